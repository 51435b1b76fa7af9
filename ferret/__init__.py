"""ferret: corpus search and text ingest as Spark DataFrame jobs."""

from ferret.functions.text import lines_of, strip_ws, tokens_of, words_of
from ferret.operators.counts import hits_per_file, hits_total, observe_hits
from ferret.operators.exact import exact_search, exact_search_texts
from ferret.operators.fuzzy import fuzzy_scores, fuzzy_search, vocabulary
from ferret.operators.ingest import classify, convert, convert_plain_lines, ingest_files, inventory, name_outputs, removal_manifest, \
    report, report_verbose, write_texts
from ferret.operators.multi import exact_search_many, fuzzy_search_many
from ferret.operators.search import search, search_methods
from ferret.sources.files import read_binary, read_lines, read_texts, read_type_list
from ferret.sources.tables import read_corpus, read_table

__all__ = [
    "lines_of", "strip_ws", "tokens_of", "words_of",
    "hits_per_file", "hits_total", "observe_hits",
    "exact_search", "exact_search_texts", "fuzzy_scores", "fuzzy_search", "vocabulary",
    "classify", "convert", "convert_plain_lines", "ingest_files", "inventory", "name_outputs", "removal_manifest",
    "report", "report_verbose", "write_texts",
    "exact_search_many", "fuzzy_search_many", "search", "search_methods",
    "read_binary", "read_lines", "read_texts", "read_type_list", "read_corpus", "read_table",
]
