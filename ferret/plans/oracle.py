"""DuckDB SQL for every registered key: an independent statement of the same result.

The SQL is written from the rules (universal newlines, Python whitespace,
lower-case substring, ...), not from the Spark plan, so the two can disagree.
"""

from __future__ import annotations

from ferret.functions.text import LINE_BREAK, WS_CHARS, WS_RUN

WS_CHARS_SQL = " || ".join(f"chr({ord(c)})" for c in WS_CHARS)


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lines_cte(table: str, keys, text: str, name: str = "lines", where: str = "") -> str:
    k = ", ".join(keys)
    w = f" WHERE {where}" if where else ""
    return (f"{name}_parts AS (SELECT {k}, string_split_regex({text}, '{LINE_BREAK}') AS p FROM {table}{w}), "
            f"{name} AS (SELECT {k}, CAST(i AS BIGINT) AS line_no, p[i] AS line "
            f"FROM {name}_parts, LATERAL range(1, len(p) + 1) t(i) "
            f"WHERE NOT (i = len(p) AND p[i] = ''))")


def strip_sql(col: str) -> str:
    return f"trim({col}, {WS_CHARS_SQL})"


def words_sql(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), '{WS_RUN}'), lambda x: x <> '')"


def tokens_cte(lines: str = "lines", keys=("doc_id",), name: str = "tokens") -> str:
    k = ", ".join(keys)
    return f"{name} AS (SELECT {k}, line_no, unnest({words_sql('line')}) AS token FROM {lines})"


def exact_sql(table: str, keys, text: str, query: str) -> str:
    k = ", ".join(keys)
    q = sql_str(query.lower())
    return (f"WITH {lines_cte(table, keys, text)} "
            f"SELECT {k}, line_no, {strip_sql('line')} AS line FROM lines WHERE contains(lower(line), {q})")


def bounds_sql(tok: str, q: str, cutoff: float) -> str:
    """The two native bounds, same arithmetic as the Spark side."""
    from collections import Counter
    n = len(q)
    length_b = f"2.0::DOUBLE * least(length({tok}), {n}) / (length({tok}) + {n})"
    terms = " + ".join(
        f"least({c}, length({tok}) - length(replace({tok}, {sql_str(ch)}, '')))"
        for ch, c in sorted(Counter(q).items()))
    char_b = f"2.0::DOUBLE * ({terms}) / (length({tok}) + {n})"
    return f"({length_b} >= {cutoff!r}::DOUBLE AND {char_b} >= {cutoff!r}::DOUBLE)"


def ratio_ctes(pairs: str, prefix: str) -> str:
    """CTEs computing difflib's ratio for every row (a, b) of ``pairs``.

    Matching blocks are found recursively: in each window the longest common block,
    ties to the earliest start in a, then in b; then the windows left and right of
    it. Valid while b is shorter than 200 characters (no autojunk).
    Result CTE ``{prefix}_ratio(a, b, ratio)``.
    """
    p = prefix
    return (
        f"{p}_blocks AS (SELECT a, b, i, j, k FROM {pairs}, "
        f"LATERAL range(0, length(a)) ti(i), LATERAL range(0, length(b)) tj(j), "
        f"LATERAL range(1, least(length(a) - i, length(b) - j) + 1) tk(k) "
        f"WHERE substr(a, i + 1, k) = substr(b, j + 1, k)), "
        f"{p}_w(a, b, alo, ahi, blo, bhi, m, kind) AS ("
        f"SELECT a, b, 0, length(a), 0, length(b), 0, 'w' FROM {pairs} "
        f"UNION ALL "
        f"SELECT x.a, x.b, "
        f"CASE v.side WHEN 'L' THEN x.alo WHEN 'R' THEN x.i + x.k ELSE x.alo END, "
        f"CASE v.side WHEN 'L' THEN x.i WHEN 'R' THEN x.ahi ELSE x.ahi END, "
        f"CASE v.side WHEN 'L' THEN x.blo WHEN 'R' THEN x.j + x.k ELSE x.blo END, "
        f"CASE v.side WHEN 'L' THEN x.j WHEN 'R' THEN x.bhi ELSE x.bhi END, "
        f"CASE v.side WHEN 'M' THEN x.k ELSE 0 END, "
        f"CASE v.side WHEN 'M' THEN 'm' ELSE 'w' END "
        f"FROM (SELECT w.a, w.b, w.alo, w.ahi, w.blo, w.bhi, bl.i, bl.j, bl.k, "
        f"row_number() OVER (PARTITION BY w.a, w.b, w.alo, w.blo ORDER BY bl.k DESC, bl.i, bl.j) AS rn "
        f"FROM {p}_w w JOIN {p}_blocks bl ON bl.a = w.a AND bl.b = w.b AND bl.i >= w.alo "
        f"AND bl.i + bl.k <= w.ahi AND bl.j >= w.blo AND bl.j + bl.k <= w.bhi WHERE w.kind = 'w') x, "
        f"(VALUES ('L'), ('R'), ('M')) v(side) "
        f"WHERE x.rn = 1 AND (v.side = 'M' OR (v.side = 'L' AND x.alo < x.i AND x.blo < x.j) "
        f"OR (v.side = 'R' AND x.i + x.k < x.ahi AND x.j + x.k < x.bhi))), "
        f"{p}_ratio AS (SELECT pr.a, pr.b, 2.0::DOUBLE * coalesce(sum(w.m), 0) / (length(pr.a) + length(pr.b)) AS ratio "
        f"FROM {pairs} pr LEFT JOIN {p}_w w ON w.a = pr.a AND w.b = pr.b AND w.kind = 'm' "
        f"GROUP BY pr.a, pr.b)"
    )


def fuzzy_ctes(table: str, keys, text: str, query: str, cutoff: float) -> str:
    """CTEs up to ``best``: per line the chosen word with both scores."""
    k = ", ".join(keys)
    ql = query.lower()
    pk = ", ".join(f"t.{c}" for c in keys)
    return (
        f"WITH RECURSIVE {lines_cte(table, keys, text)}, "
        f"tokens AS (SELECT {k}, line_no, line, unnest({words_sql('line')}) AS token FROM lines), "
        f"cand AS (SELECT DISTINCT token FROM tokens WHERE {bounds_sql('token', ql, cutoff)}), "
        f"sel_pairs AS (SELECT token AS a, {sql_str(ql)} AS b FROM cand), "
        f"{ratio_ctes('sel_pairs', 'sel')}, "
        f"chosen AS (SELECT a AS token, ratio AS select_score FROM sel_ratio WHERE ratio >= {cutoff!r}::DOUBLE), "
        f"conf_pairs AS (SELECT {sql_str(query)} AS a, token AS b FROM chosen), "
        f"{ratio_ctes('conf_pairs', 'conf')}, "
        f"scores AS (SELECT c.token, c.select_score, r.ratio AS confidence FROM chosen c "
        f"JOIN conf_ratio r ON r.b = c.token), "
        f"ranked AS (SELECT {pk}, t.line_no, t.line, t.token, s.select_score, s.confidence, "
        f"row_number() OVER (PARTITION BY {pk}, t.line_no ORDER BY s.select_score DESC, t.token DESC) AS rn "
        f"FROM tokens t JOIN scores s ON s.token = t.token), "
        f"best AS (SELECT {k}, line_no, {strip_sql('line')} AS line, token AS matched_token, "
        f"select_score, confidence FROM ranked WHERE rn = 1)"
    )


# ---------------------------------------------------------------- ingest

# Extension of the manifest file for doc_id % 8 (0..7).
MANIFEST_EXTS = (".txt", ".docx", ".pdf", ".html", ".C", ".c", ".zip", "")
EXT_RE = r"^\.*[^.].*?(\.[^.]*)$"


def manifest_cte() -> str:
    exts = ", ".join(sql_str(e) for e in MANIFEST_EXTS)
    return (f"manifest AS (SELECT doc_id, 'd' || CAST(doc_id // 8 AS VARCHAR) || ([{exts}])[doc_id % 8 + 1] "
            f"AS file_name, text FROM documents)")


def classified_cte(src: str, name: str, types, type_match: str = "member", out: str = "classified") -> str:
    if type_match == "member":
        extra = f"list_contains([{', '.join(sql_str(t) for t in types)}], ext)"
    else:
        extra = f"instr({sql_str(str(tuple(types)))}, ext) > 0"
    return (f"{out}_e AS (SELECT *, regexp_extract({name}, '{EXT_RE}', 1) AS ext FROM {src}), "
            f"{out} AS (SELECT *, left({name}, length({name}) - length(ext)) AS head, "
            f"upper(regexp_replace(ext, '^\\.+', '')) AS label, "
            f"CASE WHEN ext = '.docx' THEN 'docx' WHEN ext = '.pdf' THEN 'pdf' "
            f"WHEN {extra} THEN 'plain' ELSE 'skip' END AS handler FROM {out}_e)")


def sql_fill(template: str, **exprs) -> str:
    """A message template as a SQL string expression."""
    import re
    parts = re.split(r"\{(\w+)\}", template)
    out = [sql_str(p) if i % 2 == 0 else f"CAST({exprs[p]} AS VARCHAR)" for i, p in enumerate(parts)
           if i % 2 == 1 or p != ""]
    return "(" + " || ".join(out) + ")"


def converted_cte(src: str, name: str, text: str, out: str = "converted", codec_exts=()) -> str:
    """docx/pdf fail without a codec (those of ``codec_exts`` give marked text), plain copies are 'unsure'."""
    from ferret.operators import ingest as I
    fail = sql_fill(I.MSG_FAIL, cause=sql_fill(I.CAUSE_NO_CODEC, ext="ext"), name=name)
    has = f"ext IN ({', '.join(sql_str(e) for e in codec_exts)})" if codec_exts else "false"
    body = f"regexp_replace({text}, '\\r\\n|\\r', chr(10), 'g')"
    return (f"{out}_s AS (SELECT *, CASE WHEN handler = 'plain' THEN 'unsure' WHEN handler = 'skip' THEN 'skip' "
            f"WHEN {has} THEN 'success' ELSE 'fail' END AS status, "
            f"CASE WHEN handler = 'plain' THEN {body} WHEN handler <> 'skip' AND {has} THEN '# ' || {body} END AS out_text "
            f"FROM {src}), "
            f"{out} AS (SELECT *, CASE status "
            f"WHEN 'success' THEN {sql_fill(I.MSG_SUCCESS, name=name)} "
            f"WHEN 'fail' THEN {fail} "
            f"WHEN 'unsure' THEN {sql_fill(I.MSG_UNSURE, ext='ext', name=name)} "
            f"ELSE {sql_fill(I.MSG_SKIP, name=name)} END AS message FROM {out}_s)")


def named_cte(src: str, name: str, out: str = "named") -> str:
    from ferret.operators import ingest as I
    first = sql_fill(I.OUT_NAME, head="head", label="label")
    nth = sql_fill(I.OUT_NAME_N, head="head", label="label", n="rk")
    return (f"{out} AS (SELECT *, CASE WHEN status IN ('success', 'unsure') THEN "
            f"CASE WHEN rk = 0 THEN {first} ELSE {nth} END END AS out_name "
            f"FROM (SELECT *, CASE WHEN status IN ('success', 'unsure') THEN row_number() OVER "
            f"(PARTITION BY status IN ('success', 'unsure'), head, label ORDER BY {name}) - 1 END AS rk FROM {src}))")


# ---------------------------------------------------------------- many queries

def queries_cte() -> str:
    """Queries derived from benchmark: every distinct word (own case) of all items' texts."""
    return (f"queries AS (SELECT DISTINCT w AS query_id, w AS query FROM (SELECT unnest("
            f"regexp_split_to_array(text, '{WS_RUN}')) AS w FROM benchmark) WHERE w <> '')")


def fuzzy_many_ctes(cutoff: float) -> str:
    c = f"{cutoff!r}::DOUBLE"
    overlap = ("list_sum(list_transform(list_distinct(string_split(q.lq, '')), lambda ch: "
               "least(length(q.lq) - length(replace(q.lq, ch, '')), "
               "length(v.token) - length(replace(v.token, ch, '')))))")
    return (
        f"WITH RECURSIVE {queries_cte()}, {lines_cte('documents', ['doc_id'], 'text')}, "
        f"tokens AS (SELECT doc_id, line_no, line, unnest({words_sql('line')}) AS token FROM lines), "
        f"vocab AS (SELECT DISTINCT token FROM tokens), "
        f"lq AS (SELECT query_id, query, lower(query) AS lq FROM queries), "
        f"cand AS (SELECT v.token, q.query_id, q.query, q.lq FROM vocab v, lq q "
        f"WHERE 2.0::DOUBLE * least(length(v.token), length(q.lq)) / (length(v.token) + length(q.lq)) >= {c} "
        f"AND 2.0::DOUBLE * {overlap} / (length(v.token) + length(q.lq)) >= {c}), "
        f"sel_pairs AS (SELECT DISTINCT token AS a, lq AS b FROM cand), "
        f"{ratio_ctes('sel_pairs', 'sel')}, "
        f"chosen AS (SELECT c.token, c.query_id, c.query, r.ratio AS select_score FROM cand c "
        f"JOIN sel_ratio r ON r.a = c.token AND r.b = c.lq WHERE r.ratio >= {c}), "
        f"conf_pairs AS (SELECT DISTINCT query AS a, token AS b FROM chosen), "
        f"{ratio_ctes('conf_pairs', 'conf')}, "
        f"scores AS (SELECT c.token, c.query_id, c.select_score, r.ratio AS confidence FROM chosen c "
        f"JOIN conf_ratio r ON r.a = c.query AND r.b = c.token), "
        f"ranked AS (SELECT s.query_id, t.doc_id, t.line_no, t.line, t.token, s.select_score, s.confidence, "
        f"row_number() OVER (PARTITION BY s.query_id, t.doc_id, t.line_no "
        f"ORDER BY s.select_score DESC, t.token DESC) AS rn FROM tokens t JOIN scores s ON s.token = t.token), "
        f"best AS (SELECT query_id, doc_id, line_no, {strip_sql('line')} AS line, token AS matched_token, "
        f"select_score, confidence FROM ranked WHERE rn = 1)"
    )
