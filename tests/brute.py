"""Brute-force statements of the searcher's rules, line by line in plain Python (test oracle)."""

from __future__ import annotations

from difflib import SequenceMatcher, get_close_matches


def py_lines(text: str):
    """Universal newlines: what iterating a text-mode file yields, terminators removed."""
    out = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if out and out[-1] == "":
        out.pop()
    return out


def exact_hits(text: str, query: str):
    return [(i, line.strip()) for i, line in enumerate(py_lines(text), start=1)
            if query.lower() in line.lower()]


def best_word(words, word, cutoff):
    """(ratio, word) of the best match, ties to the larger candidate, or None."""
    best = get_close_matches(word, words, n=1, cutoff=cutoff)
    return (SequenceMatcher(None, best[0], word).ratio(), best[0]) if best else None


def fuzzy_hits(text: str, query: str, cutoff: float):
    out = []
    for i, line in enumerate(py_lines(text), start=1):
        m = best_word(line.lower().split(), query.lower(), cutoff)
        if m is None:
            continue
        conf = SequenceMatcher(None, query, m[1]).ratio()
        out.append((i, line.strip(), m[1], m[0], conf))
    return out
