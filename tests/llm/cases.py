"""Rows that every text operator must cope with, and plain reference versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven twelve.", "en", "a", 60),
    (1, "one two three four five six seven eight nine ten eleven twelve.", "en", "a", 60),  # repeated row
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t\n ", "en", None, 4),
    (None, "a row without an id, ten words or more of it here.", "en", "b", 48),
    (5, LONG, "en", "b", len(LONG)),
    (6, "éà üñ ß İ \U0001f600 x\x00y", "fr", "b", 14),
    (7, "x" * 70_000, "en", "a", 70_000),
    (8, "7 " * 30_000, "en", "a", 60_000),
]
#: Names that operators use for their own columns.
CLASHING = (
    "id k1 k2 t words grams p hash place shift digest values band root least n_docs kept base spans extra site "
    "line_site line_digests hits page_text part group pieces level number host path rule listed n_words start "
    "sequence_id offset length judged_text searched counted stripped first in_group key_1 key_of_1 n_lines n_hit"
).split()


def docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, DOCS)


def with_clashes(df):
    return df.select("*", *[F.lit("clash").alias(name) for name in CLASHING if name not in df.columns])


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def counted(df):
    return Counter(str(sorted(r.items())) for r in rows_of(df))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(TO_LOWER))


def contamination(rows, items):
    """doc rows (id, text) and item rows (id, text): the contract's result by brute force."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        width = min(13, len(w))
        for i in range(len(w) - width + 1 if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    widths = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for width in widths:
            for i in range(len(w) - width + 1):
                if got := windows.get(tuple(w[i : i + width])):
                    found |= got
                    hit |= set(range(i, i + width))
        out.append((doc, len(w), len(hit), sorted(map(str, found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def jaccard_links(rows, threshold=0.8):
    """Position of each row to (least id of its component, links), by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, parent = Counter(), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 1000 * both >= round(1000 * threshold) * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            parent[find(j)] = find(i)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    ids = {root: min((d for d in group if d is not None), default=None) for root, group in least.items()}
    return [(ids[find(i)], links[i]) for i in range(len(rows))]
