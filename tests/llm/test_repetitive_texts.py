"""Contamination of texts and items that repeat themselves."""

import random
import time

from claimlake.llm import decontamination
from tests.llm.cases import contamination, docs, rows_of

ITEMS = "item_id bigint, text string"


def judged(spark, rows, items):
    got = decontamination.judged(docs(spark, [(i, t, "en", "a", 1) for i, t in rows]), spark.createDataFrame(items, ITEMS))
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows_of(got))


def test_by_brute_force(spark):
    rng = random.Random(9)
    periodic = lambda k, n: " ".join(f"w{i % k}" for i in range(n))
    items = [(1, "the"), (2, "the the"), (3, "the " * 40), (4, periodic(2, 30)), (5, periodic(3, 14)), (6, periodic(7, 60)), (7, "a b a")]
    rows = [(i, text) for i, text in enumerate(["the " * 90, "the", periodic(2, 50), periodic(3, 13), periodic(7, 200), "a b a b a", "the the a"])]
    for i in range(10, 60):
        parts = [rng.choice([periodic(rng.randrange(1, 8), rng.randrange(5, 30)), "the " * rng.randrange(20), "a b a", f"x{i}"]) for _ in range(6)]
        rows.append((i, " ".join(parts)))
    assert judged(spark, rows, items) == sorted(contamination(rows, items))


def test_a_megabyte_of_one_word(spark):
    """Against items of one word, of 400 words, and of a text that only begins like it."""
    text = "the " * 262_144
    items = [(1, "the"), (2, "the " * 400), (3, "the " * 12 + "end"), (4, "of")]
    start = time.time()
    assert judged(spark, [(1, text)], items) == [(1, 262_144, 262_144, ["1", "2"], True)]
    assert time.time() - start < 60
