"""Divergence of sources against plain counting, and the transducer by itself."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from claimlake.llm import divergence
from claimlake.llm.divergence import DivergenceParams, Transducer
from tests.llm.cases import DOCS, ROWS, docs, with_clashes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least):
    read = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in read:
        seen[lang].update(set(terms))
        groups[lang].add(source)
    kept = {lang: sorted((t for t, n in c.items() if n >= least), key=str.encode) for lang, c in seen.items()}
    for lang, source, terms in read:
        good = set(kept[lang])
        counts[lang, source].update(t for t in terms if t in good)
        counts[lang, None].update(t for t in terms if t in good)
    out = []
    for lang, sources in groups.items():
        terms = kept[lang]

        def shares(source):
            total = sum(counts[lang, source].values()) + 2 * len(terms)
            return [1 + 1_000_000_000 * (counts[lang, source][t] + 2) // total for t in terms]

        def ranked(source, part, items):
            items = sorted(items, key=lambda i: (-i[1], i[0].encode()))
            out.extend((lang, source, part, i, v, rank) for rank, (i, v) in enumerate(items, 1) if part == "pair" or rank <= 10)

        share = {s: shares(s) for s in sources}
        whole = shares(None)
        for s in sources:
            ranked(s, "pair", [(o, sum((p - q) ** 2 // (p + q) for p, q in zip(share[s], share[o]))) for o in sources if o != s])
            ranked(s, "term", [
                (t, (p - q) ** 2 // (p + q)) for t, p, q in zip(terms, share[s], whole) if counts[lang, s][t] and p > q
            ])
    return Counter(out)


def rows_of_sources(n=400, seed=1):
    rng = random.Random(seed)
    names = ["alpha", "Beta", "gamma", "éclat", "ñandú", "日本", "ab", "abc", "abcd", "zz", "z", "x9y"]
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 5 + ["s1", "s2", None, ""])
        words = [rng.choice(names[: 4 + len(source or "") * 2]) for _ in range(rng.randrange(30))]
        rows.append((i, rng.choice([" ", "-", "\n"]).join(words), rng.choice(["en", "fr", None]), source, 1))
    return rows


def test_by_plain_counting(spark):
    rows = rows_of_sources() + ROWS * 2 + [(1000 + i, "", "xx", f"s{i}", 0) for i in range(3)]
    want = plain(rows, 10)
    got = divergence.audit(with_clashes(docs(spark, rows)))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {v for (lang, _, part, _, v, _) in want if lang == "xx" and part == "pair"} == {0}


def test_small_blocks_shards_and_passes(spark):
    """Several shards, shipments, term blocks and source blocks give what one of each gives."""
    rows = rows_of_sources(600, 2) + [(i, f"w{chr(97 + i % 26)}{chr(97 + i % 7)} abc", "en", f"t{i % 9}", 1) for i in range(300)]
    params = DivergenceParams(min_documents=3, shard_terms=2, ship_bytes=200, block_sources=2, block_terms=3, held_terms=5)
    got = divergence.audit(docs(spark, rows).repartition(7), params)
    assert Counter(tuple(r) for r in got.collect()) == plain(rows, 3)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_a_language_without_kept_terms(spark):
    rows = [(1, "a b", "en", "x", 3), (2, "c", "en", "y", 1), (3, None, "en", None, None)]
    got = {tuple(r) for r in divergence.audit(docs(spark, rows)).collect()}
    assert got == {("en", s, "pair", o, 0, rank) for s in ("", "x", "y") for rank, o in enumerate(sorted({"", "x", "y"} - {s}), 1)}


def test_transducer_numbers_terms_in_order():
    rng = random.Random(4)
    terms = sorted({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(1, 7))) for _ in range(400)})
    machine = Transducer.from_bytes(Transducer.of(terms).to_bytes())
    assert machine.ordinals(terms).tolist() == list(range(len(terms)))
    others = [t + b"x" for t in terms] + [b"d", b"", b"a" * 5000] + [t[:-1] for t in terms if t[:-1] not in terms]
    assert set(machine.ordinals(others).tolist()) == {-1}


def test_transducer_is_minimal():
    """States are as many as there are different sets of endings."""
    rng = random.Random(5)
    terms = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(120)})
    endings = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for t in terms for p in (t[:i] for i in range(len(t) + 1))}
    assert len(Transducer.of(terms).final) == len(endings)


def test_large_counts_are_exact(spark):
    params = DivergenceParams()
    row = spark.range(1).select(
        divergence._share(F.lit(4_000_000_000_000_000_000).cast("bigint"), F.lit(9_000_000_000_000_000_000).cast("bigint"), F.lit(5), params).alias("p")
    ).first()
    assert row.p == 1 + 1_000_000_000 * (4_000_000_000_000_000_000 + 2) // (9_000_000_000_000_000_000 + 10)
    assert Transducer.of([]).ordinals([b"a"]).tolist() == [-1] and np.size(Transducer.of([b"a"]).keys) == 1
