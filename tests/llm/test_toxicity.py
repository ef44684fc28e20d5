"""Toxicity: held-out accuracy, the grammar by a plain walk over its machines, and learning."""

import random
import zlib

import numpy as np
import pytest

from claimlake.llm import queries, toxicity
from claimlake.llm.toxicity import (
    CLOSED, FEATURES, MACHINES, NEGATED, NOTHING, PLAIN, REPORTED, SYMBOLS, TARGETED, THREATENED, Grammar, Lexicon,
    ToxicityModel, ToxicityParams, compose, tokens,
)
from tests.llm.cases import DOCS, ROWS, docs, with_clashes

PARAMS = ToxicityParams()
LISTED = ToxicityModel({}, {}, PARAMS.prior, PARAMS)


def outputs(text, lexicon=None):
    grammar, state, out = Grammar(lexicon or Lexicon({}, {}, PARAMS), PARAMS.reach), 0, []
    for word in tokens(text):
        symbol = grammar.lexicon.symbol(word)[0]
        out.append(grammar.outputs[state][symbol])
        state = grammar.following[state][symbol]
    return [o for o in out if o not in (NOTHING, CLOSED)]


def test_clauses():
    assert outputs("What an idiot.") == [PLAIN]
    assert outputs("You are an idiot, idiot!") == [TARGETED, PLAIN]
    assert outputs("She is not stupid; stupid") == [NEGATED, PLAIN]
    assert outputs("He isn't really so very stupid") == [PLAIN]  # beyond the reach of both
    assert outputs('He said "you are scum". Scum!') == [REPORTED, PLAIN]
    assert outputs("They called the clown a loser. You loser") == [REPORTED, REPORTED, TARGETED]
    assert outputs("I will kill you. I kill time.") == [THREATENED]
    assert outputs("I would never hurt you") == [NEGATED]
    assert outputs("Kill. You") == []
    assert outputs("") == outputs("word " * 50) == []


def test_product_is_the_machines_side_by_side():
    following, out = compose(PARAMS.reach)
    rng = random.Random(2)
    for _ in range(200):
        states, state = [0] * len(MACHINES), 0
        for _ in range(30):
            symbol = rng.randrange(SYMBOLS)
            steps = [m(s, symbol, PARAMS.reach) for m, s in zip(MACHINES, states)]
            assert out[state][symbol] == toxicity._output(symbol, *(mark for _, mark in steps))
            states, state = [s for s, _ in steps], following[state][symbol]


def test_context_lowers_the_score():
    grammar, weights = LISTED.grammar(), np.asarray(LISTED.coefficients)
    value = lambda text: float(np.dot(grammar.features(text), weights))
    plain, target = value("A worthless idiot and pathetic clown"), value("you worthless idiot, you pathetic clown")
    quoted, negated = value('She wrote "worthless idiot, pathetic clown"'), value("not worthless, no idiot, no clown")
    assert target > plain > max(quoted, negated) > value("a fine day")
    assert len(grammar.features("")) == len(FEATURES) == len(PARAMS.prior)


def toxic_rows(n=2400, seed=1):
    """Texts of invented words; toxic ones hold two words of a hidden stem, or a hidden word."""
    rng = random.Random(seed)
    syllables = "ka lo mi tu re sa no pi".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(2, 5)))
    rows, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randrange(15, 60))], rng.random() < 0.15
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), "zzur" + word() if i % 2 else "grumpf")
        rows.append((i, " ".join(words), "en", "a", 1))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_learns_hidden_words_and_stems(spark):
    rows, labels = toxic_rows()
    labels += [(None, 1), (5_000, 1), (7, None)]
    marked = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs(spark, rows), marked)
    assert set(model.words) == {"grumpf"} and any("zzur".startswith(s) or s.startswith("zzur") for s in model.stems)
    truth = {i: ("grumpf" in text or "zzur" in text) for i, text, *_ in rows}
    scored = toxicity.score(docs(spark, rows), model).collect()
    assert all(r.predicted == truth[r.doc_id] and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)


def test_held_out_labels_change_nothing(spark):
    rows, labels = toxic_rows(600)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    models = [toxicity.fit(docs(spark, rows), spark.createDataFrame(l, "doc_id bigint, toxic int")) for l in (labels, flipped)]
    assert models[0] == models[1]


def test_held_out_accuracy(spark):
    """On sf0.01: abusive documents found, others left alone (labels of other languages are partly noise)."""
    folder = "/root/testdata/sf0.01"
    got = queries.op11_toxicity(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (4, 0), (5, 0)]])
def test_odd_rows_and_few_labels(spark, labels):
    frame = with_clashes(docs(spark, [*ROWS, (9, "you pathetic worthless loser, you idiot", "en", "a", 1)]))
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = toxicity.score(frame, model).collect()
    assert len(got) == len(ROWS) + 1 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9].score == max(r.score for r in got) and by_id[2].score == by_id[3].score
    assert not by_id[None].held_out


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.score(empty, toxicity.fit(empty, spark.createDataFrame([], "doc_id bigint, toxic int"))).collect() == []
