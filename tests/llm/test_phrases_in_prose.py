"""Boilerplate phrases inside prose."""

import pytest

import corpus_pipeline
from claimlake.llm import quality
from tests.llm.cases import docs, rows_of


def prose(i, phrase):
    return (
        f"Sentence number {i} has its own words, such as w{i}a, w{i}b and w{i}c, before it mentions that {phrase} is "
        f"a phrase w{i}d that stands on many pages w{i}e of the web w{i}f; then it goes on w{i}g for a while and ends."
    )


def test_prose_with_a_phrase_stays(spark, sf_dir):
    rows = [(i, prose(i, phrase), "en", "s", 1) for i, phrase in enumerate(quality.BOILERPLATE)]
    rows += [
        (100 + i, f"A first line w{i}h that is clean.\n{prose(i + 100, phrase)}\nA last line w{i}i that is clean.", "en", "s", 1)
        for i, phrase in enumerate(quality.BOILERPLATE)
    ]
    kept = {r["doc_id"]: r["text"] for r in rows_of(corpus_pipeline.quality_rules(spark, docs(spark, rows), sf_dir))}
    assert kept == {r[0]: r[1] for r in rows}


@pytest.mark.parametrize("phrase", quality.BOILERPLATE)
def test_lines_made_of_phrases_go(phrase):
    for line in (f"Please note: {phrase.upper()}!", " - ".join([f"{phrase} now"] * 12)):
        assert quality.line_fault(line, quality.QualityParams()) == "boilerplate"
