"""Groups of copies in the line dedup of the pipeline."""

import corpus_pipeline
from tests.llm.cases import docs, rows_of


def story(name, n=12):
    return [f"Line {i} of story {name} has words such as {name}{i}a, {name}{i}b and {name}{i}c in it." for i in range(n)]


def test_copies_do_not_make_their_own_lines_boilerplate(spark, sf_dir):
    menu = "the menu of this site"
    rows = [(i, "\n".join([menu, *story("copy")]), "en", "s", 1) for i in range(20)]  # a third of the source
    near = {100 + i: story("near") + [f"Number {i} ends with words of its own, own{i}."] for i in range(20)}
    rows += [(i, "\n".join([menu, *lines]), "en", "n", 1) for i, lines in near.items()]
    other = {1000 + i: story(f"o{i}x", 3) for i in range(80)}
    rows += [(i, "\n".join([menu, *lines]), "en", "sn"[i % 2], 1) for i, lines in other.items()]
    rows += [(2000 + i, "\n".join(story("few")), "en", "few", 1) for i in range(3)]  # three pages of a small source
    rows += [(2010 + i, "\n".join([*story("tiny"), f"and {i}"]), "en", "tiny", 1) for i in range(3)]
    cleaned = corpus_pipeline.site_lines(spark, docs(spark, rows), sf_dir)
    text = {r["doc_id"]: r["text"] for r in rows_of(cleaned)}
    assert all(text[i] == "\n".join(story("copy")) for i in range(20))
    assert all(text[i] == "\n".join(lines) for i, lines in (near | other).items())
    assert all(text[2000 + i] == "\n".join(story("few")) for i in range(3))
    assert all(text[2010 + i] == "\n".join([*story("tiny"), f"and {i}"]) for i in range(3))
    kept = {r["doc_id"] for r in rows_of(corpus_pipeline.near_duplicates(spark, cleaned, sf_dir))}
    assert kept == {0, 100, 2000, 2010, *other}
