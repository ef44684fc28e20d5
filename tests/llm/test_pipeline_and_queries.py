"""The registered queries of the text operators, and the corpus pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from claimlake.llm import queries
from claimlake.llm.common import DOCUMENT_COLUMNS
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.llm.cases import ROWS, contamination, counted, docs, jaccard_links, rows_of
from tests.llm.test_corpus import plain_dedup
from tests.llm.test_per_document import check_packing

from claimlake.llm import quality


def test_one_query_per_operator():
    names = entry.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_values_agree(spark, sf_dir, name):
    ours = spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert difference(ours, duck_rows(connect(sf_dir), queries.ORACLE_SQL[name])) is None


@pytest.mark.parametrize("name", ["op4_url_filter", "op5_personal_data", "op7_decontamination"])
def test_native_plans(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_pipeline_by_brute_force(spark, sf_dir):
    rows = [tuple(r[c] for c in DOCUMENT_COLUMNS) for r in rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))]
    items = [tuple(r.values()) for r in rows_of(spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))]
    judged = [(r, quality.judge(r[1], quality.QualityParams())) for r in rows]
    left = [(r[0], j[-1], r[2], r[3], len(j[-1])) for r, j in judged if j[6]]
    cleaned = {d: t for d, _, t, _, _ in plain_dedup(left, 0.1, 3)}
    left = [(d, cleaned[d], lang, source, n) for d, _, lang, source, n in left]
    classes = jaccard_links([(r[0], r[1]) for r in left])
    left = [r for r, (first, _) in zip(left, classes) if r[0] == first]
    clean = [r for r, c in zip(left, contamination([(r[0], r[1]) for r in left], items)) if not c[4]]
    assert 0 < len(clean) < len(left) < len(rows)
    check_packing(corpus_pipeline.run(spark, sf_dir).toPandas(), clean, 2048)


def test_stages_keep_the_columns_and_take_any_rows(spark, sf_dir):
    for rows in (ROWS, []):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs(spark, rows), sf_dir).columns == list(DOCUMENT_COLUMNS)
            assert stage(spark, docs(spark, rows), sf_dir).count() <= len(rows)


def test_clean_documents_stay(spark, sf_dir):
    clean = [(i, f"Sentence number {i} has its own words, such as w{i}a, w{i}b and w{i}c, and it ends here.", "en", "s", 80) for i in range(30)]
    frame = docs(spark, clean)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
    assert counted(frame.select("doc_id", "text")) == counted(docs(spark, clean).select("doc_id", "text"))
