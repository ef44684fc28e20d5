"""Diagnosis-code mapping as Catalyst expressions over literal maps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.codes import (
    BRACKETS,
    CATEGORIES,
    CONDITIONS,
    CROSSWALK,
    DEMOGRAPHIC,
    DEMOGRAPHIC_DEFAULT,
    INTERACTIONS,
    UNMAPPED_LABEL,
)

_BLANKS = " \t\r\n"


def _sql_text(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def _sql_map(pairs: dict) -> str:
    return "map(" + ", ".join(_sql_text(x) for x in chain.from_iterable(pairs.items())) + ")"


def _literal_map(pairs: dict) -> Column:
    return F.expr(_sql_map(pairs))


def _code_to_hcc() -> Column:
    return _literal_map({row.icd10_code: row.hcc_number for row in CROSSWALK})


def _code_to_label() -> Column:
    return _literal_map({row.icd10_code: row.hcc_description for row in CROSSWALK})


def _hcc_to_weight() -> Column:
    return _literal_map({hcc: weight for hcc, (_, weight, _) in CATEGORIES.items()})


def clean_code(code: Column) -> Column:
    return F.upper(F.btrim(code, F.lit(_BLANKS)))


def hcc_list(codes: Column) -> Column:
    """Pipe-delimited diagnosis codes to the sorted distinct category numbers."""
    lookup = _code_to_hcc()
    mapped = F.transform(F.split(codes, r"\|"), lambda code: lookup[clean_code(code)])
    found = F.array_sort(F.array_distinct(F.array_compact(mapped)))
    return F.coalesce(found, F.array().cast("array<int>"))


def hcc_weight_total(hccs: Column) -> Column:
    """Coefficients of a category list, each counted once."""
    weight = _hcc_to_weight()
    return F.round(F.aggregate(hccs, F.lit(0.0), lambda total, hcc: total + weight[hcc]), 4)


def _usable(code: Column) -> Column:
    return code.isNotNull() & (code != "")


def primary_hcc(code: Column) -> Column:
    return F.when(_usable(code), _code_to_hcc()[clean_code(code)])


def primary_hcc_desc(code: Column) -> Column:
    label = F.coalesce(_code_to_label()[clean_code(code)], F.lit(UNMAPPED_LABEL))
    return F.when(_usable(code), label)


def condition_flags(hccs: Column) -> dict[str, Column]:
    return {
        flag: reduce(or_, [F.array_contains(hccs, n) for n in numbers])
        for flag, numbers in CONDITIONS.items()
    }


def interaction_terms() -> dict[str, Column]:
    """Interaction weights from the condition flag columns."""
    return {
        term: (F.col(a) & F.col(b)).cast("double") * weight
        for term, (a, b, weight) in INTERACTIONS.items()
    }


def interaction_total() -> Column:
    first, *rest = [F.col(term) for term in INTERACTIONS]
    return reduce(lambda total, term: total + term, rest, first)


def nearest_bracket(age: Column) -> Column:
    """The 5-year bracket nearest to an age, within the published range."""
    low, high = BRACKETS[0], BRACKETS[-1]
    clamped = F.greatest(F.lit(low), F.least(F.lit(high), age))
    bracket = (F.round((clamped - low) / 5) * 5 + low).cast("int")
    return F.when(age.isNotNull(), bracket)


def demographic_raf(sex: Column, age: Column) -> Column:
    cells = {
        f"{s}{bracket}": weight
        for s, weights in DEMOGRAPHIC.items()
        for bracket, weight in zip(BRACKETS, weights)
    }
    cell = F.concat(sex, nearest_bracket(age).cast("string"))
    return F.coalesce(_literal_map(cells)[cell], F.lit(DEMOGRAPHIC_DEFAULT))


def values_frame(spark: SparkSession, columns: str, rows: Iterable[Sequence]) -> DataFrame:
    """A constant table. The planner knows its size, so it broadcasts it unasked."""
    listed = ", ".join("(" + ", ".join(_sql_text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({columns})")


def crosswalk_frame(spark: SparkSession) -> DataFrame:
    """The crosswalk as a DataFrame, one row per diagnosis code."""
    return values_frame(spark, "icd10_code, hcc_number, hcc_description, raf_coefficient", CROSSWALK)


def demographic_frame(spark: SparkSession) -> DataFrame:
    rows = [(s, b, w) for s, weights in DEMOGRAPHIC.items() for b, w in zip(BRACKETS, weights)]
    return values_frame(spark, "sex, bracket, demographic_raf", rows)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the mapping callable from SQL.

    The bodies are SQL expressions, so Catalyst inlines them like the
    DataFrame forms and no Python worker is involved.
    """
    to_hcc = _sql_map({r.icd10_code: r.hcc_number for r in CROSSWALK})
    to_label = _sql_map({r.icd10_code: r.hcc_description for r in CROSSWALK})
    weights = _sql_map({hcc: weight for hcc, (_, weight, _) in CATEGORIES.items()})
    blanks = "' \\t\\r\\n'"
    hccs = (
        "coalesce(array_sort(array_distinct(array_compact(transform(split(codes, '\\\\|'), "
        f"c -> {to_hcc}[upper(btrim(c, {blanks}))])))), cast(array() as array<int>))"
    )
    bodies = {
        "icd_to_hcc_list(codes STRING) RETURNS ARRAY<INT>": hccs,
        "icd_to_hcc_raf_total(codes STRING) RETURNS DOUBLE":
            f"round(aggregate({hccs}, 0.0D, (total, h) -> total + {weights}[h]), 4)",
        "icd_to_primary_hcc(code STRING) RETURNS INT":
            f"if(code <> '', {to_hcc}[upper(btrim(code, {blanks}))], null)",
        "icd_to_primary_hcc_desc(code STRING) RETURNS STRING":
            f"if(code <> '', coalesce({to_label}[upper(btrim(code, {blanks}))], "
            f"{_sql_text(UNMAPPED_LABEL)}), null)",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
