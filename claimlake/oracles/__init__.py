"""The same queries as DuckDB SQL over the given tables.

``ctes.sql`` holds shared steps and ``queries.sql`` one statement per query.
A block starts with ``-- name: needs`` where ``needs`` lists the steps it
reads; ``compose`` puts those in front as CTEs.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from claimlake.codes import BRACKETS, CROSSWALK, DEMOGRAPHIC, FEATURES, TIE_COLUMNS, UNMAPPED_LABEL

# exact_sum(column), with or without a FILTER: the nearest double of an exact decimal sum
_EXACT = re.compile(r"exact_sum\((\w+)\)((?: FILTER \([^)]*\))?)")
_TIE = "substr(md5(concat_ws('|', " + ", ".join(f"coalesce({c}::VARCHAR, '')" for c in TIE_COLUMNS) + ")), 1, 16)"
_HEAD = re.compile(r"^-- (\w+):([^\n]*)$", re.M)


def _text(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _values(rows, columns: str, doubles: tuple[int, ...]) -> str:
    body = ", ".join(
        "(" + ", ".join(f"{_text(v)}::DOUBLE" if i in doubles else _text(v) for i, v in enumerate(row)) + ")"
        for row in rows
    )
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _code_tables() -> dict[str, str]:
    cells = [(s, b, w) for s, weights in DEMOGRAPHIC.items() for b, w in zip(BRACKETS, weights)]
    slots = ", ".join(_text(c) for c in (*[row.icd10_code for row in CROSSWALK], "Z0000"))
    return {
        "crosswalk": _values(CROSSWALK, "icd10_code, hcc_number, hcc_description, raf_coefficient", (3,)),
        "demographic": _values(cells, "sex, bracket, weight", (2,)),
        "slots": f"SELECT [{slots}] AS codes",
    }


def _blocks(file: str) -> dict[str, tuple[list[str], str]]:
    text = (Path(__file__).parent / file).read_text().replace("{unmapped}", UNMAPPED_LABEL).replace("{tie}", _TIE)
    text = text.replace("{features}", ", ".join(map(_text, FEATURES)))
    text = _EXACT.sub(r"CAST(CAST(sum(CAST(\1 AS DECIMAL(28, 8)))\2 AS VARCHAR) AS DOUBLE)", text)
    parts = _HEAD.split(text)[1:]
    return {
        name: (needs.replace(",", " ").split(), body.strip())
        for name, needs, body in zip(parts[0::3], parts[1::3], parts[2::3])
    }


@cache
def compose() -> dict[str, str]:
    steps = {name: ([], body) for name, body in _code_tables().items()} | _blocks("ctes.sql")

    def closure(names: list[str], seen: dict[str, None]) -> dict[str, None]:
        for name in names:
            if name not in seen:
                closure(steps[name][0], seen)
                seen[name] = None
        return seen

    queries = {}
    for name, (needs, body) in _blocks("queries.sql").items():
        ctes = ",\n".join(f"{step} AS (\n{steps[step][1]}\n)" for step in closure(needs, {}))
        queries[name] = f"WITH {ctes}\n{body}" if ctes else body
    return queries
