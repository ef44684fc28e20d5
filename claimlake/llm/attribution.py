"""Token counts per section from one encoding of the whole document.

A document is encoded once. The byte lengths of its tokens give their spans; the
sections are the lines that have a character other than white space, each
running to the start of the next. Spans and sections are joined as sorted
intervals. A token that crosses a boundary is allocated by ``rule``:

* ``majority``: the section that holds most of its bytes, the earlier one on a tie;
* ``start``: the section that holds its first byte.

Every token is allocated exactly once, so the counts of a document add up to its
tokens; text before the first section belongs to it. A null or empty text, and one
of white space alone, has no sections; its tokens are counted as unallocated. A
null id is carried; repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from claimlake.llm.common import BATCH_ROWS, text_or_empty


@dataclass(frozen=True)
class AttributionParams:
    ranks: str  # path of a byte-level vocabulary in tiktoken's text form
    pattern: str  # how that vocabulary splits a text before merging
    rule: str = "majority"


class LengthEncoder:
    """Byte lengths of the tokens of a text, in order."""

    def __init__(self, params: AttributionParams):
        import tiktoken

        with open(params.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("corpus", pat_str=params.pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def __call__(self, text: str) -> np.ndarray:
        return self.lengths[self.encoding.encode_ordinary(text)]


def section_starts(text: str) -> list[tuple[int, int]]:
    """(start, line number) in bytes of every line that is not blank."""
    starts, at = [], 0
    for number, line in enumerate(text.split("\n")):
        if line.strip():
            starts.append((at, number))
        at += len(line.encode("utf-8", "surrogatepass")) + 1
    return starts


def allocate(lengths: np.ndarray, starts: list[int], rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section, and how many tokens crossed a boundary.

    Section k covers bytes from its start to the next one's; the first also covers
    what comes before it.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    inner = np.asarray(starts[1:], dtype=np.int64)
    first = np.searchsorted(inner, begins, side="right")
    last = np.searchsorted(inner, ends - 1, side="right")
    crossing = np.flatnonzero(first != last)
    owner = first.copy()
    if rule == "majority":
        for i in crossing:
            cuts = [int(begins[i]), *map(int, inner[first[i] : last[i]]), int(ends[i])]
            owner[i] += int(np.argmax(np.diff(cuts)))
    return np.bincount(owner, minlength=len(starts)), len(crossing)


@cache
def encoder_of(params: AttributionParams) -> LengthEncoder:
    """One per Python worker."""
    return LengthEncoder(params)


SECTIONS = ArrayType(StructType().add("line", "long").add("n_tokens", "long"))
_ARROW = pa.list_(pa.struct([("line", pa.int64()), ("n_tokens", pa.int64())]))


def attribute(
    docs: DataFrame, params: AttributionParams, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: tokens, tokens per section, tokens that crossed, tokens of no section."""
    if params.rule not in ("majority", "start"):
        raise ValueError(f"no such rule: {params.rule}")
    source = docs.select(id_column, text_or_empty(text_column).alias("counted"))

    def row(encoder: LengthEncoder, text: str) -> tuple:
        lengths, starts = encoder(text), section_starts(text)
        if not starts:
            return len(lengths), 0, len(lengths), []
        counts, crossing = allocate(lengths, [s for s, _ in starts], params.rule)
        return len(lengths), crossing, 0, [{"line": n, "n_tokens": int(c)} for (_, n), c in zip(starts, counts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(params)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                columns = list(zip(*(row(encoder, t) for t in part.column(1).to_pylist())))
                made = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [_ARROW])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *made], names=[id_column, "n_tokens", "n_crossing", "n_unallocated", "sections"]
                )

    schema = source.select(id_column).schema
    for name in ("n_tokens", "n_crossing", "n_unallocated"):
        schema = schema.add(name, "long")
    schema = schema.add("sections", SECTIONS)
    return source.mapInArrow(run, schema)
