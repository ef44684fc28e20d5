"""Packing of token sequences with a bounded number of open windows.

Each partition is read as a stream and keeps ``open_windows`` windows open. A
document is cut into full windows and a remainder; the remainder goes into the
open window where it fits most tightly. If it fits none and all windows are
taken, the fullest is emitted. Windows still open at the end of a partition are
leftovers: groups of ``fan_in`` partitions merge theirs, emit what is full and
pass at most ``carry`` windows on, until one group is left. No task ever holds
more than ``fan_in * max(open_windows, carry)`` windows, whatever the input.

Nulls and empty texts are documents of the end id alone; a row with a null id is
packed like any other; repeated rows are packed once each; an empty table gives
no rows; ties in fit go to the window opened first. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, checkpointed, text_or_empty

PIECE = "array<struct<doc_id:bigint,start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint>>"
WINDOWS = f"part bigint, number bigint, used bigint, done boolean, pieces {PIECE}"
PIECE_TYPE = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
)
WINDOW_TYPE = pa.schema(
    [("part", pa.int64()), ("number", pa.int64()), ("used", pa.int64()), ("done", pa.bool_()), ("pieces", PIECE_TYPE)]
)


@dataclass(frozen=True)
class PackingParams:
    tokenizer: str  # path of a tokenizers JSON file
    window: int = 2048
    end_id: int = 1
    open_windows: int = 32
    fan_in: int = 16
    carry: int = 16
    #: Size of the chunks and pieces whose ids a Python worker remembers before it starts afresh.
    cached_bytes: int = 80 << 20


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer lower-cases, splits into runs of letters, digits and marks and then merges
    within each, so the ids of a text are those of its pieces in a row. Pieces repeat and
    are remembered, in ``cached_bytes`` at most beside what the texts at hand need. Those
    not met before are encoded together: each ends with the one token that carries the end
    of word. Chunks between spaces with characters beyond plain Latin letters, digits and
    marks, or with a special token, are left to the tokenizer whole.
    """

    #: Characters that are dealt with at once.
    BLOCK = 1 << 20
    #: Pieces longer than this are not remembered.
    LONGEST = 64
    # The pre-tokenization of the vocabulary, for lower-cased text of the plain alphabet.
    # Lower-casing and composition change nothing else in it, whatever the Unicode version.
    # Letters come in runs; all else is set apart: contractions, single digits, runs of marks.
    _MARKS = re.compile(r"[^a-zß-öø-ɏ \n\t\r](?:(?<=')(?:s|t|re|ve|m|ll|d)|(?<![0-9])[^a-zß-öø-ɏ0-9 \n\t\r]*|)")
    _BEYOND = re.compile(r"[^ -~\n\t\rÀ-ÖØ-öø-įı-ɏ]")
    _ODD = re.compile(r"(?<![^ \n\t\r])([!-~À-ÖØ-öø-įı-ɏ]*+[^ -~\n\t\rÀ-ÖØ-öø-įı-ɏ][^ \n\t\r]*)")
    _SPECIAL = re.compile(r"(?<![^ \n\t\r])((?:(?!<\|)[^ \n\t\r])*+<\|[^ \n\t\r]*)")

    def __init__(self, path: str, cached_bytes: int):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.limit, self.held = Tokenizer.from_file(path), cached_bytes, 0
        # pieces are normalized and split already, so what encodes them only splits at blanks
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = normalizers.Sequence([])
        bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), bytes_only])
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _plain(self, text: str) -> list[str]:
        return self._MARKS.sub(r" \g<0> ", text.lower()).split()

    def _split(self, text: str) -> list[str]:
        """Pieces of a text; a chunk for the tokenizer comes whole, with a blank before it."""
        if "<|" not in text and not self._BEYOND.search(text):
            return self._plain(text)
        odd = self._SPECIAL if "<|" in text else self._ODD
        out: list[str] = []
        for i, part in enumerate(odd.split(text)):
            if i % 2:
                out.append(" " + part)
            elif odd is self._SPECIAL:
                for j, rest in enumerate(self._ODD.split(part)):
                    out += [" " + rest] if j % 2 else self._plain(rest)
            else:
                out += self._plain(part)
        return out

    @staticmethod
    def _encoded(tokenizer, text: str) -> np.ndarray:
        (got,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(got.ids, dtype="<u4")

    def _learn(self, missing: Iterable[str]) -> None:
        pieces = []
        for piece in missing:
            if piece[0] == " ":
                self.known[piece] = self._encoded(self.tokenizer, piece[1:]).tobytes()
            else:
                pieces.append(piece)
        for i in range(0, len(pieces), 1024):
            part = pieces[i : i + 1024]
            ids = self._encoded(self.merger, " ".join(part))
            bounds = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(bounds) != len(part) or bounds[-1] != 4 * len(ids):
                self.known.update((piece, self._encoded(self.tokenizer, piece).tobytes()) for piece in part)
                continue
            data = ids.tobytes()
            self.known.update(zip(part, map(data.__getitem__, map(slice, [0, *bounds], bounds))))

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        split = [self._split(text) for text in texts]
        missing = set().union(*split).difference(self.known)
        self._learn(missing)
        known = self.known
        yield from [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for piece in missing:
            if len(piece) > self.LONGEST:
                del known[piece]
        # objects and table space of an entry, and four bytes a token
        self.held += 200 * len(missing) + 5 * sum(map(len, missing))
        if self.held > self.limit:
            known.clear()
            self.held = 0

    def _blocks(self, text: str) -> Iterator[str]:
        """The text cut at blanks into parts of about a block; a longer chunk stays whole."""
        start = 0
        while start < len(text):
            end = start + self.BLOCK
            if end < len(text):
                last = max(text.rfind(blank, start + 1, end) for blank in " \n")
                end = last if last > 0 else text.find(" ", end)
            end = len(text) if end < 0 else end
            yield text[start:end]
            start = end

    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text."""
        waiting, size = [], 0
        for text in texts:
            if size + len(text) > self.BLOCK:
                yield from self._together(waiting)
                waiting, size = [], 0
            if len(text) > self.BLOCK:
                yield b"".join(ids for block in self._blocks(text) for ids in self._together([block]))
            else:
                waiting.append(text)
                size += len(text)
        yield from self._together(waiting)

    def ids(self, text: str) -> bytes:
        return next(self.many([text]))


class OpenWindows:
    """At most ``limit`` open windows, ordered by free space for a best-fit lookup."""

    def __init__(self, size: int, limit: int | None):
        self.size, self.limit = size, limit
        self.free: list[tuple[int, int]] = []  # (free tokens, window number)
        self.pieces: dict[int, list] = {}
        self.opened = 0

    def place(self, piece: tuple, length: int) -> list[list]:
        """Put the piece away; returns the windows that are finished by it."""
        if length == self.size:
            return [[piece]]
        gone = []
        at = bisect.bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, number = self.free.pop(at)
        else:
            if self.limit is not None and len(self.free) >= self.limit:
                gone.append(self.pieces.pop(self.free.pop(0)[1]))
            room, number = self.size, self.opened
            self.opened += 1
            self.pieces[number] = []
        self.pieces[number].append(piece)
        if room == length:
            gone.append(self.pieces.pop(number))
        else:
            bisect.insort(self.free, (room - length, number))
        return gone

    def rest(self) -> list[list]:
        return [self.pieces[number] for _, number in self.free]


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = PIECE_TYPE.value_type
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([sum(p[2] for p in r[3]) for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.bool_()),
            pa.array([[dict(zip((f.name for f in names), p)) for p in r[3]] for r in rows], PIECE_TYPE),
        ],
        schema=WINDOW_TYPE,
    )


@cache
def encoder_of(path: str, cached_bytes: int) -> Encoder:
    """One per Python worker; what it knows outlasts a task."""
    return Encoder(path, cached_bytes)


def _pack_partition(params: PackingParams):
    end = np.asarray([params.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(params.tokenizer, params.cached_bytes)
        opened, ready, number, part = OpenWindows(params.window, params.open_windows), [], 0, 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for at in range(0, batch.num_rows, BATCH_ROWS):
                piece_of = batch.slice(at, BATCH_ROWS)
                encoded = encoder.many(piece_of.column(1).to_pylist())
                for doc, ids in zip(piece_of.column(0).to_pylist(), encoded, strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, params.window):
                        length = min(params.window, total - start)
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        for full in opened.place((doc, start, length, crc, total), length):
                            ready.append((part, number, True, full))
                            number += 1
                if len(ready) >= BATCH_ROWS:
                    yield _window_batch(ready)
                    ready = []
        for left in opened.rest():
            ready.append((part, number, False, left))
            number += 1
        if ready:
            yield _window_batch(ready)

    return run


def _merge_group(params: PackingParams, last: bool):
    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        pieces = [tuple(p.values()) for row in table.column("pieces").to_pylist() for p in row]
        pieces.sort(key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[3]))
        opened, out = OpenWindows(params.window, None), []
        for piece in pieces:
            out += opened.place(piece, piece[2])
        rest = opened.rest()  # fullest first
        held = 0 if last else min(params.carry, len(rest))
        rows = [(group, i, i < len(out) + len(rest) - held, w) for i, w in enumerate(out + rest)]
        return pa.Table.from_batches([_window_batch(rows)])

    return run


def pack(docs: DataFrame, params: PackingParams, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The windows are kept in the checkpoint folder before they are numbered, so a
    task that runs again cannot give another packing than its first run.
    """
    source = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        text_or_empty(text_column).alias("text"),
        F.spark_partition_id().cast("bigint").alias("part"),
    )
    found = checkpointed(source.mapInArrow(_pack_partition(params), WINDOWS))
    done, levels = found.where("done").withColumn("level", F.lit(0)), 1
    left = found.where("NOT done")
    parts = found.agg(F.max("part")).first()[0] or 0
    while True:
        last = parts < params.fan_in
        parts //= params.fan_in
        grouped = left.select(F.floor(F.col("part") / params.fan_in).cast("bigint").alias("group"), "pieces")
        merged = checkpointed(grouped.groupBy("group").applyInArrow(_merge_group(params, last), WINDOWS))
        done = done.unionByName(merged.where("done").withColumn("level", F.lit(levels)))
        if last:
            break
        left, levels = merged.where("NOT done"), levels + 1
    # 4 bits of level, 28 of partition, 31 of the window's number
    sequence = (
        F.shiftleft(F.col("level").cast("bigint"), 59) + F.shiftleft(F.col("part"), 31) + F.col("number")
    )
    placed = done.select(
        sequence.alias("sequence_id"),
        F.explode(
            F.transform(
                "pieces",
                lambda p, i: F.struct(
                    p.alias("piece"),
                    F.aggregate(F.slice("pieces", 1, i), F.lit(0).cast("bigint"), lambda a, q: a + q["length"]).alias(
                        "offset"
                    ),
                ),
            )
        ).alias("at"),
    )
    return placed.select("at.piece.*", "sequence_id", F.col("at.offset").alias("offset"))
