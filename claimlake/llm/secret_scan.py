"""Secrets in texts: a keyword automaton, regular expressions at its hits, checksums.

One Aho-Corasick automaton over all keywords passes each text once. Only where
a keyword begins is the expression of its kind tried, anchored there; tokens that
carry a checksum are reported only if it holds. Long hexadecimal runs have no
keyword, so the text is reduced to a map of such characters and searched for
runs of the wanted length.

Null texts are empty. A row with a null id is searched like any other; repeated
rows are each reported. Of two matches of a kind that overlap, the one further left
stands. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, text_or_empty

BASE_KINDS = ("assign", "access", "hex")
# Kinds beyond the base ones, in the order of their spans.
CHECKED_KINDS = ("crc_token", "extended_key")
_ORDER = {kind: i for i, kind in enumerate(BASE_KINDS + CHECKED_KINDS)}
# Keywords in lower case, by the kind that begins with them.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "crc_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "extended_key": ("xprv",),
}
PATTERNS = {
    "assign": re.compile(
        rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "crc_token": re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "extended_key": re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
}
HEX_RUN = 32
_HEX_MAP = bytes(49 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc_token_holds(body: bytes, tail: bytes) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value = 0
    for c in tail.decode():
        value = value * 62 + _BASE62.index(c)
    return value == zlib.crc32(body)


def base58_check_holds(text: bytes) -> bool:
    """The last four bytes are the start of the doubled SHA-256 of the others."""
    value = 0
    for c in text.decode():
        value = value * 58 + _BASE58.index(c)
    raw = value.to_bytes(82, "big") if value < 1 << 656 else b""
    return bool(raw) and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _accepted(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 8
    if kind == "access":
        return len(match[0]) >= 16
    return crc_token_holds(match[1], match[2]) if kind == "crc_token" else base58_check_holds(match[0])


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points, by start, then kind."""
        data = text.encode("utf-8", "surrogatepass")
        starts: dict[str, list[int]] = {}
        for end, (kind, length) in self.automaton.iter(data.lower().decode("latin-1")):
            starts.setdefault(kind, []).append(end + 1 - length)
        found = []
        for kind, places in starts.items():
            pattern, done = PATTERNS[kind], 0
            for place in sorted(places):
                if place >= done and (match := pattern.match(data, place)):
                    done = match.end()
                    if _accepted(kind, match):
                        found.append((place, done, kind))
        hexes = data.translate(_HEX_MAP)
        at = hexes.find(b"1" * HEX_RUN)
        while at >= 0:
            end = hexes.find(b" ", at)
            end = len(hexes) if end < 0 else end
            found.append((at, end, "hex"))
            at = hexes.find(b"1" * HEX_RUN, end)
        if len(data) != len(text):
            found = self._code_points(data, found)
        return sorted(found, key=lambda s: (s[0], _ORDER[s[2]], s[1]))

    @staticmethod
    def _code_points(data: bytes, found: list) -> list:
        places, before, points = sorted({p for s in found for p in s[:2]}), 0, {}
        at = 0
        for place in places:
            before += len(data[at:place].decode("utf-8", "surrogatepass"))
            at, points[place] = place, before
        return [(points[a], points[b], kind) for a, b, kind in found]


@cache
def scanner() -> Scanner:
    """One per Python worker."""
    return Scanner()


COLUMNS = "n_assign long, n_access long, n_hex long, n_checked long, base_spans string, spans string"


def _joined(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _row(text: str) -> tuple:
    spans = scanner().spans(text)
    base = [s for s in spans if s[2] in BASE_KINDS]
    counts = [sum(s[2] == kind for s in base) for kind in BASE_KINDS]
    return (*counts, len(spans) - len(base), _joined(base), _joined(spans))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts per base kind, validated tokens, and the spans of every row of ``docs``."""
    source = docs.select(id_column, text_or_empty(text_column).alias("searched"))
    names = [id_column, *(c.split()[0] for c in COLUMNS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                columns = list(zip(*map(_row, part.column(1).to_pylist())))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                made = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=names)

    schema = source.select(id_column).schema
    for column in COLUMNS.split(", "):
        schema = schema.add(*column.split())
    return source.mapInArrow(run, schema)
