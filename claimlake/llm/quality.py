"""Line-first cleaning: rules per line, then a verdict on what is left.

Every line with a word is tested for punctuation, navigation and boilerplate;
lines that fail are removed. A boilerplate phrase fails a short line, and a longer
one of which the phrases are a fair share; prose that mentions one stays. A document is rejected when its base measures fail
or when too little of its text is left.

A null text has no words and is rejected; a row with a null id is judged like any
other, and repeated rows each get the same verdict. A document at a limit
passes. An empty table gives no rows. Whole texts are read, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimlake.llm.common import BATCH_ROWS

# Phrases that mark a line as site boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "privacy policy",
    "cookie policy",
    "terms of use",
    "terms of service",
    "accept cookies",
    "enable javascript",
    "click here",
    "sign up for",
    "subscribe to our",
    "share this",
    "lorem ipsum",
    "licensed under",
)
SYMBOLS = "#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_MENU = re.compile(r" [|»›·>] ")
_SHOUT = re.compile(r"[!?]{2,}(?=[ \t]|$)")


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_percent: int = 20
    #: A line fails beyond this many symbols a word,
    max_symbols_per_word: float = 0.34
    #: or when more than this share of its words end in runs of ! or ?,
    max_shouted: float = 0.34
    #: or when it has this many menu separators,
    menu_separators: int = 3
    #: or when more than this share of its words repeat the word before.
    max_stuttered: float = 0.34
    #: A line with a boilerplate phrase fails up to this many characters,
    short_line: int = 100
    #: or when its phrases are more than this share of them.
    max_phrase_share: float = 0.2
    #: A document must keep this share of the characters of its words.
    min_kept_share: float = 0.5


def line_fault(line: str, params: QualityParams) -> str | None:
    """The first rule that a line with a word fails: punctuation, navigation or boilerplate."""
    words = line.split()
    n = len(words)
    if sum(map(line.count, SYMBOLS)) > params.max_symbols_per_word * n or (
        n > 2 and len(_SHOUT.findall(line)) > params.max_shouted * n
    ):
        return "navigation" if len(_MENU.findall(line)) >= params.menu_separators else "punctuation"
    if ("|" in line or "»" in line or "›" in line) and len(_MENU.findall(line)) >= params.menu_separators:
        return "navigation"
    low = line.lower()
    phrase_chars = sum(len(phrase) * low.count(phrase) for phrase in BOILERPLATE if phrase in low)
    if phrase_chars:
        n_chars = len(" ".join(words))
        if n_chars <= params.short_line or phrase_chars > params.max_phrase_share * n_chars:
            return "boilerplate"
    stuttered = n > 5 and sum(map(eq, words, words[1:])) > params.max_stuttered * n
    return "boilerplate" if stuttered else None


def repeated_words(words: Sequence[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that the text has more than once."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for window in windows:
        (twice if window in seen else seen).add(window)
    n, covered = 0, 0
    for i, window in enumerate(windows):
        if window in twice:
            n += i + width - max(i, covered)
            covered = i + width
    return n


def judge(text: str | None, params: QualityParams) -> tuple:
    """Base measures, the verdict and the cleaned text of one document."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    with_word = [line for line in lines if line.encode("utf-8", "surrogatepass").strip(_SPACE)]
    n_dup = len(with_word) - len(set(with_word))
    n_repeat = repeated_words(words)
    failed = n_words < params.min_words or 100 * n_repeat > params.max_repeat_percent * n_words
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    left, verdicts = [], {}
    for line in lines:
        if line not in verdicts:
            empty = not line.encode("utf-8", "surrogatepass").strip(_SPACE)
            verdicts[line] = None if empty else line_fault(line, params)
        if verdicts[line]:
            faults[verdicts[line]] += 1
        else:
            left.append(line)
    clean = "\n".join(left)
    left_chars = len(clean) - sum(map(clean.count, " \t\n\v\f\r"))
    lost = left_chars < params.min_kept_share * word_chars
    return (
        *(n_words, word_chars, n_symbols, n_dup, n_repeat, failed, not (failed or lost), len(with_word)),
        *(*faults.values(), left_chars, clean),
    )


MEASURES = (
    *[(n, "long") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    *[("base_failed", "boolean"), ("kept", "boolean"), ("n_lines", "long")],
    *[(f"n_{n}", "long") for n in ("punctuation", "navigation", "boilerplate")],
    *[("left_chars", "long"), ("clean_text", "string")],
)
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def judged(
    docs: DataFrame,
    params: QualityParams = QualityParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """The id, the columns to carry, and ``MEASURES`` for every row of ``docs``."""
    names = [id_column, *carry]
    clash = set(names) & {n for n, _ in MEASURES}
    if clash:
        raise ValueError(f"rename before judging: {sorted(clash)}")
    source = docs.select(*names, F.col(text_column).cast("string").alias("judged_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                rows = list(zip(*(judge(t, params) for t in part.column(len(names)).to_pylist())))
                made = [pa.array(values, _ARROW[kind]) for values, (_, kind) in zip(rows, MEASURES)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(names))), *made], names=[*names, *(n for n, _ in MEASURES)]
                )

    schema = StructType([*source.drop("judged_text").schema])
    for name, kind in MEASURES:
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)
