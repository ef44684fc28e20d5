"""Personal data in texts: fixed kinds first, then what their contexts reveal.

Base identifiers (email, ip, card, phone) are found by regular expressions and
checked. They seed a bootstrap: the two tokens before an identifier are a pattern, a
token being a word or a single character that is neither part of a word nor white
space, so that ``me at``, ``tel:`` and ``mail <`` are patterns alike. Patterns and the
identifier-like strings behind them form a graph. In each round the confidence of a
pattern for a kind is the weight of its known instances over all places of the corpus
where its two tokens occur; an unknown instance behind a pattern that reaches
``min_confidence``, with ``min_support`` distinct instances, is learnt with the kind
and the confidence of its best pattern. Rounds go on until nothing new is learnt;
learnt instances keep their scores, so there are at most as many rounds as links in
the longest chain. Learnt instances behind confident patterns are reported.

Identifier-like is a run of words and joining signs, or of short groups of digits
with single spaces, that holds an ``@`` or five digits, whatever its length. It starts
at most ``LEADING_PARTS`` letter-only parts before its first digit or ``@``; what is
before is context. An identifier glued to a word has no context.

Everything is DataFrame expressions. Positions are running sums of the lengths of
gaps and matches, in blocks, and contexts come from the gaps, so that a text costs
time in proportion to its length, however many matches it has. The regular
expressions are written without backtracking, so runs of any length take linear time.
Counts combine in the map tasks before they are shuffled; found spans are broadcast
only if their counted rows are small. The corpus is read twice, whole: once for
spans, once to count the patterns.

A null text is empty and has no spans. Null ids are carried, repeated rows each
get their row and count in the statistics like any other. Of overlapping matches
of a kind the left one stands; of equally confident kinds the first listed. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import bit_array, bit_is_set, broadcast_if_small, checkpointed, text_key, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # shorter chains can hold no 12 digits
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind cannot occur.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
_WORD, _JOIN = r"[\p{L}\p{N}]", r"[@._%+/#()-]"
#: Parts without a digit with which an identifier-like string may start.
LEADING_PARTS = 8
#: Strings that may be identifiers of a form the kinds do not have.
CANDIDATE = (
    rf"(?<![\p{{L}}\p{{N}}@])(?:\(?[0-9]{{2,4}}+\)?+(?:[\x20.-][0-9]{{2,4}}+(?!{_WORD})){{2,}}+"
    rf"|\(?(?=(?:\p{{L}}++[._%+/#()-]++){{0,{LEADING_PARTS}}}+\p{{L}}*+[0-9@])"
    rf"{_WORD}++(?:(?:\)\x20(?=[0-9])|{_JOIN}++){_WORD}++)*+)"
)
#: What every text with such a string contains: an ``@``, five digits in a row or two groups of digits in one run.
CANDIDATE_NEEDS = r"[0-9@](?:(?<=@)|[0-9]{4}|[^\s0-9]++[0-9]|[^\s0-9]*+\x20\(?[0-9])"
#: Tokens of a context.
TOKEN = rf"{_WORD}++|[^\p{{L}}\p{{N}}\s]"
SIGN, WHITE = r"([^a-z0-9\s\p{L}\p{N}])", r"[ \t\n\x0B\f\r]+"
#: The last two tokens of a text that is read backwards and does not start inside a word.
LAST_TOKENS = rf"^(?!{_WORD})\s*+((?:{TOKEN})\s*+(?:{TOKEN}))"
SPAN = "struct<start:int,kind:int,end:int>"
MENTION = "struct<start:int,kind:int,end:int,instance:string,pattern:bigint>"
#: Least and most bits of the map of patterns that pairs of tokens are tried on before they are counted.
MAP_BITS, MOST_MAP_BITS = 1 << 20, 1 << 26
#: Values that a running sum copies at once.
BLOCK = 256


@dataclass(frozen=True)
class BootstrapParams:
    min_support: int = 3
    min_confidence: float = 0.5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once though lambdas in ``body`` use it often."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column, combine: Callable[[Column, Column], Column], first: int) -> Column:
    """All partial results of combining an array of ints from the left, in blocks."""

    def last(block: Column) -> Column:
        return F.coalesce(F.get(block, F.size(block) - 1), F.lit(first))

    def within(block: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(block, none, lambda done, v: F.concat(done, F.array(combine(last(done), v))))

    def joined(blocks: Column) -> Column:
        def carried(totals: Column) -> Column:
            return F.transform(blocks, lambda block, i: F.transform(block, lambda v: combine(F.get(totals, i), v)))

        return F.flatten(_let(F.concat(F.array(F.lit(first)), within(F.transform(blocks, last))), carried))

    def in_blocks(all_values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_values), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda at: within(F.slice(all_values, at, F.lit(BLOCK))))

    return _let(values, lambda v: _let(in_blocks(v), joined))


def _tokens(text: Column) -> Column:
    """The lower-cased words and single other characters of a text, in order."""
    # setting signs apart and splitting takes less than half the time of extracting every token
    apart = F.regexp_replace(F.lower(text), SIGN, " $1 ")
    return F.filter(F.split(apart, WHITE), lambda w: w != "")


def _pattern(before: Column) -> Column:
    """The pattern that a text ends with: a key of its last two tokens, or null."""
    tail = F.reverse(F.regexp_extract(F.reverse(before), LAST_TOKENS, 1))
    return _let(
        _tokens(tail),
        lambda t: F.when(F.size(t) >= 2, F.xxhash64(F.get(t, F.size(t) - 2), F.get(t, F.size(t) - 1))),
    )


def _found(text: Column, pattern: str, kind: Column, keep: Callable[[Column], Column]) -> Column:
    """Every match that ``keep`` takes, with its place in code points, instance and pattern."""

    def described(pieces: Column, ends: Column) -> Column:
        gaps, matches = pieces["gaps"], pieces["matches"]

        def piece(array: Column, i: Column) -> Column:
            return F.coalesce(F.get(array, i), F.lit(""))

        def mention(m: Column) -> Column:
            i, match = m["i"], m["match"]
            # two matches hold two tokens at least
            before = F.concat(piece(matches, i - 2), piece(gaps, i - 1), piece(matches, i - 1), piece(gaps, i))
            return F.struct(
                (m["end"] - F.char_length(match)).alias("start"),
                kind.cast("int").alias("kind"),
                m["end"].alias("end"),
                _instance(match).alias("instance"),
                _pattern(before).alias("pattern"),
            )

        numbered = F.transform(
            matches, lambda m, i: F.struct(F.get(ends, i).alias("end"), m.alias("match"), i.alias("i"))
        )
        return F.transform(F.filter(numbered, lambda m: keep(m["match"])), mention)

    def placed(pieces: Column) -> Column:
        lengths = F.transform(
            pieces["matches"], lambda m, i: F.char_length(F.get(pieces["gaps"], i)) + F.char_length(m)
        )
        return _let(_running(lengths, Column.__add__, 0), lambda ends: described(pieces, ends))

    pieces = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches")
    )
    return F.when(F.rlike(text, F.lit(pattern)), _let(pieces, placed)).otherwise(F.array().cast(f"array<{MENTION}>"))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(digit: Column, i: Column) -> Column:
        value = digit.cast("int") * (1 + i % 2)
        return F.when(value > 9, value - 9).otherwise(value)

    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), worth)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.char_length(digits).between(12, 19) & _luhn(digits)
    return F.char_length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def _seeds(text: Column) -> Column:
    """Checked identifiers of all kinds, by start, then kind."""
    found = []
    for number, kind in enumerate(KINDS):
        spans = _found(text, PATTERNS[kind], F.lit(number), partial(_valid, kind))
        if kind in NEEDED:
            spans = F.when(F.contains(text, F.lit(NEEDED[kind])), spans).otherwise(F.array().cast(f"array<{MENTION}>"))
        found.append(spans)
    return F.sort_array(F.concat(*found))


def _candidates(text: Column) -> Column:
    """Identifier-like strings, by start; their kind is null."""

    def like(match: Column) -> Column:
        return F.contains(match, F.lit("@")) | (F.char_length(_digits(match)) >= 5)

    found = _found(text, CANDIDATE, F.lit(None), like)
    return F.when(F.rlike(text, F.lit(CANDIDATE_NEEDS)), found).otherwise(F.array().cast(f"array<{MENTION}>"))


def _apart(candidates: Column, seeds: Column) -> Column:
    """The candidates that overlap no seed; one pass over both in order of their starts."""

    far = 2**31 - 1

    def item(is_seed: bool) -> Callable[[Column], Column]:
        return lambda m: F.struct(m["start"].alias("start"), F.lit(not is_seed).alias("candidate"), m.alias("m"))

    def unmet(items: Column, ends: Column, nexts: Column) -> Column:
        met = F.transform(
            items,
            lambda x, i: F.when(
                x["candidate"] & (F.get(ends, i) <= x["start"]) & (F.get(nexts, i) >= x["m"]["end"]), x["m"]
            ),
        )
        return F.filter(met, lambda m: m.isNotNull())

    def one_pass(items: Column) -> Column:
        ends = F.transform(items, lambda x: F.when(x["candidate"], 0).otherwise(x["m"]["end"]))
        starts = F.transform(items, lambda x: F.when(x["candidate"], far).otherwise(x["start"]))
        nexts = F.reverse(_running(F.reverse(starts), F.least, far))
        return _let(_running(ends, F.greatest, 0), lambda e: _let(nexts, lambda n: unmet(items, e, n)))

    both = F.sort_array(F.concat(F.transform(seeds, item(True)), F.transform(candidates, item(False))))
    nothing_meets = (F.size(seeds) == 0) | (F.size(candidates) == 0)
    return F.when(nothing_meets, candidates).otherwise(_let(both, one_pass))


def _instance(match: Column) -> Column:
    return F.regexp_replace(F.lower(match), r"[^\p{L}\p{N}@.]", "")


def scanned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, text key, base spans, and mentions with patterns."""
    source = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("t"))
    found = source.select(
        "id", *text_key(F.col("t")), _seeds(F.col("t")).alias("seeds"), _candidates(F.col("t")).alias("candidates")
    )
    base = F.transform("seeds", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    mentions = F.concat("seeds", _apart(F.col("candidates"), F.col("seeds")))
    return found.select(
        "id", "k1", "k2", base.alias("base"), F.filter(mentions, lambda m: m["pattern"].isNotNull()).alias("mentions")
    )


def pattern_counts(docs: DataFrame, patterns: DataFrame, text_column: str) -> DataFrame:
    """(pattern, n_places): how often the two tokens of each pattern follow one another in all texts."""
    tokens = docs.select(_tokens(text_or_empty(text_column)).alias("tokens"))
    pairs = F.transform(
        F.when(F.size("tokens") > 1, F.sequence(F.lit(0), F.size("tokens") - 2)),
        lambda i: F.xxhash64(F.get("tokens", i), F.get("tokens", i + 1)),
    )
    n_bits = min(max(MAP_BITS, 1 << (16 * patterns.count()).bit_length()), MOST_MAP_BITS)
    place = F.pmod("pattern", F.lit(n_bits).cast("bigint"))
    bits = checkpointed(bit_array(patterns.select(place.alias("p")), n_bits // 64)).scalar()
    # the map of patterns lets few other pairs through, so little is counted and shuffled for nothing
    places = tokens.select(F.explode(pairs).alias("pattern")).where(bit_is_set(bits, place))
    return places.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_places")).join(patterns, "pattern")


def discovered(docs: DataFrame, found: DataFrame, params: BootstrapParams, text_column: str) -> DataFrame:
    """(k1, k2, extra): per text, the spans that confident patterns reveal."""
    mentions = found.select("k1", "k2", F.explode("mentions").alias("m")).select("k1", "k2", "m.*")
    edges = mentions.groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n"))
    support = edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("support"))
    patterns = checkpointed(support.where(F.col("support") >= params.min_support).select("pattern"))
    counted = checkpointed(pattern_counts(docs, patterns, text_column))
    edges = checkpointed(edges.join(counted, "pattern"))
    scores = checkpointed(
        edges.where("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    )
    unknown = edges.where("kind IS NULL").drop("kind")
    while True:
        weights = edges.drop("kind").join(scores, "instance").groupBy("pattern", "kind", "n_places")
        share = F.least(F.lit(1.0), F.sum(F.col("n") * F.col("score")) / F.col("n_places"))
        confident = checkpointed(
            weights.agg(F.round(share, 6).alias("confidence")).where(F.col("confidence") >= params.min_confidence)
        )
        best = (
            unknown.join(scores, "instance", "left_anti")
            .join(confident, ["pattern", "n_places"])
            .groupBy("instance")
            .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("first_kind"))).alias("best"))
        )
        learnt = checkpointed(
            best.select("instance", (-F.col("best.first_kind")).alias("kind"), F.col("best.confidence").alias("score"))
        )
        if learnt.isEmpty():
            break
        scores = checkpointed(scores.unionByName(learnt))
    kinds = scores.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    kinds = kinds.select("instance", (-F.col("best.k")).alias("kind"))
    behind = mentions.where("kind IS NULL").drop("kind").join(confident.select("pattern", "kind"), "pattern")
    spans = behind.join(kinds, ["instance", "kind"])
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "kind", "end")).alias("extra"))


def n_of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_personal_data(
    docs: DataFrame,
    params: BootstrapParams = BootstrapParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The id, ``base`` and ``spans`` (start, kind number, end) of every row of ``docs``."""
    found = written(scanned(docs, id_column, text_column), "personal-data")
    extra = checkpointed(discovered(docs, found, params, text_column))
    joined = found.join(broadcast_if_small(extra, 64, 32 * F.size("extra")), ["k1", "k2"], "left")
    spans = F.sort_array(F.concat("base", F.coalesce("extra", F.slice("base", 1, 0))))
    return joined.select(F.col("id").alias(id_column), "base", spans.alias("spans"))
