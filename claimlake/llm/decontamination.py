"""Contamination of documents by benchmark items, found by winnowing.

Words are lower-cased runs of letters and digits. Of every ``span - gram + 1``
consecutive word grams the smallest hash is a fingerprint, so any run of
``span`` words that a document shares with an item shares a fingerprint too.
Fingerprints of both sides are joined, and each hit is extended over the whole text:
all its windows of ``span`` words that are windows of the item are hit. An item of fewer
words is one window; it is looked up whole, wherever its first word occurs.

Hashes only propose pairs of text and item; words decide. There is one row for a pair,
however often the item occurs in the text, and overlapping windows become one span. Work is keyed by the text, so copies are
looked up once. Fingerprints of items and hits of texts are broadcast where their
counted rows are small and shuffled otherwise; hot fingerprints stay rows that
AQE can split, and nothing is gathered but the spans of one text.

A null or empty text has no words and is clean; an item without words has no
windows, one without an id counts under an empty id. Null document ids are
carried and repeated rows each get their row. A document whose hit words are
exactly the limiting share counts as contaminated. Empty tables are allowed on
either side; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import broadcast_if_small, checkpointed, text_key, text_or_empty, words_of

#: A fingerprint is 33 bits of hash and 31 bits of position in one long.
PLACE_BITS = 31
#: Bits of the fixed-size map of first words of short items.
MAP_BITS = 1 << 12


@dataclass(frozen=True)
class DecontaminationParams:
    span: int = 13
    gram: int = 8
    #: Contaminated from one hit word in so many.
    words_per_hit: int = 20


def _at(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hashed, PLACE_BITS), PLACE_BITS).bitwiseOR(place.cast("bigint"))


def _upto(last: Column) -> Column:
    """0, 1, ..., last; empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _grams(words: Column, params: DecontaminationParams) -> Column:
    places = _upto(F.size(words) - params.gram)
    return F.transform(places, lambda i: _at(F.xxhash64(F.slice(words, i + 1, params.gram)), i))


def _winnowed(grams: Column, params: DecontaminationParams) -> Column:
    width = params.span - params.gram + 1
    return F.array_distinct(
        F.transform(_upto(F.size(grams) - width), lambda i: F.array_min(F.slice(grams, i + 1, width)))
    )


def _map_bit(word: Column) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(word), F.lit(MAP_BITS)).cast("int")
    return F.shiftright(place, 6), place.bitwiseAND(63)


def _short_items(items: DataFrame, params: DecontaminationParams) -> DataFrame:
    """One row: the word counts of items under ``span`` words, and a bit map of their first words."""
    words = items.sparkSession.range(MAP_BITS // 64).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"), F.lit(None).cast("int").alias("n")
    )
    word, bit = _map_bit(F.get("words", F.lit(0)))
    short = items.where(F.size("words") < params.span).select(
        word.alias("word"), F.lit(1).cast("bigint").alias("one"), bit.alias("bit"), F.size("words").alias("n")
    )
    short = short.select("word", F.expr("shiftleft(one, bit)").alias("bits"), "n")
    by_word = short.unionByName(words).groupBy("word").agg(F.bit_or("bits").alias("bits"), F.collect_set("n").alias("ns"))
    return by_word.agg(
        F.struct(
            F.array_distinct(F.flatten(F.collect_list("ns"))).alias("counts"),
            F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda s: s["bits"]).alias("bits"),
        ).alias("short")
    )


def _short_grams(words: Column, short: Column) -> Column:
    """Hashes of all runs as long as a short item, from places where one may begin."""
    counts, bits = short["counts"], short["bits"]

    def may_begin(i: Column) -> Column:
        word, bit = _map_bit(F.get(words, i))
        return F.getbit(F.get(bits, word), bit) == 1

    def runs(i: Column) -> Column:
        fitting = F.filter(counts, lambda n: i + n <= F.size(words))
        return F.transform(fitting, lambda n: _at(F.xxhash64(F.slice(words, i + 1, n)), i))

    places = F.filter(_upto(F.size(words) - 1), may_begin)
    return F.when(F.size(counts) > 0, F.flatten(F.transform(places, runs))).otherwise(F.array().cast("array<bigint>"))


def _item_rows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    plain = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), text_or_empty(text).alias("t"))
    worded = plain.select("item", words_of(F.col("t")).alias("words")).where(F.size("words") > 0)
    return worded.groupBy("item", "words").agg(F.lit(1).alias("one")).select(
        "item", F.xxhash64("item", "words").alias("item_key"), "words"
    )


def _seeds(docs: DataFrame, items: DataFrame, params: DecontaminationParams) -> DataFrame:
    """Distinct (k1, k2, item_key): texts in which an item, or a part of it, may lie.

    A fingerprint that a text or an item holds many times counts once, so a text that
    repeats itself is not a row per place.
    """
    width = params.span
    grams = items.withColumn("grams", _grams(F.col("words"), params))
    whole = F.array(_at(F.xxhash64("words"), F.lit(0)))
    prints = F.when(F.size("words") < width, whole).otherwise(_winnowed(F.col("grams"), params))
    item_prints = checkpointed(
        grams.select("item_key", F.explode(prints).alias("p"))
        .select("item_key", F.shiftright("p", PLACE_BITS).alias("hash"))
        .distinct()
    )
    short = checkpointed(_short_items(items, params))
    texts = docs.select(*text_key(F.col("t")), words_of(F.col("t")).alias("words"))
    texts = texts.select(
        "k1", "k2", "words", short.scalar().alias("short"), F.when(F.size("words") >= width, _grams(F.col("words"), params)).alias("grams")
    )
    both = F.concat(
        F.coalesce(_winnowed(F.col("grams"), params), F.array().cast("array<bigint>")),
        _short_grams(F.col("words"), F.col("short")),
    )
    hashes = F.array_distinct(F.transform(both, lambda p: F.shiftright(p, PLACE_BITS)))
    met = texts.select("k1", "k2", F.explode(hashes).alias("hash")).join(broadcast_if_small(item_prints, 40), "hash")
    return met.select("k1", "k2", "item_key").distinct()


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(words: Column, width: Column) -> Column:
    return F.transform(_upto(F.size(words) - width), lambda i: F.array_join(F.slice(words, i + 1, width), " "))


def _spans(words: Column, item: Column, need: Column) -> Column:
    """(start, end) in words of a text of the runs that windows of ``need`` words of the item cover."""

    def at(both: Column) -> Column:
        """Where a window of the text is one of the item."""
        return F.filter(
            _upto(F.size(both["windows"]) - 1), lambda i: F.array_contains(both["shared"], F.get(both["windows"], i))
        )

    def runs(starts: Column) -> Column:
        # windows that overlap or touch are one run
        first = F.filter(starts, lambda p, i: (i == 0) | (p > F.get(starts, i - 1) + need))
        last = F.filter(starts, lambda p, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > p + need))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + need).alias("end")))

    both = _bound(
        _windows(words, need),
        lambda windows: F.struct(windows.alias("windows"), F.array_intersect(_windows(item, need), windows).alias("shared")),
    )
    return _bound(_bound(both, at), runs)


def _covered(spans: Column) -> Column:
    """Words under the spans, each counted once."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def hits(docs: DataFrame, items: DataFrame, params: DecontaminationParams) -> DataFrame:
    """One row per distinct hit text: its key, hit words, and item ids sorted as strings."""
    seeds = checkpointed(_seeds(docs, items, params))
    # the columns of the text are computed after the join, for texts with seeds only
    found = docs.select(*text_key(F.col("t")), "t").join(broadcast_if_small(seeds, 64), ["k1", "k2"])
    found = found.select("k1", "k2", "item_key", words_of(F.col("t")).alias("words"))
    lengths = items.select("item_key", "item", F.col("words").alias("item_words"))
    spanned = found.join(lengths, "item_key").select(
        "k1",
        "k2",
        "item",
        F.explode(
            _spans(
                F.col("words"),
                F.col("item_words"),
                F.least(F.lit(params.span), F.size("item_words")),
            )
        ).alias("span"),
    )
    return (
        spanned.groupBy("k1", "k2")
        .agg(F.collect_set("span").alias("spans"), F.collect_set("item").alias("found_items"))
        .select("k1", "k2", _covered(F.col("spans")).alias("n_hit"), F.array_sort("found_items").alias("item_ids"))
    )


def judged(
    docs: DataFrame,
    items: DataFrame,
    params: DecontaminationParams = DecontaminationParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The id, carried columns, ``n_words``, ``n_hit``, ``item_ids`` and ``contaminated`` of every row."""
    texts = docs.select(text_or_empty(text_column).alias("t"))
    found = checkpointed(hits(texts, checkpointed(_item_rows(items, item_column, item_text_column)), params))
    names = list(dict.fromkeys((id_column, *carry)))
    text = text_or_empty(text_column)
    counted = docs.select(*names, *text_key(text), F.size(words_of(text)).cast("bigint").alias("n_words"))
    joined = counted.join(broadcast_if_small(found, 64, F.octet_length(F.array_join("item_ids", ",")) + 16 * F.size("item_ids")), ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        *names,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (params.words_per_hit * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
