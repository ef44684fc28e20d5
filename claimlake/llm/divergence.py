"""How far the sources of a language differ in their words, with exact integer arithmetic.

A language keeps the terms that stand in enough of its documents. The kept terms,
sorted, become minimal acyclic transducers that map a term to its lexicographic
ordinal; every text is streamed through them to recount the terms per source; shares
of any two sources, and of a source and its language, are compared term by term.
Ordinals stand for the terms from there on and break ties: their order is the terms'.

A transducer holds the terms of one range of two-byte prefixes, some ``shard_terms``
of them, and is built in a task of its own. Transducers are shipped to the counting
tasks in groups of at most ``ship_bytes``; a vocabulary beyond that is counted in
several passes over the texts, by the same code. Pairs of sources are compared in
blocks of ``block_sources`` by ``block_sources`` by ``block_terms``.

Nulls in text, language or source read as empty; an empty text has no terms, but its
language and source occur and take part. Repeated rows count each time. A language
without kept terms gives its pairs the value 0 and no terms. An empty table gives no
rows. Equal values rank by the UTF-8 order of the item. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, broadcast_if_small, checkpointed, written

#: Letters in lower case, other ASCII as space, all other bytes as they are.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ROOT = 0
ROWS = "lang string, source string, part string, item string, value bigint, rank int"


@dataclass(frozen=True)
class DivergenceParams:
    min_documents: int = 10
    #: Added to every count, and the number that shares are scaled to.
    smoothing: int = 2
    scale: int = 1_000_000_000
    top_terms: int = 10
    shard_terms: int = 100_000
    ship_bytes: int = 48 << 20
    block_sources: int = 64
    block_terms: int = 4096
    #: Terms that a counting task holds before it hands them on.
    held_terms: int = 400_000


def terms_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and characters beyond ASCII, as UTF-8."""
    return text.translate(_LETTERS).split()


class _Builder:
    """Minimal acyclic automaton of sorted terms, grown one term at a time.

    States after the last common prefix are not yet final; when the next term leaves
    them, each is replaced by an equal state met before, if there is one.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[int, int]] = [{}]
        self.final: list[bool] = [False]
        self.seen: dict[tuple, int] = {}
        self.open: list[int] = [_ROOT]  # states along the last term
        self.last = b""

    def add(self, term: bytes) -> None:
        shared = 0
        for a, b in zip(self.last, term):
            if a != b:
                break
            shared += 1
        self._close(shared)
        for label in term[shared:]:
            self.arcs.append({})
            self.final.append(False)
            self.arcs[self.open[-1]][label] = len(self.arcs) - 1
            self.open.append(len(self.arcs) - 1)
        self.final[self.open[-1]] = True
        self.last = term

    def _close(self, length: int) -> None:
        while len(self.open) > length + 1:
            state, parent = self.open.pop(), self.open[-1]
            like = (self.final[state], tuple(self.arcs[state].items()))
            self.arcs[parent][self.last[len(self.open) - 1]] = self.seen.setdefault(like, state)

    def transducer(self) -> Transducer:
        """Arcs carry how many terms lie before the ones they lead to."""
        self._close(0)
        below: dict[int, int] = {}
        stack = [_ROOT]
        while stack:
            state = stack[-1]
            waiting = [t for t in self.arcs[state].values() if t not in below]
            if waiting:
                stack.extend(waiting)
            else:
                stack.pop()
                below[state] = self.final[state] + sum(below[t] for t in self.arcs[state].values())
        number = {state: i for i, state in enumerate(sorted(below))}
        keys, targets, skips = [], [], []
        for state in sorted(below):
            skipped = int(self.final[state])
            for label, target in self.arcs[state].items():  # ascending, as terms came sorted
                keys.append(number[state] << 8 | label)
                targets.append(number[target])
                skips.append(skipped)
                skipped += below[target]
        return Transducer(
            np.asarray(keys, "<i8"),
            np.asarray(targets, "<i4"),
            np.asarray(skips, "<i4"),
            np.asarray([self.final[s] for s in sorted(below)], "u1"),
        )


@dataclass(frozen=True)
class Transducer:
    """Maps a term to its ordinal among the sorted terms it was built from."""

    keys: np.ndarray  # state and label of every arc, ascending
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray

    @staticmethod
    def of(terms: list[bytes]) -> Transducer:
        """``terms``: ascending and distinct."""
        builder = _Builder()
        for term in terms:
            builder.add(term)
        return builder.transducer()

    def to_bytes(self) -> bytes:
        head = np.asarray([len(self.keys), len(self.final)], "<i8")
        return b"".join(a.tobytes() for a in (head, self.keys, self.targets, self.skips, self.final))

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        arcs, states = np.frombuffer(data, "<i8", 2).tolist()
        return Transducer(
            np.frombuffer(data, "<i8", arcs, 16),
            np.frombuffer(data, "<i4", arcs, 16 + 8 * arcs),
            np.frombuffer(data, "<i4", arcs, 16 + 12 * arcs),
            np.frombuffer(data, "u1", states, 16 + 16 * arcs),
        )

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 where the transducer does not accept it."""
        found = np.full(len(terms), -1, "<i8")
        if not len(self.keys):
            return found
        lengths = np.fromiter(map(len, terms), "<i8", len(terms))
        starts, letters = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(terms), "u1")
        at = np.arange(len(terms))
        state, skipped, step = np.zeros(len(at), "<i8"), np.zeros(len(at), "<i8"), 0
        while len(at):
            ended = lengths[at] == step
            accepted = ended & (self.final[state] == 1)
            found[at[accepted]] = skipped[accepted]
            at, state, skipped = at[~ended], state[~ended], skipped[~ended]
            key = state << 8 | letters[starts[at] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[arc] == key
            at, arc = at[on], arc[on]
            state, skipped, step = self.targets[arc].astype("<i8"), skipped[on] + self.skips[arc], step + 1
        return found


def _columns(batch: pa.RecordBatch) -> Iterator[list[list]]:
    for start in range(0, batch.num_rows, BATCH_ROWS):
        part = batch.slice(start, BATCH_ROWS)
        yield [part.column(i).to_pylist() for i in range(part.num_columns)]


def _document_counts(held: int):
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])

    def out(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, terms in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)), pa.array(list(terms), pa.binary()), pa.array(list(terms.values()))],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for langs, texts in _columns(batch):
                for lang, text in zip(langs, texts):
                    counts[lang].update(set(terms_of(text)))
                if sum(map(len, counts.values())) > held:
                    yield from out(counts)
                    counts.clear()
        yield from out(counts)

    return run


def kept_terms(docs: DataFrame, params: DivergenceParams) -> DataFrame:
    """lang, term, ordinal, shard and the shard's first ordinal of every kept term."""
    seen = docs.select("lang", "text").mapInArrow(
        _document_counts(params.held_terms), "lang string, term binary, n bigint"
    )
    kept = checkpointed(
        seen.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= params.min_documents)
    )
    prefixed = kept.select("lang", "term", F.substring("term", 1, 2).alias("prefix"))
    sizes = prefixed.groupBy("lang", "prefix").agg(F.count(F.lit(1)).alias("size"))
    in_order = Window.partitionBy("lang").orderBy("prefix")  # at most 65,536 prefixes
    first = sizes.withColumn("before", F.sum("size").over(in_order) - F.col("size")).withColumn(
        "shard", F.floor(F.col("before") / params.shard_terms)
    )
    base = F.min("before").over(Window.partitionBy("lang", "shard"))
    placed = first.select("lang", "prefix", "before", "shard", base.alias("base"))
    rank = F.row_number().over(Window.partitionBy("lang", "prefix").orderBy("term"))
    return prefixed.join(placed, ["lang", "prefix"]).select(
        "lang", "term", (F.col("before") + rank - 1).alias("ordinal"), "shard", "base"
    )


def transducers(kept: DataFrame) -> DataFrame:
    """One row per shard: lang, base ordinal, first term, serialized transducer."""
    schema = pa.schema(
        [("lang", pa.string()), ("base", pa.int64()), ("first", pa.binary()), ("data", pa.binary()), ("size", pa.int64())]
    )

    def build(table: pa.Table) -> pa.Table:
        terms = sorted(table.column("term").to_pylist())
        data = Transducer.of(terms).to_bytes()
        row = [[table.column("lang")[0].as_py()], [table.column("base")[0].as_py()], [terms[0]], [data], [len(data)]]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

    shards = kept.select("lang", "shard", "base", "term").groupBy("lang", "shard")
    return shards.applyInArrow(build, "lang string, base bigint, first binary, data binary, size bigint")


class Vocabulary:
    """The transducers of some shards, to number the terms of a language."""

    def __init__(self, shards: list[tuple[str, int, bytes, bytes]]):
        self.first: dict[str, list[bytes]] = defaultdict(list)
        self.shards: dict[str, list[tuple[int, Transducer]]] = defaultdict(list)
        for lang, base, first, data in sorted(shards, key=lambda s: s[:2]):
            self.first[lang].append(first[:2])
            self.shards[lang].append((base, Transducer.from_bytes(data)))

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        shards = self.shards.get(lang, [])
        found = np.full(len(terms), -1, "<i8")
        if len(shards) == 1:
            where = {0: np.arange(len(terms))}
        else:
            firsts, of_shard = self.first.get(lang, []), defaultdict(list)
            for i, term in enumerate(terms):
                of_shard[bisect.bisect_right(firsts, term[:2]) - 1].append(i)
            where = {s: np.asarray(at) for s, at in of_shard.items() if s >= 0}
        for shard, at in where.items():
            base, transducer = shards[shard]
            got = transducer.ordinals([terms[i] for i in at.tolist()])
            found[at] = np.where(got < 0, -1, got + base)
        return found


def _recount(shipped, held: int):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])

    def compact(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        ordinals, at = np.unique(np.concatenate([o for o, _ in parts]), return_inverse=True)
        sums = np.zeros(len(ordinals), "<i8")
        np.add.at(sums, at, np.concatenate([n for _, n in parts]))
        return ordinals, sums

    def out(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), parts in found.items():
            ordinals, sums = compact(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(sums)), pa.array([source] * len(sums)), pa.array(ordinals), pa.array(sums)],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, found, size = Vocabulary(shipped.value), defaultdict(list), 0
        for batch in batches:
            for langs, sources, texts in _columns(batch):
                counts: dict[tuple, Counter] = defaultdict(Counter)
                for lang, source, text in zip(langs, sources, texts):
                    counts[lang, source].update(terms_of(text))
                for (lang, source), terms in counts.items():
                    ordinals = vocabulary.ordinals(lang, list(terms))
                    here = ordinals >= 0
                    numbers = np.fromiter(terms.values(), "<i8", len(terms))
                    if here.any():
                        found[lang, source].append((ordinals[here], numbers[here]))
                        size += int(here.sum())
                if size > 4 * held:
                    found = defaultdict(list, {group: [compact(parts)] for group, parts in found.items()})
                    size = sum(len(parts[0][0]) for parts in found.values())
                    if size > 2 * held:
                        yield from out(found)
                        found, size = defaultdict(list), 0
        yield from out(found)

    return run


def recounted(docs: DataFrame, shards: DataFrame, params: DivergenceParams) -> DataFrame:
    """lang, source, ordinal, count: occurrences of every kept term, of those that occur.

    Shards are shipped in groups of at most ``ship_bytes``, or alone where one is larger.
    """
    sizes = [(r["lang"], r["base"], r["size"]) for r in shards.select("lang", "base", "size").collect()]
    groups: list[list[tuple[str, int]]] = [[]]
    room = params.ship_bytes
    for lang, base, size in sorted(sizes):
        if groups[-1] and size > room:
            groups.append([])
            room = params.ship_bytes
        groups[-1].append((lang, base))
        room -= size
    texts, counted = docs.select("lang", "source", "text"), None
    for group in groups:
        wanted = shards.select("lang", "base", "first", "data")
        if len(groups) > 1:
            names = docs.sparkSession.createDataFrame(group, "lang string, base bigint")
            wanted = wanted.join(names, ["lang", "base"], "left_semi")
        rows = [tuple(r) for r in wanted.collect()]  # at most ship_bytes
        shipped = docs.sparkSession.sparkContext.broadcast([(a, b, bytes(c), bytes(d)) for a, b, c, d in rows])
        part = texts.mapInArrow(
            _recount(shipped, params.held_terms), "lang string, source string, ordinal bigint, n bigint"
        )
        counted = part if counted is None else counted.unionByName(part)
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("count"))


def _share(count: Column, total: Column, size: Column, params: DivergenceParams) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * size)), exactly."""
    top = (count + params.smoothing).cast("decimal(19,0)") * F.lit(params.scale).cast("decimal(10,0)")
    bottom = (total + params.smoothing * size).cast("decimal(19,0)")
    return F.call_function("div", top, F.greatest(bottom, F.lit(1).cast("decimal(19,0)"))) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _compare(block_terms: int):
    """Sums of distances over one block of terms, for two blocks of sources."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, second, block = (k.as_py() for k in key[1:4])
        number, ordinal, share, size = (table.column(c).to_numpy() for c in ("number", "ordinal", "p", "size"))
        width = min(block_terms, int(size[0]) - block * block_terms)
        marks = ordinal < 0  # one per source: its share of a term that it lacks
        names = np.sort(number[marks])
        shares = np.empty((len(names), max(width, 0)), "<i8")
        shares[np.searchsorted(names, number[marks])] = share[marks][:, None]
        shares[np.searchsorted(names, number[~marks]), ordinal[~marks] - block * block_terms] = share[~marks]
        half = table.column("source_block").to_numpy()[marks][np.argsort(number[marks])]
        left, right = np.flatnonzero(half == first), np.flatnonzero(half == second)
        out: list[list] = [[], [], []]
        for i in left.tolist():
            gap, both = shares[i] - shares[right], shares[i] + shares[right]
            values = (gap * gap // both).sum(axis=1)
            for j, value in zip(right.tolist(), values.tolist()):
                if i != j:
                    pairs = [(i, j)] if first == second else [(i, j), (j, i)]
                    for a, b in pairs:
                        for column, v in zip(out, (names[a], names[b], value)):
                            column.append(int(v))
        return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in out], schema=schema)

    def keyed(key: tuple, table: pa.Table) -> pa.Table:
        got = run(key, table)
        langs = pa.array([key[0].as_py()] * got.num_rows, pa.string())
        return got.add_column(0, "lang", langs)

    return keyed


def _pairs(groups: DataFrame, counts: DataFrame, params: DivergenceParams) -> DataFrame:
    """lang, a, b, value: summed distances of any two sources of a language, by number."""
    absent = _share(F.lit(0).cast("bigint"), F.col("total"), F.col("size"), params)
    last = F.greatest(F.floor((F.col("size") - 1) / params.block_terms), F.lit(0).cast("bigint"))
    marks = groups.select(
        "lang", "number", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"),
        F.lit(-1).cast("bigint").alias("ordinal"), absent.alias("p"),
    )
    present = counts.select(
        "lang", "number", "size", F.floor(F.col("ordinal") / params.block_terms).alias("block"), "ordinal", "p"
    )
    rows = marks.unionByName(present).withColumn("source_block", F.floor((F.col("number") - 1) / params.block_sources))
    blocks = F.floor((F.col("n_sources") - 1) / params.block_sources)
    widths = groups.groupBy("lang").agg(F.max("number").alias("n_sources"))
    # the block of every row meets every block of its language, itself included
    met = rows.join(broadcast_if_small(widths, 64), "lang").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks))
    )
    keyed = met.select(
        "lang",
        F.least("source_block", "other").alias("first"),
        F.greatest("source_block", "other").alias("second"),
        "block", "number", "ordinal", "p", "size", "source_block",
    )
    parts = keyed.groupBy("lang", "first", "second", "block").applyInArrow(
        _compare(params.block_terms), "lang string, a bigint, b bigint, value bigint"
    )
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """lang, source, part, item, value, rank: other sources and telling terms per source."""
    read = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    kept = written(kept_terms(read, params), "terms")
    shards = written(transducers(kept), "transducers")
    counted = written(recounted(read, shards, params), "term-counts")

    totals = counted.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint")
    occurring = read.select("lang", "source").distinct().withColumn("number", numbered)
    groups = checkpointed(
        occurring.join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .na.fill(0, ["total", "size"])
    )
    counts = counted.join(broadcast_if_small(groups, 256), ["lang", "source"]).withColumn(
        "p", _share(F.col("count"), F.col("total"), F.col("size"), params)
    )

    compared = _pairs(groups, counts, params)
    names = groups.select("lang", "number", "source")
    named = compared.join(names.withColumnsRenamed({"number": "a"}), ["lang", "a"]).join(
        names.withColumnsRenamed({"number": "b", "source": "item"}), ["lang", "b"]
    )
    by_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = named.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_source).alias("rank")
    )

    whole = counted.groupBy("lang", "ordinal").agg(F.sum("count").alias("count"))
    per_lang = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("size").alias("v"))
    languages = whole.join(broadcast_if_small(per_lang, 64), "lang").select(
        "lang", "ordinal", _share(F.col("count"), F.col("all"), F.col("v"), params).alias("q")
    )
    above = counts.join(languages, ["lang", "ordinal"]).where(F.col("p") > F.col("q"))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = (
        above.select("lang", "source", "ordinal", _distance(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_ordinal))
        .where(F.col("rank") <= params.top_terms)
    )
    terms = best.join(kept.select("lang", "ordinal", F.col("term").cast("string").alias("item")), ["lang", "ordinal"])
    found = pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return found.select("lang", "source", "part", "item", F.col("value").cast("bigint").alias("value"), "rank")
