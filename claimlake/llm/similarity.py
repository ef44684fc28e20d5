"""Jaccard join of documents on word shingles, with Bayesian pruning of candidates.

A document is the set of its ``shingle``-word shingles (all its words, if it has
fewer). Documents with equal sets are one class. Classes that agree on all values
of one of ``bands`` bands of MinHash values are candidates; with 40 bands of 6
values a pair at similarity 0.8 is missed with probability below 1e-5. Candidates
are compared on further MinHash values, ``step`` at a time: with m of n equal, the
similarity has a Beta(m + 1, n - m + 1) posterior, and the pair is dropped when its
probability of reaching the threshold falls below ``tolerance``. All other pairs
are verified on their whole shingle sets.

Buckets of at most ``small_bucket`` classes give their pairs as rows. Larger ones,
as large groups of near copies make, are joined to components and dealt out as
pairs of blocks of about ``block`` classes; a task compares two blocks as matrices and
returns only counts and the edges of a spanning forest, so the links of a hot group
are all counted, but never written as pairs.

Documents without words have no shingles and link to nothing, each a class of its
own. Null ids are carried; repeated rows and copies are linked through their class;
a similarity equal to the threshold is a link. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import (
    BATCH_ROWS,
    broadcast_if_small,
    checkpointed,
    in_few_tasks,
    text_key,
    text_or_empty,
    word_bytes,
    written,
)
from claimlake.llm.components import components


@dataclass(frozen=True)
class SimilarityParams:
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 40
    rows: int = 6
    #: MinHash values kept for pruning, and how many are compared at a time.
    values: int = 128
    step: int = 16
    tolerance: float = 1e-8
    small_bucket: int = 32
    block: int = 512
    #: Words whose hashes a task remembers before it starts afresh.
    cached_words: int = 150_000

    @property
    def permille(self) -> int:
        return round(1000 * self.threshold)


class Shingler:
    """64-bit hashes of the distinct shingles of a text, sorted."""

    def __init__(self, width: int, limit: int):
        self.width, self.limit, self.known = width, limit, {}
        self.factors = np.random.default_rng(20_240_501).integers(1, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        import xxhash

        words = word_bytes(text)
        if not words:
            return np.empty(0, np.uint64)
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
            missing = set(words)
        for word in missing:
            self.known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            mixed += hashes[i : i + len(mixed)] * self.factors[i]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


class MinHasher:
    def __init__(self, params: SimilarityParams):
        n = params.bands * params.rows
        draw = np.random.default_rng(7_919)
        self.factors = (draw.integers(0, 1 << 31, (n, 1), dtype=np.uint32) * np.uint32(2)) + np.uint32(1)
        self.shifts = draw.integers(0, 1 << 32, (n, 1), dtype=np.uint32)
        self.mix = draw.integers(0, 1 << 63, params.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.params = params

    def __call__(self, shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The values for pruning, 16 bits each, and one 64-bit key per band."""
        least = None
        points = (shingles >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(points), 1024):
            values = (self.factors * points[at : at + 1024] + self.shifts).min(axis=1)
            least = values if least is None else np.minimum(least, values)
        p = self.params
        keys = (least.reshape(p.bands, p.rows).astype(np.uint64) * self.mix).sum(axis=1, dtype=np.uint64)
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.arange(p.bands, dtype=np.uint64)
        return (least[: p.values] >> np.uint32(16)).astype("<u2").tobytes(), keys.view(np.int64)


@cache
def hasher_of(params: SimilarityParams) -> MinHasher:
    return MinHasher(params)


@cache
def least_matches(params: SimilarityParams) -> dict[int, int]:
    """After n values, the fewest equal ones with which a pair may still reach the threshold.

    The posterior of reaching t with m of n equal is P(Bin(n + 1, t) <= m).
    """
    found = {}
    for n in range(params.step, params.values + 1, params.step):
        tail, t = 0.0, params.threshold
        for m in range(n + 1):
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= params.tolerance:
                found[n] = m
                break
    return found


def prune(left: np.ndarray, right: np.ndarray, params: SimilarityParams) -> np.ndarray:
    """Numbers of the row pairs of two value matrices that survive."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), np.int32)
    for n, least in least_matches(params).items():
        part = slice(n - params.step, n)
        equal = equal + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = equal >= least
        alive, equal = alive[keep], equal[keep]
    return alive


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def sketches(docs: DataFrame, params: SimilarityParams, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, text key, digest of its shingle set, values and band keys."""
    text = text_or_empty(text_column)
    source = docs.select(F.col(id_column).alias("id"), *text_key(text), text.alias("t"))
    kinds = (pa.binary(), pa.binary(), pa.list_(pa.int64()))

    def row(shingler: Shingler, text: str) -> tuple:
        shingles = shingler(text)
        if not len(shingles):
            return None, None, None
        return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), *hasher_of(params)(shingles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(params.shingle, params.cached_words)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                rows = [row(shingler, text) for text in part.column(3).to_pylist()]
                made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), *made],
                    names=["id", "k1", "k2", "digest", "values", "band_keys"],
                )

    schema = source.drop("t").schema.add("digest", "binary").add("values", "binary")
    return source.mapInArrow(run, _with_longs(schema, "band_keys"))


def _with_longs(schema, name: str):
    from pyspark.sql.types import ArrayType, LongType

    return schema.add(name, ArrayType(LongType()))


def _shingle_sets(docs: DataFrame, wanted: DataFrame, params: SimilarityParams, id_column: str, text_column: str) -> DataFrame:
    """(digest, shingles) of the wanted classes, from the text of one member each."""
    text = text_or_empty(text_column)
    source = docs.select(F.col(id_column).alias("id"), *text_key(text), text.alias("t")).alias("d")
    wanted = broadcast_if_small(wanted, 72).alias("w")
    met = source.join(
        wanted,
        (F.col("d.k1") == F.col("w.k1")) & (F.col("d.k2") == F.col("w.k2")) & F.col("d.id").eqNullSafe(F.col("w.id")),
    ).select("w.digest", "d.t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(params.shingle, params.cached_words)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                sets = [shingler(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["digest", "shingles"])

    return met.mapInArrow(run, "digest binary, shingles binary").dropDuplicates(["digest"])


def _matrix(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


PAIR = "a binary, b binary, n_docs_a long, n_docs_b long"
PAIR_COLUMNS = ["a", "b", "n_docs_a", "n_docs_b"]


def _pruned(params: SimilarityParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (_matrix(batch.column(n), "<u2", params.values) for n in ("values_a", "values_b"))
                yield batch.select(PAIR_COLUMNS).take(pa.array(prune(left, right, params)))

    return run


def _verified(params: SimilarityParams):
    def reaches(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        both = shared(x, y)
        return 1000 * both >= params.permille * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                pairs = zip(part.column("shingles_a").to_pylist(), part.column("shingles_b").to_pylist())
                yield part.select(PAIR_COLUMNS).filter(pa.array([reaches(*p) for p in pairs], pa.bool_()))

    return run


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Shingles that the sets of each pair (i, j) have in common."""
    if len(pairs) <= 2000:
        return np.array([shared(left[i], right[j]) for i, j in pairs], np.int64)
    every = np.concatenate([*left, *right])
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    common = np.cumsum(counts > 1) - 1  # a shingle of one set is shared by none
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    keep = counts[inverse] > 1
    rows, columns = rows[keep], common[inverse[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    total, width, n = np.zeros((len(left), len(right)), np.float32), 4096, int(common[-1]) + 1 if len(common) else 0
    for at in range(0, n, width):
        a, b = np.searchsorted(columns, [at, at + width])
        dense = np.zeros((len(left) + len(right), width), np.float32)
        dense[rows[a:b], columns[a:b] - at] = 1
        total += dense[: len(left)] @ dense[len(left) :].T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def _forest(n: int, pairs: np.ndarray, order: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs, each tree grown from its least node."""
    ends = np.concatenate([pairs, pairs[:, ::-1]])
    ends = ends[np.argsort(ends[:, 0], kind="stable")]
    starts = np.searchsorted(ends[:, 0], np.arange(n + 1))
    seen, edges = np.zeros(n, bool), []
    for root in order:
        if seen[root]:
            continue
        seen[root], queue = True, [root]
        while queue:
            node = queue.pop()
            near = ends[starts[node] : starts[node + 1], 1]
            near = near[~seen[near]]
            seen[near] = True
            edges += [(node, m) for m in near]
            queue += near.tolist()
    return edges


BLOCK_RESULT = "digest binary, other binary, n_docs long, n_texts long"


def _compare_blocks(params: SimilarityParams):
    """Of two blocks of a component: links per class, and edges that connect what is linked."""

    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own = np.array(table.column("own").to_pylist())
        digests = table.column("digest").to_pylist()
        values = _matrix(table.column("values"), "<u2", params.values)
        bands = np.array(table.column("band_keys").to_pylist(), np.int64)
        sets = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
        weights = np.array(table.column("n_docs").to_pylist(), np.int64)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        near = np.zeros((len(left), len(right)), bool)
        for band in range(bands.shape[1]):
            near |= bands[left, band][:, None] == bands[right, band]
        if i == j:
            near = np.triu(near, 1)
        pairs = np.argwhere(near).astype(np.int32)
        parts = [pairs[k : k + 20_000] for k in range(0, len(pairs), 20_000)]
        kept = [p[prune(values[left[p[:, 0]]], values[right[p[:, 1]]], params)] for p in parts]
        pairs = np.concatenate([pairs[:0], *kept])
        both = _shared_counts([sets[k] for k in left], [sets[k] for k in right], pairs)
        sizes = np.array([len(s) for s in sets], np.int64)
        pairs = np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], axis=1)
        linked = 1000 * both >= params.permille * (sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - both)
        pairs = pairs[linked]
        docs, texts = np.zeros(len(digests), np.int64), np.zeros(len(digests), np.int64)
        for x, y in ((0, 1), (1, 0)):
            np.add.at(docs, pairs[:, x], weights[pairs[:, y]])
            np.add.at(texts, pairs[:, x], 1)
        order = np.array(sorted(range(len(digests)), key=digests.__getitem__))
        edges = _forest(len(digests), pairs, order) if len(pairs) else []
        some = np.flatnonzero(texts)
        return pa.table(
            {
                "digest": pa.array([digests[k] for k in some] + [digests[a] for a, _ in edges], pa.binary()),
                "other": pa.array([None] * len(some) + [digests[b] for _, b in edges], pa.binary()),
                "n_docs": pa.array([*docs[some], *[0] * len(edges)], pa.int64()),
                "n_texts": pa.array([*texts[some], *[0] * len(edges)], pa.int64()),
            }
        )

    return run


@dataclass(frozen=True)
class Join:
    """What the join found: sketches of all rows, and a row per class that has links."""

    rows: DataFrame  # id, k1, k2, digest (null without words)
    linked: DataFrame  # digest, class_id, copy_id, n_links, n_text_links, root, first (row of the component)


def similar(
    docs: DataFrame,
    params: SimilarityParams = SimilarityParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Join:
    rows = written(sketches(docs, params, id_column, text_column), "sketches")
    classes = written(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.first("values").alias("values"),
            F.first("band_keys").alias("band_keys"),
            F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2")).alias("least"),
            F.count(F.lit(1)).alias("n_docs"),
        ),
        "classes",
    )
    members = classes.select("digest", F.explode("band_keys").alias("band"))
    buckets = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("center")).where("n > 1")
    placed = checkpointed(members.join(buckets.hint("merge"), "band"))

    # from here on, frames are small: the classes that share a bucket with another
    n_placed = placed.count()
    large = placed.where(F.col("n") > params.small_bucket)
    groups = components(large.select(F.col("digest").alias("a"), F.col("center").alias("b")))
    grouped = checkpointed(groups.select(F.col("node").alias("digest"), F.col("root").alias("big_group")))

    # both sides of every join below grow with the data: merge joins, at any size
    small = placed.where(F.col("n") <= params.small_bucket).select("band", "digest")
    small = in_few_tasks(small.join(grouped.hint("merge"), "digest", "left"), n_placed)
    sides = [small.select("band", *[F.col(c).alias(f"{n}_{c}") for c in ("digest", "big_group")]) for n in "ab"]
    pairs = (
        in_few_tasks(sides[0].join(sides[1].hint("merge"), "band"), 2 * n_placed)
        .where("a_digest < b_digest AND coalesce(a_big_group <> b_big_group, true)")
        .select(F.col("a_digest").alias("a"), F.col("b_digest").alias("b"))
        .distinct()
    )
    pairs = in_few_tasks(pairs, 2 * n_placed)
    for c in "ab":
        side = classes.select(F.col("digest").alias(c), *[F.col(n).alias(f"{n}_{c}") for n in ("values", "n_docs")])
        pairs = in_few_tasks(pairs.join(side.hint("merge"), c), 2 * n_placed)
    survivors = checkpointed(pairs.mapInArrow(_pruned(params), PAIR))

    needed = survivors.select(F.explode(F.array("a", "b")).alias("digest")).unionByName(grouped.select("digest"))
    wanted = classes.join(needed.hint("merge"), "digest", "left_semi").select("digest", "least.id", "least.k1", "least.k2")
    wanted = checkpointed(in_few_tasks(wanted, n_placed))
    sets = written(_shingle_sets(docs, wanted, params, id_column, text_column), "shingles")

    tested = survivors
    for c in "ab":
        side = sets.select(F.col("digest").alias(c), F.col("shingles").alias(f"shingles_{c}"))
        tested = in_few_tasks(tested.join(side.hint("merge"), c), 8 * n_placed)
    links = checkpointed(tested.mapInArrow(_verified(params), PAIR))

    sizes = grouped.groupBy("big_group").agg(F.ceil(F.count(F.lit(1)) / params.block).cast("int").alias("blocks"))
    blocked = (
        in_few_tasks(grouped.join(sizes.hint("merge"), "big_group"), n_placed)
        .join(classes.select("digest", "values", "band_keys", "n_docs").hint("merge"), "digest")
        .join(sets.hint("merge"), "digest")
        .withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("own", "with"), "j": F.greatest("own", "with")})
    )
    dense = checkpointed(
        blocked.select("big_group", "i", "j", "own", "digest", "values", "band_keys", "n_docs", "shingles")
        .groupBy("big_group", "i", "j")
        .applyInArrow(_compare_blocks(params), BLOCK_RESULT)
    )

    edges = links.select("a", "b").unionByName(
        dense.where("other IS NOT NULL").select(F.col("digest").alias("a"), F.col("other").alias("b"))
    )
    roots = components(edges).select(F.col("node").alias("digest"), "root")
    # what is known of a class comes from four places and meets in one grouping
    one = F.lit(1).cast("bigint")
    parts = [
        classes.select("digest", "least", "n_docs"),
        roots,
        links.select(F.col("a").alias("digest"), F.col("n_docs_b").alias("other_docs"), one.alias("text_links")),
        links.select(F.col("b").alias("digest"), F.col("n_docs_a").alias("other_docs"), one.alias("text_links")),
        dense.where("other IS NULL").select(
            "digest", F.col("n_docs").alias("other_docs"), F.col("n_texts").alias("text_links")
        ),
    ]
    known = parts[0]
    for part in parts[1:]:
        known = known.unionByName(part, allowMissingColumns=True)
    no_links = F.lit(0).cast("bigint")
    linked = checkpointed(
        known.groupBy("digest")
        .agg(
            F.max("least").alias("least"),
            F.max("n_docs").alias("n_docs"),
            F.max("root").alias("root"),
            F.coalesce(F.sum("other_docs"), no_links).alias("other_docs"),
            F.coalesce(F.sum("text_links"), no_links).alias("n_text_links"),
        )
        .where("n_docs > 1 OR root IS NOT NULL")
        .select(
            "digest",
            F.coalesce("root", "digest").alias("root"),
            "least",
            (F.col("n_docs") - 1 + F.col("other_docs")).alias("n_links"),
            "n_text_links",
        )
    )
    firsts = linked.groupBy("root").agg(F.min("least").alias("first"))
    named = in_few_tasks(linked.join(firsts.hint("merge"), "root"), linked.count()).select(
        "digest",
        F.col("first.id").alias("class_id"),
        F.col("least.id").alias("copy_id"),
        "n_links",
        "n_text_links",
        "root",
        "first",
    )
    return Join(rows.select("id", "k1", "k2", "digest"), checkpointed(named))


def links_per_document(
    docs: DataFrame,
    params: SimilarityParams = SimilarityParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: the id, ``class_id`` (least id of its component), ``copy_id`` (least id with an
    equal set), ``n_links`` (other rows at the threshold or above), ``n_text_links`` (classes)."""
    found = similar(docs, params, id_column, text_column)
    linked = broadcast_if_small(found.linked.select("digest", "class_id", "copy_id", "n_links", "n_text_links"), 80)
    zero = F.lit(0).cast("bigint")
    own = F.col("n_links").isNull()
    return found.rows.join(linked, "digest", "left").select(
        F.col("id").alias(id_column),
        F.when(own, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_text_links", zero).alias("n_text_links"),
    )


def one_per_class(
    docs: DataFrame,
    params: SimilarityParams = SimilarityParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with the first row, by id, of every component; rows without links all stay."""
    found = similar(docs, params, id_column, text_column)
    text = text_or_empty(text_column)
    # one row per text of a linked class: whether it may stay, and for which component
    texts = found.rows.where("digest IS NOT NULL").select("k1", "k2", "digest").distinct()
    status = checkpointed(texts.join(found.linked.select("digest", "root", "first"), "digest"))
    status = broadcast_if_small(
        status.select(F.col("k1").alias("key_1"), F.col("k2").alias("key_2"), F.col("root").alias("in_group"), "first"), 120
    )
    keyed = docs.select("*", *[k.alias(f"key_of_{n}") for k, n in zip(text_key(text), "12")])
    joined = keyed.join(status, (F.col("key_of_1") == F.col("key_1")) & (F.col("key_of_2") == F.col("key_2")), "left")
    stays = (
        (F.col("first.k1") == F.col("key_of_1"))
        & (F.col("first.k2") == F.col("key_of_2"))
        & F.col(id_column).eqNullSafe(F.col("first.id"))
    )
    alone = joined.where("in_group IS NULL").select(*docs.columns)
    # a row that is repeated, id and text, would stay more than once
    chosen = joined.where(stays).dropDuplicates(["in_group"]).select(*docs.columns)
    return alone.unionByName(chosen)
