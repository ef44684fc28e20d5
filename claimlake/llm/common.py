"""What the text operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.sources import shared

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Largest table that is broadcast on request, after its size has been measured.
BROADCAST_BYTES = 32 << 20
#: Rows that a Python task turns into one output batch.
BATCH_ROWS = 512
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII = bytes(range(128))
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and characters beyond ASCII."""
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def word_bytes(text: str) -> list[bytes]:
    """The words of :func:`words_of` as UTF-8, for code inside Python tasks."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def text_key(text: Column) -> list[Column]:
    """A 128-bit key of a text in two columns, ``k1`` and ``k2``."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Take the folder the session names; a local session without one uses a folder of its warehouse."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared.shared_folder(spark))


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def in_few_tasks(df: DataFrame, rows: int, rows_per_task: int = 25_000) -> DataFrame:
    """``df``, of about ``rows`` rows, in as many tasks as they need and no more.

    For small frames between shuffles: it is right whatever the partitioning, and
    where rows are many it changes nothing.
    """
    wanted = rows // rows_per_task + 1
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(wanted) if wanted < usual else df


def broadcast_if_small(
    df: DataFrame, row_bytes: int, varying: Column | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if its rows fit ``limit``, else unchanged.

    A row counts ``row_bytes``, and ``varying`` beside where it holds a text or a list.
    ``df`` should be checkpointed: it is measured here and read again by the join. Beyond
    the limit the planner shuffles both sides, and AQE splits hot keys.
    """
    more = F.lit(0) if varying is None else F.coalesce(F.sum(varying.cast("bigint")), F.lit(0))
    return F.broadcast(df) if df.agg((F.count(F.lit(1)) * row_bytes + more).alias("b")).first()["b"] <= limit else df


def bit_array(places: DataFrame, words: int) -> DataFrame:
    """One row, ``bits``: an array of longs in which the bits at the numbers ``p`` are set."""
    set_bits = places.select(
        F.floor(F.col("p") / 64).alias("word"), F.expr("shiftleft(1L, cast(pmod(p, 64) AS int))").alias("bits")
    )
    zeros = places.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = set_bits.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(in_order, lambda s: s["bits"]).alias("bits"))


def bit_is_set(bits: Column, place: Column) -> Column:
    return F.getbit(F.get(bits, F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1


def shared_folder(spark: SparkSession) -> str:
    """The folder for written tables that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, for reads of a few columns."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
