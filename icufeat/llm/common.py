"""Small helpers that the training-text operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: A key is heavy when it holds at least one row in HEAVY_SHARE; so there are at most HEAVY_SHARE such keys.
HEAVY_SHARE = 500

_LOCAL: dict[str, str] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only a session with a local master may do without: it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="icufeat-llm-"))
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again.

    Cuts the lineage, survives lost executors, and gives the planner the size in
    bytes, by which Spark itself decides whether a later join may broadcast.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo `modulus`; null for null."""
    return F.crc32(F.col(column).cast("string")) % modulus


def unit_hash(*columns: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def share_per_class(counts: Mapping[object, int], rows: int) -> dict[object, float]:
    """For each class the share of its rows to draw so that about `rows` of them come."""
    return {k: min(1.0, rows / n) for k, n in counts.items() if n}


def pick(column: Column, shares: Mapping[object, float]) -> Column:
    """The share of the class in `column`; 0 for a class that has none."""
    out = F.lit(0.0)
    for k, v in shares.items():
        out = F.when(column == F.lit(k), F.lit(v)).otherwise(out)
    return out


def join_facts(big: DataFrame, facts: DataFrame, key: str, count: str, total: int, spread: Column) -> DataFrame:
    """Left join of rows with one row of facts per key, whatever share of the rows a key holds.

    `count` names the column of `facts` with the rows a key has in `big`, `total` is
    their sum. Keys with at least total / HEAVY_SHARE rows, HEAVY_SHARE at most, are
    broadcast, so their rows stay where they are; all others are light enough for one
    task. Rows that are served already, and rows with a null key, go to tasks by
    `spread` instead of all to the task of one key.
    """
    names = [c for c in facts.columns if c not in (key, count)]
    heavy = F.col(count) * HEAVY_SHARE >= F.lit(max(1, total))
    hot = facts.filter(heavy).select(F.col(key).alias("__hot"), F.struct(*names).alias("__h"))
    rest = facts.filter(~heavy).select(F.col(key).cast("string").alias("__cold"), F.struct(*names).alias("__c"))
    served = F.col("__hot").isNotNull() | F.col(key).isNull()
    lone = F.when(served, F.concat(F.lit("\u0000"), spread.cast("string"))).otherwise(F.col(key).cast("string"))
    return (
        big.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
        .withColumn("__lone", lone)
        .join(rest, F.col("__lone") == F.col("__cold"), "left")
        .withColumn("__f", F.coalesce("__h", "__c"))
        .select(*[F.col(c) for c in big.columns], *[F.col(f"__f.{n}").alias(n) for n in names])
    )


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of few rows, so that long texts do not pile up as Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def and_then(batches: Iterable[pa.RecordBatch], clear: Callable[[], None]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end, or when the task is given up, `clear` runs and unused Arrow memory goes back."""
    try:
        yield from batches
    finally:
        clear()
        pa.default_memory_pool().release_unused()
