"""Session set-up, lineage cuts and joins with per-key facts."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "icufeat") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ready_checkpoints(spark: SparkSession) -> None:
    """Make sure checkpoints have a folder, the one the session names if it names one.

    Only a local master may fall back to a folder of its own: on a cluster that
    folder would exist on one machine only.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="icufeat-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and stops recomputation."""
    ready_checkpoints(df.sparkSession)
    return df.checkpoint()


def per_core(blocks: RDD, most: int = 64) -> RDD:
    """The same blocks in a partition per core, or more where one would get over `most` blocks.

    A task then takes its blocks one after the other; a pass over many small tasks would mostly start them.
    """
    count = blocks.getNumPartitions()
    return blocks.coalesce(min(count, max(blocks.context.defaultParallelism, -(-count // most))))


def join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], *, how: str = "inner") -> DataFrame:
    """Inner or left join with one row of facts per key; null keys meet.

    A plain join: Spark measures the facts when it has them, broadcasts what fits its
    threshold in bytes, and otherwise joins by shuffle and splits the partitions of hot keys.
    """
    facts = small.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & big[k].eqNullSafe(facts[f"__k_{k}"])
    return big.join(facts, condition, how).drop(*[f"__k_{k}" for k in keys])


def salted_join(
    big: DataFrame, facts: DataFrame, keys: Sequence[str], *, how: str = "inner", salts: int = 32
) -> DataFrame:
    """Inner or left join with one row of facts per key, copied `salts` times so that a hot key spreads.

    A row takes the copy of its partition's number, so equal rows spread too, and the
    optimiser learns no equation over all columns, which it would repeat for every alias.
    """
    copies = facts.withColumnsRenamed({k: f"__k_{k}" for k in keys}).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    salted = big.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    condition = F.col("__salt") == F.col("__copy")
    for k in keys:
        condition = condition & salted[k].eqNullSafe(copies[f"__k_{k}"])
    return salted.join(copies, condition, how).drop("__salt", "__copy", *[f"__k_{k}" for k in keys])
