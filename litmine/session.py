"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("litmine")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def on_one_machine(master: str) -> bool:
    """Whether all tasks run in the driver's own process."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (local runs) is a temporary folder used; executors on other machines would
    each write to their own, so a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="litmine-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df, *keys: str):
    """Use every core when a scan yields fewer partitions than there are cores.

    Compressed files and lone row groups cannot be split. A large table has
    far more splits than cores and is returned as it is, without a shuffle.
    Hashing by the row key also serves later steps that group by that key.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def spread_rows(df, n_rows: int, rows_per_task: int = 20_000):
    """Deal rows that each mean much work over as many tasks as their number needs, and over every core at least.

    Such rows are few bytes, and the number of a scan's splits, or of partitions after a join, follows the bytes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-n_rows // rows_per_task)))


def written(df, label: str = "step"):
    """Write a frame to the shared folder once and read it back.

    This cuts the lineage: later steps start from files, also after an
    executor is lost, and nothing is computed twice. Zstandard halves the
    repeated terms of triples against Parquet's default.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
