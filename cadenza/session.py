"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cadenza")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting it is a folder of the session's warehouse, if all executors can reach that: the master is
    local, or the warehouse is not on a local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    alone = re.match(r"local(\[|$)", spark.sparkContext.master)
    if not alone and warehouse.startswith(("file:", "/")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{warehouse.rstrip('/')}/cadenza-scratch"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/cadenza/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several jobs read one intermediate table: lineage ends here, the
    table survives lost executors, and later scans still prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like ``materialize``, with rows dealt to as many buckets as there are shuffle partitions, by ``key``.

    A join or grouping by the key reads the buckets as they are; only its other side is shuffled. The catalog's entry is
    taken out again, the files stay.
    """
    spark = df.sparkSession
    name = f"cadenza_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", scratch_path(spark, label)).saveAsTable(name)
    rows = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for iterative plans."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
