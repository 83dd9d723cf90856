"""Where intermediate tables go, and how lineage is cut.

Iterative operators (components, density clustering, tuning) write each round
as a table instead of keeping it on executors, so that a lost executor costs a
re-read and not the whole history.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="segspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the table once to the shared folder and continue from the files.

    With ``partition_by``, later filters on that column read only its files.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/segspark/{uuid.uuid4().hex}"
    if partition_by is None:
        df.write.mode("errorifexists").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.mode("errorifexists").partitionBy(partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_bucketed(df: DataFrame, key: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Like ``materialize``, with all rows of a key in one bucket.

    Later aggregates, windows and joins by the key, alone or (joins aside) with other columns, then need no
    shuffle. Rows that are already partitioned by the key are not shuffled for the write either. Within a
    bucket rows lie in the order of ``sort_by``, so a filter on it skips pages.
    """
    spark = df.sparkSession
    name = f"segspark_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark).rstrip('/')}/segspark/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, key).write.format("parquet").mode("errorifexists").bucketBy(buckets, key)
    writer = writer.sortBy(*sort_by) if sort_by else writer
    table = f"spark_catalog.default.{name}"
    writer.option("path", path).saveAsTable(table)
    written = spark.table(table)
    # Only the catalog tells a reader about buckets. The entry goes at once; the files and ``written`` stay.
    spark.sql(f"DROP TABLE {table}")
    return written
