"""Tables in the folder that all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, own: str | None = None) -> str:
    """The folder all executors see; `own` only where the session names none. Without either,
    a local master uses a folder of its machine and any other is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None) or own
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        root = "/tmp/sparrowmill"
    return f"{root}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write to the shared folder and reread: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}-{tag}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_key(df: DataFrame, key: str) -> DataFrame:
    """`df` with a number of its own for each row, written once so that every reader sees
    the same; a table that has the column already keeps it."""
    return df if key in df.columns else materialise(df.withColumn(key, F.monotonically_increasing_id()), "keyed")
