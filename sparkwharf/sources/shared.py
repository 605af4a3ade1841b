"""Folders that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; without that setting only a local master gets one, beside its warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_formats"
    return f"{base.rstrip('/')}/formats/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to a new shared folder and read back, which cuts their lineage; a lost executor costs a reread."""
    path = folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
