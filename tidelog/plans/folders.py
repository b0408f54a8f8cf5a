"""Folders for what queries write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; a temporary one where it is unset (local tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once to a shared folder and read from there as often as they are needed."""
    path, schema = shared_folder(rows.sparkSession, name), rows.schema
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)
