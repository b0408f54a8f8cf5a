"""What the operators share: scratch tables, blocks of documents, byte tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z in bytes and leaves all else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower-cases A-Z; every other ASCII character but digits and letters becomes a space.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of text that one block of documents holds, so that a block fits a Python worker.
BLOCK_BYTES = 8 << 20
MIN_BLOCKS = 64
#: Buckets of a block table at most (Spark allows 100,000).
MAX_BUCKETS = 50_000
#: The block tables that each session has made.
_tables: dict[SparkSession, list[str]] = {}


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a temporary one where it is unset (local tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: later stages survive lost executors and start from files."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._saved_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what saved() wrote for frames. Only for frames that nothing unsaved is made from any more."""
    for df in frames:
        spark, path = df.sparkSession, getattr(df, "_saved_at", None)
        if path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            df._saved_at = None


def rows_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def n_blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about block_bytes the texts fill; it grows with the data."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(MIN_BLOCKS, -(-total // block_bytes))


def in_blocks(docs: DataFrame, n: int, extra: list | None = None) -> DataFrame:
    """part, doc_id, text and the extra columns (text is binary, null text empty), dealt so that a block lies in one task. A block takes rows by a hash of id and text, so rows that repeat an id spread as well."""
    return docs.select(
        F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(n)).cast("long").alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        *(extra or []),
    ).repartition(min(n, MAX_BUCKETS), "part")


def bucketed(rows: DataFrame, n: int) -> DataFrame:
    """rows (dealt by part as in_blocks does it), stored once as a table bucketed by part, so that later passes over the blocks don't shuffle them.

    A bucket holds one block, or several where there are more than MAX_BUCKETS. The files lie in the shared folder; the session's
    catalog names them until drop_block_tables().
    """
    spark = rows.sparkSession
    name, n = f"tidelog_blocks_{uuid.uuid4().hex}", min(n, MAX_BUCKETS)
    _tables.setdefault(spark, []).append(name)
    rows.write.option("compression", "zstd").option("path", fresh_path(spark, "blocks")).bucketBy(n, "part").saveAsTable(name)
    return spark.table(name)


def block_table(docs: DataFrame, n: int, extra: list | None = None) -> DataFrame:
    """in_blocks(docs), as bucketed() stores it."""
    return bucketed(in_blocks(docs, n, extra), n)


def drop_block_tables(spark: SparkSession) -> None:
    """Drops this session's block tables and deletes their files; only when no result that reads them is needed any more."""
    for name in _tables.pop(spark, []):
        path = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"DROP TABLE {name}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
