"""Helpers shared by the operators: stored intermediate tables, ids and text columns."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


PLACES = 1 << 26  # bits of the bitmap of ``among`` (8 MB)
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver did (on a cluster it is installed or sent along)."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *[k for k in known if k]])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below ``spark.checkpoint.dir`` and read it back.

    The folder is shared by the driver and all executors, so a lost executor
    costs at most its running tasks; the lineage ends at the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postsift-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def among(rows: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``col`` may be one of ``keys`` (one column of the same type): all that are, and some others.

    The keys' hashed places go round as a bitmap of fixed size, so before a join on ``col`` few rows
    without a partner are shuffled, and in the worst case (far more keys than places) all are, as without it.
    """
    place = F.pmod(F.xxhash64(col), F.lit(PLACES)) + 1
    placed = keys.toDF(col).select(place.alias("place"))
    bits = placed.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = (F.bitmap_bucket_number(place) == F.col("bucket")) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return rows.join(F.broadcast(bits), held, "left_semi")


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the held-out fold; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def share(df: DataFrame, n: int, *key: str) -> Column:
    """Condition that holds for about ``n`` of the rows of ``df``, all if it has fewer: their hash of ``key`` falls below ``n`` in the number of rows."""
    rows = df.select(*key).count()
    if rows <= n:
        return F.lit(True)
    return F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 40)) < int((1 << 40) * n / rows)


def about(df: DataFrame, n: int, *key: str) -> DataFrame:
    """About ``n`` rows of ``df`` (see ``share``).

    One count over the key columns and a filter in the tasks that read the rows; nothing is sorted or gathered.
    """
    return df.where(share(df, n, *key))
