"""File sources and sinks.

Artifacts are partitioned datasets ``<root>/<kind>/run_id=<id>/batch=<n>/``:
partition pruning replaces globbing by name, and a batch suffix can never
collide. State tables are in ``state_store``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import path_exists


def union_postings(frames: list[DataFrame]) -> DataFrame:
    """A1: concatenate per-site / per-term frames, tolerating missing columns."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sanitize_frame(df: DataFrame) -> DataFrame:
    """Spreadsheet-safe values in every string column; other types untouched."""
    return df.select(
        *[tx.sanitize_cell(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
          for f in df.schema.fields]
    )


def read_labelled(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """A3: labelled items, wrapped ``{"metadata", "items"}`` or a bare array.

    Fails (naming the item index) when a description is missing or a label is
    missing or not strictly boolean. The check is one aggregate; only the
    first offending index reaches the driver. ``json_lines`` reads one item
    per line (splittable, for large label sets); the index is then the
    row id.
    """
    if json_lines:
        items = spark.read.json(path).withColumn("idx", F.monotonically_increasing_id())
        return _validate_items(items)
    raw = spark.read.option("multiLine", True).option("primitivesAsString", False).json(path)
    if "items" in raw.columns:
        items = raw.select(F.posexplode("items").alias("idx", "item")).select("idx", "item.*")
    else:
        items = spark.read.option("multiLine", True).json(path)
        items = items.withColumn("idx", F.monotonically_increasing_id())
    return _validate_items(items)


def _validate_items(items: DataFrame) -> DataFrame:
    cols = set(items.columns)
    if "description" not in cols:
        raise ValueError("Item 0 missing required field 'description'")
    if "label" not in cols:
        raise ValueError("Item 0 missing required field 'label'")
    label_type = dict(items.dtypes)["label"]
    if label_type != "boolean":
        is_bool = F.coalesce(F.lower(F.col("label").cast("string")).isin("true", "false"), F.lit(False))
        first = items.filter(~is_bool).agg(F.min("idx").alias("i")).first()["i"]
        raise ValueError(f"Item {0 if first is None else first} field 'label' must be boolean, found {label_type}")
    bad = items.filter(F.col("description").isNull() | F.col("label").isNull()).agg(F.min("idx").alias("i")).first()
    if bad is not None and bad["i"] is not None:
        raise ValueError(f"Item {bad['i']} missing required field 'description' or 'label'")
    return items


def read_run_artifacts(spark: SparkSession, root: str, kind: str, schema: T.StructType,
                       one_object_per_file: bool = True) -> tuple[DataFrame, DataFrame]:
    """A4: all JSON artifacts of one kind, with an explicit schema.

    Returns (good rows, corrupt rows). Corrupt files do not stop the read;
    they come back on the side output with their file name. Artifacts are one
    (pretty-printed) object per file by default; ``one_object_per_file=False``
    reads JSON lines, as Spark's own JSON sink writes them.
    """
    # one row per artifact file; a file that does not parse fills the corrupt field
    sch = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (
        spark.read.option("wholetext", one_object_per_file).text(f"{root.rstrip('/')}/{kind}")
        .withColumn("source_file", F.input_file_name())
        .withColumn("__p", F.from_json("value", sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    )
    ok = F.col("__p._corrupt_record").isNull()
    good = raw.filter(ok).select(*[F.col("__p." + f.name).alias(f.name) for f in schema.fields], "source_file")
    bad = raw.filter(~ok).select("source_file", F.col("value").alias("_corrupt_record"))
    return good, bad


def read_batches(spark: SparkSession, root: str, kind: str, run_id: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """A4: one kind of JSON-lines artifacts of all batches of a run, with an explicit schema.

    Returns (rows with their ``batch``, null for a run that was not cut; corrupt
    files). A file with a line that does not parse is skipped whole and named in
    the second frame; a kind that no batch wrote is empty.
    """
    path = f"{root.rstrip('/')}/{kind}/run_id={run_id}"
    fields = T._parse_datatype_string(schema)
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], T.StructType([*fields.fields, T.StructField("batch", T.IntegerType())]))
        return empty, spark.createDataFrame([], "source_file string")
    sch = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.option("recursiveFileLookup", True).text(path).withColumn("source_file", F.input_file_name())
    parsed = F.from_json("value", sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    named = lines.select("source_file", parsed.alias("p")).select("source_file", "p.*")
    bad = named.where(F.col("_corrupt_record").isNotNull()).select("source_file", F.lit(True).alias("__bad")).distinct()
    good = named.join(bad, "source_file", "left").where("__bad IS NULL")
    batch = F.nullif(F.regexp_extract("source_file", r"/batch=([0-9]+)/", 1), F.lit("")).cast("int")
    return good.select(*[f.name for f in fields.fields], batch.alias("batch")), bad.select("source_file")


def latest_export(df: DataFrame, key: str = "run_id") -> DataFrame:
    """A5: rows of the newest export = greatest partition value (a scalar subquery)."""
    newest = df.agg(F.max(key).alias("__m"))
    return df.join(newest, df[key] == newest["__m"], "left_semi")


def run_partition(path_col: str = "source_file"):
    """(run_id, batch) recovered from an artifact file name ``<kind>_<run>_batch<n>.json``."""
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    run_id = F.regexp_extract(name, r"^[a-z_]+?_(\d[^_]*(?:_\d+)?)(?:_batch\d+)?\.json$", 1)
    batch = F.regexp_extract(name, r"_batch(\d+)\.json$", 1)
    return run_id.alias("run_id"), F.when(batch != "", batch.cast("int")).alias("batch")


def write_leads_csv(leads: DataFrame, root: str, run_id: str, batch: int | None = None, mode: str = "errorifexists") -> str:
    """Sanitised CSV with header, one folder per (run, batch): batches never collide."""
    path = f"{root.rstrip('/')}/leads/run_id={run_id}" + (f"/batch={batch}" if batch is not None else "")
    (sanitize_frame(leads).write.mode(mode).option("header", True).option("escape", '"')
     # values are written as they are (Spark trims blanks around values by default)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_report_json(report: DataFrame, root: str, kind: str, run_id: str, batch: int | None = None,
                      skip_empty: bool = False, mode: str = "errorifexists") -> str | None:
    """A JSON report sink (search errors, run stats, analytics, rejected rows).

    ``skip_empty`` writes nothing for an empty report (search errors are only
    exported when there are any); checked with a one-row probe, not a count.
    """
    if skip_empty and report.limit(1).count() == 0:
        return None
    path = f"{root.rstrip('/')}/{kind}/run_id={run_id}" + (f"/batch={batch}" if batch is not None else "")
    report.write.mode(mode).json(path)
    return path
