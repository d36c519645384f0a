"""Keyed tables in versions: hash buckets, copied when they change, and a manifest a version.

``<root>/<table>/data/version=<v>/bucket=<b>/`` holds the rows of one bucket as
of version v; ``<root>/<table>/manifest/version=<v>/`` lists, for every bucket
that has rows, the folder that holds them. An upsert reads and writes the
buckets that its events fall into and no others; a version shares all other
folders with the one before it, so its cost follows the events, and each
version stays readable. Folders of a version count only once its manifest is
there: a writer that dies before leaves nothing behind that is read, and the
next one writes over it. A manifest is never overwritten, so of two writers of
one version the second fails.

The number of buckets is set by the first version (``rebucket`` writes a version
with another one): size it so that a bucket fits a task. It bounds the manifest,
which the driver reads.

Defined cases: a missing table is empty; no events make no version; null keys
are a key; of events of one key the greatest order wins, stored rows count as
the earliest of equal ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import last_per_key
from ..session import stored, table_exists
from . import schemas as S

BUCKETS = 64
MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n_buckets", T.IntegerType()), T.StructField("folder", T.StringType()),
                         T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class Keyed:
    """How rows of a state table are keyed, ordered and bucketed."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    bucket_by: tuple[str, ...]


TABLES = {
    "submitted": Keyed(("domain",), ("submitted_at", "seq"), ("domain",)),
    "queries_tried": Keyed(("query",), ("tried_at", "seq"), ("query",)),
    # a source is one bucket, so taking it out touches no other
    "source_progress": Keyed(("source", "key"), ("seq",), ("source",)),
    "site_health": Keyed(("window_start", "site"), (), ("window_start",)),
    "leads": Keyed(("company", "job_title", "date_scraped"), ("seq",), ("company", "job_title", "date_scraped")),
}


@dataclass(frozen=True)
class Version:
    number: int
    n_buckets: int
    folders: dict[int, str]


def _base(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def versions(spark: SparkSession, root: str, table: str) -> list[int]:
    """The table's versions, oldest first."""
    path = f"{_base(root, table)}/manifest"
    if not table_exists(spark, path):
        return []
    return sorted(r[0] for r in spark.read.schema(MANIFEST).parquet(path).select("version").distinct().collect())


def manifest(spark: SparkSession, root: str, table: str, version: int | None = None) -> Version | None:
    """A version's buckets, of the newest one by default; None where there is none."""
    known = versions(spark, root, table)
    if version is None and known:
        version = known[-1]
    if version not in known:
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{_base(root, table)}/manifest").where(F.col("version") == version).collect()
    return Version(version, rows[0]["n_buckets"], {r["bucket"]: r["folder"] for r in rows if r["folder"] is not None})


def _bucket(spec: Keyed, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*spec.bucket_by), F.lit(n_buckets)).cast("int")


def _rows(spark: SparkSession, root: str, table: str, folders: list[str]) -> DataFrame:
    schema = S.STATE_SCHEMAS[table]
    if not folders:
        return spark.createDataFrame([], schema)
    base = _base(root, table)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in folders])


def read_state(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A version of a state table, the newest by default; a missing table is empty."""
    at = manifest(spark, root, table, version)
    return _rows(spark, root, table, sorted(at.folders.values()) if at else [])


def _commit(spark: SparkSession, root: str, table: str, rows: DataFrame, n_buckets: int, number: int, kept: dict[int, str]) -> Version:
    """Write ``rows`` (all rows of every bucket that is not in ``kept``) and the manifest of version ``number``."""
    spec, base, folder = TABLES[table], _base(root, table), f"data/version={number:012d}"
    names = [f.name for f in S.STATE_SCHEMAS[table].fields]
    bucketed = rows.select(*names, _bucket(spec, n_buckets).alias("bucket")).repartition("bucket")
    bucketed.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/{folder}")
    # which buckets have rows: from the folders, no row is read
    written = spark.read.parquet(f"{base}/{folder}").select("bucket").distinct() if table_exists(spark, f"{base}/{folder}") else None
    fresh = {r[0]: f"{folder}/bucket={r[0]}" for r in written.collect()} if written is not None else {}
    folders = {**kept, **fresh}
    entries = [(b, n_buckets, f) for b, f in sorted(folders.items())] or [(None, n_buckets, None)]
    listed = spark.createDataFrame(entries, T.StructType(MANIFEST.fields[:3])).coalesce(1)
    listed.write.mode("errorifexists").parquet(f"{base}/manifest/version={number:012d}")
    return Version(number, n_buckets, folders)


def write_state_version(df: DataFrame, root: str, table: str, version: int, n_buckets: int = BUCKETS) -> str:
    """Write a whole table as a new version; readers take the greatest version."""
    spark = df.sparkSession
    if version in versions(spark, root, table):
        raise ValueError(f"version {version} of {table} is already there")
    _commit(spark, root, table, df, n_buckets, version, {})
    return f"{_base(root, table)}/manifest/version={version:012d}"


def upsert(events: DataFrame, root: str, table: str, n_buckets: int = BUCKETS, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> Version | None:
    """Rows of ``events`` (the table's columns and its order) put into the table as a new version: the last row of a key wins.

    ``merge(old rows of the touched buckets, events)`` gives those buckets' new
    rows where another rule is wanted (adding up). Returns the new version, or the
    present one if there is no event.
    """
    spark, spec = events.sparkSession, TABLES[table]
    at = manifest(spark, root, table)
    n = at.n_buckets if at else n_buckets
    folders = at.folders if at else {}
    new = stored(events.withColumn("__bucket", _bucket(spec, n)), f"events-{table}")
    touched = {r[0] for r in new.select("__bucket").distinct().collect()}  # at most n numbers
    if not touched:
        return at
    old, new = _rows(spark, root, table, [folders[b] for b in sorted(touched & set(folders))]), new.drop("__bucket")
    merged = merge(old, new) if merge else last_per_key(old.unionByName(new, allowMissingColumns=True), list(spec.keys), list(spec.order))
    return _commit(spark, root, table, merged, n, at.number + 1 if at else 1, {b: f for b, f in folders.items() if b not in touched})


def _bucket_of(spark: SparkSession, spec: Keyed, n_buckets: int, key: dict[str, str]) -> int:
    one = spark.createDataFrame([tuple(key[c] for c in spec.bucket_by)], ", ".join(f"`{c}` string" for c in spec.bucket_by))
    return one.select(_bucket(spec, n_buckets)).first()[0]


def rows_of(spark: SparkSession, root: str, table: str, **key: str) -> DataFrame:
    """The rows whose bucketing columns equal ``key``, read from their bucket alone."""
    spec, at = TABLES[table], manifest(spark, root, table)
    folder = at and at.folders.get(_bucket_of(spark, spec, at.n_buckets, key))
    rows = _rows(spark, root, table, [folder] if folder else [])
    return rows.where(reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()]))


def remove(spark: SparkSession, root: str, table: str, **key: str) -> bool:
    """Take out all rows whose bucketing columns equal ``key`` (I6: one source); whether there were any.

    Reads and writes the one bucket of ``key``; a table without such rows gets no new version.
    """
    spec, at = TABLES[table], manifest(spark, root, table)
    if set(key) != set(spec.bucket_by):
        raise ValueError(f"{table} is bucketed by {', '.join(spec.bucket_by)}")
    if at is None:
        return False
    bucket = _bucket_of(spark, spec, at.n_buckets, key)
    if bucket not in at.folders:
        return False
    rows = _rows(spark, root, table, [at.folders[bucket]])
    gone = reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()])
    if rows.where(gone).isEmpty():
        return False
    _commit(spark, root, table, rows.where(~gone), at.n_buckets, at.number + 1, {b: f for b, f in at.folders.items() if b != bucket})
    return True


def rebucket(spark: SparkSession, root: str, table: str, n_buckets: int) -> Version | None:
    """The newest version, written anew with another number of buckets."""
    at = manifest(spark, root, table)
    return _commit(spark, root, table, read_state(spark, root, table), n_buckets, at.number + 1, {}) if at else None


def insert_leads(batch: DataFrame, root: str, batch_id: str, n_buckets: int = BUCKETS) -> dict[str, int]:
    """Put a batch of leads into the lead table; returns ``inserted, duplicates_skipped, errors``.

    A key that the table holds is skipped, of a key that the batch repeats the
    first row (by ``seq``) counts; rows without company, title or date, or with
    a confidence outside 0 to 100, are errors. Every lead carries its batch and
    the ledger is the version's own rows: a batch that is sent again inserts
    nothing and gets its first counts, also if its first sender died after the
    rows were committed.
    """
    spark, spec = batch.sparkSession, TABLES["leads"]
    names = [f.name for f in S.STATE_SCHEMAS["leads"].fields]
    bad = F.lit(False)
    for c in spec.keys:
        bad = bad | F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    bad = bad | ~F.coalesce(F.col("confidence_score").between(0, 100), F.lit(True))
    rows = stored(batch.withColumn("__bad", bad), "lead-batch")
    total, errors = rows.agg(F.count(F.lit(1)), F.count_if("__bad")).first()
    at = manifest(spark, root, "leads")
    n, folders = (at.n_buckets, at.folders) if at else (n_buckets, {})
    good = rows.where(~F.col("__bad")).withColumn("__bucket", _bucket(spec, n))
    touched = {r[0] for r in good.select("__bucket").distinct().collect()}
    old = _rows(spark, root, "leads", [folders[b] for b in sorted(touched & set(folders))])
    first = last_per_key(good.withColumn("__late", -F.col("seq")), list(spec.keys), ["__late"])
    fresh = stored(first.join(old.select(*spec.keys), list(spec.keys), "left_anti").withColumn("batch_id", F.lit(batch_id)).select(*names, "__bucket"), "lead-rows")
    # buckets that get no row stay as they are
    changed = {r[0] for r in fresh.select("__bucket").distinct().collect()}
    mine = old.where(F.col("batch_id") == batch_id).count()  # rows of this batch from an earlier sending
    if changed:
        here = _rows(spark, root, "leads", [folders[b] for b in sorted(changed & set(folders))])
        _commit(spark, root, "leads", here.unionByName(fresh.drop("__bucket")), n, at.number + 1 if at else 1, {b: f for b, f in folders.items() if b not in changed})
    inserted = mine + fresh.count()
    return {"inserted": inserted, "duplicates_skipped": total - errors - inserted, "errors": errors}
