"""Structured Streaming variants.

* ``stream_score``          readStream -> the same scoring columns -> qualified rows (append).
* ``stream_new_companies``  first posting per company that no earlier run has
  emitted; the state store remembers the companies of all runs.
* ``stream_site_health``    attempts per site in tumbling event-time windows:
  counts per micro-batch, added to a table in buckets by window, so late rows count.

Sinks and state live under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), never on a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import RuleSet
from ..operators import scoring as sc
from ..operators.ordering import first_per_key
from ..session import ensure_checkpoint_dir, table_exists
from ..sources import state_store


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/postsift-stream/{name}-{uuid.uuid4().hex[:12]}"


def stream_score(stream_df: DataFrame, rules: RuleSet) -> DataFrame:
    """A streaming postings frame -> its qualified rows with the scoring columns."""
    return sc.qualified_postings(sc.score_postings(stream_df, rules))


def run_to_table(spark: SparkSession, stream_df: DataFrame, name: str, output_mode: str = "append") -> str:
    """Run a stream until its input is consumed (availableNow) into a Parquet folder; returns the path."""
    base = work_dir(spark, name)
    q = (
        stream_df.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ckpt")
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return f"{base}/out"


def _run_number(spark: SparkSession, root: str, run_id: str) -> int:
    """The place of a run among the runs that were started on a state path; one row a run."""
    path = f"{root}/runs"
    known = {r["run"]: r["number"] for r in spark.read.schema("run string, number long").json(path).collect()} if table_exists(spark, path, "json") else {}
    if run_id not in known:
        known[run_id] = len(known)
        spark.createDataFrame([(run_id, known[run_id])], "run string, number long").coalesce(1).write.mode("append").json(path)
    return known[run_id]


def stream_new_companies(spark: SparkSession, stream_df: DataFrame, state_path: str, run_id: str,
                         key: str = "company", order_col: str = "seq") -> DataFrame:
    """The first posting (smallest ``order_col``) of each company that no earlier run has emitted.

    Two streams: a run's own one writes the smallest row per company of each
    micro-batch to a feed below ``state_path`` (a replayed batch overwrites its
    part); the second, which all runs go on with, takes the feed's new files into
    a streaming aggregate. Its state store holds, per company, the number of the
    run that met it first and that run's smallest row, so a run looks up the
    companies of its input and reads nothing else of its history. Companies that
    changed are written per micro-batch, those of earlier runs left out; the
    result is the smallest row over the run's own parts. It does not depend on
    how files fall into batches, and a run that is started again emits the same
    companies. The state store's number of partitions is that of the first run.
    """
    root = state_path.rstrip("/")
    number, parts = _run_number(spark, root, run_id), f"{root}/parts/run={run_id}"
    others = [c for c in stream_df.columns if c not in (key, order_col)]
    fed = f"{root}/feed"

    def feed(batch: DataFrame, batch_id: int) -> None:
        rows = first_per_key(batch.filter(F.col(key).isNotNull() & (F.col(key) != "")), [key], order_col)
        # of a company's rows those of its first run count, of these the one of the smallest order
        ranked = rows.select(key, F.struct(F.lit(number).alias("run"), F.col(order_col), *[F.col(c) for c in others]).alias("row"))
        ranked.write.mode("overwrite").parquet(f"{fed}/part={number}-{batch_id}")

    def changed(batch: DataFrame, batch_id: int) -> None:
        batch.filter(F.col("row.run") == number).select(key, F.col(f"row.{order_col}").alias(order_col), *[F.col(f"row.{c}").alias(c) for c in others]) \
            .write.mode("overwrite").parquet(f"{parts}/batch_id={batch_id}")

    q = stream_df.writeStream.foreachBatch(feed).option("checkpointLocation", f"{root}/checkpoints/{run_id}").trigger(availableNow=True).start()
    q.awaitTermination()
    if not table_exists(spark, fed):
        return spark.createDataFrame([], stream_df.schema)
    row = ", ".join(f"`{c}` {stream_df.schema[c].dataType.simpleString()}" for c in (order_col, *others))
    ranked = spark.readStream.schema(f"`{key}` {stream_df.schema[key].dataType.simpleString()}, row struct<run: int, {row.replace('` ', '`: ')}>").parquet(fed)
    first = ranked.groupBy(key).agg(F.min("row").alias("row"))
    q = first.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    if not table_exists(spark, parts):
        return spark.createDataFrame([], stream_df.schema)
    return first_per_key(spark.read.schema(stream_df.schema).parquet(parts), [key], order_col).select(*stream_df.columns)


HEALTH_COUNTS = ("attempts", "successes", "blocks")


def site_health_counts(attempts: DataFrame, window: str = "1 day") -> DataFrame:
    """Attempts, successes and blocks per site in tumbling event-time windows."""
    # windows need TIMESTAMP; a wall-clock (NTZ) column is read in the session time zone
    ev = attempts.withColumn("ts", F.col("ts").cast("timestamp"))
    w = ev.groupBy(F.window("ts", window).alias("w"), "site").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("success").alias("successes"),
        F.count_if(F.col("error_type") == "blocked").alias("blocks"),
    )
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "site", *[F.col(c).cast("bigint").alias(c) for c in HEALTH_COUNTS])


def stream_site_health(spark: SparkSession, stream_df: DataFrame, window: str = "1 day", state_path: str | None = None) -> DataFrame:
    """The stream's window counts with their success rate.

    A micro-batch writes its own counts per window and site (a replayed batch
    overwrites its own). At the end of a run the new batches' counts are added to
    the stored ones: a table in buckets by window (``sources.state_store``), of
    which only the windows that got rows are read and written, early or late.
    Old windows cost nothing and no row is too late. The last batch that was added
    is a row of the same version, so a run that dies in between adds nothing twice.
    """
    base = (state_path or work_dir(spark, "site-health")).rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        site_health_counts(batch, window).write.mode("overwrite").parquet(f"{base}/counts/batch_id={batch_id}")

    q = stream_df.writeStream.foreachBatch(handle).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    _add_counts(spark, base)
    total = state_store.read_state(spark, base, "site_health").filter(F.col("window_start") != ADDED)
    return total.select("window_start", "site", "attempts", "successes",
                        F.round(F.col("successes") / F.col("attempts") * 100, 1).alias("success_rate"), "blocks")


# The row that tells the last added batch (as its number of attempts).
ADDED = "added"


def _add_counts(spark: SparkSession, base: str) -> None:
    """Counts of the batches that are not yet in the table, added to it as one version."""
    done = state_store.rows_of(spark, base, "site_health", window_start=ADDED).first()
    last = done["attempts"] if done else -1
    if not table_exists(spark, f"{base}/counts"):
        return
    schema = "window_start string, site string, " + ", ".join(f"{c} bigint" for c in HEALTH_COUNTS) + ", batch_id bigint"
    # partition pruning: parts of batches that were added are not read
    fresh = spark.read.schema(schema).option("basePath", f"{base}/counts").parquet(f"{base}/counts").filter(F.col("batch_id") > last)
    newest = fresh.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return
    counts = fresh.drop("batch_id").groupBy("window_start", "site").agg(*[F.sum(c).alias(c) for c in HEALTH_COUNTS])
    marker = spark.createDataFrame([(ADDED, None, newest, 0, 0)], counts.schema)

    def add(old: DataFrame, new: DataFrame) -> DataFrame:
        kept = old.filter(F.col("window_start") != ADDED).unionByName(new.filter(F.col("window_start") != ADDED))
        return kept.groupBy("window_start", "site").agg(*[F.sum(c).alias(c) for c in HEALTH_COUNTS]).unionByName(new.filter(F.col("window_start") == ADDED))

    state_store.upsert(counts.unionByName(marker), base, "site_health", merge=add)
