"""Streams over several files equal the batch results, whatever the order of the files; later runs remember."""

from datetime import datetime, timedelta

from tables import SF_SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from postsift.operators.ordering import first_per_key
from postsift.streaming import streams as ss


def _write_batches(spark, rows, schema, path, n_files):
    """Rows dealt over the files by position, so that files overlap in time and companies."""
    for i in range(n_files):
        spark.createDataFrame(rows[i::n_files], schema).coalesce(1).write.mode("append").parquet(path)


def _source(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_new_companies_across_batches_and_runs(spark, tmp_dir):
    rows = [(59 - i, f"Co{i % 7}", f"title {i}") for i in range(60)] + [(100, None, "x"), (101, "", "y")]
    schema = "seq long, company string, title string"
    path, state = f"{tmp_dir}/postings", f"{tmp_dir}/state"
    _write_batches(spark, rows, schema, path, 4)
    got = sorted(tuple(r) for r in ss.stream_new_companies(spark, _source(spark, schema, path), state, "r1").select("company", "seq", "title").collect())
    want = first_per_key(spark.createDataFrame(rows, schema).filter("company <> ''"), ["company"], "seq")
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) == 7
    # started again, the run emits the same; a later run emits only companies it does not know
    again = ss.stream_new_companies(spark, _source(spark, schema, path), state, "r1")
    assert sorted(r["company"] for r in again.collect()) == [f"Co{i}" for i in range(7)]
    more = [(200, "Co1", "t"), (202, "New", "late"), (201, "New", "early")]
    later = f"{tmp_dir}/later"
    _write_batches(spark, more, schema, later, 3)
    second = ss.stream_new_companies(spark, _source(spark, schema, later), state, "r2").collect()
    assert [(r["company"], r["seq"]) for r in second] == [("New", 201)]


def test_a_run_reads_its_input_and_no_part_of_earlier_runs(spark, tmp_dir):
    schema, state = "seq long, company string, title string", f"{tmp_dir}/state"
    for run in range(3):
        path = f"{tmp_dir}/in{run}"
        _write_batches(spark, [(1000 - run * 100 - i, f"Co{i + 3 * run}", "t") for i in range(6)], schema, path, 2)
        new = ss.stream_new_companies(spark, _source(spark, schema, path), state, f"r{run}")
        assert sorted(r["company"] for r in new.collect()) == sorted(f"Co{i}" for i in range(0 if run == 0 else 3 + 3 * run, 6 + 3 * run))
        assert all(f"run=r{run}/" in f for f in new.inputFiles())


def test_site_health_over_sixty_days_touches_the_windows_of_its_rows(spark, tmp_dir):
    from postsift.sources import state_store

    schema, state, t0 = "ts timestamp_ntz, site string, success boolean, error_type string", f"{tmp_dir}/health", datetime(2026, 1, 1)
    rows = [(t0 + timedelta(hours=2 * i), ["a", "b", "c"][i % 3], i % 4 > 0, "blocked" if i % 8 == 0 else None) for i in range(720)]
    _write_batches(spark, rows, schema, f"{tmp_dir}/in", 3)
    first = ss.stream_site_health(spark, _source(spark, schema, f"{tmp_dir}/in"), state_path=state)
    assert first.count() == 180 and first.agg(F.sum("attempts")).first()[0] == 720
    at = state_store.manifest(spark, state, "site_health")
    # one late and one new row: two windows and the marker are written, the others stay
    late = [(t0 + timedelta(hours=1), "a", True, None), (t0 + timedelta(days=60), "z", False, "blocked")]
    _write_batches(spark, late, schema, f"{tmp_dir}/in", 2)
    second = {(r["window_start"], r["site"]): (r["attempts"], r["successes"], r["blocks"]) for r in ss.stream_site_health(spark, _source(spark, schema, f"{tmp_dir}/in"), state_path=state).collect()}
    now = state_store.manifest(spark, state, "site_health")
    assert sum(now.folders.get(b) != f for b, f in at.folders.items()) <= 3 and now.number == at.number + 1
    want = {}
    for ts, site, ok, kind in rows + late:
        k = (ts.strftime("%Y-%m-%d 00:00:00"), site)
        n, s, blk = want.get(k, (0, 0, 0))
        want[k] = (n + 1, s + ok, blk + (kind == "blocked"))
    assert second == want
    # a run without new files adds nothing
    again = ss.stream_site_health(spark, _source(spark, schema, f"{tmp_dir}/in"), state_path=state)
    assert again.agg(F.sum("attempts")).first()[0] == 722 and state_store.manifest(spark, state, "site_health").number == now.number


def test_site_health_counts_rows_in_any_order(spark, tmp_dir):
    t0 = datetime(2026, 1, 1)
    rows = [(i, t0 + timedelta(hours=3 * i), ["a", "b"][i % 2], i % 5 != 0, None if i % 5 else "blocked") for i in range(80)]
    schema = "seq long, ts timestamp_ntz, site string, success boolean, error_type string"
    path = f"{tmp_dir}/attempts"
    _write_batches(spark, rows[::-1], schema, path, 5)
    got = {(r["window_start"], r["site"]): (r["attempts"], r["successes"], r["blocks"]) for r in ss.stream_site_health(spark, _source(spark, schema, path)).collect()}
    df = spark.createDataFrame(rows, schema)
    want = {
        (r["d"], r["site"]): (r["n"], r["ok"], r["blk"])
        for r in df.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("d"), "site")
        .agg(F.count("*").alias("n"), F.count_if("success").alias("ok"), F.count_if(F.col("error_type") == "blocked").alias("blk"))
        .collect()
    }
    assert got == want


def test_registered_streams_read_tables_of_several_files(spark, tmp_dir):
    for t, key in (("documents", "doc_id"), ("events", "event_id")):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(4, key).write.parquet(f"{tmp_dir}/{t}.parquet")
    for key in ("stream_score", "stream_new_companies", "stream_site_health"):
        one, four = (sorted(map(repr, queries()[key](spark, d).collect())) for d in (SF_SMALL, tmp_dir))
        assert one == four and one
