"""Batch slicing, exact numbering and index-rule percentiles against plain Python."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postsift.operators import attempts as at
from postsift.operators import ordering
from postsift.operators.merging import merge_site_stats
from postsift.operators.ordering import batch_slice, first_per_key, row_numbers, select_batch


def py_slice(items, batch, total):
    size, rem = len(items) // total, len(items) % total
    start = batch * size + min(batch, rem)
    return items[start:start + size + (1 if batch < rem else 0)]


@pytest.mark.parametrize("n,k", [(65, 4), (10, 4), (8, 4), (3, 5), (1, 1), (0, 3), (100, 7)])
def test_batch_slice_matches_reference_rule(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "seq")
    got = {}
    for r in batch_slice(df, k).collect():
        got.setdefault(r["batch"], []).append(r["seq"])
    for b in range(k):
        assert sorted(got.get(b, [])) == py_slice(list(range(n)), b, k)


def test_batch_sizes_65_4(spark):
    df = spark.range(65).withColumnRenamed("id", "seq")
    sizes = [r["c"] for r in batch_slice(df, 4).groupBy("batch").agg(F.count("*").alias("c")).orderBy("batch").collect()]
    assert sizes == [17, 16, 16, 16]


def test_batch_argument_errors(spark):
    df = spark.range(3).withColumnRenamed("id", "seq")
    for b, k in [(0, 0), (-1, 2), (2, 2)]:
        with pytest.raises(ValueError):
            select_batch(df, b, k)


def test_row_numbers_equal_window(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 2).alias("h"))
    mine = row_numbers(df, ["g", "h"], "seq", out="rn")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g", "h").orderBy("seq")))
    assert sorted(mine.select("seq", "rn").collect()) == sorted(ref.select("seq", "rn").collect())


def test_first_per_key(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, "b", "z")], "seq long, k string, v string")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], "seq").collect()) == [("a", 1, "y"), ("b", 2, "z")]


def py_timing(durs):
    d = sorted(durs)
    if not d:
        return 0, None, None, None
    n = len(d)
    return n, d[n // 2], d[int(n * 0.9)] if n >= 10 else d[-1], d[int(n * 0.99)] if n >= 100 else d[-1]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 99, 100, 257])
def test_timing_index_rule(spark, n):
    durs = [(i * 37) % 101 + 1 for i in range(n)]
    rows = [(i, True, d) for i, d in enumerate(durs)] + [(n + 1, False, 5), (n + 2, True, 0)]
    df = spark.createDataFrame(rows, "seq long, success boolean, duration_ms long")
    r = at.timing_distribution(df).first()
    assert (r["count"], r["p50_ms"], r["p90_ms"], r["p99_ms"]) == py_timing(durs)


def test_term_failure_streak_cuts_at_three(spark):
    # run r1: ok, fail, fail, fail (cut at seq 40), fail, ok; run r2: always ok
    outcome = [True, False, False, False, False, True]
    rows = [("r1", f"t{i}", (i + 1) * 10, ok, 5 if ok else 0) for i, ok in enumerate(outcome)]
    rows += [("r2", f"u{i}", 100 + i, True, 1) for i in range(3)]
    # retries of a term do not change its outcome unless one of them finds postings
    rows += [("r1", "t1", 11, True, 0)]
    df = spark.createDataFrame(rows, "run_id string, search_term string, seq long, success boolean, jobs_found long")
    got = {r["run_id"]: (r["terms"], r["longest_streak"], r["cut_seq"]) for r in at.term_failure_streak(df).collect()}
    assert got == {"r1": (6, 4, 40), "r2": (3, 0, None)}


def test_run_progress_stops_at_the_cut(spark):
    from datetime import datetime

    outcome = [True, False, False, False, False, True]
    rows = [("r1", f"t{i}", (i + 1) * 10, ok, 5 if ok else 0, datetime(2026, 1, 1, i)) for i, ok in enumerate(outcome)]
    df = spark.createDataFrame(rows, "run_id string, search_term string, seq long, success boolean, jobs_found long, ts timestamp_ntz")
    planned = spark.createDataFrame([("r1", f"t{i}") for i in range(8)] + [("r2", "t0")], "run_id string, search_term string")
    r1, r2 = at.run_progress(df, planned).orderBy("run_id").collect()
    # eight terms planned, six searched, the fourth ends the run
    assert (r1["search_terms_total"], r1["search_terms_completed"], r1["completion_rate"]) == (8, 4, 50.0)
    assert (r2["search_terms_total"], r2["search_terms_completed"], r2["completion_rate"]) == (1, 0, 0.0)


def test_row_numbers_with_clustered_keys(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1990, F.col("id")).otherwise(F.col("id") * 10**9).alias("seq"))
    mine = row_numbers(df, [], "seq", out="rn")
    assert [r["rn"] for r in mine.orderBy("seq").collect()] == list(range(1, 2001))


ATTEMPT = "run_id string, search_term string, site string, seq long, success boolean, error_type string, jobs_found long, error_message string, ts timestamp_ntz, batch int"


def _attempts(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(run, "t", site, seq, ok, err, 1, err, datetime(2026, 1, 1), 0) for run, site, seq, ok, err in rows], ATTEMPT)


def test_blocks_end_with_their_run(spark):
    df = _attempts(spark, [("r1", "a", 1, False, "blocked"), ("r1", "a", 2, True, None), ("r2", "a", 3, True, None), ("r2", "b", 4, False, "blocked")])
    assert {r["seq"]: r["skipped"] for r in at.circuit_breaker(df).collect()} == {1: False, 2: True, 3: False, 4: False}
    assert sorted((r["run_id"], r["site"]) for r in at.blocked_sites(df).collect()) == [("r1", "a"), ("r2", "b")]
    assert {(r["run_id"], r["site"]): r["blocked"] for r in merge_site_stats(at.site_stats(df, ("batch", "run_id", "site")), ("run_id", "site")).collect()} == {("r1", "a"): True, ("r2", "a"): False, ("r2", "b"): True}


def test_a_series_of_tries_ends_with_a_success_or_after_two(spark):
    df = _attempts(spark, [("r", "a", i, ok, None) for i, ok in enumerate([False, True, True, False, False, False, True])])
    got = [r["retry_number"] for r in at.retry_number(df).orderBy("seq").collect()]
    assert got == [0, 1, 0, 0, 1, 0, 1]


def test_description_quota_counts_descriptions(spark):
    rows = [(i, "t", None if i % 2 else "text") for i in range(10)] + [(20 + i, "u", "x") for i in range(2)]
    got = {r["seq"]: r["gets_description"] for r in at.description_quota(spark.createDataFrame(rows, "seq long, search_term string, description string"), 3).collect()}
    # the third description of t is at 4
    assert [got[i] for i in range(10)] == [True] * 5 + [False] * 5 and got[21]


def py_streaks(tries, cut):
    """site -> longest run of failures and the place where a run first reaches ``cut``, by a walk."""
    out = {}
    for site in {s for _, s, _ in tries}:
        run, longest, cut_at = 0, 0, None
        for seq, _, ok in sorted(t for t in tries if t[1] == site):
            run = run + 1 if ok is False else 0
            longest = max(longest, run)
            if run == cut and cut_at is None:
                cut_at = seq
        if longest:
            out[site] = (longest, cut_at)
    return out


@pytest.mark.parametrize("width,cut", [(2, 1), (2, 3), (3, 4), (7, 3), (4096, 3), (5, 40)])
def test_streaks_over_stretches(spark, width, cut):
    from random import Random

    draw = Random(width * 100 + cut)
    tries, seq = [], 0
    for k in range(600):
        seq += draw.choice([1, 1, 1, 2, 9])
        site = draw.choice(["hot"] * 5 + ["a", "b", None])
        ok = draw.random() < (0.1 if 200 < k < 300 else 0.5)
        tries.append((seq, site, None if draw.random() < 0.02 else ok))
    tries += [(10_000 + k, "long", False) for k in range(100)] + [(20_000 + k, "fine", True) for k in range(10)]
    df = spark.createDataFrame(tries, "seq long, site string, success boolean").repartition(5)
    got = ordering.streak_summaries(df, ["site"], ~F.col("success"), cut, width=width).where("s.longest > 0").collect()
    assert {r["site"]: (r["s"]["longest"], r["s"]["cut_at"]) for r in got} == py_streaks([(q, s, ok) for q, s, ok in tries], cut)


def test_one_site_is_spread_over_groups(spark):
    df = spark.range(50_000).select(F.col("id").alias("seq"), F.lit("one").alias("site"), (F.col("id") % 5000 != 4999).alias("bad"))
    p = ordering.streak_summaries(df, ["site"], F.col("bad"), 3)
    assert p.first()["s"]["longest"] == 4999
    plan = p._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Range (0, 50000") == 1 and "Window" not in plan


def test_running_total_equals_window(spark):
    hist = spark.createDataFrame([(v * v % 7919, v % 5 + 1) for v in range(1, 500)], "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    mine = ordering.running_total(hist, "v", "n", out="cum", total="all", width=100)
    ref = hist.withColumn("cum", F.sum("n").over(Window.orderBy("v"))).withColumn("all", F.sum("n").over(Window.partitionBy()))
    assert sorted(mine.select("v", "n", "cum", "all").collect()) == sorted(ref.select("v", "n", "cum", "all").collect())


def test_rejected_rows_are_scored_once(spark):
    from postsift.operators import leads

    scored = spark.range(1000).select(
        F.col("id").alias("seq"), F.concat(F.lit("c"), F.col("id") % 7).alias("company"), F.lit("t").alias("title"), F.repeat(F.lit("x"), 3000).alias("description"),
        F.lit("unknown").alias("rejection_category"), F.lit(1.5).alias("score"), F.expr("id % 3 = 0 AND assert_true(id < 1000) IS NULL").alias("qualified"))
    count = spark.sparkContext.accumulator(0)
    seen = spark.createDataFrame(scored.rdd.map(lambda r: (count.add(1), r)[1]), scored.schema)
    ids = {r["seq"]: r["id"] for r in leads.rejected_ids(seen).collect()}
    assert count.value == 1000
    wanted = [k for k in range(1000) if k % 3]
    assert ids == {k: f"rejected_{n:03d}_c{k % 7}" for n, k in enumerate(wanted, 1)}
    full = leads.rejected_postings(scored, None).collect()
    assert {r["seq"]: r["id"] for r in full} == ids and {len(r["description"]) for r in full} == {2000}
