"""Run telemetry over the search-attempt fact table.

Input columns: seq, ts, search_term, site, batch, success, jobs_found,
duration_ms, http_status, error_type, error_message, error_raw,
challenge_detected, challenge_solved (three states), selectors_tried,
selector_matched.

Everything is a grouped aggregate (partial map-side, then final), so a site
or term holding a third of all attempts is reduced per map task before the
shuffle. Order-dependent results use ``ordering`` helpers instead of a
window over a whole site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .ordering import first_per_key, running_total, streak_summaries
from .runstats import top_counts

def _cnt():
    return F.count(F.lit(1))


def _i(c):
    return c.cast("bigint")


def term_site_pairs(att: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Retries collapse to one search per (run, term, site); numbers only, so the aggregate hashes."""
    blocked = F.col("error_type") == "blocked"
    return att.groupBy(*extra, "run_id", "search_term", "site").agg(
        F.coalesce(F.bool_or("success"), F.lit(False)).alias("ok"),
        F.sum(F.when(F.col("success"), F.col("jobs_found")).otherwise(0)).alias("jobs"),
        F.coalesce(F.bool_or(blocked), F.lit(False)).alias("was_blocked"),
        F.min(F.when(blocked, F.col("seq"))).alias("block_seq"),
        F.max(F.when(~F.col("success"), F.col("seq"))).alias("last_error_seq"),
        F.count_if(~F.col("success")).alias("failed_attempts"),
        F.min("seq").alias("first_seq"),
    )


def site_stats(att: DataFrame, keys: tuple[str, ...] = ("site",)) -> DataFrame:
    """Per site searches attempted / successful, jobs, blocked, blocked term, errors, rate.

    A blocked search is not also an error; an empty result is a success.
    ``keys`` may add ``run_id`` and ``batch``.
    """
    pairs = term_site_pairs(att, tuple(k for k in keys if k not in ("run_id", "search_term", "site")))
    totals = pairs.groupBy(*keys).agg(
        _i(_cnt()).alias("searches_attempted"),
        _i(F.count_if("ok")).alias("searches_successful"),
        _i(F.sum("jobs")).alias("total_jobs_found"),
        F.bool_or("was_blocked").alias("blocked"),
        _i(F.count_if(~F.col("ok") & ~F.col("was_blocked"))).alias("error_count"),
    )
    first = first_per_key(pairs.filter("was_blocked").select(*keys, "block_seq", F.col("search_term").alias("blocked_at_term")), list(keys), "block_seq")
    out = totals.join(first.drop("block_seq"), list(keys), "left")
    return out.select(*keys, "searches_attempted", "searches_successful", "total_jobs_found", "blocked", "blocked_at_term", "error_count",
                      tx.rate_pct("searches_successful", "searches_attempted").alias("success_rate"))


def blocked_sites(att: DataFrame) -> DataFrame:
    """One row per run and blocked site: the first blocking attempt (message masked, cut to 500)."""
    b = att.filter(F.col("error_type") == "blocked").select("run_id", "site", "seq", "search_term", "error_message", "ts")
    first = first_per_key(b, ["run_id", "site"], "seq")
    return first.select(
        "run_id", "site", "search_term",
        tx.truncate_text(F.col("error_message"), 500).alias("error_message"),
        tx.ts_string("ts").alias("timestamp"),
    )


def site_summary(att: DataFrame, more: dict | None = None) -> DataFrame:
    """Attempts, successes, jobs of successes, durations, challenge outcomes, rates; ``more`` adds aggregates."""
    det = F.col("challenge_detected")
    g = att.groupBy("site").agg(
        _i(_cnt()).alias("total_attempts"),
        _i(F.count_if("success")).alias("successful_attempts"),
        _i(F.coalesce(F.sum(F.when(F.col("success"), F.col("jobs_found"))), F.lit(0))).alias("total_jobs"),
        _i(F.sum("duration_ms")).alias("total_duration_ms"),
        _i(F.count_if(det)).alias("cloudflare_encounters"),
        _i(F.count_if(det & (F.col("challenge_solved") == True))).alias("cloudflare_solved"),  # noqa: E712
        _i(F.count_if(det & (F.col("challenge_solved") == False))).alias("cloudflare_failed"),  # noqa: E712
        *[c.alias(n) for n, c in (more or {}).items()],
    )
    return site_rates(g)


def site_rates(g: DataFrame) -> DataFrame:
    """The rates and means of site totals."""
    return g.withColumns(
        {
            "success_rate": tx.rate_pct("successful_attempts", "total_attempts"),
            "avg_duration_ms": _i(F.when(F.col("total_attempts") > 0, F.round(F.col("total_duration_ms") / F.col("total_attempts"))).otherwise(0)),
            "avg_jobs_per_success": F.when(F.col("successful_attempts") > 0,
                                           F.round(F.col("total_jobs") / F.col("successful_attempts"), 1)).otherwise(0.0),
        }
    )


def site_value_counts(att: DataFrame) -> DataFrame:
    """Per site counts of error type, HTTP status (as text) and matched selector; falsy values skipped."""
    kv = F.explode(
        F.array(
            F.struct(F.lit("error_type").alias("kind"), F.col("error_type").alias("key")),
            F.struct(F.lit("http_status").alias("kind"), F.when(F.col("http_status") != 0, F.col("http_status").cast("string")).alias("key")),
            F.struct(F.lit("selector").alias("kind"), F.col("selector_matched").alias("key")),
        )
    )
    rows = att.select("site", kv.alias("kv")).select("site", "kv.kind", "kv.key")
    rows = rows.filter(F.col("key").isNotNull() & (F.col("key") != ""))
    return rows.groupBy("site", "kind", "key").agg(_i(_cnt()).alias("n"))


def term_performance(att: DataFrame) -> DataFrame:
    """Per term attempts, successes, jobs, sorted distinct sites tried / successful / failed, rate."""
    ok = F.col("success")

    def sites(cond=None):
        v = F.col("site") if cond is None else F.when(cond, F.col("site"))
        return F.array_join(F.array_sort(F.collect_set(v)), ",")

    g = att.groupBy("search_term").agg(
        _i(_cnt()).alias("total_attempts"),
        _i(F.count_if(ok)).alias("successful_attempts"),
        _i(F.coalesce(F.sum(F.when(ok, F.col("jobs_found"))), F.lit(0))).alias("total_jobs"),
        sites().alias("sites_tried"),
        sites(ok).alias("sites_successful"),
        sites(~ok).alias("sites_failed"),
    )
    return g.withColumn("success_rate", tx.rate_pct("successful_attempts", "total_attempts"))


def timing_distribution(att: DataFrame) -> DataFrame:
    """Count, min, max, rounded mean and index-rule p50 / p90 / p99 of successful durations > 0.

    Index rule: p50 = sorted[n // 2]; p90 = sorted[int(n * 0.9)] if n >= 10 else
    the maximum; p99 likewise with 100. Computed exactly from a duration
    histogram (pre-aggregated) and its running count by stretches: the value at
    0-based index i is the smallest duration whose running count exceeds i.
    """
    succ = att.filter(F.col("success") & (F.col("duration_ms") > 0))
    return timing_of(succ.groupBy("duration_ms").agg(_cnt().alias("n")))


def timing_of(hist: DataFrame) -> DataFrame:
    """E10 of a histogram (``duration_ms, n``)."""
    cum = running_total(hist, "duration_ms", "n", out="cum", total="total")
    n = F.col("total")
    i50 = F.floor(n / 2)
    i90 = F.when(n >= 10, F.floor(n * 0.9)).otherwise(n - 1)
    i99 = F.when(n >= 100, F.floor(n * 0.99)).otherwise(n - 1)
    d = F.col("duration_ms")
    out = cum.agg(
        _i(F.coalesce(F.sum("n"), F.lit(0))).alias("count"),
        _i(F.min(d)).alias("min_ms"),
        _i(F.max(d)).alias("max_ms"),
        _i(F.round(F.sum(d * F.col("n")) / F.sum("n"))).alias("avg_ms"),
        _i(F.min(F.when(F.col("cum") > i50, d))).alias("p50_ms"),
        _i(F.min(F.when(F.col("cum") > i90, d))).alias("p90_ms"),
        _i(F.min(F.when(F.col("cum") > i99, d))).alias("p99_ms"),
    )
    return out


def errors_by_type(att: DataFrame) -> DataFrame:
    """Failed attempts per type; a missing type counts as 'unknown'."""
    f = att.filter(~F.col("success"))
    return f.groupBy(F.coalesce(F.col("error_type"), F.lit("unknown")).alias("error_type")).agg(_i(_cnt()).alias("n"))


def errors_by_site(att: DataFrame) -> DataFrame:
    """Per site and per (site, type) counts in one ROLLUP; ``level`` 0 = (site, type), 1 = site, 3 = all."""
    f = att.filter(~F.col("success")).withColumn("error_type", F.coalesce(F.col("error_type"), F.lit("unknown")))
    return f.rollup("site", "error_type").agg(_i(_cnt()).alias("n"), _i(F.grouping_id()).alias("level"))


def top_error_messages(att: DataFrame, k: int = 10) -> DataFrame:
    """Frequency of message prefixes (100 characters), top k, ties in first-seen order."""
    f = att.filter(~F.col("success") & F.col("error_message").isNotNull() & (F.col("error_message") != ""))
    f = f.select("seq", tx.truncate_text("error_message", 100).alias("message"))
    return top_counts(f, "message", k).withColumn("n", _i(F.col("n")))


def challenge_analysis(att: DataFrame) -> DataFrame:
    """Encounters, solved (is true), failed (is false), solve rate; NULL counts in neither."""
    c = att.filter(F.col("challenge_detected"))
    g = c.agg(
        _i(_cnt()).alias("total_encounters"),
        _i(F.count_if(F.col("challenge_solved") == True)).alias("solved"),  # noqa: E712
        _i(F.count_if(F.col("challenge_solved") == False)).alias("failed"),  # noqa: E712
    )
    return g.withColumn("solve_rate", tx.rate_pct("solved", "total_encounters"))


def challenge_by_site(att: DataFrame) -> DataFrame:
    """The same per site."""
    c = att.filter(F.col("challenge_detected"))
    return c.groupBy("site").agg(
        _i(_cnt()).alias("encounters"),
        _i(F.count_if(F.col("challenge_solved") == True)).alias("solved"),  # noqa: E712
        _i(F.count_if(F.col("challenge_solved") == False)).alias("failed"),  # noqa: E712
    )


def search_errors(att: DataFrame) -> DataFrame:
    """Search errors: a failed, not blocked (run, term, site) search, typed by its last error."""
    p = term_site_pairs(att).filter(~F.col("ok") & ~F.col("was_blocked")).select("last_error_seq", "failed_attempts")
    last = att.select("seq", "run_id", "search_term", "site", "error_type", "error_message", "error_raw", "exception_class", "ts")
    return last.join(p, last["seq"] == p["last_error_seq"]).select(
        "run_id", "search_term", "site", "error_type",
        tx.truncate_text("error_message", 500).alias("error_message"),
        _i(F.col("failed_attempts")).alias("attempts"),
        tx.ts_string("ts").alias("timestamp"),
        tx.error_context("exception_class", "error_raw").alias("context"),
    ).select("*", "context.*").drop("context")


def error_summary(att: DataFrame) -> DataFrame:
    """Search errors per type, with the total on every row."""
    g = search_errors(att).groupBy("error_type").agg(_i(_cnt()).alias("n"))
    # one row per error type: the window over the aggregate is tiny
    return g.withColumn("total_errors", _i(F.sum("n").over(Window.partitionBy())))


def session_totals(att: DataFrame) -> DataFrame:
    """Per session (one per day): searches, ok, failed, jobs."""
    g = att.groupBy(tx.day_bucket("ts").alias("session_id")).agg(
        _i(_cnt()).alias("searches"),
        _i(F.count_if("success")).alias("ok"),
        _i(F.count_if(~F.col("success"))).alias("failed"),
        _i(F.sum("jobs_found")).alias("jobs"),
    )
    return g


def site_throughput(att: DataFrame) -> DataFrame:
    """Jobs per second per site."""
    g = att.groupBy("site").agg(_i(F.sum("jobs_found")).alias("jobs"), _i(F.sum("duration_ms")).alias("duration_ms"))
    return g.withColumn("jobs_per_second",
                        F.when(F.col("duration_ms") > 0, F.round(F.col("jobs") / (F.col("duration_ms") / 1000.0), 3)).otherwise(0.0))


def selector_performance(att: DataFrame) -> DataFrame:
    """Per (site, selector) times tried and times it was the matched one."""
    e = att.select("site", "selector_matched", F.explode("selectors_tried").alias("selector"))
    return e.groupBy("site", "selector").agg(
        _i(_cnt()).alias("tried"),
        _i(F.count_if(F.col("selector") == F.col("selector_matched"))).alias("matched"),
    )


def postings_per_term(att: DataFrame, postings: DataFrame, expected: int = 20) -> DataFrame:
    """Postings per searched term (0 when none) and, on every row, the average per search
    with its rating: ok at >= 80 % of expected, warning above 0, else failed."""
    terms = att.select("search_term").distinct()
    counts = postings.groupBy("search_term").agg(_cnt().alias("n"))
    j = terms.join(counts, "search_term", "left").withColumn("postings", _i(F.coalesce(F.col("n"), F.lit(0)))).drop("n")
    mean = F.col("__mean")
    rated = j.withColumn("__mean", j.agg(F.avg("postings")).scalar())
    status = F.when(mean >= 0.8 * expected, F.lit("ok")).when(mean > 0, F.lit("warning")).otherwise(F.lit("failed"))
    return rated.select("search_term", "postings", F.round(mean, 1).alias("avg_postings"), status.alias("status"))


def description_fill_rate(postings: DataFrame) -> DataFrame:
    """Share of postings with a description longer than 50 characters, per search term."""
    filled = F.when(F.length("description") > 50, 1).otherwise(0)
    g = postings.groupBy("search_term").agg(_i(_cnt()).alias("postings"), _i(F.sum(filled)).alias("filled"))
    return g.withColumn("fill_rate", tx.rate_pct("filled", "postings"))


def search_consistency(att: DataFrame) -> DataFrame:
    """Over searches without error, per site: mean / min / max time, spread and its rating,
    reliability from the fill value (jobs found) of each search."""
    s = att.filter(F.col("success"))
    g = s.groupBy("site").agg(
        _i(_cnt()).alias("searches"),
        F.round(F.avg("duration_ms"), 1).alias("avg_ms"),
        _i(F.min("duration_ms")).alias("min_ms"),
        _i(F.max("duration_ms")).alias("max_ms"),
        F.round(F.avg("jobs_found"), 1).alias("avg_fill"),
        _i(F.min("jobs_found")).alias("min_fill"),
        _i(F.max("jobs_found")).alias("max_fill"),
        F.bool_and(F.col("jobs_found") >= 60).alias("all_filled"),
    )
    spread = F.col("max_ms") - F.col("min_ms")
    ratio = F.when(F.col("avg_ms") > 0, spread / F.col("avg_ms"))
    return g.select(
        "site", "searches", "avg_ms", "min_ms", "max_ms", _i(spread).alias("spread_ms"),
        "avg_fill", "min_fill", "max_fill", _i(F.col("max_fill") - F.col("min_fill")).alias("fill_range"),
        F.when(ratio < 0.3, "consistent").when(ratio < 0.5, "moderate").otherwise("variable").alias("timing_rating"),
        F.when(F.col("all_filled"), "reliable").when(F.col("avg_fill") >= 60, "mostly_reliable").otherwise("unreliable").alias("reliability"),
    )


def slowdown_check(att: DataFrame, factor: float = 2.0) -> DataFrame:
    """Per search (run, term, site): first fetch time against the mean of the later ones; flag throttling."""
    g = att.groupBy("run_id", "site", "search_term").agg(
        F.min_by("duration_ms", "seq").alias("first_ms"),
        F.sum("duration_ms").alias("sum_ms"),
        _cnt().alias("n"),
    )
    later = F.when(F.col("n") > 1, F.round((F.col("sum_ms") - F.col("first_ms")) / (F.col("n") - 1), 1))
    return g.select(
        "run_id", "site", "search_term", _i(F.col("first_ms")).alias("first_ms"), later.alias("later_avg_ms"),
        F.coalesce(later > factor * F.col("first_ms"), F.lit(False)).alias("throttled"),
    )


def variant_comparison(att: DataFrame, variant_col: str = "site") -> DataFrame:
    """Success rate and mean time per collection variant; best by rate, first seen wins a tie."""
    g = att.groupBy(F.col(variant_col).alias("variant")).agg(
        _i(_cnt()).alias("attempts"),
        tx.rate_pct(F.count_if("success"), _cnt()).alias("success_rate"),
        F.round(F.avg("duration_ms"), 1).alias("avg_ms"),
        F.min("seq").alias("first_seq"),
    )
    # one row per variant: the ranking window is tiny
    rank = F.row_number().over(Window.orderBy(F.col("success_rate").desc(), F.col("first_seq").asc()))
    return g.withColumn("is_best", rank == 1).drop("first_seq")


def health_alerts(att: DataFrame, min_jobs_per_search: float = 50, min_success: float = 80, min_solve: float = 70) -> DataFrame:
    """One row per (site, alert) crossing a documented threshold."""
    j = site_summary(att, {"blocked": F.coalesce(F.bool_or(F.col("error_type") == "blocked"), F.lit(False))})
    jobs_per_search = F.col("total_jobs") / F.col("total_attempts")
    solve = F.when(F.col("cloudflare_encounters") > 0, F.col("cloudflare_solved") / F.col("cloudflare_encounters") * 100)
    alerts = F.array(
        F.when(jobs_per_search < min_jobs_per_search, F.lit("low_yield")),
        F.when(F.col("success_rate") < min_success, F.lit("low_success")),
        F.when(solve < min_solve, F.lit("challenge_failures")),
        F.when(F.col("blocked"), F.lit("blocked")),
    )
    return j.select("site", F.explode(F.array_compact(alerts)).alias("alert"))


def retry_number(att: DataFrame, tries: int = 2) -> DataFrame:
    """0-based try number within a search (run, term, site). A series of tries ends
    with a success or after ``tries`` tries; the next attempt begins a new series."""
    search = ["run_id", "search_term", "site"]
    before = Window.partitionBy(*search).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(F.col("success").cast("int")).over(before), F.lit(0))
    rows = att.select("seq", *search, "success").withColumn("__ended", ended)
    place = F.row_number().over(Window.partitionBy(*search, "__ended").orderBy("seq")) - 1
    return rows.select("seq", *search, _i(place % tries).alias("retry_number"))


def circuit_breaker(att: DataFrame) -> DataFrame:
    """once a site is blocked, its later attempts of the same run would be skipped.

    The first blocking seq is an aggregate (one row per run and site), joined
    back; no window runs over a whole site.
    """
    keys = ["run_id", "site"]
    first_block = att.filter(F.col("error_type") == "blocked").groupBy(*keys).agg(F.min("seq").alias("block_seq"))
    j = att.select("seq", *keys).join(first_block, keys, "left")
    return j.select("seq", *keys, F.coalesce(F.col("seq") > F.col("block_seq"), F.lit(False)).alias("skipped"))


def failure_streak(att: DataFrame, cut: int = 3) -> DataFrame:
    """per site, consecutive failed attempts (gaps and islands) in arrival order:
    the longest streak and the seq at which a streak first reaches ``cut``.

    Summaries of stretches of the arrival order are merged (``ordering.streak_summaries``),
    so attempts are read once and a site that holds all of them is spread over tasks.
    A try whose outcome is unknown ends a streak; sites without a failure have no row.
    """
    found = streak_summaries(att, ["site"], ~F.col("success"), cut)
    return found.where("s.longest > 0").select("site", F.col("s.longest").alias("longest_streak"), F.col("s.cut_at").alias("cut_seq"))


def description_quota(postings: DataFrame, quota: int = 10) -> DataFrame:
    """a posting gets a description slot while its term has fetched fewer than ``quota`` descriptions.

    The slots end with the term's quota-th posting that has a description: a
    group limit keeps ``quota`` rows per term and task, one row per term is joined back.
    """
    rows = postings.select("seq", "search_term", (F.length("description") > 0).alias("__has"))
    w = Window.partitionBy("search_term").orderBy("seq")
    fetched = rows.filter("__has").withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= quota)
    ends = fetched.groupBy("search_term").agg(F.max("seq").alias("__end"), F.max("__rn").alias("__n")).filter(F.col("__n") == quota)
    j = rows.join(ends.drop("__n"), "search_term", "left")
    return j.select("seq", "search_term", F.coalesce(F.col("seq") <= F.col("__end"), F.lit(True)).alias("gets_description"))


def sample_per_term(postings: DataFrame, k: int = 2) -> DataFrame:
    """the first k postings of each term (row_number <= k is planned with a
    partial WindowGroupLimit before the shuffle, so a hot term sends k rows per task)."""
    w = Window.partitionBy("search_term").orderBy("seq")
    return postings.select("seq", "search_term", "title").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).withColumn("rn", _i(F.col("rn")))


def phase_breakdown(fetches: DataFrame, phase_cols: list[str]) -> DataFrame:
    """Mean time per phase of a fetch and its share of the mean total.

    ``fetches`` has one row per fetch and one duration column per phase; the
    phases are unpivoted (one row per fetch and phase) and aggregated.
    """
    long = fetches.unpivot([], phase_cols, "phase", "ms")
    g = long.groupBy("phase").agg(F.avg("ms").alias("avg_ms"), F.sum("ms").alias("__sum"))
    share = F.when(F.sum("__sum").over(Window.partitionBy()) > 0,
                   F.round(F.col("__sum") / F.sum("__sum").over(Window.partitionBy()) * 100, 1)).otherwise(0.0)
    # one row per phase: the window over the aggregate is tiny
    return g.select("phase", F.round("avg_ms", 1).alias("avg_ms"), share.alias("share_pct"))


def search_phases(att: DataFrame) -> DataFrame:
    """Per search (run, term, site): time of the first try and time spent in retries."""
    g = att.groupBy("run_id", "search_term", "site").agg(
        F.min_by("duration_ms", "seq").alias("first_try_ms"), F.sum("duration_ms").alias("__all"))
    return g.select("run_id", "search_term", "site", F.col("first_try_ms").cast("double").alias("first_try_ms"),
                    (F.col("__all") - F.col("first_try_ms")).cast("double").alias("retries_ms"))


def alias_sites(att: DataFrame, aliases: dict[str, str], col: str = "site") -> DataFrame:
    """Q15: one board known under two names counts as one site (optional, none by default).

    ``aliases`` maps a spelling to its canonical name; it is a literal map (the
    option's size, not the data's), applied per row before any grouping.
    """
    if not aliases:
        return att
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return att.withColumn(col, F.coalesce(F.element_at(m, F.col(col)), F.col(col)))


def searched_terms(att: DataFrame, cut: int = 3, more: tuple = ()) -> DataFrame:
    """The terms of each run in search order, with the streak of terms without any posting that ends at a term
    (0 for a term with postings) and the seq at which a streak of the run first reaches ``cut``.

    One aggregate (``more`` adds to it), then windows over the few terms of a run.
    """
    terms = att.groupBy("run_id", "search_term").agg(
        F.min("seq").alias("seq"),
        F.coalesce(F.bool_or(F.col("success") & (F.col("jobs_found") > 0)), F.lit(False)).alias("has_result"),
        *more,
    )
    order = Window.partitionBy("run_id").orderBy("seq")
    island = terms.withColumn("__island", F.sum(F.col("has_result").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inside = F.sum((~F.col("has_result")).cast("int")).over(Window.partitionBy("run_id", "__island").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    streaks = island.withColumn("streak", inside).drop("__island")
    return streaks.withColumn("cut_seq", F.min(F.when(F.col("streak") >= cut, F.col("seq"))).over(Window.partitionBy("run_id")))


def term_failure_streak(att: DataFrame, cut: int = 3) -> DataFrame:
    """F7 (run level): a term without any posting extends the streak of result-less
    terms, a term with results ends it; the run is cut where a streak first reaches
    ``cut``. One row per run: number of terms, longest streak, the seq of the term
    that reached the cut (NULL if none).
    """
    return searched_terms(att, cut).groupBy("run_id").agg(
        _i(_cnt()).alias("terms"), _i(F.max("streak")).alias("longest_streak"), F.min("cut_seq").alias("cut_seq"))


def run_progress(att: DataFrame, planned: DataFrame, cut: int = 3) -> DataFrame:
    """E5 per run: terms planned (``run_id``, ``search_term``), planned terms completed before the
    stop rule (F7: the run ends at the term where ``cut`` result-less terms in a row are
    reached, that term included), completion rate and time span of the run's searches."""
    done = searched_terms(att, cut, (F.min("ts").alias("start"), F.max("ts").alias("end"))).select(
        "run_id", "search_term", "start", "end", (F.col("cut_seq").isNull() | (F.col("seq") <= F.col("cut_seq"))).alias("done"))
    plan = planned.select("run_id", "search_term", F.lit(True).alias("planned"))
    g = done.join(plan, ["run_id", "search_term"], "full").groupBy("run_id").agg(
        _i(F.count_if("planned")).alias("search_terms_total"),
        _i(F.count_if(F.col("planned") & F.col("done"))).alias("search_terms_completed"),
        tx.ts_string(F.min("start")).alias("start_time"), tx.ts_string(F.max("end")).alias("end_time"),
    )
    return g.withColumn("completion_rate", tx.rate_pct("search_terms_completed", "search_terms_total"))
