"""Order-dependent building blocks that stay distributed and skew-safe.

* ``first_per_key`` / ``last_per_key``  the first or last row of each key by a
  group limit: Spark keeps one row per key in every task before the shuffle,
  so a key holding a third of all rows sends one row per task, and the input
  is read once.
* ``row_numbers``    exact 1-based numbering without a window over a whole
  group. One range shuffle by (group, order) spreads a hot group over many
  partitions; sorted partitions are written with each row's partition and
  place, so what is left is one row per group and partition: its first place
  and its count, and the running sum of the counts before it.
* ``running_total``  running sums over a histogram of whole numbers, cut into
  stretches of equal width: the sums of the stretches before, then inside one.
* ``streak_summaries``  consecutive failures per key by mergeable summaries of
  stretches of the order, folded in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

STRETCH = 4096


def first_per_key(df: DataFrame, keys: list[str], order_col: str = "seq") -> DataFrame:
    """One row per key: the row with the smallest ``order_col`` (first arrival wins)."""
    return _one_per_key(df, keys, [F.col(order_col).asc_nulls_last()])


def last_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ordering tuple (last writer wins)."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_cols])


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    first = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn = 1")
    return first.select(*keys, *[c for c in df.columns if c not in keys])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(c).alias("__r_" + c) for c in right.columns])
    cond = [left[k].eqNullSafe(r["__r_" + k]) for k in keys]
    j = left.join(r, cond, how)
    keep = [c for c in right.columns if c not in keys]
    return j.select(*left.columns, *[F.col("__r_" + c).alias(c) for c in keep])


def row_numbers(df: DataFrame, group_cols: list[str], order_col: str = "seq", out: str = "rn", total: str | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by group_cols order by order_col)``.

    ``total`` optionally adds the group size. Rows move whole and are written
    once, so pass narrow ones; ``df`` is read twice (the range shuffle samples
    it first), so pass a stored table if it costs more than a scan. Among equal
    values of ``order_col`` the numbers are in any order.
    """
    keys = [*group_cols, order_col]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    rows = stored(ranged, "numbered")
    part = F.shiftrightunsigned("__at", 33).alias("__part")  # the partition; the place in it lies below
    runs = rows.groupBy(*group_cols, part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*group_cols)
    before = F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("__off", before - F.col("__first") + 1)
    if total:
        runs = runs.withColumn(total, F.sum("__n").over(group))
    j = _null_safe_join(rows.withColumn("__part", part), runs.drop("__n", "__first"), [*group_cols, "__part"])
    return j.withColumn(out, F.col("__at") + F.col("__off")).drop("__at", "__part", "__off")


def running_total(hist: DataFrame, value_col: str, count_col: str, out: str = "cum", total: str | None = None, width: int = STRETCH) -> DataFrame:
    """Add ``out`` = sum of ``count_col`` over rows with ``value_col`` <= this row's.

    ``hist`` holds one row per distinct whole value, e.g. ``groupBy(v).count()``;
    a stretch of ``width`` values is summed by one task.
    """
    inner = Window.partitionBy("__stretch").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    d = hist.withColumn("__stretch", F.floor(F.col(value_col) / width)).withColumn("__in", F.sum(count_col).over(inner))
    sums = d.groupBy("__stretch").agg(F.max("__in").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("__off", before)
    if total:
        sums = sums.withColumn(total, F.sum("__n").over(Window.partitionBy()))
    return d.join(sums.drop("__n"), "__stretch").withColumn(out, F.col("__off") + F.col("__in")).drop("__stretch", "__off", "__in")


# A stretch of tries: their number, the failures at its start and at its end, the longest run of
# failures, the place of the failure that is the cut-th of its run, the places of the first failures at its start.
SUMMARY = "struct<n: bigint, lead: bigint, trail: bigint, longest: bigint, cut_at: bigint, heads: array<bigint>>"
_NOTHING = f"CAST(named_struct('n', 0L, 'lead', 0L, 'trail', 0L, 'longest', 0L, 'cut_at', NULL, 'heads', array()) AS {SUMMARY})"


def _one_try(cut: int) -> str:
    """SQL: summary ``s`` followed by the try ``x`` (its place, doubled, plus 1 for a failure)."""
    failed, place = "(x % 2 = 1)", "shiftright(x, 1)"
    run = f"IF({failed}, s.trail + 1, 0L)"
    return (f"named_struct('n', s.n + 1, 'lead', s.lead + IF({failed} AND s.lead = s.n, 1, 0), 'trail', {run}, 'longest', greatest(s.longest, {run}), "
            f"'cut_at', coalesce(s.cut_at, IF({run} = {cut}, {place}, NULL)), "
            f"'heads', IF({failed} AND s.lead = s.n AND s.n < {cut}, concat(s.heads, array({place})), s.heads))")


def _two_stretches(cut: int) -> str:
    """SQL: summary ``s`` followed by the summary ``x.s``."""
    joined = "s.trail + x.s.lead"
    return (f"named_struct('n', s.n + x.s.n, 'lead', IF(s.lead = s.n, s.n + x.s.lead, s.lead), "
            f"'trail', IF(x.s.lead = x.s.n, s.trail + x.s.n, x.s.trail), 'longest', greatest(s.longest, x.s.longest, {joined}), "
            f"'cut_at', coalesce(s.cut_at, IF(s.trail < {cut} AND {joined} >= {cut}, get(x.s.heads, CAST({cut} - s.trail - 1 AS INT)), NULL), x.s.cut_at), "
            f"'heads', IF(s.lead = s.n, slice(concat(s.heads, x.s.heads), 1, {cut}), s.heads))")


def streak_summaries(tries: DataFrame, keys: list[str], failed: Column, cut: int, order_col: str = "seq", width: int = STRETCH) -> DataFrame:
    """``keys, s``: one summary per key of its tries in the order of ``order_col`` (unique whole numbers).

    A stretch of ``width`` places is a group of its own, so a key that holds all
    rows is spread over many tasks; a summary of it is a handful of numbers, and
    summaries of neighbours merge into one (``width`` of them a group, then all).
    """
    rows = tries.select(*keys, F.col(order_col).cast("bigint").alias("__at"), F.coalesce(failed, F.lit(False)).cast("int").alias("__f"))
    first = F.floor(F.col("__at") / width).alias("__b")
    level = rows.groupBy(*keys, first).agg(F.sort_array(F.collect_list(F.col("__at") * 2 + F.col("__f"))).alias("__l"))
    level = level.select(*keys, "__b", F.expr(f"aggregate(__l, {_NOTHING}, (s, x) -> {_one_try(cut)})").alias("s"))
    for more in (True, False):
        group = [*keys, F.floor(F.col("__b") / width).alias("__b")] if more else keys
        level = level.select(*group, F.struct(F.col("__b").alias("b"), "s").alias("__x"))
        found = level.groupBy(*keys, *(["__b"] if more else [])).agg(F.sort_array(F.collect_list("__x")).alias("__l"))
        level = found.select(*keys, *(["__b"] if more else []), F.expr(f"aggregate(__l, {_NOTHING}, (s, x) -> {_two_stretches(cut)})").alias("s"))
    return level


def batch_of(rank0: Column, n: Column, k: int) -> Column:
    """0-based batch of a 0-based position in ``n`` items cut into ``k`` contiguous
    near-equal batches, earlier batches one larger (equals ``ntile(k) - 1``)."""
    size = F.floor(n / k)
    rem = n % k
    big = rem * (size + 1)
    return F.when(rank0 < big, F.floor(rank0 / (size + 1))).otherwise(rem + F.floor((rank0 - big) / F.greatest(size, F.lit(1)))).cast("int")


def batch_slice(df: DataFrame, total_batches: int, order_col: str = "seq", out: str = "batch") -> DataFrame:
    """split ordered items into ``total_batches`` contiguous near-equal batches."""
    if total_batches < 1:
        raise ValueError(f"total_batches must be >= 1, got {total_batches}")
    numbered = row_numbers(df, [], order_col, out="__rn", total="__total")
    return numbered.withColumn(out, batch_of(F.col("__rn") - 1, F.col("__total"), total_batches)).drop("__rn", "__total")


# Fixed texts of the errors on bad batch arguments.
TOTAL_TOO_SMALL = "total_batches must be >= 1, got {total}"
BATCH_TOO_SMALL = "batch must be >= 0, got {batch}"
BATCH_TOO_LARGE = "batch ({batch}) must be < total_batches ({total})"


def select_batch(df: DataFrame, batch: int, total_batches: int, order_col: str = "seq") -> DataFrame:
    """The items of one batch; bad arguments raise a ValueError with a fixed text."""
    if not 0 <= batch < total_batches:
        text = TOTAL_TOO_SMALL if total_batches < 1 else BATCH_TOO_SMALL if batch < 0 else BATCH_TOO_LARGE
        raise ValueError(text.format(batch=batch, total=total_batches))
    return batch_slice(df, total_batches, order_col, "__b").filter(F.col("__b") == batch).drop("__b")
