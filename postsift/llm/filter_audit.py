"""Filter interaction audit: what five filters remove in every order.

Each document fails some of five filters, a mask of five bits:

* A: fewer than 100 words (maximal ``[^\\x20\\x09-\\x0D]+``);
* B: distinct words below 80 per cent of words, case-sensitive;
* C: more than 10 per cent of its code points are ``[A-Z]``;
* D: holds one of ``#$%&*|``;
* E: its text is that of a document with a smaller id, anywhere in the table.

The documents of a part (a language) are counted by mask: at most 32 cells a
part, however many documents there are. Each cell is then folded over the
array of the 120 orders: ``transform`` walks the orders, ``aggregate`` the five
steps of one, carrying whether an earlier filter took the document away. That
gives 600 structs weighted by the cell's counts; the cells' arrays are added
element by element (``zip_with``). A filter's Shapley sum is its removals over
all orders.

Texts are read once, in the tasks that scan them, and leave as a mask and a
256-bit hash. The first id of each hash is an aggregate with partial sums, and
the rows meet it by (id, hash), so a text that a third of all documents share
is no hot key. Labels meet the rows by id.

Defined cases: a null text is empty; a null language is the part ``''``, which
an empty one shares; a row without an id never fails E and makes no other fail
it, and has no label; rows that repeat an id are each counted, and those with the smallest id of
their text do not fail E; a document with several labels is good, or toxic, if
one of them says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_or_empty

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SYMBOLS = "[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: whether a text fails A, B, C, D."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, capitals = F.size(words), F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n, 100 * capitals > 10 * F.length(text), text.rlike(SYMBOLS)]
    return sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failed filters."""
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("hash"),
        text_mask(text).alias("mask"),
    )
    known = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = rows.join(known, "id", "left").select(
        "id", "part", "hash", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    marked = store(marked, "audit-rows")
    first = marked.where(F.col("id").isNotNull()).groupBy("hash").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    later = F.col("id").isNotNull() & F.col("first").isNull()
    return (
        marked.join(first, ["id", "hash"], "left")
        .groupBy("part", (F.col("mask") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))
        .agg(F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))
    )


def _struct(values: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def _fold() -> str:
    """SQL: the 600 structs of one cell ``c``."""
    bit = f"shiftleft(1, instr('{FILTERS}', substr(o, i, 1)) - 1)"
    fails = f"((c.mask & {bit}) <> 0)"
    step = _struct({
        "kept": f"IF(s.gone OR {fails}, 0L, c.n)",
        "removed": f"IF({fails} AND NOT s.gone, c.n, 0L)",
        "redundant": f"IF({fails} AND s.gone, c.n, 0L)",
        "unique_fails": f"IF(c.mask = {bit}, c.n, 0L)",
        "good_lost": f"IF({fails} AND NOT s.gone, c.good, 0L)",
        "toxic_lost": f"IF({fails} AND NOT s.gone, c.toxic, 0L)",
    })
    kind = "array<struct<" + ", ".join(f"{k}: bigint" for k in COUNTS) + ">>"
    start = f"named_struct('gone', false, 'steps', CAST(array() AS {kind}))"
    one_order = f"aggregate(sequence(1, 5), {start}, (s, i) -> named_struct('gone', s.gone OR {fails}, 'steps', concat(s.steps, array({step}))), s -> s.steps)"
    return f"flatten(transform(orders, o -> {one_order}))"


def audit(counted: DataFrame) -> DataFrame:
    """600 rows a part from its cells: ``part, filter_order, step``, the counts and ``shapley``."""
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    zeros = f"array_repeat({_struct(dict.fromkeys(COUNTS, '0L'))}, {len(ORDERS) * len(FILTERS)})"
    added = _struct({k: f"a.{k} + b.{k}" for k in COUNTS})
    letter = f"substr(orders[CAST(p DIV {len(FILTERS)} AS INT)], CAST(p % {len(FILTERS)} AS INT) + 1, 1)"
    by_filter = f"transform(split('{','.join(FILTERS)}', ','), f -> aggregate(transform(sums, (x, p) -> IF({letter} = f, x.removed, 0L)), 0L, (t, v) -> t + v))"
    return (
        parts.withColumn("orders", F.expr(f"split('{','.join(ORDERS)}', ',')"))
        .select("part", "orders", F.expr(f"aggregate(cells, {zeros}, (total, c) -> zip_with(total, {_fold()}, (a, b) -> {added}))").alias("sums"))
        .select("part", "orders", F.expr(by_filter).alias("by_filter"), F.posexplode("sums").alias("p", "x"))
        .selectExpr("part", f"orders[CAST(p DIV {len(FILTERS)} AS INT)] AS filter_order", f"CAST(p % {len(FILTERS)} + 1 AS INT) AS step", "x.*",
                    f"by_filter[instr('{FILTERS}', {letter}) - 1] AS shapley")
    )
