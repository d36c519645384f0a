r"""SimHash fingerprints and exact search within a Hamming radius (DataFrame functions only).

The terms of a text are its distinct lower-case words, split at blanks. A term
weighs as much as its length less two, from one to ten (short words are
frequent and say little), and votes with its weight for every set bit of its
128-bit hash and against every unset one. The fingerprint has the bits with a
positive sum, as 32 hexadecimal digits. It is a projection of the text: eight
bits share one 64-bit sum in lanes of 8 bits, a few terms at a time, whose sums
go into lanes of 16 bits, and terms are taken in chunks that cannot overflow a
lane.

Search: the bits are cut into ``radius + 1`` blocks. Two fingerprints within
the radius agree in at least one block, so each block, moved to the front,
keys a table; rows that share a key are compared in full. Equal fingerprints
are one entry with its number of documents, so copies do not multiply, and a
pair is kept only in the table of the first block on which it agrees.

Defined cases: null text is empty; a text without words has the fingerprint
of zeros; equal texts have equal fingerprints. In ``edited`` a null id is the
smallest, the document after the smallest is the largest, a single document
follows itself, and of rows that repeat an id the smallest text is "the next
document"; every row is returned. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

BITS = 128
# Terms of weight up to 10 that cannot overflow the highest lane, of 16 and of 8 bits: its first bit is the sum's sign.
CHUNK, FEW = 3276, 12
LANES_8, LANES_16 = 0x0101010101010101, 0x00FF00FF00FF00FF
BLANKS = r"[\x20\t\n\x0B\f\r]+"
NULL_ID, BELOW_ALL = -(1 << 63) + 2, -(1 << 63) + 1


def _votes(terms: str, chunk: Column) -> Column:
    """Sums of the CHUNK terms of a chunk: the total weight, then the weight of the set terms for each bit.

    FEW terms are added in lanes of 8 bits, their sums in lanes of 16. The few are cut from the whole
    array, because a cut of a cut would copy the chunk once for every few terms.
    """
    keys = [(k, i) for k in (0, 1) for i in range(8)]
    long = F.lit(0).cast("long")

    def add(acc: Column, t: Column) -> Column:
        lanes = [(acc[f"s{k}_{i}"] + (F.shiftrightunsigned(t[f"h{k}"], i) if i else t[f"h{k}"]).bitwiseAND(F.lit(LANES_8)) * t["w"]).alias(f"s{k}_{i}") for k, i in keys]
        return F.struct((acc["total"] + t["w"]).alias("total"), *lanes)

    def few(n: Column) -> Column:
        return F.aggregate(F.slice(terms, n * FEW + 1, F.lit(FEW)), F.struct(long.alias("total"), *[long.alias(f"s{k}_{i}") for k, i in keys]), add)

    def widen(acc: Column, x: Column) -> Column:
        even = [(acc[f"e{k}_{i}"] + x[f"s{k}_{i}"].bitwiseAND(F.lit(LANES_16))).alias(f"e{k}_{i}") for k, i in keys]
        odd = [(acc[f"o{k}_{i}"] + F.shiftrightunsigned(x[f"s{k}_{i}"], 8).bitwiseAND(F.lit(LANES_16))).alias(f"o{k}_{i}") for k, i in keys]
        return F.struct((acc["total"] + x["total"]).alias("total"), *even, *odd)

    def unpack(acc: Column) -> Column:
        return F.array(acc["total"], *[
            F.shiftrightunsigned(acc[f"{half}{k}_{i}"], 16 * lane).bitwiseAND(F.lit(0xFFFF).cast("long"))
            for k in (0, 1) for lane in range(4) for half in "eo" for i in range(8)])

    last = F.least((chunk + 1) * (CHUNK // FEW) - 1, (F.size(terms) / FEW).cast("int"))
    sums = F.transform(F.sequence(chunk * (CHUNK // FEW), last), few)
    return F.aggregate(sums, F.struct(long.alias("total"), *[long.alias(f"{half}{k}_{i}") for half in "eo" for k, i in keys]), widen, unpack)


def with_fingerprint(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of a text column (not null) as column ``name``."""
    words = F.filter(F.array_distinct(F.split(F.lower(text_col), BLANKS)), lambda w: w != "")
    terms = F.transform(words, lambda w: F.struct(
        F.xxhash64(w).alias("h0"), F.xxhash64(w, F.lit(1)).alias("h1"),
        F.greatest(F.lit(1), F.least(F.length(w) - 2, F.lit(10))).cast("long").alias("w")))

    def chunk(i: Column) -> Column:
        return _votes("_terms", i)

    chunks = F.transform(F.sequence(F.lit(0), (F.size("_terms") / CHUNK).cast("int")), chunk)
    zero = F.array_repeat(F.lit(0).cast("long"), BITS + 1)

    def digits(sums: Column) -> Column:
        def bit(b: Column) -> Column:
            return (F.get(sums, b + 1) * 2 > F.get(sums, F.lit(0))).cast("int")

        nibble = lambda j: F.substring(F.lit("0123456789abcdef"), bit(j * 4) * 8 + bit(j * 4 + 1) * 4 + bit(j * 4 + 2) * 2 + bit(j * 4 + 3) + 1, F.lit(1))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BITS // 4 - 1)), nibble), "")

    summed = F.aggregate(chunks, zero, lambda acc, c: F.zip_with(acc, c, lambda a, b: a + b), digits)
    return rows.withColumn("_terms", terms).withColumn(name, summed).drop("_terms")


def _quarter(fp: Column, k: int) -> Column:
    return F.conv(F.substring(fp, 1 + 8 * k, 8), 16, 10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(_quarter(a, k).bitwiseXOR(_quarter(b, k))) for k in range(BITS // 32)])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - hamming(a, b) / BITS


def neighbours(queries: DataFrame, all_prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs ``q, f, distance`` of distinct fingerprints within ``radius`` (equal ones too); exact."""
    width = BITS // 4 // (radius + 1)  # hexadecimal digits of a block; the last block takes the rest

    def blocks(c: Column) -> list[Column]:
        return [F.substring(c, 1 + k * width, width if k < radius else BITS) for k in range(radius + 1)]

    def table(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col("fingerprint").alias(name)).distinct()
        return distinct.select(name, F.posexplode(F.array(*blocks(F.col(name)))).alias(f"{name}_k", f"{name}_block"))

    earlier = [(F.col("q_k") > k) & (a == b) for k, (a, b) in enumerate(zip(blocks(F.col("q")), blocks(F.col("f"))))]
    near = hamming(F.col("q"), F.col("f"))
    found = table(queries, "q").join(
        table(all_prints, "f"),
        (F.col("q_k") == F.col("f_k")) & (F.col("q_block") == F.col("f_block")) & (near <= radius) & ~reduce(lambda a, b: a | b, earlier))
    return found.select("q", "f", near.alias("distance"))


def count_near(prints: DataFrame, is_query: Column, radius: int = 3) -> DataFrame:
    """``fingerprint, n_near``: for the fingerprints of the queries, the documents within ``radius``, itself included."""
    weight = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    pairs = neighbours(prints.where(is_query), prints, radius)
    return pairs.join(weight, pairs["f"] == weight["fingerprint"]).groupBy(F.col("q").alias("fingerprint")).agg(F.sum("n").alias("n_near"))


def with_next(docs: DataFrame, columns: list[str], id_col: str, text_col: str) -> DataFrame:
    """All rows with ``next``, the ``columns`` of the next smaller id, in a struct.

    Ids are cut into ranges at percentiles. Every range is one window group,
    with a copy of the first document of the range below it, so each text is
    shuffled once. Only range borders and first ids (one number a range) reach the driver.
    """
    spark = docs.sparkSession
    ranges = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    ids = docs.select(at.alias("_at"))
    cuts = ids.agg(F.percentile_approx("_at", [k / ranges for k in range(1, ranges)], ranges * 20)).first()[0] if ranges > 1 else []
    borders = sorted(set(cuts or []))
    # the range of an id: how many borders lie below it
    of = F.size(F.filter(F.array(*[_long(b) for b in borders]), lambda b: b < F.col("_at"))) if borders else F.lit(0)
    heads = {r["_range"]: r["head"] for r in ids.groupBy(of.alias("_range")).agg(F.max("_at").alias("head")).collect()}
    order = sorted(heads)
    above = F.create_map(*[x for a, b in zip(order, order[1:]) for x in (_long(heads[a]), F.lit(b))]).cast("map<bigint,int>")
    own = F.struct(of.alias("range"), F.col("_at").alias("place"), F.lit(False).alias("copy"))
    up = F.struct(above[F.col("_at")].alias("range"), F.col("_at").alias("place"), F.lit(True).alias("copy"))
    around = F.struct(F.lit(min(order, default=0)).alias("range"), _long(BELOW_ALL).alias("place"), F.lit(True).alias("copy"))
    largest = F.col("_at") == _long(max(heads.values(), default=0))
    places = F.filter(F.array(own, F.when(up["range"].isNotNull(), up), F.when(largest, around)), lambda x: x.isNotNull())
    dealt = docs.select("*", at.alias("_at")).select("*", F.inline(places).alias("_range", "_place", "_copy"))
    # plain columns as keys, so that both windows use one shuffle
    by_text = Window.partitionBy("_range").orderBy("_place", text_col)
    before = F.lag("_place").over(by_text)
    below = Window.partitionBy("_range").orderBy("_place").rangeBetween(Window.unboundedPreceding, -1)
    firsts = dealt.withColumn("_first", F.when(before.isNull() | (before != F.col("_place")), F.struct(*columns)))
    return firsts.withColumn("next", F.last("_first", ignorenulls=True).over(below)).where("NOT _copy").drop("_first", "_range", "_place", "_copy", "_at")


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its fingerprint, its edited text and the fingerprint of that, and the next document's fingerprint.

    The last third of the code points gives way to as many first ones of the next document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "fingerprint"), ["text", "fingerprint"], "doc_id", "text")
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), changed.alias("edited_text"), "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"))
    return with_fingerprint(rows, "edited_text", "edited_fingerprint")
