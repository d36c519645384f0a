"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct word shingles as 64-bit hashes (a shorter
text is one shingle). Two documents are linked if the Jaccard similarity of
their sets reaches the threshold; the join returns each document's component.

1. Equal sets are one class (a 64-bit hash of the set), however many copies.
2. Groups of similar classes: classes that share a minimum under one of four
   hash functions are compared by sketch with members of that bucket (the
   smallest under eight hashes, plain aggregates), with the first of them always,
   with the others if they meet in two buckets at least. Each class keeps its two
   best, these are verified on the full sets, and verified links make parts. A
   part follows the smallest first member that one of its classes is like
   (``LIKE`` of the sketch): parts with one leader are one group, whether linked
   or not, so a family of near copies is one group with one token union. Work is
   linear in the classes, whatever a bucket's size.
3. Token-group matrix: one row for each token and each group whose union of
   members' prefixes has it. With sets in a common token order, two sets that
   reach the threshold share at least k tokens of their first
   ``n - ceil(t n) + k`` ones, so two groups can only hold a link if they share
   at least k rows of the matrix, k being a share ``EXTRA`` of the smaller set.
   The order puts frequent tokens last (frequent in a sixteenth of the
   documents, kept as a fixed-size bitmap): common passages stay out of the
   prefixes. The order has no influence on the result, only on the work. Under a
   token of more than ``CROWD`` groups those that share enough with the largest
   one follow it into one group, so a large family is not listed pair by pair.
4. Only the qualifying groups are opened: the classes of the smaller group
   query the larger one, and in a group of several parts all classes outside its
   largest part query the group. A semi join by size and by sketches (the 64
   smallest hashes; a linked pair shares fewer than 22 of them with a probability
   below 1e-11) keeps the queries that may be linked to another part. Their full
   sets meet the members' full sets in blocks of bounded size; a block returns the
   links that join parts not yet joined in it, so no pairs are listed.
5. Verified links, inside groups and between them, make the components.

Full sets are rebuilt from the texts for the verified pairs only; a fixed-size
bitmap of their row ids picks the texts (``among``). Nothing but the bitmaps (of
``BITMAP`` and ``common.PLACES`` bits at most) reaches the driver, and no list of copies, links or group
members is gathered anywhere.

Defined cases: null and empty texts and texts of blanks have the empty set and
are linked with nothing; a null id takes part like any other and is left out
when the smallest id of a component is taken (null if there is no other);
repeated rows are equal sets; a similarity exactly at the threshold is a link;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import among, store, text_or_empty
from .components import components

SKETCH, SKETCH_LEAST = 64, 22
FIRST_LOOK = 32  # hashes of the sketch that the grouping compares
LIKE = 0.6
KEYS = 4
PIVOTS = 8
EXTRA = 0.05
CROWD = 4  # groups that a token may have before they follow the largest of them
BITMAP = 1 << 22
BLOCK = 256  # classes on either side of a block of the final comparison
SLICE = 1000  # rows handled at a time by the tasks that build sets
HOT_SHARE, HOT_LEAST = 16, 5
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_TURNS = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(size, len(words))):
        out = (out ^ h[j:j + n]) * _MULTIPLY
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def class_key(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    doc = F.col(id_col).cast("long")
    key = F.xxhash64(text)
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, key).alias("rid"), key.alias("text_key"), text.alias("text"))


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """One row per document: set size, class, sketch and the four minima (nulls for the empty set)."""
    names = ["doc_id", "rid", "text_key", "n", "ck", "sketch", *[f"m{i}" for i in range(KEYS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in _slices(batches):
            n, ck, sketch, minima = [], [], [], []
            for text in batch.column(3):
                s = shingle_set(text.as_py(), size, known)
                n.append(len(s))
                ck.append(class_key(s) if len(s) else None)
                sketch.append((s[:SKETCH] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                minima.append([int(x.min().astype(np.int64)) for x in (s, *(s * t for t in _TURNS))] if len(s) else [None] * KEYS)
            columns = [pa.array(n, pa.int64()), pa.array(ck, pa.int64()), pa.array(sketch, pa.list_(pa.int32())),
                       *[pa.array([m[i] for m in minima], pa.int64()) for i in range(KEYS)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names)

    schema = "doc_id long, rid long, text_key long, n long, ck long, sketch array<int>, " + ", ".join(f"m{i} long" for i in range(KEYS))
    return rows.mapInArrow(run, schema)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the hashed places of a column of longs set."""
    places = keys.toDF("k").select(F.pmod("k", F.lit(BITMAP)).cast("int").alias("p")).distinct().toArrow()
    bits = np.zeros(BITMAP, bool)
    bits[places.column("p").to_numpy()] = True
    return np.packbits(bits)


def _held(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 > 0


def full_sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``ck, tokens`` for all classes with a document in ``wanted`` (``rid``), and for a few others.

    The sets are stored as the tasks build them; the shuffle that leaves one of each class also serves the join on ``ck``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = WordHashes(), set()
        for batch in _slices(batches):
            ck, tokens = [], []
            for text in batch.column(0):
                s = shingle_set(text.as_py(), size, known)
                key = class_key(s) if len(s) else None
                if key is not None and key not in met:
                    met.add(key)
                    ck.append(key)
                    tokens.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ck, pa.int64()), pa.array(tokens, pa.binary())], ["ck", "tokens"])

    found = among(rows.select("rid", "text"), "rid", wanted.select("rid")).select("text")
    return store(found.mapInArrow(run, "ck long, tokens binary"), "jaccard-sets").dropDuplicates(["ck"])


def linked(rows: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose full sets reach the threshold."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("ck")).distinct().join(classes.select("ck", "rid"), "ck").select("rid")
    sets = full_sets(rows, wanted, size)
    both = pairs.join(sets.toDF("a", "ta"), "a").join(sets.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return store(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "jaccard-links")


def likely_pairs(classes: DataFrame) -> DataFrame:
    """``ck, p, k, alike``: classes with members of their buckets (pivots) and the share of their sketches they have in common.

    A pivot is the bucket's smallest class under one of ``PIVOTS`` hashes, the same in all buckets, so a class
    meets the pivots of its likes in several buckets. It is compared with the first pivots (``k`` = 0) of all its
    buckets and with others that it meets at least twice.
    """
    keyed = classes.select("ck", F.posexplode(F.array(*[f"m{i}" for i in range(KEYS)])).alias("i", "m"))
    shared = keyed.groupBy("i", "m").agg(F.min("ck").alias("least"), F.max("ck").alias("most")).where("least <> most").select("i", "m")
    keyed = store(keyed.join(shared, ["i", "m"]), "jaccard-keyed")  # the pivots' hashes travel for shared buckets only
    pivots = [f"p{k}" for k in range(PIVOTS)]
    buckets = keyed.groupBy("i", "m").agg(
        F.count(F.lit(1)).alias("size"), *[F.min(F.xxhash64("ck", F.lit(k))).alias(p) for k, p in enumerate(pivots)]).where("size > 1")
    of = keyed.join(buckets, ["i", "m"]).select("ck", "i", F.posexplode(F.array(*pivots)).alias("k", "h"))
    named = F.expr("CASE k " + " ".join(f"WHEN {k} THEN xxhash64(ck, {k})" for k in range(PIVOTS)) + " END")
    pivot = of.withColumn("own", named)
    is_pivot = pivot.where("own = h").select(F.col("ck").alias("p"), "k", "h").distinct()
    met = of.groupBy("ck", "k", "h").agg(F.count(F.lit(1)).alias("times")).where("times > 1 OR k = 0")
    pairs = met.join(is_pivot, ["k", "h"]).where("ck <> p").groupBy("ck", "p").agg(F.min("k").alias("k"))
    look = F.slice("sketch", 1, FIRST_LOOK).alias("sketch")
    mine = classes.select("ck", look)
    other = classes.select(F.col("ck").alias("p"), look.alias("psketch"))
    share = _shared_sketch() / F.least(F.size("sketch"), F.size("psketch"))
    return pairs.join(mine, "ck").join(other, "p").select("ck", "p", "k", share.alias("alike")).where(F.col("alike") >= LIKE)


def similar_pairs(likely: DataFrame) -> DataFrame:
    """For each class its two most similar pivots."""
    best = likely.where("alike >= 0.75").groupBy("ck").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.col("alike").alias("s"), "p")), asc=False), 1, 2).alias("best"))  # at most PIVOTS * KEYS a class
    return best.select(F.col("ck").alias("a"), F.explode("best.p").alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similarity_groups(likely: DataFrame, parts: DataFrame) -> DataFrame:
    """``ck, part, grp`` for every class that is linked to, like or the leader of another one; ``parts`` (``ck``, ``root``) come from verified links."""
    order = F.xxhash64("p", F.lit(0))  # the hash of the first pivots
    first = likely.where("k = 0").select("ck", "p")
    first = first.union(first.select("p", "p"))  # a leader belongs to its group, also if it follows nobody
    leader = first.groupBy("ck").agg(F.min(F.struct(order.alias("h"), "p")).alias("lead"))
    known = leader.join(parts, "ck", "full").select("ck", F.coalesce("root", "ck").alias("part"), "lead")
    led = store(known.groupBy("part").agg(F.min("lead").alias("lead")).select("part", F.coalesce("lead.p", "part").alias("grp")), "jaccard-led")
    return known.select("ck", "part").join(led, "part").select("ck", "part", "grp")


def _shared_sketch() -> Column:
    return F.size(F.array_intersect("sketch", "psketch"))


def prefixes(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``ck, n, tokens``: each class's prefix in the common order (once for each task that meets the class)."""
    spark = rows.sparkSession

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), size, known) for t in batch.column(0)]
            tokens, count = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(count.astype(np.int64))], ["token", "c"])

    sampled = rows.where(F.pmod(F.xxhash64("rid", F.lit("order")), F.lit(HOT_SHARE)) == 0).select("text").mapInArrow(sample, "token long, c long")
    frequent = sampled.groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT_LEAST).select("token")
    shared = spark.sparkContext.broadcast(_bitmap(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot, met = WordHashes(), shared.value, set()
        for batch in _slices(batches):
            keys, sizes, tokens = [], [], []
            for text in batch.column(0):
                s = shingle_set(text.as_py(), size, known)
                n = len(s)
                ck = class_key(s) if n else None
                if not n or ck in met:
                    continue
                met.add(ck)
                late = _held(hot, (s.view(np.int64) % BITMAP).astype(np.int64))
                take = n - -(-percent * n // 100) + max(1, int(EXTRA * n))
                keys.append(ck)
                sizes.append(n)
                tokens.append(np.concatenate([s[~late], s[late]])[:take].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], ["ck", "n", "tokens"])

    return rows.select("text").mapInArrow(run, "ck long, n long, tokens array<long>")


def token_matrix(prefix: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """``token, g, low, high, c, crowd, lead``: prefix tokens of several groups, each group's smallest and largest set
    and number of classes with the token, the number of groups and the one with most classes."""
    # a prefix token of one class only joins nothing: tokens cross the network once, and groups meet what is left
    tokens = prefix.select("ck", "n", F.explode("tokens").alias("token"))
    own = Window.partitionBy("token")
    several = tokens.withColumns({"first": F.min("ck").over(own), "last": F.max("ck").over(own)}).where("first <> last")
    several = several.select("token", "ck", "n").distinct()
    # a class with fewer such tokens than its smallest possible partner would have to share has no link
    held = several.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("ck")))
    held = held.where(F.col("held") >= _common(F.ceil(F.col("n") * percent / 100)))
    of = held.join(groups.select("ck", "grp"), "ck", "left").select(F.coalesce("grp", "ck").alias("g"), "n", "token")
    matrix = of.repartition("token").groupBy("token", "g").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("c"))
    matrix = matrix.withColumns({"crowd": F.count(F.lit(1)).over(own), "lead": F.max(F.struct("c", "g")).over(own)["g"]})
    return store(matrix.where("crowd > 1"), "jaccard-matrix")


def _common(n: Column) -> Column:
    """Rows of the matrix that two groups share at least, the smaller set having ``n`` tokens."""
    return F.greatest(F.lit(1), F.floor(n * EXTRA))


def followers(matrix: DataFrame) -> DataFrame:
    """``g, lead``: groups that share half the rows asked for, all under tokens of more than ``CROWD`` groups, with the
    largest group there. They are compared with it as its members, so that they do not meet each other token by token."""
    crowded = matrix.where((F.col("crowd") > CROWD) & (F.col("g") != F.col("lead")))
    shared = crowded.groupBy("g", "lead").agg(F.count(F.lit(1)).alias("common"), F.min("low").alias("low"))
    most = shared.where(F.col("common") * 2 >= _common(F.col("low"))).groupBy("g").agg(F.max(F.struct("common", "lead")).alias("most"))
    return store(most.select("g", F.col("most.lead").alias("lead")), "jaccard-followers")


def merged(groups: DataFrame, follow: DataFrame) -> DataFrame:
    """``ck, part, grp`` after the groups that ``follow`` names went over; classes without a group that do so or lead are added."""
    alone = follow.select(F.explode(F.array("g", "lead")).alias("ck")).distinct().join(groups.select(F.col("grp").alias("ck")), "ck", "left_anti")
    every = groups.select("ck", "part", "grp").union(alone.select("ck", "ck", "ck"))
    new = every.join(follow, every["grp"] == follow["g"], "left").select("ck", "part", F.coalesce("lead", "grp").alias("grp"))
    return store(new, "jaccard-merged")


def group_pairs(matrix: DataFrame, follow: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (``g``, ``h``) that share enough rows of the token-group matrix."""
    matrix = matrix.select("token", "g", "low", "high").join(follow, "g", "left").select("token", F.coalesce("lead", "g").alias("g"), "low", "high")
    matrix = matrix.repartition("token").groupBy("token", "g").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    other = matrix.select(F.col("token").alias("t"), F.col("g").alias("h"), F.col("low").alias("hlow"), F.col("high").alias("hhigh"))
    sizes = (F.col("high") * 100 >= F.col("hlow") * percent) & (F.col("hhigh") * 100 >= F.col("low") * percent)
    met = matrix.join(other, (F.col("token") == F.col("t")) & (F.col("g") < F.col("h")) & sizes)
    counted = met.groupBy("g", "h").agg(F.count(F.lit(1)).alias("common"), F.min(F.least("low", "hlow")).alias("low"))
    return counted.where(F.col("common") >= _common(F.col("low"))).select("g", "h")


def opened(rows: DataFrame, pairs: DataFrame, classes: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links (``a``, ``b``) between paired groups and between the parts of a group.

    The classes of the smaller of two groups query the larger one; in a group of several parts the classes
    outside its largest part query the group. A query is kept if some member of another part may be linked
    (a semi join on sizes and sketches); its full set then meets the members' full sets in blocks of bounded size.
    """
    sizes = groups.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("c"))
    whole = store(sizes.groupBy("grp").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("c", "part")).alias("most")).select(
        "grp", "c", "parts", F.col("most.part").alias("main")), "jaccard-sizes")
    count = whole.select("grp", "c")
    sized = pairs.join(count.toDF("g", "gc"), "g", "left").join(count.toDF("h", "hc"), "h", "left")
    small = F.coalesce("gc", F.lit(1)) <= F.coalesce("hc", F.lit(1))
    none = F.lit(None).cast("long").alias("main")
    asked = sized.select(F.when(small, F.col("g")).otherwise(F.col("h")).alias("grp"), F.when(small, F.col("h")).otherwise(F.col("g")).alias("into"), none)
    asked = store(asked.unionByName(whole.where("parts > 1").select("grp", F.col("grp").alias("into"), "main")), "jaccard-asked")
    # sketches travel for the classes of these groups only
    ids = asked.select(F.explode(F.array("grp", "into")).alias("grp")).distinct()
    inside = store(ids.join(groups, "grp", "left").select("grp", F.coalesce("ck", "grp").alias("ck"), F.coalesce("part", "grp").alias("part")), "jaccard-inside")
    members = store(among(classes.select("ck", "rid", "n", "sketch"), "ck", inside.select("ck")).join(inside, "ck"), "jaccard-members")
    queries = asked.join(members, "grp").where("main IS NULL OR part <> main").select("into", F.col("ck").alias("a"), F.col("part").alias("pa"), "rid", "n", "sketch")
    held = members.join(asked.select(F.col("into").alias("of")).distinct(), F.col("grp") == F.col("of")).select(
        "of", F.col("part").alias("pb"), F.col("n").alias("pn"), F.col("sketch").alias("psketch"))
    alike = (F.col("n") * 100 >= F.col("pn") * percent) & (F.col("pn") * 100 >= F.col("n") * percent)
    enough = _shared_sketch() >= F.greatest(F.lit(1), F.floor(F.least(F.size("sketch"), F.size("psketch")) * SKETCH_LEAST / SKETCH))
    may = (F.col("into") == F.col("of")) & (F.col("pa") != F.col("pb")) & alike & enough
    asking = store(queries.join(held, may, "left_semi").select("into", "a", "pa", "rid"), "jaccard-asking")
    into = asking.groupBy("into").agg(F.count(F.lit(1)).alias("asked"))
    answering = store(members.join(into, members["grp"] == into["into"]).select("into", F.col("ck").alias("b"), F.col("part").alias("pb"), "rid", "asked"), "jaccard-answering")
    wanted = asking.select("rid").union(answering.select("rid"))
    sets = full_sets(rows, wanted, size)
    # blocks: at most about BLOCK queries against BLOCK members, spread by hash
    parts = answering.groupBy("into").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("rows"), F.ceil(F.max("asked") / BLOCK).alias("cols"))
    left = asking.join(parts, "into").join(sets.toDF("a", "tokens"), "a").select(
        "into", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(F.xxhash64("a"), F.col("cols")).alias("j"), "a", "pa", "tokens")
    right = answering.join(parts, "into").join(sets.toDF("b", "tokens"), "b").select(
        "into", F.pmod(F.xxhash64("b"), F.col("rows")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"), "b", "pb", "tokens")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found_a, found_b = [], []
        if left.num_rows and right.num_rows:
            names, part = right.column("b").to_pylist(), right.column("pb").to_pylist()
            sets_b = [np.frombuffer(t, np.uint64) for t in right.column("tokens").to_pylist()]
            sizes = np.array([len(t) for t in sets_b])
            owner, every = np.repeat(np.arange(len(sets_b)), sizes), np.concatenate(sets_b)
            joined: dict[int, int] = {}

            def top(x: int) -> int:
                while joined.get(x, x) != x:
                    x = joined[x]
                return x

            for a, own, t in zip(left.column("a").to_pylist(), left.column("pa").to_pylist(), left.column("tokens").to_pylist()):
                t = np.frombuffer(t, np.uint64)
                at = np.searchsorted(t, every)
                at[at == len(t)] = 0
                common = np.bincount(owner[t[at] == every], minlength=len(sets_b))
                for i in np.flatnonzero(100 * common >= percent * (sizes + len(t) - common)).tolist():
                    x, y = top(own), top(part[i])
                    if x != y:
                        joined[x] = y
                        found_a.append(a)
                        found_b.append(names[i])
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    keys = ["into", "i", "j"]
    return store(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "a long, b long"), "jaccard-opened")


def join(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rid, text_key, n_shingles, ck, root, component_id`` for every row; rows of one component share its smallest id."""
    rows = _rows(docs, id_col, text_col)
    signed = store(signatures(rows, size), "jaccard-signatures")
    minima = [f"m{i}" for i in range(KEYS)]
    classes = store(signed.where("n > 0").select("rid", "n", "ck", "sketch", *minima).dropDuplicates(["ck"]), "jaccard-classes")
    likely = store(likely_pairs(classes), "jaccard-likely")
    links = linked(rows, classes, store(similar_pairs(likely), "jaccard-similar"), size, percent)
    groups = store(similarity_groups(likely, components(links).toDF("ck", "root")), "jaccard-parts")
    matrix = token_matrix(prefixes(rows, size, percent), groups, percent)
    follow = followers(matrix)
    candidates = store(group_pairs(matrix, follow, percent), "jaccard-groups")
    more = opened(rows, candidates, classes, merged(groups, follow), size, percent)
    roots = components(links.union(more)).toDF("ck", "root")
    ids = signed.where("n > 0").groupBy("ck").agg(F.min("doc_id").alias("first")).join(roots, "ck", "left")
    ids = ids.select("ck", "first", F.coalesce("root", "ck").alias("root"))
    least = ids.groupBy("root").agg(F.min("first").alias("component"))
    of_class = ids.join(least, "root").select("ck", "component", "root")
    out = signed.select("doc_id", "rid", "text_key", "n", "ck").join(of_class, "ck", "left")
    return out.select("doc_id", "rid", "text_key", F.col("n").alias("n_shingles"), "ck", "root",
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id (null last, then the smallest text key); all its columns.

    Documents with the empty set stay. Repeated rows of the document that stays are one row.
    """
    found = join(docs, size, percent, id_col, text_col).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull(), F.col("rid").alias("r"), F.col("text_key").alias("k"))
    stay = store(found.groupBy("root").agg(F.min(order).alias("first")).select("first.r", "first.k"), "jaccard-stay").toDF("_rid", "_key")
    text = text_or_empty(text_col)
    key = F.xxhash64(text)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), key.alias("_key"), F.coalesce(F.col(id_col).cast("long"), key).alias("_rid"), text.alias("_text"))
    blank = F.length(F.regexp_replace("_text", r"[\x20\t\n\x0B\f\r]+", "")) == 0
    kept = rows.where(~blank).join(stay, ["_rid", "_key"]).dropDuplicates(["_rid", "_key"])
    return kept.select("row.*").unionByName(rows.where(blank).select("row.*"))
