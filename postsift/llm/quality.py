"""Quality by logistic regression on hashed word n-grams, trained with FTRL updates.

A text is its words (``\\w+``) and its runs of other signs, case kept. A word
equal to the one before it counts as a repeat mark, so a text that says one
word over and over looks alike whatever the word is. Single words and pairs of
neighbours are hashed to ``2 ** BITS`` features; a feature's value is
``1 + log(count)``, and a text's values have length 1. A score is the sparse
dot product with the weights, through a logistic curve.

Weights are trained by follow-the-regularised-leader updates (each coordinate
has a sum ``z`` of shifted gradients and a sum ``n`` of squared ones; weights
whose ``z`` stays within ``L1`` are 0). The examples lie in ``SHARDS`` shards by
hash. In each of ``ROUNDS`` rounds every shard goes on from the shared sums over
its own examples, and what the shards added is added to the shared sums:
``2 ** BITS`` numbers of each at most, whatever the corpus holds.

The classifier is fitted on a bounded sample of the labelled rows: about
``sample`` of each label, drawn by a hash of the id, at most ``4 * sample`` over
all shards (one id may have many rows). Rows of a label that is sampled more
thinly weigh more, so scores stay shares of label 1. Scoring reads every whole
text of every row.

Defined cases: null and empty texts have only the constant feature; labels that
are null or neither 0 nor 1, or whose document is missing, are ignored; of
several labels of a document the largest counts; labels of one kind only train
towards that kind; without labels every score is 0.5; a null id has no label
and is never held out; repeated rows give repeated results; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_or_empty

BITS = 18
SHARDS, ROUNDS = 8, 4
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.05, 0.0
WORD = re.compile(r"\w+|[^\w\s]+")
BLOCK_WORDS = 300_000
REPEAT = np.uint64(0x5EED)
MIX_LEFT, MIX_RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
CONSTANT = 0  # the feature of every text; hashed ones are 1 and up
N_FEATURES = (1 << BITS) + 1


class WordHashes(dict):
    """Hashes of the first ``keep`` distinct words met; later ones are hashed each time."""

    keep = 500_000

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        h = zlib.crc32(raw) | zlib.adler32(raw) << 32
        if len(self) < self.keep:
            self[word] = h
        return h


def features(words: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of each distinct feature of each row, in rising order of both."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), sizes)
    h = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, int(sizes.sum()))
    near = row[1:] == row[:-1]
    again = near & (h[1:] == h[:-1])
    h[1:][again] = REPEAT
    pair = h[:-1][near] * MIX_LEFT ^ h[1:][near] * MIX_RIGHT
    keys = np.concatenate([h * MIX_RIGHT, (pair ^ pair >> np.uint64(29)) * MIX_LEFT]) >> np.uint64(64 - BITS)
    at = np.concatenate([row, row[1:][near]]) * N_FEATURES + keys.astype(np.int64) + 1
    at = np.concatenate([at, np.arange(len(words)) * N_FEATURES + CONSTANT])
    found, count = np.unique(at, return_counts=True)
    owner, value = found // N_FEATURES, 1 + np.log(count)
    return owner, found % N_FEATURES, value / np.sqrt(np.bincount(owner, value * value, len(words)))[owner]


def _blocks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Rows in blocks of about ``BLOCK_WORDS`` words (or one longer text), with their words."""
    for batch in batches:
        begin, words, total = 0, [], 0
        for k, text in enumerate(batch.column(text_at)):
            words.append(WORD.findall(text.as_py() or ""))
            total += len(words[-1])
            if total > BLOCK_WORDS:
                yield batch.slice(begin, k + 1 - begin), words
                begin, words, total = k + 1, [], 0
        if words:
            yield batch.slice(begin), words


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights of the follow-the-regularised-leader sums."""
    l1 = np.where(np.arange(len(z)) == CONSTANT, 0.0, L1) if len(z) == N_FEATURES else L1
    return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)


def update(z: np.ndarray, n: np.ndarray, at: np.ndarray, value: np.ndarray, label: float, weight: float) -> None:
    """One example, in place."""
    l1 = np.where(at == CONSTANT, 0.0, L1)
    z_at, n_at = z[at], n[at]
    w = -np.sign(z_at) * np.maximum(np.abs(z_at) - l1, 0) / ((BETA + np.sqrt(n_at)) / ALPHA + L2)
    gradient = weight * (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
    squared = gradient * gradient
    z[at] = z_at + gradient - (np.sqrt(n_at + squared) - np.sqrt(n_at)) / ALPHA * w
    n[at] = n_at + squared


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``shard, place, weight, label, at, value``: the features of the documents of about ``sample`` ids of each label.

    The ids are drawn from the labels alone and are broadcast (some 2 * ``sample``
    of them), so no text is shuffled.
    """
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, sample / n) for k, n in counts.items()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40))
    weight = F.lit(None).cast("double")
    for k, s in share.items():
        weight = F.when((F.col("label") == k) & (place < int((1 << 40) * s)), min(share.values()) / s).otherwise(weight)
    drawn = known.withColumn("weight", weight).where(F.col("weight").isNotNull())
    rows = docs.join(F.broadcast(drawn), "doc_id").select(
        F.pmod(F.xxhash64("doc_id", "text", F.lit("shard")), F.lit(SHARDS)).cast("int").alias("shard"),
        F.xxhash64("text", "doc_id", F.lit("place")).alias("place"), "weight", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, words in _blocks(batches, 4):
            owner, at, value = features(words, hashes)
            offsets = pa.array(np.searchsorted(owner, np.arange(len(words) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (at.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(4)), *lists], ["shard", "place", "weight", "label", "at", "value"])

    return rows.mapInArrow(run, "shard int, place long, weight double, label int, at array<int>, value array<float>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 10_000, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights from the documents that ``labels`` (``doc_id`` and ``label_col``) marks 0 or 1."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = store(_sampled(rows, marks, sample), "quality-sample")
    most = 4 * sample // SHARDS
    z, n = np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((z, n))

        def run(table: pa.Table) -> pa.Table:
            z, n = (x.copy() for x in shared.value)
            for r in table.sort_by([("place", "ascending"), ("label", "ascending")]).slice(0, most).to_batches(max_chunksize=256):
                for label, weight, at, value in zip(*(r.column(c) for c in ("label", "weight", "at", "value"))):
                    update(z, n, at.values.to_numpy(), value.values.to_numpy().astype(float), label.as_py(), weight.as_py())
            touched = np.flatnonzero((z != shared.value[0]) | (n != shared.value[1]))
            return pa.table({"at": touched.astype(np.int32), "dz": (z - shared.value[0])[touched], "dn": (n - shared.value[1])[touched]})

        moved = rows.groupBy("shard").applyInArrow(run, "at int, dz double, dn double")
        sums = moved.groupBy("at").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn")).toPandas()  # N_FEATURES rows at most
        z[sums["at"]] += sums["dz"]
        n[sums["at"]] += sums["dn"]
    return weights(z, n)


def score(docs: DataFrame, learned: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, w = WordHashes(), shared.value
        for batch, words in _blocks(batches, 1):
            owner, at, value = features(words, hashes)
            dot = np.bincount(owner, value * w[at], len(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def predicted(threshold: float) -> Column:
    return F.when(F.col("score") >= threshold, 1).otherwise(0)
