"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

The items are the indexed documents, every passage of a training text is a
query. A passage is a window of twice the longest item's words that moves by
once that length, so an item of that text lies whole in one of them. Weights
are BM25 impacts divided by the item's own full score: a passage with all of an
item's words scores 1, whatever its length. All items of at least ``threshold``
are retrieved, none is cut off by rank.

Blocks: the items are cut into blocks of ``block`` consecutive ones, and every
term has its largest weight in each block. Summed over a text's distinct words,
then over a passage's, these maxima bound the score of every item of a block;
what stays below the threshold is skipped. In the passages left, WAND moves the
terms' posting lists: the pivot is the first item at which the upper bounds of
the lists before it reach the threshold, and it is scored only if the block
maxima at the pivot reach it too.

A retrieved pair is verified: the last line of an item (or its last sentence)
is the answer, the rest the question; the share of the word 5-grams of each
that the passage holds must be at least ``overlap`` (a part of fewer words
counts as one n-gram, an item of one sentence is both).

The index is broadcast, so it has a bound: items are taken in groups of at
most ``index_words`` words (one longer item is a group of its own), each with
its own statistics, and every group is searched with all documents. No text is
shuffled; results of a text do not depend on others.

Defined cases: null and empty texts match nothing; items without words are
ignored; a null id stays null; repeated rows give repeated matches, repeated
items match each; ties do not occur, since everything above the threshold is
returned; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty

WORD = re.compile(r"\w+")
K1, B = 1.2, 0.75
GRAM = 5
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    for split in (r"\n+", r"(?<=[.!?])\s+"):
        parts = [p for p in re.split(split, text.strip()) if WORD.search(p)]
        if len(parts) > 1:
            return "\n".join(parts[:-1]), parts[-1]
    return text, text


def grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Postings of terms over items with weights, block maxima and list maxima."""

    def __init__(self, items: list[tuple[int, str]], block: int, threshold: float):
        items = [(i, t, words_of(t)) for i, t in items]
        items = [x for x in items if x[2]]
        self.ids = [i for i, _, _ in items]
        self.parts = [tuple(grams(words_of(p)) for p in parts_of(t)) for _, t, _ in items]
        self.block, self.threshold = block, threshold
        self.longest = max((len(w) for _, _, w in items), default=1)
        counts = [Counter(w) for _, _, w in items]
        df = Counter(t for c in counts for t in c)
        mean = sum(len(w) for _, _, w in items) / max(len(items), 1)
        self.term = {t: k for k, t in enumerate(sorted(df))}
        idf = {t: float(np.log(1 + (len(items) - n + 0.5) / (n + 0.5))) for t, n in df.items()}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for item, (c, (_, _, words)) in enumerate(zip(counts, items)):
            norm = K1 * (1 - B + B * len(words) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            whole = sum(impact.values())
            for t, x in impact.items():
                postings[self.term[t]].append((item, x / whole))
        self.postings = [([i for i, _ in p], [w for _, w in p]) for p in postings]
        self.most = np.array([max(w) for _, w in self.postings])
        self.block_most = [{} for _ in self.postings]
        for k, (at, weight) in enumerate(self.postings):
            for i, w in zip(at, weight):
                b = i // block
                self.block_most[k][b] = max(w, self.block_most[k].get(b, 0.0))
        # the block maxima as one flat table by term
        self.size = np.array([len(b) for b in self.block_most], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat_block = np.array([b for m in self.block_most for b in m], np.int64)
        self.flat_most = np.array([w for m in self.block_most for w in m.values()])
        self.blocks = len(items) // block + 1

    def may_match(self, owner: np.ndarray, term: np.ndarray, owners: int) -> np.ndarray:
        """Owners (texts or passages) for which some block's bound reaches the threshold; (owner, term) pairs may repeat."""
        if not len(term):
            return np.zeros(owners, bool)
        pairs = np.unique(owner * len(self.term) + term)
        owner, term = np.divmod(pairs, len(self.term))
        n = self.size[term]
        at = np.repeat(self.start[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell, inverse = np.unique(np.repeat(owner, n) * self.blocks + self.flat_block[at], return_inverse=True)
        bound = np.bincount(inverse, weights=self.flat_most[at])
        out = np.zeros(owners, bool)
        out[cell[bound >= self.threshold - 1e-9] // self.blocks] = True
        return out

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items that a passage with these distinct terms scores at the threshold or above."""
        least = self.threshold - 1e-9
        lists = [[0, self.postings[t][0], self.postings[t][1], float(self.most[t]), self.block_most[t]] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda x: x[1][x[0]])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[3]
                if bound >= least:
                    pivot = x[1][x[0]]
                    break
            if pivot is None:
                break
            block = pivot // self.block
            in_reach = [x for x in lists if x[1][x[0]] <= pivot]
            if sum(x[4].get(block, 0.0) for x in in_reach) < least:
                # no item of this block up to the next list's item can reach it
                later = [x[1][x[0]] for x in lists if x[1][x[0]] > pivot]
                self._move(in_reach, min([(block + 1) * self.block, *later]))
            elif lists[0][1][lists[0][0]] == pivot:
                score = sum(x[2][x[0]] for x in in_reach)
                if score >= least:
                    found.append((pivot, score))
                self._move(in_reach, pivot + 1)
            else:
                self._move([x for x in in_reach if x[1][x[0]] < pivot], pivot)
            lists = [x for x in lists if x[0] < len(x[1])]
        return found

    @staticmethod
    def _move(lists: list, item: int) -> None:
        for x in lists:
            at, n = x[0], len(x[1])
            while at < n and x[1][at] < item:
                at += 1
            x[0] = at

    def matches(self, texts: list[str], overlap: float) -> list[tuple[int, int, float, float, float]]:
        """Verified (text, item, score, question overlap, answer overlap), the best passage for each pair."""
        get = self.term.get
        words = [words_of(t) for t in texts]
        ids = [np.fromiter((get(w, -1) for w in ws), np.int64, len(ws)) for ws in words]
        length = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(ids)), length)
        known = flat >= 0
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for doc in np.flatnonzero(self.may_match(owner[known], flat[known], len(ids))):
            x, step = ids[doc], self.longest
            windows = max(1, -(-len(x) // step) - 1)
            at = np.flatnonzero(x >= 0)
            first = np.minimum(at // step, windows - 1)
            before = np.maximum(at // step - 1, 0)
            passing = self.may_match(np.concatenate([first, before]), np.concatenate([x[at], x[at]]), windows)
            for k in np.flatnonzero(passing):
                passage = slice(k * step, (k + 2) * step)
                terms = x[passage]
                for item, score in self.retrieve(np.unique(terms[terms >= 0]).tolist()):
                    own = grams(words[doc][passage])
                    shares = []
                    for part in self.parts[item]:
                        n = len(next(iter(part)))
                        held = own if n == GRAM else {g[i:i + n] for g in own for i in range(len(g) - n + 1)}
                        shares.append(len(part & held) / len(part))
                    if min(shares) >= overlap:
                        pair = (int(doc), item)
                        best[pair] = max(best.get(pair, (0.0, 0.0, 0.0)), (score, *shares))
        return [(doc, self.ids[item], *b) for (doc, item), b in sorted(best.items())]


def item_groups(items: DataFrame, index_words: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), text_or_empty(text_col).alias("t")).orderBy("i", "t")
    for r in rows.toLocalIterator():
        n = len(words_of(r["t"]))
        if group and size + n > index_words:
            yield group
            group, size = [], 0
        group.append((r["i"], r["t"]))
        size += n
    if group:
        yield group


def _searched(docs: DataFrame, group, keep: bool, schema, threshold: float, overlap: float, block: int) -> DataFrame:
    """Matches of one group of items, or (``keep``) the rows of ``docs`` (text, row) that have none."""
    shared = docs.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, block, threshold)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = index.matches([t.as_py() for t in part.column(0)], overlap)
                if keep:
                    mask = np.ones(part.num_rows, bool)
                    mask[[m[0] for m in found]] = False
                    yield part.filter(pa.array(mask))
                elif found:
                    ids = part.column(1).to_pylist()
                    columns = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d in columns[0]], pa.int64()), pa.array(columns[1], pa.int64()),
                         *[pa.array(c, pa.float64()) for c in columns[2:]]],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5, block: int = 2,
         index_words: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs of documents and test items they contain."""
    spark = docs.sparkSession
    rows = docs.select(text_or_empty(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    out = None
    for group in item_groups(items, index_words, "item_id", "text"):
        more = _searched(rows, group, False, SCHEMA, threshold, overlap, block)
        out = more if out is None else out.unionAll(more)
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in SCHEMA.split(", "))]) if out is None else out


def remove(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5, block: int = 2,
           index_words: int = 1_000_000, text_col: str = "text") -> DataFrame:
    """The documents without any test item, all their columns."""
    rows = docs.select(text_or_empty(text_col).alias("text"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    schema = T.StructType([T.StructField("text", T.StringType()), rows.schema["row"]])
    for group in item_groups(items, index_words, "item_id", "text"):
        rows = _searched(rows, group, True, schema, threshold, overlap, block)
    return rows.select("row.*")
