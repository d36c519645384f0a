"""Interpolated Kneser-Ney character models of grouped texts in sorted hash arrays.

A word is a run of letters and marks in lower case; its symbols and the mark
after it (0) are predicted from up to three symbols before, the word's start
included. A symbol is a UTF-16 code unit, so an n-gram of four is one 64-bit
key exactly, whatever the script. A group (a language) has its own model.

The arrays: n-grams are dealt to ``RANGES`` ranges by a hash of their two middle
symbols; a range is rows of binary columns, sorted 64-bit keys beside group
numbers and counts, or beside one logarithm a group. A lookup is a binary
search in one range.

1. ``count``: each task counts its texts' n-grams into arrays; one shuffle by
   range adds them up. All n-grams of all texts are counted, none is left out;
   texts of no group are counted apart, so that what is to be scored is known.
2. ``finish``: the arrays, now distinct, meet again by the symbol before the
   last one, which all contexts of orders 2 to 4 share, so continuation counts,
   totals and back-off weights are found inside one task; only the order-1
   table (at most 2^16 symbols a group) is gathered and sent round. The result
   holds the logarithm of every n-gram in every group.
3. ``score``: the logarithms of frequent n-grams (at most ``CACHE_BYTES`` in
   all, by share of all n-grams) are broadcast; the others meet their range by
   a shuffle and are added, so the cache changes no value.

A task holds one range, or the distinct n-grams of one symbol, and texts in
pieces of ``PIECE`` characters, so a very long text needs no more memory; what is
still to be looked up is kept in arrays, for ``PIECE`` bytes of rows at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

ORDER = 4
RANGES = 1 << 12
PIECE = 1 << 18
ROWS = 1 << 16
PENDING = 1 << 21
CACHE_BYTES = 1 << 24
UNIFORM = 1.0 / (1 << 16)
ABSENT = -100.0
MASKS = [0, *[np.uint64((1 << (16 * k)) - 1) for k in range(1, ORDER + 1)]]


@cache
def _kinds() -> np.ndarray:
    """0 for a code point outside words, 1 for a mark, 2 for a letter."""
    category = [unicodedata.category(chr(i))[0] for i in range(0x110000)]
    return np.array([{"L": 2, "M": 1}.get(c, 0) for c in category], np.uint8)


def pieces(texts: Iterable[str]) -> Iterator[list[tuple[int, str, int, bool]]]:
    """Lists of (row, piece in lower case, leading characters that only give context, whether it ends the text), about ``PIECE`` characters a list."""
    out, size = [], 0
    for row, text in enumerate(texts):
        text = text.lower()
        for lo in range(0, max(len(text), 1), PIECE):
            before = min(lo, ORDER)
            piece = text[lo - before:lo + PIECE]
            out.append((row, piece, before, lo + PIECE >= len(text)))
            size += len(piece)
            if size >= PIECE:
                yield out
                out, size = [], 0
    if out:
        yield out


def ngrams(parts: list[tuple[int, str, int, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key and row of each n-gram of the pieces, in text order, and the rows of their letters."""
    text = "\n".join(p[1] for p in parts) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter((len(p[1]) + 1 for p in parts), np.int64, len(parts))
    ends = np.cumsum(lengths)
    rows = np.repeat(np.fromiter((p[0] for p in parts), np.int64, len(parts)), lengths)
    kind = _kinds()[codes]
    asked = np.ones(len(codes), bool)
    for (_, _, before, last), start, end in zip(parts, ends - lengths, ends):
        if before:
            asked[start:start + before] = False
        if not last:
            asked[end - 1] = False
    letters = rows[(kind == 2) & asked]
    inside = kind > 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the mark after a word
    symbols, rows, asked = np.where(inside, codes, 0)[keep], rows[keep], asked[keep]
    wide = symbols > 0xFFFF
    if wide.any():
        times = 1 + wide
        first = (np.cumsum(times) - times)[wide]
        beyond = symbols[wide] - 0x10000
        symbols, rows, asked = np.repeat(symbols, times), np.repeat(rows, times), np.repeat(asked, times)
        symbols[first], symbols[first + 1] = 0xD800 + (beyond >> 10), 0xDC00 + (beyond & 0x3FF)
    symbols = symbols.astype(np.uint64)
    after = symbols == 0
    keys, same = symbols.copy(), np.ones(len(symbols), bool)
    for back in range(1, ORDER):
        same[back:] &= ~after[:-back]
        same[:back] = False
        keys[back:] |= np.where(same[back:], symbols[:-back], 0) << np.uint64(16 * back)
    return keys[asked], rows[asked], letters


def range_of(keys: np.ndarray) -> np.ndarray:
    middle = (keys >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
    return (((middle * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)) >> np.uint64(20)).astype(np.int32)


def added(keys: np.ndarray, grps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, group) in order with the sums of their counts."""
    order = np.lexsort((grps, keys))
    keys, grps = keys[order], grps[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (grps[1:] != grps[:-1])
    at = np.flatnonzero(new)
    return keys[at], grps[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


class Sums:
    """(key, group, count) arrays that are added up whenever ``PENDING`` entries wait."""

    def __init__(self):
        self.parts, self.waiting = [], 0

    def add(self, keys: np.ndarray, grps: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, grps, counts))
        self.waiting += len(keys)
        if self.waiting > PENDING:
            self.parts = [self.result()]
            self.waiting = 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.int64)
        return added(*(np.concatenate(x) for x in zip(*self.parts)))


ARRAYS = "keys binary, grps binary, counts binary"


def _stretches(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal numbers of a sorted array."""
    at = np.flatnonzero(np.diff(values)) + 1
    for lo, hi in zip([0, *at], [*at, len(values)]):
        if hi > lo:
            yield int(values[lo]), slice(lo, hi)


def _batch(column: str, values: np.ndarray, arrays: tuple[np.ndarray, ...], names: list[str], *, size: int = 256) -> Iterator[pa.RecordBatch]:
    """A row per distinct number of ``values`` with its part of each array, keys in order."""
    order = np.argsort(values, kind="stable")
    values, arrays = values[order], [a[order] for a in arrays]
    rows = list(_stretches(values))
    for lo in range(0, len(rows), size):
        part = rows[lo:lo + size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in part], pa.int32()), *[pa.array([a[s].tobytes() for _, s in part], pa.binary()) for a in arrays]], [column, *names])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _together(rows: Iterable[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums = Sums()
    for _, keys, grps, counts in rows:
        sums.add(np.frombuffer(keys, np.uint64), np.frombuffer(grps, np.uint16), np.frombuffer(counts, np.int64))
    return sums.result()


def count(texts: DataFrame, groups: list[str]) -> DataFrame:
    """``sym, keys, grps, counts``: the distinct n-grams of all rows of (grp, text) with a count per group, stored; ``sym`` is
    the symbol before the last. Texts of other groups, or null, count for group number ``len(groups)``."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {g: i for i, g in enumerate(groups)}
        sums = Sums()
        for batch in batches:
            grps = np.array([number.get(g, len(groups)) for g in batch.column(0).to_pylist()], np.int64)
            for parts in pieces(t.as_py() for t in batch.column(1)):
                keys, rows, _ = ngrams(parts)
                own = grps[rows]
                for g in np.unique(own):
                    found, times = np.unique(keys[own == g], return_counts=True)
                    sums.add(found, np.full(len(found), g, np.uint16), times.astype(np.int64))
            if sums.parts and len(sums.parts[0][0]) > PENDING:
                keys, *rest = sums.result()
                yield from _batch("rng", range_of(keys), (keys, *rest), ["keys", "grps", "counts"])
                sums = Sums()
        keys, *rest = sums.result()
        yield from _batch("rng", range_of(keys), (keys, *rest), ["keys", "grps", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            keys, *rest = _together(rows)
            yield from _batch("sym", ((keys >> np.uint64(16)) & MASKS[1]).astype(np.int32), (keys, *rest), ["keys", "grps", "counts"])

    partial = texts.select("grp", "text").mapInArrow(tally, f"rng int, {ARRAYS}")
    dealt = partial.repartition("rng").sortWithinPartitions("rng")
    return store(dealt.mapInArrow(merge, f"sym int, {ARRAYS}"), "ngram-counts")


def _levels(keys: np.ndarray, grps: np.ndarray, counts: np.ndarray, size: int, shared: int) -> list:
    """Sorted (key, group, count) of orders 4, 3 and 2 of one symbol; counts below order 4 are distinct symbols to the left.

    Orders up to ``shared`` count them over all groups together, as group 0.
    """
    known = grps < size
    out = [(keys[known], grps[known], counts[known])]
    for k in range(ORDER - 1, 1, -1):
        above, own = out[-1][:2]
        if k == shared:
            above = np.unique(above)
            own = np.zeros(len(above), grps.dtype)
        out.append(added(above & MASKS[k], own, np.ones(len(above), np.int64)))
    return out


def _columns(k: int, shared: int, size: int) -> int:
    """Number of value columns of an order: one where all groups share it."""
    return 1 if k <= shared else size


@dataclass
class Model:
    """Values of every n-gram: ``values`` has rows ``rng, keys, logs, counts, total``."""

    groups: list[str]
    values: DataFrame
    total: int


def _statistics(arrays: DataFrame, size: int, shared: int) -> pa.Table:
    """``level, sym, grp, n1, n2``: entries of one and of two per order and group that has any; for order 1 (``sym`` the symbol) its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            levels = _levels(*_together(rows), size, shared)
            out = []
            for k, (_, grps, counts) in zip(range(ORDER, 1, -1), levels):
                ones, twos = (np.bincount(grps[counts == x], minlength=size) for x in (1, 2))
                out += [(k, 0, g, int(ones[g]), int(twos[g])) for g in np.unique(grps).tolist()]
            last, grps, _ = levels[-1]
            if shared == 1:
                last = np.unique(last)
                grps = np.zeros(len(last), grps.dtype)
            out += [(1, int(s), int(g), 1, 0) for s, g in zip(last & MASKS[1], grps)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["level", "sym", "grp", "n1", "n2"])

    found = _by_symbol(arrays).mapInArrow(run, "level long, sym long, grp long, n1 long, n2 long")
    return found.groupBy("level", "sym", "grp").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).toArrow()  # at most 2^16 symbols a group


def _by_symbol(arrays: DataFrame) -> DataFrame:
    return arrays.repartition("sym").sortWithinPartitions("sym")


def _discount(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    return np.where((n1 > 0) & (n2 > 0), n1 / np.maximum(n1 + 2 * n2, 1), 0.75)


def _parameters(table: pa.Table, size: int, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Discounts per order and group, order-1 probabilities per symbol and group, and which groups have counts."""
    level, sym, grp, n1, n2 = (table.column(c).to_numpy() for c in ("level", "sym", "grp", "n1", "n2"))
    discounts = np.full((ORDER + 1, size), 0.75)
    for k in range(2, ORDER + 1):
        own = level == k
        ones, twos = np.zeros(size), np.zeros(size)
        ones[grp[own]], twos[grp[own]] = n1[own], n2[own]
        discounts[k] = _discount(ones, twos)
    own = level == 1
    counts = np.zeros((1 << 16, _columns(1, shared, size)), np.int64)
    counts[sym[own], grp[own]] = n1[own]
    total = counts.sum(axis=0)
    discount = _discount((counts == 1).sum(axis=0), (counts == 2).sum(axis=0))
    rest = np.where(total > 0, (counts > 0).sum(axis=0) * discount / np.maximum(total, 1), 1.0)
    first = np.maximum(counts - discount, 0) / np.maximum(total, 1) + rest * UNIFORM
    return discounts, first.astype(np.float32), np.isin(np.arange(size), grp[level == ORDER])


def _weights(level: tuple, discount: np.ndarray) -> tuple:
    """Entries (key, group, share of its context's total) and contexts (key, group, weight that is left)."""
    keys, grps, counts = level
    contexts, own, totals = added(keys >> np.uint64(16), grps, counts)
    _, _, kinds = added(keys >> np.uint64(16), grps, np.ones(len(keys), np.int64))
    # the place of each entry's context: both lists are in order of key, then group
    order = np.lexsort((grps, keys >> np.uint64(16)))
    place = np.empty(len(keys), np.int64)
    place[order] = np.repeat(np.arange(len(contexts)), kinds)
    return (keys, grps, (counts - discount[grps]) / totals[place]), (contexts, own, kinds * discount[own] / totals)


def _spread(wanted: np.ndarray, entries: tuple, size: int, default: float) -> np.ndarray:
    """A row per key of ``wanted`` (in order) with each group's value, ``default`` where there is none."""
    out = np.full((len(wanted), size), default)
    keys, grps, values = entries
    lo, hi = np.searchsorted(keys, wanted[0]), np.searchsorted(keys, wanted[-1], "right")
    at = np.searchsorted(wanted, keys[lo:hi])
    hit = wanted[at] == keys[lo:hi]
    out[at[hit], grps[lo:hi][hit]] = values[lo:hi][hit]
    return out


def _probabilities(wanted: np.ndarray, k: int, weights: dict, first: np.ndarray, size: int, shared: int) -> np.ndarray:
    """Probability of each distinct key of ``wanted`` (order ``k``, in order) in every group; one column for all where they share the order."""
    if k == 1:
        return first[wanted.astype(np.int64)].astype(np.float64)
    lower, at = np.unique(wanted & MASKS[k - 1], return_inverse=True)
    contexts, own = np.unique(wanted >> np.uint64(16), return_inverse=True)
    entries, rests = weights[k]
    columns = _columns(k, shared, size)
    below = _probabilities(lower, k - 1, weights, first, size, shared)[at]
    return _spread(wanted, entries, columns, 0.0) + _spread(contexts, rests, columns, 1.0)[own] * below


def finish(arrays: DataFrame, groups: list[str], shared_orders: int = 0) -> Model | None:
    """The logarithms of all n-grams; None if no group has counts. Orders up to ``shared_orders`` (below 4) are counted over all
    groups together and back off all of them alike."""
    size = len(groups)
    discounts, first, some = _parameters(_statistics(arrays, size, shared_orders), size, shared_orders)
    if not some.any():
        return None
    shared = arrays.sparkSession.sparkContext.broadcast((discounts, first, some))  # 2^16 symbols a group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        discounts, first, some = shared.value
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            keys, grps, counts = _together(rows)
            weights = {k: _weights(level, discounts[k]) for k, level in zip(range(ORDER, 1, -1), _levels(keys, grps, counts, size, shared_orders))}
            wanted, at = np.unique(keys, return_index=True)
            times = np.add.reduceat(counts, at)
            step = max(PENDING // 4 // size, 1)
            for lo in range(0, len(wanted), step):
                part = wanted[lo:lo + step]
                logs = np.where(some, np.log(_probabilities(part, ORDER, weights, first, size, shared_orders)), ABSENT).astype(np.float32)
                for batch in _batch("rng", range_of(part), (part, logs, times[lo:lo + step]), ["keys", "logs", "counts"]):
                    totals = [int(np.frombuffer(c, np.int64).sum()) for c in batch.column(3).to_pylist()]
                    yield batch.append_column("total", pa.array(totals, pa.int64()))

    values = store(_by_symbol(arrays).mapInArrow(run, "rng int, keys binary, logs binary, counts binary, total long"), "ngram-values")
    return Model(groups, values, values.agg(F.sum("total")).first()[0])


def _frequent(model: Model, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and logarithms of the n-grams with at least an ``entries``-th of all occurrences."""
    total, size = model.total, len(model.groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, logs, counts, _ in _rows(batches):
            often = np.frombuffer(counts, np.int64) * entries >= total
            if often.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.frombuffer(keys, np.uint64)[often].tobytes()], pa.binary()),
                     pa.array([np.frombuffer(logs, np.float32).reshape(-1, size)[often].tobytes()], pa.binary())], ["keys", "logs"])

    table = model.values.mapInArrow(run, "keys binary, logs binary").toArrow()  # at most ``entries`` n-grams
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    logs = np.frombuffer(b"".join(table.column("logs").to_pylist()), np.float32).reshape(-1, size)
    order = np.argsort(keys)
    return keys[order], logs[order]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _row_sums(rows: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """Add the values of each run of equal rows to its line of ``out``."""
    if len(rows):
        at = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
        np.add.at(out, rows[at], np.add.reduceat(values, at, axis=0))


def score(rows: DataFrame, model: Model, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``key, chars, letters, sums`` per row of (key, text): symbols and end marks, letters, and the log-likelihood in each group."""
    size = len(model.groups)
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(model, cache_bytes // (8 + 4 * size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = shared.value
        for batch in (part for whole in batches for part in _slices(whole)):
            n = batch.num_rows
            chars, letters, sums, rest = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, size)), Sums()
            for parts in pieces(t.as_py() for t in batch.column(1)):
                keys, own, found = ngrams(parts)
                chars += np.bincount(own, minlength=n)
                letters += np.bincount(found, minlength=n)
                distinct, which = np.unique(keys, return_inverse=True)
                at, hit = _found(known, distinct)
                values = np.zeros((len(distinct), size))
                values[hit] = logs[at[hit]] if len(logs) else 0.0
                _row_sums(own, values[which], sums)
                left = ~hit[which]
                rest.add(own[left], keys[left], np.ones(int(left.sum()), np.int64))
            own, keys, times = rest.result()
            offsets = pa.array(np.searchsorted(own, np.arange(n + 1)), pa.int32())
            open_ngrams = pa.StructArray.from_arrays(
                [pa.array(range_of(keys)), pa.array(keys.view(np.int64)), pa.array(times)], ["rng", "g", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chars), pa.array(letters), _lists(sums), pa.ListArray.from_arrays(offsets, open_ngrams)],
                ["key", "chars", "letters", "sums", "rest"])

    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL("chars long, letters long, sums array<double>, rest array<struct<rng: int, g: long, n: long>>").fields])
    parts = store(rows.select("key", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "text-values")
    more = _looked_up(parts.select("row", F.explode("rest").alias("x")).select("x.rng", "row", "x.g", "x.n"), model)
    more = more.groupBy(F.col("row").alias("m_row")).agg(*[F.sum(F.col("sums")[i]).alias(f"m{i}") for i in range(size)])
    total = F.array(*[F.col("sums")[i] + F.coalesce(F.col(f"m{i}"), F.lit(0.0)) for i in range(size)])
    return parts.drop("rest").join(more, F.col("row") == F.col("m_row"), "left").select("key", "chars", "letters", total.alias("sums"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of rows with about ``PIECE`` bytes of text, so that few rows' n-grams are open at once."""
    sizes = np.cumsum(pc.coalesce(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        before = sizes[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(sizes, before + PIECE, "right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def _lists(values: np.ndarray) -> pa.Array:
    """A list per row of a table of numbers."""
    rows, columns = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * columns, pa.int32()), pa.array(values.ravel()))


def _looked_up(asked: DataFrame, model: Model) -> DataFrame:
    """``row, sums`` in parts: the logarithms of n-grams (rng, row, g, n), found in their range's arrays."""
    size = len(model.groups)
    none = F.lit(None)
    arrays = model.values.select("rng", F.lit(0).alias("kind"), "keys", "logs", none.cast("long").alias("row"), none.cast("long").alias("g"), none.cast("long").alias("n"))
    wanted = asked.select("rng", F.lit(1).alias("kind"), none.cast("binary").alias("keys"), none.cast("binary").alias("logs"), "row", "g", "n")
    met = arrays.unionByName(wanted).repartition("rng").sortWithinPartitions("rng", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            stored, table = [], None
            while part := [row for _, row in zip(range(ROWS), rows)]:
                stored += [(np.frombuffer(r[2], np.uint64), np.frombuffer(r[3], np.float32).reshape(-1, size)) for r in part if r[1] == 0]
                open_rows = [r[4:] for r in part if r[1] == 1]
                if not open_rows:
                    continue
                if table is None:  # a range's arrays come before its questions
                    keys, logs = (np.concatenate(x) for x in zip(*stored))
                    order = np.argsort(keys)
                    table = keys[order], logs[order]
                own, g, n = np.array(open_rows, np.int64).T
                at, hit = _found(table[0], np.ascontiguousarray(g).view(np.uint64))
                if not hit.all():
                    raise ValueError("an n-gram of a text was not counted")
                distinct, which = np.unique(own, return_inverse=True)
                sums = np.zeros((len(distinct), size))
                np.add.at(sums, which, table[1][at] * n[:, None].astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(distinct), _lists(sums)], ["row", "sums"])

    return met.mapInArrow(run, "row long, sums array<double>")
