"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers encode the same bytes (a blank and the text), so each token
ends at a byte offset, and the offsets at which tokens of both end cut them
into groups. ``align`` finds them from the two sorted arrays of ends: at index
``i`` of one and ``i + shift`` of the other it compares a stretch of both, as
long again with every stretch that was equal (exponential probing), and jumps
to the first difference; what it passed are one-to-one groups. There the group
is irregular: whichever token ends first is stepped over until both end
together, and the difference of the two indices is the new shift. Many lanes
walk at once, one numpy operation a step for all of them: the documents of a
block lie behind one another (each one's end is an end of both), and a lane
starts about every ``LANE`` tokens, at the first end that both share.

A link is a token of each side that end together. The bytes of one are then the
end of the other's bytes, so the id pairs that can be linked follow from the two
vocabularies (``Pair.possible``): that bounds the table of corpus-wide counts,
which is summed by Spark, gathered and broadcast, whatever the corpus holds.

No token of either vocabulary holds a blank after its start but for white space
alone (``Pair`` checks it), so a text is encoded by its distinct stretches
between blanks, unless a blank stands at an end of it or between white space;
such texts are encoded whole, and all are if a vocabulary fails the check.

Defined cases: texts that are null or empty, or whose tokens do not spell the
bytes of the text, have no tokens; a null id stays null; repeated rows are
encoded, linked and counted as often as they occur; equal counts are all best;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

LANE = 256
SEEK = 16  # ends tried for a lane's start
BLOCK_TOKENS = 400_000
BLANK = "▁"
WHOLE = re.compile(r"  |\s \s|\A | \Z")  # blanks that a token may go across
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<int>, times array<int>"


def _byte_letters() -> dict[str, int]:
    """Letters of a byte-level vocabulary: printable Latin-1 bytes stand for themselves, the rest, in order, from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class Known(dict):
    """Ids of the chunks that are remembered; those of one text's other chunks are ``fresh``."""

    fresh: dict[str, bytes]

    def __missing__(self, chunk: str) -> bytes:
        return self.fresh[chunk]


class Pair:
    """The two tokenizers, the bytes of their tokens and the id pairs that can be linked."""

    def __init__(self, a_path: str, b_path: str, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        names = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = [b""] * (names[-1][0] + 1)
        for i, t in names:
            self.bytes_a[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode())
        self.by_blanks = not any(b" " in x[1:] and x.decode(errors="replace").strip() for x in self.bytes_a + self.bytes_b)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.keep = keep
        self.known_a, self.known_b = Known(), Known()
        self.bad: set[str] = set()

    def possible(self) -> np.ndarray:
        """Sorted ``a * len(bytes_b) + b`` of all ids whose bytes end alike, one within the other."""
        ids_a, ids_b, pairs = {}, {}, set()
        for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            for i, x in enumerate(table):
                ids.setdefault(x, []).append(i)
        n = len(self.bytes_b)
        for x, many in ids_a.items():
            for k in range(len(x)):
                pairs.update(i * n + j for j in ids_b.get(x[k:], ()) for i in many)
        for x, many in ids_b.items():
            for k in range(1, len(x)):
                pairs.update(i * n + j for i in ids_a.get(x[k:], ()) for j in many)
        return np.array(sorted(pairs), np.int64)

    def _spell(self, texts: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """Ids of each text (the blank before it included), or None where the tokens do not spell it."""
        found_a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        found_b = self.b.encode(texts, num_threads=1)
        for text, a, b in zip(texts, (x.ids for x in found_a), found_b):
            raw = (" " + text).encode()
            same = b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))
            yield (np.asarray(a, "<u4").tobytes(), np.asarray(b, "<u4").tobytes()) if same else None

    def _learn(self, chunks: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of each chunk by both; chunks that are not spelled are ``bad`` from now on."""
        new_a: dict[str, bytes] = {}
        new_b: dict[str, bytes] = {}
        inner = [c for c in chunks if not (c[0].isspace() or c[-1].isspace())]
        if inner and (ids := next(self._spell([" ".join(inner)]))):  # one text of all of them, cut where they end
            to = np.cumsum([1 + len(c.encode()) for c in inner])
            for new, lengths, raw in ((new_a, self.len_a, ids[0]), (new_b, self.len_b, ids[1])):
                cut = [0, *(4 + 4 * np.searchsorted(np.cumsum(lengths[np.frombuffer(raw, "<u4")]), to)).tolist()]
                new.update((c, raw[x:y]) for c, x, y in zip(inner, cut, cut[1:]))
        rest = [c for c in chunks if c not in new_a]
        for chunk, ids in zip(rest, self._spell(rest) if rest else ()):
            if ids is None:
                if len(self.bad) >= self.keep:
                    self.bad.clear()
                self.bad.add(chunk)
            new_a[chunk], new_b[chunk] = ids or (b"", b"")
        return new_a, new_b

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Little-endian unsigned 32-bit ids of both; empty where there are none.

        The first ``keep`` chunks met are remembered, so nearly all frequent
        ones; later ones are encoded anew with each text.
        """
        if not text:
            return b"", b""
        if not self.by_blanks or WHOLE.search(text):
            return next(self._spell([text])) or (b"", b"")
        chunks = text.split(" ")
        known_a, known_b = self.known_a, self.known_b
        missing = [c for c in set(chunks) if c not in known_a]
        if not missing:
            return b"".join(map(known_a.__getitem__, chunks)), b"".join(map(known_b.__getitem__, chunks))
        if not self.bad.isdisjoint(missing):
            return b"", b""
        new_a, new_b = self._learn(sorted(missing))
        if not self.bad.isdisjoint(missing):
            return b"", b""
        if len(known_a) + len(new_a) <= self.keep:
            known_a.update(new_a)
            known_b.update(new_b)
        known_a.fresh, known_b.fresh = new_a, new_b
        return b"".join(map(known_a.__getitem__, chunks)), b"".join(map(known_b.__getitem__, chunks))


@lru_cache(maxsize=1)
def worker_pair(a_path: str, b_path: str) -> Pair:
    """The pair of a worker process, kept for its next tasks."""
    return Pair(a_path, b_path)


def align(ends_a: np.ndarray, ends_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the groups, as counts of tokens of each side, from two rising arrays of byte ends whose last ends are equal."""
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.zeros(1, np.int64), np.zeros(1, np.int64)
    marks = np.arange(lane, len(ends_a), lane)
    if len(marks):
        tried = np.minimum(marks[:, None] + np.arange(SEEK), len(ends_a) - 1)
        place = np.searchsorted(ends_b, ends_a[tried])
        shared = ends_b[place] == ends_a[tried]
        first = shared.argmax(axis=1)[:, None]
        found = shared.any(axis=1)
        start_a = np.unique(np.take_along_axis(tried, first, 1)[found, 0] + 1)
        start_b = np.unique(np.take_along_axis(place, first, 1)[found, 0] + 1)
        inside = start_a < len(ends_a)
        at = np.concatenate([at[0], start_a[inside]]), np.concatenate([at[1], start_b[inside]])
    stop_a, stop_b = np.append(at[0][1:], len(ends_a)), np.append(at[1][1:], len(ends_b))
    i, shift = at[0].copy(), at[1] - at[0]
    probe = np.full(len(i), 2)
    live = np.arange(len(i))
    cuts_a, cuts_b = [], []
    while len(live):
        here = i[live]
        size = np.minimum(probe[live], np.minimum(stop_a[live] - here, stop_b[live] - here - shift[live]))
        begin = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(begin, size)
        index_a = np.repeat(here, size) + step
        index_b = index_a + np.repeat(shift[live], size)
        equal = ends_a[index_a] == ends_b[index_b]
        run = np.minimum.reduceat(np.where(equal, np.repeat(size, size), step), begin)  # one-to-one groups of each lane
        passed = step < np.repeat(run, size)
        cuts_a.append(index_a[passed] + 1)
        cuts_b.append(index_b[passed] + 1)
        whole = run == size
        probe[live] = np.where(whole, 2 * size, 2)
        i[live] = here + run
        odd = live[~whole]
        x, y = i[odd], i[odd] + shift[odd]
        while len(odd):
            end_x, end_y = ends_a[x], ends_b[y]
            met = end_x == end_y
            cuts_a.append(x[met] + 1)
            cuts_b.append(y[met] + 1)
            i[odd[met]] = x[met] + 1
            shift[odd[met]] = y[met] - x[met]
            x, y, odd = (x + (end_x < end_y))[~met], (y + (end_y < end_x))[~met], odd[~met]
        live = live[i[live] < stop_a[live]]
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Writer:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``, for many tokens at once."""

    def __init__(self, n_ids: int):
        self.width = len(str(n_ids - 1))
        self.digits = np.frombuffer("".join(f"{k:>{self.width}}" + " " for k in range(n_ids)).encode(), np.uint8).reshape(n_ids, self.width + 1)
        self.shown = self.digits != 32
        self.shown[:, -1] = True

    def write(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text of all groups, each with a ``;`` behind it, and where each group's text ends."""
        size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        both = np.empty(len(ids_a) + len(ids_b), np.int64)
        both[np.arange(len(ids_a)) + np.repeat(cuts_b - size_b, size_a)] = ids_a
        both[np.arange(len(ids_b)) + np.repeat(cuts_a, size_b)] = ids_b
        letters = self.digits[both]
        letters[:, -1] = ord(",")
        last = cuts_a + cuts_b - 1
        letters[last - size_b, -1] = ord("|")
        letters[last, -1] = ord(";")
        shown = self.shown[both]
        return letters[shown].tobytes(), np.cumsum(shown.sum(axis=1))[last]


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ids, numbers of tokens and groups, the groups as text, and its distinct links as places in ``Pair.possible`` with how often each occurs."""

    def finish(pair: Pair, possible: np.ndarray, writer: Writer, rows: list[tuple]) -> pa.RecordBatch:
        n_a = np.array([len(a) // 4 for _, a, _ in rows], np.int64)
        n_b = np.array([len(b) // 4 for _, _, b in rows], np.int64)
        ids_a = np.frombuffer(b"".join(a for _, a, _ in rows), "<u4").astype(np.int64)
        ids_b = np.frombuffer(b"".join(b for _, _, b in rows), "<u4").astype(np.int64)
        cuts_a, cuts_b = align(np.cumsum(pair.len_a[ids_a]), np.cumsum(pair.len_b[ids_b]))
        groups_to = np.searchsorted(cuts_a, np.cumsum(n_a), side="right")  # groups up to each row's end
        n_groups = np.diff(groups_to, prepend=0)
        text, text_ends = writer.write(ids_a, ids_b, cuts_a, cuts_b)
        text_to = np.concatenate([[0], text_ends])[groups_to]
        parts = [text[e - s:max(e - 1, e - s)].decode() for e, s in zip(text_to.tolist(), np.diff(text_to, prepend=0).tolist())]
        n_possible = len(possible)
        links = np.searchsorted(possible, ids_a[cuts_a - 1] * len(pair.bytes_b) + ids_b[cuts_b - 1])
        found, times = np.unique(np.repeat(np.arange(len(rows)), n_groups) * n_possible + links, return_counts=True)
        offsets = pa.array(np.searchsorted(found, np.arange(len(rows) + 1) * n_possible), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(parts, pa.string()),
             pa.ListArray.from_arrays(offsets, pa.array((found % n_possible).astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
            ["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_pair(a_path, b_path)
        possible, writer = pair.possible(), Writer(max(len(pair.bytes_a), len(pair.bytes_b)))
        rows, tokens = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                a, b = pair.encode(text.as_py())
                rows.append((doc, a, b))
                tokens += (len(a) + len(b)) // 4
                if tokens > BLOCK_TOKENS:
                    yield finish(pair, possible, writer, rows)
                    rows, tokens = [], 0
        if rows:
            yield finish(pair, possible, writer, rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, ALIGNED)


def link_counts(aligned: DataFrame, n_possible: int) -> DataFrame:
    """``pair, n``: how many links of the whole corpus hold each pair. A task sends each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_possible, np.int64)
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 1))
            total += np.bincount(pairs, times, n_possible).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["pair", "n"])

    return aligned.select("pairs", "times").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def rate_links(aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``aligned`` without its links, with ``n_links, n_best, count_sum``.

    ``counts`` has at most one row for each possible pair of the vocabularies,
    so it is gathered and broadcast.
    """
    pair = Pair(a_path, b_path)
    possible, n_b = pair.possible(), len(pair.bytes_b)
    rows = counts.toPandas()
    total = np.zeros(len(possible), np.int64)
    total[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    most = np.zeros(n_b, np.int64)
    np.maximum.at(most, possible % n_b, total)
    spread = aligned.sparkSession.sparkContext.broadcast((total, total == most[possible % n_b]))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, best = spread.value
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pairs", "times"))
            to = np.cumsum([0, *(len(x) for x in batch.column("pairs"))])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[to]) for v in (times, times * best[pairs], times * total[pairs])]
            columns = [batch.column(c) for c in kept] + [pa.array(v.astype(np.int64)) for v in sums]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_links", "n_best", "count_sum"])

    types = dict(aligned.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", n_links long, n_best long, count_sum long"
    return aligned.mapInArrow(run, schema)
