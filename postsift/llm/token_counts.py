"""Token counts under a unigram model, by dynamic programming shared along a trie.

A text is split at blanks into pre-tokens, each with the word-start mark in
front. The distinct new pre-tokens of a stretch of documents, sorted, form a
trie: a node is a prefix, held by the first pre-token that has it. Level by
level, each node gets the forward (best path) score and token count of its
prefix, computed once for all pre-tokens that share it; the count at the last
node is kept for the pre-token. A document's count is the sum over its
pre-tokens. Pieces are found by rolling hashes in sorted arrays.

The pieces come from a public vocabulary file. That file ranks its pieces and
has no probabilities, so a piece of rank r gets the log-probability of Zipf's
law, ``-log(r + 2)``. A character outside the vocabulary costs ten more than
the worst piece and counts as its UTF-8 bytes. Equal scores take the longer
last piece.

The trie lives in the task that reads the documents: nothing is shuffled, and
memory is bounded by ``BATCH`` pre-tokens of up to ``max_shared`` characters
and ``max_kept`` kept counts (they are then counted anew, results do not
depend on it). Longer pre-tokens are counted on their own.

Defined cases: null, empty and blank texts have no pre-tokens and no tokens; a
null id stays null; repeated rows give repeated results; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

WORD_START = "▁"
BATCH = 20_000
STRETCH = 2_000_000  # characters
PRE_TOKEN = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(text)


def zipf_pieces(model_path: str) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece file with their log-probabilities by rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    kept = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(kept)}


class TrieCounter(dict):
    """Token counts by pre-token; missing ones are counted together along their trie."""

    MIX = 0x9E3779B97F4A7C15

    def __init__(self, pieces: dict[str, float], max_kept: int, max_shared: int):
        super().__init__()
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.unknown = min(pieces.values()) - 10.0
        self.max_kept, self.max_shared = max_kept, max_shared
        # pieces by length: sorted hashes and their scores
        self.tables = {}
        for n in range(1, self.longest + 1):
            same = [(self._hash(p), s) for p, s in pieces.items() if len(p) == n]
            keys = np.array([k for k, _ in same], np.uint64)
            order = np.argsort(keys)
            self.tables[n] = keys[order], np.array([s for _, s in same])[order]

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * self.MIX + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _alone(self, word: str) -> int:
        """One long pre-token on its own."""
        scores, counts = [0.0], [0]
        for end in range(1, len(word) + 1):
            best, n = -math.inf, 0
            for start in range(max(0, end - self.longest), end):
                s = self.pieces.get(word[start:end])
                if s is not None and scores[start] + s > best:
                    best, n = scores[start] + s, counts[start] + 1
            if word[end - 1] not in self.pieces and scores[end - 1] + self.unknown > best:
                best, n = scores[end - 1] + self.unknown, counts[end - 1] + utf8_bytes(ord(word[end - 1]))
            scores.append(best)
            counts.append(n)
        return counts[-1]

    def _along_trie(self, words: list[str]) -> np.ndarray:
        """Counts of sorted distinct words; row i holds the path of word i, each node is computed in the row that first reaches it."""
        n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
        depth = int(lengths.max())
        codes = np.zeros((n, depth), np.uint32)
        codes[np.arange(depth) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        same = np.cumprod(codes[1:] == codes[:-1], axis=1, dtype=bool)
        shared = np.concatenate([[0], same.sum(axis=1)])
        hashes = np.zeros((n, depth + 1), np.uint64)
        score = np.zeros((n, depth + 1))
        count = np.zeros((n, depth + 1), np.int32)
        mix = np.uint64(self.MIX)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, mix)]), dtype=np.uint64)
        row = np.arange(n)
        for end in range(1, depth + 1):
            last = codes[:, end - 1].astype(np.uint64)
            hashes[:, end] = hashes[:, end - 1] * mix + last + np.uint64(1)
            own = np.flatnonzero((end > shared) & (end <= lengths))  # nodes of this depth
            best, tokens = np.full(len(own), -np.inf), np.zeros(len(own), np.int32)
            for size in range(min(self.longest, end), 0, -1):
                keys, values = self.tables[size]
                if not len(keys):
                    continue
                wanted = hashes[own, end] - hashes[own, end - size] * powers[size]
                at = np.searchsorted(keys, wanted)
                at[at == len(keys)] = 0
                hit = keys[at] == wanted
                total = np.where(hit, score[own, end - size] + values[at], -np.inf)
                better = total > best
                best = np.where(better, total, best)
                tokens = np.where(better, count[own, end - size] + 1, tokens)
                if size == 1:
                    total = np.where(hit, -np.inf, score[own, end - 1] + self.unknown)
                    better = total > best
                    best = np.where(better, total, best)
                    tokens = np.where(better, count[own, end - 1] + utf8_bytes(codes[own, end - 1]), tokens)
            score[own, end], count[own, end] = best, tokens
            first = np.zeros(n, np.int64)
            first[own] = own
            first = np.maximum.accumulate(first)  # the row that holds the node of each word's prefix
            score[:, end], count[:, end] = score[first, end], count[first, end]
        return count[row, lengths]

    def counts(self, words: list[str]) -> np.ndarray:
        if len(self) > self.max_kept:
            self.clear()
        missing = set(words).difference(self)
        if missing:
            long = [w for w in missing if len(w) >= self.max_shared]
            self.update((w, self._alone(WORD_START + w)) for w in long)
            short = sorted(missing.difference(long))
            for at in range(0, len(short), BATCH):
                part = short[at:at + BATCH]
                self.update(zip(part, self._along_trie([WORD_START + w for w in part]).tolist()))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def utf8_bytes(code):
    return 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF) * 1


def count_tokens(docs: DataFrame, model_path: str, max_kept: int = 500_000, max_shared: int = 48,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(zipf_pieces(model_path), max_kept, max_shared)
        for batch in batches:
            n_pre, n_tok = [], []
            words, ends, size = [], [0], 0

            def finish() -> None:
                total = np.concatenate([[0], np.cumsum(counter.counts(words))])[ends]
                n_pre.extend(np.diff(ends))
                n_tok.extend(np.diff(total))

            for text in batch.column(1):
                found = pre_tokens(text.as_py())
                words += found
                ends.append(len(words))
                size += sum(map(len, found))
                if size > STRETCH:
                    finish()
                    words, ends, size = [], [0], 0
            finish()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_pre, pa.int64()), pa.array(n_tok, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
