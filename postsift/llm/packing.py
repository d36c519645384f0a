"""Cost-balanced packing of documents into training sequences.

Every document becomes its token ids plus one end id. A document is cut into
pieces; each id lies in exactly one piece, and a sequence holds at most
``seq_len`` ids. Whole pieces of ``seq_len`` ids are sequences of their own.
The remainders of a block of documents are assigned in descending length to
the sequence with the lowest cost so far that still has room for all of it;
the cost of a piece is ``linear * n + quadratic * n ** 2`` (attention inside a
piece grows with its square). A remainder that fits nowhere whole is cut at
the sequence with the most room.

The sequences of a block have exactly the room that its remainders need: as
many of ``seq_len`` as are full, then one for each binary digit of what is
left. Lengths that are powers of two need no padding, so no id is padded.

Blocks are formed inside the tasks that read the documents (at most
``block_docs`` documents and ``block_tokens`` ids, or one longer document), so
nothing is shuffled, memory does not grow with the input, and a task that is
run again gives the same pieces under the same ids.

Defined cases: a null or empty text is one end id; a null id stays null;
repeated rows are packed as often as they occur; ties in length keep the order
of the rows, ties in cost take the first sequence; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
END_TEXT = "<|endoftext|>"
# Below this code point the two tokenizer libraries are known to agree.
LATIN_END = "ɐ"


class ChunkTokenizer:
    """Token ids of a text by the vocabulary file, with the ids of space-separated chunks kept.

    A pre-token never goes on past a blank, so a text without two blanks in a
    row is the concatenation of its chunks. Chunks of Latin letters are encoded
    from the same merge ranks by the faster library, all others (and texts that
    hold the special token's string) by the vocabulary file itself.
    """

    def __init__(self, vocab_path: str, ranks_path: str | None, keep: int = 400_000):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(vocab_path)
        self.fast = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.keep = keep
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.fast is not None and max(chunk) < LATIN_END:
            return np.asarray(self.fast.encode_ordinary(chunk), "<u4").tobytes()
        return self._whole(chunk)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if "  " in text or END_TEXT in text:
            if self.fast is not None and END_TEXT not in text and max(text) < LATIN_END:
                return np.asarray(self.fast.encode_ordinary(text), "<u4").tobytes()
            return self._whole(text)
        first, *rest = text.split(" ")
        chunks = ([first] if first else []) + [" " + c for c in rest]
        known = self.known
        if len(known) > self.keep:
            known.clear()
        try:
            return b"".join([known[c] for c in chunks])
        except KeyError:
            for c in chunks:
                if c not in known:
                    known[c] = self._chunk(c)
            return b"".join([known[c] for c in chunks])


def sequence_lengths(total: int, seq_len: int) -> list[int]:
    """Lengths that sum to ``total``: full ones, then descending powers of two."""
    lengths = [seq_len] * (total // seq_len)
    rest = total % seq_len
    bit = 1 << max(rest.bit_length() - 1, 0)
    while rest:
        if rest & bit:
            lengths.append(bit)
            rest -= bit
        bit >>= 1
    return lengths


def assign(sizes: list[int], seq_len: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of one block and its number of sequences."""
    pieces = []
    n_seq = 0
    rests = []
    for doc, n in enumerate(sizes):
        for k in range(n // seq_len):
            pieces.append((doc, k * seq_len, seq_len, n_seq, 0))
            n_seq += 1
        if n % seq_len:
            rests.append((doc, n - n % seq_len, n % seq_len))
    room = np.array(sequence_lengths(sum(r[2] for r in rests), seq_len), np.int64)
    used = np.zeros(len(room), np.int64)
    cost = np.zeros(len(room))
    for doc, start, n in sorted(rests, key=lambda r: (-r[2], r[0])):
        while n:
            best = int(np.where(room >= n, cost, np.inf).argmin())
            if room[best] < n:  # no sequence takes it whole
                best = int(room.argmax())
            take = min(n, int(room[best]))
            pieces.append((doc, start, take, n_seq + best, int(used[best])))
            room[best] -= take
            used[best] += take
            cost[best] += linear * take + quadratic * take * take
            start, n = start + take, n - take
    return pieces, n_seq + len(room)


def pack(docs: DataFrame, vocab_path: str, ranks_path: str | None = None, end_id: int = 0, seq_len: int = 1024,
         linear: float = 1.0, quadratic: float = 1.0 / 256, block_docs: int = 4096, block_tokens: int = 4_000_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, one row each, with their ids as little-endian unsigned 32-bit numbers.

    ``ranks_path`` may name the same vocabulary as merge ranks (faster for Latin text).
    """

    def blocks(batches) -> Iterator[tuple[list, list[bytes]]]:
        tok = ChunkTokenizer(vocab_path, ranks_path)
        end = np.asarray([end_id], "<u4").tobytes()
        ids, encoded, tokens = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                e = tok.encode(text.as_py() or "") + end
                ids.append(doc)
                encoded.append(e)
                tokens += len(e) // 4
                if len(ids) >= block_docs or tokens >= block_tokens:
                    yield ids, encoded
                    ids, encoded, tokens = [], [], 0
        if ids:
            yield ids, encoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for ids, encoded in blocks(batches):
            sizes = [len(e) // 4 for e in encoded]
            pieces, n = assign(sizes, seq_len, linear, quadratic)
            columns = [
                pa.array([ids[p[0]] for p in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([encoded[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in pieces], pa.binary()),
                pa.array([sizes[p[0]] for p in pieces], pa.int64()),
                pa.array([first + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            first += n

    narrow = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    return narrow.mapInArrow(run, SCHEMA)
