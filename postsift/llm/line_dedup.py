"""Removal of lines that occur in more than one document.

The key of a line is the line without blanks at both ends and with A-Z in
lower case. A key of at least ``min_chars`` code points that two documents
hold loses all its lines except those in the smallest document id holding it.

Two Bloom filters find the suspects. Every task marks the keys it meets in a
once-seen filter and those it may have met before in a twice-seen filter; the
filters of all tasks are merged in parallel, range by range (twice = either
twice, or both once). Only lines that the merged twice-seen filter holds are
shuffled: as 128-bit hashes with their document id, pre-aggregated to the
smallest and largest id of each hash, which confirms a repeat exactly (up to
128-bit collisions) and names the document that keeps it.

The filters have a fixed number of bits whatever the input, so what is
broadcast is bounded by ``2 ** bits / 8`` bytes; with more lines than bits
more lines become suspects and are shuffled, and the result is the same.

Defined cases: a null or empty text is one empty line; a null id is one
document that comes after all others; repeated rows of one id are the same
document (both keep their lines); an empty table gives no rows; columns named
in ``carry`` are passed on under their names, all others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store, text_or_empty

BLANKS = " \t\n\x0b\x0c\r"
RANGE_BITS = 20  # bits of one range of a filter
LAST_ID = (1 << 63) - 1


def line_hash(line: str, min_chars: int) -> bytes | None:
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two places in the filter for every hash (rows of two unsigned 64-bit numbers)."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _distinct_hashes(text: str, min_chars: int) -> set[bytes]:
    found = {line_hash(line, min_chars) for line in text.split("\n")}
    found.discard(None)
    return found


def _as_pairs(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), ">u8").reshape(-1, 2).astype(np.uint64)


def _encode(flags: np.ndarray) -> bytes:
    """Set places as numbers or as bits, whichever is shorter; the first byte tells."""
    places = np.flatnonzero(flags).astype("<u4")
    return b"p" + places.tobytes() if len(places) * 4 < len(flags) // 8 else b"b" + np.packbits(flags).tobytes()


def _decode(data: bytes) -> np.ndarray:
    if data[:1] == b"b":
        return np.unpackbits(np.frombuffer(data, np.uint8, offset=1)).view(bool)
    flags = np.zeros(1 << RANGE_BITS, bool)
    flags[np.frombuffer(data, "<u4", offset=1)] = True
    return flags


def twice_seen_filter(docs: DataFrame, bits: int, min_chars: int) -> bytes:
    """The merged twice-seen filter (2 ** bits bits) over the lines of ``docs`` (id, text)."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                hashes = [h for t in batch.column(1)[at:at + 256] for h in _distinct_hashes(t.as_py(), min_chars)]
                if not hashes:
                    continue
                pairs = _as_pairs(hashes)
                again = np.zeros(len(pairs), bool)
                _, first = np.unique(pairs[:, 0], return_index=True)
                again[first] = True
                again = ~again  # met before in this slice
                p = _positions(pairs, bits)
                again |= once[p[:, 0]] & once[p[:, 1]]
                twice[p[again].ravel()] = True
                once[p.ravel()] = True
        rows = []
        for k in range(1 << (bits - RANGE_BITS)):
            part = slice(k << RANGE_BITS, (k + 1) << RANGE_BITS)
            if once[part].any():
                rows.append((k, _encode(once[part]), _encode(twice[part])))
        yield pa.RecordBatch.from_pylist(
            [{"k": k, "once": o, "twice": t} for k, o, t in rows],
            pa.schema([("k", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, o, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                o, t = _decode(o), _decode(t)
                if k in state:
                    once, twice = state[k]
                    twice |= t | (once & o)
                    once |= o
                else:
                    state[k] = [o.copy(), t.copy()]
        yield pa.RecordBatch.from_pylist(
            [{"k": k, "twice": np.packbits(t).tobytes()} for k, (_, t) in state.items()],
            pa.schema([("k", pa.int32()), ("twice", pa.binary())]))

    ranges = 1 << (bits - RANGE_BITS)
    marked = docs.mapInArrow(mark, "k int, once binary, twice binary")
    merged = marked.repartition(ranges, "k").mapInArrow(merge, "k int, twice binary")
    width = 1 << (RANGE_BITS - 3)
    out = bytearray(ranges * width)
    for row in merged.toLocalIterator():
        out[row["k"] * width:(row["k"] + 1) * width] = row["twice"]
    return bytes(out)


def repeated_lines(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """``id, drop``: for each document the 16-byte hashes of the lines it loses."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(twice_seen_filter(docs, bits, min_chars))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)

        def held(p: np.ndarray) -> np.ndarray:
            return (twice[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 1024):
                owner, hashes = [], []
                for i, t in zip(ids[at:at + 1024], batch.column(1)[at:at + 1024]):
                    found = _distinct_hashes(t.as_py(), min_chars)
                    owner += [i] * len(found)
                    hashes += found
                if not hashes:
                    continue
                pairs = _as_pairs(hashes)
                p = _positions(pairs, bits)
                keep = held(p[:, 0]) & held(p[:, 1])
                pairs = pairs[keep].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(owner, np.int64)[keep]), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "h1", "h2"])

    found = store(docs.mapInArrow(suspects, "id long, h1 long, h2 long"), "line-suspects")
    repeats = found.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).where("keeper < last")
    lost = found.join(repeats.select("h1", "h2", "keeper"), ["h1", "h2"]).where("id <> keeper").select("id", "h1", "h2").distinct()
    return lost.groupBy("id").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, bits: int = 26, carry: list[str] | None = None,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents with ``n_lines, n_dropped, kept_text`` next to the columns in ``carry`` (default: the id)."""
    carry = carry or [id_col]
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    lines = docs.select(key.alias("id"), text_or_empty(text_col).alias("text"))
    lost = repeated_lines(lines, bits, min_chars)
    whole = docs.select(key.alias("id"), text_or_empty(text_col).alias("text"), F.struct(*[F.col(c) for c in carry]).alias("row"))
    joined = whole.join(lost, "id", "left").select("text", "drop", "row")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, drop in zip(batch.column(0), batch.column(1)):
                lines = text.as_py().split("\n")
                n_lines.append(len(lines))
                if drop.is_valid:
                    gone = {int(d["h1"]).to_bytes(8, "big", signed=True) + int(d["h2"]).to_bytes(8, "big", signed=True) for d in drop.as_py()}
                    lines = [x for x in lines if line_hash(x, min_chars) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append("\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_lines", "n_dropped", "kept_text"])

    schema = T.StructType([joined.schema["row"], T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(rewrite, schema).select("row.*", "n_lines", "n_dropped", "kept_text")
