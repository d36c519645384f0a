"""Fingerprints, edited texts and the radius search against direct computations."""

import random

import pytest
from pyspark.sql import functions as F

from postsift.llm import simhash


def test_edited_text_and_next_document(table):
    rng = random.Random(4)
    rows = [(i * 7 % 101, "".join(rng.choices("abc é😀\n", k=rng.randint(0, 40)))) for i in range(90)]
    rows += [(500, None), (None, "null id text"), (11, "a repeat of eleven"), (-5, "negative")]
    docs = table([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, next string, place int")
    got = sorted(((r["doc_id"], r["n_chars"], r["edited_text"]) for r in simhash.edited(docs).collect()), key=repr)
    smallest = {}
    for d, t in rows:
        k = float("-inf") if d is None else d
        smallest[k] = min(smallest.get(k, t or ""), t or "")
    order = sorted(smallest)
    expected = []
    for d, t in rows:
        k, t = (float("-inf") if d is None else d), t or ""
        following = smallest[order[order.index(k) - 1]]
        cut = len(t) // 3
        expected.append((d, len(t), t[:len(t) - cut] + following[:cut]))
    assert got == sorted(expected, key=repr)


def test_one_document_follows_itself_and_empty_table(table, spark):
    assert [r["edited_text"] for r in simhash.edited(table([(1, "abcdef")], "doc_id long, text string")).collect()] == ["abcdab"]
    assert simhash.edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text", [" ".join(f"word{i}" for i in range(7000)) + " a bb",  # more than one chunk
                                  " ".join(f"longestwords{i:05}" for i in range(9000)), " ".join(f"longestwords{i:05}" for i in range(13))])
def test_fingerprint_votes(spark, text):
    df = simhash.with_fingerprint(spark.createDataFrame([(text,), ("",), ("Same words here",), ("same  WORDS here",)], "text string"), "text", "fp")
    got = [r["fp"] for r in df.collect()]
    terms = spark.createDataFrame([(w,) for w in text.split()], "w string").select("w", F.xxhash64("w").alias("h0"), F.xxhash64("w", F.lit(1)).alias("h1")).collect()
    votes = [0] * 128
    for r in terms:
        weight = max(1, min(len(r["w"]) - 2, 10))
        for k, h in enumerate((r["h0"], r["h1"])):
            for b in range(64):
                votes[64 * k + b] += weight if h >> b & 1 else -weight
    # digit j holds bits 4 j to 4 j + 3, the first as the highest
    assert got[0] == "".join("%x" % sum((votes[4 * j + i] > 0) << (3 - i) for i in range(4)) for j in range(32))
    assert got[1] == "0" * 32 and got[2] == got[3]


def test_terms_are_cut_once(spark):
    """No cut of a cut, which copied a chunk for every few terms; whole chunks and whole fews count every term."""
    df = spark.createDataFrame([(n, " ".join(f"longestwords{i:05}" for i in range(n))) for n in (12, simhash.CHUNK, 2 * simhash.CHUNK)], "n int, text string")
    out = simhash.with_fingerprint(df, "text", "fp")
    assert "slice(slice(" not in out._jdf.queryExecution().analyzed().toString()
    for r in out.collect():
        votes = [0] * 128
        hashes = spark.range(r["n"]).select(F.concat(F.lit("longestwords"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("w")).select(F.xxhash64("w"), F.xxhash64("w", F.lit(1)))
        for h in hashes.collect():
            for b in range(128):
                votes[b] += 1 if h[b // 64] >> b % 64 & 1 else -1
        assert r["fp"] == "".join("%x" % sum((votes[4 * j + i] > 0) << (3 - i) for i in range(4)) for j in range(32))


def test_radius_search_equals_all_pairs(spark):
    rng = random.Random(6)
    prints = []
    for _ in range(30):
        base = rng.getrandbits(128)
        prints += ["%032x" % (base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 6)))) for _ in range(6)]
    df = spark.createDataFrame([(p,) for p in prints + prints[:5]], "fingerprint string")
    for radius in (0, 3, 4):
        got = sorted(tuple(r) for r in simhash.neighbours(df, df, radius).collect()) if radius else None
        expected = sorted((a, b, d) for a in set(prints) for b in set(prints) if (d := bin(int(a, 16) ^ int(b, 16)).count("1")) <= radius)
        assert got is None or got == expected
    counts = {r["fingerprint"]: r["n_near"] for r in simhash.count_near(df, F.lit(True), 3).collect()}
    assert counts[prints[0]] == sum(bin(int(prints[0], 16) ^ int(p, 16)).count("1") <= 3 for p in prints + prints[:5])


def test_likeness(spark):
    a = "0" * 32
    row = spark.createDataFrame([(a, "f" + "0" * 31)], "a string, b string").select(
        simhash.likeness(F.col("a"), F.col("b")).alias("x"), simhash.likeness(F.col("a"), F.col("a")).alias("y")).first()
    assert (row["x"], row["y"]) == (1 - 4 / 128, 1.0)
