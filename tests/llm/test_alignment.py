"""Alignment: against a plain intersection of ends, whole encoding and a recount of all links."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from postsift.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(A, B)


def brute(docs):
    """doc_id -> the row of the contract, from whole texts and sets of ends."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    letters = alignment._byte_letters()
    rows, count = [], Counter()
    for doc, text in docs:
        raw = (" " + (text or "")).encode()
        a = [(i, bytes(letters[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(raw.decode(), add_special_tokens=False).ids]
        b = [(i, bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()) for i in b_tok.encode(text or "")]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            rows.append((doc, [], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b))
        shared = sorted(set(ends_a) & set(ends_b))
        groups, links, last = [], [], 0
        for end in shared:
            in_a = [i for (i, _), e in zip(a, ends_a) if last < e <= end]
            in_b = [i for (i, _), e in zip(b, ends_b) if last < e <= end]
            groups.append(",".join(map(str, in_a)) + "|" + ",".join(map(str, in_b)))
            links.append((in_a[-1], in_b[-1]))
            last = end
        rows.append((doc, a, b, groups, links))
        count.update(links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(doc, len(a), len(b), len(g), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for doc, a, b, g, links in rows]


def result(table, docs):
    aligned = alignment.align_documents(table(docs, "doc_id long, text string, pairs string, n int").drop("x"), A, B)
    aligned = aligned.withColumn("sha", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups").cache()
    n = len(alignment.Pair(A, B).possible())
    out = alignment.rate_links(aligned, alignment.link_counts(aligned, n), A, B)
    return [tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha").collect()]


def test_documents(spark, table):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    docs = [(r[0], r[1]) for r in given.collect()]
    odd = ["", None, " ", "  two  blanks ", "tab\tand\nline \n end", "special <|endoftext|> <s></s><unk> text", "mark ▁ here", "日本語 テキスト 😀", "a", "\x00\x01",
           "don't stop", "word " * 3000 + "end", "x" * 5000, "same text", "same text"]
    docs += [(10_000 + k, t) for k, t in enumerate(odd)] + [(None, "no id"), (10_001, "an id again")]
    rows = [(d, t, "clash", 1) for d, t in docs]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(result(table, rows), key=key) == sorted(brute(docs), key=key)


def test_empty_table(table):
    assert result(table, []) == []


def test_by_blanks_is_whole(pair):
    draw = random.Random(3)
    letters = list("ab  \n\t'sé中ß1.,<|>▁ 　\x00\x1c😀 the") + ["the ", "<s>", "<|endoftext|>", "\n \n"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 30))) for _ in range(5000)]
    small = alignment.Pair(A, B, keep=50)  # forgets all the time
    for text, whole in zip(texts, pair._spell(texts)):
        assert pair.encode(text) == small.encode(text) == (whole or (b"", b""))


@pytest.mark.parametrize("lane", [1, 7, 256, 10**6])
def test_align_is_the_intersection(lane):
    draw = np.random.default_rng(lane)
    for size, share in ((1, 1.0), (50, 0.5), (3000, 0.9), (3000, 0.02), (20_000, 0.999)):
        a, b = (np.unique(np.append(draw.permutation(size)[:max(1, int(size * share))], size)) + 1 for _ in range(2))
        cuts_a, cuts_b = alignment.align(a, b, lane)
        shared = np.intersect1d(a, b)
        assert np.array_equal(a[cuts_a - 1], shared) and np.array_equal(b[cuts_b - 1], shared)


def test_possible_pairs_end_alike(pair):
    found = pair.possible()
    n = len(pair.bytes_b)
    for k in random.Random(1).sample(range(len(found)), 2000):
        a, b = pair.bytes_a[found[k] // n], pair.bytes_b[found[k] % n]
        assert a.endswith(b) or b.endswith(a)
    some_a, some_b = random.Random(2).sample(range(len(pair.bytes_a)), 300), random.Random(3).sample(range(n), 300)
    known = set(found.tolist())
    for i in some_a:
        for j in some_b:
            alike = pair.bytes_a[i].endswith(pair.bytes_b[j]) or pair.bytes_b[j].endswith(pair.bytes_a[i])
            assert alike == (i * n + j in known)
