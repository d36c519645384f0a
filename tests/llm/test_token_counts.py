"""Counts equal to a unigram tokenizer with the same pieces and scores."""

import random

import public_tokenizers
from tokenizers import Tokenizer, models

from postsift.llm import token_counts as tc

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def expected(text, unigram):
    total = 0
    for w in tc.pre_tokens(text or ""):
        e = unigram.encode(tc.WORD_START + w)
        for i, (a, b) in zip(e.ids, e.offsets):
            total += len((tc.WORD_START + w)[a:b].encode()) if i == 0 else 1
    return total


def test_counts_equal_the_library(table):
    pieces = tc.zipf_pieces(MODEL)
    unigram = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], 0, False))
    rng = random.Random(3)
    texts = [None, "", "  \n", "The quick brown fox", "naïve café 日本語 😀😀 x", "a" * 300, "wordwordword " * 50, "same", "same"]
    texts += [" ".join("".join(rng.choices("abcdeiéß日", k=rng.randint(1, 60))) for _ in range(20)) for _ in range(30)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")]
    got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in tc.count_tokens(table(rows, "doc_id long, text string, n_tokens string"), MODEL).collect()}
    for doc, text, _ in rows:
        assert got[doc] == (len(tc.pre_tokens(text or "")), expected(text, unigram)), text


def test_forgetting_kept_counts_changes_nothing():
    pieces = tc.zipf_pieces(MODEL)
    words = [f"word{i}x" for i in range(300)]
    large, small = tc.TrieCounter(pieces, 10_000, 48), tc.TrieCounter(pieces, 10, 48)
    assert large.counts(words).tolist() == [small.counts([w])[0] for w in words]


def test_empty_table(spark):
    assert tc.count_tokens(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
