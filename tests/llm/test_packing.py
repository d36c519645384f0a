"""Every id in exactly one piece, no padding, ids equal to the vocabulary file's own."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postsift.llm import packing

VOCAB, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "a  b   c", "one two three. Four\n\nfive", " lead and trail ", "x<|endoftext|>y", "日本語 テスト 😀 b", "é à ç", "ɐbc ɐ",
         "word " * 3000, "tab\tand \n newline \x0b", "don't we'll 12345 !!", "x" * 5000, "same", "same"]


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_pieces_rebuild_every_document(table, ranks):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, "null id", 7)]
    out = packing.pack(table(rows, "doc_id long, text string, start int"), VOCAB, ranks, block_docs=6).collect()
    tok = Tokenizer.from_file(VOCAB)
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["length"], r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, text, _ in rows:
        expected = tok.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[doc])
        assert [i for p in own for i in p[1]] == expected
        at = 0
        for start, ids, length, total in own:
            assert (start, length, total) == (at, len(ids), len(expected))
            at += length
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0  # a power of two: nothing is padded


def test_descending_assignment_to_the_cheapest_sequence():
    pieces, n = packing.assign([6, 5, 3, 2, 16], 8, 1.0, 1.0)
    assert n == 4  # 16 is two full sequences, the rest is two more
    assert sorted(p[:3] for p in pieces if p[0] == 4) == [(4, 0, 8), (4, 8, 8)]
    place = {p[0]: p[3] for p in pieces}
    assert place[0] == place[3] and place[1] == place[2]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCAB).count() == 0
