"""Sorted n-gram arrays against a plain Kneser-Ney model over dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from postsift.llm import ngram_arrays as na


def units(word):
    raw = word.encode("utf-16-le")
    return [int.from_bytes(raw[i:i + 2], "little") for i in range(0, len(raw), 2)]


def plain_ngrams(text, order=4):
    """Tuples of four symbols, word by word."""
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        symbols = [0] * (order - 1) + units(word) + [0]
        yield from (tuple(symbols[i:i + order]) for i in range(len(symbols) - order + 1))


class Plain:
    """The model of ``texts``; orders up to ``shared`` are those of ``everyone``'s texts."""

    def __init__(self, texts, order=4, shared=0, everyone=()):
        self.counts = {order: Counter(g for t in texts for g in plain_ngrams(t))}
        whole = {order: Counter(g for t in everyone for g in plain_ngrams(t))}
        for k in range(order - 1, 0, -1):
            whole[k] = Counter(g[1:] for g in whole[k + 1])
            self.counts[k] = whole[k] if k <= shared else Counter(g[1:] for g in self.counts[k + 1])
        self.totals, self.kinds, self.d = {}, {}, {}
        for k, counts in self.counts.items():
            self.totals[k], self.kinds[k] = defaultdict(int), defaultdict(int)
            for g, c in counts.items():
                self.totals[k][g[:-1]] += c
                self.kinds[k][g[:-1]] += 1
            n1, n2 = (sum(c == x for c in counts.values()) for x in (1, 2))
            self.d[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75

    def p(self, g):
        if not g:
            return 1 / 65536
        k, context = len(g), g[:-1]
        total = self.totals[k].get(context, 0)
        if not total:
            return self.p(g[1:])
        c = self.counts[k].get(g, 0)
        return (max(c - self.d[k], 0) + self.kinds[k][context] * self.d[k] * self.p(g[1:])) / total

    def log(self, text):
        return sum(math.log(self.p(g)) for g in plain_ngrams(text))


def corpus(seed=1):
    rng = random.Random(seed)
    parts = {"aa": ["the", "ing", "on", "er", "中文", "x"], "bb": ["der", "ung", "sch", "ß", "\U00020000\U00020001", "한국"]}
    return [(lang, " ".join("".join(rng.choices(p, k=rng.randint(1, 3))) for _ in range(30))) for lang, p in parts.items() for _ in range(15)]


@pytest.mark.parametrize("cache_bytes", [1 << 24, 16 * 20, 0])
def test_equals_plain_model(table, cache_bytes):
    rows = corpus()
    asked = ["the ungon", "SCHß, der7der", "\U00020000x 中", "", "12 ?", "never Seen qЖ", "the " * 50]
    both = rows + [(None, t) for t in asked]
    model = na.finish(na.count(table(both, "grp string, text string"), ["aa", "bb"]), ["aa", "bb"])
    plain = [Plain([t for g, t in rows if g == lang]) for lang in ("aa", "bb")]
    docs = table([(i, t) for i, t in enumerate(asked)], "key long, text string")
    got = {r["key"]: r for r in na.score(docs, model, cache_bytes).collect()}
    for i, text in enumerate(asked):
        assert np.allclose(got[i]["sums"], [m.log(text) for m in plain], rtol=1e-5), text
        assert got[i]["chars"] == sum(1 for _ in plain_ngrams(text))
        assert got[i]["letters"] == sum(c.isalpha() for c in text)


@pytest.mark.parametrize("shared", [1, 2, 3])
def test_shared_orders_equal_plain_model(table, shared):
    rows = corpus(2)
    asked = ["the ungon", "schß x7der", "never Seen qЖ"]
    model = na.finish(na.count(table(rows + [(None, t) for t in asked], "grp string, text string"), ["aa", "bb"]), ["aa", "bb"], shared)
    plain = [Plain([t for g, t in rows if g == lang], shared=shared, everyone=[t for _, t in rows]) for lang in ("aa", "bb")]
    got = {r["key"]: r["sums"] for r in na.score(table(list(enumerate(asked)), "key long, text string"), model).collect()}
    for i, text in enumerate(asked):
        assert np.allclose(got[i], [m.log(text) for m in plain], rtol=1e-5)


def test_pieces_of_long_texts_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abc dé\U00020000 .\n", k=n)) for n in (0, 1, 7, 8, 9, 50, 333)] + ["z" * 40]
    keys, rows, letters = na.ngrams(next(na.pieces(texts)))
    want = Counter(zip(rows.tolist(), keys.tolist()))
    assert sum(want.values()) == sum(1 for t in texts for _ in plain_ngrams(t))
    monkeypatch.setattr(na, "PIECE", 8)
    got, found = Counter(), 0
    for parts in na.pieces(texts):
        keys, rows, own = na.ngrams(parts)
        got.update(zip(rows.tolist(), keys.tolist()))
        found += len(own)
    assert got == want and found == len(letters)


def test_open_ngrams_of_many_rows_in_bounded_memory(spark):
    """Rows of one batch whose n-grams all miss the cache: no Python object an n-gram."""
    import tracemalloc

    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(20)) for _ in range(2500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").coalesce(1)
    model = na.finish(na.count(docs.selectExpr("'aa' AS grp", "text"), ["aa"]), ["aa"])
    run, seen = [], []
    plain = type(docs).mapInArrow

    def kept(self, function, schema):
        run.append(function)
        return plain(self, function, schema)

    type(docs).mapInArrow = kept
    try:
        na.score(docs, model, 0)
    finally:
        type(docs).mapInArrow = plain
    batch = docs.toArrow().combine_chunks().to_batches()[0]
    tracemalloc.start()
    for out in run[1](iter([batch])):  # the first is that of the frequent n-grams
        seen += out.column("key").to_pylist()
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == list(range(2500)) and peak < 1e8, peak


def test_small_buffers_change_nothing(table, monkeypatch):
    sums = na.Sums()
    monkeypatch.setattr(na, "PENDING", 3)
    rng = np.random.default_rng(0)
    keys, grps = rng.integers(0, 9, 50).astype(np.uint64), rng.integers(0, 2, 50).astype(np.uint16)
    for lo in range(0, 50, 2):
        sums.add(keys[lo:lo + 2], grps[lo:lo + 2], np.ones(2, np.int64))
    k, g, n = sums.result()
    assert dict(zip(zip(k.tolist(), g.tolist()), n.tolist())) == Counter(zip(keys.tolist(), grps.tolist()))


def test_groups_without_letters_are_never_best(table):
    docs = table([("aa", "some words"), ("bb", "123"), (None, "ЖЖ")], "grp string, text string")
    model = na.finish(na.count(docs, ["aa", "bb"]), ["aa", "bb"])
    out = na.score(table([(1, "ЖЖ")], "key long, text string"), model).first()
    assert out["sums"][0] > out["sums"][1]
    assert na.finish(na.count(table([("bb", "123")], "grp string, text string"), ["bb"]), ["bb"]) is None


def test_signs_are_no_letters():
    keys, _, letters = na.ngrams(next(na.pieces(["½ ² ٣ _ 7"])))
    assert len(keys) == len(letters) == 0
    keys, _, letters = na.ngrams(next(na.pieces(["हिन्दी"])))  # vowel signs stay inside the word
    assert len(keys) == 7 and len(letters) == 3
