"""Quality: features and updates against plain loops, held-out accuracy, defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from postsift.llm import quality, queries
from postsift.llm.common import held_out

DOCS = "doc_id long, text string, lang string, label int, score string, shard int"
LABELS = "doc_id long, quality int, toxic int"
GOOD, BAD = "the quiet river runs past green hills and old stone walls", "win$$$ cash&&& now### click*** here!!!"


def plain(text):
    """Feature -> value by counting, with the module's hashes of words."""
    hashes = quality.WordHashes()
    mask = (1 << 64) - 1
    h, before = [], None
    for w in re.findall(r"\w+|[^\w\s]+", text):
        h.append(int(quality.REPEAT) if w == before else hashes[w])
        before = w
    left, right = int(quality.MIX_LEFT), int(quality.MIX_RIGHT)
    keys = [x * right & mask for x in h]
    for x, y in zip(h, h[1:]):
        p = (x * left & mask) ^ (y * right & mask)
        keys.append((p ^ p >> 29) * left & mask)
    count = Counter([(k >> 64 - quality.BITS) + 1 for k in keys] + [quality.CONSTANT])
    norm = math.sqrt(sum((1 + math.log(c)) ** 2 for c in count.values()))
    return {k: (1 + math.log(c)) / norm for k, c in count.items()}


def test_features():
    texts = ["", "one", "no no no no", GOOD, BAD * 3, "é è 中文 x\ny", "a b a b a b"]
    owner, at, value = quality.features([quality.WORD.findall(t) for t in texts], quality.WordHashes())
    for k, text in enumerate(texts):
        mine = dict(zip(at[owner == k].tolist(), value[owner == k].tolist()))
        assert mine == pytest.approx(plain(text))


def test_repeats_look_alike():
    a, b = (set(plain(" ".join([w] * 50))) for w in ("oneaea", "whha"))
    assert len(a & b) >= 3  # the constant, the mark and the pair of marks


def test_updates_are_the_plain_ones():
    draw = random.Random(5)
    z, n, plain_z, plain_n = np.zeros(quality.N_FEATURES), np.zeros(quality.N_FEATURES), Counter(), Counter()
    for _ in range(200):
        x = {k: draw.random() for k in {quality.CONSTANT, *draw.sample(range(1, 40), 6)}}
        label, weight = draw.randrange(2), draw.choice([1.0, 0.25])
        w = {}
        for k in x:
            l1 = 0 if k == quality.CONSTANT else quality.L1
            w[k] = 0 if abs(plain_z[k]) <= l1 else -(plain_z[k] - math.copysign(l1, plain_z[k])) / ((quality.BETA + math.sqrt(plain_n[k])) / quality.ALPHA + quality.L2)
        p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
        for k, v in x.items():
            g = weight * (p - label) * v
            plain_z[k] += g - (math.sqrt(plain_n[k] + g * g) - math.sqrt(plain_n[k])) / quality.ALPHA * w[k]
            plain_n[k] += g * g
        at = np.array(sorted(x))
        quality.update(z, n, at, np.array([x[k] for k in at]), label, weight)
    assert {k: z[k] for k in plain_z} == pytest.approx(dict(plain_z))
    assert {k: n[k] for k in plain_n} == pytest.approx(dict(plain_n))


def scores(table, docs, labels, sample=10_000):
    docs, labels = table([(d, t, "en", 7, "x", 1) for d, t in docs], DOCS), table(labels, LABELS)
    out = quality.score(docs, quality.fit(docs, labels, sample)).collect()
    return sorted(((r["doc_id"], r["score"]) for r in out), key=lambda r: (r[0] is None, r))


def test_defined_cases(table):
    docs = [(i, f"{GOOD if i % 3 else BAD} {i}") for i in range(200)]
    extra = [(500, None), (501, ""), (502, " \n"), (None, BAD), (None, None), (7, GOOD), (503, BAD * 20_000), (504, BAD), (504, BAD)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(150)] + [(1, 0, 0), (2, None, 0), (3, 5, 0), (9999, 1, 1), (None, 1, 1)]
    out = scores(table, docs + extra, labels)
    assert len(out) == 209 and all(0 <= s <= 1 for _, s in out)
    found = dict(out)
    assert all((found[i] >= 0.3) == (i % 3 > 0) for i in range(150, 200))
    assert found[500] == found[501] == found[502]
    assert found[503] < 0.3 and [s for d, s in out if d == 504] == [found[504]] * 2
    thin = dict(scores(table, docs, labels, sample=40))
    assert sum((thin[i] >= 0.3) == (i % 3 > 0) for i in range(200)) >= 195


def test_labels_of_one_kind_or_none(table):
    docs = [(i, f"{GOOD} {i}") for i in range(20)]
    assert {s for _, s in scores(table, docs, [])} == {0.5}
    assert all(s > 0.5 for _, s in scores(table, docs, [(i, 1, 0) for i in range(20)]))
    assert all(s < 0.5 for _, s in scores(table, docs, [(i, 0, 0) for i in range(20)]))
    assert scores(table, [], [(1, 1, 1)]) == []


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op11_quality(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r["quality"], r["predicted"]): r["count"] for r in out.groupBy("quality", "predicted").count().collect()}
    assert n.get((1, 0), 0) <= 0.01 * n[1, 1]
    assert n[0, 0] >= 0.9 * (n[0, 0] + n.get((0, 1), 0))


def test_held_out_labels_are_not_learned(spark, table):
    docs = table([(i, f"{GOOD if i % 3 else BAD} {i}") for i in range(100)], "doc_id long, text string")
    true = table([(i, int(i % 3 > 0), 0) for i in range(100)], LABELS)
    turned = true.withColumn("quality", quality.F.when(held_out("doc_id", 5, 0), 1 - true["quality"]).otherwise(true["quality"]))
    learned = [quality.fit(docs, x.where(~held_out("doc_id", 5, 0))) for x in (true, turned)]
    assert np.allclose(*learned)
