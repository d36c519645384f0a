"""WAND retrieval and verified matches against direct computations."""

import random

import numpy as np

from postsift.llm import decontaminate as dc


def items_of(rng, n=60):
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(900)]
    return [(i, " ".join(rng.choices(common, k=10) + rng.sample(rare, rng.randint(3, 20))) + (".\nanswer " + " ".join(rng.sample(rare, 3)) if i % 2 else "")) for i in range(n)]


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(1)
    items = items_of(rng)
    for block in (1, 2, 7, 64):
        index = dc.Index(items, block, 0.5)
        for _ in range(150):
            words = set(rng.choice(items)[1].lower().replace(".", "").split())
            terms = sorted({index.term[w] for w in words if w in index.term and rng.random() < 0.7} | set(rng.sample(range(len(index.term)), 25)))
            full = np.zeros(len(items))
            for t in terms:
                for i, w in zip(*index.postings[t]):
                    full[i] += w
            got = dict(index.retrieve(terms))
            assert set(got) == set(np.flatnonzero(full >= 0.5 - 1e-9).tolist())
            assert all(abs(full[i] - s) < 1e-9 for i, s in got.items())
            if got:
                assert index.may_match(np.zeros(len(terms), np.int64), np.array(terms), 1)[0]


def test_documents_with_items_are_found_and_removed(table, spark):
    rng = random.Random(2)
    items = items_of(rng)
    filler = [f"c{i}" for i in range(12)] + [f"f{i}" for i in range(500)]
    rows, expected = [], set()
    for d in range(200):
        words = rng.choices(filler, k=rng.randint(0, 800))
        if d % 5 == 0:
            i, text = rng.choice(items)
            words.insert(rng.randrange(len(words) + 1), text.upper() if d % 2 else text)
            expected.add((d, i))
        rows.append((d, " ".join(words), 1.0))
    rows += [(300, None, 1.0), (301, "", 1.0), (None, items[0][1], 1.0), (302, "word " * 50_000, 1.0), (303, items[1][1].split("\n")[0], 1.0)]
    bench = table([*items, (900, None), (901, " . ")], "item_id long, text string")
    docs = table(rows, "doc_id long, text string, score double")
    for words in (1_000_000, 200):  # one index, several
        got = {(r["doc_id"], r["item_id"]) for r in dc.find(docs, bench, index_words=words).collect()}
        assert got == expected | {(None, items[0][0])}
        kept = dc.remove(docs, bench, index_words=words)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in expected} - {None}


def test_empty_tables(table, spark):
    docs, none = table([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert dc.find(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert dc.find(none, table([(1, "a b")], "item_id long, text string")).count() == 0
    assert dc.remove(docs, spark.createDataFrame([], "item_id long, text string")).count() == 1
