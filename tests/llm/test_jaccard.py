"""The join against all pairs of sets."""

import random
import re

import pytest

from postsift.llm import jaccard
from postsift.llm.components import components


def brute(rows, size=5, percent=75):
    sets = []
    for _, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(40)]
    rows, doc = [], 0
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(1, 120))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.choice([1, 1, 2, 8])):  # near copies, and copies of copies
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                base = text
            rows.append((doc, (" " if rng.random() < 0.8 else "\n").join(text).upper() if rng.random() < 0.1 else " ".join(text)))
            doc += 1
    rows += [(doc, None), (doc + 1, ""), (doc + 2, " \n\t"), (doc + 3, "one two"), (doc + 4, "One  two"), (None, "one two"), (None, None), (0, rows[0][1])]
    rows.append((doc + 5, "x " * 30_000))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(table, seed):
    rows = corpus(seed)
    out = jaccard.join(table([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, token string"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr)
    assert got == brute(rows)


def family(seed, copies, changes):
    """Near copies of one text, most of them below the threshold to each other: one group of many parts."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for doc in range(copies):
        text = list(base)
        for _ in range(rng.choice(changes)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
        rows.append((doc, " ".join(text)))
    return rows + [(copies + i, " ".join(rng.choices(base, k=60))) for i in range(5)]


@pytest.mark.parametrize("seed,changes", [(1, (3, 4, 5, 6)), (2, (2, 6, 9)), (3, (7, 8, 12))])
def test_parts_of_a_family_are_linked_as_all_pairs_say(table, monkeypatch, seed, changes):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = family(seed, 150, changes)
    out = jaccard.join(table(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr) == brute(rows)


def test_a_family_of_unlinked_copies_is_one_group(table):
    rows = jaccard._rows(table(family(4, 200, (5, 6)), "doc_id long, text string"), "doc_id", "text")
    classes = jaccard.store(jaccard.signatures(rows, 5).where("n > 0").dropDuplicates(["ck"]), "classes")
    nobody = classes.select("ck", classes["ck"].alias("root")).where("false")
    groups = jaccard.similarity_groups(jaccard.store(jaccard.likely_pairs(classes), "likely"), nobody).collect()
    sizes = sorted((sum(r["grp"] == g for r in groups) for g in {r["grp"] for r in groups}), reverse=True)
    assert sizes[0] > 100 and len(sizes) < 40


def test_pairs_just_above_the_threshold_are_linked(table):
    rng = random.Random(7)
    rows = []
    for i in range(500):  # 175 of 225 shingles in common, no word with other pairs
        base = [f"w{i}_{j}" for j in range(204)]
        other = list(base)
        for at in rng.sample(range(10, 194, 10), 5):
            other[at] = f"x{i}_{at}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    out = jaccard.join(table(rows, "doc_id long, text string")).collect()
    assert [r["doc_id"] for r in out if r["component_id"] != r["doc_id"] // 2 * 2] == []


def test_a_family_below_the_likeness_of_groups_does_not_meet_pair_by_pair(table, monkeypatch):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for doc in range(400):
        text = list(base)
        for _ in range(rng.randint(14, 18) if doc % 20 else 3):
            text[rng.randrange(300)] = f"x{rng.randrange(10 ** 7)}"
        rows.append((doc, " ".join(text)))
    stored = {}
    store = jaccard.store

    def watch(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(jaccard, "store", watch)
    out = jaccard.join(table(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr) == brute(rows)
    assert stored["jaccard-groups"].count() < 400


def test_similarity_at_the_threshold_links(table):
    # 7 of 8 and 6 of 8 common shingles: 6 / 8 = 0.75 exactly
    a = "a b c d e f g h i j k"
    rows = [(1, a), (2, "a b c d e f g h i j z"), (3, "a b c d e f g h y z q")]
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(table(rows, "doc_id long, text string")).collect()) == [
        (d, c) for d, _, c in brute(rows)]


def test_empty_table(table, spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert jaccard.keep_first(spark.createDataFrame([], "doc_id long, text string, _rid int")).count() == 0


def test_keep_first_keeps_one_of_each_component_and_all_blank_ones(table):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "a"), (3, text + " more", "b"), (9, text, "c"), (9, text, "c"), (1, "other words", "d"), (7, None, "e"), (8, "  ", "f")]
    out = jaccard.keep_first(table(rows, "doc_id long, text string, lang string"))
    assert out.columns == ["doc_id", "text", "lang"]
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 7, 8]


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.range(3).selectExpr("1000 + id AS a", "1000 AS b"))
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in (1000, 1001, 1002)} == {1000}
