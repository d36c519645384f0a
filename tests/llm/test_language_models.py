"""Kneser-Ney models: proper distributions, held-out accuracy, defined cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from postsift.llm import language, toxicity
from postsift.llm import ngram_arrays as arrays
from postsift.llm.common import among, held_out, read_table

SF = "/root/testdata/sf0.01"


def texts(seed=0, n=60):
    rng = random.Random(seed)
    parts = {"aa": ["the", "ing", "on", "er", "sh"], "bb": ["der", "ung", "sch", "ei", "ß"]}
    return [(lang, " ".join("".join(rng.choices(p, k=rng.randint(1, 3))) for _ in range(40))) for lang, p in parts.items() for _ in range(n)]


def test_language_cases(table):
    rows = [(i, t, lang, 0.5) for i, (lang, t) in enumerate(texts())]
    rows += [(1000, None, "aa", 0.0), (1001, "", "aa", 0.0), (1002, "123 !!", None, 0.0), (1003, "therer ing sher", None, 0.0), (None, "schung derei", None, 0.0), (1003, "therer ing sher", None, 0.0)]
    docs = table(rows, "doc_id long, text string, lang string, score double")
    out = {r["doc_id"]: r for r in language.identify(docs, ~held_out("doc_id", 4, 2)).collect()}
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1001]["score"] == 0
    assert out[1003]["lang_pred"] == "aa" and out[None]["lang_pred"] == "bb"
    assert all(out[i]["lang_pred"] == lang for i, _, lang, _ in rows[:120]) and all(0 <= r["score"] <= 1 for r in out.values())


def test_language_with_nothing_to_learn(table, spark):
    docs = table([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[:3] for r in language.identify(docs, ~held_out("doc_id", 4, 2)).collect()] == [(1, "und", 0.0)]
    assert language.identify(spark.createDataFrame([], "doc_id long, text string, lang string"), ~held_out("doc_id", 4, 2)).count() == 0
    one = language.identify(table([(i, "some words here", "en") for i in range(8)], "doc_id long, text string, lang string"), ~held_out("doc_id", 4, 2))
    assert {r["lang_pred"] for r in one.collect()} == {"en"}


def test_language_held_out_accuracy(spark):
    docs = read_table(spark, SF, "documents")
    out = language.identify(docs, ~held_out("doc_id", 4, 2)).join(docs.select("doc_id", "lang"), "doc_id").where(held_out("doc_id", 4, 2)).collect()
    assert len(out) > 200 and sum(r["lang"] == r["lang_pred"] for r in out) >= 0.99 * len(out)


def test_language_curve_and_limits_from_all_rows(table, monkeypatch):
    """More than 4,096 documents: each of them counts for the curve and for the limits."""
    seen = {}
    for name in ("_curve", "_quantiles"):
        def kept(rows, *more, name=name, plain=getattr(language, name)):
            seen[name] = (rows.collect(), plain(rows, *more))
            return seen[name][1]

        monkeypatch.setattr(language, name, kept)
    rng = random.Random(5)
    words = {"aa": ["there", "shining", "oner", "singer"], "bb": ["derung", "scheiung", "eische", "singer"]}
    rows = [(i, rng.choice(words[g]) + " " + rng.choice(words[g]), g) for i in range(2600) for g in words]
    language.identify(table(rows, "doc_id long, text string, lang string"), held_out("doc_id", 4, 2) | ~held_out("doc_id", 4, 2)).count()
    margins, curve = seen["_curve"]
    assert len(margins) == len(rows)
    z = np.array([r["margin"] for r in margins] + [0.0, 0.0])
    expected = language.logistic(np.stack([np.ones(len(z)), z], axis=1), np.array([r["right"] for r in margins] + [0.0, 1.0]))
    assert np.allclose(curve, expected, rtol=1e-6)
    entropies, limits = seen["_quantiles"]
    assert len(entropies) == sum(r["right"] for r in margins) and set(limits) == set(words)
    for g in words:
        assert abs(limits[g] - np.quantile([r["x"] for r in entropies if r["grp"] == g], 0.995)) < 2e-9


def toxic_rows(n=400):
    rng = random.Random(2)
    plain = [f"{a}{b}" for a in ("th", "on", "er", "in", "sh", "at") for b in ("ing", "ed", "ly", "er", "ou")]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 200))
        toxic = i % 4 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_separates_classes(table):
    rows = toxic_rows()
    learned = toxicity.fit(table(rows[:320], "doc_id long, text string, toxic int"))
    docs = table([(i, t, 9.0) for i, t, _ in rows] + [(None, None, 9.0), (5000, "", 9.0), (5001, "thing " * 30_000, 9.0), (5002, "123", 9.0)], "doc_id long, text string, score double")
    out = {r["doc_id"]: r for r in toxicity.score(docs, learned).collect()}
    right = sum(out[i]["predicted"] == y for i, _, y in rows[320:])
    assert right >= 78 and all(0 <= r["score"] <= 1 for r in out.values())
    assert out[5000]["score"] == out[None]["score"] == out[5002]["score"] and out[5001]["predicted"] == 0
    kept = toxicity.keep(docs, learned)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in out.values())


def test_few_toxic_labels_still_give_a_curve(table):
    plain = [(i, t, 0) for i, t, y in toxic_rows(300) if not y]
    for shift in (0, 1000, 2000):  # ids decide which rows the models do not count
        rows = plain + [(shift + 10_000 + i, "idiot moron scum thing " + t, 1) for i, (_, t, _) in enumerate(plain[:3])]
        learned = toxicity.fit(table(rows, "doc_id long, text string, toxic int"))
        assert learned is not None
        out = toxicity.score(table([(0, plain[50][1]), (1, "idiot moron scum " + plain[51][1])], "doc_id long, text string"), learned)
        scores = {r["doc_id"]: r["score"] for r in out.collect()}
        assert scores[1] > scores[0] and scores[0] < 0.5


def test_toxicity_without_both_classes(table, spark):
    docs = table([(1, "a b", 0), (2, "c", None)], "doc_id long, text string, toxic int")
    assert toxicity.fit(docs) is None
    assert [tuple(r) for r in toxicity.score(docs.limit(1), None).collect()][0][1:] == (0.0, 0)
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), None).count() == 0


def test_toxic_expression_of_two_documents_counts(table):
    """Two toxic documents among many thousand words: their expression sets the two log-likelihoods apart."""
    rng = random.Random(4)
    rows = [(str(i % 2), " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(300))) for i in range(200)]
    rows += [("1", "qxqxz " * 20)] * 2
    asked = ["qxqxz", "abcde fghij"]
    counts = arrays.count(table(rows + [(None, t) for t in asked], "grp string, text string"), toxicity.CLASSES)
    docs = table(list(enumerate(asked)), "key long, text string")
    found = {r["key"]: r for r in toxicity._evidence(docs, arrays.finish(counts, toxicity.CLASSES, toxicity.SHARED)).collect()}
    assert found[0]["difference"] > 100 > 50 > abs(found[1]["difference"])


def test_toxicity_sample_is_weighted_back(table):
    rows = toxic_rows()
    docs = table(rows, "doc_id long, text string, toxic int")
    learned = toxicity.fit(docs, calibration=100)
    sample = learned.sample.collect()
    for label, n in (("0", 300), ("1", 100)):
        times = [r["times"] for r in sample if r["label"] == label]
        assert 25 < len(times) < 80 and abs(times[0] - n / 50) < 1e-9
    out = toxicity.score(docs.select("doc_id", "text"), learned).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in out) >= 380


def test_toxicity_without_words(table):
    docs = table([(1, "12", 0), (2, "!", 1)], "doc_id long, text string, toxic int")
    learned = toxicity.fit(docs)
    assert sorted(tuple(r) for r in toxicity.score(docs, learned).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
    assert toxicity.keep(docs, learned).count() == 2


def test_texts_without_a_label_are_held_back_before_the_join(table):
    """Only texts that may have a label cross the network; the joined rows are those of a plain join."""
    docs = table([(i, f"text {i}") for i in range(5000)] + [(7, "again"), (None, "no id")], "doc_id long, text string")
    labels = table([(i, i % 2) for i in range(0, 5000, 50)] + [(50, 1), (None, 1), (9000, 0)], "doc_id int, toxic int")
    assert 100 <= among(docs, "doc_id", labels.select(F.col("doc_id").cast("long"))).count() < 120
    found = toxicity.labelled_rows(docs, labels)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Join Inner") < plan.index("LeftSemi")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.join(labels, "doc_id").select("doc_id", "text", "toxic").collect()))


def test_among_keeps_every_key(table, spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, *range(10_000, 90_000, 7)]
    rows = table([(k,) for k in keys], "k long")
    assert among(rows, "k", rows).count() == len(keys)
    assert among(rows, "k", spark.createDataFrame([], "k long")).count() == 0
    words = table([("a",), ("",), (None,), ("b",)], "w string")
    assert {"a", ""} <= {r[0] for r in among(words, "w", words.where("w <> 'b'")).collect()}
