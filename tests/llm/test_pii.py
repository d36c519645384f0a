"""Base spans against Python's own matcher; learned additions and redaction."""

import re

from pyspark.sql import functions as F

from postsift.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "no data", "mail a.b+c@ex-1.example.com. or x@y", "a@b.c@d.e_f@g.h..i", "a@b.c_d@e.f", "..@-.- é@x.yz", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.3.4 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "4111111111111111", "79927398713 7992739871300000", "+1 (017) 555-7713 +49.30.1234567 +12 +1234567890123456 ++44 20 7946 0958",
    "😀 4111 1111 1111 1111 é +1 555 123 4567", "x41111111@a.b", "0 0 0 0 0 0 0 0 0 0 0 0 0 0", "1-1-1-1 1-1 1--1", "9" * 30000, "a." * 8000 + "@" + "b." * 8000 + "c", "1 " * 20000, "+1" + "2" * 20000,
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" and len(m[0]) < 4000 else kind != "ip",
                  "card": kind == "card" and 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(table):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[3])]
    out = pii.find(table([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, spans string, p int"))
    got = sorted(((r["doc_id"], [tuple(s) for s in r["base"]]) for r in out.collect()), key=repr)
    assert got == sorted(((d, brute(t)) for d, t in rows), key=repr)


def test_learned_spans_contain_the_base_and_do_not_overlap_it(table):
    rows = [(i, f"call +1 (0{i % 90 + 10}) 555-{1000 + i} or mail u{i}@ex.example.com, ip 10.0.{i % 250}.7 code {i}.{i}.{i} number {10**11 + i}") for i in range(300)]
    rows += [(1000 + i, f"call (0{i % 90 + 10}) 555-{1000 + i} or mail u{i} [at] ex [dot] com") for i in range(50)]
    for r in pii.find(table(rows, "doc_id long, text string"), max_train=600, rounds=5).collect():
        base, spans = {tuple(s) for s in r["base"]}, {tuple(s) for s in r["spans"]}
        assert base <= spans
        for k, a, b in spans - base:
            assert not any(a < y and x < b for _, x, y in base)


def test_trees_learn_from_all_proposals(table, monkeypatch):
    """Many proposals: every one is an example, equal ones by their weight."""
    stored = {}
    monkeypatch.setattr(pii, "store", lambda df, name, plain=pii.store: stored.setdefault(name, plain(df, name)))
    text = " ".join(f"10.0.{i % 250}.7" for i in range(100)) + " " + " ".join(f"{i}.300.1.{i}" for i in range(100))
    docs = table([(i, text) for i in range(150)], "doc_id long, text string")
    pii.find(docs, rounds=2).count()
    proposed = sum(r[f"n_{k}"] for r in stored["pii-spans"].select(*[F.size(f"p_{k}").alias(f"n_{k}") for k in pii.KINDS]).collect() for k in pii.KINDS)
    examples = stored["pii-examples"]
    assert proposed > 20_000 and examples.agg(F.sum("n")).first()[0] == proposed and examples.count() < 1000


def test_redaction(table):
    df = table([(1, "é mail a@b.co now 1.2.3.4!")], "doc_id long, text string")
    out = pii.find(df).join(df, "doc_id").select(pii.redact(F.col("text"), F.col("spans")).alias("t")).first()
    assert out["t"] == "é mail [EMAIL] now [IP]!"


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
