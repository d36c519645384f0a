"""Filter audit against a plain walk through every order, and its defined cases."""

import re
from itertools import permutations

import pytest

from postsift.llm import filter_audit

DOCS = "doc_id long, text string, lang string, mask string, hash int"
LABELS = "doc_id long, quality int, toxic int"
CLEAN = " ".join(f"word{i}" for i in range(120))


def brute(docs, labels):
    texts = [(d, t or "", l or "") for d, t, l, *_ in docs]
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}

    def fails(d, t):
        words = re.findall("[^\x20\x09-\x0d]+", t)
        return {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": any(c in t for c in "#$%&*|"),
            "E": d is not None and any(t == u and e is not None and e < d for e, u, _ in texts),
        }

    rows = [(d, p, fails(d, t)) for d, t, p in texts]
    out = {}
    for part in {p for _, p, _ in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        mine = [(d, f) for d, p, f in rows if p == part]
        for order in map("".join, permutations("ABCDE")):
            alive = list(mine)
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if x[1][f]]
                left = [x for x in alive if not x[1][f]]
                out[part, order, step] = [
                    len(left), len(gone), sum(x[1][f] for x in mine) - len(gone),
                    sum(x[1][f] and sum(x[1].values()) == 1 for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                shapley[f] += len(gone)
                alive = left
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def result(table, docs, labels):
    rows = filter_audit.audit(filter_audit.cells(table(docs, DOCS), table(labels, LABELS))).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*filter_audit.COUNTS, "shapley")) for r in rows}


def test_all_orders(table):
    texts = [
        CLEAN, CLEAN + " a|b", CLEAN.upper(), "THE " * 150, "short", "", None, " \t\n\x0b", "SHORT #", CLEAN + " #" * 50,
        "é" * 2000 + " ABC", CLEAN + "\r\n" + CLEAN, "a b " * 99 + "c",
    ]
    docs = [(i, texts[i % len(texts)], ("en", "de", None, "")[i % 4], "mine", 1) for i in range(60)]
    docs += [(3, texts[3], "fr", "mine", 1), (3, texts[3], "en", "x", 2), (None, CLEAN, "en", "x", 2), (None, None, None, None, None)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (9, None, None), (None, 1, 1), (999, 1, 1)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    assert result(table, docs, labels) == brute(docs, labels)


def test_one_text_everywhere(table):
    docs = [(i, CLEAN, "en", "", 0) for i in range(300)]
    out = result(table, docs, [])
    assert out == brute(docs, [])
    assert out["en", "ABCDE", 5][:2] == (1, 299)


def test_very_long_text(table):
    long = "lorem " * 400_000
    out = result(table, [(1, long, "en", "", 0), (2, long, "en", "", 0)], [])
    assert out["en", "BEACD", 1][:2] == (0, 2) and out["en", "EBACD", 1][:2] == (1, 1)


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)]])
def test_empty_table(table, labels):
    assert result(table, [], labels) == {}
