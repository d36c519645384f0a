"""The pipeline's stages with nulls, repeated rows, clashing column names and no rows."""

import pytest

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
NAMES = ["_rid", "_key", "kept_text", "n_lines", "n_dropped", "row", "id", "key", "score", "label", "root", "rid", "item_id", "drop"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
LINE = "this very line stands in two documents\n"
WORDS = " ".join(f"word{i}" for i in range(80))


def rows():
    texts = {1: LINE + "first own text here", 2: LINE + "another text of its own", 3: WORDS, 4: WORDS, 5: WORDS + " more", 6: None, 7: "", 8: " \n ", 9: "single", 11: "x" * 50_000}
    out = [(d, t, "en", "s", len(t or ""), *[f"{n} of {d}" for n in NAMES]) for d, t in texts.items()]
    out.append((None, "no id at all but some words", None, None, None, *[None] * len(NAMES)))
    return out + [out[8]]  # 9 twice


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1], ids=[n for n, _ in cp.STAGES[:-1]])
def test_a_stage_keeps_every_column(spark, table, name, stage):
    docs = table(rows(), SCHEMA)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    ids = sorted((r[0] for r in got), key=lambda d: (d is None, d))
    # nothing here is toxic or from the benchmark
    kept = {"near_duplicates": [1, 2, 3, 6, 7, 8, 9, 11, None]}.get(name, [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 11, None])
    assert ids == kept
    before = {r[0]: r for r in rows()}
    for r in got:
        assert r[5:] == before[r[0]][5:] and r[2:4] == before[r[0]][2:4]
        if name == "line_dedup":
            left = {2: "another text of its own", 4: ""}  # lines that documents 1 and 3 hold too
            assert (r[1], r[4]) == (text := left.get(r[0], before[r[0]][1] or ""), len(text))
        else:
            assert r[1] == before[r[0]][1] and r[4] == before[r[0]][4]


@pytest.mark.parametrize("name,stage", cp.STAGES, ids=[n for n, _ in cp.STAGES])
def test_no_documents(spark, table, name, stage):
    assert stage(spark, table([], SCHEMA), SF).count() == 0


def test_packing_holds_every_document(spark, table):
    pieces = cp.STAGES[-1][1](spark, table(rows(), SCHEMA), SF).collect()
    per = {}
    for p in pieces:
        per[p["doc_id"]] = per.get(p["doc_id"], 0) + p["length"]
    assert set(per) == {r[0] for r in rows()} and per[6] == per[7] == 1
