"""Dropped lines against a direct computation."""

import random

from postsift.llm import line_dedup as ld


def brute(rows):
    def key(line):
        k = line.strip(ld.BLANKS)
        k = "".join(c.lower() if "A" <= c <= "Z" else c for c in k)
        return k if len(k) >= 10 else None

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders.setdefault(key(line), set()).add(ld.LAST_ID if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        mine = ld.LAST_ID if doc is None else doc
        kept = [x for x in lines if not key(x) or len(holders[key(x)]) < 2 or min(holders[key(x)]) == mine]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_against_direct_computation(table):
    rng = random.Random(5)
    pool = [f"Line number {i} of the pool" for i in range(30)] + ["short", "ÄÖÜ is not lowered", "äöü is not lowered", "", "  padded line here  ", "padded line here", "PADDED LINE HERE"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 8)) + [f"unique line of {i}"])) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, pool[0]), (None, pool[1]), (3, rows[3][1]), (203, (pool[2] + "\n") * 5000), (204, "tiny ten!!\ntiny ten!!")]
    out = ld.drop_repeated_lines(table([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, row string, id int"), bits=20)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()), key=repr)
    assert got == brute(rows)


def test_small_filter_gives_the_same_result_and_carry_keeps_columns(table):
    rows = [(i, "a line that repeats\nown line number " + str(i), f"s{i}") for i in range(50)]
    out = ld.drop_repeated_lines(table(rows, "doc_id long, text string, source string"), bits=20, carry=["doc_id", "source"]).collect()
    assert all(r["source"] == f"s{r['doc_id']}" for r in out)
    assert [r["n_dropped"] for r in sorted(out)] == [0] + [1] * 49


def test_empty_table(spark):
    assert ld.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string"), bits=20).count() == 0
