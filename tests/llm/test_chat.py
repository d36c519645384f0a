"""Round trips of hostile conversations."""

import random

from postsift.llm import chat

BITS = ["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<|n|>", "<|", "|>", "\n", "\\", "assistant", "ok", "é😀", "", "<"]


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(BITS, k=rng.randint(0, 8)))))
    rows += [(100, 0, "assistant", None), (101, None, "user", "first"), (101, 1, None, "no role"), (102, 1, "user", "b"), (102, 1, "user", "a"), (102, 1, "user", "a"),
             (None, 0, "user", "no id"), (103, 0, "us\ner<|im_end|>", "role with marks"), (103, 1, "a\\nb<|n|>", "x"), (104, 0, "assistant", "long <|im_end|> " * 3000)]
    return rows


def test_read_back_equals_the_source(table):
    rows = rows_of(1)
    out = chat.read_back(chat.format_conversations(table([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, at int"))).collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((float("-inf") if t is None else t, r or "", x or ""))
    assert len(out) == len(by)
    for o in out:
        source = sorted(by[o["conv_id"]], key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        assert [(t["role"], t["text"]) for t in o["turns"]] == [s[1:] for s in source]
        assert o["loss_text"] == "".join(s[2] for s in source if s[1] == "assistant")


def test_plain_content_is_not_escaped(table):
    out = chat.format_conversations(table([(1, 0, "user", "a <| b"), (1, 1, "assistant", "<|im_end|>")], "conv_id long, turn long, role string, text string")).first()
    assert out["formatted"] == "<|im_start|>user\na <| b<|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
