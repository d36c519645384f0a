r"""Personal data in texts: base spans and spans chosen by boosted trees (DataFrame functions only).

Base spans are the leftmost non-overlapping matches per kind that pass the
kind's check (email; ip with parts up to 255; card of 13 to 19 digits passing
Luhn; phone of 9 to 15 digits). A match that fails is dropped without retry.
Base spans always stay.

High-recall generators propose more spans, overlapping ones too: written-out
``at`` and ``dot``, long dotted or colon-separated numbers, any 12 to 19 digits, phone-like digit
groups without ``+``. Gradient-boosted trees score the proposals by format and
context (lengths, digit share, separators, checksums, neighbouring characters,
words before). They learn from all proposals of all documents (a caller may ask
for about ``max_train`` of them, by hash): a proposal that touches a base span of
its kind is a positive example. Proposals with the same features and label are
one example, weighted by their number. On the quarter of the documents kept
back, the lowest score whose share of positives is at least ``precision`` becomes
the kind's threshold. A proposal outside all base spans that reaches it is added; of
overlapping additions the best score stays (then the earlier, the longer).

Positions of all matches come from the pieces between them (``split``), since
Spark's functions return texts, not places. Blanks, dots and hyphens between
the parts of a card or a domain are first replaced by one private code point
each, of the same length, so that no pattern repeats a group (Java's matcher
recurses for each repetition and fails on very long texts).

Defined cases: null text is empty and has no spans; a null id stays null;
repeated rows give repeated results; with no or only one class of examples
nothing is added; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import about, store, text_or_empty

KINDS = ("email", "ip", "card", "phone")
JOINT, OTHER = "\ue000", "\ue001"
# Patterns on the text with joints (base spans).
EMAIL_JOINT = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"
CARD_JOINT = r"(?<=[0-9])[\x20-](?=[0-9])"
BASE = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+{JOINT}-]))[A-Za-z0-9._%+{JOINT}-]++@[A-Za-z0-9-]+{JOINT}[A-Za-z0-9{JOINT}-]+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{JOINT}]+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of further proposals.
PROPOSE = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}\x20?(?:@|[\[(]at[\])])\x20?[\p{L}0-9-]{1,64}"
             r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[\p{L}0-9-]{1,64}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,10}(?:\.[0-9]{1,10}){3}|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9][\x20().0-9-]{6,22}[0-9](?![0-9])",
}
# A text without these cannot hold the kind.
NEEDS = {"email": r"@|[\[(]at[\])]", "ip": r"[0-9a-fA-F][.:]", "card": r"[0-9]{2}|[0-9][\x20-][0-9]", "phone": r"[0-9][\x20().0-9-]"}
CONTEXT_WORDS = {
    "email": "mail|write|contact|contacto|courriel",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|anruf",
}
FEATURES = ["f_email", "f_ip", "f_card", "f_phone", "f_length", "f_digits", "f_digit_share", "f_joints", "f_dots",
            "f_at", "f_luhn", "f_octets", "f_before_word", "f_before_blank", "f_after_word", "f_after_blank", "f_context"]


def found(text: Column, pattern: str) -> Column:
    """Spans (start, end exclusive, raw) of the matches of ``pattern`` in code points."""
    raws = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(raws)), raws, lambda g, r: F.struct(F.length(g).alias("gap"), r.alias("raw")))
    empty = "array<struct<start:bigint,end:bigint,raw:string>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["raw"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), x["raw"].alias("raw")))).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(empty).alias("spans"))
    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def digits_of(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def octets(raw: Column) -> Column:
    return F.forall(F.split(raw, r"\."), lambda p: F.coalesce(p.try_cast("double") <= 255, F.lit(False)))


def valid(kind: str, raw: Column) -> Column:
    n = F.length(digits_of(raw))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits_of(raw))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return octets(raw) if kind == "ip" else F.lit(True)


def spans_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans and further proposals per row: ``doc_id, text_key`` and two arrays per kind."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    plain = F.replace(F.col("text"), F.lit(JOINT), F.lit(OTHER))
    joined = {"email": F.regexp_replace(plain, EMAIL_JOINT, JOINT), "card": F.regexp_replace(plain, CARD_JOINT, JOINT)}
    none = F.array().cast("array<struct<start:bigint,end:bigint,raw:string>>")
    for kind in KINDS:
        may = F.col("text").rlike(NEEDS[kind])
        rows = rows.withColumn(f"m_{kind}", F.when(may, joined.get(kind, plain)))
    for kind in KINDS:
        rows = rows.withColumn(f"b_{kind}", F.when(F.col(f"m_{kind}").isNotNull(), found(F.col(f"m_{kind}"), BASE[kind])).otherwise(none))
        rows = rows.withColumn(f"p_{kind}", F.when(F.col(f"m_{kind}").isNotNull(), found(F.col("text"), PROPOSE[kind])).otherwise(none))

    def checked(k: str) -> Column:
        return F.filter(f"b_{k}", lambda s: valid(k, s["raw"]))

    base = [checked(k).alias(f"b_{k}") for k in KINDS]

    def with_context(k: str) -> Column:
        return F.transform(f"p_{k}", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["raw"].alias("raw"),
            F.lower(F.substring(F.col("text"), F.greatest(s["start"] - 39, F.lit(1)).cast("int"), F.least(s["start"], F.lit(40)).cast("int"))).alias("before"),
            F.substring(F.col("text"), (s["end"] + 1).cast("int"), F.lit(1)).alias("after")))

    return rows.select("doc_id", "text_key", *base, *[with_context(k).alias(f"p_{k}") for k in KINDS])


def proposals(spans: DataFrame) -> DataFrame:
    """One row per proposal with its features; ``label`` tells whether it touches a base span of its kind, ``clear`` any."""

    def touches(k: str, s: Column) -> Column:
        return F.exists(f"b_{k}", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    def of(k: str) -> Column:
        return F.transform(f"p_{k}", lambda s: F.struct(
            F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["raw"].alias("raw"), s["before"].alias("before"),
            s["after"].alias("after"), touches(k, s).alias("label"), (~reduce(lambda a, b: a | b, [touches(x, s) for x in KINDS])).alias("clear")))

    rows = spans.select("doc_id", "text_key", F.inline(F.concat(*[of(k) for k in KINDS])))
    raw, digits = F.col("raw"), digits_of(F.col("raw"))
    last = F.substring(F.col("before"), -1, 1)
    flag = {
        **{f"f_{k}": F.col("kind") == k for k in KINDS},
        "f_at": raw.contains("@"),
        "f_luhn": F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False),
        "f_octets": F.when(F.col("kind") == "ip", octets(raw)).otherwise(False),
        "f_before_word": last.rlike(r"[\p{L}0-9]"),
        "f_before_blank": last.rlike(r"\s") | (last == ""),
        "f_after_word": F.col("after").rlike(r"[\p{L}0-9]"),
        "f_after_blank": F.col("after").rlike(r"\s") | (F.col("after") == ""),
        "f_context": reduce(lambda a, k: a | ((F.col("kind") == k) & F.col("before").rlike(CONTEXT_WORDS[k])), KINDS, F.lit(False)),
    }
    number = {
        "f_length": F.length(raw),
        "f_digits": F.length(digits),
        "f_digit_share": F.length(digits) / F.length(raw),
        "f_joints": F.length(F.regexp_replace(raw, r"[^\x20()-]", "")),
        "f_dots": F.length(F.regexp_replace(raw, r"[^.:]", "")),
    }
    return rows.select("doc_id", "text_key", "kind", "start", "end", "label", "clear",
                       *[v.cast("double").alias(k) for k, v in (number | flag).items()])


def train(rows: DataFrame, max_train: int | None, rounds: int, depth: int, precision: float):
    """The trees and the threshold of each kind; None without examples of both classes."""
    back = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0
    asked = rows if max_train is None else about(rows, max_train, "doc_id", "text_key", "kind", "start")
    examples = store(asked.groupBy(back.alias("back"), "kind", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n")), "pii-examples")
    counts = {r["label"]: r["count"] for r in examples.where("NOT back").groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    # Spark draws split candidates from max(maxBins ** 2, 10,000) examples: with so many bins from all of them
    bins = max(32, math.isqrt(sum(counts.values())) + 1) if sum(counts.values()) > 10_000 else 32
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    learner = GBTClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxIter=rounds, maxDepth=depth, maxBins=bins, seed=7, checkpointInterval=-1)
    learned = examples.where("NOT back").withColumn("y", F.col("label").cast("double")).withColumn("weight", F.col("n").cast("double"))
    model = learner.fit(assemble.transform(learned).select("features", "y", "weight"))
    kept_back = score(model, examples.where("back")).groupBy("kind", "p").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("good")).collect()  # a row per score of the trees
    thresholds = {}
    for kind in KINDS:
        good = total = 0
        for p, n, right in sorted(((r["p"], r["n"], r["good"]) for r in kept_back if r["kind"] == kind), reverse=True):
            total += n
            good += right
            if p >= 0.5 and good >= precision * total:
                thresholds[kind] = p
    return model, thresholds


def score(model, rows: DataFrame) -> DataFrame:
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    return scored.withColumn("p", vector_to_array("probability")[1])


def find(docs: DataFrame, max_train: int | None = None, rounds: int = 10, depth: int = 4, precision: float = 0.99,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``base`` and ``spans``: arrays of (kind, start, end) by kind as listed, then start."""
    spans = store(spans_of(docs, id_col, text_col), "pii-spans")
    rows = proposals(spans)
    learned = train(rows, max_train, rounds, depth, precision)
    item = "array<struct<rank:int,start:bigint,end:bigint,p:double>>"
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    if learned is None or not learned[1]:
        whole = spans.withColumn("more", F.array().cast(item))
    else:
        model, thresholds = learned
        enough = reduce(lambda a, k: a | ((F.col("kind") == k) & (F.col("p") >= thresholds[k])), thresholds, F.lit(False))
        added = score(model, rows.where("clear").distinct()).where(enough).groupBy("doc_id", "text_key").agg(
            F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "p"))).alias("more"))
        added = added.select(F.col("doc_id").alias("a_doc"), F.col("text_key").alias("a_key"), "more")
        whole = spans.join(added, F.col("doc_id").eqNullSafe(F.col("a_doc")) & (F.col("text_key") == F.col("a_key")), "left")
        whole = whole.withColumn("more", F.coalesce("more", F.array().cast(item)))

    def beaten(s: Column, o: Column) -> Column:
        better = (o["p"] > s["p"]) | ((o["p"] == s["p"]) & ((o["start"] < s["start"]) | ((o["start"] == s["start"]) & (
            (o["end"] > s["end"]) | ((o["end"] == s["end"]) & (o["rank"] < s["rank"]))))))
        return (o["start"] < s["end"]) & (s["start"] < o["end"]) & better

    kept = F.filter("more", lambda s: ~F.exists("more", lambda o: beaten(s, o)))

    def ranked(i: int) -> Column:
        return F.transform(f"b_{KINDS[i]}", lambda s: F.struct(F.lit(i + 1).alias("rank"), s["start"].alias("start"), s["end"].alias("end")))

    base = F.concat(*[ranked(i) for i in range(len(KINDS))])
    every = F.array_sort(F.concat(base, F.transform(kept, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))))

    def named(a: Column) -> Column:
        return F.transform(a, lambda s: F.struct(F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return whole.select("doc_id", named(base).alias("base"), named(every).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first in order of place."""

    def step(acc: Column, s: Column) -> Column:
        outside = s["start"] >= acc["at"]
        more = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(outside, s["end"]).otherwise(acc["at"]).alias("at"), F.when(outside, more).otherwise(acc["out"]).alias("out"))

    placed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(placed, begin, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
