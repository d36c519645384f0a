"""C21 for rule tables of any size: rules meet texts by q-grams, then a substring test decides.

``scoring.rule_hits`` compiles a rule file into one test per pattern, which is
the cheapest way for some hundreds of them and no way for 100,000. Here the
rules are a table:

1. Every pattern is anchored at its rarest trigram (shorter patterns at
   themselves): rarest in a share of the postings, which decides speed alone.
2. A text is cut into pieces with enough of its neighbours around them to hold
   any pattern that touches the piece; the trigrams of a piece meet the anchors
   by equality, and the piece must contain the pattern.
3. Hits of a posting are made distinct. Patterns longer than ``HEAD`` characters
   are found by their head and confirmed on the whole text, by ``seq``.

Rules are taken in groups by hash, each about ``group`` patterns: one broadcast
and one scan a group, so a broadcast never grows with the table. Texts and
their trigrams are not shuffled (no trigram is a hot key), only hits are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import TITLE_AREA_CHARS
from ..session import stored

Q = 3
HEAD = 128
PIECE = 64
AREAS = {"company": ["company"], "title": ["head"], "title_or_description": ["posting_title", "description"]}
OUT = ["priority", "rule_group", "kind", "scope", "pattern", "weight"]


def _areas(postings: DataFrame, wanted: list[str]) -> DataFrame:
    """``seq, area, text``: what the rules look at, lower-cased."""
    low = F.lower("description")
    texts = {
        "company": F.lower("company"),
        "head": F.substring(low, 1, TITLE_AREA_CHARS),
        "posting_title": F.coalesce(F.lower("title"), F.lit("")),
        "description": low,
    }
    each = F.array(*[F.struct(F.lit(a).alias("area"), texts[a].alias("text")) for a in wanted])
    return postings.select("seq", F.inline(each)).where("text IS NOT NULL")


def _pieces(areas: DataFrame, around: int) -> DataFrame:
    """``seq, area, base, window, first, last``: pieces, each with ``around`` characters of its neighbours; an empty text is one empty piece."""
    size = max(PIECE, around)
    parts = areas.select("seq", "area", F.expr(f"IF(text = '', array(''), regexp_extract_all(text, '(?s).{{1,{size}}}', 0))").alias("parts"))
    return parts.selectExpr("seq", "area", f"""inline(transform(parts, (p, i) -> named_struct(
        'base', concat(p, coalesce(left(get(parts, i + 1), {Q - 1}), '')),
        'window', concat(coalesce(right(get(parts, i - 1), {around}), ''), p, coalesce(left(get(parts, i + 1), {around}), '')),
        'first', i = 0, 'last', i = size(parts) - 1)))""")


def _grams(text: str, q: int) -> Column:
    """All substrings of ``q`` characters: what stands ahead of each place."""
    return F.expr(f"regexp_extract_all({text}, '(?s)(?=({'.' * q}))', 1)")


def _held(pieces: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each gram of each piece; the empty gram stands for a text once."""
    held = [_grams("base", q) for q in sizes if q]
    if 0 in sizes:
        held.append(F.when(F.col("first"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    return pieces.select("seq", "area", "window", "first", "last", F.explode(F.concat(*held)).alias("gram"))


def _candidates(postings: DataFrame, rules: DataFrame, share: float) -> tuple[DataFrame, list[str], list[int], int]:
    """Rules by area with their anchors, the areas, the lengths of anchors and the longest head."""
    areas = F.lit(None).cast("array<string>")
    for scope, names in AREAS.items():
        areas = F.when(F.col("scope") == scope, F.array(*[F.lit(a) for a in names])).otherwise(areas)
    areas = F.coalesce(areas, F.array(F.lit("description")))
    spread = rules.withColumn("area", F.explode(areas)).withColumn("head", F.substring("pattern", 1, HEAD)).withColumn("q", F.least(F.length("pattern"), F.lit(Q)))
    facts = spread.agg(F.collect_set("area").alias("areas"), F.collect_set("q").alias("sizes"), F.max(F.length("head")).alias("longest")).first()
    wanted, sizes, longest = sorted(facts["areas"]), sorted(facts["sizes"]), facts["longest"] or 0
    if not wanted:
        return spread.withColumn("gram", F.lit("")), wanted, sizes, longest
    own = F.expr("CASE q WHEN 0 THEN array('') WHEN 1 THEN array(head) WHEN 2 THEN array(head) END")
    options = spread.select("area", "priority", "pattern", F.explode(F.coalesce(own, _grams("head", Q))).alias("gram")).distinct()
    used = options.groupBy("area", "gram").agg(F.count("*").alias("rules"))
    sample = postings.where(F.pmod(F.xxhash64("seq", F.lit("anchors")), F.lit(1 << 30)) < int(share * (1 << 30)))
    seen = _held(_pieces(_areas(sample, wanted), longest + 1), sizes).groupBy("area", "gram").agg(F.count("*").alias("texts"))
    cost = used.join(seen.hint("merge"), ["area", "gram"], "left").select("area", "gram", F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "rules", "gram").alias("cost"))
    anchor = options.join(cost.hint("merge"), ["area", "gram"]).groupBy("area", "priority", "pattern").agg(F.min("cost")["gram"].alias("gram"))
    return spread.join(anchor.hint("merge"), ["area", "priority", "pattern"]), wanted, sizes, longest


def rule_hits(postings: DataFrame, rules: DataFrame, group: int = 50_000, share: float = 1 / 64) -> DataFrame:
    """One row per posting and rule that hits it, as ``scoring.rule_hits``.

    ``rules`` has the columns of ``functions.rules.RULE_TABLE_SCHEMA``; ``priority``
    identifies a rule. Null texts are never hit, an empty pattern hits every
    other text, an empty table of rules or postings gives no rows.
    """
    anchored, wanted, sizes, longest = _candidates(postings, rules, share)
    if not wanted:
        return postings.select("seq").join(rules.select(*OUT).where("false"))
    anchored = anchored.select("area", "gram", "head", "word_boundary", "regex", *OUT)
    anchored = stored(anchored, "rule-anchors")
    n_groups = -(-anchored.count() // group)
    pieces = _pieces(_areas(postings, wanted), longest + 1)
    # a whole word must show what stands before and behind it: the text's own ends count as a line's end
    seen = F.concat(F.when(F.col("first"), "\n").otherwise(""), "window", F.when(F.col("last"), "\n").otherwise(""))
    whole_word = F.rlike(seen, F.concat(F.lit("(?s)(?<=.)"), "regex", F.lit("(?=.)")))
    short = F.length("pattern") <= HEAD
    here = F.when(F.col("word_boundary") & short, whole_word).otherwise(F.col("window").contains(F.col("head")))
    found = None
    for k in range(n_groups):
        some = anchored.where(F.pmod(F.xxhash64("priority", "pattern"), F.lit(n_groups)) == k)
        hits = _held(pieces, sizes).join(F.broadcast(some), ["area", "gram"]).where(here)
        sure = hits.where(short).select("seq", *OUT)
        long = hits.where(~short).select("seq", "area", "word_boundary", "regex", *OUT).distinct()
        whole = F.when(F.col("word_boundary"), F.rlike("text", F.col("regex"))).otherwise(F.col("text").contains(F.col("pattern")))
        both = sure.union(long.join(_areas(postings, wanted), ["seq", "area"]).where(whole).select("seq", *OUT)) if longest == HEAD else sure
        found = both if found is None else found.union(both)
    return found.distinct()
