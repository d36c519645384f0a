"""Large rule tables: the q-gram join gives the rows of the compiled rules and of a plain loop."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postsift.functions.rule_sql import word_regex
from postsift.functions.rules import RULE_TABLE_SCHEMA
from postsift.operators import rule_join, scoring
from postsift.plans.probe_rules import probe_rules
from postsift.functions.rules import rule_table
from postsift.sources import bindings
from tables import SF_SMALL

POSTINGS = "seq long, title string, company string, description string, area string, text string"


def rule(priority, scope, pattern, whole=False):
    return (priority, f"g{priority % 3}", "tier", scope, pattern, float(priority), whole, word_regex(pattern) if whole else None)


def brute(postings, rules):
    out = set()
    for seq, title, company, description, *_ in postings:
        low = None if description is None else description.lower()
        texts = {"company": [company and company.lower()] if company is not None else [], "title": [low and low[:200]] if low is not None else [],
                 "title_or_description": [(title or "").lower()] + ([low] if low is not None else [])}
        for priority, _, _, scope, pattern, _, whole, _ in rules:
            for text in texts.get(scope, [low] if low is not None else []):
                if re.search(rf"(?<!\w){re.escape(pattern)}(?!\w)", text) if whole else pattern in text:
                    out.add((seq, priority))
    return out


def found(spark, postings, rules, **options):
    rows = rule_join.rule_hits(spark.createDataFrame(postings, POSTINGS).repartition(3), spark.createDataFrame(rules, RULE_TABLE_SCHEMA), **options).collect()
    assert len(rows) == len({(r["seq"], r["priority"]) for r in rows})
    return {(r["seq"], r["priority"]) for r in rows}


def test_equals_a_plain_loop(spark):
    draw = random.Random(11)
    letters = "aab cé\n.中"
    text = lambda n: "".join(draw.choice(letters) for _ in range(n))
    postings = [(k, text(draw.randrange(12)), text(3), text(draw.choice([0, 1, 2, 63, 64, 65, 130, 400])), "x", "y") for k in range(60)]
    postings += [(100, None, None, None, "x", "y"), (101, "", "", "", "x", "y"), (102, "AB C", "Aab", "A" * 700 + "b", "x", "y")]
    scopes = ["company", "title", "title_or_description", "description", "anything"]
    rules = [rule(k, draw.choice(scopes), text(draw.choice([1, 2, 3, 4, 6])), draw.random() < 0.4) for k in range(1, 120)]
    rules += [rule(200, "description", ""), rule(201, "company", ""), rule(202, "title_or_description", "ab c", True)]
    postings.append((103, "", "", text(30) + "long " * 60 + text(30), "x", "y"))
    rules += [rule(300, "description", "long " * 40), rule(301, "description", ("long " * 40).strip(), True), rule(302, "description", "ong " * 40 + "no"), rule(303, "title", "long " * 30)]
    expected = brute(postings, rules)
    assert found(spark, postings, rules) == expected
    assert found(spark, postings, rules, group=17, share=1.0) == expected


def test_equals_the_compiled_rules(spark):
    postings, rules = bindings.postings(spark, SF_SMALL), probe_rules()
    cols = ["seq", *rule_join.OUT]
    joined = rule_join.rule_hits(postings, rule_table(spark, rules)).select(cols).collect()
    assert sorted(joined) == sorted(scoring.rule_hits(postings, rules).select(cols).collect())


def test_empty_tables(spark):
    posting, one = [(1, "a", "b", "c d", "x", "y")], [rule(1, "description", "c")]
    assert found(spark, [], one) == set() and found(spark, posting, []) == set() and found(spark, posting, one) == {(1, 1)}


@pytest.fixture(scope="module")
def many_rules(spark):
    """100,000 patterns made by Spark; every thousandth is a word of the postings, many share a frequent beginning."""
    ids = spark.range(100_000)
    pattern = F.when(F.col("id") % 1000 == 0, F.concat(F.lit("needle"), F.col("id"))).otherwise(F.concat(F.lit("the "), F.md5(F.col("id").cast("string"))))
    return ids.select((F.col("id") + 1).cast("int").alias("priority"), F.lit("tier1_tools").alias("rule_group"), F.lit("tier").alias("kind"),
                      F.lit("description").alias("scope"), pattern.alias("pattern"), F.lit(1.0).alias("weight"), F.lit(False).alias("word_boundary"), F.lit(None).cast("string").alias("regex"))


def test_many_patterns(spark, many_rules):
    postings = spark.range(3000).select(
        F.col("id").alias("seq"), F.lit("t").alias("title"), F.lit("c").alias("company"),
        F.concat(F.lit("the the the "), F.repeat(F.lit("the quick word "), 20), F.lit(" needle"), F.col("id") % 50 * 1000, F.lit(" end")).alias("description"))
    hits = rule_join.rule_hits(postings, many_rules)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "needle7000" not in plan and len(plan) < 100_000  # no rule is a literal of the plan
    assert "BroadcastHashJoin" in hits._jdf.queryExecution().executedPlan().toString()
    # needle1 is part of needle10 and so on: a plain count of the contained ones
    names = [f"needle{k * 1000}" for k in range(100)]
    expected = sum(60 * sum(n in f"needle{k * 1000} " for n in names) for k in range(50))
    assert hits.count() == expected
