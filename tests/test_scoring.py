"""Hand-made cases for the scorer, the rule loader and the category ladder."""

import json

import pytest
from pyspark.sql import types as T

from postsift.functions.rules import DEFAULT_THRESHOLD, load_rules, parse_rules
from postsift.operators.leads import process_leads
from postsift.operators.scoring import qualified_postings, score_postings

RULES = {
    "threshold": 50,
    "company_blocklist": ["orbitex", "kla"],
    "required_context": {"patterns": ["sunpanel", "pv"]},
    "exclusions": {
        "installers": {"patterns": ["roof crew"], "description": "Field installer roles", "check_area": "title"},
        "sales": {"patterns": ["quota carrier"], "description": "Door to door sales", "check_area": "title"},
        "bosses": {"patterns": ["chief"], "description": "Management roles", "check_area": "title"},
        "space": {"patterns": ["satellite array"], "description": "Spacecraft panels"},
        "misc": {"patterns": ["racket stringing"], "description": "Odd ones"},
    },
    "positive_signals": {
        "tier1_tools": {"patterns": ["layoutpro", "gridsketch"], "weight": 100, "description": "Tools"},
        "tier2_strong": {"patterns": ["string sizing"], "weight": 60, "description": "Strong"},
        "tier3_cad_project": {"patterns_cad": ["cadkit"], "patterns_project": ["utility scale"], "weight": 40, "description": "CAD project"},
        "tier4_title": {"patterns": ["pv designer"], "weight": 80, "description": "Titles"},
        "tier5_cad_design": {"patterns_cad": ["cadkit"], "weight": 30, "description": "CAD design"},
        "tier6_design_titles": {"patterns": ["drafter"], "weight": 20, "description": "Design titles"},
    },
    "design_role_indicators": ["design"],
}
R = parse_rules(RULES)
SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "seq" else T.StringType()) for n in ("seq", "company", "title", "description")])


def score(spark, rows, rules=R):
    df = spark.createDataFrame(rows, SCHEMA)
    out = score_postings(df, rules).orderBy("seq").collect()
    return {r["seq"]: r for r in out}


def test_missing_description_variants(spark):
    r = score(spark, [(1, "A", "t", None), (2, "A", "t", ""), (3, "A", "t", "   ")])
    assert r[1]["reasons"] == ["No description provided"] and r[1]["score"] == 0.0
    assert r[2]["reasons"] == ["No description provided"]
    # blanks are a description: they go on to the context check
    assert r[3]["reasons"] == ["Missing required solar/PV context in title or description"]
    assert r[3]["rejection_category"] == "no_solar_context"


def test_company_blocklist_and_empty_company(spark):
    r = score(spark, [(1, "Orbitex Space", "pv", "pv design layoutpro"), (2, None, "pv", "pv layoutpro"),
                      (3, "", "pv", "pv layoutpro"), (4, "Oklahoma Sun", "pv", "pv layoutpro")])
    assert r[1]["company_score"] == -100.0 and r[1]["reasons"] == ["Company 'Orbitex Space' in blocklist (orbitex)"]
    assert r[1]["rejection_category"] == "company_blocklist" and not r[1]["qualified"]
    assert r[2]["company_score"] == 0.0 and r[2]["qualified"]
    assert r[3]["company_score"] == 0.0
    # substring rule: 'kla' inside 'Oklahoma' blocks (kept for parity)
    assert r[4]["company_score"] == -100.0


def test_context_only_in_title(spark):
    r = score(spark, [(1, "A", "PV role", "layoutpro work"), (2, "A", "role", "PV layoutpro work")])
    assert r[1]["reasons"][0] == "+0: Has solar/PV context in title (required)"
    assert r[2]["reasons"][0] == "+0: Has solar/PV context in description (required)"
    assert r[1]["score"] == 100.0


def test_exclusion_scope_title_area_199_201(spark):
    pad = "pv " + "x" * 191  # 194 characters
    at_199 = pad + " chief"   # pattern ends at character 200: inside the head
    at_201 = pad + "xxx chief"  # starts after character 200: outside the head
    r = score(spark, [(1, "A", "t", at_199), (2, "A", "t", at_201)])
    assert r[1]["score"] == -100.0 and r[1]["rule_group"] == "exclusions.bosses"
    # the category is read from the reason text: "management roles (matched 'chief')" holds no
    # ladder word ('manager', 'chief ' with a blank), so it lands in 'other' like the reference
    assert r[1]["rejection_category"] == "exclusions.other"
    assert r[2]["score"] == 0.0 and r[2]["rejection_category"] == "below_threshold"


def test_exclusion_order_and_category_text(spark):
    r = score(spark, [(1, "A", "t", "pv roof crew quota carrier"), (2, "A", "t", "pv racket stringing"),
                      (3, "A", "t", "pv satellite array")])
    assert r[1]["reasons"] == ["Excluded: Field installer roles (matched 'roof crew')"]
    assert r[1]["rejection_category"] == "exclusions.installer"
    # 'stringing' contains no ladder word; the group description decides -> other
    assert r[2]["rejection_category"] == "exclusions.other" and r[2]["rule_group"] == "exclusions.misc"
    assert r[3]["rejection_category"] == "exclusions.space"


def test_tiers_add_up_threshold_and_cap(spark):
    full = "pv designer design layoutpro string sizing cadkit utility scale drafter"
    r = score(spark, [(1, "A", "t", full), (2, "A", "t", "pv drafter design cadkit"), (3, "A", "t", "pv drafter")])
    assert r[1]["score"] == 330.0 and r[1]["top_tier"] == "tier1"
    assert r[1]["reasons"] == [
        "+0: Has solar/PV context in description (required)", "+100: Tools (layoutpro)", "+60: Strong (string sizing)",
        "+40: CAD project", "+80: Titles (pv designer)", "+30: CAD design", "+20: Design titles (drafter)",
        "+0: Has design role indicator"]
    # exactly at the threshold qualifies
    assert r[2]["score"] == 50.0 and r[2]["qualified"] and r[2]["top_tier"] == "tier5"
    assert r[3]["score"] == 20.0 and not r[3]["qualified"]
    leads = process_leads(qualified_postings(score_postings(spark.createDataFrame([(1, "A Co", "t", full)], SCHEMA), R)), R, "2026-01-01")
    assert leads.first()["confidence_score"] == 100.0


def test_first_pattern_in_list_order_not_text_order(spark):
    r = score(spark, [(1, "A", "t", "pv gridsketch then layoutpro")])
    assert "+100: Tools (layoutpro)" in r[1]["reasons"]


def test_large_description(spark):
    big = "pv " + "lorem " * 20000 + "layoutpro"
    r = score(spark, [(1, "A", "t", big)])
    assert r[1]["score"] == 100.0


def test_loader_validation(tmp_dir):
    with pytest.raises(ValueError, match="missing required keys"):
        parse_rules({"company_blocklist": []})
    with pytest.raises(ValueError, match="required_context missing 'patterns'"):
        parse_rules({"company_blocklist": [], "required_context": {}, "exclusions": {}, "positive_signals": {}})
    minimal = {"company_blocklist": [], "required_context": {"patterns": ["pv"]}, "exclusions": {}, "positive_signals": {}}
    r = parse_rules(minimal)
    assert r.threshold == DEFAULT_THRESHOLD and r.tiers == {} and r.design_indicators == ()
    path = f"{tmp_dir}/rules.json"
    with open(path, "w") as f:
        json.dump(RULES, f)
    assert load_rules(path).tier("tier4_title").patterns == ("pv designer",)


def test_minimal_rules_score(spark):
    minimal = parse_rules({"company_blocklist": [], "required_context": {"patterns": ["pv"]}, "exclusions": {},
                           "positive_signals": {}})
    r = score(spark, [(1, "A", "t", "pv")], minimal)
    assert r[1]["score"] == 0.0 and not r[1]["qualified"]


def test_dedupe_first_per_company_and_missing_company(spark):
    rows = [(3, "Sun Co", "b", "pv layoutpro"), (1, "Sun Co", "a", "pv layoutpro"), (2, None, "c", "pv layoutpro"),
            (4, "", "d", "pv layoutpro"), (5, "sun co", "e", "pv layoutpro")]
    s = score_postings(spark.createDataFrame(rows, SCHEMA), R)
    leads = {r["company"]: r for r in process_leads(qualified_postings(s), R, "2026-01-01").collect()}
    assert set(leads) == {"Sun Co", "sun co"}  # exact-case companies
    assert leads["Sun Co"]["job_title"] == "a" and leads["Sun Co"]["domain"] == "sun.com"


LADDER_RULES = parse_rules({
    "company_blocklist": [],
    "required_context": {"patterns": ["pv"]},
    "exclusions": {
        "chips": {"patterns": ["asic design"], "description": "Chip roles"},
        "execs": {"patterns": ["ceo"], "description": "Top roles"},
        "pitch": {"patterns": ["technical sales"], "description": "Pitch roles"},
        "courts": {"patterns": ["racket"], "description": "Tennis stringing"},
        "bosses": {"patterns": ["project manager"], "description": "People leads"},
        "eng": {"patterns": ["relay engineer"], "description": "Other roles"},
    },
    "positive_signals": {},
})


@pytest.mark.parametrize("text,category,group", [
    ("pv asic design", "exclusions.eda_tools", "exclusions.chips"),      # 'asic' checked before semiconductor words
    ("pv ceo", "exclusions.other", "exclusions.execs"),                   # "'ceo'" is quoted: no ' ceo' in the reason
    ("pv technical sales", "exclusions.sales", "exclusions.pitch"),
    ("pv racket", "exclusions.tennis", "exclusions.courts"),              # reached through the group description only
    ("pv project manager", "exclusions.management", "exclusions.bosses"),
    ("pv relay engineer", "exclusions.other", "exclusions.eng"),          # no listed keyword in the reason
    ("pv nothing", "below_threshold", "below_threshold"),
])
def test_category_ladder_traps(spark, text, category, group):
    r = score(spark, [(1, "A", "t", text)], LADDER_RULES)
    assert (r[1]["rejection_category"], r[1]["rule_group"]) == (category, group)


def test_missing_optional_columns(spark):
    df = spark.createDataFrame([(1, "pv layoutpro")], "seq long, description string")
    r = score_postings(df, R).first()
    assert r["score"] == 100.0 and r["reasons"][0] == "+0: Has solar/PV context in description (required)"


def test_dedupe_keep_best(spark):
    rows = [(1, "Sun Co", "a", "pv drafter design cadkit"), (2, "Sun Co", "b", "pv layoutpro"), (3, "Sun Co", "c", "pv layoutpro")]
    s = qualified_postings(score_postings(spark.createDataFrame(rows, SCHEMA), R))
    first = process_leads(s, R, "2026-01-01").first()
    best = process_leads(s, R, "2026-01-01", keep="best").first()
    assert first["job_title"] == "a" and best["job_title"] == "b"
    with pytest.raises(ValueError):
        process_leads(s, R, "2026-01-01", keep="last")


def test_word_boundary_option(spark):
    base = {"company_blocklist": [], "required_context": {"patterns": ["pv"]}, "positive_signals": {
        "tier1_tools": {"patterns": ["cad"], "weight": 100, "description": "Tools", "word_boundary": True}}}
    sub = parse_rules({**base, "exclusions": {"m": {"patterns": ["cto"], "description": "Top"}}})
    word = parse_rules({**base, "exclusions": {"m": {"patterns": ["cto"], "description": "Top", "word_boundary": True}}})
    rows = [(1, "A", "t", "pv director role cad"), (2, "A", "t", "pv the cto. cad"), (3, "A", "t", "pv cadence")]
    s, w = score(spark, rows, sub), score(spark, rows, word)
    # substring parity by default: 'cto' inside 'director' excludes
    assert s[1]["score"] == -100.0 and s[2]["score"] == -100.0
    # whole words when asked: only the standalone 'cto' excludes; 'cad' does not fire inside 'cadence'
    assert w[1]["score"] == 100.0 and w[2]["score"] == -100.0 and w[3]["score"] == 0.0


def test_qualified_plus_rejected_is_all(spark):
    from tables import SF_SMALL
    from postsift.operators.runstats import filter_stats, rejection_breakdown
    from postsift.plans.probe_rules import probe_rules
    from postsift.sources import bindings as b

    s = score_postings(b.postings(spark, SF_SMALL), probe_rules())
    st_ = filter_stats(s).first()
    assert st_["qualified"] + st_["rejected"] == st_["total_processed"] == 200
    cats = rejection_breakdown(s, None).collect()
    assert sum(r["n"] for r in cats) == st_["rejected"]
