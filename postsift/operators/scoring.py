"""Rule scoring (C1-C21) as native Column expressions.

``score_postings`` adds the scoring result to every row of a postings
DataFrame in two narrow projections: no shuffle, no UDF, whole-stage codegen.
Lower-cased text and the 200-character title area are materialised once in a
first projection; every rule test then reads those columns. First-match
rules are CASE chains in list order (``sql_first_index``), so evaluation stops at
the first hit just like a loop with ``break``.

Semantics follow the reference's scorer:
  company blocklist (stop) -> missing description (0) -> required context in
  title or description (else 0) -> exclusions in group order (-100, stop) ->
  tiers 1..6 (additive; 2, 3, 5 need a design-role indicator) -> threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (
    REASON_CONTEXT_DESC,
    REASON_CONTEXT_TITLE,
    REASON_DESIGN,
    REASON_NO_CONTEXT,
    REASON_NO_DESCRIPTION,
    TITLE_AREA_CHARS,
    RuleSet,
    rule_rows,
    rule_table,
)
from ..functions.rule_sql import sql_any, sql_first_index, sql_has, sql_pick, sql_str

# --- fixed values ---------------------------------------------------------
# Rejection categories are read from the text of the first reason, in this
# order (the order decides overlaps, e.g. 'asic design' is an EDA hit).
CATEGORY_LADDER = (
    ("exclusions.installer", ("installer", "stringer", "roofer", "foreman", "crew", "technician", "lineman", "lineworker")),
    ("exclusions.sales", ("sales", "marketing", "account executive", "business development")),
    ("exclusions.management", ("manager", "director", "vp ", "vice president", "chief ")),
    ("exclusions.other_engineering", ("application engineer", "field engineer", "commissioning", "systems engineer",
                                      "interconnection", "grid", "protection", "metering", "estimator", "preconstruction")),
    ("exclusions.other_engineering_strict", ("structural engineer", "civil engineer", "mechanical engineer", "geotechnical")),
    ("exclusions.eda_tools", ("cadence", "synopsys", "mentor", "eda", "asic", "verilog", "virtuoso", "spectre")),
    ("exclusions.semiconductor", ("semiconductor", "rtl design", "fpga", "vlsi", "chip design", "wafer", "foundry")),
    ("exclusions.space", ("satellite", "spacecraft", "orbit", "rocket", "aerospace", "starlink", "avionics")),
    ("exclusions.tennis", ("tennis", "racquet", "badminton", "pickleball")),
)
# management also matches these words at the start or after a blank
MANAGEMENT_SHORT = ("ceo", "cto", "cfo")

SCORE_COLUMNS = (
    "company_score", "role_score", "score", "qualified", "threshold", "reasons",
    "rule_group", "top_tier", "rejection_category",
)
DETAIL_COLUMNS = (
    "blocked_by", "context_in_title", "context_in_description", "design_role", "excluded_group", "excluded_pattern",
    "tier1_pattern", "tier2_pattern", "tier3_hit", "tier4_pattern", "tier5_hit", "tier6_pattern",
)



def category_sql(first_reason: str) -> str:
    """The rejection category read from the text of the first reason."""
    r = f"lower({first_reason})"
    parts = []
    for cat, words in CATEGORY_LADDER:
        cond = sql_any(r, words)
        if cat == "exclusions.management":
            short = " OR ".join(f"contains({r}, {sql_str(' ' + w)}) OR startswith({r}, {sql_str(w)})" for w in MANAGEMENT_SHORT)
            cond = f"({cond} OR {short})"
        parts.append(f"WHEN {cond} THEN {sql_str(cat)}")
    excluded = "CASE " + " ".join(parts) + " ELSE 'exclusions.other' END"
    return (
        f"CASE WHEN contains({r}, 'missing required') OR contains({r}, 'no description') THEN 'no_solar_context' "
        f"WHEN contains({r}, 'excluded') THEN {excluded} ELSE 'below_threshold' END"
    )


def score_postings(
    df: DataFrame,
    rules: RuleSet,
    description: str = "description",
    company: str | None = "company",
    title: str | None = "title",
    details: bool = False,
) -> DataFrame:
    """C14 score_job over a DataFrame; adds SCORE_COLUMNS (and DETAIL_COLUMNS if asked).

    ``company=None`` / ``title=None`` score without that input (C16 uses no title).
    ``top_tier`` is the highest tier that fired (the reference's own extractor
    can only return 'unknown'; the intended value is computed from tier hits).
    ``rule_group`` names the true deciding rule group next to the text-derived
    ``rejection_category``. The rule set is compiled to SQL expression text,
    one parse per column (``functions.rule_sql``).
    """
    tmp = "__ps_"
    E = F.expr
    # optional inputs the frame lacks are scored as missing, like an absent field
    title = title if title and title in df.columns else None
    company = company if company and company in df.columns else None
    d = f"`{description}`"
    pre = df.withColumns(
        {
            tmp + "desc": E(f"lower({d})"),
            tmp + "title": E(f"coalesce(lower(`{title}`), '')") if title else F.lit(""),
            tmp + "comp": E(f"`{company}`") if company else F.lit(None).cast("string"),
        }
    ).withColumn(tmp + "head", E(f"substring({tmp}desc, 1, {TITLE_AREA_CHARS})"))
    desc, head, ttl, comp = (tmp + n for n in ("desc", "head", "title", "comp"))

    # Exclusions, groups in order, patterns in order; one CASE over all pairs
    ex_groups, ex_pats, ex_reasons, ex_cases = [], [], [], []
    for ex in rules.exclusions:
        scope = head if ex.scope == "title" else desc
        for p in ex.patterns:
            ex_groups.append(ex.name)
            ex_pats.append(p)
            ex_reasons.append(ex.reason(p))
            ex_cases.append(f"WHEN {sql_has(scope, p, ex.word_boundary)} THEN {len(ex_pats)}")
    ex_idx = ("CASE " + " ".join(ex_cases) + " END") if ex_cases else "CAST(NULL AS INT)"

    t1, t2, t3, t4, t5, t6 = (rules.tier(k) for k in (
        "tier1_tools", "tier2_strong", "tier3_cad_project", "tier4_title", "tier5_cad_design", "tier6_design_titles"))
    none_i = "CAST(NULL AS INT)"
    design = sql_any(desc, rules.design_indicators)
    mid = pre.withColumns(
        {
            # Blocklist, first blocked name in list order
            tmp + "blk": E(f"CASE WHEN {comp} IS NOT NULL AND {comp} <> '' THEN {sql_first_index(f'lower({comp})', rules.blocklist)} END"),
            tmp + "hasdesc": E(f"{d} IS NOT NULL AND {d} <> ''"),
            # C4: required context in the title or the description
            tmp + "ctxt": E(sql_any(ttl, rules.context)),
            tmp + "ctxd": E(sql_any(desc, rules.context)),
            tmp + "ex": E(ex_idx),
            # Design-role indicator (guard of tiers 2, 3, 5)
            tmp + "design": E(design),
            tmp + "t1": E(sql_first_index(desc, t1.patterns, t1.word_boundary) if t1 else none_i),
            tmp + "t2": E(f"CASE WHEN {design} THEN {sql_first_index(desc, t2.patterns, t2.word_boundary)} END" if t2 else none_i),
            tmp + "t3": E(f"{design} AND {sql_any(desc, t3.patterns_cad, t3.word_boundary)} AND "
                          f"{sql_any(desc, t3.patterns_project, t3.word_boundary)}" if t3 else "false"),
            tmp + "t4": E(sql_first_index(head, t4.patterns, t4.word_boundary) if t4 else none_i),
            tmp + "t5": E(f"{design} AND {sql_any(desc, t5.patterns_cad, t5.word_boundary)}" if t5 else "false"),
            tmp + "t6": E(sql_first_index(desc, t6.patterns, t6.word_boundary) if t6 else none_i),
        }
    )
    c = {n: tmp + n for n in ("blk", "hasdesc", "ctxt", "ctxd", "ex", "design", "t1", "t2", "t3", "t4", "t5", "t6")}
    blocked = f"({c['blk']} IS NOT NULL)"
    no_desc = f"(NOT {c['hasdesc']})"
    no_ctx = f"(NOT ({c['ctxt']} OR {c['ctxd']}))"
    excluded = f"({c['ex']} IS NOT NULL)"

    def w(t):
        return repr(float(t.weight)) if t else "0.0"

    positive = " + ".join([
        f"CASE WHEN {c['t1']} IS NOT NULL THEN {w(t1)} ELSE 0.0 END",
        f"CASE WHEN {c['t2']} IS NOT NULL THEN {w(t2)} ELSE 0.0 END",
        f"CASE WHEN {c['t3']} THEN {w(t3)} ELSE 0.0 END",
        f"CASE WHEN {c['t4']} IS NOT NULL THEN {w(t4)} ELSE 0.0 END",
        f"CASE WHEN {c['t5']} THEN {w(t5)} ELSE 0.0 END",
        f"CASE WHEN {c['t6']} IS NOT NULL THEN {w(t6)} ELSE 0.0 END",
    ])
    role_score = f"CAST(CASE WHEN {blocked} OR {no_desc} OR {no_ctx} THEN 0.0 WHEN {excluded} THEN -100.0 ELSE {positive} END AS DOUBLE)"
    company_score = f"CAST(CASE WHEN {blocked} THEN -100.0 ELSE 0.0 END AS DOUBLE)"
    # the company part is 0 unless blocked, and a block stops scoring
    score = f"CAST(CASE WHEN {blocked} THEN -100.0 ELSE {role_score} END AS DOUBLE)"
    thr = repr(float(rules.threshold))
    qualified = f"CASE WHEN {blocked} OR (NOT {no_desc} AND NOT {no_ctx} AND {excluded}) THEN false ELSE {score} >= {thr} END"

    def tier_reason(t, idx: str | None, hit: str | None = None) -> str:
        if t is None:
            return "CAST(NULL AS STRING)"
        if idx is not None:
            return sql_pick([t.reason(p) for p in t.patterns], idx)
        return f"CASE WHEN {hit} THEN {sql_str(t.reason())} END"

    comp_reason = (
        f"concat({sql_str('Company ' + chr(39))}, {comp}, {sql_str(chr(39) + ' in blocklist (')}, "
        f"{sql_pick(rules.blocklist, c['blk'])}, ')')"
    )
    scored_reasons = "array_compact(array(" + ", ".join([
        f"CASE WHEN {c['ctxt']} THEN {sql_str(REASON_CONTEXT_TITLE)} ELSE {sql_str(REASON_CONTEXT_DESC)} END",
        tier_reason(t1, c["t1"]), tier_reason(t2, c["t2"]), tier_reason(t3, None, c["t3"]),
        tier_reason(t4, c["t4"]), tier_reason(t5, None, c["t5"]), tier_reason(t6, c["t6"]),
        f"CASE WHEN {c['design']} THEN {sql_str(REASON_DESIGN)} END",
    ]) + "))"
    reasons = (
        f"CASE WHEN {blocked} THEN array({comp_reason}) "
        f"WHEN {no_desc} THEN array({sql_str(REASON_NO_DESCRIPTION)}) "
        f"WHEN {no_ctx} THEN array({sql_str(REASON_NO_CONTEXT)}) "
        f"WHEN {excluded} THEN array({sql_pick(ex_reasons, c['ex'])}) "
        f"ELSE {scored_reasons} END"
    )
    rule_group = (
        f"CASE WHEN {blocked} THEN 'company_blocklist' WHEN {no_desc} THEN 'no_description' "
        f"WHEN {no_ctx} THEN 'no_context' WHEN {excluded} THEN concat('exclusions.', {sql_pick(ex_groups, c['ex'])}) "
        f"WHEN {qualified} THEN 'qualified' ELSE 'below_threshold' END"
    )
    top_tier = (
        f"CASE WHEN {blocked} OR {no_desc} OR {no_ctx} OR {excluded} THEN 'unknown' "
        f"WHEN {c['t1']} IS NOT NULL THEN 'tier1' WHEN {c['t2']} IS NOT NULL THEN 'tier2' WHEN {c['t3']} THEN 'tier3' "
        f"WHEN {c['t4']} IS NOT NULL THEN 'tier4' WHEN {c['t5']} THEN 'tier5' WHEN {c['t6']} IS NOT NULL THEN 'tier6' "
        f"ELSE 'unknown' END"
    )
    out = {
        "company_score": company_score,
        "role_score": role_score,
        "score": score,
        "qualified": qualified,
        "threshold": f"CAST({thr} AS DOUBLE)",
        "reasons": reasons,
        "rule_group": rule_group,
        "top_tier": top_tier,
    }
    if details:
        live = f"(NOT {blocked} AND NOT {no_desc} AND NOT {no_ctx})"
        scoring = f"({live} AND NOT {excluded})"
        out.update(
            {
                "blocked_by": sql_pick(rules.blocklist, c["blk"]),
                "context_in_title": c["ctxt"],
                "context_in_description": c["ctxd"],
                "design_role": c["design"],
                "excluded_group": f"CASE WHEN {live} THEN {sql_pick(ex_groups, c['ex'])} END",
                "excluded_pattern": f"CASE WHEN {live} THEN {sql_pick(ex_pats, c['ex'])} END",
                "tier1_pattern": f"CASE WHEN {scoring} THEN {sql_pick(t1.patterns if t1 else [], c['t1'])} END",
                "tier2_pattern": f"CASE WHEN {scoring} THEN {sql_pick(t2.patterns if t2 else [], c['t2'])} END",
                "tier3_hit": f"{scoring} AND {c['t3']}",
                "tier4_pattern": f"CASE WHEN {scoring} THEN {sql_pick(t4.patterns if t4 else [], c['t4'])} END",
                "tier5_hit": f"{scoring} AND {c['t5']}",
                "tier6_pattern": f"CASE WHEN {scoring} THEN {sql_pick(t6.patterns if t6 else [], c['t6'])} END",
            }
        )
    # The results leave through a one-row generator: a later filter on them (e.g.
    # ``qualified``) cannot be pushed below it and inlined into the scan, where
    # it would re-evaluate every rule (and ``lower(text)``) once per reference.
    struct = "named_struct(" + ", ".join(f"{sql_str(k)}, {v}" for k, v in out.items()) + ")"
    scored = mid.select(*[F.col(f"`{x}`") for x in mid.columns], E(f"inline(array({struct}))"))
    scored = scored.withColumn(
        "rejection_category",
        E(f"CASE WHEN qualified THEN CAST(NULL AS STRING) WHEN company_score < 0 THEN 'company_blocklist' "
          f"WHEN size(reasons) = 0 THEN 'unknown' ELSE {category_sql('reasons[0]')} END"),
    )
    return scored.drop(*[col for col in scored.columns if col.startswith(tmp)])


def is_match(df: DataFrame, rules: RuleSet, description: str = "description", company: str | None = "company") -> DataFrame:
    """Qualified flag of a description (and optional company), no title."""
    return score_postings(df, rules, description, company, None).withColumnRenamed("qualified", "is_match")


def qualified_postings(scored: DataFrame) -> DataFrame:
    """C17: keep qualified rows (a frame without a description keeps everything)."""
    if "qualified" not in scored.columns:
        return scored
    return scored.filter(F.col("qualified"))


def rule_hits(postings: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per (posting, rule pattern) hit; explains a score.

    One generated test per rule in a projection: no join, postings never move.
    For rule tables of thousands of patterns see ``rule_join.rule_hits``.
    """
    p = postings.selectExpr(
        "seq", "lower(description) AS _d", f"substring(lower(description), 1, {TITLE_AREA_CHARS}) AS _h",
        "coalesce(lower(title), '') AS _t", "lower(company) AS _c")
    columns = {"company": ("_c",), "title": ("_h",), "title_or_description": ("_t", "_d")}
    tests = []
    for priority, group, kind, scope, pattern, weight, whole_words, _ in rule_rows(rules):
        cond = " OR ".join(sql_has(c, pattern, whole_words) for c in columns.get(scope, ("_d",)))
        row = {"priority": str(priority), "rule_group": sql_str(group), "kind": sql_str(kind), "scope": sql_str(scope),
               "pattern": sql_str(pattern), "weight": f"CAST({weight!r} AS DOUBLE)"}
        tests.append(f"CASE WHEN {cond} THEN named_struct(" + ", ".join(f"'{k}', {v}" for k, v in row.items()) + ") END")
    if not tests:
        return p.select("seq").join(rule_table(postings.sparkSession, rules).drop("word_boundary", "regex"))
    return p.selectExpr("seq", f"inline(array_compact(array({', '.join(tests)})))")


def first_hits(hits: DataFrame) -> DataFrame:
    """The hit of the lowest priority per posting and rule group."""
    from .ordering import first_per_key

    return first_per_key(hits, ["seq", "rule_group"], "priority")
