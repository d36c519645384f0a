"""Registered queries for the rule scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rules import rule_table
from ..operators import rule_join
from ..operators import scoring as sc
from ..sources import bindings as b
from . import oracle_views as ov
from .probe_rules import probe_rules
from .registry import query

R = probe_rules()
SCORED = ov.scored_sql(R)
W = ov.with_(ov.POSTINGS, SCORED)


def scored(spark, d, details=False):
    return sc.score_postings(b.postings(spark, d), R, details=details)


def _score_cols(df):
    return df.select(
        "seq", "company_score", "role_score", "score", "qualified", "threshold",
        F.array_join("reasons", " ; ").alias("reasons_text"), "rule_group", "top_tier", "rejection_category",
    )


@query("score_job", "C14", W + """SELECT seq, company_score, role_score, score, qualified, threshold, reasons_text,
  rule_group, top_tier, rejection_category FROM scored""")
def score_job(spark, d):
    return _score_cols(scored(spark, d))


@query("contains_any", "C1", ov.with_(ov.POSTINGS) + f"""SELECT seq,
  {ov.any_sql('lower(description)', R.context)} AS context_in_description,
  {ov.any_sql('lower(description)', R.design_indicators)} AS design_role FROM postings""")
def contains_any(spark, d):
    p = b.postings(spark, d)
    low = F.lower("description")
    return p.select("seq", tx.contains_any(low, R.context).alias("context_in_description"),
                    tx.contains_any(low, R.design_indicators).alias("design_role"))


_T2 = R.tier("tier2_strong").patterns
_T1 = R.tier("tier1_tools").patterns


@query("first_pattern", "C2", ov.with_(ov.POSTINGS) + f"""SELECT seq,
  {ov.first_sql('lower(description)', _T2)} AS first_strong,
  {ov.first_sql('lower(description)', _T1)} AS first_tool FROM postings""")
def first_pattern(spark, d):
    p = b.postings(spark, d)
    low = F.lower("description")
    return p.select("seq", tx.first_pattern(low, _T2).alias("first_strong"), tx.first_pattern(low, _T1).alias("first_tool"))


@query("score_company", "C3", W + "SELECT seq, company_score, CASE WHEN company_score < 0 THEN reasons_text END AS company_reason FROM scored")
def score_company(spark, d):
    s = scored(spark, d)
    return s.select("seq", "company_score", F.when(F.col("company_score") < 0, F.array_join("reasons", " ; ")).alias("company_reason"))


def _detail_sql(select: str) -> str:
    # the detail keys read the CTE stages of the oracle scorer directly
    return ov.with_(ov.POSTINGS, SCORED) + select


@query("required_context", "C4", _detail_sql("""SELECT seq, _ctxt AS context_in_title, _ctxd AS context_in_description,
  _hasdesc AND NOT (_ctxt OR _ctxd) AND _blk IS NULL AS missing_context FROM scored_c"""))
def required_context(spark, d):
    s = scored(spark, d, details=True)
    return s.select("seq", "context_in_title", "context_in_description",
                    (F.col("rule_group") == "no_context").alias("missing_context"))


@query("exclusion_match", "C5", _detail_sql("""SELECT seq,
  CASE WHEN _blk IS NULL AND _hasdesc AND (_ctxt OR _ctxd) THEN split_part(_ex, chr(1), 1) END AS excluded_group,
  CASE WHEN _excluded THEN split_part(_ex, chr(1), 2) END AS exclusion_reason FROM scored_c"""))
def exclusion_match(spark, d):
    s = scored(spark, d, details=True)
    return s.select("seq", "excluded_group",
                    F.when(F.col("rule_group").startswith("exclusions."), F.col("reasons").getItem(0)).alias("exclusion_reason"))


@query("design_role", "C6", _detail_sql("SELECT seq, _design AS design_role FROM scored_c"))
def design_role(spark, d):
    return scored(spark, d, details=True).select("seq", "design_role")


def _tier_sql(col_expr: str, alias: str) -> str:
    return _detail_sql(f"SELECT seq, CASE WHEN NOT (_zero OR _excluded OR _blk IS NOT NULL) THEN {col_expr} END AS {alias} FROM scored_c")


def _tier_reason_pattern(reason_col: str) -> str:
    # the pattern is the text inside the last parentheses of a tier reason
    return f"regexp_extract({reason_col}, '\\(([^()]*)\\)$', 1)"


@query("tier1_tools", "C7", _tier_sql(_tier_reason_pattern("_r1"), "tier1_pattern"))
def tier1_tools(spark, d):
    return scored(spark, d, details=True).select("seq", "tier1_pattern")


@query("tier2_strong", "C8", _tier_sql(_tier_reason_pattern("_r2"), "tier2_pattern"))
def tier2_strong(spark, d):
    return scored(spark, d, details=True).select("seq", "tier2_pattern")


@query("tier3_cad_project", "C9", _tier_sql("_h3", "tier3_hit"))
def tier3_cad_project(spark, d):
    s = scored(spark, d, details=True)
    return s.select("seq", F.when(F.col("rule_group").isin("qualified", "below_threshold"), F.col("tier3_hit")).alias("tier3_hit"))


@query("tier4_title", "C10", _tier_sql(_tier_reason_pattern("_r4"), "tier4_pattern"))
def tier4_title(spark, d):
    return scored(spark, d, details=True).select("seq", "tier4_pattern")


@query("tier5_cad_design", "C11", _tier_sql("_h5", "tier5_hit"))
def tier5_cad_design(spark, d):
    s = scored(spark, d, details=True)
    return s.select("seq", F.when(F.col("rule_group").isin("qualified", "below_threshold"), F.col("tier5_hit")).alias("tier5_hit"))


@query("tier6_titles", "C12", _tier_sql(_tier_reason_pattern("_r6"), "tier6_pattern"))
def tier6_titles(spark, d):
    return scored(spark, d, details=True).select("seq", "tier6_pattern")


@query("score_role", "C13", W + "SELECT seq, role_score, CASE WHEN company_score < 0 THEN NULL ELSE reasons_text END AS role_reasons FROM scored")
def score_role(spark, d):
    s = scored(spark, d)
    return s.select("seq", "role_score", F.when(F.col("company_score") >= 0, F.array_join("reasons", " ; ")).alias("role_reasons"))


@query("score_reasons", "C15", W + "SELECT seq, reasons_text, CAST(len(string_split(reasons_text, ' ; ')) AS BIGINT) AS n_reasons FROM scored")
def score_reasons(spark, d):
    s = scored(spark, d)
    return s.select("seq", F.array_join("reasons", " ; ").alias("reasons_text"), F.size("reasons").cast("bigint").alias("n_reasons"))


@query("is_match", "C16", ov.with_(ov.POSTINGS, ov.scored_sql(R, use_title=False)) + "SELECT seq, qualified AS is_match FROM scored")
def is_match(spark, d):
    return sc.is_match(b.postings(spark, d), R).select("seq", "is_match")


@query("qualified_postings", "C17", W + "SELECT seq, company, title, score FROM scored WHERE qualified")
def qualified_postings(spark, d):
    return sc.qualified_postings(scored(spark, d)).select("seq", "company", "title", "score")


@query("rejection_category", "C19", W + "SELECT seq, rejection_category, rule_group FROM scored WHERE NOT qualified")
def rejection_category(spark, d):
    return scored(spark, d).filter(~F.col("qualified")).select("seq", "rejection_category", "rule_group")


@query("top_tier", "C20", W + "SELECT seq, top_tier FROM scored WHERE qualified")
def top_tier(spark, d):
    return scored(spark, d).filter("qualified").select("seq", "top_tier")


def _rules_sql() -> str:
    from ..functions.rules import rule_rows

    vals = ", ".join(f"({r[0]}, {ov.q(r[1])}, {ov.q(r[2])}, {ov.q(r[3])}, {ov.q(r[4])}, {r[5]})" for r in rule_rows(R))
    assert not any(r[6] for r in rule_rows(R)), "the oracle restates substring rules only"
    return f"rules(priority, rule_group, kind, scope, pattern, weight) AS (VALUES {vals})"


_RULE_HITS = (ov.with_(ov.POSTINGS, _rules_sql()) + """SELECT p.seq, r.priority, r.rule_group, r.kind, r.scope, r.pattern,
  CAST(r.weight AS DOUBLE) AS weight
FROM postings p JOIN rules r ON coalesce(CASE
  WHEN r.scope = 'company' THEN contains(lower(p.company), r.pattern)
  WHEN r.scope = 'title' THEN contains(substr(lower(p.description), 1, 200), r.pattern)
  WHEN r.scope = 'title_or_description' THEN contains(coalesce(lower(p.title), ''), r.pattern) OR contains(lower(p.description), r.pattern)
  ELSE contains(lower(p.description), r.pattern) END, FALSE)""")


@query("rule_hits", "C21", _RULE_HITS)
def rule_hits(spark, d):
    return sc.rule_hits(b.postings(spark, d), R)


@query("rule_table_hits", "C21", _RULE_HITS)
def rule_table_hits(spark, d):
    return rule_join.rule_hits(b.postings(spark, d), rule_table(spark, R))
