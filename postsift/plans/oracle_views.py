"""The bindings and the scorer restated in plain SQL for the DuckDB oracle.

These strings are written independently of the Spark operators (CASE
ladders over ``contains``), so a match is a real cross-check. They are used
only by ``oracle_sql()`` and the tests, never by the engine.
"""

from __future__ import annotations

from ..functions.rules import (
    REASON_CONTEXT_DESC,
    REASON_CONTEXT_TITLE,
    REASON_DESIGN,
    REASON_NO_CONTEXT,
    REASON_NO_DESCRIPTION,
    RuleSet,
)
from ..functions.text import (
    BLOCKED_WORDS,
    CONNECTION_WORDS,
    HIRING_CLAUSE,
    MANAGERS_CLAUSE,
    PROFILE_SITE,
    RATE_LIMIT_WORDS,
    SEARCH_BASE,
    TIMEOUT_WORDS,
    keyword_clause,
)
from ..operators.scoring import CATEGORY_LADDER, MANAGEMENT_SHORT
from ..sources.bindings import (
    COMPANY_SUFFIXES,
    ERROR_STATUS,
    ERROR_TEXTS,
    N_POSTING_TERMS,
    N_TERMS,
    PROGRESS_KEYS,
    PROGRESS_STATUS,
    SELECTORS,
    SITES,
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else (q(v) if isinstance(v, str) else str(v)) for v in values) + "]"


def any_sql(x: str, pats) -> str:
    pats = list(pats)
    if not pats:
        return "FALSE"
    return "coalesce(" + " OR ".join(f"contains({x}, {q(p)})" for p in pats) + ", FALSE)"


def first_sql(x: str, pats) -> str:
    pats = list(pats)
    if not pats:
        return "NULL"
    return "CASE " + " ".join(f"WHEN contains({x}, {q(p)}) THEN {q(p)}" for p in pats) + " END"


# --- bindings ---------------------------------------------------------------

POSTINGS = f"""postings AS (
  SELECT doc_id AS seq, doc_id AS posting_id,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN ''
         ELSE 'Acme ' || source || {sql_list(COMPANY_SUFFIXES)}[doc_id % 5 + 1] END AS company,
    substr(text, 1, 40) AS title, lang AS location, '/jobs/' || doc_id || '/x' AS job_url,
    CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN '' ELSE text END AS description,
    source AS site, 'term_' || (doc_id % {N_POSTING_TERMS}) AS search_term, doc_id % 4 AS batch
  FROM documents)"""

LABELLED = """labelled AS (
  SELECT p.*, l.quality = 1 AS label FROM postings p JOIN labels l ON l.doc_id = p.seq)"""


def _classify_sql(x: str) -> str:
    lx = f"lower({x})"
    return (
        f"CASE WHEN {any_sql(lx, RATE_LIMIT_WORDS)} THEN 'rate_limit' "
        f"WHEN {any_sql(lx, BLOCKED_WORDS)} THEN 'blocked' "
        f"WHEN {any_sql(lx, TIMEOUT_WORDS)} THEN 'timeout' "
        f"WHEN {any_sql(lx, CONNECTION_WORDS)} THEN 'connection' ELSE 'unknown' END"
    )


MASK_SQL = "regexp_replace({x}, '(://[^:]+:)[^@]+(@)', '\\1****\\2', 'g')"

ATTEMPTS = f"""ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
attempts AS (
  SELECT event_id AS seq, ts, strftime(ts, '%Y-%m-%d') AS run_id, 'term_' || (user_id % {N_TERMS}) AS search_term,
    {sql_list(SITES)}[event_id % 4 + 1] AS site, user_id % 4 AS batch,
    event_type <> 'error' AS success,
    CAST(CASE WHEN event_type <> 'error' THEN k ELSE 0 END AS BIGINT) AS jobs_found,
    CAST(CASE WHEN k = 0 THEN 0 ELSE floor(value * 100) END AS BIGINT) AS duration_ms,
    CASE WHEN event_type <> 'error' THEN 200 ELSE {sql_list(ERROR_STATUS)}[k % 6 + 1] END AS http_status,
    CASE WHEN event_type = 'error' THEN {_classify_sql(sql_list(ERROR_TEXTS) + "[k % 6 + 1]")} END AS error_type,
    CASE WHEN event_type = 'error' THEN substr({MASK_SQL.format(x=sql_list(ERROR_TEXTS) + "[k % 6 + 1]")}, 1, 500) END AS error_message,
    CASE WHEN event_type = 'error' THEN {sql_list(ERROR_TEXTS)}[k % 6 + 1] END AS error_raw,
    CASE WHEN event_type = 'error' THEN ['HTTPError', 'HTTPError', 'ReadTimeout', 'ConnectionError', 'HTTPError', 'ValueError'][k % 6 + 1] END AS exception_class,
    k % 7 = 0 AS challenge_detected,
    CASE WHEN k % 7 = 0 THEN (CASE k % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END) END AS challenge_solved,
    {sql_list(SELECTORS)}[1:(k % 4 + 1)] AS selectors_tried,
    CASE WHEN k % 5 <> 0 THEN {sql_list(SELECTORS)}[k % 4 + 1] END AS selector_matched
  FROM ev)"""


def clean_company_sql(x: str) -> str:
    inner = (
        f"trim(regexp_replace(regexp_replace({x}, "
        r"'(?i)\s*(LLC|Inc\.?|Corp\.?|Co\.?|Ltd\.?|L\.L\.C\.?|INC|CORP)\.?\s*$', ''), "
        r"'[^\p{L}\p{N}_\s-]', '', 'g'))"
    )
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {inner} END)"


def guess_domain_sql(x: str) -> str:
    c = clean_company_sql(x)
    return f"(CASE WHEN {c} = '' THEN '' ELSE regexp_replace(lower({c}), '\\s+', '', 'g') || '.com' END)"


def normalize_domain_sql(x: str) -> str:
    return f"ltrim(trim(lower({x})), 'w.')"


def encode_sql(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


def url_managers_sql(company: str) -> str:
    return f"{q(SEARCH_BASE)} || {encode_sql(q(PROFILE_SITE + ' \"') + ' || ' + clean_company_sql(company) + ' || ' + q('\" ' + MANAGERS_CLAUSE))}"


def url_hiring_sql(company: str) -> str:
    return f"{q(SEARCH_BASE)} || {encode_sql(q(PROFILE_SITE + ' \"') + ' || ' + clean_company_sql(company) + ' || ' + q('\" ' + HIRING_CLAUSE))}"


def clean_title_sql(t: str) -> str:
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN '' ELSE regexp_replace({t}, '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g') END)"


def url_role_sql(company: str, title: str) -> str:
    body = q(PROFILE_SITE + ' "') + " || " + clean_company_sql(company) + " || '\" \"' || " + clean_title_sql(title) + " || '\"'"
    return f"{q(SEARCH_BASE)} || {encode_sql(body)}"


def url_enduser_sql(company: str, keywords) -> str:
    body = q(PROFILE_SITE + ' "') + " || " + clean_company_sql(company) + " || " + q('" (' + keyword_clause(keywords) + ")")
    return f"{q(SEARCH_BASE)} || {encode_sql(body)}"


SUBMISSIONS = f"""submissions AS (
  SELECT o.o_orderkey AS seq, {normalize_domain_sql(guess_domain_sql('c.c_name'))} AS domain, c.c_name AS company,
    'lead_' || o.o_orderkey AS lead_id, o.o_orderdate AS submitted_at,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'https://example.com/o/' || o.o_orderkey END AS source_url
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

QUERY_LOG = """query_log AS (
  SELECT o_orderkey AS seq, ' term_' || ((o_custkey % 20) * 2) || ' ' AS query, o_orderdate AS tried_at,
    o_orderkey % 7 AS companies_found FROM orders)"""

PROGRESS = f"""progress0 AS (
  SELECT s_suppkey AS seq, 'dir' || (s_suppkey % 7) AS source, {sql_list(PROGRESS_KEYS)}[s_suppkey % 3 + 1] AS key,
    s_nationkey FROM supplier),
progress AS (
  SELECT seq, source, key,
    CASE WHEN key = 'status' THEN {sql_list(PROGRESS_STATUS)}[seq % 2 + 1]
         WHEN key = 'last_page' THEN CAST(seq % 50 AS VARCHAR) ELSE CAST(s_nationkey AS VARCHAR) END AS value
  FROM progress0)"""

CANDIDATES = f"""candidates0 AS (
  SELECT 'customer' AS kind, c_custkey AS seq, c_name AS company, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_name, 'SUPPLIER' FROM supplier),
candidates AS (
  SELECT kind, seq, company, {normalize_domain_sql(guess_domain_sql('company'))} AS domain, segment FROM candidates0)"""


# --- scorer -------------------------------------------------------------------

def scored_sql(rules: RuleSet, source: str = "postings", name: str = "scored", use_title: bool = True,
               use_company: bool = True) -> str:
    """A CTE ``name`` with the scoring columns added to ``source`` (all columns kept)."""
    t = {k: rules.tier(k) for k in (
        "tier1_tools", "tier2_strong", "tier3_cad_project", "tier4_title", "tier5_cad_design", "tier6_design_titles")}
    comp = "company" if use_company else "CAST(NULL AS VARCHAR)"
    title = "coalesce(lower(title), '')" if use_title else "''"
    blocked_name = f"(CASE WHEN {comp} IS NULL OR {comp} = '' THEN NULL ELSE {first_sql(f'lower({comp})', rules.blocklist)} END)"
    ex_cases = []
    for ex in rules.exclusions:
        area = "_h" if ex.scope == "title" else "_d"
        for p in ex.patterns:
            ex_cases.append(f"WHEN contains({area}, {q(p)}) THEN {q(ex.name)} || chr(1) || {q(ex.reason(p))}")
    ex_case = ("CASE " + " ".join(ex_cases) + " END") if ex_cases else "NULL"
    design = any_sql("_d", rules.design_indicators)

    def tier_first(key, area="_d", guard=None):
        tr = t[key]
        if tr is None:
            return "NULL"
        inner = "CASE " + " ".join(f"WHEN contains({area}, {q(p)}) THEN {q(tr.reason(p))}" for p in tr.patterns) + " END" if tr.patterns else "NULL"
        return inner if guard is None else f"(CASE WHEN {guard} THEN {inner} END)"

    t3 = t["tier3_cad_project"]
    t5 = t["tier5_cad_design"]
    t3_hit = f"(_design AND {any_sql('_d', t3.patterns_cad)} AND {any_sql('_d', t3.patterns_project)})" if t3 else "FALSE"
    t5_hit = f"(_design AND {any_sql('_d', t5.patterns_cad)})" if t5 else "FALSE"

    def wt(key):
        return float(t[key].weight) if t[key] else 0.0

    thr = rules.threshold
    stage1 = f"""{name}_a AS (
  SELECT *, lower(description) AS _d, substr(lower(description), 1, 200) AS _h, {title} AS _t FROM {source}),
{name}_b AS (
  SELECT *,
    {blocked_name} AS _blk,
    (description IS NOT NULL AND description <> '') AS _hasdesc,
    {any_sql('_t', rules.context)} AS _ctxt,
    {any_sql('_d', rules.context)} AS _ctxd,
    {ex_case} AS _ex,
    {design} AS _design
  FROM {name}_a),
{name}_c AS (
  SELECT *,
    {tier_first('tier1_tools')} AS _r1,
    {tier_first('tier2_strong', guard='_design')} AS _r2,
    {t3_hit} AS _h3,
    {tier_first('tier4_title', area='_h')} AS _r4,
    {t5_hit} AS _h5,
    {tier_first('tier6_design_titles')} AS _r6,
    (_blk IS NULL AND _hasdesc AND (_ctxt OR _ctxd) AND _ex IS NOT NULL) AS _excluded,
    (NOT _hasdesc OR NOT (_ctxt OR _ctxd)) AS _zero
  FROM {name}_b),
{name}_d AS (
  SELECT *,
    CAST(CASE WHEN _blk IS NOT NULL THEN -100.0 ELSE 0.0 END AS DOUBLE) AS company_score,
    CAST(CASE WHEN _blk IS NOT NULL OR _zero THEN 0.0 WHEN _excluded THEN -100.0 ELSE
      (CASE WHEN _r1 IS NOT NULL THEN {wt('tier1_tools')} ELSE 0 END + CASE WHEN _r2 IS NOT NULL THEN {wt('tier2_strong')} ELSE 0 END
       + CASE WHEN _h3 THEN {wt('tier3_cad_project')} ELSE 0 END + CASE WHEN _r4 IS NOT NULL THEN {wt('tier4_title')} ELSE 0 END
       + CASE WHEN _h5 THEN {wt('tier5_cad_design')} ELSE 0 END + CASE WHEN _r6 IS NOT NULL THEN {wt('tier6_design_titles')} ELSE 0 END)
    END AS DOUBLE) AS role_score
  FROM {name}_c),
{name}_e AS (
  SELECT *,
    CAST(CASE WHEN _blk IS NOT NULL THEN -100.0 ELSE role_score END AS DOUBLE) AS score,
    CASE WHEN _blk IS NOT NULL OR _excluded THEN FALSE
         ELSE (CASE WHEN _blk IS NOT NULL THEN -100.0 ELSE role_score END) >= {thr} END AS qualified,
    CAST({thr} AS DOUBLE) AS threshold,
    CASE WHEN _blk IS NOT NULL THEN 'Company ''' || {comp} || ''' in blocklist (' || _blk || ')'
         WHEN NOT _hasdesc THEN {q(REASON_NO_DESCRIPTION)}
         WHEN NOT (_ctxt OR _ctxd) THEN {q(REASON_NO_CONTEXT)}
         WHEN _excluded THEN split_part(_ex, chr(1), 2)
         ELSE concat_ws(' ; ', CASE WHEN _ctxt THEN {q(REASON_CONTEXT_TITLE)} ELSE {q(REASON_CONTEXT_DESC)} END,
              _r1, _r2, CASE WHEN _h3 THEN {q(t3.reason()) if t3 else 'NULL'} END, _r4,
              CASE WHEN _h5 THEN {q(t5.reason()) if t5 else 'NULL'} END, _r6,
              CASE WHEN _design THEN {q(REASON_DESIGN)} END)
    END AS reasons_text
  FROM {name}_d),
{name} AS (
  SELECT * EXCLUDE (_d, _h, _t, _blk, _hasdesc, _ctxt, _ctxd, _ex, _design, _r1, _r2, _h3, _r4, _h5, _r6, _excluded, _zero),
    CASE WHEN _blk IS NOT NULL THEN 'company_blocklist' WHEN NOT _hasdesc THEN 'no_description'
         WHEN NOT (_ctxt OR _ctxd) THEN 'no_context' WHEN _excluded THEN 'exclusions.' || split_part(_ex, chr(1), 1)
         WHEN qualified THEN 'qualified' ELSE 'below_threshold' END AS rule_group,
    CASE WHEN _blk IS NOT NULL OR _zero OR _excluded THEN 'unknown'
         WHEN _r1 IS NOT NULL THEN 'tier1' WHEN _r2 IS NOT NULL THEN 'tier2' WHEN _h3 THEN 'tier3'
         WHEN _r4 IS NOT NULL THEN 'tier4' WHEN _h5 THEN 'tier5' WHEN _r6 IS NOT NULL THEN 'tier6' ELSE 'unknown' END AS top_tier,
    CASE WHEN qualified THEN NULL WHEN _blk IS NOT NULL THEN 'company_blocklist'
         WHEN NOT _hasdesc OR NOT (_ctxt OR _ctxd) THEN 'no_solar_context'
         WHEN _excluded THEN {_ladder_sql("lower(split_part(_ex, chr(1), 2))")}
         ELSE 'below_threshold' END AS rejection_category
  FROM {name}_e)"""
    return stage1


def _ladder_sql(r: str) -> str:
    parts = []
    for cat, words in CATEGORY_LADDER:
        cond = any_sql(r, words)
        if cat == "exclusions.management":
            short = " OR ".join(f"contains({r}, {q(' ' + w)}) OR starts_with({r}, {q(w)})" for w in MANAGEMENT_SHORT)
            cond = f"({cond} OR {short})"
        parts.append(f"WHEN {cond} THEN {q(cat)}")
    return "CASE " + " ".join(parts) + " ELSE 'exclusions.other' END"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
