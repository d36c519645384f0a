"""Scalar Column functions (string, url, math, date).

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen. Regexes use ``(?U)`` where the rule they reproduce relies on Unicode
``\\w`` / ``\\s`` classes (Java's are ASCII by default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rule_sql import sql_any, sql_str

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- fixed values ---------------------------------------------------------
# These strings must equal the reference's for identical results.
FORMULA_PREFIXES = ("=", "+", "-", "@", "\t", "\r")
COMPANY_SUFFIX_REGEX = r"\s*(LLC|Inc\.?|Corp\.?|Co\.?|Ltd\.?|L\.L\.C\.?|INC|CORP)\.?\s*$"
CREDENTIAL_REGEX = r"(://[^:]+:)[^@]+(@)"
STATUS_CODE_REGEX = r"\b([3-5]\d{2})\b"
SEARCH_BASE = "https://www.google.com/search?q="
PROFILE_SITE = "site:linkedin.com/in/"
MANAGERS_CLAUSE = "(solar OR design OR engineering) (manager OR director OR lead)"
HIRING_CLAUSE = '(recruiter OR "talent acquisition" OR "hiring manager" OR HR OR "human resources")'
# error classes, checked in this order, first hit wins
RATE_LIMIT_WORDS = ("429", "too many requests", "rate limit", "throttl")
BLOCKED_WORDS = ("403", "forbidden", "blocked", "captcha", "cloudflare", "access denied")
TIMEOUT_WORDS = ("timeout", "timed out")
CONNECTION_WORDS = ("connection", "network", "dns", "refused")
# challenge detection from an error text: request-client and browser variants
CHALLENGE_WORDS_HTTP = ("cloudflare", "403", "captcha")
CHALLENGE_WORDS_BROWSER = ("cloudflare", "turnstile", "captcha")


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --- SQL-text builders --------------------------------------------------------
# Given a column *name*, the functions below hand Spark one SQL expression (one
# driver call) instead of a tree of Column calls; given a Column they build the
# same expression with the Column API.

def clean_company_sql(x: str) -> str:
    no_suffix = f"regexp_replace({x}, {sql_str('(?iU)' + COMPANY_SUFFIX_REGEX)}, '')"
    kept = f"regexp_replace({no_suffix}, {sql_str(r'(?U)[^\w\s-]')}, '')"
    stripped = f"regexp_replace({kept}, {sql_str(r'(?U)^\s+|\s+$')}, '')"
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {stripped} END)"


def guess_domain_sql(x: str) -> str:
    clean = clean_company_sql(x)
    return f"(CASE WHEN {clean} = '' THEN '' ELSE concat(regexp_replace(lower({clean}), {sql_str(r'(?U)\s+')}, ''), '.com') END)"


def normalize_domain_sql(x: str) -> str:
    return f"ltrim('w.', regexp_replace(lower({x}), {sql_str(r'(?U)^\s+|\s+$')}, ''))"


def percent_encode_sql(x: str) -> str:
    return f"replace(replace(replace(replace(url_encode({x}), '+', '%20'), '%2F', '/'), '%7E', '~'), '*', '%2A')"


def clean_title_sql(t: str) -> str:
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN '' ELSE regexp_replace({t}, {sql_str(r'(?U)[^\w\s-]')}, '') END)"


def profile_search_sql(*parts: str) -> str:
    return f"concat({sql_str(SEARCH_BASE)}, {percent_encode_sql('concat(' + ', '.join(parts) + ')')})"


def classify_error_sql(m: str, k: str = "''") -> str:
    lm, lk = f"lower(coalesce({m}, ''))", f"lower(coalesce({k}, ''))"
    return (
        f"CASE WHEN {sql_any(lm, RATE_LIMIT_WORDS)} THEN 'rate_limit' "
        f"WHEN {sql_any(lm, BLOCKED_WORDS)} THEN 'blocked' "
        f"WHEN {sql_any(lm, TIMEOUT_WORDS)} OR contains({lk}, 'timeout') THEN 'timeout' "
        f"WHEN {sql_any(lm, CONNECTION_WORDS)} OR contains({lk}, 'connection') THEN 'connection' ELSE 'unknown' END"
    )


def mask_credentials_sql(x: str) -> str:
    return f"regexp_replace({x}, {sql_str(CREDENTIAL_REGEX)}, '$1****$2')"


def contains_any(text: ColumnOrName, patterns) -> Column:
    """True when any pattern is a substring of ``text`` (NULL text -> false)."""
    t = _c(text)
    pats = list(patterns)
    if not pats:
        return F.lit(False)
    expr = None
    for p in pats:
        hit = t.contains(F.lit(p))
        expr = hit if expr is None else (expr | hit)
    return F.coalesce(expr, F.lit(False))


def first_index(text: ColumnOrName, patterns) -> Column:
    """1-based index of the first pattern, in list order, found in ``text``; NULL if none.

    A CASE chain: evaluation stops at the first hit, the order is the list
    order (not the text order), and it stays inside generated code.
    """
    t = _c(text)
    pats = list(patterns)
    if not pats:
        return F.lit(None).cast("int")
    expr = F.when(t.contains(F.lit(pats[0])), F.lit(1))
    for i, p in enumerate(pats[1:], start=2):
        expr = expr.when(t.contains(F.lit(p)), F.lit(i))
    return expr


def first_pattern(text: ColumnOrName, patterns) -> Column:
    """The first pattern in list order that ``text`` contains, or NULL."""
    pats = list(patterns)
    if not pats:
        return F.lit(None).cast("string")
    idx = first_index(text, pats)
    # guarded: element_at with a NULL index is not reliably NULL under codegen
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(p) for p in pats]), idx))


def py_strip(c: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode whitespace (``trim`` only strips blanks)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def mask_credentials(c: ColumnOrName) -> Column:
    """B1: ``scheme://user:pw@host`` -> ``scheme://user:****@host``, every match."""
    if isinstance(c, str):
        return F.expr(mask_credentials_sql(_ident(c)))
    return F.regexp_replace(_c(c), CREDENTIAL_REGEX, "$1****$2")


def sanitize_cell(c: ColumnOrName) -> Column:
    """B2: prefix a quote when a value starts with a spreadsheet formula character."""
    col = _c(c)
    return F.when(F.substring(col, 1, 1).isin(*FORMULA_PREFIXES), F.concat(F.lit("'"), col)).otherwise(col)


def truncate_text(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_c(c), 1, n)


def clean_company(c: ColumnOrName) -> Column:
    """Drop one trailing legal suffix, then all but word chars, blanks, '-'; strip.

    NULL and '' give ''. The suffix pattern allows zero blanks before the
    suffix, so a name ending in 'co' loses it (kept on purpose).
    """
    if isinstance(c, str):
        return F.expr(clean_company_sql(_ident(c)))
    col = _c(c)
    no_suffix = F.regexp_replace(col, "(?iU)" + COMPANY_SUFFIX_REGEX, "")
    kept = F.regexp_replace(no_suffix, r"(?U)[^\w\s-]", "")
    return F.when(col.isNull() | (col == ""), F.lit("")).otherwise(py_strip(kept))


def guess_domain(c: ColumnOrName) -> Column:
    """Cleaned name, lower case, blanks removed, '.com' appended; '' stays ''."""
    if isinstance(c, str):
        return F.expr(guess_domain_sql(_ident(c)))
    clean = clean_company(c)
    return F.when(clean == "", F.lit("")).otherwise(
        F.concat(F.regexp_replace(F.lower(clean), r"(?U)\s+", ""), F.lit(".com"))
    )


def normalize_domain(c: ColumnOrName) -> Column:
    """Lower, strip, then strip any leading run of the characters 'w' and '.'."""
    if isinstance(c, str):
        return F.expr(normalize_domain_sql(_ident(c)))
    return F.ltrim(py_strip(F.lower(_c(c))), F.lit("w."))


def percent_encode(c: ColumnOrName) -> Column:
    """Percent-encode like a default URL quote: keeps ``/`` and ``~``, blank -> %20, ``*`` -> %2A."""
    e = F.url_encode(_c(c))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def _profile_search(*parts: Column) -> Column:
    return F.concat(F.lit(SEARCH_BASE), percent_encode(F.concat(*parts)))


def search_url_managers(company: ColumnOrName) -> Column:
    """B8."""
    if isinstance(company, str):
        return F.expr(profile_search_sql(sql_str(PROFILE_SITE + ' "'), clean_company_sql(_ident(company)), sql_str('" ' + MANAGERS_CLAUSE)))
    return _profile_search(F.lit(PROFILE_SITE + ' "'), clean_company(company), F.lit('" ' + MANAGERS_CLAUSE))


def clean_title(title: ColumnOrName) -> Column:
    """Title with special characters removed (not stripped); '' when missing."""
    t = _c(title)
    return F.when(t.isNull() | (t == ""), F.lit("")).otherwise(F.regexp_replace(t, r"(?U)[^\w\s-]", ""))


def search_url_role(company: ColumnOrName, title: ColumnOrName) -> Column:
    """B9."""
    if isinstance(company, str) and isinstance(title, str):
        return F.expr(profile_search_sql(sql_str(PROFILE_SITE + ' "'), clean_company_sql(_ident(company)), sql_str('" "'),
                                         clean_title_sql(_ident(title)), sql_str('"')))
    return _profile_search(
        F.lit(PROFILE_SITE + ' "'), clean_company(company), F.lit('" "'), clean_title(title), F.lit('"')
    )


def search_url_hiring(company: ColumnOrName) -> Column:
    """B10."""
    if isinstance(company, str):
        return F.expr(profile_search_sql(sql_str(PROFILE_SITE + ' "'), clean_company_sql(_ident(company)), sql_str('" ' + HIRING_CLAUSE)))
    return _profile_search(F.lit(PROFILE_SITE + ' "'), clean_company(company), F.lit('" ' + HIRING_CLAUSE))


def keyword_clause(keywords) -> str:
    """B11 helper: multi-word keywords quoted, first 10, joined with ' OR '."""
    terms = [f'"{k}"' if " " in k else k for k in keywords]
    return " OR ".join(terms[:10])


def search_url_enduser(company: ColumnOrName, keywords) -> Column:
    """Profile search with the template keywords of a rule set."""
    if isinstance(company, str):
        return F.expr(profile_search_sql(sql_str(PROFILE_SITE + ' "'), clean_company_sql(_ident(company)),
                                         sql_str('" (' + keyword_clause(keywords) + ")")))
    return _profile_search(
        F.lit(PROFILE_SITE + ' "'), clean_company(company), F.lit('" (' + keyword_clause(keywords) + ")")
    )


def classify_error(message: ColumnOrName, exception_class: ColumnOrName | None = None) -> Column:
    """rate_limit / blocked / timeout / connection / unknown, first rule wins."""
    if isinstance(message, str) and (exception_class is None or isinstance(exception_class, str)):
        return F.expr(classify_error_sql(_ident(message), _ident(exception_class) if exception_class else "''"))
    m = F.lower(F.coalesce(_c(message), F.lit("")))
    k = F.lower(F.coalesce(_c(exception_class), F.lit(""))) if exception_class is not None else F.lit("")
    return (
        F.when(contains_any(m, RATE_LIMIT_WORDS), F.lit("rate_limit"))
        .when(contains_any(m, BLOCKED_WORDS), F.lit("blocked"))
        .when(contains_any(m, TIMEOUT_WORDS) | k.contains("timeout"), F.lit("timeout"))
        .when(contains_any(m, CONNECTION_WORDS) | k.contains("connection"), F.lit("connection"))
        .otherwise(F.lit("unknown"))
    )


def error_status_code(message: ColumnOrName, status: ColumnOrName | None = None) -> Column:
    """Explicit status if present, else the first 3xx-5xx number in the text."""
    found = F.regexp_extract(_c(message), "(?U)" + STATUS_CODE_REGEX, 1)
    parsed = F.when(found != "", found.cast("int"))
    return parsed if status is None else F.coalesce(_c(status).cast("int"), parsed)


def error_context(exception_class: ColumnOrName, message: ColumnOrName, status: ColumnOrName | None = None) -> Column:
    """Exception class and status code of an error; a missing class is NULL."""
    return F.struct(F.nullif(_c(exception_class), F.lit("")).alias("exception_class"), error_status_code(message, status).alias("status_code"))


def challenge_flag(message: ColumnOrName, browser: bool = False) -> Column:
    """Challenge seen in an error text (two word lists)."""
    words = CHALLENGE_WORDS_BROWSER if browser else CHALLENGE_WORDS_HTTP
    return contains_any(F.lower(_c(message)), words)


def confidence_score(score: ColumnOrName, qualified: ColumnOrName) -> Column:
    """min(100, score) for qualified rows, else NULL."""
    return F.when(_c(qualified), F.least(F.lit(100.0), _c(score).cast("double")))


def rate_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 1) -> Column:
    """round(num / den * 100, digits), 0.0 when den is 0."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, F.round(n.cast("double") / d * 100.0, digits)).otherwise(F.lit(0.0))


def absolute_url(url: ColumnOrName, base: str, slash_only: bool = False) -> Column:
    """Prefix ``base`` to a relative link.

    ``slash_only`` selects the second variant: only links starting with '/'
    are prefixed, anything else is kept as it is.
    """
    u = _c(url)
    if slash_only:
        return F.when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(u)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base), u))


def job_id_from_url(url: ColumnOrName) -> Column:
    """Digits of ``/jobs/<digits>/``; '' when absent."""
    return F.regexp_extract(_c(url), r"/jobs/(\d+)/", 1)


def url_from_card_id(link: ColumnOrName, card_id: ColumnOrName, prefix: str, base: str) -> Column:
    """The link, or a URL built from an element id that carries ``prefix``."""
    l, i = _c(link), _c(card_id)
    built = F.when(i.startswith(prefix), F.concat(F.lit(base), F.substring(i, len(prefix) + 1, 1 << 30)))
    return F.coalesce(F.nullif(l, F.lit("")), built)


def clean_location(c: ColumnOrName) -> Column:
    """Cut at '...' and strip."""
    return py_strip(F.substring_index(_c(c), "...", 1))


CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"


def py_title(c: ColumnOrName) -> Column:
    """Python's ``str.title()``: a letter after any uncased character is upper-cased,
    every other letter lower-cased (``full-time`` -> ``Full-Time``, ``1st`` -> ``1St``).
    ``initcap`` only capitalises after blanks. The sharp s title-cases to ``Ss``."""
    col = _c(c)
    chars = F.split(col, "")

    def one(ch, i):
        prev = F.element_at(chars, F.greatest(i, F.lit(1)))  # 1-based: the character before 0-based i
        up = F.when(ch == "\u00df", F.lit("Ss")).otherwise(F.upper(ch))
        return F.when((i == 0) | ~prev.rlike(CASED), up).otherwise(F.lower(ch))

    return F.when(col.isNotNull(), F.array_join(F.transform(chars, one), ""))


def employment_type(c: ColumnOrName) -> Column:
    """B22: '_' -> blank, then title case like Python's ``str.title()``."""
    return py_title(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def salary_text(c: ColumnOrName) -> Column:
    """Keep a salary only when it carries '$'."""
    s = _c(c)
    return F.when(s.contains("$"), s)


def day_bucket(ts: ColumnOrName) -> Column:
    """Yyyy-MM-dd of a timestamp (the first 10 characters of its ISO form)."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def ts_string(ts: ColumnOrName) -> Column:
    """Timestamps leave the engine as 'yyyy-MM-dd HH:mm:ss' strings."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def run_stamp(run_date: str) -> Column:
    """The run date is a parameter, never the clock inside a query."""
    return F.lit(run_date)


def rejected_id(rn: ColumnOrName, company: ColumnOrName) -> Column:
    """``rejected_{n:03d}_{company[:20]}``; a missing company prints as 'None'."""
    return F.format_string("rejected_%03d_%s", _c(rn), F.substring(F.coalesce(_c(company), F.lit("None")), 1, 20))


def text_length_gate(c: ColumnOrName, n: int) -> Column:
    """Keep a text only when it is longer than ``n`` characters."""
    t = _c(c)
    return F.when(F.length(t) > n, t)
