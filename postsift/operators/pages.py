"""Extraction from stored raw pages (H1-H8, F3, F4, F8) as regex column jobs.

Input: ``pages(page_id, url, html)``. Live fetching is not part of the
engine; the data part of the reference's page parsers runs here per row with
built-in regex functions, and the one-row-per-link step is an ``explode``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .ordering import first_per_key

# --- fixed values ---------------------------------------------------------
# link texts containing any of these are navigation, not postings
NAVIGATION_WORDS = ("search", "filter", "sort", "page", "next", "prev")
FALLBACK_LINK_CAP = 50
MIN_LINK_TEXT = 5
DESCRIPTION_CHARS = 5000
MIN_MAIN_TEXT = 100
BASE_URL = "https://jobs.example.com"

HREF = r'href="([^"]+)"'
ANCHOR = r'<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>'
JOB_LINK = "/jobs?/"
# a card's link: target and what it encloses; the target's id
CARD_LINK = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
JOB_ID_LINK = r"/jobs/(\d+)/"
# scripts, styles and comments with what they hold, then any tag: whatever begins first
MARKUP = r"(?s)<(?i:script)[^>]*>.*?</(?i:script)>|<(?i:style)[^>]*>.*?</(?i:style)>|<!--.*?-->|<[^>]+>"
LD_BLOCK = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
# Named entities (fixed values); numeric ones are decoded by their code. A no-break space counts as a blank.
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•", "hellip": "…",
    "middot": "·", "copy": "©", "reg": "®", "trade": "™", "deg": "°", "euro": "€", "pound": "£",
    "aacute": "á", "agrave": "à", "acirc": "â", "auml": "ä", "aring": "å", "ccedil": "ç",
    "eacute": "é", "egrave": "è", "ecirc": "ê", "euml": "ë", "iacute": "í", "icirc": "î", "iuml": "ï",
    "ntilde": "ñ", "oacute": "ó", "ocirc": "ô", "ouml": "ö", "uacute": "ú", "ugrave": "ù", "uuml": "ü",
    "szlig": "ß", "Auml": "Ä", "Eacute": "É", "Ouml": "Ö", "Uuml": "Ü",
}


def decode_entities(text):
    """Named and numeric entities decoded once, from left to right; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def char(code):
        c = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code == 160, " ").when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), c)

    def piece(p, i):
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8});", 1)
        number = F.when(name.rlike("^#[0-9]"), F.substring(name, 2, 8).try_cast("bigint")).when(
            name.startswith("#"), F.conv(F.substring(name, 3, 8), 16, 10).try_cast("bigint"))
        decoded = F.when(name.startswith("#"), char(number)).otherwise(F.try_element_at(names, name))
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(decoded, F.substring(p, F.length(name) + 2, F.length(p))), F.concat(F.lit("&"), p)))

    def decoded_once(t):
        return F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&", -1), piece), "")).otherwise(t)

    # bound by a lambda, so a costly ``text`` is computed once however often it is used
    return F.get(F.transform(F.array(text), decoded_once), F.lit(0))


def html_to_text(html, limit: int | None = DESCRIPTION_CHARS):
    """H4: drop scripts, styles, comments and tags, decode entities, collapse blanks, cut."""
    h = F.regexp_replace(html, MARKUP, " ")
    h = decode_entities(h)
    h = F.trim(F.regexp_replace(h, r"\s+", " "))
    return F.substring(h, 1, limit) if limit else h


def page_links(pages: DataFrame, cap: int | None = None) -> DataFrame:
    """H1 + F4 + F8: every href of a page, one row each, first occurrence per (page, url) kept,
    at most ``cap`` of them in page order; absolute URL (B18) and job id (B19).

    Distinctness and cap concern one row's array, so nothing is shuffled.
    """
    urls = F.array_distinct("__all")
    kept = urls if cap is None else F.slice(urls, 1, cap)
    links = pages.select("page_id", F.regexp_extract_all("html", F.lit(HREF), 1).alias("__all")).select(
        "page_id", F.explode(F.transform(kept, lambda u: F.struct((F.array_position("__all", u) - 1).cast("int").alias("pos"), u.alias("url")))).alias("__l"))
    return links.select(
        "page_id", "__l.pos", "__l.url",
        tx.absolute_url("__l.url", BASE_URL).alias("abs_url"),
        tx.job_id_from_url(tx.absolute_url("__l.url", BASE_URL)).alias("job_id"),
    )


def links_per_page(pages: DataFrame) -> DataFrame:
    """distinct and all hrefs of each page that has any."""
    hrefs = F.regexp_extract_all("html", F.lit(HREF), 1)
    n = pages.select("page_id", F.size(F.array_distinct(hrefs)).cast("bigint").alias("distinct_links"), F.size(hrefs).cast("bigint").alias("all_links"))
    return n.filter(F.col("all_links") > 0)


def _parts(fragment):
    """Tags -> '|', split, strip each part, drop empty ones (text with a separator)."""
    pieces = F.split(F.regexp_replace(fragment, r"<[^>]+>", "|"), r"\|")
    return F.filter(F.transform(pieces, lambda p: tx.py_strip(p)), lambda p: p != "")


def cards(pages: DataFrame, tag: str = "article", link: str | None = None) -> DataFrame:
    """H2: every card of a page, one row each: ``page_id, card, html, parts, target, job_id``, in page order.

    A card is an element ``tag`` with any attributes (cards are not nested).
    ``link`` is a pattern for the target of a card's own link whose first group is
    the posting's id: cards without such a link are dropped, and of cards of a
    page with the same target the first stays. Without ``link`` cards need none.
    """
    found = F.regexp_extract_all("html", F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))
    rows = pages.withColumn("__cards", found).select(*pages.columns, F.posexplode("__cards").alias("card", "__card"))
    rows = rows.drop("html").withColumnRenamed("__card", "html").withColumn("parts", _parts(F.col("html")))
    if link is None:
        return rows.withColumn("target", F.lit(None).cast("string")).withColumn("job_id", F.lit(None).cast("string")).withColumn("title", F.get("parts", F.lit(0)))
    targets, texts = (F.regexp_extract_all("html", F.lit(CARD_LINK), F.lit(k)) for k in (1, 2))
    links = F.filter(F.arrays_zip(targets.alias("target"), texts.alias("text")), lambda x: x["target"].rlike(link))
    rows = rows.withColumn("__link", F.get(links, F.lit(0))).where("__link IS NOT NULL")
    rows = rows.select(*rows.columns[:-1], F.col("__link.target").alias("target"), F.regexp_extract("__link.target", link, 1).alias("job_id"),
                       tx.py_strip(F.regexp_replace("__link.text", "<[^>]+>", "")).alias("title"))
    rows = rows.where("job_id <> ''")
    first = Window.partitionBy("page_id", "target").orderBy("card")
    return rows.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def _card_fields(rows: DataFrame) -> DataFrame:
    loc = F.get("parts", F.lit(2))
    return rows.withColumns({
        "company": F.coalesce(F.get("parts", F.lit(1)), F.lit("")),
        "location": F.coalesce(F.when(loc.contains("..."), tx.clean_location(loc)).otherwise(loc), F.lit("")),
    }).where("title IS NOT NULL AND title <> ''")


def listing_fields(pages: DataFrame, tag: str = "article", link: str | None = None) -> DataFrame:
    """H2: title, company and location of every card of a page; cards without a title, or without an id where ``link`` asks for one, are dropped.

    The title is the text of the card's own link, without ``link`` the card's first text.
    """
    out = _card_fields(cards(pages.select("page_id", "html"), tag, link))
    return out.select("page_id", F.col("card").cast("bigint").alias("card"), "title", "company", "location",
                      *([] if link is None else ["job_id", tx.absolute_url("target", BASE_URL).alias("job_url")]))


def _posting_of(block: Column) -> Column:
    """The posting of a JSON-LD text as a VARIANT: of its objects (itself, the elements of a list, of a ``@graph``) the
    first of type JobPosting, else the first with a description; NULL for malformed text."""
    def objects(v: Column) -> Column:
        listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
        graph = F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array().cast("array<variant>"))
        return F.concat(listed, graph)

    def rank(v: Column) -> Column:
        kind = F.coalesce(F.try_variant_get(v, "$['@type']", "string"), F.try_variant_get(v, "$['@type'][0]", "string"))
        return F.when(kind == "JobPosting", 0).when(F.try_variant_get(v, "$.description", "string").isNotNull(), 1).otherwise(2)

    def best(found: Column) -> Column:
        ranks = F.transform(found, rank)
        return F.get(found, (F.array_position(ranks, F.array_min(ranks)) - 1).cast("int"))

    # bound by lambdas, so a block is parsed once
    return F.get(F.transform(F.array(F.try_parse_json(block)), lambda v: best(objects(v))), F.lit(0))


def _ld_text(v: str, path: str) -> Column:
    """A text field of a VARIANT; numbers count as their digits, lists and objects are no text."""
    value = F.try_variant_get(v, path, "string")
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")).rlike("^(ARRAY|OBJECT)"), F.lit(None)).otherwise(value)


def json_ld_fields(docs: DataFrame, json_col: str = "json_ld") -> DataFrame:
    """H3: fields of a JSON-LD block with type guards.

    The block may be an object, a list or a ``@graph``. A field of another type
    than text (a number for the salary's object, a list of employment types) is
    NULL and leaves the others alone; malformed JSON yields NULL fields, not a failure.
    """
    d = docs.select("seq", _posting_of(F.col(json_col)).alias("__v"))
    d = d.select("seq", *[_ld_text("__v", p).alias(n) for n, p in (
        ("__d", "$.description"), ("__s", "$.baseSalary.value.value"), ("__e", "$.employmentType"), ("__p", "$.datePosted"))])
    return d.select(
        "seq",
        F.when(F.length("__d") > 0, html_to_text(F.col("__d"))).alias("description"),
        tx.salary_text(F.col("__s")).alias("salary"),
        F.when(F.length("__e") > 0, tx.employment_type(F.col("__e"))).alias("employment_type"),
        F.when(F.length("__p") > 0, F.col("__p")).alias("date_posted"),
    )


def _page_ld(html: str = "html") -> Column:
    """The posting of a page's JSON-LD blocks: the first block that holds a description, else NULL."""
    found = F.transform(F.regexp_extract_all(html, F.lit(LD_BLOCK), F.lit(1)), lambda b: F.try_variant_get(_posting_of(b), "$.description", "string"))
    return F.get(F.filter(found, lambda x: x != ""), F.lit(0))


def page_json_ld(pages: DataFrame) -> DataFrame:
    """H3 over whole pages: the fields of every JSON-LD block, ``page_id, block`` and the fields."""
    blocks = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(LD_BLOCK), F.lit(1))).alias("block", "json_ld"))
    fields = json_ld_fields(blocks.withColumn("seq", F.struct("page_id", "block")))
    return fields.select("seq.page_id", F.col("seq.block").cast("bigint").alias("block"), *[c for c in fields.columns if c != "seq"])


_SELECTOR = re.compile(r"""([A-Za-z][\w-]*)?((?:[.#][\w-]+|\[[\w-]+(?:[*^$]?=(?:"[^"]*"|'[^']*'|[\w-]+))?\])*)""")
_SELECTOR_PART = re.compile(r"""([.#])([\w-]+)|\[([\w-]+)(?:([*^$]?=)(?:"([^"]*)"|'([^']*)'|([\w-]+)))?\]""")


def selector_regex(selector: str) -> str:
    """A pattern for the opening tags that a selector names; group 1 is the tag.

    A selector is a tag, then any of ``.class``, ``#id``, ``[attr]``, ``[attr="v"]``,
    ``[attr*="v"]``, ``[attr^="v"]``, ``[attr$="v"]``; all must hold, in any order of the attributes.
    """
    whole = _SELECTOR.fullmatch(selector)
    if not whole or not selector:
        raise ValueError(f"not a selector: {selector!r}")
    tests = ""
    for sign, name, attr, op, *values in _SELECTOR_PART.findall(whole[2]):
        attr, op = ("class", "~=") if sign == "." else ("id", "=") if sign == "#" else (attr, op)
        v = re.escape(name or "".join(values))
        body = {"~=": r"(?:[^{q}]*\s)?" + v + r"(?:\s[^{q}]*)?", "=": v, "*=": "[^{q}]*" + v + "[^{q}]*", "^=": v + "[^{q}]*", "$=": "[^{q}]*" + v}.get(op)
        valued = "" if body is None else r"\s*=\s*(?:" + "|".join(q + body.replace("{q}", q) + q for q in "\"'") + ")"
        tests += rf"(?=[^>]*\s(?i:{re.escape(attr)}){valued}" + (r"(?=[\s=>/])" if body is None else "") + ")"
    tag = f"(?i:{re.escape(whole[1])})" if whole[1] else r"[A-Za-z][\w-]*"
    return rf"<({tag})(?=[\s>/]){tests}[^>]*>"


def _without_code(html: str) -> Column:
    """Pages without what is no element: scripts, styles, comments."""
    return F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")


def first_selector(pages: DataFrame, selectors: list[str] | tuple[str, ...]) -> DataFrame:
    """H5: the first selector, in their order, that any element of the page matches, and how many do; NULL and 0 if none does."""
    page = pages.select("page_id", F.inline(F.array(F.struct(_without_code("html").alias("html")))))
    matched = F.coalesce(*[F.when(F.regexp_like("html", F.lit(selector_regex(s))), F.lit(s)) for s in selectors])
    page = page.select("page_id", "html", matched.alias("selector_matched"))
    count = F.lit(0)
    for s in selectors:
        count = F.when(F.col("selector_matched") == s, F.regexp_count("html", F.lit(selector_regex(s)))).otherwise(count)
    return page.select("page_id", "selector_matched", count.cast("bigint").alias("n_matched"))


def selector_fallback(pages: DataFrame, selectors: list[str] | tuple[str, ...] = ("h1", "title"), out: str = "heading") -> DataFrame:
    """H5: the text of the first selector, in their order, whose first element has any, and which one that was.

    An element ends at the first closing tag of its name.
    """
    page = pages.select("page_id", F.inline(F.array(F.struct(_without_code("html").alias("html")))))
    texts = [tx.py_strip(F.regexp_extract("html", r"(?s)" + selector_regex(s) + r"(.*?)</\1\s*>", 2)) for s in selectors]
    found = F.filter(F.array(*[F.struct(t.alias("text"), F.lit(s).alias("selector")) for t, s in zip(texts, selectors)]), lambda x: x["text"] != "")
    page = page.select("page_id", F.get(found, F.lit(0)).alias("__f"))
    return page.select("page_id", F.col("__f.text").alias(out), F.col("__f.selector").alias("selector_matched"))


def description_fallback(pages: DataFrame, main: str = "article") -> DataFrame:
    """H6: JSON-LD description first, else the main container (a selector) text when over 100 characters, else ''."""
    body = F.regexp_extract("html", r"(?s)" + selector_regex(main) + r"(.*?)</\1\s*>", 2)
    texts = pages.select("page_id", _page_ld().alias("ld"), body.alias("main"))
    return texts.select("page_id", _description(F.col("ld"), F.col("main")).alias("description"))


def _description(ld: Column, main: Column) -> Column:
    def gated(t: Column) -> Column:
        return F.coalesce(tx.text_length_gate(t, MIN_MAIN_TEXT), F.lit(""))

    own = F.when(F.length(ld) > 0, html_to_text(ld)).otherwise("")
    # the main text is turned into text only where the block gave none
    return F.get(F.transform(F.array(own), lambda d: F.when(d != "", d).otherwise(F.get(F.transform(F.array(html_to_text(main)), gated), F.lit(0)))), F.lit(0))


def fallback_links(pages: DataFrame, has_cards: DataFrame, job_link: str = JOB_LINK, cap: int = FALLBACK_LINK_CAP) -> DataFrame:
    """H7: for pages without cards, of the first ``cap`` links whose target matches ``job_link``
    the texts longer than 5 characters that are not navigation, distinct per page.

    The job links are selected before the cap, so menu links do not use it up.
    """
    no_cards = pages.join(has_cards.select("page_id"), "page_id", "left_anti")
    targets, texts = (F.regexp_extract_all("html", F.lit(ANCHOR), k) for k in (1, 2))
    links = no_cards.select("page_id", F.arrays_zip(targets.alias("target"), texts.alias("text")).alias("__all"))
    job = F.slice(F.filter(F.transform("__all", lambda x, i: F.struct(i.alias("pos"), x["target"].alias("target"), tx.py_strip(x["text"]).alias("title"))),
                           lambda x: x["target"].rlike(job_link)), 1, cap)
    named = F.filter(job, lambda x: (F.length(x["title"]) > MIN_LINK_TEXT) & ~tx.contains_any(F.lower(x["title"]), NAVIGATION_WORDS))
    titles = F.transform("__named", lambda x: x["title"])
    first = F.filter("__named", lambda x, i: F.array_position(titles, x["title"]) == i + 1)
    return links.select("page_id", named.alias("__named")).select("page_id", F.explode(first).alias("__l")).select("page_id", "__l.title", "__l.pos")


def pages_to_postings(pages: DataFrame, tag: str = "article", link: str | None = None) -> DataFrame:
    """A10: stored raw pages -> one posting row per card (``cards``), ``seq`` the page, ``card`` its place in it.

    Title, company and location come from the card; the link is the card's own
    where ``link`` asks for one, else the page. A page of one card is a posting's
    own page, so its description may come from the page's JSON-LD (H6); of
    several cards each has its own text.
    """
    one = F.size(F.regexp_extract_all("html", F.lit(rf"(?is)<{tag}[\s>]"), F.lit(0))) == 1
    p = pages.select("page_id", "url", "html", F.when(one, _page_ld()).alias("__ld"))
    out = _card_fields(cards(p, tag, link))
    return out.select(
        F.col("page_id").alias("seq"),
        F.col("card").cast("bigint").alias("card"),
        "title", "company", "location",
        F.coalesce(tx.absolute_url("target", BASE_URL), F.col("url")).alias("job_url"),
        _description(F.col("__ld"), F.col("html")).alias("description"),
        *([] if link is None else ["job_id"]),
    )


def valid_postings(postings: DataFrame) -> DataFrame:
    """H8: keep rows with a title and a company."""
    ok = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return postings.filter(ok("title") & ok("company"))


def first_per_job_id(rows: DataFrame, id_col: str = "job_id", order_col: str = "seq") -> DataFrame:
    """first arrival wins per job id over all searches."""
    return first_per_key(rows.filter(F.col(id_col) != ""), [id_col], order_col)
