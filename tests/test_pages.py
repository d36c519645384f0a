"""Pages: several cards, selectors, JSON-LD of any shape, fallbacks."""

import json

import pytest
from pyspark.sql import functions as F

from postsift.operators import pages as pg

PAGE = "page_id long, url string, html string"
CARDS = """<html><body><script>var x = "<article>no</article>";</script>
<ARTICLE class="card one"><div class="card-title"><a class=x href="/jobs/12/a">  Lead <b>Designer</b> </a></div><p>Acme</p><p>Tempe, AZ ... more</p></ARTICLE>
<article id='job-card-7'><a href="/menu">menu</a><a href="https://o.example/jobs/34/b">Drafter</a><span>Beta</span></article>
<article><a href="/jobs/12/a">Lead again</a></article>
<article><a href="/jobs/56/c"> </a><p>No title</p></article>
<article><p>No link</p><p>Gamma</p></article>
<articles>not a card</articles></body></html>"""


def frame(spark, *htmls):
    return spark.createDataFrame([(k, f"https://p.example/{k}", h) for k, h in enumerate(htmls, 1)], PAGE)


def test_every_card_with_its_own_link(spark):
    rows = pg.listing_fields(frame(spark, CARDS, "", None, "<p>none</p>"), link=pg.JOB_ID_LINK).orderBy("page_id", "card").collect()
    assert [(r["page_id"], r["card"], r["job_id"], r["title"], r["company"], r["location"], r["job_url"]) for r in rows] == [
        (1, 1, "12", "Lead Designer", "Designer", "Acme", pg.BASE_URL + "/jobs/12/a"),
        (1, 2, "34", "Drafter", "Drafter", "Beta", "https://o.example/jobs/34/b")]


def test_cards_without_links_are_taken_by_their_texts(spark):
    page = '<article><h2>A</h2><i>B</i><i>C ... D</i></article><article data-x="1"><h2>E</h2></article><article> <br> </article>'
    rows = pg.listing_fields(frame(spark, page)).orderBy("card").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "A", "B", "C"), (1, 1, "E", "", "")]


def test_postings_of_a_result_page_and_of_a_posting_page(spark):
    long = "word " * 40
    ld = '<script type="application/ld+json">{"@type": "JobPosting", "description": "<p>from &amp; the block</p>"}</script>'
    one = f'{ld}<article class="x"><h1>Title</h1><p>{long}</p></article>'
    two = f'{ld}<article><a href="/jobs/1/x">T1</a><p>{long}</p></article><article><a href="/jobs/2/y">T2</a><p>short</p></article>'
    rows = pg.pages_to_postings(frame(spark, one, two)).orderBy("seq", "card").collect()
    assert [(r["seq"], r["card"], r["title"], r["job_url"]) for r in rows] == [(1, 0, "Title", "https://p.example/1"), (2, 0, "T1", "https://p.example/2"), (2, 1, "T2", "https://p.example/2")]
    assert [r["description"] for r in rows] == ["from & the block", "T1 " + long.strip(), ""]
    linked = pg.pages_to_postings(frame(spark, two), link=pg.JOB_ID_LINK).orderBy("card").collect()
    assert [(r["job_id"], r["job_url"]) for r in linked] == [("1", pg.BASE_URL + "/jobs/1/x"), ("2", pg.BASE_URL + "/jobs/2/y")]


SELECTED = """<!-- <li class="job_result"> --><ul><li class="a job_result b">x</li><li class='job_results'>y</li></ul>
<div data-k="v" role="listitem">z</div><div class="BigJobCard">q</div><article id="job-card-9">w</article><custom-tag title="a>b"/>"""


@pytest.mark.parametrize("selector,count", [
    ("li", 2), ("LI", 2), ("li.job_result", 1), (".job_result", 1), (".job_results", 1), ("li[class*='job']", 2), ('li[class*="job"]', 2), ('div[role="listitem"]', 1),
    ("div[role=list]", 0), ('article[id^="job-card-"]', 1), ('[id$="-9"]', 1), ("#job-card-9", 1), ("div[data-k]", 1), ("div[data]", 0), ('div[class*="JobCard"]', 1),
    ("div.BigJobCard", 1), ("ul", 1), ("p", 0), ("li.a.b", 1), ("li.a.c", 0), ("custom-tag", 1), ("[role]", 1)])
def test_selectors(spark, selector, count):
    row = pg.first_selector(frame(spark, SELECTED), [selector]).first()
    assert (row["selector_matched"], row["n_matched"]) == ((selector, count) if count else (None, 0))


def test_the_first_selector_in_order_wins(spark):
    df = frame(spark, SELECTED, "<p>x</p>", "", None)
    rows = pg.first_selector(df, ["li.none", "#job-card-9", "li", "p"]).orderBy("page_id").collect()
    assert [(r["selector_matched"], r["n_matched"]) for r in rows] == [("#job-card-9", 1), ("p", 1), (None, 0), (None, 0)]
    for bad in ("", "ul li", "li:first", "li["):
        with pytest.raises(ValueError, match="not a selector"):
            pg.selector_regex(bad)


def test_text_of_the_first_selector_with_any(spark):
    df = frame(spark, "<title>T</title><h1 class='x'> </h1><div class='hd main'>D</div>", "<h1>H</h1><title>T</title>", "<b>no</b>")
    rows = pg.selector_fallback(df, ["h1", ".hd", "title"], "heading").orderBy("page_id").collect()
    assert [tuple(r) for r in rows] == [(1, "D", ".hd"), (2, "H", "h1"), (3, None, None)]


def fields(spark, *blocks):
    rows = pg.json_ld_fields(spark.createDataFrame(list(enumerate(blocks)), "seq long, json_ld string")).orderBy("seq").collect()
    return [(r["description"], r["salary"], r["employment_type"], r["date_posted"]) for r in rows]


def test_json_ld_of_any_shape(spark):
    post = {"@type": "JobPosting", "description": "<b>a</b> &amp; b", "baseSalary": {"value": {"value": "$50,000"}}, "employmentType": "FULL_TIME", "datePosted": "2026-01-02"}
    full = ("a & b", "$50,000", "Full Time", "2026-01-02")
    other = {"@type": "Organization", "description": "not this"}
    assert fields(spark, *map(json.dumps, [post, [other, post], {"@graph": [other, post]}, [{"x": 1}, {"description": "d"}]])) == [full, full, full, ("d", None, None, None)]
    guarded = dict(post, baseSalary=50000, employmentType=["FULL_TIME"], datePosted={"at": 1})
    assert fields(spark, json.dumps(guarded), json.dumps(dict(post, baseSalary={"value": "$5"})), json.dumps(dict(post, baseSalary=[1], description=None))) == [
        ("a & b", None, None, None), ("a & b", None, "Full Time", "2026-01-02"), (None, None, "Full Time", "2026-01-02")]
    empty = (None, None, None, None)
    assert fields(spark, "{not json", "", None, "[]", "3", '"text"', "null") == [empty] * 7


def test_several_blocks_of_a_page(spark):
    page = ("<script type='application/ld+json'>{bad</script><script id=x type=\"application/ld+json\">{\"name\": 1}</script>"
            '<script type="application/ld+json">{"description": "third"}</script><article>' + "main " * 50 + "</article>")
    df = frame(spark, page, "<article class='m'>" + "main " * 50 + "</article>", "<article>short</article>")
    assert [r["description"] for r in pg.description_fallback(df).orderBy("page_id").collect()] == ["third", ("main " * 50).strip(), ""]
    assert [(r["page_id"], r["block"], r["description"]) for r in pg.page_json_ld(df).orderBy("block").collect()] == [(1, 0, None), (1, 1, None), (1, 2, "third")]


def test_fallback_links_of_pages_without_cards(spark):
    links = '<a href="/jobs/1/a">Solar designer</a><a href="/x">Menu entry here</a><a href="/jobs/2/b">next</a><a href="/jobs/3/c">Solar designer</a>'
    df = frame(spark, links, f"<article>{links}</article>", "<p>nothing</p>")
    rows = pg.fallback_links(df, pg.cards(df).select("page_id").distinct()).collect()
    assert [(r["page_id"], r["title"]) for r in rows] == [(1, "Solar designer")]


def test_entities_are_decoded_from_a_text_computed_once(spark):
    df = frame(spark, "<p>a &lt; b &amp;amp; c</p><!-- x --><style>s</style>")
    out = df.select(pg.html_to_text(F.col("html")).alias("t"))
    assert out.first()["t"] == "a < b &amp; c"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("(?i:style)[^>]*>.*?") == 1
