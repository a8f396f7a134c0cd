import pytest

from ledgerweb.functions import sections
from ledgerweb.functions.sections import Page, find_section, find_website

LONG = "We design and sell widgets of every kind to makers around the world. " * 12
RISK = "Our business is subject to many risks. It may rain. " * 6


def page(body):
    return Page(f"<html><body>{body}</body></html>")


def test_by_contents():
    p = page(f'<table><tr><td><a href="#item1_business">Item 1. Business</a></td></tr><tr><td><a href="#item1a_risk">Item 1A</a></td></tr></table><div id="item1_business"><b>Item 1. Business</b></div><p>{LONG}</p><div id="item1a_risk">Item 1A. Risk Factors</div><p>{RISK}</p><div id="item1b">Item 1B</div>')
    assert find_section(p, "business") == (LONG.strip(), "contents")
    assert find_section(p, "risk_factors") == (RISK.strip(), "contents")


def test_by_contents_with_opaque_ids():
    p = page(f'<p><a href="#i1cb1_7">Item 1.</a> <a href="#i1cb1_9">Item 1A.</a></p><div id="i1cb1_7"></div><p>{LONG}</p><div id="i1cb1_9"></div><p>Item 1A. Risk Factors</p><p>{RISK}</p>')
    assert find_section(p, "business") == (LONG.strip(), "contents")


def test_by_id():
    p = page(f'<div id="item_1_business"><p>{LONG}</p></div><div id="item_1a"><p>{RISK}</p></div><p>Item 2. Properties</p><p>Land.</p>')
    assert find_section(p, "business") == (LONG.strip(), "id")
    assert find_section(p, "risk_factors") == (RISK.strip(), "id")


def test_by_heading_outside_of_tables():
    p = page(f"<table><tr><td>Item 1. Business</td><td>4</td></tr></table><p>Item 1. Business</p><p>{LONG}</p><p>ITEM 1A. RISK FACTORS</p><p>{RISK}</p><p>Item 2. Properties</p>")
    assert find_section(p, "business") == (LONG.strip(), "heading")
    assert find_section(p, "risk_factors") == (RISK.strip(), "heading")


def test_by_text():
    p = page(f"<table><tr><td>Item 1. Business</td></tr><tr><td>{LONG}</td></tr><tr><td>Item 2. Properties</td></tr></table>")
    assert find_section(p, "business") == (LONG.strip(), "text")


def test_short_and_missing_sections():
    assert find_section(page("<p>Item 1. Business</p><p>Short.</p><p>Item 2. Properties</p>"), "business") == (None, None)
    assert find_section(Page(None), "business") == (None, None) and find_section(Page("<p"), "risk_factors") == (None, None)


def test_texts_between_places():
    p = page('<p id="a">one</p><p>two</p><p>one</p><script>no()</script><p>three</p><p id="b">four</p>')
    assert p.between(p.place_of("a"), p.place_of("b")) == "one\ntwo\nthree" and p.between(0, None, 5) == "one\nt"


@pytest.mark.parametrize("body, site", [
    ('<span name="dei:EntityWebSite">https://www.Acme.com/</span><p>visit other.com, our website</p>', "acme.com"),
    ('<ix:nonNumeric name="dei:EntityWebSite">http://shop.acme.co.uk/x</ix:nonNumeric>', "acme.co.uk"),
    ("<p>Our website is www.acme.com. Filed with sec.gov.</p><p>x.org</p>", "acme.com"),
    ("<p>nothing here</p>", None),
])
def test_websites(body, site):
    assert find_website(page(body)) == site


def test_website_from_a_namespace():
    assert find_website(Page('<html xmlns:us="http://fasb.org/us-gaap/2024" xmlns:air="http://www.aarcorp.com/20240531"><body><p>text</p></body></html>')) == "aarcorp.com"


def test_parsers_share_a_page_and_fail_alone(spark):
    pages = spark.createDataFrame([(1, "<p>hello</p>", "k"), (1, None, None)], "id int, html string, more string")
    parsers = {"first": lambda p: p.blocks[0][0], "size": lambda p: str(len(p.html)), "none": lambda p: None}
    got = sorted(map(tuple, sections.parse_pages(pages, "id", parsers=parsers, keep=["more"]).collect()), key=str)
    assert got == [(1, "hello", "12", None, "k"), (1, None, "0", None, None)]


def test_library_first(spark):
    parsed = spark.createDataFrame([(7, "own", "/f/7/a.html"), (None, "own", "/f/0000000008/b.html"), (None, "own", "/f/x/c.html"), (9, "own", "/f/9/d.html")], "cik long, business string, path string")
    library = spark.createDataFrame([("7", "lib"), ("8", "lib8")], "cik string, business string")
    got = {r.path[3:]: r.business for r in sections.with_library(parsed, library).collect()}
    assert got == {"7/a.html": "lib", "0000000008/b.html": "lib8", "x/c.html": None, "9/d.html": "own"}
