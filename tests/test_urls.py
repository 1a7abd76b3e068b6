import pytest
from pyspark.sql import functions as F

from webcat.functions import urls as U

BASE = "https://www.x.com/p/q"


def test_site_name(value):
    assert value(U.site_name(F.lit("https://www.lacabra.com/x"))) == "lacabra_com"


@pytest.mark.parametrize("url,index,expected", [
    ("https://us.lacabra.com/products/la-pelota", 0, "000_us.lacabra.com_products_la-pelota"),
    ("https://www.a.com/", 12, "012_a.com_home"),
    ("https://a.com/ä b//c!", 7, "007_a.com_ä_b_c"),
])
def test_safe_filename(value, url, index, expected):
    assert value(U.safe_filename(F.lit(url), F.lit(index))) == expected


def test_safe_filename_is_cut(value):
    assert len(value(U.safe_filename(F.lit("https://a.com/" + "x" * 500), F.lit(1)))) == 200


@pytest.mark.parametrize("url,expected", [
    ("https://a.com/p/?b=2&a=1&a=9&c=#f", "https://a.com/p?a=1&b=2&c="),
    ("https://a.com/", "https://a.com/"),
    ("HTTPS://A.com/x///", "https://A.com/x"),
    ("https://a.com/p?q=%41+b&z", "https://a.com/p?q=A b&z="),
    ("https://a.com/p?q=%zz", "https://a.com/p?q=%zz"),
    ("https://a.com/p?", "https://a.com/p"),
])
def test_normalize_url(value, url, expected):
    once = value(U.normalize_url(F.lit(url)))
    assert once == expected
    assert value(U.normalize_url(F.lit(once))) == once


@pytest.mark.parametrize("href,expected", [
    ("https://other.com/a", "https://other.com/a"),
    ("//cdn.y.com/a", "https://cdn.y.com/a"),
    ("www.x.com/products/coffee", "https://www.x.com/products/coffee"),
    ("www.y.com/a", "https://www.y.com/a"),
    ("shop.y.com/a", "https://shop.y.com/a"),
    ("www.x.com/products/www.x.com/products/coffee", "https://www.x.com/products/coffee"),
    ("/products/www.x.com/products/coffee", "https://www.x.com/products/coffee"),
    ("../z", "https://www.x.com/z"),
    ("index.html", "https://www.x.com/p/index.html"),
    ("?k=1", "https://www.x.com/p/q?k=1"),
    ("#top", "https://www.x.com/p/q#top"),
    ("a/./b/../c", "https://www.x.com/p/a/c"),
    ("a//b", "https://www.x.com/p/a/b"),
    ("javascript:void(0)", "javascript:void(0)"),
    ("  /ok ", "https://www.x.com/ok"),
    ("   ", None),
])
def test_resolve_url(value, href, expected):
    assert value(U.resolve_url(F.lit(href), U.base_parts(F.lit(BASE)))) == expected


def test_fragment_and_query_of_the_base_are_replaced(value):
    base = U.base_parts(F.lit("https://a.com/x?old=1#old"))
    assert value(U.resolve_url(F.lit("?k=1"), base)) == "https://a.com/x?k=1"
    assert value(U.resolve_url(F.lit("#new"), base)) == "https://a.com/x?old=1#new"


@pytest.mark.parametrize("url,expected", [
    ("http://a.com/http://b.com", True), ("https://a.com/x//y", True), ("https://a.com/{id}", True),
    ("https://a.com/" + "x" * 2001, True), ("https://a.com/a.com/a.com", True), ("https://a.com/a.com", False),
    ("https://a.com/x?y=//z", False),
])
def test_is_malformed_url(value, url, expected):
    assert value(U.is_malformed_url(F.lit(url))) is expected


@pytest.mark.parametrize("url,external,expected", [
    ("https://www.x.com/a", False, True), ("https://y.com/a", False, False), ("https://y.com/a", True, True),
    ("ftp://www.x.com/a", False, False), ("https://www.x.com/a.PDF", False, False),
    ("https://www.x.com/a.unknown", False, True), (None, False, False),
])
def test_is_valid_url(value, url, external, expected):
    column = U.is_valid_url(F.lit(url).cast("string"), F.lit("www.x.com"), follow_external=external)
    assert value(column) is expected


@pytest.mark.parametrize("text,expected", [
    ("/menu", True), ("/a/b/a", False), ("foo()", False), ("ab", False), ("MAX_SIZE", False),
    ("x.com/x.com/a", False), ("page.html", True), ("word", False), ("http://x.com/a", False),
])
def test_is_valid_js_url(value, text, expected):
    assert value(U.is_valid_js_url(F.lit(text), F.lit("x.com"))) is expected


@pytest.mark.parametrize("text,expected", [
    ("/dir/", True), ("/a.png", False), ("data:x", False), ("/a.cfm", False), ("/a.html", True), ("#x", False), (" ", False),
])
def test_is_valid_css_url(value, text, expected):
    assert value(U.is_valid_css_url(F.lit(text))) is expected
