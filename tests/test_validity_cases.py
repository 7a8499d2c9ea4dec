"""The eight validity cases: missing pages, categories, products in and out of stock."""

import pytest
from pyspark.sql import functions as F

from aislewatch.operators import html, validity

PAGER = """<nav role="navigation" aria-label="Paginering"><ul>
<li><a aria-label="Gå till föregående sida" href="/category/">prev</a></li>
{links}
<li><a aria-label="Gå till nästa sida" href="/category/?page=2">next</a></li></ul></nav>"""


def _pager(n):
    links = "".join(f'<li><a aria-label="Gå till sida {i}" href="/category/?page={i}">{i}</a></li>' for i in range(1, n + 1))
    return PAGER.format(links=links)


def _product(name, price, extra=""):
    return (
        f'<script type="application/ld+json">{{"@type": "Product", "name": "{name}", "offers": {{"price": "{price}", '
        f'"priceCurrency": "SEK"{extra}}}}}</script><h1>{name}</h1>'
    )


STRUCTURAL = [
    ("category", "https://x.example/produkt/kettle-1/", _pager(5) + '<div data-testid="product-card">P</div>' * 4, True),
    ("product", "https://x.example/produkt/robot-2/", _product("Robot", 1299) + '<button data-cy="pdp-add-to-cart">K</button><div role="tablist"><img src="a.jpg"></div>', False),
    ("sold out", "https://x.example/produkt/item-3/", _product("Item", 599, ', "availability": "OutOfStock"') + '<button data-cy="pdp-add-to-cart" disabled>Slut</button>', False),
    ("no data", "https://x.example/produkt/plain-4/", '<h1>Plain</h1><button data-testid="pdp-add-to-cart">Add to Cart</button><div data-testid="image-panel"><img src="a.jpg"></div>', False),
]
LAYERED = [
    ("missing", "https://x.example/produkt/a-1/", None, None, "<h1 class='c'>Ooops! Sidan finns inte längre :(</h1><p>hittade du till en sida som inte finns längre.</p>", True),
    ("category", "https://x.example/produkt/a-2/", "https://x.example/hemmet/kok/", None, _pager(2) + '<div class="product-grid"><div data-testid="product-card">P</div></div>', True),
    ("product", "https://x.example/produkt/a-3/", None, None, _product("Test", 199) + '<button data-cy="pdp-add-to-cart">K</button><div aria-label="Produktbeskrivning">d</div><span class="price">199 SEK</span>', False),
    ("404 in name", "https://x.example/produkt/model-x-404/", None, None, _product("Model X-404 Speaker", 299) + '<p>Sidan finns inte alltid uppdaterad.</p><button data-cy="pdp-add-to-cart">K</button><span class="price">299 SEK</span>', False),
    ("status", "https://x.example/produkt/a-5/", None, 404, _product("Gone", 1), True),
]


@pytest.fixture(scope="module")
def structural(spark):
    rows = [(n, u, f"<html><body>{h}</body></html>") for n, u, h, _ in STRUCTURAL]
    pages = spark.createDataFrame(rows, "name string, url string, html string")
    pages = pages.withColumn("jsonld_product", F.coalesce(validity.jsonld_page_type(F.col("html")) == "Product", F.lit(False)))
    return {r["name"]: r for r in validity.structural_verdict(html.parse_pages(pages)).collect()}


@pytest.mark.parametrize("case", STRUCTURAL, ids=[c[0] for c in STRUCTURAL])
def test_structural(structural, case):
    assert structural[case[0]]["is_invalid"] is case[3]


def test_structural_reason(structural):
    assert structural["category"]["reason"] == "Invalid: pagination with 7 pages (category page)"


@pytest.fixture(scope="module")
def layered(spark):
    rows = [(n, u, f, s, f"<html><body>{h}</body></html>") for n, u, f, s, h, _ in LAYERED]
    pages = spark.createDataFrame(rows, "name string, url string, final_url string, http_status int, html string")
    return {r["name"]: r for r in validity.layered_verdict(pages).collect()}


@pytest.mark.parametrize("case", LAYERED, ids=[c[0] for c in LAYERED])
def test_layered(layered, case):
    assert layered[case[0]]["is_invalid"] is case[5]


def test_layered_details(layered):
    assert layered["category"]["redirect_detected"] is True and layered["category"]["category_score"] >= 2
    assert layered["product"]["json_ld_type"] == "Product" and layered["product"]["product_score"] >= 2


@pytest.mark.parametrize(
    "body, guarded, found",
    [
        ("product not found", True, True), ("this product is no longer available", True, True),
        ("price 5 product not found", True, False), ("price 5 product not found", False, True),
        ("price " + "x" * 600 + " page not found", True, True), ("all is well", False, False),
    ],
)
def test_error_phrase_and_its_guard(spark, body, guarded, found):
    phrases = ["page not found", "product not found", "this product is no longer available"]
    df = spark.createDataFrame([(body,)], "x string")
    got = df.select(validity.error_phrase("x", phrases, guarded).alias("y")).first()["y"]
    assert (got is not None) == found
