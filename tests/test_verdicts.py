"""Selectors, the phrase automaton, verdicts by shop, and pages that break."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aislewatch.functions import phrases
from aislewatch.operators import html, signals, validity
from aislewatch.operators.selectors import Elements, compiled
from aislewatch.plans.observe import observe_products
from aislewatch.rules.verdicts import SHOPS
from aislewatch.session import spread
from aislewatch.sources import captures, sinks

PAGE = """<div id=a class="x big"><p class=q>one</p><p class="q r" data-k="Some Value">two<b>deep</b></p><i>three</i></div>
<ul><li><a href="/view-1.html">A</a></li><li><a href="/other">B</a></li></ul><img src=z.png><span class=xbig></span>"""


def found(selector):
    tree = html._parse(PAGE)
    return [(tree["nodes"][n]["tag"], n) for n in Elements(tree["nodes"]).select(selector)]


@pytest.mark.parametrize(
    "selector, tags",
    [
        ("div", ["div"]), ("#a", ["div"]), (".q", ["p", "p"]), (".q.r", ["p"]), ("p, b, p", ["p", "p", "b"]), ("*", None),
        ("div b", ["b"]), ("div > b", []), ("p > b", ["b"]), ("#a > p + p", ["p"]), ("p ~ i", ["i"]), ("p + i", ["i"]), ("i ~ p", []),
        ("[data-k]", ["p"]), ("[data-k='Some Value']", ["p"]), ("[data-k*='some' i]", ["p"]), ("[data-k*='some']", []),
        ("[class*='big']", ["div", "span"]), (".big", ["div"]), ("a[href^='/view-'][href$='.html']", ["a"]), ("ul li a", ["a", "a"]),
        ("div.x.big > .r b", ["b"]), ("span p", []), ("[data-k*='a,b'], img[src]", ["img"]),
    ],
)
def test_selectors(selector, tags):
    got = [t for t, _ in found(selector)]
    assert got == tags if tags is not None else len(got) == 12


@pytest.mark.parametrize("wrong", ["div >", "> div", "a[href", "a:hover", "", "a,,b["])
def test_wrong_selectors_are_refused(wrong):
    with pytest.raises(ValueError):
        compiled(wrong)


def test_places_and_text_ranges():
    nodes = html._parse(PAGE)["nodes"]
    places = {}
    for n in nodes:
        places.setdefault(n["parent"], []).append(n["pos"])
    assert all(p == list(range(1, len(p) + 1)) for p in places.values())
    assert all(n["t_from"] <= n["t_to"] for n in nodes)


@pytest.mark.parametrize("seed", range(5))
def test_automaton_finds_what_plain_search_finds(seed):
    rnd = random.Random(seed)
    listed = tuple(dict.fromkeys("".join(rnd.choices("ab 4é_", k=rnd.randint(1, 5))) for _ in range(25)))
    for _ in range(40):
        text = "".join(rnd.choices("ab 4é_", k=rnd.randint(0, 60)))
        got = phrases.find(text, listed)
        assert set(got) == {n for n, p in enumerate(listed) if p in text}
        for n, (at, whole) in got.items():
            assert at == text.index(listed[n]) + 1
            assert whole is None or text.startswith(listed[n], whole - 1)


def test_whole_words(spark):
    listed = ["stock", "in stock", "404"]
    texts = ["restock, stocks, in-stock now", "IN STOCK", "x404", "", None, "stocks stock"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    rows = phrases.with_phrase_hits(df, {"hits": "t"}, listed).orderBy("n").collect()
    got = [None if r.hits is None else [(listed[h.phrase], h.at, h.whole_at) for h in r.hits] for r in rows]
    assert got == [[("stock", 3, 21)], [("stock", 4, 4), ("in stock", 1, 1)], [("404", 2, None)], [], None, [("stock", 1, 8)]]


def test_every_shop_has_rules_that_end():
    signals.rule_rows()  # refuses unknown names and wrong selectors
    for name, shop in SHOPS.items():
        last = shop.rules[-1]
        assert not (last.need or last.one_of or last.without), name
        used = {s for r in shop.rules for s in (*r.need, *r.one_of, *r.without, *r.among, r.value) if s}
        assert used == set(shop.signals), (name, set(shop.signals) ^ used)


def test_a_page_that_breaks_leaves_the_others(spark):
    rows = [(1, "<p>fine</p>"), (2, "<p>break</p>"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "page_id int, html string")

    def broken(row, page, tree):
        if "break" in page:
            raise RuntimeError("cannot read this")
        return len(tree["nodes"])

    probe = html.Probe("size", "int", pa.int32(), (), broken)
    got = {r.page_id: r for r in html.parse_pages(df, probes=[probe], error="error").collect()}
    assert got[1].size == 1 and got[1].error is None and got[1].dom is not None
    assert got[2].dom is None and got[2].size is None and got[2].error == "RuntimeError: cannot read this"
    assert got[3].dom is None and got[3].error is None and got[4].size == 0
    with pytest.raises(Exception, match="cannot read this"):
        html.parse_pages(df, probes=[probe]).collect()


def test_the_job_reports_failed_pages(spark):
    good = "<h1>Kettle</h1><script type='application/ld+json'>{\"@type\": \"Product\"}</script><button>Add to basket</button>"
    rows = [
        (1, "https://www.tesco.com/a", 200, good), (2, "https://www.tesco.com/b", 200, "<h1>x</h1><![x[y"), (3, " ", 200, good),
        (4, None, 200, good), (5, "https://www.tesco.com/c", 200, "<h1>Oops</h1>"), (6, "https://www.tesco.com/d", 200, None),
        (7, "https://other.example/p/1", 404, good), (8, "https://www.tesco.com/e", 404, good),
    ]
    df = spark.createDataFrame([(i, u, None, s, h) for i, u, s, h in rows], "page_id long, url string, final_url string, http_status int, html string")
    seen = observe_products(df)
    good_rows, failed = captures.split_errors(seen)
    failed = failed.select("page_id", "url", "error", "is_valid", "listing_status", "name").collect()
    assert [(r.page_id, r.url, r.is_valid, r.listing_status, r.name) for r in failed] == [(2, "https://www.tesco.com/b", None, None, None)]
    assert failed[0].error.startswith("AssertionError")
    got = {r.page_id: r for r in good_rows.collect()}
    assert {i: (r.is_valid, r.verdict) for i, r in got.items()} == {
        1: (True, "valid"), 5: (False, "error_page:h1_error"), 6: (False, "empty_response"),
        7: (False, "HTTP 404 response"), 8: (False, "HTTP 404 response"),
    }
    assert got[1].name == "Kettle" and got[1].in_stock is True and got[5].name is None


def test_good_and_failed_rows_are_written_in_one_pass(spark, tmp_path):
    rows = [(1, "https://www.tesco.com/a", None, 200, "<h1>Kettle</h1>"), (2, "https://www.tesco.com/b", None, 200, "<![x[y")]
    df = spark.createDataFrame(rows, "page_id long, url string, final_url string, http_status int, html string")
    sinks.write_checked(observe_products(df), f"{tmp_path}/out")
    back = spark.read.json(f"{tmp_path}/out")
    assert [(r.page_id, r.failed) for r in back.orderBy("page_id").select("page_id", "failed").collect()] == [(1, "false"), (2, "true")]
    assert spark.read.json(f"{tmp_path}/out/failed=true").first().url == "https://www.tesco.com/b"


def test_stock_container_is_read_first(spark):
    page = "<main><p>In stock</p><div class='stock-message'>Sold out</div><h1 id=pageTitle>K</h1></main>"
    rows = [(1, "https://ao.com/product/x.aspx", None, 200, page)]
    df = spark.createDataFrame(rows, "page_id long, url string, final_url string, http_status int, html string")
    row = observe_products(df).first()
    assert (row.is_valid, row.in_stock, row.stock_text) == (True, False, "sold out")
    assert validity.shop_probe().needs == ("url", "retailer")


def test_spread_runs_nothing(spark):
    group = "spread-runs-nothing"
    spark.sparkContext.setJobGroup(group, group)
    spread(spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count())
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
