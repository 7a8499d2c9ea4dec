"""Decisions on awkward inputs, and properties of the expressions."""

import json
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aislewatch.functions import money, stock, text, urls, vectors
from aislewatch.operators import blobs, html, prices
from aislewatch.operators.json_scan import scan
from aislewatch.rules.prices import DEFAULT_STRATEGIES, Strategy


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "written, amount",
    [("€69.99", "69.99"), ("1.234,50 €", "1234.50"), ("111,06", "111.06"), ("-€41.07", "41.07"), ("1 234,50 €", "1234.50"), ("12.345.678,00", "12345678.00"), ("soon", None)],
)
def test_euros(spark, written, amount):
    assert one(spark, written, money.euros) == (Decimal(amount) if amount else None)


@pytest.mark.parametrize(
    "parse, written, amount",
    [
        (money.dollars, "Now $1,299", "1299.00"), (money.dollars, "$ 5.5", "5.00"), (money.pounds, "£54.9", "54.90"),
        (money.pounds, "54.90", None), (money.kronor, "1 299 kr", "1299.00"), (money.kronor, "349,00 SEK", "349.00"),
        (money.zloty, "cena 349, 99 zł", "349.99"), (money.zloty, "raty 34,99 zł", None), (money.zloty, "0,10 zł", None),
        (money.australian_dollars, "A$ 1,099.95", "1099.95"), (money.minor_units, "6999", "69.99"), (money.minor_units, "69.99", None),
    ],
)
def test_prices(spark, parse, written, amount):
    assert one(spark, written, parse) == (Decimal(amount) if amount else None)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=0, max_value=9999999, places=2), min_size=1, max_size=30))
def test_format_then_parse(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x decimal(12,2)")
    written = df.withColumn("w", money.format_money("x", F.lit("EUR")))
    assert [r["y"] for r in written.select(money.euros("w").alias("y")).collect()] == amounts


def test_unavailable_is_not_available(spark):
    rows = [("this item is unavailable", None), ("nicht  verfügbar", "DE"), ("nicht verfügbar", "SE"), ("unavailablex", None), (None, None)]
    df = spark.createDataFrame(rows, "body string, country string")
    nowhere = F.lit(None).cast("string")
    got = [r["spoken"] for r in stock.with_phrase_state(df, nowhere, "body", "country").collect()]
    assert got[0] == (False, "unavailable") and got[1] == (False, "nicht verfügbar")
    assert got[2:] == [None, None, None]
    first = stock.with_phrase_state(df, F.lit("In stock"), "body", "country").first()["spoken"]
    assert first == (True, "in stock")


@pytest.mark.parametrize("tie, want", [("first", "a"), ("last", "b"), ("item", "c")])
def test_srcset(spark, tie, want):
    assert one(spark, "a 600w, b 600w, c 2x", lambda c: urls.srcset_largest(c, tie)) == want


@pytest.mark.parametrize(
    "written, name",
    [("Škoda – Größe ÄÖ / x", "koda_-_Groesse_AeOe_x"), ("  ", "product"), ("Żółw łódź", "Zolw_lodz"), ("œuf æble", "oeuf_aeble")],
)
def test_safe_name(spark, written, name):
    assert one(spark, written, urls.safe_name) == name


def test_set_params_keeps_order_and_first_value(spark):
    got = one(spark, "https://h.example/p?b=2&wid=5&b=3#f", lambda c: urls.set_params(c, {"wid": "9"}, {"q": "1", "b": "7"}))
    assert got == "https://h.example/p?b=2&wid=9&q=1"


def test_entities_are_decoded_once(spark):
    assert one(spark, "&amp;lt; &#163;5 &#x20AC; &#junk &nbsp;x", text.decode_entities) == "&lt; £5 € &#junk  x"


def test_background_url_quotes(spark):
    for style in ("url('a.jpg')", 'url("a.jpg")', "url( a.jpg )"):
        assert one(spark, style, html.background_url) == "a.jpg"


def _serial_rating_filter(lines):
    """The sequential rule, for comparison."""
    import re

    kept, armed = [], False
    for line in lines:
        if re.search(r"out of 5 stars|Read a Review", line, re.I):
            armed = True
        elif armed and re.fullmatch(r"\d+(?:\.\d+)?", line):
            armed = False
        elif not re.fullmatch(r"\(?\d+\)?", line):
            kept.append(line)
    return kept


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["4 out of 5 stars", "Read a Review", "3.5", "12", "(7)", "kettle", "lid"]), max_size=12))
def test_rating_lines(spark, lines):
    df = spark.createDataFrame([(lines,)], "x array<string>")
    assert df.select(text.drop_rating_lines(F.col("x")).alias("y")).first()["y"] == _serial_rating_filter(lines)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "A", "b", "b.", ""]), max_size=8))
def test_distinct_lines(spark, lines):
    df = spark.createDataFrame([(lines,)], "x array<string>")
    once = df.select(text.distinct_lines(F.col("x"), "lower").alias("y"))
    seen, want = set(), []
    for line in lines:
        if line.lower() not in seen:
            seen.add(line.lower())
            want.append(line)
    assert once.first()["y"] == want
    assert once.select(text.distinct_lines(F.col("y"), "lower").alias("z")).first()["z"] == want


def test_adaptive_steps_are_not_monotone(spark):
    got = [one(spark, s, vectors.required_inliers, "double") for s in (0.96, 0.91, 0.80, 0.70, 0.69)]
    assert got == [8, 12, 15, 20, 15]


def test_walk_follows_the_order_of_the_text(spark):
    state = '{"z":{"name":"first"},"a":{"name":"second","deep":[{"name":"third"}]}}'
    searches, flags = {"n": ["name"]}, {"n": (("name",), "STRING")}
    walked = blobs.walk(spark.createDataFrame([(state,)], "x string"), "x", searches=searches, flags=flags)
    assert walked.select(blobs.first_of_keys(F.col("walk"), "n").alias("y")).first()["y"] == "first"
    assert walked.select(blobs.last_flag(F.col("walk"), "n").alias("y")).first()["y"] == "third"


def test_walk_has_no_depth_limit_and_keeps_the_last_of_repeated_keys(spark):
    product = '{"@type":["Thing","Product"],"sku":1.50,"sku":2.50}'
    state = '{"a":' * 60 + product + "}" * 60
    walked = blobs.walk(spark.createDataFrame([(state,), ("{bad",), (None,), ("",)], "x string"), "x")
    found = [r["p"] for r in walked.select(blobs.product_texts(F.col("walk"), "x").alias("p")).collect()]
    assert sorted(f or [] for f in found) == [[], [], [], [product]]
    parsed = walked.select(F.get(blobs.products_at_any_depth(F.col("walk"), "x"), F.lit(0)).alias("v"))
    skus = parsed.filter("v is not null").select(F.try_variant_get("v", "$.sku", "double")).collect()
    assert [r[0] for r in skus] == [2.5]


def test_walk_of_twenty_thousand_levels_and_a_thousand_nested_products(spark):
    deep = '{"a":' * 20_000 + '{"@type":"Product","inStock":true}' + "}" * 20_000
    nested = '{"@type":"Product","n":' * 1_000 + "1" + "}" * 1_000
    broken = '{"a":' * 20_000 + '{"@type":"Product"}' + "}" * 19_999
    rows = spark.createDataFrame([(1, deep), (2, nested), (3, broken)], "n int, x string")
    walked = blobs.walk(rows, "x").select("n", F.size("walk.products").alias("size"), blobs.last_flag(F.col("walk"), "in_stock").alias("flag"))
    assert {r.n: (r.size, r.flag) for r in walked.collect()} == {1: (1, "true"), 2: (1000, None), 3: (0, None)}


def _random_json(rnd, depth=0):
    kind = rnd.random()
    if depth > 4 or kind < 0.45:
        return rnd.choice([1, -2.5, True, False, None, "Product", 'x\né"', 0, 1e5, ""])
    if kind < 0.7:
        return [_random_json(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    names = ["@type", "name", "title", "inStock", "availability", "a"]
    return {rnd.choice(names): _random_json(rnd, depth + 1) for _ in range(rnd.randint(0, 4))}


def _walked(node, out):
    if isinstance(node, dict):
        kind = node.get("@type")
        if kind == "Product" or (isinstance(kind, list) and "Product" in kind):
            out["products"].append(node)
        held = [node[k] for k in ("title", "name") if node.get(k) is not None]
        out["found"] += held[:1]
        for key, value in node.items():
            if key == "inStock" and isinstance(value, bool):
                out["flag"] = value
    for value in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
        _walked(value, out)
    return out


@pytest.mark.parametrize("seed", range(300))
def test_scanner_agrees_with_a_parser(seed):
    rnd = random.Random(seed)
    root = _random_json(rnd)
    written = json.dumps(root, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]))
    got = scan(written, {"name": ["title", "name"]}, blobs.FLAG_KEYS)
    want = _walked(root, {"products": [], "found": [], "flag": None})
    assert [json.loads(written[at : at + size]) for at, size in got["products"]] == want["products"]
    assert got["flags"].get("in_stock") == (None if want["flag"] is None else str(want["flag"]).lower())
    assert ("name" in got["found"]) == bool(want["found"])
    if want["found"]:
        told, value = got["found"]["name"], want["found"][0]
        assert told == value if isinstance(value, str) else json.loads(told) == value
    cut = written[: rnd.randint(0, len(written))]
    try:
        json.loads(cut)
        valid = True
    except ValueError:
        valid = False
    assert (scan(cut, {}, blobs.FLAG_KEYS) is not None) == valid


def test_selectors(spark):
    page = '<div id="m" class="a b"><p>one<p>two <b>bold</b></div><p data-x="pre-1">three<br>four</p><img src="i.png"/>'
    parsed = html.parse_pages(spark.createDataFrame([(1, page)], "k int, html string"))
    dom, nodes = F.col("dom"), F.col("dom.nodes")
    texts = lambda found: F.transform(found, lambda n: html.text_of(dom, n))
    row = parsed.select(
        texts(html.select(nodes, tag="p")).alias("p"),
        texts(html.select(nodes, tag="p", within=html.select(nodes, id="m", cls="b"))).alias("inside"),
        texts(html.select(nodes, starts={"data-x": "pre"})).alias("starts"),
        texts(html.select(nodes, contains={"data-x": "-"}, attrs={"data-x": "pre-1"})).alias("both"),
        F.size(html.select(nodes, tag="img", has=["src"])).alias("images"),
    ).first()
    assert row["p"] == ["one", "two bold", "three four"]
    assert row["inside"] == ["one", "two bold"]
    assert row["starts"] == row["both"] == ["three four"]
    assert row["images"] == 1


def test_entities_are_decoded_once_and_above_the_basic_plane(spark):
    said = "&#128512;&#x1F600;&#65537;&eacute;&rsquo;&hellip;&ndash;&amp;lt;&#38;lt;&nosuch;&&nbsp;&#0;&#xD800;"
    want = "😀😀\U00010001é’…–&lt;&lt;&nosuch;&\u00a0\ufffd\ufffd"
    assert one(spark, said, text.decode_entities) == want


def test_zloty_with_grouped_thousands(spark):
    for said, want in {"1 234,50 zł": "1234.50", "12 345,00 zł": "12345.00", "349, 99 zł": "349.99", "1234,50 zł": "1234.50"}.items():
        assert str(one(spark, said, money.zloty)) == want


def test_price_places_try_every_element(spark):
    page = '<div class="_7030e_x">raty 34,99 zł</div><div class="_7030e_x">cena 349, 99 zł</div>'
    rule = {"shop": (Strategy("node", "box", {"tag": "div", "contains": {"class": "_7030e_"}}, "zloty"),)}
    df = spark.createDataFrame([("shop", page)], "retailer string, html string")
    scripts = prices.script_finds(F.col("html"), F.col("retailer"), rule, ())
    parsed = html.parse_pages(df.withColumn("scripts", scripts))
    places = prices.place_texts(F.col("dom"), F.col("retailer"), F.lit(None).cast("string"), F.col("scripts"), rule, DEFAULT_STRATEGIES)
    got = parsed.withColumn("places", places).select(prices.price_at(F.col("places")).alias("p")).first()["p"]
    assert (str(got["value"]), got["source"]) == ("349.99", "box")
