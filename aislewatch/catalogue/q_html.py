"""H1-H10 on the captured pages and on product pages."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import RETAIL_PAGE
from aislewatch.catalogue.registry import register
from aislewatch.operators import html, structure


def dom():
    return F.col("dom")


def nodes():
    return F.col("dom.nodes")


# Markup without comments and without the bodies of scripts and styles, in the oracle's terms.
BARE = r"regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"


@register(
    "H1_node_table",
    rf"""SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all({BARE}, '<([a-z][a-z0-9]*)[\s>/]', 1)) AS tag FROM pages)
         GROUP BY 1, 2""",
)
def h1(t):
    table = html.node_table(html.parse_pages(t.pages.select("page_id", "html")), "page_id")
    return table.filter(~F.col("tag").isin("script", "style")).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@register(
    "H2_select_rows",
    r"""SELECT page_id, CAST(n AS BIGINT) AS place, regexp_extract(l[n], 'href="([^"]*)"', 1) AS href, regexp_extract(l[n], '>([^<]*)', 1) AS text
        FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS n FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a [^>]*>[^<]*') AS l FROM pages))""",
)
def h2_rows(t):
    """Links of navigation lists with their texts, from the tables of elements and text pieces alone."""
    parsed = html.parse_pages(t.pages.select("page_id", "html"))
    elements = html.node_table(parsed, "page_id")
    links = structure.select_rows(elements, "page_id", "nav ul > li > a[href^='/']")
    told = structure.text_of_rows(links, html.text_table(parsed, "page_id"), "page_id")
    items = structure.select_rows(elements, "page_id", "nav ul > li").select("page_id", F.col("node").alias("parent"), F.col("pos").alias("place"))
    return told.drop("pos").join(items, ["page_id", "parent"]).select(
        "page_id", F.col("place").cast("bigint").alias("place"), F.col("attrs")["href"].alias("href"), "text"
    )


@register(
    "H2_select",
    r"""SELECT page_id, CAST(n AS BIGINT) AS place, regexp_extract(a, 'href="([^"]*)"', 1) AS href
        FROM (SELECT page_id, unnest(l) AS a, generate_subscripts(l, 1) - 1 AS n
              FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a [^>]*>') AS l FROM pages))""",
)
def h2(t):
    parsed = html.parse_pages(t.pages.select("page_id", "html"))
    links = html.select(nodes(), tag="a", starts={"href": "/"}, within=html.select(nodes(), tag="nav"))
    return parsed.select("page_id", F.posexplode(links).alias("place", "a")).select(
        "page_id", F.col("place").cast("bigint").alias("place"), F.col("a")["attrs"]["href"].alias("href")
    )


def _plain(fragment: str) -> str:
    return rf"trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace({fragment}, '<[^>]+>', ' ', 'g'), '&quot;', chr(34)), '&#x27;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[\s\x{{A0}}]+', ' ', 'g'))"


@register(
    "H3_element_text",
    f"""SELECT page_id, {_plain("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS article,
               {_plain("regexp_extract(html, '(?s)<footer>(.*)</footer>', 1)")} AS footer FROM pages""",
)
def h3(t):
    parsed = html.parse_pages(t.pages.select("page_id", "html"))
    return parsed.select(
        "page_id",
        html.text_of(dom(), html.first(html.select(nodes(), tag="article"))).alias("article"),
        html.text_of(dom(), html.first(html.select(nodes(), tag="footer"))).alias("footer"),
    )


def _retail(t):
    return html.parse_pages(t.feed(RETAIL_PAGE).select("page_id", "html"))


@register(
    "H4_attribute_chain",
    """SELECT p_partkey AS page_id, n AS place, CASE n WHEN 0 THEN 'c3.jpg' WHEN 1 THEN 'a' || p_partkey || '.jpg' ELSE 'b' || p_partkey || '.jpg' END AS url FROM part, range(0, 3) r(n)""",
)
def h4(t):
    images = html.select(nodes(), tag="img", within=html.select(nodes(), cls="glide"))
    return _retail(t).select(
        "page_id", F.posexplode(F.transform(images, html.image_address)).alias("place", "url")
    ).withColumn("place", F.col("place").cast("bigint"))


@register(
    "H5_product_name",
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 6 <> 1 THEN p_name || ' ' || p_brand WHEN p_partkey % 4 <> 1 THEN p_name || ' og' ELSE p_name END AS name FROM part""",
)
def h5(t):
    return _retail(t).select("page_id", html.product_name(dom()).alias("name"))


@register(
    "H6_meta",
    """SELECT p_partkey AS page_id, 'About ' || p_name AS description, CASE WHEN p_partkey % 5 = 0 THEN CAST(round(p_retailprice * 100) AS BIGINT) / CAST(100 AS DOUBLE) END AS price FROM part""",
)
def h6(t):
    return _retail(t).select(
        "page_id",
        html.meta(dom(), "description").alias("description"),
        html.meta(dom(), "product:price:amount", "og:price:amount").cast("decimal(12,2)").cast("double").alias("price"),
    )


@register(
    "H7_specification_lines",
    """SELECT p_partkey AS page_id, 'Brand: ' || p_brand || chr(10) || 'Size: ' || p_size || chr(10) || 'Type: ' || p_type AS specification FROM part""",
)
def h7(t):
    return _retail(t).select("page_id", F.array_join(html.specification_lines(dom()), "\n").alias("specification"))


@register(
    "H8_without_clones",
    "SELECT p_partkey AS page_id, 2::BIGINT AS n_slides FROM part",
)
def h8(t):
    slides = html.without_clones(html.select(nodes(), tag="li", cls="glide__slide"), "glide__slide--clone")
    return _retail(t).select("page_id", F.size(slides).cast("bigint").alias("n_slides"))


@register(
    "H9_gallery_order",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN 'm.jpg t1.jpg t2.jpg' ELSE 'm.jpg t2.jpg t1.jpg' END AS gallery FROM part",
)
def h9(t):
    ordered = html.gallery_order(dom(), html.select(nodes(), id="grid"))
    return _retail(t).select("page_id", F.array_join(ordered["url"], " ").alias("gallery"))


@register(
    "H10_background_url",
    "SELECT p_partkey AS page_id, 'https://cdn.example/h' || p_partkey || '.jpg' AS url FROM part",
)
def h10(t):
    hero = html.first(html.select(nodes(), tag="div", contains={"style": "background-image"}))
    return _retail(t).select("page_id", html.background_url(hero["attrs"]["style"]).alias("url"))
