"""Captured pages to product observations in one map-only job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions import stock, text, urls
from aislewatch.operators import blobs, html, prices, signals, validity
from aislewatch.rules.identifiers import DEFAULT_ID_RULE, ID_RULES
from aislewatch.session import allow_repeated_keys, spread

def _jsonld_fields(page: Column) -> dict[str, Column]:
    """Plain columns from the page's first Product, so no VARIANT crosses to the tokeniser."""
    products = blobs.objects(blobs.tolerant_blobs(blobs.jsonld_texts(page)), ["Product"])
    product = F.get(products, F.lit(0))
    offers = blobs.offers(product)
    return {
        "ld_name": F.try_variant_get(product, "$.name", "string"),
        "ld_description": F.try_variant_get(product, "$.description", "string"),
        "ld_price": blobs.pick_offer(offers, "price"),
        "ld_currency": blobs.pick_offer(offers, "currency"),
        "ld_availability": blobs.pick_offer(offers, "availability"),
    }


def observe_products(captures: DataFrame, max_images: int | None = None) -> DataFrame:
    """One observation per capture (page_id, url, final_url, http_status, html) that has a URL.

    All images are kept unless ``max_images`` is given.

    JSON fields are read from the raw page in the JVM; the page then goes through the tokeniser once, which
    also reads the signals of its shop and all phrases, and the raw HTML is dropped. A shop with rules of its
    own is judged by them, any other by the layered verdict. No stage shuffles, except to spread a small
    input. A page on which the tokeniser fails does not end the job: ``error`` says what happened, and all
    that would have been read from it is NULL; ``captures.split_errors`` parts such rows from the others.
    """
    allow_repeated_keys(captures.sparkSession)
    asked = captures.filter(F.trim(F.coalesce("url", F.lit(""))) != "")
    named = spread(asked).withColumns({"retailer": urls.retailer_of("url"), "country": urls.country_of("url")})
    # Only pages of shops without rules go through the patterns of the layered verdict.
    unruled = named.withColumn("_unruled", F.when(~signals.has_rules(F.col("retailer")), F.col("html")))
    judged = validity.layered_verdict(unruled, page="_unruled", balance=False).withColumnsRenamed(
        {"is_invalid": "_layered_invalid", "reason": "_layered_reason"}
    )
    judged = judged.withColumns({**_jsonld_fields(F.col("html")), "blocked": validity.is_blocked("html")})
    judged = judged.withColumn("_scripts", prices.script_finds(F.col("html"), F.col("retailer")))
    keep = [
        "page_id", "url", "retailer", "country", "http_status", "_layered_invalid", "_layered_reason", "blocked",
        "ld_name", "ld_description", "ld_price", "ld_currency", "ld_availability", "_scripts",
    ]
    read_once = html.parse_pages(judged, keep=keep, balance=False, probes=[validity.shop_probe()], error="error")
    told = validity.verdict_by_retailer(read_once)
    parsed = told.withColumns(
        {
            "is_invalid": F.when(F.col("error").isNull(), F.coalesce("is_invalid", "_layered_invalid")),
            "reason": F.when(F.col("error").isNull(), F.coalesce("reason", "_layered_reason")),
        }
    )
    dom, nodes = F.col("dom"), F.col("dom.nodes")

    # Elements first, then their texts, then what is read from the texts: each step is a column of
    # its own, so nothing that costs a pass over the page is written into an expression twice.
    buttons = F.filter(nodes, lambda n: n["tag"] == "button")
    elements = parsed.withColumns(
        {
            "_places": prices.place_texts(dom, F.col("retailer"), F.col("ld_price"), F.col("_scripts")),
            "_buy": html.first(F.filter(buttons, lambda b: F.lower(html.text_of(dom, b)).rlike(stock.rules.BUY_TEXT))),
            "_meta_description": html.meta(dom, "description"),
            "name": html.product_name(dom, jsonld=F.col("ld_name")),
            "image_urls": F.array_distinct(
                F.array_compact(F.transform(html.select(nodes, tag="img"), html.image_address))
            ),
        }
    )
    if max_images is not None:
        elements = elements.withColumn("image_urls", F.slice("image_urls", 1, max_images))
    buy = F.col("_buy")
    texts = elements.withColumns(
        {
            "_buy_text": html.text_of(dom, buy),
            "_buy_off": buy["attrs"]["disabled"].isNotNull(),
            "_buy_aria": buy["attrs"]["aria-disabled"],
            "_buy_class": buy["attrs"]["class"],
        }
    ).drop("dom", "_buy", "_scripts")

    read = texts.withColumns(
        {
            "_price": prices.price_at(F.col("_places")),
            "_pressed": stock.button("_buy_text", F.col("_buy_off"), F.col("_buy_aria"), F.col("_buy_class")),
            "_offered": stock.offered_state("retailer", "ld_availability"),
            "_spoken": stock.state_of_hits(F.col("shop.stock_hits"), F.col("shop.hits"), "country"),
        }
    )
    heard = {
        "button": F.struct(F.col("_pressed").alias("state"), F.col("_buy_text").alias("text")),
        "jsonld": F.struct(F.col("_offered").alias("state"), F.col("ld_availability").alias("text")),
        "negative": F.struct(F.when(~F.col("_spoken.state"), False).alias("state"), F.col("_spoken.text").alias("text")),
    }
    description = text.first_long_enough([(F.col("ld_description"), 20), (F.col("_meta_description"), 0)])
    found = read.withColumns(
        {"_stock": stock.by_precedence("retailer", heard), "description": text.clean(description)}
    )
    numbered = urls.with_stable_id(found, ID_RULES, DEFAULT_ID_RULE)
    in_stock = stock.default_state("retailer", F.col("_stock.state"), F.col("_buy_text").isNotNull())
    named = numbered.select(
        "page_id", "url", "retailer", "country", "product_id",
        (~F.col("is_invalid")).alias("is_valid"), F.col("reason").alias("verdict"), "blocked", "name",
        F.col("_price.value").alias("price_amount"), F.col("_price.source").alias("price_source"),
        F.col("ld_currency").alias("currency"), in_stock.alias("in_stock"), F.col("_stock.text").alias("stock_text"),
        "description", "image_urls", "error",
    )
    fields = ["name", "price_amount", "price_source", "currency", "in_stock", "stock_text", "description", "image_urls"]
    listed = validity.null_invalid(named, "is_valid", "verdict", fields)
    status = F.when(F.col("error").isNull(), F.col("listing_status"))
    return listed.withColumns({"image_count": F.size("image_urls"), "listing_status": status})
