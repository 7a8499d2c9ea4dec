"""Variant roll-up (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def available_names(variants: DataFrame, product: str = "product_id") -> DataFrame:
    """The available names of each product as rows (product, name, first_pos), for products with any number of them."""
    return variants.filter("available").groupBy(product, "name").agg(F.min("pos").alias("first_pos"))


def roll_up_variants(variants: DataFrame, product: str = "product_id") -> DataFrame:
    """One row per product from (product, pos, name, selected, available).

    The selected variant decides; otherwise no available variant means FALSE and any means TRUE with
    the list of names. Names are made distinct first, so a product repeated over a third of all rows
    still reaches the reducer as its distinct names.
    """
    named = variants.groupBy(product, "name").agg(
        F.min(F.when(F.col("available"), F.col("pos"))).alias("first_pos"),
        F.min_by(F.struct("name", "available"), F.when(F.col("selected"), F.col("pos"))).alias("chosen"),
        F.min(F.when(F.col("selected"), F.col("pos"))).alias("chosen_pos"),
        F.bool_or("available").alias("any_available"),
    )
    rolled = named.groupBy(product).agg(
        F.bool_or("any_available").alias("any_available"),
        F.min_by("chosen", "chosen_pos").alias("chosen"),
        F.sort_array(
            F.collect_list(F.when(F.col("first_pos").isNotNull(), F.struct("first_pos", "name")))
        ).alias("names"),
    )
    listed = F.array_join(F.col("names")["name"], ", ")
    return rolled.select(
        product,
        F.coalesce(F.col("chosen")["available"], F.col("any_available")).alias("in_stock"),
        F.when(
            F.col("chosen").isNotNull(),
            F.concat(
                F.col("chosen")["name"], F.when(F.col("chosen")["available"], " - In stock").otherwise(" - Out of stock")
            ),
        )
        .when(F.col("any_available"), F.concat(F.lit("Available in: "), listed))
        .otherwise("All variants out of stock")
        .alias("stock_text"),
    )
