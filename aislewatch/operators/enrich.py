"""Enrichment joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewatch.session import parted


def fill_missing(pages: DataFrame, extra: DataFrame, code: str, fields: Sequence[str], valid: str) -> DataFrame:
    """Fill missing fields of valid rows from a second source with one row per code."""
    given = extra.select(code, *[F.col(f).alias(f"_x_{f}") for f in fields])
    joined = pages.join(given, code, "left")
    filled = {f: F.when(F.col(valid), F.coalesce(f, f"_x_{f}")).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(filled).drop(*[f"_x_{f}" for f in fields])


def choose_variant(requests: DataFrame, variants: DataFrame, product: str, wanted: str, pos: str) -> DataFrame:
    """Variant of a product by name, case-insensitively, with a message when it fails.

    Variants reduce to one row per (product, name) first, and are parted by them before, since texts are aggregated by
    sorting; a list of names is made only for products of which a request names a variant that is not there. Building the
    plan counts the variants.
    """
    keyed = parted(variants.withColumn("_name_key", F.lower(F.trim("name"))), variants.count(), product, "_name_key")
    by_name = keyed.groupBy(product, "_name_key").agg(
        F.min_by(F.struct("name", "url", "available"), F.col(pos)).alias("_v"), F.min(pos).alias("_pos")
    )
    asked = requests.withColumn("_name_key", F.lower(F.trim(wanted)))
    no_wish = F.coalesce(F.col("_name_key") == "", F.lit(True))
    joined = asked.join(by_name.drop("_pos"), [product, "_name_key"], "left")
    # Only requests that miss name the variants there are, so lists are made and joined for their products alone.
    joined = joined.withColumn("_missed", F.when(~no_wish & F.col("_v").isNull(), F.col(product)))
    missed = joined.filter(F.col("_missed").isNotNull()).select(F.col("_missed").alias(product)).distinct()
    names = by_name.join(missed, product, "left_semi").groupBy(F.col(product).alias("_missed")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_pos"), F.col("_v")["name"].alias("name")))).alias("_n")
    )
    joined = joined.join(names, "_missed", "left")
    message = (
        F.when(no_wish, F.lit(None).cast("string"))
        .when(F.col("_v").isNull() & F.col("_n").isNull(), "No color variants found on this product page")
        .when(F.col("_v").isNull(), F.concat(F.lit("Color '"), F.col(wanted), F.lit("' not found. Available colors: "), F.array_join(F.col("_n")["name"], ", ")))
        .when(~F.col("_v")["available"], F.concat(F.lit("Color '"), F.col(wanted), F.lit("' is out of stock")))
    )
    return joined.select(
        *requests.columns,
        F.when(~no_wish, F.col("_v")["name"]).alias("variant"),
        F.when(~no_wish, F.col("_v")["url"]).alias("variant_url"),
        message.alias("color_error"),
    )


def still_to_do(wanted: DataFrame, saved: DataFrame, index: str) -> DataFrame:
    """Wanted indices that are not saved."""
    return wanted.join(saved.select(index).distinct(), index, "left_anti")


def index_range(df: DataFrame, index: str) -> DataFrame:
    """All indices from the smallest to the largest of a table, made in bounded pieces."""
    step = 100_000
    ends = df.agg(F.min(index).alias("lo"), F.max(index).alias("hi"))
    starts = ends.select(F.explode(F.sequence("lo", "hi", F.lit(step).cast("bigint"))).alias("from"), "hi")
    spread = starts.repartition("from")
    return spread.select(F.explode(F.sequence("from", F.least(F.col("from") + step - 1, F.col("hi")))).alias(index))
