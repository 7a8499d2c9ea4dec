"""Captured pages as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewatch.operators.images import distinct_first


def read_pages(spark: SparkSession, path: str, columns: Sequence[str] = ("page_id", "url", "html")) -> DataFrame:
    """Page captures. Only the named columns are read."""
    return spark.read.parquet(path).select(*columns)


def choose_result(results: DataFrame, request: str, url: str, requested: str, pos: str) -> DataFrame:
    """Per request the result of the requested URL, else the first one; failures get an ``error``.

    An aggregate, so results combine before the shuffle and one request may have any number of them.
    """
    rest = [c for c in results.columns if c != request]
    order = F.struct((~F.col(url).eqNullSafe(F.col(requested))).alias("other"), F.col(pos))
    chosen = results.groupBy(request).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(request, "_r.*")
    error = F.when(F.col("http_status") != 200, F.concat(F.lit("bad response: "), F.col("http_status"))).when(
        F.col("content").isNull(), "missing content"
    )
    return chosen.withColumn("error", error)


def unwrap_envelope(fields: Sequence[Column]) -> Column:
    """S3: HTML from the first filled field of an envelope: plain, ``data:`` URI or bare base64."""
    raw = F.coalesce(*[F.nullif(f, F.lit("")) for f in fields])
    data = F.regexp_extract(raw, r"(?s)^data:text/html[^,]*,(.*)$", 1)
    plain_data = F.coalesce(F.try_url_decode(F.replace(data, F.lit("+"), F.lit("%2B"))), data)
    coded = F.decode(F.try_to_binary(data, F.lit("base64")), "UTF-8")
    looks_coded = raw.rlike(r"^[A-Za-z0-9+/=\s]{200,}$") & (F.length(F.trim(raw)) % 4 == 0)
    decoded = F.decode(F.try_to_binary(raw, F.lit("base64")), "UTF-8")
    return (
        F.when(raw.rlike(r"^data:text/html[^,]*;base64,"), F.coalesce(coded, plain_data))
        .when(raw.startswith("data:text/html"), plain_data)
        .when(looks_coded & decoded.contains("<"), decoded)
        .otherwise(raw)
    )


def choose_capture(
    captures: DataFrame, page: str, capture_no: str, images: Column, description: Column, least_images: int = 2, least_text: int = 60
) -> DataFrame:
    """The first capture rich enough, else the last attempt."""
    rest = [c for c in captures.columns if c != page]
    ok = F.coalesce((images >= least_images) & (F.length(description) >= least_text), F.lit(False))
    order = F.struct((~ok).alias("poor"), F.when(ok, F.col(capture_no)).otherwise(-F.col(capture_no)).alias("turn"))
    return captures.groupBy(page).agg(F.min_by(F.struct(*rest), order).alias("_c")).select(page, "_c.*")


def union_capture_images(images: DataFrame, page: str, capture_no: str, key: str, pos: str) -> DataFrame:
    """Images of all captures of a page; an earlier capture wins a key. ``source_no`` is the capture's number."""
    return distinct_first(images.withColumnRenamed(capture_no, "source_no"), page, key, ["source_no", pos])


# Suffixes of image files.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp", "bmp", "tiff", "tif", "gif", "jfif", "avif")


def is_image_path(path: Column | str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*IMAGE_SUFFIXES)


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Image files of a folder by path. The content column is read only if it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.filter(is_image_path("path")).orderBy("path")


def with_errors(rows: DataFrame, url: str, checks: Mapping[str, Column]) -> DataFrame:
    """Drop rows without a URL; add ``error``, the first failed check, instead of failing the job."""
    asked = rows.filter(F.trim(F.coalesce(F.col(url), F.lit(""))) != "")
    chain = None
    for message, failed in checks.items():
        test = F.coalesce(failed, F.lit(True))
        chain = F.when(test, message) if chain is None else chain.when(test, message)
    return asked.withColumn("error", chain if chain is not None else F.lit(None).cast("string"))


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and failed rows (url, error)."""
    return rows.filter(F.col("error").isNull()).drop("error"), rows.filter(F.col("error").isNotNull())
