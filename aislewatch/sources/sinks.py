"""Writing observations and page archives, and naming outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aislewatch.functions import urls


def as_documents(observations: DataFrame) -> DataFrame:
    """One JSON document per product; keys without a value are left out."""
    return observations.select(F.to_json(F.struct("*")).alias("document"))


def write_observations(observations: DataFrame, path: str, by: str = "retailer", mode: str = "append") -> None:
    """One table of JSON documents, partitioned by retailer."""
    observations.write.mode(mode).partitionBy(by).json(path)


def write_checked(observations: DataFrame, path: str, error: str = "error", mode: str = "append") -> None:
    """Good and failed rows in one pass, as documents under ``failed=false`` and ``failed=true``.

    A failed row keeps what names it and its error; keys without a value are left out.
    """
    observations.withColumn("failed", F.col(error).isNotNull()).write.mode(mode).partitionBy("failed").json(path)


def archive_rows(pages: DataFrame) -> DataFrame:
    """Raw pages with a content hash, by which later captures are told apart."""
    return pages.withColumn("content_hash", F.sha1("html"))


def write_archive(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Raw page archive keyed by page id."""
    archive_rows(pages).write.mode(mode).parquet(path)


def output_key(url: Column | str, name: Column | str, product_id: Column | str, stamp: Column | None = None, max_name: int = 120) -> Column:
    """``<slug>_<safe name>_<stable id>[_<stamp>]``."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    parts = [urls.host_slug(url), urls.safe_name(name, max_name), as_col(product_id)]
    if stamp is not None:
        parts.append(F.date_format(stamp, "yyyyMMdd-HHmmss"))
    return F.concat_ws("_", *parts)


def number_within(df: DataFrame, key: str, order: str, out: str, width: int = 1_000_000) -> DataFrame:
    """Number the rows of each key from 0 in the order of an integer column, for keys of any size.

    Rows are ranked per (key, range of ``order``) and shifted by the counts of the ranges before, so a
    key that holds a third of all rows is still spread over many tasks.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order) / width))
    counts = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = Window.partitionBy(key, "_range").orderBy(order)
    ranked = ranged.withColumn("_rank", F.row_number().over(local) - 1).join(offsets, [key, "_range"])
    return ranked.withColumn(out, F.col("_rank") + F.col("_before")).drop("_range", "_rank", "_before")


#: What a generated key ends in: an underscore and its number, in two digits at least.
_NUMBERED = r"^(.*)_(\d{2,})$"


def _suffixed(key: Column, number: Column) -> Column:
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(2), F.length(digits)), F.lit("0"))
    return F.concat(key, F.lit("_"), padded)


def _numbers_of(keys: DataFrame, key: str) -> DataFrame:
    """(key, _f): of keys that look like generated ones, the key they would be made from and their number."""
    base = F.regexp_extract(key, _NUMBERED, 1)
    number = F.regexp_extract(key, _NUMBERED, 2).try_cast("bigint")
    numbered = keys.select(F.col(key).alias("_whole"), base.alias(key), number.alias("_f"))
    # "x_007" is not what number 7 would give, so it stands in no generated key's way.
    return numbered.filter((F.col("_f") >= 1) & (_suffixed(F.col(key), F.col("_f")) == F.col("_whole"))).select(key, "_f").distinct()


def unique_keys(df: DataFrame, key: str, order: str, taken: DataFrame | None = None, width: int = 1_000_000) -> DataFrame:
    """The first row of a key keeps it; later ones get ``_01``, ``_02`` and so on.

    ``taken`` holds keys (in a column of the same name) that earlier batches have used: a key that stands there is
    given to no row, and numbers go on from those in use. A generated key that is taken, or that is the key of
    another row of the batch, is passed over. So keys are unique within the batch and against ``taken``.
    """
    given = df.select(key).distinct()
    used = given if taken is None else given.unionByName(taken.select(key)).distinct()
    numbered = number_within(df, key, order, "_no", width)
    if taken is None:
        numbered = numbered.withColumn("_r", F.col("_no"))
    else:
        held = taken.select(key).distinct().withColumn("_held", F.lit(1))
        numbered = numbered.join(held, key, "left").withColumn("_r", F.col("_no") + F.coalesce("_held", F.lit(0))).drop("_held")
    # The r-th free number is r plus the numbers in use before it: the i-th one in use, f, comes before if f - i < r.
    blocked = number_within(_numbers_of(used, key), key, "_f", "_i", width)
    blocked = blocked.select(key, (F.col("_f") - F.col("_i")).alias("_at"), (F.col("_i") + 1).alias("_skip"))
    ranked = numbered.filter(F.col("_r") > 0)
    free = _last_before(ranked, blocked, key, "_r", "_at", "_skip", width)
    renamed = free.withColumn(key, _suffixed(F.col(key), F.col("_r") + F.col("_skip"))).drop("_skip")
    return numbered.filter(F.col("_r") == 0).unionByName(renamed).drop("_no", "_r").select(*df.columns)


def _last_before(rows: DataFrame, marks: DataFrame, key: str, at: str, mark: str, value: str, width: int) -> DataFrame:
    """Add to each row the largest ``value`` of the key's marks that lie at or before it, or 0.

    Values grow along the marks. Rows and marks meet per (key, range), and a range starts with the largest value of
    the ranges before, so a key with very many rows is spread over many tasks.
    """
    ends = marks.groupBy(key, F.floor(F.col(mark) / width).alias("_range")).agg(F.max(value).alias("_end"))
    asked = rows.withColumn("_range", F.floor(F.col(at) / width))
    ranges = asked.select(key, "_range").unionByName(ends.select(key, "_range")).distinct().join(ends, [key, "_range"], "left")
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.max("_end").over(before), F.lit(0))).drop("_end")
    columns = asked.columns
    events = asked.withColumns({"_turn": F.lit(1), value: F.lit(None).cast("bigint"), "_at": F.col(at)})
    stops = marks.select(
        key, F.floor(F.col(mark) / width).alias("_range"), F.lit(0).alias("_turn"), F.col(value).cast("bigint").alias(value), F.col(mark).alias("_at")
    )
    local = Window.partitionBy(key, "_range").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = events.unionByName(stops, allowMissingColumns=True).withColumn("_local", F.max(value).over(local))
    joined = both.filter(F.col("_turn") == 1).join(starts, [key, "_range"])
    found = F.coalesce(F.col("_local"), F.col("_start"))
    return joined.withColumn(value, found).select(*[c for c in columns if c != "_range"], value)


def record_keys(keys: DataFrame, key: str, path: str) -> None:
    """Add a batch's keys to the stored table of taken ones."""
    keys.select(key).write.mode("append").parquet(path)


def taken_keys(spark: SparkSession, key: str, path: str) -> DataFrame:
    """All keys that batches so far have recorded; an empty table before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"`{key}` string")
    return spark.read.schema(f"`{key}` string").parquet(path)
