"""Request logs (S8) and the questions asked of them (L1, L2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_PATTERN = (
    r"^\[([^\]]+)\] Job ID: ([a-f0-9-]+) \| Status: (\w+) \| HTTP: (\d+) \| Result: (\d+) \| Strategy: (.*?) \| URL: (.*)$"
)
FAILED = r"FAILED|BLOCKED|ERROR"


def format_line(at: Column, job_id: Column, status: Column, http: Column, result: Column, strategy: Column, url: Column) -> Column:
    """One log line."""
    return F.concat(
        F.lit("["), F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit("] Job ID: "), job_id, F.lit(" | Status: "), status,
        F.lit(" | HTTP: "), http.cast("string"), F.lit(" | Result: "), result.cast("string"), F.lit(" | Strategy: "), strategy,
        F.lit(" | URL: "), url,
    )


def append_log(lines: DataFrame, path: str) -> None:
    """Append lines (one string column) to the log folder."""
    lines.write.mode("append").text(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_log(spark.read.text(path))


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Typed columns of each line; a line of another form gives NULLs and keeps its text."""
    part = lambda n: F.nullif(F.regexp_extract(value, LINE_PATTERN, n), F.lit(""))
    return lines.withColumns(
        {
            "logged_at": F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss")),
            "job_id": part(2), "status": part(3), "http_status": part(4).try_cast("int"),
            "result_code": part(5).try_cast("int"), "strategy": part(6), "url": part(7),
        }
    )


def recent_job_ids(log: DataFrame, order: str, n: int = 10) -> DataFrame:
    """L1: the last ``n`` distinct job ids, newest first."""
    last = log.filter(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.max(order).alias("last_line"))
    return last.orderBy(F.col("last_line").desc()).limit(n)


def recent_failures(log: DataFrame, order: str, value: str = "value", n: int = 20) -> DataFrame:
    """L2: the last ``n`` failed lines, oldest first."""
    failed = log.filter(F.col(value).rlike(FAILED) & F.col("job_id").isNotNull())
    return failed.orderBy(F.col(order).desc()).limit(n)


def failed_ids(failures: DataFrame, order: str) -> DataFrame:
    """L2: their ids as one string. The input holds at most the lines of a report."""
    listed = F.sort_array(F.collect_list(F.struct(order, "job_id")))["job_id"]
    return failures.agg(F.array_join(listed, ", ").alias("job_ids"), F.count("*").alias("n"))
