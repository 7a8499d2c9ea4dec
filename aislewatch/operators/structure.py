"""Selecting and joining over element rows (H2, H3 on tables instead of inside a row).

Elements are numbered in document order, and an element's descendants are a range of numbers, so that one lies inside
another is a test of intervals. The intervals of one page nest or are apart: a merge in document order with a
stack of the open ones pairs them in one pass. A page that holds a third of all rows is cut into ranges of numbers;
an interval goes to every range it reaches, and a range is merged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.operators.selectors import Step, Test, compiled

#: Numbers of one page that one task merges at a time.
RANGE = 4096


def contained(outer: DataFrame, inner: DataFrame, page: str, low: str, high: str, at: str, nearest: bool = False) -> DataFrame:
    """Pairs (page, ``low``, ``at``) where the point ``at`` of ``inner`` lies in the interval [``low``, ``high``] of ``outer``.

    Intervals of a page nest or are apart, and are told apart by ``low`` and ``high``. With ``nearest`` only the
    innermost interval of each point is paired. Rows with a NULL among these columns take no part; repeated rows count
    once.
    """
    outer = outer.select(page, F.col(low).cast("bigint").alias("_low"), F.col(high).cast("bigint").alias("_high")).dropna().distinct()
    inner = inner.select(page, F.col(at).cast("bigint").alias("_low")).dropna().distinct()
    reach = F.sequence(F.floor(F.col("_low") / RANGE), F.floor(F.col("_high") / RANGE))
    opened = outer.filter(F.col("_low") <= F.col("_high")).select(page, "_low", "_high", F.explode(reach).alias("_range"), F.lit(0).alias("_kind"))
    points = inner.select(
        page, "_low", F.col("_low").alias("_high"), F.floor(F.col("_low") / RANGE).alias("_range"), F.lit(1).alias("_kind")
    )
    # In a range: intervals by their start, the longer one first, then the points there.
    order = [page, "_range", "_low", "_kind", F.col("_high").desc()]
    events = opened.unionByName(points).repartition(page, "_range").sortWithinPartitions(*order)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, stack = None, []
        for batch in batches:
            pages, lows, highs, ranges, kinds = (batch.column(k).to_pylist() for k in range(5))
            rows, starts, points_at = [], [], []
            for n in range(batch.num_rows):
                if (pages[n], ranges[n]) != group:
                    group, stack = (pages[n], ranges[n]), []
                while stack and stack[-1][1] < lows[n]:
                    stack.pop()
                if kinds[n] == 0:
                    stack.append((lows[n], highs[n]))
                    continue
                for start, _ in stack[-1:] if nearest else stack:
                    rows.append(pages[n])
                    starts.append(start)
                    points_at.append(lows[n])
            arrays = [pa.array(rows, batch.schema.field(0).type), pa.array(starts, pa.int64()), pa.array(points_at, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[page, "_outer", "_inner"])

    kind = dict(outer.dtypes)[page]
    pairs = events.mapInArrow(merge, f"`{page}` {kind}, _outer bigint, _inner bigint")
    return pairs.select(page, F.col("_outer").alias(low), F.col("_inner").alias(at))


def _test(test: Test) -> Column:
    held = F.element_at("attrs", test.name)
    if not test.op:
        return held.isNotNull()
    value = test.value.lower() if test.fold else test.value
    held = F.lower(held) if test.fold else held
    if test.op == "=":
        return held == value
    if test.op == "~=":
        return F.array_contains(F.split(held, r"\s+"), value)
    if not value:
        return F.lit(False)
    return {"*=": held.contains, "^=": held.startswith, "$=": held.endswith}[test.op](value)


def _holds(step: Step) -> Column:
    out = F.lit(True) if step.tag is None else F.col("tag") == step.tag
    for test in step.tests:
        out = out & F.coalesce(_test(test), F.lit(False))
    return out


def select_rows(nodes: DataFrame, page: str, selector: str) -> DataFrame:
    """H2 over element rows: the rows of ``node_table`` that a selector names, each once.

    Filters find each step's elements; steps are joined by the page and, inside, by a merge of intervals; as a child,
    by the parent's number; as a sibling, by the parent and the place.
    """
    found = None
    for path in compiled(selector):
        hits = _of_path(nodes, page, path)
        found = hits if found is None else found.unionByName(hits)
    return found.dropDuplicates([page, "node"]) if len(compiled(selector)) > 1 else found


def _of_path(nodes: DataFrame, page: str, path: tuple[Step, ...]) -> DataFrame:
    held = nodes.filter(_holds(path[0]))
    for step in path[1:]:
        here = nodes.filter(_holds(step))
        if step.link == " ":
            # An element lies inside another if its number follows the other's and is not beyond its last one.
            outer = held.select(page, (F.col("node") + 1).alias("_from"), F.col("last").alias("_to"))
            pairs = contained(outer, here, page, "_from", "_to", "node", nearest=True)
            held = here.join(pairs.select(page, F.col("node").cast("int").alias("node")), [page, "node"], "left_semi")
        elif step.link == ">":
            parents = held.select(page, F.col("node").alias("parent"))
            held = here.join(parents, [page, "parent"], "left_semi")
        elif step.link == "+":
            before = held.select(page, "parent", (F.col("pos") + 1).alias("pos"))
            held = here.join(before, [page, "parent", "pos"], "left_semi")
        else:
            first = held.groupBy(page, "parent").agg(F.min("pos").alias("_first"))
            held = here.join(first, [page, "parent"]).filter(F.col("pos") > F.col("_first")).drop("_first")
    return held


def text_of_rows(nodes: DataFrame, texts: DataFrame, page: str) -> DataFrame:
    """H3 over rows: add ``text``, the element's text pieces in order joined by blanks; empty without pieces.

    ``texts`` is ``text_table``. The text of an element is one value of its row, as it is in the page.
    """
    ranges = nodes.select(page, (F.col("t_from") + 1).alias("_from"), F.col("t_to").alias("_to")).filter("_from <= _to").distinct()
    # Elements of the same pieces share a range; ranges of one start are told apart by their end.
    pairs = _in_ranges(ranges, texts, page)
    joined = texts.join(pairs, [page, "at"])
    told = joined.groupBy(page, "_from", "_to").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("_pieces"))
    written = told.select(page, (F.col("_from") - 1).alias("t_from"), F.col("_to").alias("t_to"), F.array_join("_pieces.text", " ").alias("text"))
    return nodes.join(written, [page, "t_from", "t_to"], "left").withColumn("text", F.coalesce("text", F.lit(""))).select(*nodes.columns, "text")


def _in_ranges(ranges: DataFrame, texts: DataFrame, page: str) -> DataFrame:
    """(page, _from, _to, at) for pieces inside ranges: pairs by start, then the ends that reach the piece."""
    widest = ranges.groupBy(page, "_from").agg(F.max("_to").alias("_to"))
    pairs = contained(widest, texts, page, "_from", "_to", "at")
    return pairs.join(ranges, [page, "_from"]).filter(F.col("at") <= F.col("_to")).select(page, "_from", "_to", F.col("at").cast("int").alias("at"))
