"""Choosing among candidates and assigning one to one."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions import vectors
from aislewatch.session import cut_lineage


def judge(candidates: DataFrame, min_inliers: int = vectors.DEFAULT_MIN_INLIERS) -> DataFrame:
    """M5, M6: add the trusted inliers, the requirement, and whether a candidate passes."""
    return candidates.withColumn("inliers", vectors.trusted_inliers("sim", "inliers")).withColumns(
        {"required": vectors.required_inliers("sim", default=min_inliers)}
    ).withColumn("passes", F.col("inliers") >= F.col("required"))


def best_candidate(judged: DataFrame) -> DataFrame:
    """M7: one candidate per db image: passing first, then inliers, similarity and site order.

    An aggregate, so candidates combine before they are shuffled.
    """
    order = F.struct(~F.col("passes"), -F.col("inliers"), -F.col("sim"), F.col("site_id"))
    best = F.min_by(F.struct("site_id", "sim", "inliers", "passes"), order)
    return judged.groupBy("db_id").agg(best.alias("_b")).select("db_id", "_b.*")


def one_to_one(best: DataFrame) -> DataFrame:
    """M8: of the passing rows of a site image the first by (similarity, inliers, db order) wins.

    A loser has no second choice, and only passing rows use a site image up, so one aggregate per
    site gives the result of the sequential rule.
    """
    order = F.struct(-F.col("sim"), -F.col("inliers"), F.col("db_id"))
    return best.filter("passes").groupBy("site_id").agg(F.min_by("db_id", order).alias("db_id"))


def split_matches(db: DataFrame, best: DataFrame, exclusive: bool = True) -> DataFrame:
    """Every db image once, with its candidate and ``match`` or ``missing``."""
    if exclusive:
        # Read twice below: a narrow table, cut off from the search that made it.
        best = cut_lineage(best)
        winners = one_to_one(best).select("db_id", F.lit(True).alias("_won"))
        decided = best.join(winners, "db_id", "left")
    else:
        decided = best.withColumn("_won", F.col("passes"))
    full = db.select("db_id").join(decided, "db_id", "left")
    return full.select(
        "db_id",
        "site_id",
        F.coalesce("sim", F.lit(0.0)).alias("sim"),
        F.coalesce("inliers", F.lit(0)).cast("bigint").alias("inliers"),
        F.when(F.coalesce("_won", F.lit(False)), "match").otherwise("missing").alias("status"),
    )


#: Edges that one task settles one after the other.
SETTLED_EDGES = 200_000
#: A round that settles less than this share of the edges is followed by a block in order.
LEAST_SHARE = 0.1


def components(edges: DataFrame) -> DataFrame:
    """Add ``_root``, the smallest db image of the edges' connected component.

    Every site links its dbs to the smallest one. A round points each db to its smallest neighbour, follows the pointers
    to their ends by doubling, and rewrites the links to those ends; pointers lead to smaller dbs, so they have ends. The
    number of steps grows with the logarithm of a component's length.
    """
    edges = cut_lineage(edges)
    lowest = edges.groupBy("site_id").agg(F.min("db_id").alias("b"))
    links = edges.join(lowest, "site_id").select(F.col("db_id").alias("a"), "b").filter("a != b").distinct()
    links = cut_lineage(links)
    roots: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parent = parent.select("node", F.least("node", "least").alias("parent"))
        parent, moving = cut_lineage(parent), True
        while moving:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            jumped = cut_lineage(parent.join(up, "parent").select("node", "parent", "above"))
            moving = not jumped.filter("above < parent").isEmpty()
            parent = jumped.select("node", F.col("above").alias("parent"))
        roots.append(parent)
        of_a = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = links.join(of_a, "a").join(of_b, "b").filter("pa != pb")
        links = cut_lineage(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    found = edges.withColumn("_root", F.col("db_id"))
    for step in roots:
        step = step.select(F.col("node").alias("_root"), F.col("parent").alias("_next"))
        found = found.join(step, "_root", "left").withColumn("_root", F.coalesce("_next", "_root")).drop("_next")
    return found


def _settle(edges: pd.DataFrame) -> pd.DataFrame:
    """The serial rule over some whole components: every db in order takes its first unused site."""
    ordered = edges.sort_values(["db_id", "rank", "site_id"], kind="stable")
    used, held, done = set(), [], None
    for db, site in zip(ordered["db_id"].tolist(), ordered["site_id"].tolist(), strict=True):
        if db != done and site not in used:
            used.add(site)
            held.append((db, site))
            done = db
    return pd.DataFrame(held, columns=["db_id", "site_id"])


def _in_tasks(edges: DataFrame, bucket: Column) -> DataFrame:
    kinds = dict(edges.dtypes)
    schema = f"db_id {kinds['db_id']}, site_id {kinds['site_id']}"
    return edges.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandas(lambda part: _settle(part), schema)


def serial_assignment(edges: DataFrame, settled_edges: int = SETTLED_EDGES) -> DataFrame:
    """Db images in order each take their first accepted unused site image.

    ``edges`` holds accepted (db_id, site_id, rank). Choices depend on each other only within a connected component of
    the edges, so components of at most ``settled_edges`` are settled one after the other, many in a task, however long
    a chain of refusals is. Larger ones are settled in rounds; see ``_in_rounds``.
    """
    edges = cut_lineage(edges.select("db_id", "site_id", "rank"))
    total = edges.count()
    if total <= settled_edges:
        return _in_tasks(edges, F.lit(0))
    rooted = cut_lineage(components(edges))
    large = rooted.groupBy("_root").agg(F.count("*").alias("_n")).filter(F.col("_n") > settled_edges)
    large = cut_lineage(large.select("_root"))  # at most total / settled_edges rows
    small = rooted.join(large, "_root", "left_anti")
    buckets = -(-total // settled_edges)
    found = _in_tasks(small, F.pmod(F.xxhash64("_root"), F.lit(buckets)))
    if large.isEmpty():
        return found
    return found.unionByName(_in_rounds(rooted.join(large, "_root").drop("_root"), settled_edges))


def _in_rounds(edges: DataFrame, settled_edges: int) -> DataFrame:
    """The serial rule over edges that are too many for one task.

    A round gives a site to a db for good when the site is the db's first choice and no earlier db still has an edge to
    it. A round that gives too little is followed by a block: the first dbs that together hold ``settled_edges`` are
    settled one after the other. What remains is settled in one task as soon as it fits, so the number of rounds is
    bounded by the number of edges over ``settled_edges``.
    """
    edges = cut_lineage(edges)
    left, found = edges.count(), []
    while left > settled_edges:
        firsts = edges.groupBy("db_id").agg(F.min_by("site_id", F.struct("rank", "site_id")).alias("site_id"))
        lowest = edges.groupBy("site_id").agg(F.min("db_id").alias("db_id"))
        edges, now, given = _without(edges, firsts.join(lowest, ["db_id", "site_id"]))
        found.append(given)
        if settled_edges < now > left * (1 - LEAST_SHARE):
            # An approximate cut suffices: a block is any number of whole dbs, the first ones in order.
            cut = edges.approxQuantile("db_id", [settled_edges / now], 0.2 * settled_edges / now)[0]
            block = edges.filter(F.col("db_id") <= F.lit(cut))
            edges, now, given = _without(edges, _in_tasks(block, F.lit(0)), block)
            found.append(given)
        left = now
    found.append(_in_tasks(edges, F.lit(0)))
    return reduce(lambda a, b: a.unionByName(b), found)


def _without(edges: DataFrame, given: DataFrame, done: DataFrame | None = None) -> tuple[DataFrame, int, DataFrame]:
    """Edges without the dbs and sites of the pairs given, and without the dbs of ``done``; their number; the pairs."""
    given = cut_lineage(given.select("db_id", "site_id"))
    rest = edges.join(given.select("db_id"), "db_id", "left_anti").join(given.select("site_id"), "site_id", "left_anti")
    if done is not None:
        rest = rest.join(done.select("db_id").distinct(), "db_id", "left_anti")
    rest = cut_lineage(rest)
    return rest, rest.count(), given
