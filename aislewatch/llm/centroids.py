"""Centroid clustering: a vantage-point tree over the centroids finds each vector's nearest one."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewatch.llm.shared import stored
from aislewatch.llm.vectors import checked, is_whole, matrix_of, scaled

#: All centroids together are sent to every task, so their size is bounded.
MOST_CENTROID_BYTES = 64 << 20
#: Entries of the table (vectors of a run, nodes) that a search holds at once.
SEARCH_CELLS = 1 << 20


@dataclass(frozen=True)
class Clustering:
    """What to cluster: vectors of ``width`` components, ``scale`` steps a unit, ``count`` centroids."""

    width: int = 64
    scale: int = 64
    count: int = 16
    rounds: int = 3
    seed: str = "1"


class VantageTree:
    """Vantage-point tree over numbered points with whole coordinates.

    A node holds one point (its vantage) and two halves of the others, nearer and farther ones, each
    with the least and largest distance from the vantage; a leaf holds at most ``LEAF`` points.
    """

    LEAF = 2

    def __init__(self, points: np.ndarray):
        self.points = checked(points)
        self.vantage: list[int] = []
        self.leaf: list[np.ndarray | None] = []
        #: Per node: (child, least distance, largest distance) of its halves.
        self.halves: list[list[tuple[int, float, float]]] = []
        self._build(np.arange(len(points)))

    def _build(self, members: np.ndarray) -> int:
        node = len(self.vantage)
        self.vantage.append(int(members[0]))
        self.leaf.append(members if len(members) <= self.LEAF else None)
        self.halves.append([])
        if self.leaf[node] is None:
            others = members[1:]
            squares = ((self.points[others] - self.points[members[0]]) ** 2).sum(axis=1)
            order = np.argsort(squares, kind="stable")
            others, far = others[order], np.sqrt(squares[order].astype(np.float64))
            middle = len(others) // 2
            for part in (slice(0, middle), slice(middle, None)):
                if len(others[part]):
                    child = self._build(others[part])
                    self.halves[node].append((child, float(far[part][0]), float(far[part][-1])))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest point (ties: the smaller number) and its squared distance, per vector."""
        step = max(1, SEARCH_CELLS // len(self.vantage))
        runs = [self._nearest(vectors[k : k + step]) for k in range(0, len(vectors), step)]
        if not runs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*runs, strict=True))

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        best = np.full(n, len(self.points), np.int64)
        square = np.full(n, np.iinfo(np.int64).max, np.int64)
        #: Least distance that points below an open node can have; closed nodes are infinitely far.
        bound = np.full((n, len(self.vantage)), np.inf)
        bound[:, 0] = 0.0

        def meet(rows: np.ndarray, point: int) -> np.ndarray:
            found = ((vectors[rows] - self.points[point]) ** 2).sum(axis=1)
            better = (found < square[rows]) | ((found == square[rows]) & (point < best[rows]))
            square[rows[better]], best[rows[better]] = found[better], point
            return found

        rows = np.arange(n)
        while len(rows):
            # Each vector opens its own best node, as long as that may hold a point as near as its best.
            node = bound[rows].argmin(axis=1)
            least = bound[rows, node]
            open_ = least <= np.sqrt(square[rows].astype(np.float64)) * (1 + 1e-12) + 1e-6
            rows, node, least = rows[open_], node[open_], least[open_]
            bound[rows, node] = np.inf
            order = np.argsort(node, kind="stable")
            cuts = np.flatnonzero(np.diff(node[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                here, at = rows[part], int(node[part[0]])
                if self.leaf[at] is not None:
                    for point in self.leaf[at]:
                        meet(here, int(point))
                    continue
                far = np.sqrt(meet(here, self.vantage[at]).astype(np.float64))
                for child, low, high in self.halves[at]:
                    # The triangle inequality; a little is taken off for rounding.
                    gap = np.maximum(np.maximum(low - far, far - high) * (1 - 1e-12) - 1e-6, 0.0)
                    bound[here, child] = np.maximum(gap, least[part])
        return best, square


def kept_vectors(vectors: DataFrame, plan: Clustering) -> DataFrame:
    """(vec_id, _v): rows with exactly ``width`` components, none null or non-finite, as whole numbers."""
    whole = is_whole(F.col("embedding")) & (F.size("embedding") == plan.width)
    return vectors.filter(whole).select("vec_id", scaled(F.col("embedding"), plan.scale).alias("_v"))


def first_centroids(kept: DataFrame, plan: Clustering) -> np.ndarray:
    """The kept vectors with the smallest hashes of ``seed:vec_id``, in ascending order of the hash."""
    key = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    drawn = kept.filter("vec_id is not null").select(key.alias("_key"), "_v").orderBy("_key", "_v").limit(plan.count)
    rows = [r["_v"] for r in drawn.collect()]
    return np.array(rows, np.int64).reshape(len(rows), plan.width)


def cluster_sums(kept: DataFrame, centroids: np.ndarray, plan: Clustering) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of the vectors nearest to each centroid; empty ones are left out.

    A task adds up its own vectors, so ``count`` times ``width`` sums leave it; these are added exactly.
    """
    tree = kept.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), plan.width), np.int64)
        for batch in batches:
            rows = matrix_of(batch["_v"], plan.width)
            near, _ = tree.value.nearest(rows)
            n += np.bincount(near, minlength=len(n))
            np.add.at(total, near, rows)
        used = np.flatnonzero(n)
        cells = [np.repeat(used, plan.width), np.tile(np.arange(plan.width), len(used)), np.repeat(n[used], plan.width)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cells, total[used].ravel())], ["cluster", "at", "n", "s"])

    sums = kept.select("_v").mapInArrow(add, "cluster bigint, at bigint, n bigint, s bigint").groupBy("cluster", "at")
    found: dict[int, tuple[int, list[int]]] = {}
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("cluster", "at").collect():
        found.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["s"]))
    return found


def assign(kept: DataFrame, centroids: np.ndarray, plan: Clustering) -> DataFrame:
    """(vec_id, cluster, distance): each vector's nearest centroid and squared distance."""
    tree = kept.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, square = tree.value.nearest(matrix_of(batch["_v"], plan.width))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(square)], ["vec_id", "cluster", "distance"]
            )

    id_type = kept.schema["vec_id"].dataType
    schema = T.StructType([
        T.StructField("vec_id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())
    ])
    return kept.select("vec_id", "_v").mapInArrow(near, schema)


def cluster(vectors: DataFrame, plan: Clustering = Clustering()) -> DataFrame:
    """Cluster vectors around centroids: one row (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256) per kept vector.

    Vectors that are null, have another number of components, or hold a null or non-finite component
    are left out. Rows that repeat are vectors of their own, assigned alike; a vector without vec_id is
    clustered but cannot start as a centroid, and equal ids start in the order of their vectors. Fewer
    kept vectors than centroids give fewer centroids, none an empty table. Ties go to the smaller
    number; an empty centroid stays where it was. Other columns are ignored. Scaled components must
    not exceed 2**26 in size; larger ones raise an error. Centroids go to every task: their number is
    a parameter, and more than 64 MB of them raise an error.
    """
    if plan.count * plan.width * 8 > MOST_CENTROID_BYTES:
        raise ValueError("the centroids are too large to be sent to every task")
    kept = stored(kept_vectors(vectors, plan), "centroid-vectors")
    centroids = first_centroids(kept, plan)
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], _result_type(kept))
    for _ in range(plan.rounds):
        for k, (n, sums) in cluster_sums(kept, centroids, plan).items():
            centroids[k] = [s // n for s in sums]
    found = stored(assign(kept, centroids, plan), "centroid-clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    table = kept.sparkSession.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], sum(x["cluster_inertia"] for x in per), digests[r["cluster"]]) for r in per],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    # One row per centroid, whose number is a checked parameter.
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _result_type(kept: DataFrame) -> T.StructType:
    names = [("cluster", T.IntegerType()), ("distance", T.LongType()), ("cluster_inertia", T.LongType())]
    names += [("inertia", T.LongType()), ("centroid_sha256", T.StringType())]
    return T.StructType([T.StructField("vec_id", kept.schema["vec_id"].dataType), *(T.StructField(n, t) for n, t in names)])


def oracle_sql(plan: Clustering = Clustering()) -> str:
    """The same rows in DuckDB: every vector against every centroid, round by round."""
    square = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    parts = [
        f"""kept as materialized (
  select row_number() over () as rid, vec_id, v from (
    select vec_id, list_transform(embedding, lambda x: floor({plan.scale} * x::double)::bigint) as v from embeddings
    where len(embedding) = {plan.width}
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0))""",
        f"""c0 as materialized (
  select row_number() over (order by h, v) - 1 as k, v as c
  from (select sha256('{plan.seed}:' || vec_id) as h, v from kept where vec_id is not null)
  qualify row_number() over (order by h, v) <= {plan.count})""",
    ]
    for r in range(plan.rounds + 1):
        parts.append(
            f"""a{r} as materialized (
  select rid, vec_id, v, arg_min(k, (d, k)) as k, min(d) as d from (
    select rid, vec_id, v, k, {square} as d from kept cross join c{r})
  group by rid, vec_id, v)"""
        )
        if r < plan.rounds:
            parts.append(
                f"""c{r + 1} as materialized (
  select o.k, coalesce(m.c, o.c) as c from c{r} o left join (
    select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from (
      select k, i, sum(x) as s, count(*) as n from (select k, unnest(v) as x, generate_subscripts(v, 1) as i from a{r})
      group by k, i)
    group by k) m on o.k = m.k)"""
            )
    last = plan.rounds
    return f"""with {", ".join(parts)}
select a.vec_id, a.k::int as cluster, a.d as distance,
  sum(a.d) over (partition by a.k)::bigint as cluster_inertia, sum(a.d) over ()::bigint as inertia,
  sha256(list_reduce(list_transform(c.c, lambda x: x::varchar), lambda p, q: p || ',' || q)) as centroid_sha256
from a{last} a join c{last} c on a.k = c.k"""
