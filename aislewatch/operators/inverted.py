"""Inverted file for nearest neighbours by cosine (M2, M3, M4 without a scope).

Items lie in cells around centroids that are fitted on a bounded sample; every item is in one cell. A query
first visits its nearest cells. What it finds there bounds the angle within which a better item must lie, and
the triangle inequality on angles then leaves cells out; the exact search visits all others, so two visits
prove the result. The approximate search stops after the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.session import cut_lineage

#: The centroids are fitted on so many bytes of vectors at most, chosen by a hash of the item.
SAMPLE_BYTES = 32 << 20
SAMPLE_ROWS = 20_000
MOST_CELLS = 1024
FIT_ROUNDS = 8
#: Share of the cells that a query visits first.
FIRST_SHARE = 1 / 16
#: Where bounds would leave more than this share of the items in, comparing in blocks is cheaper than cells.
SCAN_SHARE = 0.5
DECIMALS = 6
# Slack on angle bounds: far above rounding errors, far below any useful angle.
_SLACK = 1e-6


def _matrix_of(rows: DataFrame, width: int) -> np.ndarray:
    """Vectors of a bounded number of rows."""
    column = rows.select(F.col("_v").cast("array<double>").alias("_v")).toArrow()["_v"].combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def sample_of(items: DataFrame, width: int, least: int = 1) -> np.ndarray:
    """A bounded, repeatable sample of vectors: the first rows by hash."""
    rows = max(least, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    return _matrix_of(items.orderBy(F.xxhash64("_item"), "_item").limit(rows), width)


def fit_centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids of a sample by spherical k-means, started from its first rows."""
    centroids = sample[:cells].copy()
    for _ in range(FIT_ROUNDS):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def cells_for(count: int) -> int:
    return min(MOST_CELLS, max(1, math.isqrt(count)))


def share_left(queries: DataFrame, sample: np.ndarray, cells: int, k: int, threshold: float | None) -> float:
    """Share of the sample that the bounds of a search would leave in, on average over a few queries by hash."""
    if not len(sample):
        return 0.0
    centroids = fit_centroids(sample, min(cells, len(sample)))
    asked = _matrix_of(queries.orderBy(F.xxhash64("_query"), "_query").limit(64), sample.shape[1])
    if not len(asked):
        return 0.0
    own = np.arccos(np.clip(sample @ centroids.T, -1.0, 1.0))
    cell = own.argmin(axis=1)
    low, high = np.full(len(centroids), np.inf), np.full(len(centroids), -np.inf)
    np.minimum.at(low, cell, own[np.arange(len(cell)), cell])
    np.maximum.at(high, cell, own[np.arange(len(cell)), cell])
    scores = np.sort(asked @ sample.T, axis=1)
    best = scores[:, -min(k, scores.shape[1])]
    best = best if threshold is None else np.maximum(best, threshold)
    angles = np.arccos(np.clip(asked @ centroids.T, -1.0, 1.0))
    bound = np.maximum(np.maximum(angles - high, low - angles), 0.0)
    left = bound <= np.arccos(np.clip(best, -1.0, 1.0))[:, None]
    return float((left @ np.bincount(cell, minlength=len(centroids))).mean() / len(sample))


def _angles(vectors: pd.Series, centroids: np.ndarray) -> np.ndarray:
    stacked = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(stacked, axis=1, keepdims=True)
    return np.arccos(np.clip(stacked @ centroids.T / np.maximum(norms, 1e-300), -1.0, 1.0))


def _with_fields(df: DataFrame, extra: str) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", " + extra


class InvertedFile:
    """Cells of ``items`` (_item, _v), whose vectors are unit vectors of one width, or zero."""

    def __init__(self, items: DataFrame, score_frames, cells: int | None = None, block_rows: int = 4096):
        self.score_frames, self.block_rows = score_frames, block_rows
        items = cut_lineage(items)
        self.count = items.count()
        first = items.select(F.size("_v").alias("n")).first()
        width = first["n"] if first else 1
        wanted = cells or cells_for(self.count)
        self.centroids = fit_centroids(sample_of(items, width, wanted), wanted)
        centroids = items.sparkSession.sparkContext.broadcast(self.centroids)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    angles = _angles(batch["_v"], centroids.value)
                    cell = angles.argmin(axis=1)
                    yield batch.assign(_cell=cell.astype(np.int32), _angle=angles[np.arange(len(batch)), cell])

        self.items = cut_lineage(items.mapInPandas(assign, _with_fields(items, "_cell int, _angle double")))
        # At most MOST_CELLS rows.
        sizes = self.items.groupBy("_cell").agg(F.min("_angle").alias("lo"), F.max("_angle").alias("hi"), F.count("*").alias("n"))
        self.low = np.full(len(self.centroids), np.inf)
        self.high = np.full(len(self.centroids), -np.inf)
        self.sizes = np.zeros(len(self.centroids), np.int64)
        for r in sizes.collect():
            self.low[r["_cell"]], self.high[r["_cell"]], self.sizes[r["_cell"]] = r["lo"], r["hi"], r["n"]

    def search(
        self, queries: DataFrame, k: int, threshold: float | None = None, first_cells: int | None = None, exact: bool = True
    ) -> DataFrame:
        """(_query, _item, _score, _scored): the ``k`` nearest items of each query (_query, _v), ties by item.

        ``_scored`` is the number of pairs that were scored for the query. Without ``exact`` only the
        ``first_cells`` nearest cells are visited, and items elsewhere are missed.
        """
        held = int((self.sizes > 0).sum())
        first = min(held, first_cells or max(1, math.ceil(held * FIRST_SHARE)))
        begun = cut_lineage(self._visit(queries, first, None, threshold))
        found = self._score(begun, k, threshold)
        scored = begun.groupBy("_query").agg(F.sum("_size").alias("_scored"))
        if exact and first < held:
            found = cut_lineage(found)
            # The k-th best score so far; below k finds anything that reaches the threshold may be better.
            worst = found.groupBy("_query").agg(F.min("_score").alias("_worst"), F.count("*").alias("_n"))
            least = F.when(F.col("_n") >= k, F.col("_worst")).otherwise(F.lit(-2.0 if threshold is None else threshold))
            known = queries.join(worst.select("_query", least.alias("_least")), "_query", "left")
            known = known.withColumn("_least", F.coalesce("_least", F.lit(-2.0 if threshold is None else threshold)))
            others = cut_lineage(self._visit(known, first, "_least", threshold).drop("_least"))
            found = found.unionByName(self._score(others, k, threshold))
            scored = begun.unionByName(others).groupBy("_query").agg(F.sum("_size").alias("_scored"))
        order = Window.partitionBy("_query").orderBy(F.col("_score").desc(), "_item")
        best = found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")
        return best.join(scored, "_query")

    def _visit(self, queries: DataFrame, first: int, least: str | None, threshold: float | None) -> DataFrame:
        """One row per query and cell to visit: the nearest ones, or with ``least`` those of the others that may hold
        a score as large."""
        shared = queries.sparkSession.sparkContext.broadcast((self.centroids, self.low, self.high, self.sizes))

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centroids, low, high, sizes = shared.value
            for batch in batches:
                if not len(batch):
                    continue
                angles = _angles(batch["_v"], centroids)
                angles[:, sizes == 0] = np.inf
                near = np.zeros(angles.shape, dtype=bool)
                np.put_along_axis(near, np.argpartition(angles, first - 1, axis=1)[:, :first], True, axis=1)
                if least is not None:
                    # No member of a cell can be nearer than the cell's span of angles allows.
                    bound = np.maximum(np.maximum(angles - high, low - angles), 0.0)
                    wanted = np.clip(batch[least].to_numpy() - 10.0**-DECIMALS, -1.0, 1.0)
                    near = ~near & (sizes > 0) & (bound <= np.arccos(wanted)[:, None] + _SLACK)
                rows, cells = np.nonzero(near)
                yield batch.iloc[rows].assign(_cell=cells.astype(np.int32), _size=sizes[cells])

        return queries.mapInPandas(visit, _with_fields(queries, "_cell int, _size bigint"))

    def _score(self, visits: DataFrame, k: int, threshold: float | None) -> DataFrame:
        """The ``k`` best of each query in each block of items that it visits.

        A cell is cut into blocks and its visitors into chunks, so neither a large cell nor one that all queries
        visit lies in one task.
        """
        chunks = visits.groupBy("_cell").agg(F.ceil(F.count("*") / self.block_rows).cast("int").alias("_chunks"))
        blocks = F.ceil(F.col("_size") / self.block_rows).cast("int")
        left = visits.join(chunks, "_cell").select(
            "_cell", "_query", "_v", F.pmod(F.xxhash64("_query"), F.col("_chunks")).cast("int").alias("_chunk"),
            F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"),
        )
        sizes = self.items.sparkSession.createDataFrame(
            [(c, max(1, math.ceil(int(n) / self.block_rows))) for c, n in enumerate(self.sizes)], "_cell int, _blocks int"
        )
        right = self.items.join(F.broadcast(sizes), "_cell").join(chunks, "_cell").select(
            "_cell", "_item", "_v", F.pmod(F.xxhash64("_item"), F.col("_blocks")).cast("int").alias("_block"),
            F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"),
        )
        key = ["_cell", "_block", "_chunk"]
        types = {n: dict(d.dtypes)[n] for d, n in ((visits, "_query"), (self.items, "_item"))}
        score_frames = self.score_frames

        def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame(columns=["_query", "_item", "_score"])]
            if len(a) and len(b):
                b = b.sort_values("_item", kind="stable", ignore_index=True)
                out = list(score_frames(a.drop(columns=key), b, k, threshold)) or out
            return pd.concat(out, ignore_index=True)[["_query", "_item", "_score"]]

        schema = f"_query {types['_query']}, _item {types['_item']}, _score double"
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(score, schema)
