"""Hard-negative mining: cover trees over norm-augmented vectors, searched best first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.llm.shared import rows_of, stored
from aislewatch.llm.vectors import checked, is_whole, products, scaled

#: Vectors of one tree, trees that a task holds, anchors that meet them in one task, anchors bounded at once.
TREE_ROWS = 2048
GROUP_TREES = 4
GROUP_ANCHORS = 16384
ANCHOR_RUN = 128
MOST_TASKS = 20_000


@dataclass(frozen=True)
class Mining:
    """What to mine: positives an anchor, negatives a positive, and the window of a negative's score in
    hundredths of the positive's."""

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95


class CoverTree:
    """Cover tree over vectors lifted to one sphere by a further component sqrt(M² - |x|²).

    Level by level the covering radius halves: the members of a node are covered by centres that lie
    farther apart than the next level's radius, the farthest uncovered member first. A node's radius is
    the largest distance of its members. Members that no other shares a cell with are verified from
    their parent's own bucket, as are the members of cells of at most ``LEAF``.
    """

    LEAF = 16

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels = checked(vectors), ids, labels
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        largest = float(norms.max(initial=0.0))
        self.top = largest**0.5
        self.lifted = np.column_stack((vectors, np.sqrt(largest - norms)))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.bucket: list[np.ndarray] = []
        self._grow(np.arange(len(vectors)))
        angle = 2 * np.arcsin(np.minimum(np.array(self.radius) / max(2 * self.top, 1e-300), 1.0))
        self.angle = angle if self.top else np.zeros(len(self.radius))
        self.centres = vectors[self.centre].astype(np.float64)

    def _distances(self, lifted: np.ndarray, centre: int) -> np.ndarray:
        """Distances on the sphere, where |a - b|² = 2 (M² - a·b); good to a ten-millionth of M."""
        return np.sqrt(np.maximum(2 * (self.top**2 - lifted @ self.lifted[centre]), 0.0))

    def _node(self, centre: int, radius: float) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append([])
        self.bucket.append(np.empty(0, np.int64))
        return len(self.centre) - 1

    def _grow(self, members: np.ndarray) -> None:
        far = self._distances(self.lifted, members[0])
        todo = [(self._node(int(members[0]), float(far.max())), members, far, float(far.max()))]
        while todo:
            node, members, least, cover = todo.pop()
            if len(members) <= self.LEAF or self.radius[node] <= 1e-6 * self.top:
                self.bucket[node] = members
                continue
            cover = min(cover, self.radius[node]) / 2
            cell = np.zeros(len(members), np.int64)
            centres, lifted = [self.centre[node]], self.lifted[members]
            while True:
                at = int(least.argmax())
                if least[at] <= cover:
                    break
                far = self._distances(lifted, members[at])
                nearer = far < least
                cell[nearer], least = len(centres), np.minimum(far, least)
                centres.append(int(members[at]))
            order = np.argsort(cell, kind="stable")
            loose = []
            for part in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
                if len(part) == 1:
                    loose.append(members[part])
                    continue
                radius = float(least[part].max())
                child = self._node(centres[cell[part[0]]], radius)
                self.children[node].append(child)
                todo.append((child, members[part], least[part].copy(), cover))
            if loose:
                self.bucket[node] = np.concatenate(loose)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that members of each node can have with each anchor."""
        reach = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))[:, None] * self.top
        cosine = np.clip(anchors.astype(np.float64) @ self.centres.T / np.maximum(reach, 1e-300), -1.0, 1.0)
        theta = np.arccos(cosine)
        slack = 1e-6 * reach + 1e-3
        low = reach * np.cos(np.minimum(theta + self.angle, np.pi)) - slack
        return low, reach * np.cos(np.maximum(theta - self.angle, 0.0)) + slack


class Wanted:
    """The best ``k`` (score, id) of an anchor in a window of scores: higher scores, then smaller ids first."""

    def __init__(self, name, low: int | None, high: int | None, k: int):
        self.name, self.high, self.k = name, high, k
        self.low = low
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    def reached(self, low: float, high: float) -> bool:
        """Whether a node whose scores lie between the bounds can hold a row that is still wanted."""
        return (self.low is None or high >= self.low) and (self.high is None or low <= self.high)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = np.ones(len(scores), bool) if self.low is None else scores >= self.low
        if self.high is not None:
            some &= scores <= self.high
        if not some.any():
            return
        scores, ids = np.concatenate((self.scores, scores[some])), np.concatenate((self.ids, ids[some]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:  # a later row must do at least as well as the last one held
            self.low = int(self.scores[-1])


def search(trees: list[CoverTree], limits: list[tuple], at: int, anchor: dict, wanted: list[Wanted], same: bool) -> None:
    """Descend the trees for one anchor, the node with the largest bound first, into ``wanted``.

    ``limits[t]`` are the bounds of tree t's nodes for a run of anchors, ``at`` the anchor's row in it.
    A node is left out when all that it can score lies outside every window that is still open.
    """
    vector, label = anchor["v"], anchor["label"]
    queue = [(-limits[t][1][at, 0], t, 0) for t in range(len(trees))]
    heapq.heapify(queue)
    while queue:
        bound, t, node = heapq.heappop(queue)
        low, high = limits[t]
        if not any(w.reached(low[at, node], -bound) for w in wanted):
            continue
        tree = trees[t]
        members = tree.bucket[node]
        if len(members):
            labels = tree.labels[members]
            fits = (labels == label) & (tree.ids[members] != anchor["vec_id"]) if same else labels != label
            members = members[fits]
            scores, ids = products(tree.vectors[members], vector), tree.ids[members]
            for w in wanted:
                w.take(scores, ids)
        for child in tree.children[node]:
            if any(w.reached(low[at, child], high[at, child]) for w in wanted):
                heapq.heappush(queue, (-high[at, child], t, child))


_TREE = "tree bigint, ids binary, labels binary, matrix binary, width int"
_FOUND = "anchor_id bigint, name bigint, name_score bigint, vec_id bigint, score bigint"


def taking_part(vectors: DataFrame, label: Column, plan: Mining) -> DataFrame:
    """(vec_id, label, v): rows that take part, one per vec_id, vectors as whole numbers."""
    whole = is_whole(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    row = F.struct(label.cast("bigint").alias("label"), scaled(F.col("embedding"), plan.scale).alias("v"))
    rows = vectors.filter(whole).select(F.col("vec_id").cast("bigint").alias("vec_id"), row.alias("r"))
    return rows.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v")


def grow_trees(rows: DataFrame, count: int) -> DataFrame:
    """Serialised vectors of one tree a row: neighbours by (width, label) in runs of ``TREE_ROWS``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def tree() -> pa.RecordBatch:
            ids = np.array([r["vec_id"] for r in held], np.int64)
            labels = np.array([r["label"] for r in held], np.int64)
            matrix = np.array([r["v"] for r in held], np.int64)
            values = [[number], [ids.tobytes()], [labels.tobytes()], [matrix.tobytes()], [len(held[0]["v"])]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["tree", "ids", "labels", "matrix", "width"])

        for row in rows_of(batches):
            if held and (len(held) == TREE_ROWS or len(row["v"]) != len(held[0]["v"])):
                yield tree()
                number, held = number + 1, []
            held.append(row)
        if held:
            yield tree()

    key = [F.size("v"), F.col("label"), F.xxhash64("vec_id")]
    parts = max(1, min(MOST_TASKS, -(-count // TREE_ROWS)))
    return rows.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(pack, _TREE)


def best_in_trees(trees: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """Rows (anchor_id, name, name_score, vec_id, score): the best ``k`` of each anchor's windows in each group of trees.

    ``anchors`` holds (vec_id, label, v, windows), windows being structs (name, score, low, high). Every
    run of trees meets every run of anchors by key; trees of a task stay in memory, anchors stream past.
    """
    tree_groups = max(1, -(-trees.count() // GROUP_TREES))
    anchor_groups = max(1, -(-anchors.count() // GROUP_ANCHORS))
    of_tree = F.pmod(F.xxhash64("tree"), F.lit(tree_groups)).cast("int")
    of_anchor = F.pmod(F.xxhash64("vec_id"), F.lit(anchor_groups)).cast("int")
    left = trees.select(
        of_tree.alias("tg"), F.explode(F.sequence(F.lit(0), F.lit(anchor_groups - 1))).alias("ag"), F.lit(0).alias("kind"), "*"
    )
    right = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(tree_groups - 1))).alias("tg"), of_anchor.alias("ag"), F.lit(1).alias("kind"), "*"
    )
    both = left.unionByName(right, allowMissingColumns=True)
    parts = min(MOST_TASKS, 2 * tree_groups * anchor_groups)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: list[CoverTree] = []
        run: list[dict] = []
        group = None

        def settle() -> pa.RecordBatch:
            out = []
            for width in {a["v"].shape[0] for a in run}:
                here = [a for a in run if a["v"].shape[0] == width]
                some = [t for t in forest if t.vectors.shape[1] == width]
                limits = [t.bounds(np.array([a["v"] for a in here])) for t in some]
                for at, anchor in enumerate(here):
                    wanted = [Wanted((w["name"], w["score"]), w["low"], w["high"], k) for w in anchor["windows"]]
                    search(some, limits, at, anchor, wanted, same)
                    for w in wanted:
                        out += [(anchor["vec_id"], *w.name, int(i), int(s)) for i, s in zip(w.ids, w.scores, strict=True)]
            run.clear()
            columns = list(zip(*out, strict=True)) or [[]] * 5
            names = ["anchor_id", "name", "name_score", "vec_id", "score"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for row in rows_of(batches, 64):
            if (row["tg"], row["ag"]) != group:
                yield settle()
                forest, group = [], (row["tg"], row["ag"])
            if row["kind"] == 0:
                ids = np.frombuffer(row["ids"], np.int64)
                matrix = np.frombuffer(row["matrix"], np.int64).reshape(len(ids), row["width"])
                forest.append(CoverTree(matrix, ids, np.frombuffer(row["labels"], np.int64)))
                continue
            run.append(row | {"v": np.array(row["v"], np.int64)})
            if len(run) == ANCHOR_RUN:
                yield settle()
        yield settle()

    return both.repartition(parts, "tg", "ag").sortWithinPartitions("tg", "ag", "kind").mapInArrow(mine, _FOUND)


def mine_negatives(vectors: DataFrame, label: Column, is_anchor: Column, plan: Mining = Mining()) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    ``vectors`` holds (vec_id, label, embedding); ``label`` gives the label to use and ``is_anchor`` which
    rows are anchors. Rows with a null vec_id, label or vector, or a null or non-finite component, take
    no part. Of rows that share a vec_id the one with the smallest (label, vector) counts. Vectors of
    another length have no inner product with an anchor and are none of its positives or negatives. Ties
    go to the smaller vec_id. An anchor without positives, or a positive without a negative in its
    window, gives no row; an empty table gives an empty one. Other columns are ignored. Scaled components must
    not exceed 2**26 in size.

    Anchors are a stated share of all rows and are met with all of them in blocks; only the best rows
    of a block leave it. No label, however large, lies in one task: trees are runs of a range order.
    """
    rows = stored(taking_part(vectors, label, plan), "negatives-rows")
    trees = stored(grow_trees(rows, rows.count()), "negatives-trees")
    anchors = rows.filter(is_anchor)
    everything = F.array(F.struct(*(F.lit(None).cast("bigint").alias(c) for c in ("name", "score", "low", "high"))))
    near = best_in_trees(trees, anchors.withColumn("windows", everything), plan.positives, same=True)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= plan.positives)
    score = F.col("score")
    # Whole-number limits of 100 * negative between percents of the positive; a negative positive score has no window.
    window = F.struct(
        F.col("vec_id").alias("name"),
        score.alias("score"),
        F.expr(f"(score * {plan.least_percent} + 99) div 100").alias("low"),
        F.expr(f"(score * {plan.most_percent}) div 100").alias("high"),
    )
    near = near.filter((score >= 0) & (window["low"] <= window["high"]))
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(window)).alias("windows"))
    asked = stored(anchors.join(windows, "vec_id"), "negatives-anchors")
    found = best_in_trees(trees, asked, plan.negatives, same=False)
    first = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= plan.negatives)
    return ranked.select(
        "anchor_id",
        F.col("name").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("name_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


#: The same rows in DuckDB, every anchor against every row.
ORACLE_SQL = """with part as materialized (
  select vec_id, min(r).label as label, min(r).v as v from (
    select vec_id, {'label': case when vec_id % 7 = 0 then (label + 1) % 10 else label end::bigint,
      'v': list_transform(embedding, lambda x: floor(256 * x::double)::bigint)} as r
    from embeddings where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0)
  group by vec_id),
pairs as materialized (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from part a join part b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
positives as materialized (
  select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, (row_number() over w)::int as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 3"""
