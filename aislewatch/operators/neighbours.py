"""Exact k-nearest neighbours of two image tables.

Nothing here forms the cross product of rows. Both sides are cut into blocks of bounded size; Spark
brings block pairs together by key, one matrix product scores a pair, and only the k best of each
query row leave it. What keeps the work down, all of it exact:

* a scope (images of one product) is the normal case: only rows of one scope meet;
* without one the item side travels as a broadcast matrix while its size, as sent, stays under a limit;
* beyond it items lie in the cells of an inverted file (cosine) or the buckets of a multi-index (bits), and a
  query visits only those that bounds cannot rule out;
* equal vectors are scored once: for ties only the first k items of equal vector can be chosen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.operators.hashing import nearest_hashes, share_met
from aislewatch.operators.inverted import DECIMALS, SCAN_SHARE, InvertedFile, cells_for, sample_of, share_left
from aislewatch.session import cut_lineage, spread

BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 4096
#: Pieces of a side grow to so many rows, or bytes of matrix, before there are more than MOST_SMALL of them: a row is sent
#: once per piece of the other side.
PIECE_ROWS, PIECE_BYTES, MOST_SMALL = 65_536, 64 * 1024 * 1024, 8
#: Partitions for each meeting of a chunk and a block, so that few meetings share one.
MEETING_SPREAD = 4
# Items that are scored at once, and in the first tile: the tiles grow as the bound gets sharper.
_TILE, _FIRST_TILE = 4096, 512


def _matrix(vectors: pd.Series, metric: str) -> np.ndarray:
    stacked = np.stack([np.asarray(v) for v in vectors])
    if metric == "hamming":
        # Words to bits, bits to signs: the distance is then a matrix product too.
        bits = np.unpackbits(np.ascontiguousarray(stacked.astype(np.int64)).view(np.uint8), axis=1)
        return bits.astype(np.float32) * 2 - 1
    return stacked.astype(np.float64)


def _raw(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """What grows with nearness and is cheap to form for all pairs; ``_exact`` turns chosen ones into scores."""
    product = x @ y.T
    if metric != "l2":
        return product
    return -((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * product)


def _exact(raw: np.ndarray, width: int, metric: str) -> np.ndarray:
    """Scores where larger is nearer."""
    if metric == "cosine":
        return np.round(raw, DECIMALS)
    if metric == "hamming":
        return -np.rint((width - raw) / 2).astype(np.float64)
    return -np.round(np.sqrt(np.maximum(-raw, 0)), DECIMALS)


def _least_raw(scores: np.ndarray, width: int, metric: str) -> np.ndarray:
    """A bound that the raw values of all pairs with at least these scores reach, rounding included."""
    if metric == "hamming":
        return width + 2 * scores - 0.5
    if metric == "cosine":
        return scores - 10.0**-DECIMALS
    far = -scores + 10.0**-DECIMALS
    return np.where(np.isinf(scores), -np.inf, -far * far - 1e-9)


def _few(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, in order; the earlier column wins a tie."""
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    chosen = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[chosen], cols[chosen], scores[chosen]


def _places(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` of a matrix with few true cells, eight cells at a look."""
    flat = keep.reshape(-1)
    if len(flat) % 8:
        return np.nonzero(keep)
    eights = np.flatnonzero(flat.view(np.uint64))
    found, at = np.nonzero(flat.reshape(-1, 8)[eights])
    return np.divmod(eights[found] * 8 + at, keep.shape[1])


def _single_slack(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """What a product in single precision may lack of the exact one, per row of ``x``; None where that is no use."""
    norms = [np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (x, y)]
    if not all(n.max(initial=0) < 1e9 for n in norms):  # NaN too
        return None
    # Twice the bound on the error of a sum of so many products of rounded factors.
    return (x.shape[1] + 4) * 2.0**-22 * norms[0] * norms[1].max(initial=0) + 1e-30


def _best(x: np.ndarray, y: np.ndarray, k: int, metric: str, threshold: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and column numbers and scores of the k best columns of each row.

    Columns are met in tiles; the k-th best so far is the bound that a later pair must reach to be looked at.
    Cosine products are formed in single precision first; those that may reach the bound, exactly.
    """
    width = x.shape[1]
    none = np.zeros(0, np.int64)
    found = (none, none, np.zeros(0))
    least = np.full(len(x), -np.inf if threshold is None else threshold)
    slack = _single_slack(x, y) if metric == "cosine" else None
    left = x if slack is None else x.astype(np.float32)
    slack = np.zeros(len(x)) if slack is None else slack
    # Room for a tile's products and marks, used again for each tile.
    room = np.empty(len(x) * min(_TILE, len(y)), np.result_type(left, np.float32))
    marks = np.empty(len(room), bool)
    at, size = 0, min(_TILE, _FIRST_TILE)
    while at < len(y):
        tile = y[at : at + size]
        shape = (len(x), len(tile))
        if metric == "l2":
            raw = _raw(x, tile, metric)
        else:
            raw = np.matmul(left, tile.astype(left.dtype, copy=False).T, out=room[: shape[0] * shape[1]].reshape(shape))
        bound = _least_raw(least, width, metric)
        if at == 0 and raw.shape[1] > k:
            kth = np.partition(raw, raw.shape[1] - k, axis=1)[:, raw.shape[1] - k] - slack
            bound = np.maximum(bound, _least_raw(_exact(kth, width, metric), width, metric))
        # Rounded down, so that single precision keeps what may reach the bound.
        bound = np.nextafter((bound - slack).astype(raw.dtype), raw.dtype.type(-np.inf))
        rows, cols = _places(np.greater_equal(raw, bound[:, None], out=marks[: raw.size].reshape(shape)))
        if len(rows):
            exact = raw[rows, cols] if left is x else np.einsum("ij,ij->i", x[rows], tile[cols])
            scores = _exact(exact, width, metric)
            fits = scores >= least[rows]
            rows, cols, scores = rows[fits], cols[fits] + at, scores[fits]
            found = _few(*(np.concatenate(both) for both in zip(found, (rows, cols, scores), strict=True)), k)
            counts = np.bincount(found[0], minlength=len(x))
            ends = np.cumsum(counts) - 1
            full = counts >= k
            least[full] = found[2][ends[full]]
        at, size = at + len(tile), min(_TILE, at + len(tile))
    return found


def _score_frames(
    queries: pd.DataFrame, items: pd.DataFrame, y: np.ndarray, k: int, metric: str, threshold: float | None
) -> Iterator[pd.DataFrame]:
    """Score queries against one item matrix, in tiles that bound the score matrix to 32 MB."""
    step = max(1, (4 * 1024 * 1024) // max(1, min(len(items), _TILE)))
    ids = items["_item"].to_numpy()
    for at in range(0, len(queries), step):
        part = queries.iloc[at : at + step]
        rows, cols, scores = _best(_matrix(part["_v"], metric), y, k, metric, threshold)
        out = part.iloc[rows].drop(columns=["_v"]).reset_index(drop=True)
        out["_item"] = ids[cols]
        out["_score"] = scores
        yield out


def nearest(
    queries: DataFrame,
    items: DataFrame,
    query_id: str,
    item_id: str,
    vector: str,
    k: int,
    metric: str = "cosine",
    threshold: float | None = None,
    scope: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
    scan_share: float | None = 1.0,
) -> DataFrame:
    """The k nearest items of each query, ties by item id: (scope, query, item, score).

    ``metric`` is ``cosine`` on unit vectors (larger is nearer, with an optional lower ``threshold``),
    ``l2``, or ``hamming`` on arrays of 64-bit words. Rows without a vector take no part. ``scope``
    restricts neighbours to the same product, image pair or the like. ``scan_share`` is that of
    ``hashing.nearest_hashes``. Building the plan runs jobs: the search is adapted to what it measures.
    """
    scope = list(scope)
    q = queries.filter(F.col(vector).isNotNull()).select(*scope, F.col(query_id).alias("_query"), F.col(vector).alias("_v"))
    # Both sides may descend from one table, so the scope columns get an identity of their own.
    i = items.filter(F.col(vector).isNotNull()).select(*[F.col(c).alias(c) for c in scope], F.col(item_id).alias("_item"), F.col(vector).alias("_v"))
    id_type = {n: dict(d.dtypes)[n] for d, n in ((q, "_query"), (i, "_item"))}
    fields = [f"`{c}` {dict(q.dtypes)[c]}" for c in scope]
    schema = ", ".join(fields + [f"_query {id_type['_query']}", f"_item {id_type['_item']}", "_score double"])

    found = None
    if not scope:
        found = _by_broadcast(q, i, schema, k, metric, threshold, broadcast_bytes)
        if found is None and metric == "cosine":
            found = _by_index(q, i, k, lambda a, b: _by_cells(a, b, k, threshold, block_rows))
        elif found is None and metric == "hamming":
            found = _by_index(q, i, k, lambda a, b: _by_hashes(a, b, k, block_rows, scan_share))
    if found is None:
        found = _by_blocks(q, i, schema, k, metric, threshold, scope, block_rows)
    score = F.col("_score") if metric == "cosine" else -F.col("_score")
    return found.select(*scope, F.col("_query").alias(query_id), F.col("_item").alias(item_id), score.alias("score"))


def _by_index(q: DataFrame, i: DataFrame, k: int, search) -> DataFrame:
    """Search one query per distinct vector among the first ``k`` items of each, and hand the result to all alike."""
    q, i = cut_lineage(q), cut_lineage(i)
    distinct_q = cut_lineage(q.groupBy("_v").agg(F.min("_query").alias("_lead")))
    same = Window.partitionBy("_v").orderBy("_item")
    few = cut_lineage(i.withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k).drop("_r"))
    best = search(distinct_q.select(F.col("_lead").alias("_query"), "_v"), few)
    members = q.join(distinct_q, "_v").select("_query", "_lead")
    return members.join(best.withColumnRenamed("_query", "_lead"), "_lead").select("_query", "_item", "_score")


def cosine_frames(queries: pd.DataFrame, items: pd.DataFrame, k: int, threshold: float | None) -> Iterator[pd.DataFrame]:
    """The ``k`` most similar items of each query; both sides in frames (_query or _item, _v), items in order."""
    return _score_frames(queries, items, _matrix(items["_v"], "cosine"), k, "cosine", threshold)


def _by_cells(q: DataFrame, i: DataFrame, k: int, threshold: float | None, block_rows: int) -> DataFrame:
    """Through the cells of an inverted file; in blocks where a sample shows that bounds would rule little out."""
    count, first = i.count(), i.select(F.size("_v").alias("n")).first()
    schema = f"_query {dict(q.dtypes)['_query']}, _item {dict(i.dtypes)['_item']}, _score double"
    if first and share_left(q, sample_of(i, first["n"]), cells_for(count), k, threshold) > SCAN_SHARE:
        found = _pairs_of_blocks(q, i, schema, k, "cosine", threshold, [], block_rows)
        return found.select("_query", "_item", "_score")
    return InvertedFile(i, cosine_frames, block_rows=block_rows).search(q, k, threshold).drop("_scored")


def _by_hashes(q: DataFrame, i: DataFrame, k: int, block_rows: int, scan_share: float | None) -> DataFrame:
    kinds = (dict(q.dtypes)["_query"], dict(i.dtypes)["_item"])
    schema = f"_query {kinds[0]}, _item {kinds[1]}, _score double"

    def scan(queries: DataFrame, items: DataFrame) -> DataFrame:
        found = _pairs_of_blocks(queries, items, schema, k, "hamming", None, [], block_rows)
        return found.select("_query", "_item", (-F.col("_score")).cast("int").alias("_distance"))

    if scan_share is not None and share_met(q, i, k) > scan_share:
        found = scan(q, i)
    else:
        found = nearest_hashes(q, i, k, scan, scan_share)
    return found.select("_query", "_item", (-F.col("_distance")).cast("double").alias("_score"))


def _by_broadcast(q, i, schema, k, metric, threshold, limit) -> DataFrame | None:
    """Item matrix on every executor, if its size as sent allows; queries then never move."""
    # A word of a hash is sent as 64 signs of four bytes.
    width = 64 * 4 if metric == "hamming" else 8
    size = i.select(F.sum(F.size("_v") * width + 16).alias("bytes")).first()["bytes"] or 0
    if size > limit:
        return None
    frame = i.toPandas().sort_values("_item", kind="stable", ignore_index=True)
    if frame.empty:
        return q.sparkSession.createDataFrame([], schema)
    shared = q.sparkSession.sparkContext.broadcast((frame[["_item"]], _matrix(frame["_v"], metric)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, y = shared.value
        for batch in batches:
            if len(batch):
                yield from _score_frames(batch, ids, y, k, metric, threshold)

    return spread(q).mapInPandas(score, schema)


def _by_blocks(q, i, schema, k, metric, threshold, scope, block_rows) -> DataFrame:
    # Each side is read several times below, and may be a costly query itself.
    q, i = cut_lineage(q), cut_lineage(i)
    # Equal vectors: queries are scored once, and of equal items only the first k can be chosen.
    distinct_q = q.groupBy(*scope, "_v").agg(F.min("_query").alias("_lead"))
    leads = distinct_q.select(*scope, F.col("_lead").alias("_query"), "_v")
    same = Window.partitionBy(*scope, "_v").orderBy("_item")
    i = i.withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k).drop("_r")
    best = _pairs_of_blocks(leads, i, schema, k, metric, threshold, scope, block_rows)

    # Hand the result of each distinct query vector to every query that has it.
    members = q.join(distinct_q, [*scope, "_v"]).select(*scope, "_query", "_lead")
    return members.join(best.withColumnRenamed("_query", "_lead"), [*scope, "_lead"]).select(*scope, "_query", "_item", "_score")


def _pairs_of_blocks(leads, i, schema, k, metric, threshold, scope, block_rows) -> DataFrame:
    """The ``k`` best items of distinct queries: chunks of queries meet blocks of items by key."""

    first = i.select(F.size("_v").alias("n")).first()
    width = (first["n"] if first else 1) * (64 * 4 if metric == "hamming" else 8)
    most_rows = max(block_rows, min(PIECE_ROWS, PIECE_BYTES // width))

    def pieces(rows: Column) -> Column:
        small = F.least(F.ceil(rows / block_rows), F.lit(MOST_SMALL))
        return F.greatest(small, F.ceil(rows / most_rows), F.lit(1)).cast("int")

    # Both sides are cut into pieces per scope: queries into chunks, items into blocks.
    total = leads.count()
    meetings = None
    if scope:
        blocks = i.groupBy(*scope).agg(pieces(F.count("*")).alias("_blocks"))
        chunks = leads.groupBy(*scope).agg(pieces(F.count("*")).alias("_chunks"))
        per_scope = chunks.join(blocks, scope)
        i, leads = i.join(per_scope, scope), leads.join(per_scope, scope)
        bucket = F.pmod(F.xxhash64(*scope), F.lit(max(1, math.ceil(total / block_rows))))
    else:
        whole = {"_chunks": pieces(F.lit(total)), "_blocks": pieces(F.lit(i.count()))}
        meetings = i.sparkSession.range(1).select((whole["_chunks"] * whole["_blocks"]).alias("n")).first()["n"]
        i, leads = i.withColumns(whole), leads.withColumns(whole)
        bucket = F.lit(0).cast("bigint")

    key = ["_bucket", "_block", "_chunk"]
    left = leads.select(
        *scope, "_query", "_v", bucket.alias("_bucket"),
        F.pmod(F.xxhash64("_query"), F.col("_chunks")).cast("int").alias("_chunk"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"),
    )
    right = i.select(
        *[F.col(c).alias(c) for c in scope], "_item", "_v", bucket.alias("_bucket"),
        F.pmod(F.xxhash64("_item"), F.col("_blocks")).cast("int").alias("_block"),
        F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"),
    )

    if meetings is not None:
        # Blocks are small as sent and long to compare: each meeting is a task of its own, or nearly, and none waits in a
        # task that was put together by size.
        left, right = (side.repartition(MEETING_SPREAD * meetings, *key) for side in (left, right))

    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.drop(columns=key), b.drop(columns=key)
        out = [pd.DataFrame(columns=[*scope, "_query", "_item", "_score"])]
        if len(a) and len(b):
            groups = a.groupby(scope, sort=False) if scope else [((), a)]
            lots = {s: g for s, g in b.groupby(scope, sort=False)} if scope else {(): b}
            for at, part in groups:
                lot = lots.get(at)
                if lot is not None:
                    lot = lot.sort_values("_item", kind="stable", ignore_index=True)
                    out += _score_frames(part, lot, _matrix(lot["_v"], metric), k, metric, threshold)
        out = [o for o in out if len(o)] or out
        return pd.concat(out, ignore_index=True)[[*scope, "_query", "_item", "_score"]]

    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(score, schema)
    top = Window.partitionBy(*scope, "_query").orderBy(F.col("_score").desc(), "_item")
    return best.withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= k).drop("_r")


def ratio_test(
    pairs: DataFrame, descriptors: DataFrame, ratio: float = 0.75, least: int = 8, floor_zero: bool = False, enough: int = 4
) -> DataFrame:
    """Good descriptor matches of image pairs (a_id, b_id).

    Of each descriptor of image a the two nearest of image b are found; it is good when the first is
    nearer than ``ratio`` times the second. Below ``least`` good ones the count stands, or is zero
    with ``floor_zero``. Images with fewer than ``enough`` descriptors score zero.
    """
    sizes = descriptors.groupBy("image_id").agg(F.count("*").alias("n"))
    known = (
        pairs.join(sizes.select(F.col("image_id").alias("a_id"), F.col("n").alias("n_a")), "a_id", "left")
        .join(sizes.select(F.col("image_id").alias("b_id"), F.col("n").alias("n_b")), "b_id", "left")
        .withColumn("usable", (F.coalesce("n_a", F.lit(0)) >= enough) & (F.coalesce("n_b", F.lit(0)) >= enough))
    )
    known = cut_lineage(known.select("a_id", "b_id", "usable"))
    usable = known.filter("usable").select("a_id", "b_id")
    side = lambda end, out: usable.join(
        descriptors.select(F.col("image_id").alias(end), F.col("descriptor_no").alias(out), "descriptor"), end
    )
    two = nearest(
        side("a_id", "a_no"), side("b_id", "b_no"), "a_no", "b_no", "descriptor", 2, metric="l2", scope=["a_id", "b_id"]
    )
    good = (
        two.groupBy("a_id", "b_id", "a_no")
        .agg(F.min("score").alias("d1"), F.max("score").alias("d2"), F.count("*").alias("n"))
        .filter((F.col("n") == 2) & (F.col("d1") < ratio * F.col("d2")))
        .groupBy("a_id", "b_id")
        .agg(F.count("*").alias("good"))
    )
    count = F.coalesce("good", F.lit(0).cast("bigint"))
    if floor_zero:
        count = F.when(count < least, F.lit(0).cast("bigint")).otherwise(count)
    return known.join(good, ["a_id", "b_id"], "left").select("a_id", "b_id", count.alias("good_matches"))


def histogram_similarity(pairs: DataFrame, histograms: DataFrame) -> DataFrame:
    """Mean over channels of the correlation of two images' histograms.

    ``histograms`` has (image_id, channel, bins); the correlation is one pass over two short arrays.
    """
    a = histograms.select(F.col("image_id").alias("a_id"), "channel", F.col("bins").alias("x"))
    b = histograms.select(F.col("image_id").alias("b_id"), "channel", F.col("bins").alias("y"))
    joined = pairs.join(a, "a_id").join(b, ["b_id", "channel"])
    return (
        joined.withColumn("r", _correlation(F.col("x"), F.col("y")))
        .groupBy("a_id", "b_id")
        .agg(F.avg("r").alias("histogram"))
    )


def _correlation(x: Column, y: Column) -> Column:
    zipped = F.zip_with(x, y, lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("n", "a", "b", "aa", "bb", "ab")])
    sums = F.aggregate(
        zipped,
        zero,
        lambda s, e: F.struct(
            (s["n"] + 1).alias("n"), (s["a"] + e["a"]).alias("a"), (s["b"] + e["b"]).alias("b"),
            (s["aa"] + e["a"] * e["a"]).alias("aa"), (s["bb"] + e["b"] * e["b"]).alias("bb"),
            (s["ab"] + e["a"] * e["b"]).alias("ab"),
        ),
        lambda s: (s["n"] * s["ab"] - s["a"] * s["b"])
        / F.sqrt((s["n"] * s["aa"] - s["a"] * s["a"]) * (s["n"] * s["bb"] - s["b"] * s["b"])),
    )
    return sums
