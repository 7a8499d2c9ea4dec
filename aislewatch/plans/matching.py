"""Match a reference catalogue's images with a retailer's images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.functions import vectors
from aislewatch.operators import assignment, neighbours
from aislewatch.session import cut_lineage


def candidates(
    db: DataFrame, site: DataFrame, top_k: int = 5, sim_threshold: float = 0.70, scope: Sequence[str] = (), **blocking
) -> DataFrame:
    """M1-M4: the ``top_k`` most similar site images of each db image that reach the threshold.

    Cutting at k and then at the threshold equals the reverse, since both follow the similarity; so the
    threshold goes into the neighbour search, where it also prunes.
    """
    unit = lambda df: df.withColumn("vector", vectors.unit_vector("vector"))
    found = neighbours.nearest(
        unit(db), unit(site), "db_id", "site_id", "vector", top_k, "cosine", sim_threshold, scope, **blocking
    )
    return found.withColumnRenamed("score", "sim")


def match_by_embedding(
    db: DataFrame,
    site: DataFrame,
    inliers: Column | DataFrame,
    top_k: int = 5,
    sim_threshold: float = 0.70,
    min_inliers: int = vectors.DEFAULT_MIN_INLIERS,
    one_to_one: bool = True,
    scope: Sequence[str] = (),
    **blocking,
) -> DataFrame:
    """(db_id, site_id, sim, inliers, status) for every db image.

    ``inliers`` is an expression over a candidate, or a table (db_id, site_id, inliers).
    """
    found = candidates(db, site, top_k, sim_threshold, scope, **blocking)
    if isinstance(inliers, DataFrame):
        found = found.join(inliers, ["db_id", "site_id"], "left")
    else:
        found = found.withColumn("inliers", inliers)
    best = assignment.best_candidate(assignment.judge(found, min_inliers))
    return assignment.split_matches(db, best, one_to_one)


def hash_shortlist(db: DataFrame, site: DataFrame, top_k: int = 12, scope: Sequence[str] = (), **blocking) -> DataFrame:
    """The ``top_k`` nearest site images by differing bits, ties by site order, with their rank.

    Where a hash is missing the distance is a constant, so such db images get the first site images in
    order, and site images without a hash follow all others. Both only matter below ``top_k``
    readable items, and are filled in from bounded lists.
    """
    # Both sides are read several times below, and their hashes may be costly to form.
    db, site = (cut_lineage(side.select(*scope, name, "phash")) for side, name in ((db, "db_id"), (site, "site_id")))
    near = neighbours.nearest(db, site, "db_id", "site_id", "phash", top_k, "hamming", None, scope, **blocking)
    near = near.select(*scope, "db_id", "site_id", F.col("score").cast("int").alias("distance"))
    unread = F.lit(vectors.UNREADABLE_DISTANCE)
    no_hash = _with_first_sites(db.filter(F.col("phash").isNull()), site, scope, top_k)
    no_item = _with_first_sites(db.filter(F.col("phash").isNotNull()), site.filter(F.col("phash").isNull()), scope, top_k)
    filled = no_hash.unionByName(no_item).select(*scope, "db_id", "site_id", unread.alias("distance"))
    order = Window.partitionBy(*scope, "db_id").orderBy("distance", "site_id")
    return near.unionByName(filled).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k)


def _with_first_sites(db: DataFrame, site: DataFrame, scope: Sequence[str], k: int) -> DataFrame:
    """Each db image with the first ``k`` site images of its scope, by order."""
    if not scope:
        ids = [r["site_id"] for r in site.select("site_id").orderBy("site_id").limit(k).collect()]
        listed = F.array(*[F.lit(i) for i in ids]).cast(f"array<{dict(site.dtypes)['site_id']}>")
        return db.select("db_id", F.explode(listed).alias("site_id"))
    order = Window.partitionBy(*scope).orderBy("site_id")
    firsts = site.select(*scope, "site_id").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    return db.select(*scope, "db_id").join(firsts.drop("_r"), list(scope))


def match_by_hash(db: DataFrame, site: DataFrame, evidence: dict[str, Column], top_k: int = 12, **blocking) -> DataFrame:
    """Hash matcher. ``evidence`` gives inliers, ssim and histogram as expressions.

    Its matches carry no similarity and no inliers.
    """
    short = hash_shortlist(db, site, top_k, **blocking).withColumns(evidence)
    accepted = short.filter(
        vectors.hash_accepts(F.col("distance"), F.col("inliers"), F.col("ssim"), F.col("histogram"))
    )
    assigned = assignment.serial_assignment(accepted)
    full = db.select("db_id").join(assigned, "db_id", "left")
    return full.select(
        "db_id",
        "site_id",
        F.lit(0.0).alias("sim"),
        F.lit(0).cast("bigint").alias("inliers"),
        F.when(F.col("site_id").isNotNull(), "match").otherwise("missing").alias("status"),
    )


def match_images(algorithm: str, db: DataFrame, site: DataFrame, **options) -> DataFrame:
    """Choose the matcher by name."""
    matchers = {"resnet50": match_by_embedding, "phash_legacy": match_by_hash}
    if algorithm not in matchers:
        raise ValueError(f"unknown algorithm {algorithm!r}; choose one of {sorted(matchers)}")
    return matchers[algorithm](db, site, **options)
