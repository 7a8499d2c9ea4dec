"""M1-M17 on embeddings: the catalogue side is every vector, the retailer side blends each vector
with the one before it, so that true matches, conflicts and misses all occur."""

from pyspark.sql import functions as F

from aislewatch.catalogue.registry import register
from aislewatch.functions import vectors
from aislewatch.operators import assignment, neighbours
from aislewatch.plans import matching

DB_FEED = "SELECT vec_id AS db_id, label, transform(embedding, x -> CAST(x AS DOUBLE)) AS vector FROM embeddings"
SITE_FEED = """
SELECT b.vec_id AS site_id, b.label, zip_with(coalesce(a.embedding, b.embedding), b.embedding, (x, y) -> w * CAST(x AS DOUBLE) + (1 - w) * CAST(y AS DOUBLE)) AS vector
FROM (SELECT *, CAST(40 + 12 * (floor(vec_id / 2) % 5) AS DOUBLE) / 100 AS w FROM embeddings) b LEFT JOIN embeddings a ON a.vec_id = b.vec_id - 1
"""


def _inliers():
    """Stand-in for counted inliers, which are an input of matching."""
    return (F.col("db_id") * 7 + F.col("site_id") * 13) % 30


_UNIT = "list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-8))"
SIDES = f"""
db0 AS (SELECT vec_id AS db_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
site0 AS (SELECT b.vec_id AS site_id, b.label, list_transform(list_zip(coalesce(a.embedding, b.embedding), b.embedding), lambda z: w * CAST(z[1] AS DOUBLE) + (1 - w) * CAST(z[2] AS DOUBLE)) AS v
  FROM (SELECT *, CAST(40 + 12 * (floor(vec_id / 2) % 5) AS DOUBLE) / 100 AS w FROM embeddings) b LEFT JOIN embeddings a ON a.vec_id = b.vec_id - 1),
db AS (SELECT db_id, label, v AS raw, {_UNIT} AS v FROM db0), site AS (SELECT site_id, label, v AS raw, {_UNIT} AS v FROM site0)"""
PAIRS = f"""{SIDES},
pairs AS (SELECT db_id, site_id, db.label AS label, site.label AS site_label, round(list_inner_product(db.v, site.v), 6) AS sim FROM db, site),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db_id ORDER BY sim DESC, site_id) AS r FROM pairs) WHERE r <= 5)"""
_REQUIRED = "CASE WHEN sim >= 0.95 THEN 8 WHEN sim >= 0.90 THEN 12 WHEN sim >= 0.80 THEN 15 WHEN sim >= 0.70 THEN 20 ELSE 15 END"
JUDGED = f"""{PAIRS},
judged AS (SELECT *, inliers >= required AS passes FROM (SELECT *, CASE WHEN sim >= 0.94 THEN 999 ELSE (db_id * 7 + site_id * 13) % 30 END AS inliers, {_REQUIRED} AS required FROM top WHERE sim >= 0.70)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db_id ORDER BY passes DESC, inliers DESC, sim DESC, r) AS k FROM judged) WHERE k = 1),
winners AS (SELECT db_id FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY sim DESC, inliers DESC, db_id) AS k FROM best WHERE passes) WHERE k = 1)"""


def _db(t):
    return t.feed(DB_FEED)


def _site(t):
    return t.feed(SITE_FEED)


@register("M1_unit_vector", f"WITH {SIDES} SELECT site_id, round(v[1], 6) AS first_part, round(v[64], 6) AS last_part FROM site")
def m1(t):
    unit = _site(t).withColumn("u", vectors.unit_vector("vector"))
    return unit.select("site_id", F.round(F.col("u")[0], 6).alias("first_part"), F.round(F.col("u")[63], 6).alias("last_part"))


def _unit(df):
    return df.withColumn("vector", vectors.unit_vector("vector"))


@register(
    "M2_best_cosine",
    f"WITH {PAIRS} SELECT db_id, site_id, sim FROM top WHERE r = 1",
)
def m2(t):
    found = neighbours.nearest(_unit(_db(t)), _unit(_site(t)), "db_id", "site_id", "vector", 1)
    return found.withColumnRenamed("score", "sim")


@register("M3_top_five", f"WITH {PAIRS} SELECT db_id, site_id, sim FROM top")
def m3(t):
    found = neighbours.nearest(_unit(_db(t)), _unit(_site(t)), "db_id", "site_id", "vector", 5, broadcast_bytes=0, block_rows=512)
    return found.withColumnRenamed("score", "sim")


@register("M4_candidates", f"WITH {PAIRS} SELECT db_id, site_id, sim FROM top WHERE sim >= 0.70")
def m4(t):
    return matching.candidates(_db(t), _site(t), broadcast_bytes=0, block_rows=512)


@register(
    "M5_required_inliers",
    f"WITH {JUDGED} SELECT db_id, site_id, CAST(required AS BIGINT) AS required, CAST({_REQUIRED.replace('sim', '(sim - 0.1)')} AS BIGINT) AS lower_required FROM judged",
)
def m5(t):
    return matching.candidates(_db(t), _site(t)).select(
        "db_id",
        "site_id",
        vectors.required_inliers("sim").cast("bigint").alias("required"),
        vectors.required_inliers(F.round(F.col("sim") - 0.1, 6)).cast("bigint").alias("lower_required"),
    )


@register("M6_trusted_inliers", f"WITH {JUDGED} SELECT db_id, site_id, CAST(inliers AS BIGINT) AS inliers FROM judged")
def m6(t):
    return matching.candidates(_db(t), _site(t)).select(
        "db_id", "site_id", vectors.trusted_inliers("sim", _inliers()).cast("bigint").alias("inliers")
    )


def _best(t):
    found = matching.candidates(_db(t), _site(t)).withColumn("inliers", _inliers())
    return assignment.best_candidate(assignment.judge(found))


@register("M7_best_candidate", f"WITH {JUDGED} SELECT db_id, site_id, sim, CAST(inliers AS BIGINT) AS inliers, passes FROM best")
def m7(t):
    return _best(t).select("db_id", "site_id", "sim", F.col("inliers").cast("bigint").alias("inliers"), "passes")


@register("M8_one_to_one", f"WITH {JUDGED} SELECT best.db_id, site_id FROM best JOIN winners ON winners.db_id = best.db_id")
def m8(t):
    return assignment.one_to_one(_best(t)).select("db_id", "site_id")


_STATUS = """SELECT d.vec_id AS db_id, b.site_id, coalesce(b.sim, 0.0) AS sim, CAST(coalesce(b.inliers, 0) AS BIGINT) AS inliers, CASE WHEN w.db_id IS NOT NULL THEN 'match' ELSE 'missing' END AS status
  FROM embeddings d LEFT JOIN best b ON b.db_id = d.vec_id LEFT JOIN winners w ON w.db_id = d.vec_id"""


@register("M9_match_images", f"WITH {JUDGED} {_STATUS}")
def m9(t):
    """Flagship: the whole embedding matcher."""
    return matching.match_by_embedding(_db(t), _site(t), _inliers())


@register(
    "M10_scoped_match",
    "WITH " + JUDGED.replace("FROM db, site)", "FROM db JOIN site ON site.label = db.label AND site.label <> 3)") + " " + _STATUS,
)
def m10(t):
    """Folders per product; one product has no retailer images at all."""
    site = _site(t).filter("label <> 3")
    return matching.match_by_embedding(_db(t), site, _inliers(), scope=["label"], block_rows=512)


def _word(test):
    return F.aggregate(
        F.transform(F.col("vector"), test),
        F.lit(0).cast("bigint"),
        lambda a, b: F.shiftleft(a, 1).bitwiseOR(b.cast("int").cast("bigint")),
    )


def _hashed(df, id_name):
    """A 256-bit hash as four words; one image in 37 is unreadable."""
    v = F.col("vector")
    words = F.array(
        _word(lambda x: x > -0.1), _word(lambda x: x > 0.0), _word(lambda x: x > 0.1),
        _word(lambda x, i: x > F.get(v, (i + 1) % 64)),
    )
    return df.withColumn("phash", F.when(F.col(id_name) % 37 != 5, words)).drop("vector")


_BITS = """CASE WHEN {id} % 37 <> 5 THEN CAST(array_to_string(list_concat(list_transform(raw, lambda x: CASE WHEN x > CAST(-0.1 AS DOUBLE) THEN '1' ELSE '0' END), list_transform(raw, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END),
  list_transform(raw, lambda x: CASE WHEN x > CAST(0.1 AS DOUBLE) THEN '1' ELSE '0' END), list_transform(list_zip(raw, list_append(raw[2:64], raw[1])), lambda z: CASE WHEN z[1] > z[2] THEN '1' ELSE '0' END)), '') AS BIT) END"""
HASHES = f"""{SIDES}, dbh AS (SELECT db_id, {_BITS.format(id='db_id')} AS h FROM db), siteh AS (SELECT site_id, {_BITS.format(id='site_id')} AS h FROM site),
hpairs AS (SELECT db_id, site_id, coalesce(bit_count(xor(dbh.h, siteh.h)), 999999) AS distance FROM dbh, siteh),
short AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db_id ORDER BY distance, site_id) AS rank FROM hpairs) WHERE rank <= 12),
evid AS (SELECT *, (db_id * 7 + site_id * 13) % 140 AS inl, CASE WHEN (db_id + site_id) % 5 <> 0 THEN CAST((db_id * 3 + site_id * 5) % 100 AS DOUBLE) / 100 END AS ssim, CAST((db_id * 11 + site_id * 17) % 100 AS DOUBLE) / 100 AS hist FROM short),
acc AS MATERIALIZED (SELECT *, distance <= 60 OR (distance <= 90 AND (inl >= 15 OR (coalesce(ssim, -1) >= 0.62 AND hist >= 0.90) OR coalesce(ssim, -1) >= 0.77 OR hist >= 0.97)) OR inl >= 120 OR (coalesce(ssim, -1) >= 0.80 AND hist >= 0.96) AS ok FROM evid)"""


def _evidence():
    d, s = F.col("db_id"), F.col("site_id")
    return {
        "inliers": (d * 7 + s * 13) % 140,
        "ssim": F.when((d + s) % 5 != 0, ((d * 3 + s * 5) % 100).cast("double") / 100),
        "histogram": ((d * 11 + s * 17) % 100).cast("double") / 100,
    }


@register(
    "M11_hamming",
    f"WITH {HASHES} SELECT db_id, CAST(distance AS BIGINT) AS distance FROM hpairs WHERE db_id = site_id",
)
def m11(t):
    a = _hashed(_db(t), "db_id").select("db_id", F.col("phash").alias("a"))
    b = _hashed(_site(t), "site_id").select("site_id", F.col("phash").alias("b"))
    return a.join(b, F.col("db_id") == F.col("site_id")).select("db_id", vectors.hamming("a", "b").cast("bigint").alias("distance"))


def _short(t):
    return matching.hash_shortlist(_hashed(_db(t), "db_id"), _hashed(_site(t), "site_id"))


@register("M12_shortlist", f"WITH {HASHES} SELECT db_id, site_id, CAST(distance AS BIGINT) AS distance, rank FROM short")
def m12(t):
    return _short(t).select(
        "db_id", "site_id", F.col("distance").cast("bigint").alias("distance"), F.col("rank").cast("bigint").alias("rank")
    )


@register("M12_multi_index", f"WITH {HASHES} SELECT db_id, site_id, CAST(distance AS BIGINT) AS distance, rank FROM short")
def m12_multi_index(t):
    """The same through the buckets of the multi-index, for item tables that are too large to be sent."""
    db, site = _hashed(_db(t), "db_id"), _hashed(_site(t), "site_id")
    return matching.hash_shortlist(db, site, broadcast_bytes=0, scan_share=None).select(
        "db_id", "site_id", F.col("distance").cast("bigint").alias("distance"), F.col("rank").cast("bigint").alias("rank")
    )


@register("M13_accepted", f"WITH {HASHES} SELECT db_id, site_id, ok AS accepted FROM acc")
def m13(t):
    rule = vectors.hash_accepts(F.col("distance"), F.col("inliers"), F.col("ssim"), F.col("histogram"))
    return _short(t).withColumns(_evidence()).select("db_id", "site_id", rule.alias("accepted"))


SERIAL = f"""WITH RECURSIVE {HASHES}, lists AS MATERIALIZED (SELECT d.db_id, row_number() OVER (ORDER BY d.db_id) AS k, coalesce(c, CAST([] AS BIGINT[])) AS c
   FROM dbh d LEFT JOIN (SELECT db_id, list(site_id ORDER BY rank) AS c FROM acc WHERE ok GROUP BY 1) a ON a.db_id = d.db_id),
 turn AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS db_id, CAST(NULL AS BIGINT) AS site_id
   UNION ALL SELECT l.k, CASE WHEN f IS NULL THEN used ELSE list_append(used, f) END, l.db_id, f
   FROM (SELECT l.k, l.db_id, t.used, list_filter(l.c, lambda s: NOT list_contains(t.used, s))[1] AS f FROM turn t JOIN lists l ON l.k = t.k + 1) l)"""


@register("M14_serial_assignment", f"{SERIAL} SELECT db_id, site_id FROM turn WHERE site_id IS NOT NULL")
def m14(t):
    rule = vectors.hash_accepts(F.col("distance"), F.col("inliers"), F.col("ssim"), F.col("histogram"))
    return assignment.serial_assignment(_short(t).withColumns(_evidence()).filter(rule))


@register(
    "M15_ratio_test",
    f"""WITH {SIDES}, p AS (SELECT db_id // 10 AS a_id, db_id, site_id, round(sqrt(greatest(0, list_sum(list_transform(list_zip(db.v, site.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))), 6) AS d FROM db JOIN site ON site_id // 10 = db_id // 10),
      r AS (SELECT *, row_number() OVER (PARTITION BY db_id ORDER BY d, site_id) AS k FROM p),
      g AS (SELECT a_id, db_id, max(d) FILTER (k = 1) AS d1, max(d) FILTER (k = 2) AS d2 FROM r WHERE k <= 2 GROUP BY 1, 2)
      SELECT a_id, count(*) FILTER (d1 < 0.75 * d2) AS good_matches, CASE WHEN count(*) FILTER (d1 < 0.75 * d2) < 4 THEN 0 ELSE count(*) FILTER (d1 < 0.75 * d2) END AS floored FROM g GROUP BY 1""",
)
def m15(t):
    image = lambda c: F.floor(F.col(c) / 10).cast("bigint")
    a = _unit(_db(t)).select(image("db_id").alias("image_id"), F.col("db_id").alias("descriptor_no"), F.col("vector").alias("descriptor"))
    b = _unit(_site(t)).select(
        (image("site_id") + 1000000000).alias("image_id"), F.col("site_id").alias("descriptor_no"), F.col("vector").alias("descriptor")
    )
    pairs = a.select(F.col("image_id").alias("a_id"), (F.col("image_id") + 1000000000).alias("b_id")).distinct()
    both = a.unionByName(b)
    free = neighbours.ratio_test(pairs, both)
    floored = F.when(F.col("good_matches") < 4, F.lit(0).cast("bigint")).otherwise(F.col("good_matches"))
    return free.select("a_id", "good_matches", floored.alias("floored"))


@register(
    "M16_histogram_similarity",
    """WITH e AS (SELECT vec_id // 3 AS image_id, vec_id % 3 AS channel, unnest(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    SELECT a_id, round(avg(c), 6) AS histogram FROM (SELECT a.image_id AS a_id, a.channel, corr(a.x, b.x) AS c FROM e a JOIN e b ON b.image_id = a.image_id + 1 AND b.channel = a.channel AND a.i = b.i GROUP BY 1, 2) GROUP BY 1""",
)
def m16(t):
    image = F.floor(F.col("vec_id") / 3).cast("bigint")
    bins = t.embeddings.select(image.alias("image_id"), (F.col("vec_id") % 3).alias("channel"), F.col("embedding").alias("bins"))
    pairs = bins.select(F.col("image_id").alias("a_id"), (F.col("image_id") + 1).alias("b_id")).distinct()
    return neighbours.histogram_similarity(pairs, bins).select("a_id", F.round("histogram", 6).alias("histogram"))


@register(
    "M17_match_by_hash",
    f"{SERIAL} SELECT db_id, site_id, CAST(0 AS DOUBLE) AS sim, CAST(0 AS BIGINT) AS inliers, CASE WHEN site_id IS NULL THEN 'missing' ELSE 'match' END AS status FROM turn WHERE db_id IS NOT NULL",
)
def m17(t):
    return matching.match_images(
        "phash_legacy", _hashed(_db(t), "db_id"), _hashed(_site(t), "site_id"), evidence=_evidence()
    )
