"""Image lists (I): one row per image, keyed by page, ordered by an explicit position.

A page may hold a third of all rows. Choices per page are therefore aggregates, which combine on the
map side, joined back to the rows; ranks are used only under a small bound, where Spark keeps just
that many rows per page and task before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.functions import urls
from aislewatch.session import cut_lineage, parted


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- I2, I3, I5: expressions ------------------------------------------------------------------

# What marks an address as decoration rather than a product image.
DENY = r"(?i)sprite|icon|badge|logo|swatch|video|360|manual|instructions|illustration|promo|placeholder"
IMAGE_SUFFIX = r"(?i)\.(?:jpe?g|png|webp|gif|avif)$"


def is_product_image(url: Column | str, allow: str = ".", deny: str = DENY) -> Column:
    """Allowed by host or path pattern, and free of decoration marks."""
    return _col(url).rlike(allow) & ~_col(url).rlike(deny)


def image_key(url: Column | str, rule: str) -> Column:
    """Canonical key of an image address under a named rule."""
    url = _col(url)
    bare = urls.drop_query(url)
    path = F.lower(urls.path_of(url))
    name = urls.file_name(F.rtrim(bare, F.lit("/")))
    if rule == "exact":
        return url
    if rule == "no_query":
        return bare
    if rule == "path":
        return path
    if rule == "path_without_extension":
        return F.regexp_replace(path, r"\.[^./]+$", "")
    if rule == "filename":
        return F.lower(name)
    if rule == "size_removed":
        return F.concat(urls.host_of(url), F.regexp_replace(path, r"/\d+x\d+/", "/"))
    if rule == "guid":
        guid = F.coalesce(urls.extract(path, r"/([0-9a-f\-]{32,36})/"), F.lit(""))
        return F.lower(F.concat(guid, F.lit(":"), F.regexp_replace(urls.stem(name), r"(?i)_(?:\d+|s\d+)$", "")))
    if rule == "uuid":
        return F.lower(
            F.coalesce(
                urls.extract(url, r"([a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12})"),
                urls.extract(url, r"(?i)\.([a-f0-9]{32})\.(?:jpeg|jpg|png|webp)"),
                F.nullif(F.regexp_replace(name, IMAGE_SUFFIX, ""), F.lit("")),
                F.substring(F.sha1(url), 1, 16),
            )
        )
    raise ValueError(f"unknown image key rule: {rule}")


# Where the number of an image stands, by rule.
NUMBER_PATTERNS = {
    "last_number": r"(\d+)(?:\.\w+)?$",
    "z_three": r"_Z(\d{3})",
    "sq": r"(?i)_SQ(\d+)_",
    "leading": r"/(\d+)\.[^/]*$",
    "suffix": r"[-_](\d{1,3})(?:\.\w+)?$",
}


def natural_order(url: Column | str, rule: str = "last_number") -> Column:
    """Sort key (has no number, number, name)."""
    path = urls.drop_query(url)
    number = urls.extract(path, NUMBER_PATTERNS[rule]).try_cast("bigint")
    return F.struct(number.isNull().alias("unnumbered"), number.alias("number"), F.lower(path).alias("name"))


def family_key(url: Column | str) -> Column:
    """Stem without its size and number suffixes."""
    stem = urls.stem(F.lower(urls.file_name(urls.drop_query(url))))
    stem = F.regexp_replace(stem, r"_(\d{3,4}(?:x\d{3,4})?|[12]\d{3}px)$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"[-_](\d{1,3})$", ""), r"[-_]+", "-")
    return F.regexp_replace(stem, r"^-+|-+$", "")


def family_number(url: Column | str) -> Column:
    """Number of an image within its family: at most three digits."""
    stem = urls.stem(F.lower(urls.file_name(urls.drop_query(url))))
    return urls.extract(stem, r"[-_](\d{1,3})(?:_[a-z]+)?$").try_cast("int")


# --- I1, I4, I6, I12, I14, I19 ----------------------------------------------------------------


def first_tier(images: DataFrame, page: str | Sequence[str], tier: str) -> DataFrame:
    """Keep the rows of each page's first non-empty tier."""
    best = images.groupBy(*_keys(page)).agg(F.min(tier).alias(tier))
    return images.join(best, [*_keys(page), tier])


def distinct_first(images: DataFrame, page: str | Sequence[str], key: str, pos: str | Sequence[str]) -> DataFrame:
    """I4: the first row of each key within its page, by position.

    Rows with texts are aggregated by sorting, so they are parted by key first: a task then sorts a part of bounded size
    and not all that its reader has unfolded.
    """
    images = images.repartition(*_keys(page), key)
    rest = [c for c in images.columns if c not in (*_keys(page), key)]
    order = F.struct(*_keys(pos))
    firsts = images.groupBy(*_keys(page), key).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return firsts.select(*_keys(page), key, *[F.col("_row")[c].alias(c) for c in rest])


def cap_images(images: DataFrame, page: str | Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    """The first ``most`` rows of each page. The bounded rank is applied before the shuffle too."""
    window = Window.partitionBy(*_keys(page)).orderBy(*order)
    return images.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= most).drop("_rank")


def union_sources(sources: Sequence[DataFrame], page: str, key: str, pos: str) -> DataFrame:
    """Union in order of trust, then first of each key; an earlier source wins."""
    tagged = [s.withColumn("source_no", F.lit(i)) for i, s in enumerate(sources)]
    everything = reduce(lambda a, b: a.unionByName(b), tagged)
    return distinct_first(everything, page, key, ["source_no", pos])


#: Rows of one page that one task ranks, about.
RANKED_ROWS = 100_000


def fill_to_expected(images: DataFrame, page: str, tier: str, pos: str, expected: str) -> DataFrame:
    """All of tier 0, then later tiers in order while fewer than the expected number.

    The fillers of a page are ranked in two steps, per salt and then over the survivors, so a page
    with very many candidates is spread over as many tasks as its rows ask for. The top of the tops
    is exact. The largest number any page expects bounds all ranks, so Spark limits them before the shuffle.
    """
    pages = images.groupBy(page).agg(F.count("*").alias("n"), F.max(expected).alias("most"))
    rows, most = pages.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("most"), F.lit(0))).first()
    base = images.filter(F.col(tier) == 0)
    held = base.groupBy(page).agg(F.count("*").alias("_held"))
    later = images.filter(F.col(tier) > 0).join(held, page, "left")
    later = later.withColumn("_need", F.col(expected) - F.coalesce("_held", F.lit(0))).filter(F.col("_need") > 0)
    later = later.withColumn("_salt", F.pmod(F.xxhash64(page, tier, pos), F.lit(1 + rows // RANKED_ROWS)))
    for part in ([page, "_salt"], [page]):
        window = Window.partitionBy(*part).orderBy(tier, pos)
        ranked = later.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= int(most))
        later = ranked.filter(F.col("_rank") <= F.col("_need")).drop("_rank")
    return base.unionByName(later.drop("_held", "_need", "_salt"))


def best_per_item(candidates: DataFrame, item: str | Sequence[str], url: str, rank: Column, pos: str) -> DataFrame:
    """The best quality of each item, the earlier one on ties."""
    return candidates.groupBy(*_keys(item)).agg(F.min_by(url, F.struct(rank, F.col(pos))).alias(url))


def quality_rank(url: Column | str, patterns: Sequence[str] = ("/orig/", "/rocs1200/")) -> Column:
    """Rank of an address by the first quality mark it carries."""
    out = None
    for rank, mark in enumerate(patterns):
        test = _col(url).contains(mark)
        out = F.when(test, rank) if out is None else out.when(test, rank)
    return out.otherwise(len(patterns))


# --- I7-I11: choosing a group -----------------------------------------------------------------


#: Numbers of a family have at most three digits, so their set is this many longs of bits.
PLANES = 16


def _planes(number: Column) -> dict[str, Column]:
    """The set of numbers below 1024 as longs: aggregates that only combine bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int"))
    return {f"_p{p}": F.bit_or(F.when(F.floor(number / 64) == p, bit)) for p in range(PLANES)}


def _longest_run(planes: Sequence[Column]) -> Column:
    """Length of the longest run of consecutive numbers in a set of bits, lowest plane first; 0 for none.

    The bits are written out, the highest first, and cut at the gaps; a plane that is not there is one gap.
    """
    written = [F.when(p.isNull(), F.lit("0")).otherwise(F.lpad(F.bin(p), 64, "0")) for p in reversed(planes)]
    return F.array_max(F.transform(F.split(F.concat(*written), "0+"), F.length)).cast("bigint")


def dominant_family(images: DataFrame, page: str, url: str, pos: str) -> DataFrame:
    """Keep each page's best family by (size, longest run of numbers, earliest position).

    A family's set of numbers is sixteen longs of bits. Rows are parted by page and family first, as the join needs them: a
    task then holds the sets of a bounded number of rows, and not of all families that its reader meets. Building the
    plan counts the rows.
    """
    named = images.withColumns({"_family": family_key(url), "_number": family_number(url)})
    named = parted(named, images.count(), page, "_family")
    planes = _planes(F.col("_number"))
    families = named.groupBy(page, "_family").agg(
        F.count("*").alias("n"), F.min(pos).alias("first_pos"), *[value.alias(name) for name, value in planes.items()]
    )
    order = F.struct("n", _longest_run([F.col(p) for p in planes]).alias("run"), (-F.col("first_pos")).alias("first"))
    best = families.groupBy(page).agg(F.max_by("_family", order).alias("_family"))
    return named.join(best, [page, "_family"]).drop("_number").withColumnRenamed("_family", "family")


def largest_cluster(images: DataFrame, page: str, cluster: str, pos: str, above: int = 2) -> DataFrame:
    """I8: keep the largest cluster if it has more than ``above`` rows, else keep the whole page."""
    sizes = images.groupBy(page, cluster).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos"))
    best = sizes.groupBy(page).agg(
        F.max_by(cluster, F.struct("n", -F.col("first_pos"))).alias("_best"), F.max("n").alias("_n")
    )
    joined = images.join(best, page)
    return joined.filter((F.col("_n") <= above) | F.col("_best").eqNullSafe(F.col(cluster))).drop("_best", "_n")


def keep_identity(images: DataFrame, page: str, match: Column, least: int = 2) -> DataFrame:
    """Keep matching rows only, on pages where at least ``least`` rows match."""
    counted = images.withColumn("_match", F.coalesce(match, F.lit(False)))
    hits = counted.groupBy(page).agg(F.count_if("_match").alias("_hits"))
    return counted.join(hits, page).filter((F.col("_hits") < least) | F.col("_match")).drop("_match", "_hits")


def most_common(images: DataFrame, page: str, value: str, pos: str) -> DataFrame:
    """Each page's most frequent value, the first seen on ties."""
    counts = images.filter(F.col(value).isNotNull()).groupBy(page, value).agg(
        F.count("*").alias("n"), F.min(pos).alias("first_pos")
    )
    return counts.groupBy(page).agg(F.max_by(value, F.struct("n", -F.col("first_pos"))).alias(value))


def widest_code(images: DataFrame, page: str, code: str, number: str, pos: str, least: int = 2) -> DataFrame:
    """The code with most distinct numbers, at least ``least``, the first seen on ties."""
    pairs = images.groupBy(page, code, number).agg(F.min(pos).alias("first_pos"))
    counts = pairs.groupBy(page, code).agg(F.count(number).alias("n"), F.min("first_pos").alias("first_pos"))
    return (
        counts.filter(F.col("n") >= least)
        .groupBy(page)
        .agg(F.max_by(code, F.struct("n", -F.col("first_pos"))).alias(code), F.max("n").alias("n_numbers"))
    )


# --- I13, I15, I16 ----------------------------------------------------------------------------


def drop_thumbnails(images: DataFrame, page: str, url: str, prefix: str = r"^miniatyrbild-\d+-av-\d+-", mark: str = "miniatyrbild-") -> DataFrame:
    """Drop a thumbnail whose base image is on the same page."""
    name = urls.file_name(urls.drop_query(url))
    named = images.withColumn("_name", name).withColumn("_mini", F.col("_name").startswith(mark))
    bases = named.filter(~F.col("_mini")).select(page, F.col("_name").alias("_base")).distinct()
    kept = named.filter(F.col("_mini")).withColumn("_base", F.regexp_replace("_name", prefix, "")).join(
        bases, [page, "_base"], "left_anti"
    )
    return named.filter(~F.col("_mini")).unionByName(kept.drop("_base")).drop("_name", "_mini")


def until_first_gap(images: DataFrame, page: str, number: str) -> DataFrame:
    """Keep the rows of a numbered sequence before its first gap, counted from its smallest number.

    The stop is the smallest number without a successor: two joins on (page, number), no running sum.
    """
    numbers = images.select(page, number).distinct()
    follow = numbers.select(page, (F.col(number) - 1).alias(number))
    stops = numbers.join(follow, [page, number], "left_anti").groupBy(page).agg(F.min(number).alias("_stop"))
    return images.join(stops, page).filter(F.col(number) <= F.col("_stop")).drop("_stop")


def until_two_small(images: DataFrame, page: str, number: str, size: str, floor: int) -> DataFrame:
    """Keep the large items before two consecutive small ones."""
    small = images.filter(F.col(size) < floor).select(page, number).distinct()
    before = small.select(page, (F.col(number) + 1).alias(number))
    stops = small.join(before, [page, number], "left_semi").groupBy(page).agg(F.min(number).alias("_stop"))
    joined = images.filter(F.col(size) >= floor).join(stops, page, "left")
    return joined.filter(F.col("_stop").isNull() | (F.col(number) < F.col("_stop"))).drop("_stop")


def is_real_image(body: Column | str, least: int = 1000) -> Column:
    """I16: large enough, and starting with the bytes of a known image format."""
    return (F.length(_col(body)) >= least) & urls.magic_extension(body).isNotNull()


# --- I17, I18: near duplicates ----------------------------------------------------------------


def average_hash(values: Column | str) -> Column:
    """64 values to 64 bits; a bit is set where the value reaches the mean; first value on top."""
    values = _col(values)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))
    mean = total / F.size(values)
    bits = F.transform(F.array(mean), lambda m: F.aggregate(
        values,
        F.lit(0).cast("bigint"),
        lambda a, x: F.shiftleft(a, 1).bitwiseOR(F.when(x.cast("double") >= m, F.lit(1)).otherwise(F.lit(0)).cast("bigint")),
    ))
    return F.when(F.size(values) == 64, bits[0])


def _bands(h: Column, count: int) -> list[Column]:
    """Cut 64 bits into ``count`` bands of nearly equal width."""
    edges = [64 * i // count for i in range(count + 1)]
    return [
        F.shiftrightunsigned(h, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("bigint")) for a, b in zip(edges, edges[1:])
    ]


#: Distinct hashes of one scope that a task settles in order, and hashes of one bucket that it compares at once.
SETTLED_HASHES = 20_000
BLOCK_HASHES = 4096


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of differing bits of two arrays of 64-bit hashes."""
    return np.bitwise_count(a ^ b)


def _settle_hashes(part: pd.DataFrame, scope: list[str], pos: str, h: str, max_hamming: int) -> pd.DataFrame:
    """Leaders of whole scopes: in the order of positions, every hash that no earlier leader is near to."""
    kept = []
    for _, rows in part.groupby(scope, sort=False, dropna=False):
        rows = rows.sort_values(pos, kind="stable")
        hashes = rows[h].to_numpy(np.int64).view(np.uint64)
        leaders, held, chosen = np.empty(len(hashes), np.uint64), 0, np.zeros(len(hashes), bool)
        for n, own in enumerate(hashes):
            if not (_differing(leaders[:held], own) <= max_hamming).any():
                leaders[held], chosen[n] = own, True
                held += 1
        kept.append(rows[chosen])
    return pd.concat(kept)[[*scope, h, pos]] if kept else part[[*scope, h, pos]]


def _near_any(rows: DataFrame, scope: list[str], pos: str, h: str, max_hamming: int, leads: str | None) -> DataFrame:
    """The hashes that some other one is near to: an earlier one, or with ``leads`` one that this column marks.

    With ``max_hamming + 2`` bands two hashes that close agree on at least two, so each stands in a bucket for every
    pair of bands. A bucket is compared inside its task, one row per hash leaves it, and a large bucket is cut into
    blocks that meet in pairs: no list of pairs is ever written.
    """
    bands = _bands(F.col(h), max_hamming + 2)
    combos = F.array(
        *[F.struct(F.lit(i).alias("combo"), a.alias("x"), b.alias("y")) for i, (a, b) in enumerate(combinations(bands, 2))]
    )
    bucket = [*scope, "combo", "x", "y"]
    own = [*scope, F.col(pos), F.col(h), *([F.col(leads)] if leads else [])]
    keyed = rows.select(*own, F.inline(combos))
    sizes = keyed.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_HASHES).cast("int").alias("_blocks"), F.count("*").alias("_n"))
    # A bucket of one hash compares nothing.
    placed = keyed.join(sizes.filter(F.col("_n") > 1).drop("_n"), bucket).withColumn("_block", F.pmod(F.xxhash64(h), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    met = placed.select("*", other).withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")})
    group = [*bucket, "_low", "_high"]
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in scope), f"`{h}` {kinds[h]}"])

    def compare(part: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        """Hits among rows whose groups lie together; ``first`` marks where a group begins."""
        hashes, places = part[h].to_numpy(np.int64).view(np.uint64), part[pos].to_numpy()
        marked = part[leads].to_numpy(bool) if leads else np.ones(len(part), bool)
        hit, number = np.zeros(len(part), bool), np.cumsum(first)
        sizes = np.bincount(number)
        for step in range(1, int(sizes.max())):
            # Rows that have a member of their group ``step`` places further on.
            left = np.flatnonzero(number[:-step] == number[step:])
            right = left + step
            near = _differing(hashes[left], hashes[right]) <= max_hamming
            left, right = left[near], right[near]
            if leads is None:
                hit[np.where(places[left] > places[right], left, right)[places[left] != places[right]]] = True
            else:
                hit[left[marked[right]]] = True
                hit[right[marked[left]]] = True
        return part.loc[hit & ~marked if leads else hit, [*scope, h]].drop_duplicates()

    def compare_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def begins(part: pd.DataFrame) -> np.ndarray:
            keys = part[group]
            changed = (keys != keys.shift()) & ~(keys.isna() & keys.shift().isna())
            first = changed.any(axis=1).to_numpy()
            first[:1] = True
            return first

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < 4 * BLOCK_HASHES:
                continue
            part = pd.concat(held, ignore_index=True)
            first = begins(part)
            last = int(np.flatnonzero(first)[-1])
            if last:  # the last group may go on in the next batch
                yield compare(part.iloc[:last], first[:last])
            held = [part.iloc[last:]]
        part = pd.concat(held, ignore_index=True) if held else None
        if part is not None and len(part):
            yield compare(part, begins(part))

    together = met.select(*group, pos, h, *([leads] if leads else [])).repartition(*group).sortWithinPartitions(*group)
    return together.mapInPandas(compare_all, schema).distinct()


def drop_near_duplicates(
    images: DataFrame, scope: str | Sequence[str], pos: str, h: str, max_hamming: int = 4, settled_hashes: int = SETTLED_HASHES
) -> DataFrame:
    """Visit images by position; keep one unless a kept one is within ``max_hamming`` bits.

    Images without a hash are kept. Equal hashes are first reduced to their earliest image, which decides for all of
    them. A scope (a product's images) of at most ``settled_hashes`` distinct hashes is settled in order by one task,
    which holds many scopes. A larger one is settled in rounds over tables of bands: hashes without an earlier near one
    among the undecided lead, and what is near to a leader goes. Neither way writes pairs of images.
    """
    scope = _keys(scope)
    hashed = cut_lineage(images.filter(F.col(h).isNotNull()).groupBy(*scope, h).agg(F.min(pos).alias(pos)))
    sizes = hashed.groupBy(*scope).agg(F.count("*").alias("_n"))
    large = cut_lineage(sizes.filter(F.col("_n") > settled_hashes).select(*scope))
    buckets = max(1, -(-hashed.count() // settled_hashes))
    small = hashed.join(large, scope, "left_anti").withColumn("_bucket", F.pmod(F.xxhash64(*scope), F.lit(buckets)))
    kinds = dict(hashed.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*scope, h, pos])
    leaders = small.groupBy("_bucket").applyInPandas(lambda part: _settle_hashes(part, scope, pos, h, max_hamming), schema)
    if not large.isEmpty():
        leaders = leaders.unionByName(_leaders_in_rounds(hashed.join(large, scope), scope, pos, h, max_hamming))
    given = leaders.withColumnRenamed(pos, "_lead")
    first_rows = images.join(given, [*scope, h]).filter(F.col(pos) == F.col("_lead"))
    unread = images.filter(F.col(h).isNull())
    return first_rows.drop("_lead").unionByName(unread)


def _leaders_in_rounds(hashed: DataFrame, scope: list[str], pos: str, h: str, max_hamming: int) -> DataFrame:
    undecided, found = cut_lineage(hashed.select(*scope, h, pos)), []
    while not undecided.isEmpty():
        later = _near_any(undecided, scope, pos, h, max_hamming, None)
        marked = undecided.join(later.withColumn("_later", F.lit(True)), [*scope, h], "left")
        marked = cut_lineage(marked.withColumn("_leads", F.col("_later").isNull()).drop("_later"))
        found.append(marked.filter("_leads").drop("_leads"))
        gone = _near_any(marked, scope, pos, h, max_hamming, "_leads")
        undecided = cut_lineage(marked.filter("not _leads").drop("_leads").join(gone, [*scope, h], "left_anti"))
    return reduce(lambda a, b: a.unionByName(b), found)
