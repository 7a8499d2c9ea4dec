"""Mixing sources to target weights: balanced sampling by the cube method."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.llm.shared import stored

MOST_REPEATS = 3
#: Units that one flight decides together.
BLOCK_UNITS = 4096
SEED = 20
_NEAR = 1e-9


def word_count(text: str = "text"):
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null counts 0."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source_size, weight, target.

    Sources by code point, null last, weigh 1, 2, 3, repeating. They share the sum of all sizes by
    weight; a target stops at ``most_repeats`` times its source's size and the excess is shared anew.
    The windows see one row per source. Sources are capped in order of cap by weight, so the level
    at which sharing ends is found from running sums.
    """
    sources = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))
    weighed = weighed.withColumn("_cap", most_repeats * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(everything)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = weighed.withColumn("_level", left / F.sum("weight").over(rest))
    free = F.when(F.col("_cap") > F.col("weight") * F.col("_level"), F.col("_level"))
    # The first source that is not capped fixes the level of all that follow.
    level = level.withColumn("_level", F.first(free, ignorenulls=True).over(everything))
    share = F.coalesce(F.col("weight") * F.col("_level"), F.col("_cap"))
    return level.select("source", "source_size", "weight", F.least("_cap", share).alias("target"))


def flight(psi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities through the null space of (count, size) until at most two are fractional.

    Three fractional units at a time: the direction (s2 - s3, s3 - s1, s1 - s2) changes neither the
    sum of probabilities nor the expected size; a step along it, up or down at random with zero mean,
    makes at least one of them 0 or 1. Two units of equal size may move alone.
    """
    psi = psi.tolist()
    draws = iter(rng.random(3 * len(psi) + 8).tolist())
    held: list[int] = []
    for k in range(len(psi) + 1):
        while len(held) == 3 or (len(held) == 2 and size[held[0]] == size[held[1]]):
            if len(held) == 3:
                s1, s2, s3 = (float(size[i]) for i in held)
                u = (s2 - s3, s3 - s1, s1 - s2)
                if u == (0.0, 0.0, 0.0):
                    u = (1.0, -1.0, 0.0)
            else:
                u = (1.0, -1.0)
            up = min(((1 - psi[i]) / c if c > 0 else psi[i] / -c) for i, c in zip(held, u, strict=True) if c)
            down = min((psi[i] / c if c > 0 else (1 - psi[i]) / -c) for i, c in zip(held, u, strict=True) if c)
            step = up if next(draws) * (up + down) < down else -down
            for i, c in zip(held, u, strict=True):
                value = psi[i] + step * c
                psi[i] = 0.0 if value < _NEAR else 1.0 if value > 1 - _NEAR else value
            held = [i for i in held if 0 < psi[i] < 1]
        if k < len(psi) and 0 < psi[k] < 1:
            held.append(k)
    return np.array(psi)


def landing(psi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round what a source's last flight leaves, at most two units, with the least change of its size."""
    open_ = [i for i in range(len(psi)) if 0 < psi[i] < 1]
    out = psi.copy()
    expected = sum(psi[i] * size[i] for i in open_)
    options = range(1 << len(open_))
    held = [[(o >> k) & 1 for k in range(len(open_))] for o in options]
    best = min(held, key=lambda bits: abs(sum(b * size[i] for b, i in zip(bits, open_, strict=True)) - expected), default=[])
    for b, i in zip(best, open_, strict=True):
        out[i] = float(b)
    return out


def _flights(units: DataFrame, level: int, last: bool) -> DataFrame:
    def decide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "doc_id"], ignore_index=True, na_position="first")
        first = group.iloc[0]
        name = "" if first["source"] is None else "=" + first["source"]
        rng = np.random.default_rng([SEED, level, zlib.crc32(name.encode()), int(first["_block"])])
        size = group["size"].to_numpy(np.float64)
        psi = flight(group["psi"].to_numpy(np.float64), size, rng)
        group["psi"] = landing(psi, size) if last else psi
        return group

    return units.groupBy("source", "_block").applyInPandas(decide, units.schema)


def copies_taken(units: DataFrame, targets: DataFrame) -> DataFrame:
    """How often the mix takes each unit of ``units`` (source, doc_id, size): adds source_size, target, copies.

    A unit's expected copies are target / source_size, at most the repeats allowed. The whole part is
    taken of every unit. The fractional parts of a source are decided by flights over hashed blocks
    of some ``BLOCK_UNITS`` units, however large the source; what a block leaves open, at most two
    units, meets that of other blocks in the next round, until one block is left and lands.
    """
    both = units.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected + _NEAR)
    both = both.withColumn("whole", whole).withColumn("psi", F.greatest(expected - whole, F.lit(0.0)))
    both = both.withColumn("psi", F.when(F.col("psi") < _NEAR, 0.0).otherwise(F.col("psi")))
    both = both.withColumn("_order", F.xxhash64("doc_id", F.lit(SEED)))
    count = both.groupBy("source").agg(F.count("*").alias("_n")).withColumnRenamed("source", "_s")
    both = both.join(count, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    blocks = F.ceil(F.col("_n") / BLOCK_UNITS)
    both = both.withColumn("_block", F.pmod("_order", blocks)).drop("_n")
    settled = both.filter("psi = 0")
    open_ = both.filter("psi > 0")
    level = 0
    while True:
        most = open_.agg(F.max("_block")).first()[0]
        if most is None:
            break
        flown = stored(_flights(open_, level, most == 0), "mix-flight")
        settled = settled.union(flown.filter("psi = 0 or psi = 1"))
        if most == 0:
            break
        open_ = flown.filter("psi > 0 and psi < 1").withColumn("_block", F.floor(F.col("_block") / (BLOCK_UNITS // 2)))
        level += 1
    copies = (F.col("whole") + F.col("psi")).cast("bigint")
    return settled.select("source", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row (doc_id, source, size, source_size, target, copies) per doc_id and source of ``docs``.

    Rows that repeat a doc_id within a source are one unit with the sum of their sizes, so they share
    a decision. Null and empty texts have size 0: they are units like others and add no words. Null
    doc_id and null source are values of their own. Equal sizes are told apart by a hash of doc_id,
    so reruns agree. An empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select("doc_id", "source", word_count().alias("size"))
    units = stored(rows.groupBy("doc_id", "source").agg(F.sum("size").alias("size")), "mix-units")
    return copies_taken(units, source_targets(units))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns only."""
    plan = mix_plan(docs).filter("copies > 0").select("doc_id", "source", F.sequence(F.lit(1).cast("bigint"), "copies").alias("times"))
    left, right = docs.alias("l"), plan.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.source").eqNullSafe(F.col("r.source"))
    own = [F.col(f"l.`{c}`") for c in docs.columns]
    # The number of a copy comes last and is dropped by place, so no column's name can clash with it.
    taken = left.join(right, same).select(*own, F.explode("r.times").alias("_copy"))
    return taken.toDF(*[f"c{k}" for k in range(len(own))], "_copy").drop("_copy").toDF(*docs.columns)
