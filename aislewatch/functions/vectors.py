"""Vector and hash expressions of image matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aislewatch.functions.text import bind

# Inliers required from a similarity upwards, most similar first.
INLIER_STEPS = ((0.95, 8), (0.90, 12), (0.80, 15), (0.70, 20))
DEFAULT_MIN_INLIERS = 15
TRUSTED_SIMILARITY = 0.94
TRUSTED_INLIERS = 999
UNREADABLE_DISTANCE = 999999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_vector(v: Column | str) -> Column:
    """M1: ``v / (|v| + 1e-8)`` in double precision; NULL where the embedding failed."""
    wide = F.transform(_col(v), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x)) + F.lit(1e-8)
    return F.when(F.size(_col(v)) > 0, bind(norm, lambda n: F.transform(_col(v), lambda x: x.cast("double") / n)))


def required_inliers(
    similarity: Column | str, steps: Sequence[tuple[float, int]] = INLIER_STEPS, default: int = DEFAULT_MIN_INLIERS
) -> Column:
    """M5: inliers required at a similarity.

    Below the lowest step the default applies, so the requirement is not monotone there.
    """
    similarity = _col(similarity)
    out = None
    for low, inliers in steps:
        out = F.when(similarity >= low, inliers) if out is None else out.when(similarity >= low, inliers)
    return out.otherwise(default)


def trusted_inliers(similarity: Column | str, inliers: Column | str, from_similarity: float = TRUSTED_SIMILARITY) -> Column:
    """M6: a very high similarity is trusted without geometry."""
    return F.when(_col(similarity) >= from_similarity, TRUSTED_INLIERS).otherwise(F.coalesce(_col(inliers), F.lit(0)))


def hamming(a: Column | str, b: Column | str) -> Column:
    """Differing bits of two hashes given as arrays of 64-bit words."""
    a, b = _col(a), _col(b)
    bits = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n
    )
    return F.when(a.isNull() | b.isNull(), UNREADABLE_DISTANCE).otherwise(bits)


def hash_accepts(distance: Column, inliers: Column, ssim: Column, histogram: Column) -> Column:
    """Accept rule of the hash matcher; a missing structural similarity proves nothing."""
    s = F.coalesce(ssim, F.lit(-1.0))
    h = F.coalesce(histogram, F.lit(0.0))
    border = (inliers >= 15) | ((s >= 0.62) & (h >= 0.90)) | (s >= 0.77) | (h >= 0.97)
    strong = (inliers >= 120) | ((s >= 0.80) & (h >= 0.96))
    return (distance <= 60) | ((distance <= 90) & border) | strong
