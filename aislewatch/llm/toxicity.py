"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.llm.shared import stored, texts_of

#: Labelled rows that a model is fitted on, chosen by a hash of doc_id; and terms of its lexicon, the
#: surest first. Both bounds hold whatever the input.
SAMPLE_ROWS = 20_000
LEXICON_TERMS = 20_000
#: A term needs this many toxic documents and this many standard errors of its log odds above zero.
LEAST_DOCUMENTS = 3
LEAST_SURENESS = 2.5
#: Parts in tenths by hash: the lexicon, the trees and the calibration each learn from other rows.
LEXICON_PART, TREES_PART = 4, 8
LEAST_CALIBRATION = 10
#: A word also counts by its beginnings, so that inflected and compound forms are known.
BEGINNINGS = (4, 6)
NEAR_WORDS = 5
SCORE_STEPS = 1000

#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deinem deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra".split()
)
#: Signs that stand for letters inside disguised words.
DISGUISES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*.\-_]+[^\W\d_]+)+")
INNER_SIGN = re.compile(r"[0-9@$!|*_]")
#: Stands in every disguised word, and is quickly found or missed.
SIGN_AND_LETTER = re.compile(r"[0-9@$!|*_][0-9@$!|*.\-_]*[^\W\d_]")
SHOUTED = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ]{3,}(?!\w)")

FEATURES = (
    "words", "lexicon_density", "lexicon_weight", "heaviest", "lexicon_words", "second_person", "near_second_person",
    "capitals", "shouted", "exclamations", "punctuation", "disguised", "disguised_lexicon", "lengthened",
)

_CAPITALS = np.array([65 <= c <= 90 for c in range(256)])
_LETTERS = np.array([65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC3 for c in range(256)])
_SIGNS = np.array([33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in range(256)])
_ASCII_LETTERS = np.array([65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])
_CALLS = np.array([c in b"!?" for c in range(256)])


@dataclass(frozen=True)
class ToxicityModel:
    """Term weights, trees and calibration; without both classes in the sample, only their share."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


class Weights(dict):
    """Weight of each word met: the largest of the word's own and its beginnings'; at most ``MOST`` are remembered.

    ``PERSON`` is added to that of a second-person word, so that one look tells both.
    """

    MOST = 300_000
    PERSON = 1024.0

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= self.MOST:
            self.clear()
        weight = max(self.lexicon.get(term, 0.0) for term in terms(word))
        weight += self.PERSON if word in SECOND_PERSON else 0.0
        self[word] = weight
        return weight


def terms(word: str) -> list[str]:
    """A word and its beginnings, which are marked by a star."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def measure(text: str, weights: Weights) -> list[float]:
    """The values of ``FEATURES`` for one text."""
    lower = text.lower()
    words = WORD.findall(lower)
    n = max(len(words), 1)
    weight = np.fromiter(map(weights.__getitem__, words), np.float64, len(words))
    persons = np.flatnonzero(weight >= Weights.PERSON)
    weight[persons] -= Weights.PERSON
    hits = np.flatnonzero(weight)
    near = np.searchsorted(persons, hits + NEAR_WORDS, "right") > np.searchsorted(persons, hits - NEAR_WORDS, "left")
    codes = np.frombuffer(text.encode("utf-8"), np.uint8)
    counts = np.bincount(codes, minlength=256)
    capitals, letters = int(counts[_CAPITALS].sum()), max(int(counts[_LETTERS].sum()), 1)
    small = codes | 0x20
    same = (small[1:] == small[:-1]) & _ASCII_LETTERS[small[1:]]
    runs = same[1:] & same[:-1]
    lengthened = int(runs[:1].sum()) + int((runs[1:] & ~runs[:-1]).sum())
    hidden = []
    if SIGN_AND_LETTER.search(lower):
        some = [token for token in lower.split() if SIGN_AND_LETTER.search(token)]
        hidden = [w for token in some for w in DISGUISED.findall(token) if INNER_SIGN.search(w)]
    plain = [re.sub(r"[\W\d_]", "", w.translate(DISGUISES)) for w in hidden]
    return [
        math.log1p(len(words)), float(weight.sum()) / n, math.log1p(float(weight.sum())), float(weight.max(initial=0.0)),
        math.log1p(len({words[k] for k in hits})), len(persons) / n, int(near.sum()) / n, capitals / letters, len(SHOUTED.findall(text)) / n,
        float(counts[_CALLS].sum()) / n, float(counts[_SIGNS].sum()) / n, len(hidden) / n,
        sum(weights[w] % Weights.PERSON > 0 for w in plain if w) / n, lengthened / n,
    ]


def dense_features(text: Column | str, lexicon: dict[str, float]) -> Column:
    """``FEATURES`` of each whole text as an array of doubles; null counts as empty, which gives zeros."""

    @F.arrow_udf("array<double>")
    def dense(column: pa.Array) -> pa.Array:
        weights = Weights(lexicon)
        return pa.array([measure(t, weights) for t in texts_of(column)], pa.list_(pa.float64()))

    return dense(text)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label, part): at most ``SAMPLE_ROWS`` labelled rows, one per doc_id, in tenths by hash.

    A doc_id that ``labels`` marks more than once is toxic if any row says so; of rows that share a doc_id the
    smallest text is taken. Only the chosen ids are broadcast, so no text is shuffled but those chosen.
    """
    key = F.xxhash64("doc_id", F.lit("toxicity"))
    marked = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = marked.select("doc_id", "label").orderBy(key, "doc_id").limit(SAMPLE_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    return stored(rows.select("doc_id", "text", F.col("label").cast("double").alias("label"), part.alias("part")), "toxicity-sample")


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weights (log odds) of the terms that stand surely more often in toxic documents than in others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string())]
            columns += [pa.array([v[k] for v in held.values()], pa.int64()) for k in (0, 1)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

        for batch in batches:
            for text, label in zip(texts_of(batch["text"]), batch["label"].to_pylist(), strict=True):
                for term in {t for word in set(WORD.findall(text.lower())) for t in terms(word)}:
                    held.setdefault(term, [0, 0])[int(label)] += 1
                if len(held) > 200_000:
                    yield flush()
        yield flush()

    sizes = {int(r["label"]): r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return {}
    counted = sample.select("text", "label").mapInArrow(count, "term string, clean bigint, toxic bigint")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    sureness = weight / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    some = counted.filter(F.col("t") >= LEAST_DOCUMENTS).select("term", weight.alias("w"), sureness.alias("z"))
    some = some.filter(F.col("z") >= LEAST_SURENESS).orderBy(F.desc("z"), "term").limit(LEXICON_TERMS)
    return {r["term"]: r["w"] for r in some.collect()}


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit lexicon, trees and calibration on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Rows without a label, ids that are null, and labels other than 0 and 1 teach nothing. Empty tables,
    or a sample of one class only, give a model that scores every text by the share of toxic rows (0 without
    any). At most ``SAMPLE_ROWS`` labelled documents are used; ties and row order do not matter.
    """
    sample = labelled_sample(docs, labels)
    lexicon = learn_lexicon(sample.filter(F.col("part") < LEXICON_PART))
    features = sample.select("label", "part", dense_features("text", lexicon).alias("values")).coalesce(8)
    rows = stored(features, "toxicity-features").select("label", "part", array_to_vector("values").alias("features"))
    taught = rows.filter((F.col("part") >= LEXICON_PART) & (F.col("part") < TREES_PART))
    counts = {(r["label"], r["taught"]): r["n"] for r in _sizes(rows)}
    toxic, everything = counts.get((1.0, True), 0), sum(n for (_, is_taught), n in counts.items() if is_taught)
    if not toxic or toxic == everything:
        total = sum(counts.values())
        share = sum(n for (label, _), n in counts.items() if label == 1.0) / total if total else 0.0
        return ToxicityModel(lexicon, None, None, share)
    trees = GBTClassifier(maxIter=30, maxDepth=4, stepSize=0.2, minInstancesPerNode=2, seed=1).fit(taught)
    apart = rows.filter(F.col("part") >= TREES_PART)
    # Where the rows set apart are too few to calibrate by, all but the lexicon's are taken.
    few = min(n for (_, is_taught), n in counts.items() if not is_taught) if len(counts) == 4 else 0
    graded = trees.transform(apart if few >= LEAST_CALIBRATION else rows.filter(F.col("part") >= LEXICON_PART))
    # Equal scores are added up first, so at most SCORE_STEPS + 1 rows a class are fitted.
    steps = graded.groupBy("label", _rounded().alias("raw")).agg(F.count("*").cast("double").alias("weight"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(steps)
    return ToxicityModel(lexicon, trees, calibration, toxic / everything)


def _sizes(rows: DataFrame) -> list:
    """Rows by label of the trees' part (taught) and of the rows set apart; the lexicon's are not counted."""
    taught = (F.col("part") < TREES_PART).alias("taught")
    return rows.filter(F.col("part") >= LEXICON_PART).groupBy("label", taught).agg(F.count("*").alias("n")).collect()


def _rounded() -> Column:
    return F.round(vector_to_array("probability")[1] * SCORE_STEPS) / SCORE_STEPS


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of each row, score (0 to 1) and predicted (1 from 0.5 on).

    Every row is scored by its whole text alone: null and empty texts count as empty, repeated rows score
    alike, an empty table gives an empty one, and other columns are ignored.
    """
    if model.trees is None or model.calibration is None:
        value = F.lit(model.share)
        return docs.select(*keep, value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
    held = F.struct(*keep).alias("held")
    rows = docs.select(held, array_to_vector(dense_features("text", model.lexicon)).alias("features"))
    graded = model.trees.transform(rows).select("held", _rounded().alias("raw"))
    value = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    found = model.calibration.transform(graded).select("held.*", value.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
