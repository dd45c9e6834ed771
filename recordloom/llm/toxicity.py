"""Toxicity scores: boosted trees over a few dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import check_fold, fold, landed, ship

ship(__name__)

#: At most so many labelled documents teach the model (those with the least hash of their id).
TRAIN_DOCS = 20_000
#: The lexicon: word beginnings of 3 to 12 letters, at most so many, each in at least so many toxic documents.
LEXICON_SIZE, LEXICON_LEAST = 400, 3
STEMS = tuple(range(3, 13))
#: Least log odds of a toxic document, given the entry, for it to enter the lexicon.
LEAST_ODDS = 2.0
NEAR = 5
TREES, DEPTH, SEED = 12, 3, 7
#: Trees learn from folds 2 to 4, calibration from fold 1; fold 0 is held out.
CALIBRATE_FOLD = 1
MEMO = 150_000
PLAIN = (0.0, False)

#: Second-person words in the languages at hand.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie ihnen ihre tu te toi ton ta tes vous "
    "votre vos tú ti tus usted ustedes vosotros vuestro".split())
LEET = str.maketrans("013457@$!|", "oieastasil")
LETTERS = re.compile(r"[^\W\d_]+")
ODD = re.compile(r"[^\W\d_]+(?:[0-9@$!|*#][^\W\d_]*)+")
FEATURES = ("log_words", "lexicon_density", "lexicon_hits", "lexicon_best", "lexicon_kinds", "near_second_person",
            "second_person", "capitals", "shouted", "exclaims", "marks", "digits", "obfuscated", "hidden_hits", "stretched")


def stems(word: str) -> list[str]:
    return [word[:n] for n in STEMS if n <= len(word)]


def count_stems(batches):
    """Per batch: how many toxic and other documents hold each word beginning."""
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = set(LETTERS.findall((text or "").lower()))
            for s in {s for w in words for s in stems(w)}:
                seen.setdefault(s, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays([
            pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()),
            pa.array([v[0] for v in seen.values()], pa.int64())], names=["stem", "bad", "good"])


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Word beginnings that mark toxic documents, with their log odds; a beginning is left out
    when a shorter one says the same."""
    totals = sample.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    if not n.get(1) or not n.get(0):
        return {}
    odds = F.log((F.col("bad") + 0.1) / (n[1] + 1.0)) - F.log((F.col("good") + 0.1) / (n[0] + 1.0))
    best = (sample.mapInArrow(count_stems, "stem string, bad long, good long").groupBy("stem")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") >= LEXICON_LEAST)
            .withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
            # Strong and frequent entries first: what an entry adds is its odds times its documents.
            .orderBy(F.desc(F.col("odds") * F.col("bad")), "stem").limit(LEXICON_SIZE * len(STEMS)).collect())
    chosen: dict[str, float] = {}
    spread = {r["stem"]: (r["bad"], r["odds"]) for r in best}
    for s, (bad, o) in sorted(spread.items(), key=lambda x: (len(x[0]), x[0])):
        shorter = [spread[s[:k]] for k in STEMS if k < len(s) and s[:k] in chosen]
        if all(o > p[1] + 0.7 for p in shorter) and len(chosen) < LEXICON_SIZE:
            chosen[s] = float(o)
    return chosen


def featurize(lexicon: dict[str, float]):
    """A ``mapInArrow`` function from (doc_id, text, extra columns) to features."""

    def weight(word: str) -> float:
        return max((lexicon[s] for s in stems(word) if s in lexicon), default=0.0)

    def run(batches):
        memo: dict[str, tuple[float, bool]] = {}
        for batch in batches:
            rows = np.zeros((batch.num_rows, len(FEATURES)))
            for i, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                chunks = text.split()
                if not chunks:
                    continue
                if len(memo) > MEMO:
                    memo.clear()
                hits, second = [], []
                for k, c in enumerate(chunks):
                    m = memo.get(c)
                    if m is None:
                        words = LETTERS.findall(c.lower())
                        m = (max(map(weight, words), default=0.0), any(w in SECOND_PERSON for w in words))
                        m = memo[c] = PLAIN if m == PLAIN else m
                    if m[0]:
                        hits.append((k, m[0], c))
                    if m[1]:
                        second.append(k)
                n = len(chunks)
                odd = ODD.findall(text)
                hidden = sum(1 for w in odd if weight(w.lower().translate(LEET).replace("*", "")) > 0)
                near = 0
                if hits and second:
                    at = np.array(second)
                    near = sum(1 for k, _, _ in hits if np.abs(at - k).min() <= NEAR)
                codes = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
                upper, lower = codes[65:91].sum(), codes[97:123].sum()
                size = max(1, codes.sum())
                rows[i] = (
                    math.log1p(n), len(hits) / n, math.log1p(len(hits)), max((w for _, w, _ in hits), default=0.0),
                    len({c.lower() for _, _, c in hits}), near / n, len(second) / n, upper / max(1, upper + lower),
                    sum(1 for c in chunks if len(c) > 2 and c.isupper()) / n, (codes[33] + codes[63]) / size,
                    (codes[35:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum()) / size,
                    codes[48:58].sum() / size, len(odd) / n, hidden, len(re.findall(r"([^\W\d_])\1{3,}", text)) / n)
            keep = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, *[pa.array(rows[:, j]) for j in range(len(FEATURES))]], names=[*names, *FEATURES])
        pa.default_memory_pool().release_unused()

    return run


FEATURE_TYPES = ", ".join(f"{f} double" for f in FEATURES)


class Model:
    """A lexicon, trees and a calibration; without trees every score is ``base``."""

    def __init__(self, lexicon: dict[str, float], trees, calibration, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fit on at most ``limit`` labelled documents that are not held out.  Labels are joined by a
    bounded list of ids; the features of the sample are written once and read by every tree."""
    known = (labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~check_fold(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = landed(rows.join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", fold(F.col("doc_id")).alias("fold")), "toxicity-sample")
    lexicon = learn_lexicon(sample.where(F.col("fold") != CALIBRATE_FOLD).select("text", "toxic"))
    featured = landed(sample.mapInArrow(featurize(lexicon), f"toxic int, fold int, {FEATURE_TYPES}"), "toxicity-features")
    n = {k: 0 for k in ((a, b) for a in (True, False) for b in (0, 1))}
    for r in featured.groupBy((F.col("fold") == CALIBRATE_FOLD).alias("cal"), "toxic").count().collect():
        n[r["cal"], r["toxic"]] = r["count"]
    positive, total = n[True, 1] + n[False, 1], sum(n.values())
    if not n[False, 0] or not n[False, 1]:
        return Model(lexicon, None, None, positive / total if total else 0.0)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED,
                          cacheNodeIds=False).fit(vectors.where(F.col("fold") != CALIBRATE_FOLD))
    calibration = None
    if n[True, 0] and n[True, 1]:
        scored = trees.transform(vectors.where(F.col("fold") == CALIBRATE_FOLD)).select(
            F.col("toxic").cast("double").alias("label"), vector_to_array("probability")[1].alias("features"), F.lit(1.0).alias("weight"))
        calibration = IsotonicRegression(labelCol="label", featuresCol="features", weightCol="weight").fit(scored)
    return Model(lexicon, trees, calibration, positive / total)


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, score (0 to 1) and predicted for every row; a narrow map followed by tree expressions."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(f, T.DoubleType()) for f in FEATURES]])
    featured = rows.mapInArrow(featurize(model.lexicon), schema)
    if model.trees is None:
        out = featured.select("doc_id", F.lit(float(model.base)).alias("score"))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured).select("doc_id", "features")
        out = model.trees.transform(vectors).select("doc_id", vector_to_array("probability")[1].alias("raw"))
        if model.calibration is None:
            out = out.withColumnRenamed("raw", "score")
        else:
            # Ties in the steps of the calibration keep a trace of the order of the trees.
            out = model.calibration.setFeaturesCol("raw").setPredictionCol("fitted").transform(out).select(
                "doc_id", (F.lit(0.98) * F.col("fitted") + F.lit(0.02) * F.col("raw")).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have all features 0 and the score that the model gives to that.  Labels other
    than 0 and 1 are not used; a document labelled twice counts as toxic if either label says so; with
    no toxic or no clean label, every score is the share of toxic ones (0 without labels).  Repeated rows get
    equal scores; other columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, text=text, doc_id=doc_id)
    return score(docs, model, text, doc_id).select(
        "doc_id", check_fold(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    model = train(docs, labels, text=text, doc_id=doc_id)
    # The whole row rides along as one value, so nothing is joined back and no column can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    kept = score(rows.select(F.col("row").alias("doc_id"), "text"), model, "text", "doc_id")
    return kept.where("predicted = 0").select("doc_id.*")
