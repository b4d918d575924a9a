"""Toxicity severity: cumulative-link ordinal regression on sparse text features.

Model: one weight vector w shared by all ordered thresholds c1 < c2 < ...,
``P(grade >= k) = sigmoid(w . x - c_k)``; the expected severity is the sum of
these probabilities over k (0 to the highest grade). A document is rejected
when ``P(grade >= 1)`` reaches ``reject``.

Features: the lower-cased words (letter and digit runs) of the whole text and
their first 4, 5 and 6 characters (so that inflected forms of a root count
together), each as occurrences per 100 words. The features kept are the
``features`` ones with the strongest difference in document frequency between
the toxic and the clean training rows.

Grades: the labels are binary, so grade 0 is a clean row and the toxic rows
are split at equal counts into grades 1..``grades`` by how much of their text
the strongest toxic features make up.

Training sample: at most ``per_class`` toxic and as many clean labelled rows,
chosen by a seeded hash of their ids (the documented bound); everything the
driver receives is bounded by the sample and the kept features. Scoring
covers every document.

Defined cases: null or empty text has no features and gets the score of the
thresholds alone. Several labels of a document: toxic wins; null labels are
not used. Without labelled rows of both classes there is nothing to learn:
severity 0, nothing rejected. Repeated rows are scored alike.

Scale: two passes over the sample, one map over the documents; no shuffle of
texts beyond the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of
from skuflow.session import materialize

PER_CLASS = 4000
FEATURES = 4096
GRADES = 3
REJECT = 0.5
PREFIXES = (4, 5, 6)
LEAST_ROWS = 3
CACHE_WORDS = 400_000


def word_features(word: str) -> list[str]:
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) >= n]


def _frequencies(batches):
    """Rows of (feature, toxic rows, clean rows) for the documents of a task."""
    import pyarrow as pa
    seen = {0: Counter(), 1: Counter()}
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(re.findall(r"\w+", text.lower()))
            seen[toxic].update({f for w in words for f in word_features(w)})
    names = list(seen[0].keys() | seen[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([seen[1][n] for n in part], pa.int64()),
                                          pa.array([seen[0][n] for n in part], pa.int64())], names=["feature", "toxic", "clean"])


def _vectors(index: dict[str, int]):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = re.findall(r"\w+", text.lower())
                counts = Counter()
                for w, n in Counter(words).items():
                    for f in word_features(w):
                        if f in index:
                            counts[index[f]] += n
                rows.append((toxic, list(counts.keys()), [100.0 * n / len(words) for n in counts.values()]))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.list_(pa.int32())),
                                              pa.array(cols[2], pa.list_(pa.float64()))], names=["toxic", "at", "rate"])
    return run


class Ordinal:
    """Cumulative-link model with shared weights, fitted by full-batch Adam on the mean log loss of all thresholds."""

    def __init__(self, grades: int, weights: np.ndarray, cuts: np.ndarray):
        self.grades, self.weights, self.cuts = grades, weights, cuts

    @classmethod
    def fit(cls, rows: np.ndarray, cols: np.ndarray, rates: np.ndarray, grade: np.ndarray, width: int, grades: int,
            rounds: int = 400, step: float = 0.15, ridge: float = 1e-4) -> "Ordinal":
        n = len(grade)
        above = (grade[:, None] >= np.arange(1, grades + 1)).astype(float)
        weights = np.zeros(width)
        first = np.log((1 - above.mean(axis=0) + 1e-3) / (above.mean(axis=0) + 1e-3))
        # cuts = first cut, then positive gaps: stays ordered
        raw = np.concatenate((first[:1], np.log(np.maximum(np.diff(first), 0.1))))
        moment, square = np.zeros(width + grades), np.zeros(width + grades)
        for t in range(1, rounds + 1):
            cuts = np.concatenate((raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))))
            z = np.bincount(rows, rates * weights[cols], minlength=n)
            p = 1 / (1 + np.exp(-np.clip(z[:, None] - cuts, -35, 35)))
            miss = (p - above) / n
            gw = np.bincount(cols, rates * miss.sum(axis=1)[rows], minlength=width) + ridge * weights
            gc = -miss.sum(axis=0)
            graw = np.concatenate(([gc.sum()], np.exp(raw[1:]) * np.cumsum(gc[::-1])[::-1][1:]))
            g = np.concatenate((gw, graw))
            moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
            move = step * (moment / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-8)
            weights, raw = weights - move[:width], raw - move[width:]
        return cls(grades, weights, np.concatenate((raw[:1], raw[0] + np.cumsum(np.exp(raw[1:])))))

    def at_least(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.asarray(z)[:, None] - self.cuts, -35, 35)))


def severity_grades(rows, cols, rates, toxic: np.ndarray, evidence: np.ndarray, grades: int) -> np.ndarray:
    """0 for clean rows; toxic rows in ``grades`` equal parts by the rate of toxic evidence (ties by position)."""
    amount = np.bincount(rows, rates * evidence[cols], minlength=len(toxic))
    bad = np.flatnonzero(toxic == 1)
    order = bad[np.argsort(amount[bad], kind="stable")]
    grade = np.zeros(len(toxic), dtype=int)
    grade[order] = 1 + np.arange(len(order)) * grades // max(1, len(order))
    return grade


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES, grades: int = GRADES,
          seed: int = 3) -> tuple[dict[str, float], np.ndarray] | None:
    """(weight of each feature, thresholds), or None without rows of both classes."""
    marks = (labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic"))
             .where("__id is not null and __toxic in (0, 1)").groupBy("__id").agg(F.max("__toxic").alias("__toxic")))
    order = [F.xxhash64(F.lit(seed), F.col("__id")), F.col("__id")]
    chosen = materialize(marks.where("__toxic = 1").orderBy(*order).limit(per_class)
                         .unionAll(marks.where("__toxic = 0").orderBy(*order).limit(per_class)), "tox-rows")
    # at most 2 * per_class rows are broadcast
    joined = docs.select(F.col("doc_id").alias("__id"), text_of().alias("__text")).join(F.broadcast(chosen), "__id")
    sample = materialize(joined.dropDuplicates(["__id"]).select("__toxic", "__text"), "tox-sample")
    size = {r["__toxic"]: r["count"] for r in sample.groupBy("__toxic").count().collect()}
    if not size.get(0) or not size.get(1):
        return None
    spread = sample.repartition(max(8, sample.sparkSession.sparkContext.defaultParallelism))
    counts = (spread.mapInArrow(_frequencies, "feature string, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") + F.col("clean") >= LEAST_ROWS))
    a, b = F.col("toxic") / F.lit(float(size[1])), F.col("clean") / F.lit(float(size[0]))
    both = (F.col("toxic") + F.col("clean")) / F.lit(float(size[0] + size[1]))
    spread_of = F.sqrt(both * (1.0 - F.least(both, F.lit(0.999))) * F.lit(1 / size[0] + 1 / size[1]))
    top = (counts.withColumn("z", (a - b) / spread_of)
           .orderBy(F.desc(F.abs("z")), "feature").limit(features).select("feature", "toxic", "clean").collect())
    index = {r["feature"]: i for i, r in enumerate(top)}
    if not index:
        return None
    got = spread.mapInArrow(_vectors(index), "toxic int, at array<int>, rate array<double>").collect()
    got.sort(key=lambda r: (r["toxic"], list(zip(r["at"], r["rate"]))))
    toxic = np.array([r["toxic"] for r in got])
    rows = np.repeat(np.arange(len(got)), [len(r["at"]) for r in got])
    cols = np.array([c for r in got for c in r["at"]], dtype=int)
    rates = np.array([v for r in got for v in r["rate"]], dtype=float)
    evidence = np.array([(r["toxic"] / size[1] > 8 * (r["clean"] + 0.5) / size[0]) and r["feature"][0] == "=" for r in top], dtype=float)
    grade = severity_grades(rows, cols, rates, toxic, evidence, grades)
    model = Ordinal.fit(rows, cols, rates, grade, len(index), grades)
    return {f: float(model.weights[i]) for f, i in index.items()}, model.cuts


SCORE = "struct<severity:double,toxic_probability:double,grade:int>"


def _scorer(weights: dict[str, float], cuts: np.ndarray):
    def run(parts):
        class Weights(dict):
            def __missing__(self, word):
                w = sum(weights.get(f, 0.0) for f in word_features(word))
                if len(self) < CACHE_WORDS and len(word) <= 40:
                    self[word] = w
                return w

        known = Weights()
        model = Ordinal(len(cuts), np.zeros(0), cuts)
        for texts in parts:
            z = []
            for text in texts:
                words = re.findall(r"\w+", text.lower())
                z.append(100.0 * sum(map(known.__getitem__, words)) / len(words) if words else 0.0)
            p = model.at_least(np.array(z, dtype=float))
            yield pd.DataFrame({"severity": p.sum(axis=1), "toxic_probability": p[:, 0] if len(z) else p.sum(axis=1),
                                "grade": (p >= 0.5).sum(axis=1).astype("int32")})
    return run


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES, grades: int = GRADES,
                    reject: float = REJECT, seed: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, ...) with one more column ``__tox``: severity (expected grade),
    toxic_probability, grade (most severe one at least as likely as not), rejected."""
    fitted = train(docs, labels, per_class, features, grades, seed)
    if fitted is None:
        score = F.struct(F.lit(0.0).alias("severity"), F.lit(0.0).alias("toxic_probability"), F.lit(0).alias("grade"))
    else:
        run = _scorer(*fitted)

        def score_text(texts):
            return run(texts)
        score_text.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        score = F.pandas_udf(score_text, SCORE)(text_of())
    scored = docs.withColumn("__score", score)
    return scored.withColumn("__tox", F.struct(
        F.col("__score.severity").alias("severity"), F.col("__score.toxic_probability").alias("toxic_probability"),
        F.col("__score.grade").alias("grade"), (F.col("__score.toxic_probability") >= reject).alias("rejected"))).drop("__score")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, table(spark, sf_dir, "labels")).select("doc_id", "__tox.*")
