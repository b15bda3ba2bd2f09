"""Toxicity: a classifier chain of linear models.

The categories are predicted one after the other: low quality, toxic, severe (both). The
labels hold one toxicity category, ``toxic``; low quality is a quality label that serves the
chain as an earlier category, and severe stands for rows that carry both.
Each category's model is a logistic regression on a text's distinct words and word
beginnings (hashed) and on the probabilities of the categories before it. In training,
those probabilities come out of fold: each document's from models that have not seen
it. In prediction they come from the chain itself.

The fit takes at most SAMPLE_ROWS labelled documents of each toxic label, those with
the smallest id hashes, weighted back to the labels' shares; labels whose hash cannot be
among those go before the ranking. The sample's hashed features
reach the driver, nothing else does. Every document is scored over its whole text, on
the executors.

Defined cases: a null text, or one without words, has probabilities 0 and is not toxic;
a category whose labels are all alike has that share as its probability, 0 without
labels; null labels do not count as labelled; of repeated labels of a document the
largest holds; repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import may_be_first, numbered, renumbered, table, take
from .shingles import WordHasher

CATEGORIES = ("low_quality", "toxic", "severe")
SAMPLE_ROWS = 4000
FOLDS = 5
FEATURE_BITS = 20
#: features a model keeps: those that tell its category best in the sample
FEATURES = 1024
LEAST_DOCUMENTS = 4
#: bytes of the word beginnings that are features too
PREFIXES = (4, 5, 6, 7)
RIDGE = 0.5
STEPS = 150
THRESHOLD = 0.5


def features(hasher: WordHasher, text: str | None) -> np.ndarray:
    return np.unique((hasher.words_and_prefixes(text, PREFIXES) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """The bounded training sample on the driver: doc_id, toxic, low_quality, weight, f (feature ids as bytes)."""
    marks = take(labels, doc_id="bigint", quality="int", toxic="int").filter("doc_id is not null and toxic is not null")
    marks = marks.groupBy("doc_id").agg(
        F.max((F.col("toxic") != 0).cast("int")).alias("toxic"), (1 - F.min((F.coalesce("quality", F.lit(1)) != 0).cast("int"))).alias("low_quality"))
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    of = F.when(F.col("toxic") == 1, F.lit(totals.get(1, 1))).otherwise(F.lit(totals.get(0, 1)))
    few = marks.filter(may_be_first(F.xxhash64("doc_id"), rows, of))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    kept = few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows).drop("nth")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for b in batches:
            yield b.assign(f=[features(hasher, t).tobytes() for t in b["text"]]).drop(columns="text")

    texts = take(docs, doc_id="bigint", text="string").filter("text is not null")
    out = texts.join(F.broadcast(kept), "doc_id").groupBy("doc_id", "toxic", "low_quality").agg(
        F.min("text").alias("text")).mapInPandas(
        run, "doc_id bigint, toxic int, low_quality int, f binary",
    ).toPandas().sort_values("doc_id", ignore_index=True)
    counts = out["toxic"].value_counts()
    out["weight"] = [totals[t] / counts[t] for t in out["toxic"]]
    return out


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic regression on the best features for its category and on earlier categories' logits."""

    def __init__(self, rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.ids, self.coefficients, self.earlier = np.zeros(0, np.int32), np.zeros(0), np.zeros(earlier.shape[1])
        share = float((weight * y).sum() / weight.sum()) if len(y) else 0.0
        self.constant = share if share in (0.0, 1.0) else None
        self.bias = 0.0
        if self.constant is not None:
            return
        width = 1 << FEATURE_BITS
        seen = np.zeros((2, width))
        for r, t in zip(rows, y, strict=True):
            seen[int(t), r] += 1
        n = np.bincount(y.astype(int), minlength=2)
        rate = (seen[1] + 0.5) / (n[1] + 1), (seen[0] + 0.5) / (n[0] + 1)
        noise = rate[0] * (1 - rate[0]) / (n[1] + 1) + rate[1] * (1 - rate[1]) / (n[0] + 1)
        tells = np.where(seen.sum(axis=0) >= LEAST_DOCUMENTS, np.abs(rate[0] - rate[1]) / np.sqrt(noise), 0.0)
        best = np.argsort(-tells, kind="stable")[:FEATURES]
        self.ids = np.sort(best[tells[best] > 0]).astype(np.int32)
        x = np.hstack([self._matrix(rows), earlier]).astype(np.float32)
        self._fit(x, y, weight / weight.mean())

    def _matrix(self, rows: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(rows), len(self.ids)), np.float32)
        for k, r in enumerate(rows):
            if len(self.ids):
                at = np.searchsorted(self.ids, r)
                at[at == len(self.ids)] = 0
                x[k, at[self.ids[at] == r]] = 1
        return x

    def _fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Accelerated gradient descent with per-column steps from bounds on the curvature."""
        y, weight = y.astype(np.float32), weight.astype(np.float32)
        step = 4 / (np.abs(x).T @ (weight * (np.abs(x).sum(axis=1) + 1)) + 4 * RIDGE)
        bias_step = np.float32(4) / (weight * (np.abs(x).sum(axis=1) + 1)).sum()
        w = v = np.zeros(x.shape[1], np.float32)
        b = c = np.float32(0)
        for k in range(STEPS):
            gap = weight * (_sigmoid(x @ v + c) - y)
            w_next, b_next = v - step * (x.T @ gap + RIDGE * v), c - bias_step * gap.sum()
            momentum = np.float32(k / (k + 3))
            v, c = w_next + momentum * (w_next - w), b_next + momentum * (b_next - b)
            w, b = w_next, b_next
        text = len(self.ids)
        self.coefficients, self.earlier, self.bias = w[:text], w[text:], b

    def probabilities(self, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        out = np.full(len(rows), self.bias) + earlier @ self.earlier
        if len(self.ids):
            for k, r in enumerate(rows):
                at = np.searchsorted(self.ids, r)
                at[at == len(self.ids)] = 0
                out[k] += self.coefficients[at[self.ids[at] == r]].sum()
        return _sigmoid(out)


def fit_chain(data: pd.DataFrame) -> list[Linear]:
    rows = [np.frombuffer(f, np.int32) for f in data["f"]]
    toxic, low = data["toxic"].to_numpy(float), data["low_quality"].to_numpy(float)
    truth = {"low_quality": low, "toxic": toxic, "severe": toxic * low}
    weight = data["weight"].to_numpy(float)
    fold = data["doc_id"].to_numpy() % FOLDS
    chain, earlier = [], np.zeros((len(rows), 0))
    for category in CATEGORIES:
        y = truth[category]
        chain.append(Linear(rows, earlier, y, weight))
        held = np.zeros(len(rows))
        for k in range(FOLDS if len(chain) < len(CATEGORIES) else 0):
            own, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
            part = Linear([rows[i] for i in rest], earlier[rest], y[rest], weight[rest])
            held[own] = part.probabilities([rows[i] for i in own], earlier[own])
        earlier = np.hstack([earlier, _logit(held)[:, None]])
    return chain


def chain_probabilities(chain: list[Linear], rows: list[np.ndarray]) -> np.ndarray:
    earlier, out = np.zeros((len(rows), 0)), []
    some = np.array([len(r) > 0 for r in rows], dtype=bool)
    for model in chain:
        p = model.probabilities(rows, earlier)
        out.append(np.where(some, p, 0.0))
        earlier = np.hstack([earlier, _logit(p)[:, None]])
    return np.array(out).T.reshape(len(rows), len(chain))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, the probability of each category, toxic."""
    data = sample(docs, labels)
    chain = fit_chain(data)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for b in batches:
            p = chain_probabilities(chain, [features(hasher, t) for t in b["text"]])
            out = pd.DataFrame(p, columns=[f"p_{c}" for c in CATEGORIES], index=b.index)
            yield out.assign(k=b["k"], no_id=b["no_id"])

    ours = ", ".join(f"p_{c} double" for c in CATEGORIES)
    done = numbered(take(docs, doc_id="bigint", text="string")).mapInPandas(run, f"{ours}, k bigint, no_id boolean")
    return renumbered(done).withColumn("toxic", F.col("p_toxic") >= threshold)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
