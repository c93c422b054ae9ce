"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another, each a logistic model over words
and word beginnings plus the log-odds of the categories before it. While
training, those come from out-of-fold predictions, so that a later model never
sees an earlier one's answer for a row that the earlier one was fitted on.

The labels give one category, ``toxic``. The next ones are grades of it that the
labelled texts themselves define: ``repeated`` texts hold at least the median number of
telling features of toxic texts, ``dense`` ones at least the median share of them. The
last link, ``verdict``, is about ``toxic`` again and sees all three before it. A document
is rejected when it reaches the threshold that serves the last link's out-of-fold scores
best (the highest F1 of the labels that the sampled rows stand for).

Fitting uses at most ``sample`` labelled documents of each class, those of the
smallest id hash; features are chosen by their counts in that sample. Where that
draws the classes at different rates, rows weigh as many labels as they stand for,
so that the classes keep their shares of all labels. Every document is scored whole.

Defined cases: a null or empty text has no features; repeated label rows count
once, as toxic if any says so; null labels and labels of no document are left
out; without both classes every probability is 0 and nothing is rejected;
repeated rows are scored alike; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (letter_codes, map_texts, own_columns, stored, text_slices, word_bounds,
                                word_hashes)

CATEGORIES = ("toxic", "repeated", "dense", "verdict")
SAMPLE = 4000  # labelled documents of each class that a model is fitted on, at most
FEATURES = 512
LEAST_TEXTS = 5  # sampled texts that hold a feature, at least
FOLDS = 5
PREFIX_BYTES = 4
RIDGE = 0.3

_CODES = letter_codes(fold_case=True)
_OF_PREFIX = np.uint64(0x5851F42D4C957F2D)
FOUND_DDL = "doc_id long, features array<long>"


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) for each word and each beginning of a longer word, and words per text."""
    starts, ends, texts = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, _CODES)
    longer = ends - starts > PREFIX_BYTES
    begins = word_hashes(data, starts[longer], starts[longer] + PREFIX_BYTES, _CODES) ^ _OF_PREFIX
    return (np.concatenate([texts, texts[longer]]), np.concatenate([words, begins]),
            np.bincount(texts, minlength=len(offsets) - 1))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, data, offsets in text_slices(batch):
            texts, found, _ = _features(data, offsets)
            order = np.lexsort((found, texts))
            texts, found = texts[order], found[order]
            fresh = np.ones(len(found), bool)
            fresh[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
            texts, found = texts[fresh], found[fresh]
            cuts = np.searchsorted(texts, np.arange(len(offsets)))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[first: first + len(offsets) - 1], pa.int64()), lists],
                                             names=["doc_id", "features"])


@dataclass
class Chain:
    """``features`` ascending; weights of each category: features, bias, then earlier categories; the
    log-odds of the last one from which a document is rejected."""

    features: np.ndarray
    weights: list[np.ndarray]
    least: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.weights)))
        for k, w in enumerate(self.weights):
            n = x.shape[1]
            out[:, k] = np.clip(x @ w[:n] + w[n] + out[:, :k] @ w[n + 1:], -30, 30)
        return out


def _fit(x: np.ndarray, y: np.ndarray, s: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Ridge logistic regression of rows of weight ``s`` by accelerated gradient steps; the bias is the last column, unpenalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-3
    v = np.ones(x.shape[1])
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (s * (x @ v))
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (0.25 * np.linalg.norm(np.sqrt(s) * (x @ v)) ** 2 + RIDGE)
    w = z = np.zeros(x.shape[1])
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -30, 30)))
        new = z - step * (x.T @ (s * (p - y)) + penalty * z)
        z = new + k / (k + 3) * (new - w)
        w = new
    return w


def best_cut(odds: np.ndarray, y: np.ndarray, s: np.ndarray) -> float:
    """The score of highest F1 for rows of weight ``s`` from which on they are taken, the highest of the best."""
    order = np.argsort(-odds, kind="stable")
    score, hit, all_ = odds[order], np.cumsum((s * y)[order]), np.cumsum(s[order])
    last = np.append(score[1:] != score[:-1], True)  # a cut takes all equal scores
    f1 = np.where(last, 2 * hit / (all_ + (s * y).sum()), -1.0)
    return float(score[int(np.argmax(f1))])


def fit_chain(x: np.ndarray, labels: list[np.ndarray], features: np.ndarray, folds: np.ndarray,
              stands: np.ndarray | None = None) -> Chain:
    """Each model sees the earlier categories as models of the other folds predict them; ``stands`` weighs the rows.
    The cut of the last one comes from its own out-of-fold scores."""
    weights, earlier = [], np.zeros((len(x), 0))
    stands = np.ones(len(x)) if stands is None else stands
    for y in labels:
        whole = np.hstack([x, earlier])
        out_of_fold = np.zeros(len(x))
        for fold in range(FOLDS):
            held = folds == fold
            if held.any() and not held.all():
                w = _fit(whole[~held], y[~held], stands[~held])
                out_of_fold[held] = np.clip(whole[held] @ w[:-1] + w[-1], -30, 30)
        w = _fit(whole, y, stands)
        n = x.shape[1]
        weights.append(np.concatenate([w[:n], w[-1:], w[n:-1]]))
        earlier = np.hstack([earlier, out_of_fold[:, None]])
    chain = Chain(features, weights)
    # a text without features says nothing, so it is never rejected
    silent = float(chain.log_odds(np.zeros((1, x.shape[1])))[0, -1])
    chain.least = max(best_cut(earlier[:, -1], labels[-1], stands), silent + 1e-9)
    return chain


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """The chain fitted on a bounded sample of labelled documents; None without both classes."""
    known = own_columns(labels, {"doc_id": "doc_id", "toxic": "toxic"}).dropna().groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).withColumn("draw", F.xxhash64("doc_id"))
    labelled = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = [known.filter(c).orderBy("draw", "doc_id").limit(sample) for c in ("toxic = 1", "toxic = 0")]
    chosen = F.broadcast(drawn[0].union(drawn[1]).drop("draw"))
    texts = own_columns(docs, {"doc_id": "doc_id", "text": "text"}).join(chosen.select("doc_id"), "doc_id")
    found = stored(map_texts(texts, _extract, FOUND_DDL).join(chosen, "doc_id"), "features")
    sizes = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    # labels that a drawn row stands for, and the classes' shares of all that
    each = {c: labelled[c] / min(labelled[c], sample) for c in (0, 1)}
    whole = sum(each[c] * sizes[c] for c in (0, 1))
    part = {c: each[c] * sizes[c] / whole for c in (0, 1)}
    counts = found.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).filter(F.col("a") + F.col("b") >= LEAST_TEXTS)
    a, b = F.col("a") / sizes[1], F.col("b") / sizes[0]
    # the signed root of the chi-square statistic ranks how surely a feature tells the classes apart
    score = F.abs(a - b) / F.sqrt(a * part[1] + b * part[0])
    best = counts.withColumn("score", score).orderBy(F.desc("score"), "feature").limit(FEATURES).collect()
    features = np.array(sorted(np.uint64(r["feature"] & (2**64 - 1)) for r in best), np.uint64)
    telling = np.isin(features, np.array([r["feature"] & (2**64 - 1) for r in best
                                          if r["a"] / sizes[1] > 8 * (r["b"] + 0.5) / sizes[0]], np.uint64))
    wanted = F.array(*[F.lit(int(f)) for f in features.view(np.int64)])
    rows = found.select("doc_id", "toxic", F.size("features").alias("n"),
                        F.array_intersect("features", wanted).alias("hits")).orderBy("doc_id").collect()
    x = np.zeros((len(rows), len(features)))
    for i, r in enumerate(rows):
        x[i, np.searchsorted(features, np.array(r["hits"], np.int64).view(np.uint64))] = 1
    toxic = np.array([r["toxic"] for r in rows], float)
    told = x[:, telling].sum(axis=1)
    share = told / np.maximum(1, [r["n"] for r in rows])
    grade = lambda v: toxic * (v >= max(np.median(v[toxic == 1]), 1e-9))
    folds = np.array([(r["doc_id"] * 0x9E3779B97F4A7C15 >> 17) % FOLDS for r in rows])
    stands = np.where(toxic == 1, each[1], each[0]) * (len(rows) / whole)
    return fit_chain(x, [toxic, grade(told), grade(share), toxic], features, folds, stands)


def _score(chain: Chain | None, keep_columns: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.zeros(1 << 20, bool)
        if chain is not None:
            near[chain.features >> np.uint64(44)] = True
        for batch in batches:
            n = batch.num_rows
            odds = np.full((n, len(CATEGORIES)), -np.inf)
            if chain is not None:
                for first, data, offsets in text_slices(batch):
                    texts, found, _ = _features(data, offsets)
                    hit = near[found >> np.uint64(44)]
                    texts, found = texts[hit], found[hit]
                    at = np.minimum(np.searchsorted(chain.features, found), len(chain.features) - 1)
                    same = chain.features[at] == found
                    x = np.zeros((len(offsets) - 1, len(chain.features)))
                    x[texts[same], at[same]] = 1
                    odds[first: first + len(x)] = chain.log_odds(x)
            p = 1 / (1 + np.exp(-odds))
            rejected = odds[:, -1] >= (np.inf if chain is None else chain.least)
            if keep_columns:
                yield batch.filter(pa.array(~rejected))
            else:
                columns = [pa.array(np.round(p[:, k], 6)) for k in range(p.shape[1])]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(rejected)],
                                                 names=["doc_id", *[f"p_{c}" for c in CATEGORIES], "rejected"])

    return run


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, a probability per category, rejected."""
    chain = train(docs, labels)
    rows = own_columns(docs, {"doc_id": "doc_id", "text": "text"})
    shape = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", rejected boolean"
    return map_texts(rows, _score(chain, False), shape)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return map_texts(docs, _score(train(docs, labels), True), docs.schema)
