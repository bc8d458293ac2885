"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from every whole text in Arrow batches (characters by class, words, lines, repeats). The
trees are fitted in one task on a bounded sample of labelled documents, ``sample_docs`` at most on average and up to
half of it of each class, each weighted by how many documents it stands for, so scores stay probabilities. A
statistic is cut into at most ``bins`` bins at quantiles of the sample; a level of a tree is found from the
histograms of gradients over all nodes, statistics and bins. The fitted trees are three flat arrays in heap order
(children of i at 2i + 1 and 2i + 2; a leaf above the last level sends all rows left), and NumPy moves all rows
of a batch through all trees one level at a time.

Only the text gives inputs. Labels are read from documents outside the held-out fold (crc32 of doc_id).

Defined results: a null text is empty, and an empty text has a score like any other; documents without a label, or
with contradicting labels, are not learned from; without labels every score is 0.5, with one class it is that class's
smoothed share; a null doc_id is not held out; repeated rows are scored one by one and learned from once; very long
texts are read whole; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import pickle
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package


@dataclass(frozen=True)
class ClassifierParams:
    sample_docs: int = 16384   # bound of the labelled sample (its expected size at most)
    trees: int = 80
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    l2: float = 1.0
    least_weight: float = 2.0  # of the rows (by second derivative) in a child
    folds: int = 5
    held_fold: int = 0
    cut: float = 0.3           # predicted 1 from this score on


UPPER, LOWER, DIGIT, SPACE, STOP, SYMBOL, MARK, CONTROL, BEYOND = range(9)
_CLASS = np.full(256, MARK, dtype=np.int64)
_CLASS[:33], _CLASS[127] = CONTROL, CONTROL
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = DIGIT, UPPER, LOWER, BEYOND
_CLASS[list(b".,;:?'\"()")] = STOP
_CLASS[list(b"#*$%&|<>")] = SYMBOL

STATISTICS = ("log_chars", "log_words", "word_chars", "longest_word", "short_words", "distinct_words", "top_word", "repeated_windows", "marked_words", "capital_words",
              "log_lines", "repeated_lines", "line_words", "sentence_words", "upper", "lower", "digits", "spaces", "stops", "symbols", "marks", "controls", "beyond_ascii",
              "exclamations", "entropy")


def statistics(text: bytes) -> list[float]:
    """The values of STATISTICS for one UTF-8 text; shares are 0 where there is nothing to share."""
    raw = np.frombuffer(text, dtype=np.uint8)
    hist = np.bincount(raw, minlength=256)
    n = len(raw)
    by_class = np.bincount(_CLASS, weights=hist, minlength=9)
    letters = by_class[UPPER] + by_class[LOWER]
    chars = n - int(hist[128:192].sum())
    words = text.split()  # ASCII white space
    k = len(words)
    counts = Counter(words)
    windows = Counter(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = hist[hist > 0] / max(n, 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=k)
    return [
        np.log1p(chars), np.log1p(k), lengths.sum() / max(k, 1), np.log1p(lengths.max(initial=0)), (lengths <= 3).sum() / max(k, 1), len(counts) / max(k, 1),
        max(counts.values(), default=0) / max(k, 1), sum(c for c in windows.values() if c > 1) / max(k - 2, 1),
        sum(c for w, c in counts.items() if not w[-1:].isalnum() and w[-1] < 128) / max(k, 1), sum(c for w, c in counts.items() if w.isupper()) / max(k, 1),
        np.log1p(len(lines)), (len(lines) - len(set(lines))) / max(len(lines), 1), k / max(len(lines), 1), k / (1 + hist[46]),
        by_class[UPPER] / max(letters, 1), by_class[LOWER] / max(letters, 1), *(by_class[c] / max(n, 1) for c in (DIGIT, SPACE, STOP, SYMBOL, MARK, CONTROL, BEYOND)),
        hist[33] / max(n, 1), float(-(share * np.log2(share)).sum())]


def held_out(doc_id: Column, p: ClassifierParams) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(p.folds)) == p.held_fold, F.lit(False))


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    def run(batches):
        for b in batches:
            x = np.array([statistics(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()], dtype=np.float32).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32), x.ravel())], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<float>")


@dataclass
class Trees:
    """Flat trees in heap order: inner nodes (trees, 2**depth - 1), leaves (trees, 2**depth); ``start`` in log odds."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row; all rows go down all trees level by level."""
        total = np.full(len(x), self.start)
        trees, inner = self.feature.shape
        rows, of = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), dtype=np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[of, node]] > self.threshold[of, node])
        return 1 / (1 + np.exp(-(total + self.leaf[of, node - inner].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, p: ClassifierParams = ClassifierParams()) -> Trees:
    """Boosted trees of the logistic loss by histograms of gradients."""
    inner = 2 ** p.depth - 1
    ones = float((weight * y).sum())
    start = float(np.log((ones + 0.5) / (float(weight.sum()) - ones + 0.5)))
    empty = Trees(start, np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner), dtype=np.float32), np.zeros((0, inner + 1)))
    if len(np.unique(y)) < 2:
        return empty
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, p.bins + 1)[1:-1], method="lower")) for f in range(m)]
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)  # bin b: values up to edge b
    flat = code + np.arange(m)[None, :] * p.bins
    usable = np.stack([np.arange(p.bins) < len(e) for e in edges])  # a cut after bin b needs edge b
    odds, trees = np.full(n, start), []
    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-odds))
        g, h = weight * (prob - y), weight * prob * (1 - prob)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf, dtype=np.float32)
        node = np.zeros(n, dtype=np.int64)
        for level in range(p.depth):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (m * p.bins) + flat).ravel()
            hist = [np.bincount(at, weights=np.repeat(v, m), minlength=width * m * p.bins).reshape(width, m, p.bins) for v in (g, h)]
            left_g, left_h = (v.cumsum(axis=2) for v in hist)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g ** 2 / (left_h + p.l2) + right_g ** 2 / (right_h + p.l2) - all_g ** 2 / (all_h + p.l2)
            gain[~(usable[None] & (left_h >= p.least_weight) & (right_h >= p.least_weight))] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(width, -1).max(axis=1) > 1e-9):
                f, b = divmod(int(best[k]), p.bins)
                feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        place = node - inner
        leaf = -p.rate * np.bincount(place, weights=g, minlength=inner + 1) / (np.bincount(place, weights=h, minlength=inner + 1) + p.l2)
        odds = odds + leaf[place]
        trees.append((feature, threshold, leaf))
    return Trees(start, *(np.stack(v) for v in zip(*trees)))


def fit_classifier(features: DataFrame, labels: DataFrame, p: ClassifierParams = ClassifierParams()) -> Trees:
    """Trees from the labels (doc_id, quality) of documents outside the held-out fold; features: (doc_id, x)."""
    quality = F.col("quality").cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), quality.alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"), p)).groupBy("doc_id").agg(
        F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").select("doc_id", "y")
    known = materialize(known)
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two rows
    share = {y: min(1.0, p.sample_docs / 2 / n) for y, n in counts.items()}
    draw = (F.xxhash64(F.lit("sample"), "doc_id") / F.lit(float(1 << 64))) + 0.5  # in [0, 1]
    drawn = known.filter(draw < F.when(F.col("y") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    # about sample_docs short rows; a document that occurs more than once gives one of them
    sample = features.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(F.min("x").alias("x"))

    def run(_, t):
        by = np.argsort(t.column("doc_id").to_numpy(), kind="stable")
        y = t.column("y").to_numpy()[by].astype(np.float64)
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)[by]
        weight = np.array([1 / share[int(v)] for v in y])
        return pa.table([pa.array([pickle.dumps(fit_trees(x, y, weight / weight.mean(), p))], pa.binary())], names=["trees"])

    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(run, "trees binary").collect()
    if fitted:
        return pickle.loads(fitted[0]["trees"])
    return fit_trees(np.zeros((0, len(STATISTICS)), dtype=np.float32), np.zeros(0), np.zeros(0), p)


def with_scores(features: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) for every row of (doc_id, x)."""
    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, len(STATISTICS)), dtype=np.float32)
            s = np.concatenate([trees.scores(x[at:at + 4096]) for at in range(0, len(x), 4096)]) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return features.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, p: ClassifierParams = ClassifierParams()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    with_package(docs.sparkSession)
    features = materialize(document_statistics(docs))
    return with_scores(features, fit_classifier(features, labels, p)).select(
        "doc_id", held_out(F.col("doc_id"), p).alias("held_out"), "score", (F.col("score") >= p.cut).cast("int").alias("predicted"))
