"""Operator 6: quality classifier — histogram gradient-boosted trees over document statistics.

``statistics`` turns each whole text into ``FEATURES`` numbers in one pass (numpy over Arrow batches). ``fit`` grows complete
binary trees on quantile histograms of the labelled rows, and keeps them flattened: per tree one array of features, thresholds
and leaf values, so that ``Trees.score`` walks all rows through all trees by array indexing alone.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled rows (those of the smallest hashed doc_id); everything
else covers all rows.

Edge cases: a null text is empty; empty texts have a score like any other; a null doc_id is never a training row nor
held out; of labels that share a doc_id the smallest counts; without labels of both kinds every score is the share of label 1
(0.5 without labels); repeated rows repeat; extra columns are kept by ``classify`` except those named as its outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textnp import slices, words

#: The most labelled rows that the classifier is fitted on.
TRAIN_ROWS = 20_000

FEATURES = [
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "distinct_words", "top_word", "repeated_next", "upper", "digit", "space", "newline",
    "period", "comma", "exclaim", "pipe", "marks", "other_punctuation", "wide", "distinct_bytes", "byte_entropy", "words_a_line", "caps_words", "short_words",
]
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t", "newline": b"\n", "period": b".", "comma": b",", "exclaim": b"!", "pipe": b"|",
    "marks": b"#$%&*@^~", "other_punctuation": b"\"'()-/:;<=>?[\\]_`{}+", "wide": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _TABLE[list(_bytes), _k] = 1
_UPPER = np.zeros(256, bool)
_UPPER[list(_CLASSES["upper"])] = True


def features_of(column) -> np.ndarray:
    """One row of FEATURES for each text of an Arrow string column."""
    out = np.zeros((len(column), len(FEATURES)))
    for first, end, buf, offsets in slices(column):
        hashes, starts, ends, rows = words(buf, offsets)
        length = (ends - starts).astype(float)
        caps = _UPPER[buf[starts]] & _UPPER[buf[ends - 1]] if len(starts) else np.zeros(0, bool)
        for k in range(end - first):
            a, b, w, v = offsets[k], offsets[k + 1], rows[k], rows[k + 1]
            size, n = int(b - a), int(v - w)
            counts = np.bincount(buf[a:b], minlength=256)
            share = counts[counts > 0] / max(size, 1)
            own = hashes[w:v]
            _, times = np.unique(own, return_counts=True)
            line = counts[10] + 1
            out[first + k] = [
                np.log1p(size), np.log1p(n), *((length[w:v].mean(), length[w:v].std(), length[w:v].max()) if n else (0, 0, 0)), len(times) / max(n, 1), times.max(initial=0) / max(n, 1),
                (own[1:] == own[:-1]).sum() / max(n, 1), *(counts @ _TABLE / max(size, 1)), len(share), -(share * np.log2(share)).sum() if size else 0, n / line, caps[w:v].sum() / max(n, 1),
                (length[w:v] <= 3).sum() / max(n, 1),
            ]
    return out


def statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those of keep) and ``features``: array<double>."""
    names = [c for c in (df.columns if keep is None else keep) if c != "features"]
    source = df.select(*dict.fromkeys([*names, text]))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), "features array<double>"])

    def run(batches):
        import pyarrow as pa

        width = len(FEATURES)
        for batch in batches:
            found = features_of(batch.column(batch.schema.get_field_index(text)))
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, width, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, column], [*names, "features"])

    return source.mapInArrow(run, schema)


@dataclass
class Trees:
    """Complete trees of one depth. Node i of a tree has children 2i+1 and 2i+2; leaves come last."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if len(self.feature):
            tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
            out += self.value[tree, node - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 1.0, shrink: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss; splits are read off gradient histograms of at most ``bins`` quantile bins."""
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if len(np.unique(y)) < 2:
        return Trees(base, depth, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    inner = 2**depth - 1
    feature, threshold, value = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            total_g, total_h = np.bincount(local, g, width), np.bincount(local, h, width)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                key = local * (len(c) + 1) + binned[:, j]
                left_g = np.bincount(key, g, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)[:, :-1]
                left_h = np.bincount(key, h, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)[:, :-1]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + shrink) + right_g**2 / (right_h + shrink) - (total_g**2 / (total_h + shrink))[:, None]
                gain[(left_h < least) | (right_h < least)] = 0
                at = gain.argmax(axis=1)
                found = gain[np.arange(width), at]
                better = found > best + 1e-9
                best[better] = found[better]
                feature[t, first : first + width][better] = j
                threshold[t, first : first + width][better] = c[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + shrink)
        raw += value[t, leaf]
    return Trees(base, depth, feature, threshold, value)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of doc_id as text leaves the given remainder; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", most: int = TRAIN_ROWS) -> Trees:
    """Fit on labelled rows outside the held-out fifth: the ``most`` of the smallest hashed doc_id. Only their texts are measured."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    known = known.groupBy("doc_id").agg(F.min(label).cast("double").alias("_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of two numbers are sent along.
    sample = docs.select("doc_id", text).join(F.broadcast(known), "doc_id")
    rows = statistics(sample, text, ["doc_id", "_y"]).orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(most).toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["_y"].to_numpy(float))


def classify(df: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", threshold: float = 0.3, most: int = TRAIN_ROWS, keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those of keep) and ``score``, ``predicted``; beyond the training rows each text is measured once and not shuffled."""
    names = [c for c in (df.columns if keep is None else keep) if c not in ("score", "predicted")]
    model = train(df, labels, label, text, most)
    source = df.select(*dict.fromkeys([*names, text]))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), "score double", "predicted int"])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            score = model.score(features_of(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return source.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, columns as they are, that are predicted to have label 1."""
    model = train(docs, labels)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            score = model.score(features_of(batch.column(batch.schema.get_field_index("text"))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
