"""Quality classifier (operator 8): histogram gradient-boosted trees.

Every text becomes a row of statistics (``FEATURES``): shares of character
kinds, word and line lengths, repetition. The statistics are cut into at most
``BINS`` bins by quantiles of the training rows, trees of fixed depth are grown
on histograms of gradients, and the finished forest is three flat arrays, so
scoring walks all rows down a tree level by level in numpy.

The forest is fitted on the driver from a bounded sample: at most ``sample``
labelled rows, those of smallest hash. Features of the sample are computed by
Spark, and so are all scores, in one pass over whole texts without a shuffle.
Label, language, source and id are not inputs.

Defined cases: null and empty texts are scored like any other text; labels
that are null or neither 0 nor 1 are not learned from; with no label, or one
class only, every score is that class's share (0.5 without labels); repeated
rows count as often as they occur; other columns pass through, those named
like an output column are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.llm import tokens

SAMPLE, BINS, TREES, DEPTH, RATE = 20_000, 64, 80, 4, 0.15
_KINDS = {  # character kinds by byte
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "blank": b" \t\x0b\x0c\r", "newline": b"\n", "stop": b".", "comma": b",", "mark": b"!?", "bar": b"|",
    "symbol": b"$%&*#@^~_=+<>\\/`", "quote": b"'\"()[]{}:;-",
}
_KIND = np.full(256, len(_KINDS), dtype=np.int64)  # control characters and the like
_KIND[128:] = len(_KINDS) + 1
for _k, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _k
_N_KINDS = len(_KINDS) + 2
FEATURES = (*(f"share_{k}" for k in (*_KINDS, "control", "beyond_ascii")), "log_bytes", "log_words", "word_bytes",
            "long_words", "distinct_words", "top_word", "symbol_ends", "upper_words", "lines", "line_words",
            "distinct_lines", "top_line", "repeats", "stop_words")


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    out = [np.zeros((0, len(FEATURES)))]
    for _, raw, bounds in tokens.chunks(column):
        n = len(bounds) - 1
        size = np.diff(bounds).astype(float)
        text = np.repeat(np.arange(n), np.diff(bounds))
        kind = _KIND[raw]
        shares = np.bincount(text * _N_KINDS + kind, minlength=n * _N_KINDS).reshape(n, _N_KINDS) / np.maximum(size, 1)[:, None]
        starts, ends = tokens.words(raw, bounds)
        owner = np.searchsorted(bounds, starts, side="right") - 1
        count = np.bincount(owner, minlength=n).astype(float)
        some = np.maximum(count, 1)
        per_word = lambda x: np.bincount(owner, weights=x, minlength=n) / some
        low = tokens.lower_ascii(raw)
        word = tokens.hashes(low, starts, ends)
        distinct, top = tokens.distinct_per_text(owner, word, n)
        last = kind[ends - 1] if len(ends) else np.zeros(0, np.int64)
        first_two = np.zeros(len(starts), dtype=bool)
        if len(starts):
            first_two = (kind[starts] == 1) & (kind[np.minimum(starts + 1, ends - 1)] == 1) & (ends - starts > 1)
        l_starts, l_ends = tokens.runs(raw != 10, bounds)
        l_owner = np.searchsorted(bounds, l_starts, side="right") - 1
        lines = np.bincount(l_owner, minlength=n).astype(float)
        l_distinct, l_top = tokens.distinct_per_text(l_owner, tokens.hashes(low, l_starts, l_ends), n)
        # a word that repeats the one before it
        same = np.zeros(len(word))
        if len(word) > 1:
            same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        out.append(np.column_stack([
            shares, np.log1p(size), np.log1p(count), per_word((ends - starts).astype(float)), per_word((ends - starts > 15) * 1.0),
            distinct / some, top / some, per_word((last == 9) * 1.0), per_word(first_two * 1.0), np.log1p(lines),
            count / np.maximum(lines, 1), l_distinct / np.maximum(lines, 1), l_top / np.maximum(lines, 1), per_word(same),
            per_word((ends - starts <= 3) * 1.0)]))
    return np.vstack(out)


@dataclass(frozen=True)
class Forest:
    """Complete trees in heap order: node ``i`` has the children ``2 i + 1`` and
    ``2 i + 2``; rows with ``x > cut`` go right."""
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves), log-odds
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            odds += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, *, trees=TREES, depth=DEPTH, rate=RATE, bins=BINS, ridge=2.0, least=8.0) -> Forest:
    """Boosted trees for the logistic loss. ``least`` rows stay in every child."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        odds = 0.0 if not len(y) else (30.0 if share else -30.0)
        return Forest(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), odds)
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])  # x > e[b] iff code > b
    flat = code + np.arange(f) * bins
    prior = float(np.log(share / (1 - share)))
    odds = np.full(n, prior)
    feature, cut, leaf = (np.zeros((trees, k), t) for k, t in ((inner, int), (inner, float), (leaves, float)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        cut[t] = np.inf  # nodes without a good cut send all rows left
        for level in range(depth):
            base = 2 ** level - 1
            wide = 2 ** level
            at = ((node - base)[:, None] * (f * bins) + flat).ravel()
            sums = [np.bincount(at, weights=np.repeat(w, f), minlength=wide * f * bins).reshape(wide, f, bins).cumsum(axis=2)
                    for w in (grad, hess, np.ones(n))]
            left, total = [s for s in sums], [s[:, :, -1:] for s in sums]
            right = [a - b for a, b in zip(total, left)]
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - total[0] ** 2 / (total[1] + ridge)
            gain[(left[2] < least) | (right[2] < least)] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            for k, b in enumerate(best):
                j, b = divmod(int(b), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, base + k], cut[t, base + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        spot = node - inner
        g, h = (np.bincount(spot, weights=w, minlength=leaves) for w in (grad, hess))
        leaf[t] = rate * g / (h + ridge)
        odds += leaf[t][spot]
    return Forest(feature, cut, leaf, prior)


def train(docs: DataFrame, labels: DataFrame, *, ident: str = "doc_id", text: str = "text", label: str = "quality",
          usable: Column, sample: int = SAMPLE) -> Forest:
    """Fit on at most ``sample`` documents of labels for which ``usable`` (an
    expression over ``labels``) holds: those of least hash of their id. Rows that
    repeat an id, a label and a text count once."""
    chosen = (labels.filter(usable & F.col(label).isin(0, 1) & F.col(ident).isNotNull())
              .select(F.col(ident).alias("__id"), F.col(label).cast("double").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample))
    joined = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__t")).join(
        F.broadcast(chosen), "__id")  # at most ``sample`` rows

    def rows(batches):
        for batch in batches:
            x = statistics(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["id", "y", "x"])

    # an id may have several texts: the bound holds for the rows that are fitted
    found = joined.select("__t", "__id", "__y").mapInArrow(
        rows, T.StructType([T.StructField("id", docs.schema[ident].dataType), *T.StructType.fromDDL("y double, x array<double>")]))
    got = found.distinct().orderBy(F.xxhash64("id"), "id", "y", "x").limit(sample).collect()
    got.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["y"] for r in got]))


def score(df: DataFrame, forest: Forest, *, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` with the score of its texts as the last column."""
    df = df.drop(to)
    at = df.columns.index(text)

    def rows(batches):
        for batch in batches:
            s = forest.score(statistics(batch.column(at).cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, to])

    return df.mapInArrow(rows, T.StructType([*df.schema.fields, T.StructField(to, T.DoubleType())]))
