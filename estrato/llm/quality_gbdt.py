"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on a bounded sample of labelled rows, level by level from histograms of gradients, and kept as flat
arrays of complete binary trees, so that a batch of documents walks all trees with array indexing alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000  # labelled rows that are learnt from at most
THRESHOLD = 0.7

STATISTICS = (
    "log_bytes log_words word_bytes distinct_words top_word same_as_previous punctuation symbols bars exclamations "
    "capitals digits spaces beyond_ascii log_lines words_per_line sentence_lines repeated_lines longest_word long_words"
).split()

_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCTUATION, _SYMBOLS, _BLANKS = b".,;:?'\"()-", b"#*$%&<>@^~=+_{}[]\\/", b" \t\n\x0b\x0c\r"


def statistics(text: str | None) -> list[float]:
    """The numbers of ``STATISTICS`` for one whole text; an empty or null text has zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [float(np.log1p(len(data)))] + [0.0] * (len(STATISTICS) - 1)
    n, size = len(words), len(data)
    share = lambda characters: (size - len(data.translate(None, characters))) / size
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    lengths = list(map(len, words))
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        sum(lengths) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        share(_PUNCTUATION),
        share(_SYMBOLS),
        data.count(b"|") / n,
        data.count(b"!") / n,
        share(_CAPITALS),
        share(_DIGITS),
        share(_BLANKS),
        (size - len(text)) / size,
        float(np.log1p(len(lines))),
        n / len(lines),
        sum(line.rstrip()[-1] in b".?!" for line in lines) / len(lines),
        1 - len(set(lines)) / len(lines),
        float(max(lengths)),
        sum(length > 20 for length in lengths) / n,
    ]


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in flat arrays; node k has children 2k + 1 and 2k + 2, the leaves come last."""

    prior: float
    feature: np.ndarray  # [trees, inner nodes]
    threshold: np.ndarray  # rows above it go right; infinite where a node is not split
    leaf: np.ndarray  # [trees, leaves]

    def margins(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        rows, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        return self.prior + self.leaf[tree, node - inner].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(x)))


def grow(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    bins: int = 32,
    rate: float = 0.2,
    ridge: float = 1.0,
    least: int = 5,
) -> Forest:
    """Second-order boosting of the logistic loss. Without rows, or with one label only, the forest is its prior."""
    n, width = len(x), len(STATISTICS)
    share = (float(y.sum()) + 1.0) / (n + 2.0)
    prior = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    forest = Forest(
        prior, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    )
    if n == 0 or y.min() == y.max():
        return replace(forest, feature=forest.feature[:1], threshold=forest.threshold[:1], leaf=forest.leaf[:1])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(n, prior)
    column = np.arange(width) * bins
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * (width * bins) + column + binned).ravel()
            shape = (count, width, bins)
            sums = [
                np.bincount(slot, np.repeat(v, width), count * width * bins).reshape(shape).cumsum(axis=2)
                for v in (gradient, weight, np.ones(n))
            ]
            (gl, hl, nl), (g, h, m) = sums, (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(nl < least) | (m - nl < least)] = 0
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            for k in np.flatnonzero(flat[np.arange(count), best] > 1e-9):
                j, b = divmod(int(best[k]), bins)
                if b < len(cuts[j]):
                    forest.feature[t, first + k], forest.threshold[t, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), forest.feature[t, node]] > forest.threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, gradient, leaves), np.bincount(at, weight, leaves)
        forest.leaf[t] = -rate * g / (h + ridge)
        margin += forest.leaf[t, at]
    return forest


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = SAMPLE,
) -> Forest:
    """A forest from at most ``sample`` labelled ids, those with the smallest hashes.

    ``labels`` holds only rows that may be learnt from. Rows without id or label do not count; an id with several
    labels has the smallest. The ids are few enough to broadcast by that bound; a document's statistics are computed
    where it lies, and only they reach the driver.
    """
    chosen = (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .groupBy(F.col(id_column).alias("__id"))
        .agg(F.min(F.col(label_column).cast("double")).alias("label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    found = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text")).join(
        F.broadcast(chosen), "__id"
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = pd.DataFrame(matrix(rows["text"]), columns=STATISTICS)
            out.insert(0, "label", rows["label"].to_numpy() > 0)
            yield out

    schema = "label boolean, " + ", ".join(f"{name} double" for name in STATISTICS)
    rows = found.select("text", "label").mapInPandas(measure, schema).toPandas()
    rows = rows.sort_values(list(rows.columns))  # the order of tasks must not matter
    return grow(rows[STATISTICS].to_numpy(np.float64).reshape(-1, len(STATISTICS)), rows["label"].to_numpy(float))


def scorer(forest: Forest):
    """A column function from a text to its score, 0 to 1; higher means that label 1 is likelier."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(forest.scores(matrix(texts)))

    return score


def classify(docs: DataFrame, labels: DataFrame, text_column: str = "text", **options: object) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``THRESHOLD`` on); columns of those names are replaced.

    Only the whole text is an input of a score; null and empty texts are scored as texts without words. Repeated rows
    score alike. Without labels every score is the prior; no rows give no rows.
    """
    forest = learn(docs, labels, text_column=text_column, **options)
    scored = docs.withColumn("score", scorer(forest)(F.col(text_column)))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
