"""Language-model scoring by context-tree weighting over bytes, beside a word unigram base.

A byte is coded as eight binary decisions; each decision node has its own context tree over the preceding bytes. At
every context the Krichevsky-Trofimov estimate is weighed against the product of its longer contexts, over all depths
from 0 to ``DEPTH``. Counts of (context, byte) grams come from all training texts. Subtrees below the last ``SHARED``
context bytes are computed in buckets of whole subtrees, so a task holds about the distinct grams of ``BUCKET`` bytes
of text or one subtree; the shorter contexts are aggregates and joins by key.

Documents do not fetch the model word by word: texts are dealt into blocks, a block asks once for every distinct gram
and word it has. All it asks of a bucket is one row: the sorted keys by their differences and their counts, compressed.
The bucket merges the rows of all blocks and answers each with an array of values in the order of its keys, which the
block finds again from its texts; keys do not travel back.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from estrato.llm.common import LOWER, WordHasher, mixed, word_spans

DEPTH = 6  # preceding bytes of the longest context; with the coded byte, 56 bits of a key
SHARED = 3  # last context bytes on which the grams of a subtree agree
BLOCK = 8 << 20  # bytes of text that share their questions
BUCKET = 4 << 20  # bytes of text whose grams make a bucket of subtrees, on average
CHUNK = 1 << 18  # bytes that are turned into grams at once, at least one text

_END = (0, 1)  # the key of the token after the last word

_first_half, _second_half = WordHasher(91), WordHasher(92)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit halves of every word's hash, and the number of words of each text.

    The second half is odd, which keeps words apart from grams (0).
    """
    data, starts, ends, counts = word_spans(texts)
    second = _second_half(data, starts, ends) | np.uint64(1)
    return _first_half(data, starts, ends).view(np.int64), second.view(np.int64), counts


def _distinct(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place where each stands, and the sum of its weights."""
    found, places, at = np.unique(keys, return_index=True, return_inverse=True)
    return found, places, np.bincount(at, weights, len(found)).astype(np.int64)


def grams(texts: list[bytes]) -> np.ndarray:
    """All grams of the texts in a row: ``DEPTH`` context bytes (0 before the start) and the byte, packed.

    A text of n bytes has n + 1 grams; the last codes its end as byte 0.
    """
    buffer = np.frombuffer(b"".join(b"\0" * DEPTH + t + b"\0" for t in texts), np.uint8).astype(np.int64)
    n = len(buffer) - DEPTH
    packed = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        packed = (packed << 8) | buffer[k : k + n]
    keep = np.ones(n, bool)
    sizes = np.array([len(t) + 1 + DEPTH for t in texts])
    for at in np.cumsum(sizes)[:-1]:
        keep[at - DEPTH : at] = False
    return packed[keep]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= CHUNK or i + 1 == len(texts):
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers by planes of equal bytes, compressed."""
    if not len(numbers):
        return b""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, 8 * size, codec="zstd", asbytes=True), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _packed_sorted(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys.view(np.uint64), prepend=np.uint64(0)))  # modulo 2**64


def _unpacked_sorted(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, size, np.uint64), dtype=np.uint64).view(np.int64)


def _rounded(values: np.ndarray) -> np.ndarray:
    """Doubles to 36 binary digits, an error of 1e-11 of a value, so that two of their eight bytes are zero."""
    return ((values.view(np.uint64) + np.uint64(1 << 15)) & np.uint64(0xFFFFFFFFFFFF0000)).view(float)


_TOP, _REST = 8 * SHARED, 8 * (DEPTH - SHARED)


def _turned(keys: np.ndarray) -> np.ndarray:
    """Grams with their last ``SHARED`` context bytes first, so that those of a subtree lie close together."""
    subtree, older = (keys >> 8) & ((1 << _TOP) - 1), keys >> (8 + _TOP)
    return (((subtree << _REST) | older) << 8) | (keys & 255)


def _turned_back(keys: np.ndarray) -> np.ndarray:
    subtree, older = keys >> (8 + _REST), (keys >> 8) & ((1 << _REST) - 1)
    return (((older << _TOP) | subtree) << 8) | (keys & 255)


def _places(buckets: np.ndarray) -> dict[int, np.ndarray]:
    """For each bucket the places that hold it, ascending."""
    order = np.argsort(buckets, kind="stable")
    found, starts = np.unique(buckets[order], return_index=True)
    return dict(zip(found.tolist(), np.split(order, starts[1:])))


QUESTION = StructType(
    [StructField(name, IntegerType(), False) for name in ("block", "bucket")]
    + [StructField(name, LongType(), False) for name in ("n_words", "n_grams")]
    + [StructField(name, BinaryType(), False) for name in ("words", "seconds", "grams", "counts")]
)


class _Questions:
    """The distinct words and grams of one block, with their counts in training texts.

    Words are sorted by the first half of their hash and grams as turned, whatever the order of the texts.
    """

    def __init__(self) -> None:
        none = np.zeros(0, np.int64)
        self.words, self.grams = [(none, none, none)], [(none, none)]
        self.pending: list[tuple[bytes, bool]] = []
        self.size = 0

    def add(self, text: bytes, trains: bool) -> None:
        self.pending.append((text, trains))
        self.size += len(text) + 1
        if self.size >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if self.pending:
            texts, trains = [t for t, _ in self.pending], np.array([float(t) for _, t in self.pending])
            first, second, counts = word_keys(texts)
            codes, keys = pd.factorize(first)
            place = np.zeros(len(keys), np.int64)
            place[codes[::-1]] = np.arange(len(codes))[::-1]
            self.words.append((keys, second[place], np.bincount(codes, np.repeat(trains, counts), len(keys))))
            self.words.append((np.array([_END[0]]), np.array([_END[1]]), np.array([trains.sum()])))
            keys = _turned(grams(texts)) << 1 | np.repeat(trains.astype(np.int64), [len(t) + 1 for t in texts])
            keys.sort()
            starts = np.flatnonzero(np.diff(keys >> 1, prepend=-1))
            self.grams.append((keys[starts] >> 1, np.add.reduceat(keys & 1, starts)))
            self.pending, self.size = [], 0
        if len(self.grams) > 12:
            self.merge()

    def merge(self) -> None:
        first, second, counts = (np.concatenate(parts) for parts in zip(*self.words))
        keys, places, sums = _distinct(first, counts)
        self.words = [(keys, second[places], sums)]
        keys, counts = (np.concatenate(parts) for parts in zip(*self.grams))
        order = np.argsort(keys, kind="stable")  # merges the sorted parts
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        self.grams = [(keys[starts], np.add.reduceat(counts, starts).astype(np.int64) if len(keys) else counts)]

    def by_bucket(self, buckets: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each bucket the places of its words and of its grams."""
        self.flush()
        self.merge()
        number = lambda keys: (mixed(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        words, found = _places(number(self.words[0][0])), _places(number(self.grams[0][0] >> (8 + _REST)))
        none = np.zeros(0, np.int64)
        return {b: (words.get(b, none), found.get(b, none)) for b in sorted(words.keys() | found.keys())}

    def rows(self, block: int, buckets: int) -> pa.RecordBatch:
        places = self.by_bucket(buckets)
        (words, second, counts), (found, sums) = self.words[0], self.grams[0]
        rows = [
            (
                block, bucket, len(w), len(g), _packed_sorted(words[w]), _packed(second[w]), _packed_sorted(found[g]),
                _packed(np.concatenate([counts[w], sums[g]])),
            )
            for bucket, (w, g) in places.items()
        ]
        kinds = [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary()] * 4
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, QUESTION.names)


def _ask(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The questions of texts sorted by block, one block in memory at a time."""
    current, questions = None, _Questions()
    for batch in batches:
        columns = [batch.column(i) for i in (0, 2, 3)]
        for block, text, trains in zip(*columns):
            if block.as_py() != current:
                if current is not None:
                    yield questions.rows(current, buckets)
                current, questions = block.as_py(), _Questions()
            questions.add(_bytes(text.as_py()), trains.as_py())
    if current is not None:
        yield questions.rows(current, buckets)


class _Bucket:
    """What all blocks ask of one bucket: distinct words' counts, distinct grams and counts, and who asked which."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("block")
        self.blocks, self.n_words, self.n_grams = (rows[c].to_numpy(np.int64) for c in ("block", "n_words", "n_grams"))
        sizes = list(zip(rows["n_words"], rows["n_grams"]))
        first = np.concatenate([_unpacked_sorted(d, w) for d, (w, _) in zip(rows["words"], sizes)])
        second = np.concatenate([_unpacked(d, w) for d, (w, _) in zip(rows["seconds"], sizes)])
        counts = [_unpacked(d, w + g) for d, (w, g) in zip(rows["counts"], sizes)]
        order = np.lexsort((second, first))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
        self.word_at = np.zeros(len(order), np.int64)
        self.word_at[order] = np.cumsum(new) - 1
        own = np.concatenate([c[:w] for c, (w, _) in zip(counts, sizes)])
        self.words = np.bincount(self.word_at, own, int(new.sum())).astype(np.int64)
        keys = np.concatenate([_unpacked_sorted(d, g) for d, (_, g) in zip(rows["grams"], sizes)])
        found, self.gram_at = np.unique(keys, return_inverse=True)
        own = np.concatenate([c[w:] for c, (w, _) in zip(counts, sizes)])
        self.grams, self.counts = _turned_back(found), np.bincount(self.gram_at, own, len(found))

    def levels(self) -> list[Level]:
        """The levels from ``DEPTH`` up to ``SHARED`` of the bucket's subtrees."""
        levels = [deepest(self.grams, self.counts)]
        for depth in range(DEPTH - 1, SHARED - 1, -1):
            levels.append(levels[-1].parent(depth))
        return levels

    def answers(self, bucket: int, logs: np.ndarray) -> pd.DataFrame:
        split = lambda values, at, sizes: np.split(values[at], np.cumsum(sizes)[:-1])
        return pd.DataFrame(
            {
                "block": self.blocks,
                "bucket": bucket,
                "counts": [_packed(v) for v in split(self.words, self.word_at, self.n_words)],
                "logs": [_packed(v) for v in split(_rounded(logs), self.gram_at, self.n_grams)],
            }
        )


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence; exact to about 1e-14 for x >= 0.5."""
    steps, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        steps += np.log(y)
        y = y + 1
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - steps


def _log_gamma_of(counts: np.ndarray, more: float, table: np.ndarray) -> np.ndarray:
    """``_log_gamma(counts + more)``, small counts from ``table``."""
    values = table[np.minimum(counts, len(table) - 1).astype(np.int64)]
    large = np.flatnonzero(counts >= len(table))
    values[large] = _log_gamma(counts[large] + more)
    return values


_HALVES, _WHOLES = _log_gamma(np.arange(4096) + 0.5), _log_gamma(np.arange(4096) + 1.0)


def block_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    both = _log_gamma_of(zeros, 0.5, _HALVES) + _log_gamma_of(ones, 0.5, _HALVES)
    return both - np.log(np.pi) - _log_gamma_of(zeros + ones, 1.0, _WHOLES)


class Level:
    """The decision nodes of one depth: sorted keys context * 256 + partial byte, counts and log odds of stopping."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = block_probability(zeros, ones)
        self.odds = None if below is None else own - below
        self.weighted = own if below is None else np.logaddexp(own, below) - np.log(2.0)

    def parent(self, depth: int) -> Level:
        """The level with contexts of ``depth`` bytes, one less than here."""
        shorter = ((self.keys >> 8) & ((1 << (8 * depth)) - 1)) << 8 | (self.keys & 255)
        keys, self.up = np.unique(shorter, return_inverse=True)  # the place of each node's parent
        at = self.up
        total = lambda v: np.bincount(at, v, len(keys))
        return Level(keys, total(self.zeros), total(self.ones), total(self.weighted))

    def mixed_with(self, at: np.ndarray, longer: np.ndarray) -> np.ndarray:
        """Probabilities of a zero and a one (two rows) at the nodes ``at``, given those of their longer contexts."""
        stop = 1.0 / (1.0 + np.exp(-np.clip(self.odds, -700, 700)))
        return (stop * self.own())[:, at] + (1 - stop)[at] * longer

    def own(self) -> np.ndarray:
        """Probabilities of a zero and of a one (two rows) by the counts of each node alone."""
        return (np.stack([self.zeros, self.ones]) + 0.5) / (self.zeros + self.ones + 1.0)

    def mix(self, contexts: np.ndarray, nodes: np.ndarray, bits: np.ndarray, longer: np.ndarray | None) -> np.ndarray:
        """Probability of ``bits``, given that of the longer contexts; 1/2 where nothing was seen."""
        wanted = (contexts << 8) | nodes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = self.keys[at] == wanted
        zeros, ones = np.where(known, self.zeros[at], 0.0), np.where(known, self.ones[at], 0.0)
        own = (np.where(bits == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)
        if longer is None:
            return own
        odds = np.where(known, self.odds[at], 0.0)
        stop = 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))
        return stop * own + (1 - stop) * longer


def _decisions(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(8):
        yield (1 << k) | (symbols >> (8 - k)), (symbols >> (7 - k)) & 1


def deepest(keys: np.ndarray, counts: np.ndarray) -> Level:
    """The level of depth ``DEPTH`` from grams and their training counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(float)
    contexts, symbols = keys >> 8, keys & 255
    nodes, totals, ones = [], [], []
    for node, bits in _decisions(symbols):  # sorted, the grams of a node lie together
        own = (contexts << 8) | node
        starts = np.flatnonzero(np.diff(own, prepend=own[:1] - 1))
        nodes.append(own[starts])
        totals.append(np.add.reduceat(counts, starts))
        ones.append(np.add.reduceat(counts * bits, starts))
    found = np.concatenate(nodes)
    order = np.argsort(found)
    total, one = np.concatenate(totals)[order], np.concatenate(ones)[order]
    return Level(found[order], total - one, one, None)


def _tops(rows: pd.DataFrame) -> pd.DataFrame:
    """The decision nodes of depth ``SHARED`` of one bucket, and under key -1 its training tokens and distinct ones."""
    bucket = _Bucket(rows)
    top = [-1], [float(bucket.words.sum())], [float((bucket.words > 0).sum())], [0.0]
    if len(bucket.grams):
        level = bucket.levels()[-1]
        top = [np.concatenate(c) for c in zip(top, (level.keys, level.zeros, level.ones, level.weighted))]
    return pd.DataFrame({"bucket": rows["bucket"].iloc[0], **dict(zip(("key", "zeros", "ones", "weighted"), top))})


def _log_probability(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The answers of one bucket: counts of words, log10 probabilities of the bytes of grams.

    ``above`` has, for the nodes of depth ``SHARED``, what the shorter contexts make of the probability q of a one
    there: a + b * q.
    """
    bucket = _Bucket(rows)
    value = np.zeros(len(bucket.grams))
    if len(bucket.grams):
        levels = bucket.levels()
        p, at = levels[0].own(), np.arange(len(levels[0].keys))
        for longer, level in zip(levels, levels[1:]):
            at = longer.up[at]
            p = level.mixed_with(at, p)
        above = above.sort_values("key")
        place = np.searchsorted(above["key"].to_numpy(np.int64), levels[-1].keys)
        a, b = above["a"].to_numpy(float)[place], above["b"].to_numpy(float)[place]
        logs = np.log10(np.stack([1 - a - b, a])[:, at] + b[at] * p)
        contexts = bucket.grams >> 8 << 8
        for node, bits in _decisions(bucket.grams & 255):
            at = np.searchsorted(levels[0].keys, contexts | node)
            value += logs[bits, at]
    return bucket.answers(int(rows["bucket"].iloc[0]), value)


@F.pandas_udf(StructType([StructField("weighted", DoubleType()), StructField("odds", DoubleType())]))
def _weigh(zeros: pd.Series, ones: pd.Series, below: pd.Series) -> pd.DataFrame:
    level = Level(None, zeros.to_numpy(float), ones.to_numpy(float), below.to_numpy(float))
    return pd.DataFrame({"weighted": level.weighted, "odds": level.odds})


def _above(tops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key``, ``a`` and ``b`` (see ``_log_probability``) for the nodes of depth ``SHARED``; and the word totals.

    A node has at most 256 nodes below it and the totals a row per bucket, so neither an aggregate nor a join has a hot
    key.
    """
    parent = lambda depth: F.expr(f"(shiftright(key, 8) & {(1 << (8 * depth)) - 1}) * 256 + (key & 255)")
    # Dealt by parent, the nodes are computed once for the aggregates and the join; for that all take all columns.
    below = F.when(F.col("key") >= 0, parent(SHARED - 1)).otherwise(F.lit(-1))
    levels = [tops.withColumn("parent", below).repartition("parent")]
    totals = None
    for depth in range(SHARED - 1, -1, -1):
        sums = [F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]
        sums = levels[-1].groupBy("parent").agg(*sums, F.max("key").alias("a_key"))
        totals = totals or sums.where("a_key < 0").select("zeros", "ones")
        sums = sums.where("a_key >= 0")
        both = sums.withColumnRenamed("parent", "key").withColumn("both", _weigh("zeros", "ones", "weighted"))
        level = both.select("key", "zeros", "ones", "both.weighted", "both.odds")
        levels.append(level.withColumn("parent", parent(depth - 1) if depth else F.lit(0).cast("bigint")))
    stop = 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("odds")))))
    own = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    mixed = levels.pop().select("key", (stop * own).alias("a"), (1 - stop).alias("b"))
    while len(levels) > 1:
        mixed = mixed.withColumnRenamed("key", "parent")
        level = levels.pop().join(mixed, "parent")
        mixed = level.select("key", (F.col("a") + F.col("b") * stop * own).alias("a"), (F.col("b") * (1 - stop)).alias("b"))
    return levels[0].join(mixed.withColumnRenamed("key", "parent"), "parent").drop("parent"), totals


def _answer(buckets: int, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    data = [_bytes(t) for t in texts["text"]]
    questions = _Questions()
    for text in data:
        questions.add(text, False)
    texts = texts.drop(columns="text")
    places = questions.by_bucket(buckets)
    first, keys = questions.words[0][0], questions.grams[0][0]
    counts, logs = np.zeros(len(first)), np.zeros(len(keys))
    for bucket, own_counts, own_logs in zip(answers["bucket"], answers["counts"], answers["logs"]):
        w, g = places[bucket]
        counts[w], logs[g] = _unpacked(own_counts, len(w)), _unpacked(own_logs, len(g), float)
    end = float(counts[np.searchsorted(first, _END[0])])
    del questions, places, answers

    size = len(data)
    n_words, n_known = np.zeros(size, np.int64), np.full(size, int(end > 0))
    base, score = np.full(size, np.log10(end + 1)), np.zeros(size)
    for start, chunk in _chunks(data):
        rows = slice(start, start + len(chunk))
        one, _, spoken = word_keys(chunk)
        codes, own = pd.factorize(one)
        found, text = counts[np.searchsorted(first, own)][codes], np.repeat(np.arange(len(chunk)), spoken)
        n_words[rows] = spoken
        base[rows] += np.bincount(text, np.log10(found + 1), len(chunk))
        n_known[rows] += np.bincount(text, found > 0, len(chunk)).astype(np.int64)
        own, codes = np.unique(_turned(grams(chunk)), return_inverse=True)
        each = logs[np.searchsorted(keys, own)][codes]  # a search for sorted keys stays in near memory
        sizes = np.array([len(t) + 1 for t in chunk])
        score[rows] = np.add.reduceat(each, np.cumsum(sizes) - sizes)
    return pd.DataFrame(
        {
            "id": texts["id"],
            "held_out": ~texts["trains"].astype(bool),
            "n_tokens": n_words + 1,
            "n_known": n_known,
            "known_score": base,
            "score": score,
            "n_bytes": np.array([len(t) for t in data], np.int64),
        }
    )


def score_texts(docs: DataFrame, trains, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``,
    ``n_bytes`` and ``bits_per_byte``. ``trains`` is a condition; the model learns from the rows that meet it.

    Texts are lower-cased in A-Z. Tokens are words, then one end per text. ``base_score`` adds log10 of
    (c + 1) / (N + V + 1) over the tokens. ``score`` is the log10 probability of the bytes and their end under the
    context tree. A null text counts as empty: one end token, one coded end. A null condition means held out. Without
    training rows N and V are 0 and every decision has probability 1/2. Rows are scored each, equal texts alike; other
    columns are not read; no rows give no rows.

    The texts move once, into blocks by a hash of id and text. What a block asks of a bucket moves as one row, and so
    do the answers back; logarithms travel with 36 binary digits. A bucket gets a row per block, never a row per word or
    gram, so no key is hot.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(trains, F.lit(False)).alias("trains"),
    )
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int").alias("block")
    dealt = rows.select(block, "id", "text", "trains").repartition("block")

    # Both uses below take all columns of ``asked``: so the plans beneath stay equal, and Spark deals the texts, asks
    # and deals the questions once for both.
    buckets = max(1, -(-size // BUCKET))
    asked = dealt.sortWithinPartitions("block").mapInArrow(partial(_ask, buckets), QUESTION).repartition("bucket").groupBy("bucket")
    node = [StructField("bucket", IntegerType(), False), StructField("key", LongType(), False)]
    node += [StructField(name, DoubleType(), False) for name in ("zeros", "ones", "weighted")]
    above, found = _above(asked.applyInPandas(_tops, StructType(node)))
    totals = found.agg(
        F.coalesce(F.sum("zeros"), F.lit(0)).cast("bigint").alias("train_tokens"),
        F.coalesce(F.sum("ones"), F.lit(0)).cast("bigint").alias("distinct"),
    )
    answers = asked.cogroup(above.groupBy("bucket")).applyInPandas(
        _log_probability, "block int, bucket int, counts binary, logs binary"
    )
    scored = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            partial(_answer, buckets),
            "id bigint, held_out boolean, n_tokens bigint, n_known bigint, known_score double, score double, "
            "n_bytes bigint",
        )
    )
    unit = F.log10(F.col("train_tokens") + F.col("distinct") + 1)
    return scored.crossJoin(F.broadcast(totals)).select(  # totals is one row
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        (F.col("known_score") - F.col("n_tokens") * unit).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
