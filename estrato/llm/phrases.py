"""Collocations of two to five words, from sorted count streams that are merged instead of looked up.

Every place in the corpus gives one context: the words that follow it inside its piece, five at most. A task sorts the
contexts of some million words, counts equal ones and deals them by their first word as compact blocks. A group then
merges the blocks it gets into one sorted stream, in which contexts with the same first words are neighbours, so one
pass yields the counts of phrases of every length. Contexts that begin with very common words are dealt by further
words as well; a phrase of such words alone is counted in several groups and added up.

The resulting count stream is then merged with its own cuts: sorted by their first parts for the left counts, by their
rests for the right counts, and by the phrase less one word at either end for the counts of extensions. All of these
are sort-merge joins over the frequent phrases alone, which adaptive execution splits where a part is common.

A phrase that occurs often consists of words that do, so contexts end at a rare word. Which words are rare is counted
first; a bitmap of fixed size carries that to the texts. It can let a rare word pass, which costs rows, never results.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import LOWER, bitmap, holds, mixed
from estrato.session import stage

MOST_WORDS = 5
LEAST = 100  # occurrences of a candidate
SHARE = 100  # per cent of a phrase's occurrences that a longer candidate must cover to stand for it
TOP = 2000  # phrases returned for each language
NO_LANGUAGE = "und"

BYTES = 1 << 23  # bytes of text whose words a worker counts together, at least one text
WORDS = 1 << 21  # words whose contexts a worker counts together, at least one text
PART = 1 << 20  # contexts that one group merges, about
HOT = 1 << 19  # occurrences from which a word does not keep its contexts in one group
BITS = 1 << 26  # size of the bitmap of frequent words, 8 MB as it is broadcast
HOT_BITS = 1 << 20  # the same for words from HOT occurrences

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# Lower case, one character for every end of a piece and one for every space between words.
_PLAIN = LOWER.translate(bytes.maketrans(_PIECE_ENDS + b"\t", b"\n" * len(_PIECE_ENDS) + b" "))

_GRAM = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("times", pa.int64())])


def _rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """The counts as sorted rows, some ten thousand at a time."""
    for lang, own in counts.items():
        ordered = sorted(own.items())
        for low in range(0, len(ordered), 1 << 15):
            phrases, times = zip(*ordered[low : low + (1 << 15)])
            texts = pa.array(phrases, pa.binary()).cast(pa.string())
            langs = pa.array([lang] * len(times), pa.string())
            yield pa.RecordBatch.from_arrays([langs, texts, pa.array(times, pa.int64())], schema=_GRAM)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, plain, gathered up to ``BYTES``."""
    found: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            plain = text.as_py().translate(_PLAIN)
            found[lang.as_py()].append(plain)
            size += len(plain)
            if size >= BYTES:
                yield found
                found, size = defaultdict(list), 0
    if found:
        yield found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and under a null phrase the number of all words of a language."""
    for found in _by_language(batches):
        counts = {lang: Counter(b"\n".join(texts).split()) for lang, texts in found.items()}
        totals = [sum(own.values()) for own in counts.values()]
        yield from _rows(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.nulls(len(counts), pa.string()), pa.array(totals, pa.int64())],
            schema=_GRAM,
        )


def _digest(lang: str, word: bytes) -> int:
    """64 bits of a word, the same number that ``_buckets`` computes inside Spark."""
    return xxhash.xxh64_intdigest(lang.encode() + b"\t" + word, seed=42)


def _buckets(words: DataFrame, bits: int) -> DataFrame:
    """The places of words (lang, phrase) in a bitmap."""
    digest = F.xxhash64(F.concat_ws("\t", "lang", "phrase").cast("binary"))
    return words.select(F.pmod(digest, F.lit(bits)).alias("bucket"))


class _Numbers(dict):
    """Numbers of the frequent words of a language in a worker's share of the texts; -1 for any other word."""

    def __init__(self, lang: str, frequent: np.ndarray):
        super().__init__()
        self.lang, self.frequent = lang, frequent
        self.words: list[bytes] = []
        self.digests: list[int] = []
        self.texts: list[np.ndarray] = []

    def __missing__(self, word: bytes) -> int:
        digest = _digest(self.lang, word)
        place = digest % BITS
        number = -1
        if self.frequent[place >> 3] >> (place & 7) & 1:
            number = len(self.words)
            self.words.append(word)
            self.digests.append(digest)
        self[word] = number
        return number

    def add(self, plain: bytes) -> int:
        """Take up a text: the numbers of its words, with -1 after every piece. How many there are."""
        numbers: list[int] = []
        for piece in plain.split(b"\n"):
            words = piece.split()
            if len(words) > 1:
                numbers += map(self.__getitem__, words)
                numbers.append(-1)
        self.texts.append(np.array(numbers, np.int32))
        return len(numbers)


def _sorted_rows(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their columns; numbers from -1."""
    keys = []
    for low in range(0, len(columns), 2):
        key = (columns[low] + 1).astype(np.uint64) << np.uint64(32)
        keys.append(key | (columns[low + 1] + 1).astype(np.uint64) if low + 1 < len(columns) else key)
    return np.lexsort(keys[::-1])


def _changes(columns: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For sorted rows, after each column: where a row differs from the one before in the columns so far."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
        yield changed


_BLOCK = "lang string, part long, words binary, hot binary, width int, places binary, times binary"
_BLOCK_SCHEMA = pa.schema(
    [("lang", pa.string()), ("part", pa.int64()), ("words", pa.binary()), ("hot", pa.binary()), ("width", pa.int32()),
     ("places", pa.binary()), ("times", pa.binary())]
)


def _blocks(numbers: _Numbers, hot_words: np.ndarray, parts: int, most_words: int) -> Iterator[tuple]:
    """The distinct contexts of some texts with their counts, in one block for each part that gets some."""
    text = np.concatenate([*numbers.texts, np.full(most_words, -1, np.int32)])
    size = len(text) - most_words
    columns, alive = [text[:size]], text[:size] >= 0
    for k in range(1, most_words):
        alive = alive & (text[k : k + size] >= 0)
        columns.append(np.where(alive, text[k : k + size], np.int32(-1)))
    long_enough = columns[1] >= 0
    columns = [c[long_enough] for c in columns]
    if not len(columns[0]):
        return
    order = _sorted_rows(columns)
    columns = [c[order] for c in columns]
    for changed in _changes(columns):
        pass
    starts = np.flatnonzero(changed)
    times = np.diff(starts, append=len(order)).astype(np.uint32)
    columns = [c[starts] for c in columns]

    digests = np.array(numbers.digests, np.uint64)
    hot = holds(hot_words, (digests % np.uint64(HOT_BITS)).astype(np.int64))
    key, leading = digests[columns[0]], hot[columns[0]]
    for column in columns[1:]:
        further = leading & (column >= 0)
        key = np.where(further, mixed(key + digests[column] * np.uint64(0x9E3779B97F4A7C15)), key)
        leading = further & hot[column]
    part = (mixed(key) % np.uint64(parts)).astype(np.int64)
    dealt = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.diff(part[dealt], prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows = dealt[low:high]
        own = [c[rows] for c in columns]
        used = np.unique(np.concatenate(own))
        used = used[used >= 0]
        width = 2 if len(used) < 65535 else 4
        kind = np.uint16 if width == 2 else np.uint32
        places = np.concatenate([np.where(c < 0, 0, np.searchsorted(used, c) + 1) for c in own]).astype(kind)
        yield (
            numbers.lang,
            int(part[rows[0]]),
            zlib.compress(b"\n".join([numbers.words[u] for u in used.tolist()]), 1),
            np.packbits(hot[used]).tobytes(),
            width,
            zlib.compress(places.tobytes(), 1),
            zlib.compress(times[rows].tobytes(), 1),
        )


def _contexts(docs: DataFrame, frequent: np.ndarray, hot: np.ndarray, parts: int, most_words: int) -> DataFrame:
    """Blocks of contexts of two to ``most_words`` frequent words with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot_words = shared.value
        found: dict[str, _Numbers] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for numbers in found.values():
                for block in _blocks(numbers, hot_words, parts, most_words):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(block, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                name = lang.as_py()
                if name not in found:
                    found[name] = _Numbers(name, known)
                size += found[name].add(text.as_py().translate(_PLAIN))
                if size >= WORDS:
                    yield from counted()
                    found, size = {}, 0
        yield from counted()

    return docs.mapInArrow(run, _BLOCK)


def _merged(least: int, most_words: int):
    """All blocks of one part of a language as one sorted stream: the counts of the phrases its contexts begin with.

    Phrases below ``least`` are left out, but for those of hot words alone, of which other parts hold the rest.
    """

    def run(blocks: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        hot_of: dict[int, bool] = {}
        pieces: list[list[np.ndarray]] = [[] for _ in range(most_words)]
        counted = []
        for block in blocks.to_pylist():
            words = zlib.decompress(block["words"]).split(b"\n")
            own = np.array([-1] + [numbers.setdefault(w, len(numbers)) for w in words], np.int32)
            hot_of.update(zip(own[1:].tolist(), np.unpackbits(np.frombuffer(block["hot"], np.uint8)).tolist()))
            places = np.frombuffer(zlib.decompress(block["places"]), np.uint16 if block["width"] == 2 else np.uint32)
            for piece, column in zip(pieces, np.split(places, most_words)):
                piece.append(own[column])
            counted.append(np.frombuffer(zlib.decompress(block["times"]), np.uint32))
        columns, times = [np.concatenate(p) for p in pieces], np.concatenate(counted).astype(np.int64)
        order = _sorted_rows(columns)
        columns, times = [c[order] for c in columns], times[order]
        words = list(numbers)
        hot = np.array([bool(hot_of[i]) for i in range(len(words))])
        phrases, sums = [], []
        shared_by_all = np.ones(len(times), bool)
        for size, changed in enumerate(_changes(columns), 1):
            shared_by_all &= hot[columns[size - 1]]
            if size == 1:
                continue
            starts = np.flatnonzero(changed)
            total = np.add.reduceat(times, starts)
            kept = (columns[size - 1][starts] >= 0) & ((total >= least) | shared_by_all[starts])
            sums += total[kept].tolist()
            for row in starts[kept].tolist():
                phrases.append(b" ".join([words[c[row]] for c in columns[:size]]))
        lang = [blocks["lang"][0].as_py()] * len(sums)
        texts = pa.array(phrases, pa.binary()).cast(pa.string())
        return pa.Table.from_arrays([pa.array(lang, pa.string()), texts, pa.array(sums, pa.int64())], schema=_GRAM)

    return run


def phrase_counts(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``most_words`` words that occur ``least`` times in a language, and each language's words.

    The first frame has lang, phrase (joined by one space), n_words and times; the second lang and n.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_column), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    counted = texts.mapInArrow(_count_words, "lang string, phrase string, times long")
    summed = counted.groupBy("lang", "phrase").agg(F.sum("times").alias("times"))
    words = stage(summed.where(F.col("phrase").isNull() | (F.col("times") >= least)), "words")
    frequent = words.where("phrase IS NOT NULL")
    parts = 1 + (words.where("phrase IS NULL").agg(F.sum("times")).first()[0] or 0) // PART
    known = bitmap(_buckets(frequent, BITS), BITS)
    hot = bitmap(_buckets(frequent.where(F.col("times") >= HOT), HOT_BITS), HOT_BITS)
    blocks = _contexts(texts, known, hot, parts, most_words)
    merged = blocks.groupBy("lang", "part").applyInArrow(
        _merged(least, most_words), "lang string, phrase string, times long"
    )
    longer = merged.groupBy("lang", "phrase").agg(F.sum("times").alias("times")).where(F.col("times") >= least)
    counts = frequent.unionByName(longer).withColumn("n_words", F.size(F.split("phrase", " ")))
    return stage(counts, "phrases"), words.where("phrase IS NULL").select("lang", F.col("times").alias("n"))


def _whole(numerator: tuple[Column, Column], denominator: tuple[Column, Column]) -> Column:
    """floor(1000 * a * b / (c * d)) of positive whole numbers, exactly: products have up to 38 digits."""
    wide = [F.col(c).cast("decimal(18,0)") if isinstance(c, str) else c for c in (*numerator, *denominator)]
    a, b, c, d = wide
    thousand = F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", a * b * thousand, c * d)


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and
    tabs. A phrase of 2 to ``most_words`` words with ``a`` >= ``least`` occurrences inside pieces is a candidate. Cut
    after its first k words it scores floor(1000 * a * n / (l * r)), with l and r the occurrences of both parts and n
    all words of the language; the cut with the lowest score counts, the first of them on ties. A candidate inside a
    longer one that has ``share`` per cent of its occurrences is left out. Order: score and a descending, then phrase.

    A null text is empty, a null language is ``und``, repeated rows count as often as they come, and no rows, or no
    candidates, give no rows. Other columns are not read. A text must fit a worker's memory, a language need not.
    """
    counts, totals = phrase_counts(docs, text_column, lang_column, least, most_words)
    candidates = counts.where("n_words > 1")
    cut = candidates.withColumn("k", F.explode(F.expr("sequence(1, n_words - 1)"))).withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - n_words)")}
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("times").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("times").alias("r"))
    scored = (
        cut.join(left.hint("merge"), ["lang", "first"])
        .join(right.hint("merge"), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", _whole(("times", "n"), ("l", "r")))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "l", "r", "times", "n")).alias("best"))
    )
    # A longer phrase occurs no more often than any phrase between the two, so one word more at either end decides.
    within = (
        counts.where("n_words > 2")
        .select(
            "lang",
            F.explode(
                F.array(F.expr("substring_index(phrase, ' ', n_words - 1)"), F.expr("substring_index(phrase, ' ', 1 - n_words)"))
            ).alias("phrase"),
            "times",
        )
        .groupBy("lang", "phrase")
        .agg(F.max("times").alias("longer"))
    )
    alone = scored.join(within.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("best.times") * share)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("best.times"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        F.col("best.times").alias("a"),
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        F.col("best.n").alias("n"),
        F.col("best.score").alias("score"),
    )
