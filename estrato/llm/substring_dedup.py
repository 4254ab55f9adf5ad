"""Removal of repeated passages: every window of words that starts earlier somewhere else goes.

Windows find their equals through an anchor, the smallest hash among the shingles inside them: equal windows have
equal anchors. Neighbouring windows mostly share theirs and travel together as one segment. Anchors that occur once in
the corpus are left where they are; the others decide the shard that a segment goes to.

A shard holds each text of a segment once, at its earliest place. It is a compressed FM-index: the Burrows-Wheeler
transform of its segments over words, in a wavelet matrix with counted bits. Documents stream against it from their
last word to their first. Each backward step narrows the interval of matches by a word, and an interval that is longer
than a window falls back to the window's, so the step after every word yields the matches of the window that starts
there. A window whose interval holds an earlier place is repeated. Later copies of a whole segment need no search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import WordHasher, bitmap, holds, mixed, word_spans
from estrato.session import stage

WINDOW = 20  # words of a passage that counts as repeated
SHINGLE = 8  # words of an anchor
LONGEST = 64  # windows of a segment; longer runs, as of one word repeated, become several segments
BYTES = 1 << 20  # bytes of text that are hashed at once
ANCHORS = 1 << 20  # anchors that a worker counts together
BITS = 1 << 27  # size of the bitmap of repeated anchors, 16 MB as it is broadcast
SHARD = 1 << 18  # words of a shard, about
HOT = 1 << 14  # windows under one anchor from which they are dealt by their own content
SENT = 1 << 17  # segments whose words a task knows to have sent already

_hash_words = WordHasher(13)
_PLACES = np.random.default_rng(14).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_SPACES = b" \t\n\x0b\x0c\r"


# Anchors and segments


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in slices of about ``BYTES``, cut at white space."""
    low = 0
    while len(text) - low > BYTES:
        high = low + BYTES
        while high < len(text) and text[high] not in _SPACES:
            high += 1
        yield text[low:high]
        low = high
    yield text[low:]


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of the words of each text."""
    out: list[np.ndarray] = []
    waiting: list[bytes] = []

    def flush() -> None:
        data, starts, ends, counts = word_spans(waiting)
        out.extend(np.split(_hash_words(data, starts, ends), np.cumsum(counts)[:-1]))
        waiting.clear()

    size = 0
    for text in texts:
        if len(text) > BYTES:
            if waiting:
                flush()
            parts = [word_spans([part])[:3] for part in _slices(text)]
            out.append(np.concatenate([_hash_words(*part) for part in parts]))
            size = 0
            continue
        waiting.append(text)
        size += len(text)
        if size > BYTES:
            flush()
            size = 0
    if waiting:
        flush()
    return out


def _slices_of(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``BYTES`` of text, at least one row each."""
    if batch.num_rows:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.searchsorted(sizes, np.arange(BYTES, sizes[-1] + BYTES, BYTES), "right"))
        low = 0
        for high in [*np.clip(cuts, 1, batch.num_rows).tolist(), batch.num_rows]:
            if high > low:
                yield batch.slice(low, high - low)
                low = high


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    return best(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def anchors_of(words: np.ndarray, window: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the hash of every shingle that is an anchor, once for each of its places."""
    none = np.zeros(0, np.uint64)
    if len(words) < window:
        return none, none
    count = len(words) - shingle + 1
    hashes = np.zeros(count, np.uint64)
    for k in range(shingle):
        hashes += words[k : k + count] * _PLACES[k]
    hashes = mixed(hashes)
    inside = window - shingle + 1
    least = _sliding(hashes, inside, np.minimum)
    edge = np.zeros(inside - 1, np.uint64)
    # A shingle is an anchor if it is the least of some window around it, that is, of the one with the greatest least.
    greatest = _sliding(np.concatenate([edge, least, edge]), inside, np.maximum)
    return least, hashes[greatest == hashes]


def runs_of(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of every run with one anchor, runs cut at ``LONGEST``."""
    fresh = np.ones(len(anchors), bool)
    np.not_equal(anchors[1:], anchors[:-1], out=fresh[1:])
    starts = np.flatnonzero(fresh)
    lengths = np.diff(starts, append=len(anchors))
    parts = -(-lengths // LONGEST)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.repeat(starts, parts) + within * LONGEST
    lengths = np.minimum(np.repeat(lengths, parts) - within * LONGEST, LONGEST)
    return starts, lengths


def _anchor_counts(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0

        def counted() -> pa.RecordBatch:
            anchors, times = np.unique(np.concatenate(gathered), return_counts=True)
            columns = [pa.array(anchors.view(np.int64)), pa.array(times.astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, ["anchor", "times"])

        for batch in batches:
            for part in _slices_of(batch, "text"):
                for words in word_hashes(part.column("text").to_pylist()):
                    found = anchors_of(words, window, shingle)[1]
                    gathered.append(found)
                    size += len(found)
                if size >= ANCHORS:
                    yield counted()
                    gathered, size = [], 0
        if gathered:
            yield counted()

    return run


_SEGMENT = "anchor long, doc_id long, twin long, start long, windows int, words binary"


def _segments(docs: DataFrame, bits: np.ndarray, window: int, shingle: int) -> DataFrame:
    """The segments whose anchors are repeated.

    A task sends the words of a segment with its earliest place so far; later copies come with their place alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent = shared.value, {}
        for batch in batches:
            for part in _slices_of(batch, "text"):
                out = []
                texts = part.column("text").to_pylist()
                names = zip(part.column("doc_id").to_pylist(), part.column("twin").to_pylist())
                for (doc_id, twin), text, words in zip(names, texts, word_hashes(texts)):
                    anchors = anchors_of(words, window, shingle)[0]
                    starts, lengths = runs_of(anchors)
                    own = anchors[starts]
                    wanted = holds(known, (own & np.uint64(BITS - 1)).astype(np.int64))
                    if not wanted.any():
                        continue
                    spoken = text.split()
                    for at, start, length in zip(
                        own[wanted].view(np.int64).tolist(), starts[wanted].tolist(), lengths[wanted].tolist()
                    ):
                        passage = b" ".join(spoken[start : start + length + window - 1])
                        digest = hashlib.blake2b(passage, digest_size=16).digest()
                        place = (doc_id is not None, doc_id or 0, twin, start)
                        first = digest not in sent or place < sent[digest]
                        out.append((at, doc_id, twin, start, length, passage if first else None))
                        if first:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent[digest] = place
                if out:
                    yield _batch(out, _SEGMENT)

    return docs.mapInArrow(run, _SEGMENT)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, _KINDS[kind]) for column, kind in zip(zip(*rows), kinds)], list(names)
    )


# The index of a shard


class WaveletMatrix:
    """Counts of symbols in prefixes of a sequence: one bit vector for each bit of a symbol, with counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.zeros = [], []
        self.shifts = range(max(size - 1, 1).bit_length() - 1, -1, -1)
        for shift in self.shifts:
            bits = symbols >> shift & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before))
            self.zeros.append(len(symbols) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.first = self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, (words, before), zeros in zip(self.shifts, self.levels, self.zeros):
            cell = places >> 6
            mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[cell] + np.bitwise_count(words[cell] & mask)
            places = np.where(symbols >> shift & 1 == 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._walk(symbols, places) - self.first[symbols]


class FMIndex:
    """Backward search over a text of whole numbers from 0 to ``size`` - 1, for matches of up to ``window`` symbols.

    Suffixes are sorted by at least ``window`` + 1 symbols, which is all that such a search compares. Beside the
    wavelet matrix only the first row and the earliest place of each distinct window are kept.
    """

    def __init__(self, text: np.ndarray, size: int, window: int):
        n = len(text)
        ranks, depth = [text.astype(np.int64)], 1
        while depth < window + 1:
            pairs = ranks[-1] * (n + size) + np.roll(ranks[-1], -depth)
            ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            depth *= 2
        order = np.argsort(ranks[-1], kind="stable")
        self.matrix = WaveletMatrix(text[order - 1].astype(np.int64), size)
        self.before = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=size), out=self.before[1:])
        alike, at = np.zeros(n, np.int64), 0
        for bit, rank in enumerate(ranks):
            if window >> bit & 1:
                alike = np.unique(alike * (n + size) + np.roll(rank, -at), return_inverse=True)[1].astype(np.int64)
                at += 1 << bit
        alike = alike[order]
        fresh = np.ones(n, bool)
        np.not_equal(alike[1:], alike[:-1], out=fresh[1:])
        self.starts = np.flatnonzero(fresh)
        self.earliest = np.minimum.reduceat(order, self.starts)
        self.rows = n

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one more symbol in front."""
        found = self.matrix.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        base = self.before[symbols]
        return base + found[: len(low)], base + found[len(low) :]

    def window_at(self, low: np.ndarray) -> np.ndarray:
        """The number of the distinct window that row ``low`` begins with."""
        return np.searchsorted(self.starts, low, "right") - 1


def repeated_windows(passages: list[np.ndarray], size: int, window: int) -> list[np.ndarray]:
    """For each passage of word numbers (from 1 to ``size`` - 1) which of its windows start in the list earlier.

    Passages are in order of their places. All of them stream against the index of all, side by side.
    """
    lengths = np.array([len(p) for p in passages])
    begins = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    for begin, passage in zip(begins.tolist(), passages):
        text[begin : begin + len(passage)] = passage
    index = FMIndex(text, size, window)
    verdicts = np.zeros(len(text), bool)
    low, high = np.zeros(len(passages), np.int64), np.full(len(passages), index.rows)
    order = np.argsort(-lengths, kind="stable")  # longest first, so those still running are a prefix
    running = lengths[order]
    for step in range(1, int(running[0]) + 1):
        own = order[: np.searchsorted(-running, -step, "right")]
        at = begins[own] + lengths[own] - step
        low[own], high[own] = index.extend(text[at], low[own], high[own])
        if step >= window:
            match = index.window_at(low[own])
            verdicts[at] = index.earliest[match] < at
            low[own] = index.starts[match]
            high[own] = np.append(index.starts, index.rows)[match + 1]
    return [verdicts[b : b + n - window + 1] for b, n in zip(begins.tolist(), lengths.tolist())]


_VERDICT = "doc_id long, twin long, start long, windows int, repeated binary"


def _search(window: int):
    """One shard: each of its passages at the earliest place, and a bit for every window of it that is repeated."""

    def run(shard: pa.Table) -> pa.Table:
        keys = [(name, "ascending") for name in ("doc_id", "twin", "start")]
        shard = shard.take(pc.sort_indices(shard, keys, null_placement="at_start"))
        known: set[bytes] = set()
        fresh = [not (words in known or known.add(words)) for words in shard["words"].to_pylist()]
        shard = shard.filter(pa.array(fresh))
        numbers: dict[bytes, int] = {}
        passages = [
            np.array([numbers.setdefault(w, len(numbers) + 1) for w in words.as_py().split(b" ")])
            for words in shard["words"]
        ]
        found = repeated_windows(passages, len(numbers) + 1, window)
        bits = pa.array([np.packbits(own).tobytes() for own in found], pa.binary())
        return shard.select(["doc_id", "twin", "start", "windows"]).append_column("repeated", bits)

    return run


def _single_windows(window: int):
    """The windows of a passage one by one, each under the anchor that its own content gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, out = row["words"].split(b" "), []
                for i in range(row["windows"]):
                    passage = b" ".join(words[i : i + window])
                    anchor = int.from_bytes(hashlib.blake2b(passage, digest_size=8).digest(), "big", signed=True)
                    out.append((anchor, row["doc_id"], row["twin"], row["start"] + i, 1, passage))
                yield _batch(out, _SEGMENT)

    return run


def _earliest(passages: DataFrame) -> DataFrame:
    """Each distinct passage at its earliest place."""
    return (
        passages.groupBy("anchor", "words")
        .agg(F.min(F.struct("doc_id", "twin", "start")).alias("place"), F.first("windows").alias("windows"))
        .select("anchor", "place.*", "windows", "words")
    )


def _touched(bits: np.ndarray, rows: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in a bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices_of(batch, "text"):
                yield part.filter(pa.array(holds(shared.value, part.column("key").to_numpy())))

    return rows.mapInArrow(run, rows.schema)


def _applied(window: int, found_elsewhere=None):
    """Documents with the places of their repeated segments: what is left of them.

    With a bitmap of keys, only documents that are not in it, and have no such segments.
    """
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices_of(batch, "text"):
                if found_elsewhere is not None:
                    part = part.filter(pa.array(~holds(found_elsewhere.value, part.column("key").to_numpy())))
                if not part.num_rows:
                    continue
                out = []
                for row in part.to_pylist():
                    words = row["text"].split()
                    gone = np.zeros(max(len(words) - window + 1, 0), bool)
                    found = row.get("found") or []
                    for f in found:
                        gone[f["start"] : f["start"] + f["windows"]] = True
                    for f in found:
                        if f["repeated"] is not None:
                            bits = np.unpackbits(np.frombuffer(f["repeated"], np.uint8), count=f["windows"])
                            gone[f["start"] : f["start"] + f["windows"]] = bits == 1
                    change = np.zeros(len(words) + 1, np.int64)
                    places = np.flatnonzero(gone)
                    np.add.at(change, places, 1)
                    np.add.at(change, places + window, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                    kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c) if spans else b" ".join(words)
                    out.append((row["doc_id"], len(words), int(covered.sum()), spans, kept.decode()))
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return run, schema


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Each row's id, ``n_words``, ``n_removed``, removed word ``spans`` (start, end) and the ``kept`` words.

    Words are runs of anything but ASCII white space; a window is ``window`` consecutive words of one text. Every word
    in a window goes whose words also start earlier: in a smaller id, or earlier in the same text. Windows are judged
    on the texts as given. ``kept`` joins the rest by one space.

    A null id is smaller than all others; rows of one id with different texts are ordered by a hash of the text, and
    rows equal in id and text are one document, so each has the same result. A null text has no words, other columns
    are not read, no rows give no rows. Texts are read four times; only segments with repeated anchors move, and texts that hold one.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text_column).alias("twin"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.select("text").mapInArrow(_anchor_counts(window, shingle), "anchor long, times int")
    repeated = counted.groupBy("anchor").agg(F.sum("times").alias("times")).where("times > 1")
    known = bitmap(repeated.select(F.col("anchor").bitwiseAND(F.lit(BITS - 1)).alias("bucket")), BITS)
    segments = stage(_segments(rows, known, window, shingle), "segments")

    passages = segments.where("words IS NOT NULL")
    sizes = passages.groupBy("anchor").agg(F.sum("windows").alias("n"))
    crowded = stage(sizes.where(F.col("n") > HOT).select("anchor"), "crowded")
    split = _earliest(passages.join(crowded, "anchor", "left_semi").select(*passages.columns))
    split = _earliest(split.select(*passages.columns).mapInArrow(_single_windows(window), _SEGMENT))
    words = passages.agg(F.sum(F.col("windows") + F.lit(window))).first()[0] or 0
    shards = max(1, -(-words // SHARD))
    indexed = passages.join(crowded, "anchor", "left_anti").unionByName(split)
    dealt = indexed.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    verdicts = dealt.groupBy("shard").applyInArrow(_search(window), _VERDICT)

    everywhere = segments.select("doc_id", "twin", "start", "windows", F.lit(None).cast("binary").alias("repeated"))
    found = (
        everywhere.unionByName(verdicts)
        .groupBy("doc_id", "twin")
        .agg(F.collect_list(F.struct("start", "windows", "repeated")).alias("found"))
    )
    of = found.select(F.col("doc_id").alias("of_id"), F.col("twin").alias("of_twin"), "found")
    # Texts without a segment need no places and do not move.
    key = F.xxhash64("doc_id", "twin").bitwiseAND(F.lit(BITS - 1))
    touched = bitmap(segments.select(key.alias("bucket")), BITS)
    keyed = rows.withColumn("key", key)
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("twin") == F.col("of_twin"))
    joined = _touched(touched, keyed).join(of, same, "left")
    run, schema = _applied(window)
    changed = joined.select("doc_id", "text", "found").mapInArrow(run, schema)
    run, schema = _applied(window, docs.sparkSession.sparkContext.broadcast(touched))
    whole = keyed.select("doc_id", "key", "text").mapInArrow(run, schema)
    return whole.unionByName(changed).withColumnRenamed("doc_id", id_column)
