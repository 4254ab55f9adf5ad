"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the components of its links.

A document is the set of its distinct word shingles, each a 64-bit hash. Documents with equal sets are one class.
Tokens have one global order, rare ones first: frequent tokens, as found by one pass, come last by their counts. Two
sets can only reach the threshold if their prefixes in that order share a token, and if prefixes are lengthened by
k - 1 tokens, only if they share k. A document whose prefix looks expensive gets a longer one.

Classes that share a prefix token form a list. A list is settled in two steps that never pair up all its members: each
member meets one pivot, and then only members outside the pivot's component meet the others. Members of one component
need no further link. In both steps a pair is verified only if its prefixes share as many tokens as prefixes of their
lengths must, for sets of their sizes; that is one token only for the most unequal sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import LongType

from estrato.llm.common import LOWER, WordHasher, mixed, word_spans
from estrato.session import stage

WIDTH = 5  # words of a shingle
FREQUENT = 1 << 20  # tokens with a known place at the end of the order; their table is broadcast, 16 bytes each
LEAST_FREQUENT = 16  # documents from which a token counts as frequent
CHUNK = 1 << 21  # tokens that one pass counts together
COST = 1024  # mean list length of a prefix's tokens up to which it stays as it is; pivots settle shorter lists
LONGEST = 8  # shared tokens asked for at most
BITS = 1 << 26  # size of the bitmap of wanted nodes, 8 MB as it is broadcast
LARGE = 1 << 13  # tokens from which a sketch has 32 bits a token
PAIRS = 256  # pairs of sets that a worker compares at once
BYTES = 1 << 18  # bytes of text that are hashed at once, at least one text

_NO_ID = -(1 << 63)

_word_hashes = WordHasher(5)
_PLACES = np.random.default_rng(6).integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)


def _hashed(texts: list[bytes], width: int) -> list[np.ndarray]:
    """``shingle_sets`` of a few texts at once: words by differences of a running polynomial, windows by shifts."""
    data, starts, ends, counts = word_spans(texts)
    words = _word_hashes(data, starts, ends)
    first = [0, *np.cumsum(counts).tolist()]
    windows = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        windows += words[k : k + len(windows)] * _PLACES[k]
    windows = mixed(windows).view(np.int64)
    sets = []
    for low, high in zip(first, first[1:]):
        if high - low >= width:
            own = windows[low : high - width + 1].copy()
            own.sort()
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            sets.append(own[fresh])
        else:
            short = (words[low:high] * _PLACES[: high - low]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mixed(short + np.uint64(high - low)).view(np.int64)[: high - low])
    return sets


def shingle_sets(texts: Iterable[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes; of fewer words the whole sequence is one; none without words."""
    waiting, size = [], 0
    for text in texts:
        waiting.append(text.encode("utf-8", "surrogatepass").translate(LOWER) if text else b"")
        size += len(waiting[-1]) + 1
        if size >= BYTES:
            yield from _hashed(waiting, width)
            waiting, size = [], 0
    if waiting:
        yield from _hashed(waiting, width)


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (text.as_py() for text in column)


def class_of(tokens: np.ndarray) -> bytes:
    """16 bytes that name the set."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _node(name: bytes) -> int:
    return int.from_bytes(name[:8], "big", signed=True)


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The smallest intersection of sets of sizes a and b that reaches ``percent`` of the union."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def _survey(docs: DataFrame) -> DataFrame:
    """Per document its class and set size (kind 0), and tokens that meet in a chunk of documents (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, seen, size = [], set(), 0

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(gathered), return_counts=True)
            tokens, counts = tokens[counts > 1], counts[counts > 1]
            none = pa.nulls(len(tokens))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(len(tokens), np.int32)),
                    none.cast(pa.int64()),
                    none.cast(pa.binary()),
                    pa.array(tokens),
                    pa.array(counts.astype(np.int64)),
                ],
                ["kind", "id", "class", "token", "size"],
            )

        for batch in batches:
            names, sizes = [], []
            for tokens in shingle_sets(_texts(batch.column(1))):
                names.append(class_of(tokens))
                sizes.append(len(tokens))
                if names[-1] not in seen and len(tokens):
                    seen.add(names[-1])
                    gathered.append(tokens)
                    size += len(tokens)
                if size >= CHUNK:
                    yield frequent()
                    gathered, seen, size = [], set(), 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(names), np.int32)),
                    batch.column(0),
                    pa.array(names, pa.binary()),
                    pa.nulls(len(names)).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                ["kind", "id", "class", "token", "size"],
            )
        if gathered:
            yield frequent()

    return docs.mapInArrow(run, "kind int, id bigint, class binary, token bigint, size bigint")


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _prefixes(docs: DataFrame, tokens: np.ndarray, counts: np.ndarray, percent: int) -> DataFrame:
    """Prefix tokens of every class: token, node (first half of the class), and size, position and match count."""
    known = docs.sparkSession.sparkContext.broadcast((tokens, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, times = known.value
        perhaps = np.zeros(1 << 22, bool)
        perhaps[frequent & 0x3FFFFF] = True
        done: set[int] = set()
        for batch in batches:
            out = []
            for own in shingle_sets(_texts(batch.column(0))):
                node = _node(class_of(own)) if len(own) else 0
                if not len(own) or node in done:
                    continue
                done.add(node)
                n = len(own)
                base, matches = prefix_length(n, percent), 1
                late = np.flatnonzero(perhaps[own & 0x3FFFFF])
                if len(late):
                    at = np.minimum(np.searchsorted(frequent, own[late]), len(frequent) - 1)
                    right = frequent[at] == own[late]
                    late, cost = late[right], times[at[right]]
                    order = np.argsort(cost, kind="stable")
                    own = np.concatenate([np.delete(own, late), own[late[order]]])
                    mean = (cost[order][: max(0, base - (n - len(late)))].sum() + base) / base
                    if mean > COST:
                        matches = min(1 + int(np.ceil(np.log2(mean / COST))), LONGEST, n - base + 1)
                length = base + matches - 1
                out.append((own[:length], node, n, matches))
            if out:
                lengths = np.array([len(t) for t, *_ in out])
                repeat = lambda k: np.repeat(np.array([row[k] for row in out], np.int64), lengths)
                place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                packed = (repeat(2) << 34) | (place << 4) | repeat(3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([t for t, *_ in out])), pa.array(repeat(1)), pa.array(packed)],
                    ["token", "node", "packed"],
                )

    return docs.select("text").mapInArrow(run, "token bigint, node bigint, packed bigint")


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """The places of (node, id) in a packed bitmap; at most ``BITS / 32`` words reach the driver."""
    place = F.col("node").bitwiseXOR(F.col("id")).bitwiseAND(F.lit(BITS - 1))
    words = (
        wanted.select(place.alias("place"))
        .groupBy(F.shiftright("place", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 31 AS int))")).alias("bits"))
    )
    found = words.toPandas()
    bitmap = np.zeros(BITS // 32, "<u4")
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bitmap


def _sets(docs: DataFrame, bitmap: np.ndarray | None, whole: bool) -> DataFrame:
    """Node, class, size and tokens (``whole``) or their sketch, of every text that is wanted.

    A task names a class once, so copies that share an id leave it once.
    """
    wanted = None if bitmap is None else docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if wanted is None else wanted.value
        done: set[bytes] = set()
        for batch in batches:
            out = []
            for own, row_id in zip(shingle_sets(_texts(batch.column(1))), batch.column(0).to_pylist()):
                name = class_of(own)
                node = _node(name)
                place = (node ^ row_id) & (BITS - 1)
                if len(own) and name not in done and (bits is None or int(bits[place >> 5]) >> (place & 31) & 1):
                    done.add(name)
                    out.append((node, name, len(own), own.tobytes() if whole else sketch(own)))
            if out:
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], ["node", "class", "n", "data"]
                )

    return docs.select("key", "text").mapInArrow(run, "node bigint, class binary, n bigint, data binary")


def sketch(tokens: np.ndarray) -> bytes:
    """The last bits of every token, 16 of small sets and 32 of large ones, sorted: two or four bytes a token."""
    kind = np.uint16 if len(tokens) < LARGE else np.uint32
    return np.sort(tokens.astype(kind)).tobytes()


def _numbered(bits: np.ndarray) -> np.ndarray:
    """Sorted numbers, equal ones told apart by which of them they are."""
    fresh = np.ones(len(bits), bool)
    np.not_equal(bits[1:], bits[:-1], out=fresh[1:])
    at = np.arange(len(bits))
    return bits.astype(np.int64) << 31 | at - np.maximum.accumulate(np.where(fresh, at, 0))


def _shared_at_most(a: bytes, n: int, b: bytes, m: int) -> int:
    """No fewer than the tokens that two sets share, from their sketches; equal tokens have equal bits."""
    x, y = (np.frombuffer(s, np.uint16 if len(s) == 2 * k else np.uint32) for s, k in ((a, n), (b, m)))
    if x.dtype != y.dtype:
        x, y = (np.sort(s.astype(np.uint16)) for s in (x, y))
    both = np.concatenate([_numbered(x), _numbered(y)])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


@F.pandas_udf(LongType())
def _bound(a: pd.Series, n: pd.Series, b: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([_shared_at_most(*row) for row in zip(a, n, b, m)], dtype="int64")


@F.pandas_udf(LongType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two sets in bytes."""
    out = []
    for x, y in zip(a, b):
        both = np.concatenate([np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)])
        both.sort(kind="stable")
        out.append(int((both[1:] == both[:-1]).sum()))
    return pd.Series(out, dtype="int64")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows with texts or sets go to Python ``PAIRS`` at a time, while a table is staged inside."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(PAIRS))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _met(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` of nodes (a, b) with the given columns of both their sets."""
    # Merged at every size: whether pairs are few enough to broadcast must not change what moves.
    side = lambda s: sets.select(
        F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]
    ).hint("merge")
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _enough_matches(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) whose prefixes share as many tokens as sets of their sizes must.

    Sets of n and m tokens that reach the threshold share at least ``o`` tokens, and then prefixes of n - o + k and
    m - o + k tokens share k. The prefixes are there already, so k follows from their lengths: for sets of one size a
    good tenth of the tokens, and one more for every token that a prefix was lengthened by.
    """
    def side(name: str) -> DataFrame:
        length = F.col("n") - F.ceil(F.col("n") * percent / 100) + F.col("matches")
        own = (F.col("node").alias(name), "token", F.col("n").alias(f"n_{name}"), length.alias(f"length_{name}"))
        return lists.select(*own).hint("merge")

    c = F.col
    both = pairs.join(side("a"), "a").join(side("b"), ["b", "token"])
    least = least_overlap(c("n_a"), c("n_b"), percent)
    asked = F.least(c("length_a") - c("n_a") + least, c("length_b") - c("n_b") + least)
    counted = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("found"), F.first(asked).alias("asked"))
    return counted.where(c("found") >= c("asked")).select("a", "b")


def _verified(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """The classes, with their nodes, of those pairs of nodes (a, b) that reach the threshold.

    First only sketches meet, which bound the shared tokens from above. Whole sets move for what is left.
    """
    sketched = _met(pairs, sets_of(_ends(pairs), False), "n", "data")
    perhaps = _bound("data_a", "n_a", "data_b", "n_b") >= least_overlap(F.col("n_a"), F.col("n_b"), percent)
    with _small_batches(pairs.sparkSession):
        near = stage(sketched.where(perhaps).select("a", "b"), "near")
    both = _met(near, sets_of(_ends(near), True), "class", "n", "data")
    both = both.withColumn("shared", _shared("data_a", "data_b"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    linked = both.where(F.col("shared") * 100 >= union * percent).select("a", "b", "class_a", "class_b")
    with _small_batches(pairs.sparkSession):
        return stage(linked, "links")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it is connected to) of every node in ``edges`` (``u``, ``v``).

    Labels spread to neighbours and then jump to the label of their label, until nothing changes; every round is
    written to the shared folder. No node's neighbours are gathered.
    """
    both = stage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels.node == near.u).select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        moved = spread.join(jump, "to").select("node", "label", F.least("to", "further").alias("next"))
        moved = stage(moved, "labels")
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("next != label").isEmpty():
            return labels


def _classes(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of rows with id and text: id, class and size of each; and each class with its smallest id and its label.

    Classes of one component have one label.
    """
    with _small_batches(rows.sparkSession):
        survey = stage(_survey(rows), "shingles")
    members = survey.where("kind = 0").select("id", "class", "size")
    frequent = (
        survey.where("kind = 1")
        .groupBy("token")
        .agg(F.sum("size").alias("times"))
        .where(F.col("times") >= LEAST_FREQUENT)
        .orderBy(F.desc("times"), "token")
        .limit(FREQUENT)
        .toPandas()
        .sort_values("token")
    )
    prefixes = _prefixes(rows, frequent["token"].to_numpy(np.int64), frequent["times"].to_numpy(np.int64), percent)

    # Lists of two classes or more, each with its pivot: the member with the fewest rarer tokens.
    own = Window.partitionBy("token")
    place = F.expr("shiftright(packed, 4) & 1073741823")
    lists = (
        prefixes.repartition("token")
        .dropDuplicates(["token", "node"])
        .withColumn("members", F.count(F.lit(1)).over(own))
        .withColumn("pivot", F.min(F.struct(place.alias("place"), "node", "packed")).over(own))
        .where("members > 1")
        .select(
            "token",
            "node",
            "members",
            F.expr("shiftright(packed, 34)").alias("n"),
            place.alias("place"),
            F.expr("packed & 15").alias("matches"),
            F.col("pivot.node").alias("pivot"),
            F.expr("shiftright(pivot.packed, 34)").alias("pivot_n"),
            F.col("pivot.place").alias("pivot_place"),
            F.expr("pivot.packed & 15").alias("pivot_matches"),
        )
    )
    with _small_batches(rows.sparkSession):
        lists = stage(lists, "lists")

    def possible(n, place, m, other, matches) -> Column:
        """Whether sets with a shared token at these places can reach the threshold, it being one of the first ones."""
        rest = F.least(n - place, m - other) - 1
        return matches + rest >= least_overlap(n, m, percent)

    c = F.col
    star = (
        lists.where(c("node") != c("pivot"))
        .where(possible(c("n"), c("place"), c("pivot_n"), c("pivot_place"), F.least("matches", "pivot_matches")))
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    star = stage(_enough_matches(star, lists, percent), "star")
    classes = members.where("size > 0").groupBy("class").agg(F.min("id").alias("id"))
    classes = classes.withColumn("node", F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("bigint"))
    key = F.coalesce("id", F.lit(_NO_ID))

    def sets_of(nodes: DataFrame, whole: bool) -> DataFrame:
        """The sets of some nodes, or their sketches: picked where the texts lie while a bitmap can tell, else moved."""
        found = classes.join(nodes, "node", "left_semi").select("node", key.alias("id"))
        keyed = rows.select(key.alias("key"), "text")
        with _small_batches(rows.sparkSession):
            if nodes.count() <= BITS // 4:
                return stage(_sets(keyed, _bitmap(found), whole), "sets")
            texts = found.select(c("id").alias("key")).distinct()
            return stage(_sets(keyed.join(texts, "key", "left_semi"), None, whole), "sets")

    edges = _verified(star, sets_of, percent)
    ends = lambda found: found.select(c("class_a").alias("u"), c("class_b").alias("v"))
    labels = components(ends(edges))

    # Members outside their pivot's component meet the other components of the list.
    named = labels.select(F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("bigint").alias("node"), "label")
    alone = F.unhex(F.lpad(F.hex("node"), 16, "0"))
    all_lists = lists
    lists = lists.where("members > 2").join(named, "node", "left").withColumn("label", F.coalesce("label", alone))
    pivots = named.select(c("node").alias("pivot"), c("label").alias("pivot_label"))
    lists = lists.join(pivots, "pivot", "left").withColumn(
        "pivot_label", F.coalesce("pivot_label", F.unhex(F.lpad(F.hex("pivot"), 16, "0")))
    )
    lists = stage(lists, "labelled")
    outside = lists.where("label != pivot_label").alias("x")
    others = lists.where("node != pivot").alias("y")
    matches = F.least("x.matches", "y.matches")
    rest = (
        outside.join(others, "token")
        .where("x.label != y.label AND (y.label = y.pivot_label OR x.node < y.node)")
        .where(possible(c("x.n"), c("x.place"), c("y.n"), c("y.place"), matches))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )
    rest = stage(_enough_matches(rest, all_lists, percent), "rest")
    if not rest.isEmpty():
        more = _verified(rest, sets_of, percent)
        labels = components(ends(edges).unionByName(ends(more)))

    classes = classes.select("class", "id").join(labels.withColumnRenamed("node", "class"), "class", "left")
    return members, classes.withColumn("label", F.coalesce("label", "class"))


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` (its set's size) and ``component_id``, the smallest reachable id.

    Words are lower-cased in A-Z; a set holds the distinct windows of ``WIDTH`` words. Rows are linked when the
    intersection is at least ``percent`` per cent of the union; equal sets always are. A null text, an empty one or
    one without words has size 0, is linked with nothing and is its own component. Rows with equal ids stay rows; a
    null id never names a component unless nothing else can, and other columns are not read. No rows give no rows.

    Texts are read for classes and frequent tokens, for prefixes, and in both steps for the sketches of classes that
    meet another and the sets of those that may be linked. Only the table of the ``FREQUENT`` most frequent tokens is broadcast. It affects order and cost, never
    the result.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    members, classes = _classes(rows, percent)
    smallest = classes.groupBy("label").agg(F.min("id").alias("component"))
    classes = classes.join(smallest, "label").select("class", "component")
    joined = members.withColumn("class", F.when(F.col("size") > 0, F.col("class"))).join(classes, "class", "left")
    return joined.select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def _with_class(docs: DataFrame) -> DataFrame:
    """``docs`` with the class of every row's text, null without words."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PAIRS):
                part = batch.slice(low, PAIRS)
                names = [class_of(own) if len(own) else None for own in shingle_sets(_texts(part.column(at)))]
                columns = [*part.columns, pa.array(names, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "__class"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__class", T.BinaryType())]))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of ``docs`` (with doc_id and text) for each component, all columns kept; no component is lost.

    It is a row of the component's smallest id, null counting as greatest; of several texts with that id the one with
    the smallest class, and of several rows of that class the one with the smallest hash of all columns. Which rows
    stay does not depend on how the data are split. Rows without words are in no component and all stay.
    """
    members, classes = _classes(docs.select(F.col("doc_id").cast("bigint").alias("id"), "text"), percent)
    of = classes.select("class", "label")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "class")
    best = members.where("size > 0").join(of, "class").groupBy("label").agg(F.min(order).alias("best"))
    chosen = best.select(F.col("best.id").alias("__id"), F.col("best.class").alias("__chosen"))
    rows = _with_class(docs)
    same = (F.col("__class") == F.col("__chosen")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id"))
    first = Window.partitionBy("__chosen").orderBy(F.xxhash64(*docs.columns))
    found = rows.where("__class IS NOT NULL").join(chosen, same).withColumn("__place", F.row_number().over(first))
    without = rows.where("__class IS NULL")
    return found.where("__place = 1").select(docs.columns).unionByName(without.select(docs.columns))
