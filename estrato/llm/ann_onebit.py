"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A unit vector is rotated into ``bits`` dimensions and only the signs are kept, packed into 64-bit words. With the
inner product of the vector and its code as correction, the code estimates inner products without bias and with a known
error bound. Queries are rotated alike and cut into bit planes, so an estimate is a few AND and popcount operations.
Candidates whose upper bound reaches the lower bound of the k-th best are measured exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS_PER_DIMENSION = 4
PLANES = 4  # bits of a quantised query component
EPSILON = 3.0  # width of the error bounds in standard deviations
CANDIDATES, QUERIES = 1 << 14, 1 << 12  # rows of a block
SEED = 20


@functools.cache
def rotation(dimensions: int) -> np.ndarray:
    """A seeded matrix with orthonormal columns, bits x dimensions; the bits are whole 64-bit words."""
    bits = -(-dimensions * BITS_PER_DIMENSION // 64) * 64
    gauss = np.random.default_rng(SEED + dimensions).standard_normal((bits, dimensions))
    return np.linalg.qr(gauss)[0]


def _words(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs, axis=1).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes as rows of 64-bit words, the vectors' lengths, and the inner product of each unit vector with its code."""
    turned = vectors @ rotation(vectors.shape[1]).T
    lengths = np.sqrt((vectors**2).sum(axis=1))
    match = np.abs(turned).sum(axis=1) / (lengths * np.sqrt(turned.shape[1]))
    return _words(turned > 0), lengths, match


def estimate(
    codes: np.ndarray, lengths: np.ndarray, match: np.ndarray, query: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all coded vectors with one query, and the half width of their bounds."""
    turned = rotation(len(query)) @ query
    bits = len(turned)
    low = turned.min()
    step = max((turned.max() - low) / ((1 << PLANES) - 1), 1e-300)
    levels = np.rint((turned - low) / step).astype(np.uint8)
    weighed = np.zeros(len(codes))
    for plane in range(PLANES):
        mask = _words(((levels >> plane) & 1)[None, :])[0]
        weighed += np.bitwise_count(codes & mask).sum(axis=1, dtype=np.int64) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    # The sum of sign * component: twice the components under set bits less all components.
    signed = 2 * (step * weighed + low * ones) - (step * levels.sum() + low * bits)
    guess = lengths * signed / (np.sqrt(bits) * match)
    size = np.sqrt((query**2).sum())
    spread = size * np.sqrt((1 - match**2) / (match**2 * (bits - 1))) + step / (np.sqrt(12) * match)
    return guess, EPSILON * lengths * spread


def _search(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best candidates of this block for every query of this block."""
    columns = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
    if len(candidates) and len(queries):
        ids = candidates["id"].to_numpy(np.int64)
        vectors = np.stack(candidates["vector"].to_numpy()).astype(np.float64)
        codes = np.frombuffer(b"".join(candidates["code"]), np.uint64).reshape(len(ids), -1)
        lengths, match = candidates["length"].to_numpy(float), candidates["match"].to_numpy(float)
        for query_id, query_key, query in zip(queries["id"], queries["key"], queries["vector"]):
            query = np.asarray(query, np.float64)
            guess, half = estimate(codes, lengths, match, query)
            own = ids == query_id
            lower = np.where(own, -np.inf, guess - half)
            bar = -np.inf
            if len(lower) > k:
                bar = np.partition(lower, len(lower) - k)[len(lower) - k]
            near = np.flatnonzero((guess + half >= bar) & ~own)
            score = (vectors[near] * query).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            columns["query_id"].append(np.full(len(best), query_id))
            columns["query_key"].append(np.full(len(best), query_key))
            columns["vec_id"].append(ids[near][best])
            columns["score"].append(score[best])
    return pd.DataFrame({name: np.concatenate(parts) if parts else [] for name, parts in columns.items()})


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the ``k`` nearest rows of every query row.

    Nearness is the inner product of the original vectors in double precision; ties go to the smaller id. ``is_query``
    is a condition on rows of ``vectors``. A query's candidates are all rows with another id and as many dimensions;
    with fewer than ``k``, all are returned. Rows whose id is null or whose vector is not ``usable`` take no part.
    Rows with the same id and vector are one query but separate candidates. Other columns are not read; no queries
    or rows give no rows.

    Every row is coded once. Blocks of rows meet blocks of queries, each block of a fixed expected size, dealt by a
    hash of id and vector, so equal vectors spread; a block returns at most ``k`` rows a query.
    """
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumns({"dimensions": F.size("vector"), "key": F.xxhash64("vector")})
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries")).first()
    row_blocks = max(1, -(-counts["rows"] // CANDIDATES))
    query_blocks = max(1, -(-counts["queries"] // QUERIES))
    spread = F.xxhash64("id", "key")

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, group in batch.groupby("dimensions"):
                words, lengths, match = encode(np.stack(group["vector"].to_numpy()).astype(np.float64))
                yield group.assign(code=[w.tobytes() for w in words], length=lengths, match=match)

    coded = rows.select("id", "vector", "dimensions", "key").mapInPandas(
        code,
        "id bigint, vector array<double>, dimensions int, key bigint, code binary, length double, match double",
    )
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = ["dimensions", "row_block", "query_block"]
    left = coded.withColumns(
        {"row_block": F.pmod(spread, F.lit(row_blocks)).cast("int"), "query_block": blocks(query_blocks)}
    )
    right = (
        rows.where("asks")
        .dropDuplicates(["id", "vector"])
        .withColumns({"query_block": F.pmod(spread, F.lit(query_blocks)).cast("int"), "row_block": blocks(row_blocks)})
        .select(*place, "id", "key", "vector")
    )
    found = (
        left.groupBy(*place)
        .cogroup(right.groupBy(*place))
        .applyInPandas(
            lambda c, q: _search(c, q, k), "query_id bigint, query_key bigint, vec_id bigint, score double"
        )
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id"), "score")
