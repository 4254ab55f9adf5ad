"""What the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space; ``bytes.split()`` cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lowered and nothing else touched."""
    return F.translate(text, _UPPER, _LOWER)


def remainder_of_id(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    """The words of one text as UTF-8; none for a null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def values(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few constant rows whose size the planner knows."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


LOWER = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of all words of many texts at once, by differences of a running polynomial modulo 2**64."""

    def __init__(self, seed: int):
        numbers = np.random.default_rng(seed).integers(0, 1 << 64, 257, np.uint64) | np.uint64(1)
        self.letters, self.base, self.size = numbers[:256], int(numbers[256]), 0

    def _powers(self, size: int) -> None:
        if size > self.size:
            self.size = 1 << (size - 1).bit_length()
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.full(self.size, base, np.uint64)]).cumprod(dtype=np.uint64)
                for base in (self.base, pow(self.base, -1, 1 << 64))
            )

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=running[1:])
        return mixed((running[ends] - running[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one array of bytes, the start and end of every word, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    stops = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, stops), prepend=0)
    return data, starts, ends, counts


_CELL = 1 << 17  # bits of a bitmap that one group packs


def _packed(group: pa.Table) -> pa.Table:
    buckets = group["bucket"].to_numpy()
    cell, place = buckets[0] // _CELL, buckets % _CELL
    bits = np.zeros(_CELL, np.uint8)
    bits[place] = 1
    return pa.table({"cell": pa.array([int(cell)], pa.int64()), "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def bitmap(buckets: DataFrame, bits: int) -> np.ndarray:
    """The numbers in the column ``bucket`` (0 to ``bits`` - 1) as a packed bitmap, made in cells by the executors.

    ``bits`` / 8 bytes reach the driver, however many rows there are.
    """
    distinct = buckets.select(F.col("bucket").cast("long").alias("bucket")).distinct()
    cells = distinct.groupBy((F.col("bucket") / _CELL).cast("long").alias("part")).applyInArrow(
        lambda group: _packed(group), "cell long, bits binary"
    )
    out = np.zeros(max(bits, _CELL) // 8, np.uint8)
    for row in cells.toLocalIterator():
        out[row.cell * (_CELL // 8) : (row.cell + 1) * (_CELL // 8)] = np.frombuffer(row.bits, np.uint8)
    return out


def holds(bits: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Which of the numbers are in a packed bitmap."""
    return bits[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1 == 1
