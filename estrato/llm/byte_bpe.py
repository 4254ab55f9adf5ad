"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points become symbols of a small automaton; a symbol knows its class and what follows it. Every symbol is a
transition function on the automaton's states. Functions compose associatively, so the state before every code point
comes from a prefix scan over the finite set of composed functions, without a regular expression. The pieces between
boundaries are merged by rank through a cache; token ends are kept, and decoding places bytes by them.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20  # code points that are scanned at once, at least one text
ROWS = 256  # rows of an Arrow batch that are unpacked at once
CACHE = 1 << 19  # pieces a worker remembers before it starts anew
LONG_PIECE = 64  # bytes from which merging uses a heap

# Symbols of the automaton.
RESET, LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, SPACES, BLANK, GAP = range(9)
# States: nothing open, in a run of letters, numbers, others or white space, after a blank that joins what follows,
# and with one or two letters of a contraction to come.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)
STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here", both by [symbol, state]."""
    step, starts = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[symbol] = run
        starts[symbol, [run, AFTER_BLANK]] = False
    step[LETTER, ONE_MORE], step[LETTER, TWO_MORE] = FREE, ONE_MORE
    starts[LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, rest in ((QUOTE_1, ONE_MORE), (QUOTE_2, TWO_MORE)):
        step[symbol] = rest
        step[symbol, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS
        starts[symbol, [IN_OTHERS, AFTER_BLANK]] = False
    step[SPACES] = IN_SPACES
    starts[SPACES, IN_SPACES] = False
    step[BLANK] = AFTER_BLANK
    return step, starts


@functools.cache
def _scan_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The functions that symbols compose to: symbol -> function, compositions, function applied to state, starts."""
    step, starts = _automaton()
    known = {tuple(range(STATES)): 0}
    order = [tuple(range(STATES))]
    for f in order:  # grows while functions are found
        for symbol in range(9):
            g = tuple(int(step[symbol, s]) for s in f)
            if g not in known:
                known[g] = len(order)
                order.append(g)
    apply = np.array(order, np.uint8)
    compose = np.array([[known[tuple(apply[b][apply[a]].tolist())] for b in range(len(order))] for a in range(len(order))])
    of_symbol = np.array([known[tuple(step[symbol].tolist())] for symbol in range(9)], np.uint8)
    return of_symbol, compose.astype(np.uint8), apply, starts


def _scan(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix compositions: blocks of ``width`` side by side, then the blocks' totals the same way."""
    compose = _scan_tables()[1]
    size = len(compose)
    flat = compose.ravel()
    n = len(functions)
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    for i in range(1, width):
        columns[i] = flat[columns[i - 1].astype(np.intp) * size + columns[i]]
    if blocks > 1:
        before = np.zeros(blocks, np.uint8)
        before[1:] = _scan(columns[-1].copy(), width)[:-1]
        columns = flat[before.astype(np.intp) * size + columns]
    return np.ascontiguousarray(columns.T).ravel()[:n]


@functools.cache
def _classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACES for every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    # White space of the pattern: the code points with the property White_Space.
    spaces = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[spaces] = SPACES
    return table


def boundaries(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts as one buffer of bytes, the byte offset of each piece, and which text a piece belongs to.

    Between two texts stands one byte 0, a piece of its own with text number -1.
    """
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kinds = _classes()[codes]
    kinds[ends] = SPACES  # white space before the end of a text is followed by no word
    symbols = kinds.copy()
    following = np.empty_like(kinds)
    following[:-1], following[-1] = kinds[1:], SPACES
    last = (kinds == SPACES) & (following != SPACES)
    symbols[last] = np.where(codes[last] == 32, BLANK, GAP)
    quotes = np.flatnonzero(codes == 39)
    if len(quotes):
        after = np.concatenate([codes, np.zeros(2, np.uint32)])
        a, b = after[quotes + 1], after[quotes + 2]
        symbols[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = QUOTE_1
        two = ((a == ord("l")) & (b == ord("l"))) | (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")))
        symbols[quotes[two]] = QUOTE_2
    symbols[ends] = RESET
    of_symbol, _, apply, starts = _scan_tables()
    states = np.empty(len(symbols), np.uint8)
    states[0] = FREE
    states[1:] = apply[:, FREE][_scan(of_symbol[symbols])[:-1]]
    first = np.flatnonzero(starts.ravel()[symbols.astype(np.intp) * STATES + states])
    number = np.searchsorted(ends, first, "left")
    number[symbols[first] == RESET] = -1
    buffer = joined.encode("utf-8", "surrogatepass")
    if len(buffer) > len(codes):
        sizes = 1 + (codes >= 0x80).astype(np.uint8) + (codes >= 0x800) + (codes >= 0x10000)
        first = np.cumsum(sizes, dtype=np.int64)[first] - sizes[first]
    return buffer, first, number


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    get, none = ranks.get, 1 << 62
    parts = [piece[i : i + 1] for i in range(len(piece))]
    scores = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while scores:
        best = min(scores)
        if best == none:
            break
        at = scores.index(best)
        joined = parts[at] = parts[at] + parts.pop(at + 1)
        del scores[at]
        if at < len(scores):
            scores[at] = get(joined + parts[at + 1], none)
        if at:
            scores[at - 1] = get(parts[at - 1] + joined, none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap over linked parts, for pieces of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))

    def rank(i: int) -> int | None:
        j = end[i]
        return ranks.get(piece[i : end[j]]) if j < n else None

    heap = [(r, i, end[i], end[end[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue  # one of the parts has changed
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
        for k in (i, before[i]):
            if k >= 0 and (r := rank(k)) is not None:
                heapq.heappush(heap, (r, k, end[k], end[end[k]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """Ranks of a byte-level BPE, with the cache of merged pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.fresh: list[list[int]] = []
        self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _number(self, piece: bytes) -> int:
        found = self.cache.get(piece)
        if found is None:
            rank = self.ranks.get(piece)
            merge = _merge_short if len(piece) < LONG_PIECE else _merge_long
            self.fresh.append([rank] if rank is not None else merge(piece, self.ranks))
            found = self.cache[piece] = len(self.counts) + len(self.fresh) - 1
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if len(self.cache) > CACHE:
            self._forget()
        buffer, first, number = boundaries(texts)
        spans = np.append(first, len(buffer)).tolist()
        pieces = [buffer[a:b] for a, b in zip(spans, spans[1:])]
        get, slow = self.cache.get, self._number
        rows = np.array([n if (n := get(p)) is not None else slow(p) for p in pieces], np.int64)
        if self.fresh:
            self.counts = np.append(self.counts, [len(ids) for ids in self.fresh])
            self.flat = np.concatenate([self.flat, *[np.array(ids, np.int32) for ids in self.fresh]])
            self.fresh = []
        own = number >= 0
        rows, number = rows[own], number[own]
        offsets = np.cumsum(self.counts) - self.counts
        ids = self.flat[_ragged(offsets[rows], self.counts[rows])]
        per_text = np.bincount(number, weights=self.counts[rows], minlength=len(texts)).astype(np.int64)
        return ids, per_text

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of one text; ``ends`` has the end of each token in bytes."""
        sizes = np.diff(ends, prepend=0)
        return self.bytes[_ragged(self.starts[ids], sizes)].tobytes()


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, in a row."""
    total = int(sizes.sum())
    at = np.cumsum(sizes) - sizes
    return np.repeat(starts - at, sizes) + np.arange(total)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file, once in a worker; the file is part of the installed packages of every machine."""
    return Vocabulary(read_ranks(path))


def _chunks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for text in texts:
        text = text or ""
        chunk.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def encode(
    docs: DataFrame,
    ranks_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    read_back: bool = False,
) -> DataFrame:
    """Per row of ``docs``: the id, ``ids array<int>`` and ``ends array<int>``, the byte where each token ends.

    With ``read_back`` the column ``decoded binary`` has the bytes that ids and ends decode to, made where they are.
    Every piece of the pattern is merged alone and no special token is recognised. A null or empty text has no ids.
    Texts of any length are encoded whole. Repeated rows are encoded each; other columns are not read; no rows give
    no rows. Nothing is shuffled, and results leave a worker chunk by chunk.
    """
    kind = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, ids array<int>, ends array<int>" + (", decoded binary" if read_back else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks_path)
        for batch in batches:
            done = 0
            for chunk in _chunks(t for at in range(0, len(batch), ROWS) for t in batch.slice(at, ROWS)[1].to_pylist()):
                ids, counts = words.encode(chunk)
                stops = np.cumsum(counts)
                whole = np.cumsum(words.sizes[ids])
                before = np.concatenate([[0], whole])[stops - counts]
                ends = (whole - np.repeat(before, counts)).astype(np.int32)
                offsets = pa.array(np.concatenate([[0], stops]), pa.int32())
                columns = [
                    batch.column(0).slice(done, len(chunk)),
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int32())),
                ]
                if read_back:
                    spans = zip(stops - counts, stops)
                    columns.append(pa.array([words.decode(ids[a:b], ends[a:b]) for a, b in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [id_column, "ids", "ends", "decoded"][: len(columns)])
                done += len(chunk)

    rows = docs.select(F.col(id_column), F.col(text_column).alias("__text"))
    return rows.mapInArrow(run, schema)


def decode(ranks_path: str):
    """A column function from ``ids`` and ``ends`` to the bytes of the text; null or no ids give no bytes."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        words = vocabulary(ranks_path)
        for ids, ends in batches:
            yield pd.Series(
                [b"" if i is None or not len(i) else words.decode(np.asarray(i), np.asarray(e)) for i, e in zip(ids, ends)]
            )

    return run

