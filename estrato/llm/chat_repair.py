"""Cheapest repair of damaged conversations, by min-plus products over a grammar of their rows.

A row is one symbol: the class of its role's initial and its first fault. What a row, or a run of rows, can do to a
conversation is a matrix over four states of the repaired sequence: nothing yet, after a system row, after a user row,
after an assistant row. Its entries are the cheapest cost between two states with the edits that reach it, the
ASCII-least ones on ties. Products of such matrices are associative, ties included: edits of the same rows with the
same cost are never one the beginning of the other, since that would cost the difference.

Pairs of neighbouring symbols that occur often in a batch of conversations become symbols of their own, pairs of those
again, and so on. Each such rule gets one matrix, from the matrices of its two parts, and all conversations that hold
the rule share it. Edits are ropes: a rule joins those of its parts without copying them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.session import stage

ROLES = ("user", "assistant")
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5  # costs
TRUNCATED = 5  # for a truncated row that stays
CHUNK_BITS = 12  # rows that travel as one string: 2 ** CHUNK_BITS of a task's sorted rows
SYMBOLS = 1 << 16  # symbols that share a grammar; a longer conversation is several pieces of it
SHORT = 48  # edits that a rope holds as plain text

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states of the repaired sequence
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_MAY_FOLLOW = {SYSTEM: (NOTHING,), USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_ENDS = (NOTHING, ASSISTANT)
_LEGAL = ("su", "ua", "au")

# A symbol is 4 * class of the initial + fault, sent as a letter from "A".
_INITIALS, _SOUND, _TRUNCATED, _BLANK, _DUPLICATE = "suax", 0, 1, 2, 3


class Rope:
    """A string as a tree of its parts, compared without being written out."""

    __slots__ = ("size", "text", "left", "right", "digest", "power")
    MODULUS, BASE = (1 << 127) - 1, 0x1D3F5B6A79E8C4D2B1A0918273645546

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        if text is not None:
            self.size, self.text, self.left, self.right = len(text), text, None, None
            self.digest, self.power = 0, 1
            for letter in text:
                self.digest = (self.digest * self.BASE + ord(letter)) % self.MODULUS
                self.power = self.power * self.BASE % self.MODULUS
            return
        self.size = left.size + right.size
        self.digest = (left.digest * right.power + right.digest) % self.MODULUS
        self.power = left.power * right.power % self.MODULUS
        short = self.size <= SHORT
        self.text = left.text + right.text if short else None
        self.left, self.right = (None, None) if short else (left, right)

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(None, self, other)

    def __lt__(self, other: Rope) -> bool:
        mine, yours = [self], [other]
        while mine and yours:
            x, y = mine.pop(), yours.pop()
            if x.size == y.size and x.digest == y.digest:
                continue
            if x.text is None and (y.text is not None or x.size >= y.size):
                mine += [x.right, x.left]
                yours.append(y)
            elif y.text is None:
                yours += [y.right, y.left]
                mine.append(x)
            else:
                both = min(x.size, y.size)
                if x.text[:both] != y.text[:both]:
                    return x.text < y.text
                mine += [Rope(x.text[both:])] if x.size > both else []
                yours += [Rope(y.text[both:])] if y.size > both else []
        return not mine and bool(yours)

    def __str__(self) -> str:
        out, waiting = [], [self]
        while waiting:
            node = waiting.pop()
            if node.text is None:
                waiting += [node.right, node.left]
            else:
                out.append(node.text)
        return "".join(out)


Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _better(a: tuple[int, Rope] | None, b: tuple[int, Rope]) -> bool:
    """Whether ``b`` is cheaper than ``a``, or as cheap with smaller edits."""
    return a is None or b[0] < a[0] or (b[0] == a[0] and b[1] < a[1])


def times(first: Matrix, second: Matrix) -> Matrix:
    """The cheapest edits between two states through both parts."""
    out: Matrix = {}
    for (i, k), (cost, edits) in first.items():
        for j in range(4):
            more = second.get((k, j))
            if more is not None:
                old = out.get((i, j))
                if old is None or cost + more[0] <= old[0]:
                    new = (cost + more[0], edits + more[1])
                    if _better(old, new):
                        out[i, j] = new
    return out


def _insertions() -> Matrix:
    """No, one or two inserted rows; more never pay."""
    none = {(i, i): (0, Rope("")) for i in range(4)}
    one = {(i, j): (INSERT, Rope("I")) for j in (USER, ASSISTANT) for i in _MAY_FOLLOW[j]}
    out = dict(none)
    for matrix in (one, times(one, one)):
        for key, entry in matrix.items():
            if _better(out.get(key), entry):
                out[key] = entry
    return out


_INSERTIONS = _insertions()


def _row_matrix(symbol: int) -> Matrix:
    """What one row can do, rows inserted before it included."""
    initial, fault = _INITIALS[symbol >> 2], symbol & 3
    edits: Matrix = {(i, i): (DELETE, Rope("D")) for i in range(4)}
    if fault in (_SOUND, _TRUNCATED):
        extra = TRUNCATED if fault == _TRUNCATED else 0
        ways = [(_STATE[initial], KEEP, "K")] if initial in _STATE else []
        ways += [(state, REROLE, "R") for state in (USER, ASSISTANT)]
        for state, cost, letter in ways:
            for before in _MAY_FOLLOW[state]:
                entry = (cost + extra, Rope(letter))
                if _better(edits.get((before, state)), entry):
                    edits[before, state] = entry
    return times(_INSERTIONS, edits)


_ROWS = [_row_matrix(symbol) for symbol in range(16)]


def grammar(pieces: list[np.ndarray]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (pairs of earlier symbols, the first one symbol 16) and the pieces written with them.

    Every round replaces the most frequent pair and all others at least half as frequent that share no symbol with
    one already chosen, until no pair occurs twice. Pairs do not cross pieces.
    """
    lengths = [len(p) for p in pieces]
    text = np.full(sum(lengths) + len(pieces), -1, np.int64)
    at = 0
    for piece, length in zip(pieces, lengths):
        text[at : at + length] = piece
        at += length + 1
    rules: list[tuple[int, int]] = []
    while True:
        base = 16 + len(rules)
        inside = (text[:-1] >= 0) & (text[1:] >= 0)
        codes = np.where(inside, text[:-1] * base + text[1:], -1)
        pairs, counts = np.unique(codes[inside], return_counts=True)
        if not len(pairs) or counts.max() < 2:
            break
        least, used, chosen = max(2, counts.max() // 2), set(), []
        often = np.flatnonzero(counts >= least)
        for place in often[np.argsort(-counts[often], kind="stable")].tolist():
            a, b = divmod(int(pairs[place]), base)
            if a not in used and b not in used:
                used |= {a, b}
                chosen.append(int(pairs[place]))
        chosen.sort()
        found = np.flatnonzero(np.isin(codes, chosen))
        # Only runs of one symbol overlap: there every second pair counts.
        fresh = np.diff(found, prepend=-2) != 1
        within = np.arange(len(found)) - np.maximum.accumulate(np.where(fresh, np.arange(len(found)), 0))
        found = found[within % 2 == 0]
        text[found] = base + np.searchsorted(chosen, codes[found])
        rules += [divmod(code, base) for code in chosen]
        text = np.delete(text, found + 1)
    ends = np.flatnonzero(text < 0)
    return rules, [text[a:b] for a, b in zip(np.concatenate([[0], ends[:-1] + 1]).tolist(), ends.tolist())]


def cheapest(sequences: list[bytes]) -> list[tuple[int, str]]:
    """Cost and edits of each sequence of row symbols (letters from "A")."""
    pieces, owners = [], []
    for owner, sequence in enumerate(sequences):
        symbols = np.frombuffer(sequence, np.uint8).astype(np.int64) - ord("A")
        for low in range(0, len(symbols), SYMBOLS):
            pieces.append(symbols[low : low + SYMBOLS])
            owners.append(owner)
    matrices = list(_ROWS)
    vectors: list[Matrix] = [{(NOTHING, NOTHING): (0, Rope(""))} for _ in sequences]
    if pieces:
        rules, written = grammar(pieces)
        for a, b in rules:
            matrices.append(times(matrices[a], matrices[b]))
        for owner, piece in zip(owners, written):
            for symbol in piece.tolist():
                vectors[owner] = times(vectors[owner], matrices[symbol])
    out = []
    for vector in vectors:
        best = None
        for (_, state), entry in times(vector, _INSERTIONS).items():
            if state in _ENDS and _better(best, entry):
                best = entry
        out.append((best[0], str(best[1])))
    return out


def _next_role(state: int) -> str:
    return ROLES[1] if state == USER else ROLES[0]


def _moved(state: int, letter: str, initial: str) -> int:
    """The state after one edit; ``initial`` is that of the row a K keeps."""
    if letter == "D":
        return state
    return _STATE[initial] if letter == "K" else _STATE[_next_role(state)[0]]


def _parts_of_edits(edits: str, parts: list[str]) -> list[tuple[int, int, str]]:
    """State and number of repaired rows before each part of a conversation, and the edits of its rows.

    Rows inserted at the end belong to the last part.
    """
    out, at, state, place = [], 0, NOTHING, 0
    for number, part in enumerate(parts):
        first, begin, before = at, state, place
        for letter in part:
            initial = _INITIALS[(ord(letter) - ord("A")) >> 2]
            while True:
                edit = edits[at]
                at += 1
                state = _moved(state, edit, initial)
                place += edit != "D"
                if edit != "I":
                    break
        if number == len(parts) - 1:
            at = len(edits)
        out.append((begin, before, edits[first:at]))
    return out


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "parts array<struct<chunk:long,state:int,place:long,edits:string>>"
)
_PART = pa.struct([("chunk", pa.int64()), ("state", pa.int32()), ("place", pa.int64()), ("edits", pa.string())])
_REPORT_KINDS = [pa.int64()] * 7 + [pa.string(), pa.list_(_PART)]


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations as strings of symbols: their faults, cost and edits, worked out in groups of ``SYMBOLS``."""

    def done(rows: list[dict]) -> pa.RecordBatch:
        texts = ["".join(p["symbols"] for p in row["parts"]) for row in rows]
        known = {text: None for text in texts}
        known = dict(zip(known, cheapest([text.encode() for text in known])))
        out = []
        for row, text in zip(rows, texts):
            cost, audit = known[text]
            numbers = np.frombuffer(text.encode(), np.uint8) - ord("A")
            faults = np.bincount(numbers & 3, minlength=4)
            pairs = np.bincount((numbers[:-1] >> 2) * 4 + (numbers[1:] >> 2), minlength=16)
            legal = sum(int(pairs[_INITIALS.index(a) * 4 + _INITIALS.index(b)]) for a, b in _LEGAL)
            turns = [p for p in row["parts"] if p["turns"]]
            distinct = sum(p["turns"] for p in turns) - sum(a["high"] == b["low"] for a, b in zip(turns, turns[1:]))
            gaps = turns[-1]["high"] - turns[0]["low"] + 1 - distinct if turns else 0
            edits = _parts_of_edits(audit, [p["symbols"] for p in row["parts"]])
            parts = [
                {"chunk": p["chunk"], "state": s, "place": n, "edits": e} for p, (s, n, e) in zip(row["parts"], edits)
            ]
            out.append(
                (
                    row["conv_id"], gaps, int(faults[_BLANK]), int(faults[_DUPLICATE]), int(faults[_TRUNCATED]),
                    int(pairs.sum()) - legal, cost, audit, parts,
                )
            )
        columns = [pa.array(c, k) for c, k in zip(zip(*out), _REPORT_KINDS)]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _REPORT.split(", ")])

    for batch in batches:
        rows, size = [], 0
        for low in range(0, batch.num_rows, 256):
            for row in batch.slice(low, 256).to_pylist():
                rows.append(row)
                size += sum(len(p["symbols"]) for p in row["parts"])
                if size >= SYMBOLS:
                    yield done(rows)
                    rows, size = [], 0
        if rows:
            yield done(rows)


def _symbol(initial: Column, fault: Column) -> Column:
    number = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in "sua"]), initial), F.lit(0))
    return F.chr(F.when(number == 0, 3).otherwise(number - 1) * 4 + fault + ord("A"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest repair of conversations; ``rows`` has conv_id, turn, role and text.

    The first frame has a row per conversation: ``gaps`` (missing turn numbers), the rows that are ``blank`` (no word),
    ``duplicate`` (role and text came before) or ``truncated`` (not ended by . ! or ?), each by its first fault,
    ``illegal`` neighbours, and ``cost`` and ``audit`` of the cheapest edits: K keeps a row, R makes it the user's or
    assistant's, D deletes it (as blank and duplicate rows must be), I inserts an empty one. The repaired roles have
    initials ``(s?(ua)+)?``. Of equally cheap edits the ASCII-least are taken.

    The second frame holds ``places``: the sorted rows with what ``repaired_rows`` needs.

    Rows of a conversation are ordered by turn, nulls first, then role and text. A null role or text counts as one
    space; a null conv_id is a conversation of its own; rows equal in all of it stay rows; other columns are not read.
    No rows give no rows. Rows are sorted over all tasks, so a long conversation is spread over many; only its symbols
    and edits, a character a row, come together.
    """
    space = F.lit(" ")
    told = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    said = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    fault = (
        F.when(F.trim(said) == "", _BLANK).when(F.substring(said, -1, 1).isin(".", "!", "?"), _SOUND).otherwise(_TRUNCATED)
    )
    ordered = told.withColumn("fault", fault).orderBy("conv_id", "turn", "role", "text")
    places = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "places")

    # Which rows came before, from digests alone.
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    bare = places.select(
        "conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), "fault", digest.alias("digest")
    )
    first = bare.groupBy("conv_id", "digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    again = first.where("times > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    known = bare.join(again, same, "left")
    later = (F.col("fault") != _BLANK) & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    symbol = _symbol(F.col("initial"), F.when(later, _DUPLICATE).otherwise(F.col("fault")))
    chunks = (
        known.select("conv_id", "turn", "at", symbol.alias("symbol"), F.expr(f"shiftright(at, {CHUNK_BITS})").alias("chunk"))
        .groupBy("conv_id", "chunk")
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "symbol"))), lambda x: x.symbol), "").alias(
                "symbols"
            ),
            F.size(F.collect_set("turn")).alias("turns"),
            F.min("turn").alias("low"),
            F.max("turn").alias("high"),
        )
    )
    whole = chunks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "symbols", "turns", "low", "high"))).alias("parts")
    )
    report = stage(whole.mapInArrow(_reported, _REPORT), "report")
    edits = report.select("conv_id", F.inline("parts"))
    carriers = edits.select(
        "conv_id", "chunk", F.lit(-1).cast("long").alias("at"), "state", "place", "edits", *_nulls("turn long, role string, text string")
    )
    data = places.select(
        "conv_id", F.expr(f"shiftright(at, {CHUNK_BITS})").alias("chunk"), "at",
        *_nulls("state int, place long, edits string"), "turn", "role", "text",
    )
    return report.drop("parts"), carriers.unionByName(data)


def _nulls(schema: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in schema.split(", "))]


_REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"
_REPAIRED_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each chunk behind its edits: the rows after repair."""
    edits, at, state, place = "", 0, NOTHING, 0
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            out: list[tuple] = []
            for row in batch.slice(low, 512).to_pylist():
                conversation = row["conv_id"]
                if row["edits"] is not None:
                    edits, at, state, place = row["edits"], 0, row["state"], row["place"]
                    rows_left = sum(e != "I" for e in edits)
                else:
                    while edits[at] == "I":
                        out.append((conversation, place, "I", None, _next_role(state), ""))
                        state, place, at = _moved(state, "I", ""), place + 1, at + 1
                    edit = edits[at]
                    role = _next_role(state) if edit == "R" else row["role"]
                    if edit != "D":
                        out.append((conversation, place, edit, row["turn"], role, row["text"]))
                        place += 1
                    state, at, rows_left = _moved(state, edit, role[:1]), at + 1, rows_left - 1
                if not rows_left:
                    for _ in range(at, len(edits)):
                        out.append((conversation, place, "I", None, _next_role(state), ""))
                        state, place = _moved(state, "I", ""), place + 1
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), _REPAIRED_KINDS)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _REPAIRED.split(", ")])


def repaired_rows(places: DataFrame, in_order: bool = False) -> DataFrame:
    """The rows of all repaired conversations: conv_id, place (from 0), edit (K, R or I), turn, role, text.

    A long conversation is spread over tasks, chunk by chunk. ``in_order`` keeps each conversation in one task and its
    rows in order there, for readers that stream through it.
    """
    keys = ["conv_id"] if in_order else ["conv_id", "chunk"]
    return places.repartition(*keys).sortWithinPartitions("conv_id", "chunk", "at").mapInArrow(_applied, _REPAIRED)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text`` of its rows, joined by newlines; ``repaired`` comes in order.

    Texts are hashed as they pass, so memory does not depend on the length of a conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def ended(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

        for batch in batches:
            out = []
            for conversation, role, text in zip(batch.column(0), batch.column(4), batch.column(5)):
                conversation = conversation.as_py()
                if state is None or conversation != current:
                    if state is not None:
                        out.append((current, state.hexdigest()))
                    current, state = conversation, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role.as_py()}:{text.as_py()}".encode())
            if out:
                yield ended(out)
        if state is not None:
            yield ended([(current, state.hexdigest())])

    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with faults chosen by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats the row, 4 makes it the user's.
    """
    space = F.lit(" ")
    told = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    number = F.crc32(F.concat(told[0], F.lit(":"), told[1]).cast("binary")) % 20
    text = F.coalesce("text", space)
    return (
        rows.select("conv_id", "turn", "role", "text", number.alias("number"))
        .where("number != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("number") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(F.col("number") == 1, "").when(F.col("number") == 2, F.translate(text, ".!?", "")).otherwise(text).alias(
                "text"
            ),
            F.explode(F.when(F.col("number") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )
