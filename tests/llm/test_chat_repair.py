"""Conversation repair against exhaustive search and a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from estrato.llm import chat_repair as cr
from estrato.llm import queries

SPACE = " \t\n\x0b\x0c\r"


def _faults(rows):
    """Per row the name of its first fault or None."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare.strip(SPACE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _plain(rows, faults):
    """Cost, audit and rows after repair, by states that carry whole strings."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit, out) in list(states.items()):
                role = {"u": "user", "a": "assistant"}[follow[state]]
                new = (cost + 5, audit + "I", out + [(role, "")])
                if follow[state] not in states or new[:2] < states[follow[state]][:2]:
                    states[follow[state]] = new
        return states

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            ways = [(state, 2, "D", None)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                target = {"u": "user", "a": "assistant"}[follow[state]]
                ways.append((follow[state], 1 + extra, "R", (target, text)))
                initial = role[:1]
                if initial == follow[state] or (initial == "s" and state == ""):
                    ways.append((initial, extra, "K", (role, text)))
            for target, more, letter, made in ways:
                new = (cost + more, audit + letter, out + ([made] if made else []))
                if target not in after or new[:2] < after[target][:2]:
                    after[target] = new
        best = after
    return min((best_of for state, best_of in inserted(best).items() if state in ("", "a")), key=lambda b: b[:2])


def _exhaustive(rows, faults):
    best = None
    fills = ["", "u", "a", "ua", "au"]
    for gaps in itertools.product(fills, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, initials = 0, "", ""
            for (_, role, _), fault, edit, gap in zip(rows, faults, edits, gaps):
                cost, audit, initials = cost + 5 * len(gap), audit + "I" * len(gap), initials + gap
                if edit == "D":
                    cost, audit = cost + 2, audit + "D"
                    continue
                if fault in ("blank", "duplicate"):
                    cost += 10**6
                cost += (edit != "K") + (5 if fault == "truncated" else 0)
                audit += "K" if edit == "K" else "R"
                initials += (role[:1] if role[:1] in ("s", "u", "a") else "x") if edit == "K" else edit
            cost, audit, initials = cost + 5 * len(gaps[-1]), audit + "I" * len(gaps[-1]), initials + gaps[-1]
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def _expected(rows):
    """The report of one conversation's rows, in order."""
    faults = _faults(rows)
    cost, audit, repaired = _plain(rows, faults)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    said = "\n".join(f"{role}:{text}" for role, text in repaired)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest())


def _ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def _random_rows(pick, size):
    roles = ["user", "assistant", "system", "tool", "", "summary"]
    texts = ["Yes.", "No!", "why", "  ", "", "ok?\n", "cut off", "é.", ".", "漢"]
    weights = [6, 6, 2, 1, 1, 1]
    return [(pick.choice([None, *range(size)]), pick.choices(roles, weights)[0], pick.choice(texts)) for _ in range(size)]


def test_plain_programme_matches_exhaustive_search():
    pick = random.Random(1)
    for _ in range(25):
        rows = _ordered(_random_rows(pick, pick.randint(0, 2)))
        faults = _faults(rows)
        assert _plain(rows, faults)[:2] == _exhaustive(rows, faults)


def test_grammar_matches_plain_programme(monkeypatch):
    pick = random.Random(2)
    cases = [_random_rows(pick, pick.choice([1, 2, 5, 9, 40])) for _ in range(300)]
    cases += [[(i, pick.choice(["user", "assistant"]), f"{i}{pick.choice('. ')}") for i in range(400)] for _ in range(4)]
    cases += [[(i, ["user", "assistant"][i % 2], f"{i}.") for i in range(700)], [(i, "user", f"{i}") for i in range(300)]]
    sequences, wanted = [], []
    for rows in cases:
        faults = _faults(rows)
        code = {None: 0, "truncated": 1, "blank": 2, "duplicate": 3}
        initial = {"s": 0, "u": 1, "a": 2}
        sequences.append(bytes(65 + 4 * initial.get(r[1][:1], 3) + code[f] for r, f in zip(rows, faults)))
        wanted.append(_plain(rows, faults)[:2])
    assert cr.cheapest(sequences) == wanted
    monkeypatch.setattr(cr, "SYMBOLS", 7)
    assert cr.cheapest(sequences) == wanted


def test_rules_spell_the_pieces():
    rng = np.random.default_rng(5)
    pieces = [rng.integers(0, 16, n) for n in (0, 1, 2, 50, 300)] + [np.full(37, 3), np.full(2, 3), np.tile([1, 2, 2], 40)]
    rules, written = cr.grammar(pieces)

    def spelled(symbol):
        return [symbol] if symbol < 16 else spelled(rules[symbol - 16][0]) + spelled(rules[symbol - 16][1])

    assert [[x for s in piece.tolist() for x in spelled(s)] for piece in written] == [p.tolist() for p in pieces]
    assert len(written[-1]) < 12 and all(max(rule) < 16 + i for i, rule in enumerate(rules))


def test_ropes_compare_like_their_texts():
    pick = random.Random(6)
    ropes = [cr.Rope("".join(pick.choices("DIKR", k=pick.randint(0, 3)))) for _ in range(30)]
    ropes += [cr.Rope("K")]
    for _ in range(8):
        ropes.append(ropes[-1] + ropes[-1])
    ropes += [a + b for a, b in itertools.product(ropes[-6:], ropes[:5])] + [a + b for a, b in itertools.product(ropes[:5], ropes[-6:])]
    for a, b in itertools.product(ropes, ropes):
        assert (a < b) == (str(a) < str(b))


@pytest.mark.parametrize("chunk_bits, parts", [(12, 1), (1, 5)])
def test_repair_matches_brute_force(spark, monkeypatch, chunk_bits, parts):
    monkeypatch.setattr(cr, "CHUNK_BITS", chunk_bits)
    pick = random.Random(parts)
    conversations = {i: _random_rows(pick, pick.choice([1, 2, 3, 8, 30])) for i in range(60)}
    conversations[None] = _random_rows(pick, 5)
    conversations[-5] = [(i // 3, pick.choice(["user", "assistant"]), f"{i % 50}{pick.choice('.?x')}") for i in range(900)]
    rows = [(c, t, r, x, "clash") for c, own in conversations.items() for t, r, x in own]
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string").repartition(parts)
    report, places = cr.repair(frame)
    in_order = cr.repaired_rows(places, in_order=True)
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.digests(in_order).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = {r[0]: (*r[1:], hashes.get(r[0], nothing)) for r in report.collect()}
    assert got == {c: _expected(_ordered(own)) for c, own in conversations.items()}
    spread = sorted(map(repr, cr.repaired_rows(places).collect()))
    assert spread == sorted(map(repr, in_order.collect()))
    by_conversation = defaultdict(list)
    for r in in_order.collect():
        by_conversation[r.conv_id].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in by_conversation.values())


def test_nulls_are_spaces_and_no_rows_give_none(spark):
    schema = "conv_id long, turn long, role string, text string"
    report, places = cr.repair(spark.createDataFrame([(1, None, None, "Hi."), (1, 3, "user", None)], schema))
    row = report.first()
    assert (row.gaps, row.blank, row.illegal, row.cost, row.audit) == (0, 1, 1, 4, "DD")
    assert cr.repaired_rows(places).count() == 0
    report, places = cr.repair(spark.createDataFrame([], schema))
    assert report.count() == 0 and cr.repaired_rows(places).count() == 0


def test_query_matches_brute_force(spark, tmp_path):
    pick = random.Random(9)
    rows = [(c, t, r, x) for c in [None, *range(40)] for t, r, x in _random_rows(pick, pick.choice([1, 1, 6]))]
    rows += [(100, 2, None, None), (101, None, "user", "Hi."), (102, 1, "assistant", "Fine, yes."), (102, 1, "assistant", "Fine, yes.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted(map(repr, (tuple(r) for r in queries.op11_chat_repair(spark, str(tmp_path)).collect())))
    damaged = defaultdict(list)
    for c, turn, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        number = zlib.crc32(name.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(number, text)
        damaged[c] += [(turn, "user" if number == 4 else role, text)] * {0: 0, 3: 2}.get(number, 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == sorted(repr((c, *(_expected(_ordered(own)) if own else empty))) for c, own in damaged.items())
