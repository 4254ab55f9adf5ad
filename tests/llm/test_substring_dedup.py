"""Removal of repeated passages against brute force, and the index against plain search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.llm import substring_dedup as sd


def _brute(rows, window):
    """Rows of distinct ids, null first: id, words, removed, kept."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            own = tuple(words[i : i + window])
            if own in seen:
                gone[i : i + window] = [True] * window
            seen.add(own)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc_id, len(words), sum(gone), kept))
    return out


def _texts(seed, count):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "漢字", "x" * 50]
    passages = [[pick.choice(vocabulary) for _ in range(pick.randint(5, 90))] for _ in range(6)]
    made = []
    for _ in range(count):
        words = []
        for _ in range(pick.randint(0, 4)):
            words += pick.choice(passages) if pick.random() < 0.6 else [pick.choice(vocabulary) for _ in range(30)]
        made.append("".join(w + pick.choice([" ", "\n", "  ", "\t"]) for w in words))
    return made + [made[3], made[3], "a " * 400, "b " + "a " * 70, "a b " * 60, "", " \n", None, "  nbsp   x"]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, words string")


def _result(frame):
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in frame.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("window, shingle, hot, shard", [(20, 8, 1 << 14, 1 << 18), (20, 8, 3, 500), (5, 2, 40, 200), (4, 4, 1, 50)])
def test_removal_matches_brute_force(spark, monkeypatch, window, shingle, hot, shard):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "SHARD", shard)
    monkeypatch.setattr(sd, "BYTES", 700)  # texts are cut into slices
    monkeypatch.setattr(sd, "SENT", 5)
    texts = _texts(window + hot, 60)
    rows = [(None if i == 9 else 7 * i - 50, t) for i, t in enumerate(texts)]
    frame = _frame(spark, rows).repartition(5)
    got = _result(sd.without_repeats(frame, window=window, shingle=shingle))
    assert got == _brute(rows, window)
    assert sum(r[2] for r in got) > 100


def test_spans_are_what_went(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, "new " + " ".join(words[5:30]) + " end"), (3, " ".join(words[:19]))]
    found = {r.doc_id: r for r in sd.without_repeats(_frame(spark, rows)).collect()}
    assert [tuple(s) for s in found[2].spans] == [(1, 26)] and found[2].kept == "new end"
    assert found[1].spans == [] and found[3].spans == [] and found[3].n_removed == 0


def test_repeated_rows_are_one_document_and_ids_may_repeat(spark):
    text, other = " ".join(f"w{i}" for i in range(30)), "x " + " ".join(f"w{i}" for i in range(30))
    same = [tuple(r)[:3] for r in sd.without_repeats(_frame(spark, [(1, text)] * 3)).select("doc_id", "n_words", "n_removed").collect()]
    assert same == [(1, 30, 0)] * 3
    for parts in (1, 3):
        frame = _frame(spark, [(1, text), (1, other), (2, text)]).repartition(parts)
        removed = sorted((r.doc_id, r.n_words, r.n_removed) for r in sd.without_repeats(frame).collect())
        first = frame.where("doc_id = 1").orderBy(F.xxhash64("text")).first().text  # one of the two keeps it
        assert removed == sorted([(1, 30, 0 if first == text else 30), (1, 31, 0 if first == other else 30), (2, 30, 30)])


def test_no_rows(spark):
    assert sd.without_repeats(_frame(spark, [])).collect() == []


def test_index_counts_like_plain_search():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 5, 3000)
    index = sd.FMIndex(text, 5, 6)
    cyclic = np.concatenate([text, text[:8]])
    for _ in range(50):
        pattern = rng.integers(0, 5, rng.integers(1, 7))
        low, high = np.array([0]), np.array([len(text)])
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        plain = sum((cyclic[i : i + len(pattern)] == pattern).all() for i in range(len(text)))
        assert high[0] - low[0] == plain


def test_equal_windows_have_equal_anchors_that_count_twice():
    words = np.random.default_rng(4).integers(0, 1 << 60, 100, dtype=np.uint64)
    twice = np.concatenate([words[:50], words[10:40], words[60:]])
    least, marked = sd.anchors_of(twice, 20, 8)
    assert (least[10:21] == least[50:61]).all()
    assert all((marked == a).sum() >= 2 for a in least[10:21])
    least, marked = sd.anchors_of(np.full(21, 7, np.uint64), 20, 8)
    assert len(least) == 2 and (marked == least[0]).sum() > 1
