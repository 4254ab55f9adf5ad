"""Collocations against brute force on small texts."""

import random
import re
from collections import Counter, defaultdict

import pytest
from estrato.llm import phrases

RESULT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _brute(rows, least, most_words, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][" ".join(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            words = phrase.split(" ")
            if len(words) < 2 or a < least:
                continue
            if any(
                b >= least and g != phrase and f" {phrase} " in f" {g} " and 100 * b >= share * a
                for g, b in counts.items()
            ):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[" ".join(words[:k])], counts[" ".join(words[k:])]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _random_texts(seed, texts):
    pick = random.Random(seed)
    words = ["a", "b", "a\x01", "É", "é", "word", "Word", "\x00", "x" * 40, "漢"]
    ends = [" ", " ", " ", "  ", "\t", "\n", ". ", ",", "\x0b", "!"]
    made = []
    for _ in range(texts):
        size = pick.choice([0, 1, 2, 5, 30, 200])
        made.append(
            (pick.choice(["en", "fr", None, "", "en\tx"]), "".join(pick.choice(words) + pick.choice(ends) for _ in range(size)))
        )
    return made + [("en", None), ("en", ""), (None, "  \n "), ("de", "only a few")]


@pytest.mark.parametrize("parts, share, top", [(1, 100, 2000), (7, 100, 3), (7, 50, 2000)])
def test_collocations_match_brute_force(spark, monkeypatch, parts, share, top):
    monkeypatch.setattr(phrases, "BYTES", 500)  # many chunks, so words and contexts are added up
    monkeypatch.setattr(phrases, "WORDS", 200)
    monkeypatch.setattr(phrases, "PART", 500)
    rows = _random_texts(parts, 60)
    docs = spark.createDataFrame([(lang, text, "clash") for lang, text in rows], "lang string, text string, phrase string")
    found = phrases.collocations(docs.repartition(parts), least=3, share=share, top=top)
    assert found.columns == RESULT
    assert sorted(tuple(r) for r in found.collect()) == _brute(rows, 3, 5, share, top)


def test_repeated_rows_count_again_and_order_is_bytewise(spark):
    rows = [("en", "b c. ￿ c. \U00010000 c.")] * 4
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = sorted(tuple(r) for r in phrases.collocations(docs, least=4).collect())
    assert found == _brute(rows, 4, 5, 100, 2000)
    assert [r[2] for r in found] == ["b c", "￿ c", "\U00010000 c"]


def test_no_rows_and_no_candidates(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", "a b")], empty.schema)).collect() == []


@pytest.mark.parametrize("hot", [1, 40, 1 << 19])
def test_phrases_of_hot_words_are_added_up_over_groups(spark, monkeypatch, hot):
    """One pair in every text, each time with other words behind it: its contexts are dealt over many groups."""
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "PART", 100)
    monkeypatch.setattr(phrases, "WORDS", 64)
    rows = [("en", f"hot pair {i % 90} {i % 45} tail") for i in range(900)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = sorted(tuple(r) for r in phrases.collocations(docs.repartition(6), least=10).collect())
    assert found == _brute(rows, 10, 5, 100, 2000)
    counts, totals = phrases.phrase_counts(docs, least=10)
    assert {r.phrase: r.times for r in counts.collect()}["hot pair"] == 900
    assert [tuple(r) for r in totals.collect()] == [("en", 4500)]


def test_products_beyond_64_bits(spark):
    a, n, left, right = 10**15 + 7, 10**16 + 3, 10**15 + 9, 10**15 + 13
    rows = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    got = rows.select(phrases._whole(("a", "n"), ("l", "r"))).first()[0]
    assert got == 1000 * a * n // (left * right)
