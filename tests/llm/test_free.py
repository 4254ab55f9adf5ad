"""The operators that run Python inside tasks, on small frames, against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from estrato.llm import ann_onebit, byte_bpe, ctw, jaccard_join, line_rules, mixing, quality_gbdt

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "\n\t ", "one", "two words", "é 😀 漢字", "a" * 3000, "x y " * 2000]


def _docs(spark, texts, sources=None):
    rows = [(i, t, None if sources is None else sources[i], "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score string")


# one-bit nearest neighbours


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def _exact(rows, k):
    good = [
        (i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, vector in good:
        if q % 20 == 0:
            near = [(-float((v * vector).sum()), i) for i, v in good if i != q and len(v) == len(vector)]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return {q: found for q, found in out.items() if found}


@pytest.mark.parametrize("dimensions", [3, 64])
def test_neighbours_match_brute_force(spark, dimensions):
    rng = np.random.default_rng(dimensions)
    rows = [(i, rng.standard_normal(dimensions).tolist(), "s") for i in range(400)]
    rows += [(400 + i, rows[7][1], None) for i in range(60)]  # many equal vectors: ties by id
    rows += [(500, None, ""), (520, [], ""), (540, [0.0] * dimensions, ""), (560, [float("nan")] * dimensions, "")]
    rows += [(580, [float("inf")] + [1.0] * (dimensions - 1), ""), (600, [None] * dimensions, ""), (None, rows[0][1], "")]
    rows += [(620, [1.0, 2.0], ""), (621, [2.0, 1.0], "")]
    found = ann_onebit.nearest(_vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    expected = _exact(rows, 20)
    assert {q: [x[:2] for x in v] for q, v in got.items()} == {q: [x[:2] for x in v] for q, v in expected.items()}
    assert all(abs(a[2] - b[2]) < 1e-12 for q in got for a, b in zip(got[q], expected[q]))


def test_no_vectors_and_no_queries(spark):
    assert ann_onebit.nearest(_vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert ann_onebit.nearest(_vectors(spark, [(1, [1.0], "")]), F.col("vec_id") % 20 == 0).count() == 0


def test_error_bounds_hold_for_nearly_all_estimates():
    rng = np.random.default_rng(1)
    vectors, queries = rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))
    coded = ann_onebit.encode(vectors)
    inside = [np.abs(g - vectors @ q) <= h for q in queries for g, h in [ann_onebit.estimate(*coded, q)]]
    assert np.mean(inside) > 0.99


# mixing


def _water(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_sources, target = float(sum(sizes.values())), set(order), {}
    while True:
        total = sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if left * weight[s] / total > most * sizes[s]} if total else set()
        if not above:
            return target | {s: left * weight[s] / total for s in open_sources}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_sources -= above


def test_the_mix_meets_its_targets(spark):
    rng = random.Random(3)
    names = ["a", "b", "Z", None, "é", "empty"]
    texts, sources = [], []
    for i in range(600):
        source = rng.choice(names[:5]) if rng.random() < 0.6 else "a"
        texts.append("w " * (7 if i % 3 == 0 else rng.randrange(0, 60)))
        sources.append(source)
    texts += [None, ""]
    sources += ["empty", "empty"]
    docs = _docs(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    expected = _water(sizes, (5, 2, 1), 3)
    taken = Counter()
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.taken == r.copies * r.size <= 3 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        taken[r.source] += r.taken
    assert len(rows) == len(texts)
    assert all(abs(taken[s] - expected[s]) <= 1 for s in names)


@pytest.mark.parametrize("seed", range(5))
def test_the_knapsack_is_as_good_as_trying_everything(seed):
    rng = np.random.default_rng(seed)
    sizes, counts, budget = rng.permutation(np.arange(2, 40))[:6], rng.integers(0, 4, 6), int(rng.integers(0, 150))
    reached = {0}
    for s, c in zip(sizes.tolist(), counts.tolist()):
        reached = {r + s * k for r in reached for k in range(c + 1)}
    taken = mixing.knapsack(sizes, counts, budget)
    assert (taken <= counts).all() and (sizes * taken).sum() == max(r for r in reached if r <= budget)


def test_a_large_budget_is_filled_before_the_knapsack():
    sizes, counts = np.array([1, 3, 50_000]), np.array([100, 40_000, 9])
    taken = mixing.fit(sizes, counts, 333_333)
    assert (taken <= counts).all() and (sizes * taken).sum() == 333_333


def test_few_very_long_documents_fit_to_the_word():
    for seed in range(5):
        assert mixing.fit(np.array([90_000, 61_000, 59_000]), np.ones(3, int), 120_000, seed).tolist() == [0, 1, 1]
    assert mixing.fit(np.array([50_000, 40_000, 20_000]), np.array([1, 2, 1]), 80_000).tolist() == [0, 2, 0]
    # The even share, one of each, would leave 10,000 words that nothing fits.
    assert mixing.fit(np.array([50_000, 40_000]), np.array([2, 2]), 100_000).tolist() == [2, 0]
    assert mixing.fit(np.array([50_000, 0]), np.array([2, 3]), 200_000).tolist() == [2, 3]


def test_the_seed_draws_among_lengths_of_one_document():
    sizes = np.arange(1_000, 41_000, 10)
    counts, budget = np.ones(len(sizes), int), 20_000_003
    a, b = (mixing.fit(sizes, counts, budget, seed) for seed in (1, 2))
    assert budget - 10 < (sizes * a).sum() <= budget and budget - 10 < (sizes * b).sum() <= budget
    assert (a != b).sum() > 100 and (a == mixing.fit(sizes, counts, budget, 1)).all()
    share = budget / sizes.sum()
    assert all(abs(part.mean() - share) < 0.05 for part in np.split(a, 8))


def test_mixed_rows_repeat_and_repeated_ids_stay_rows(spark):
    texts = ["a b", "c d", "e f g h i j k l"] * 5
    docs = _docs(spark, texts, ["x", "x", "y"] * 5).withColumn("doc_id", F.col("doc_id") % 3)
    decided = mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies")).collect()
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    assert Counter(r.doc_id for r in rows.collect()) == {i: n for i, n in decided if n}
    assert mixing.mix(_docs(spark, [])).count() == 0


# classifier


def test_the_forest_separates_held_out_texts(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    good = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(5)) + "."
    bad = lambda: " ".join(word() + "%%%" for _ in range(40))
    texts = [good() if i % 4 else bad() for i in range(600)] + ODD
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, quality int")
    rows = quality_gbdt.classify(_docs(spark, texts), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in rows if 300 <= r.doc_id < 600) >= 297
    again = quality_gbdt.classify(_docs(spark, texts).repartition(5), labels).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_without_labels_or_rows_the_prior_scores(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_gbdt.classify(_docs(spark, ODD), none).collect()} == {0.5}
    assert quality_gbdt.classify(_docs(spark, []), none).count() == 0


def test_flat_trees_walk_like_nested_ones():
    x = np.random.default_rng(0).random((300, len(quality_gbdt.STATISTICS)))
    forest = quality_gbdt.grow(x, (x[:, 3] + x[:, 5] > 1).astype(float), trees=5, depth=3)
    for row, margin in zip(x[:40], forest.margins(x[:40])):
        total = forest.prior
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            total += leaf[k - len(f)]
        assert margin == pytest.approx(total)


# line rules


def _base(text):
    words = [w for w in (text or "").encode().split()]
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(inside),
    )


def test_counts_match_brute_force(spark):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(["a ", "b ", "é", "|", "\n", "c. ", " ", "$"]) for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = line_rules.quality_lines(_docs(spark, texts)).select("doc_id", "quality.*").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(texts[r.doc_id])
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_failing_lines_go_and_too_great_a_loss_rejects(spark):
    words = iter(range(100_000))
    line = lambda n, end: " ".join(f"w{next(words)}" for _ in range(n)) + end
    body = [line(20, ".") for _ in range(4)]
    menu, legal, cut = "home | news | about | contact", "All rights reserved.", line(9, "")
    mostly = "\n".join([*body[:2], *[line(12, "") for _ in range(4)]])
    texts = ["\n".join([menu, *body, legal, "Heading", cut]), "\n".join(body), mostly]
    first, clean, lost = line_rules.quality_lines(_docs(spark, texts)).orderBy("doc_id").select("quality.*").collect()
    assert first.kept and first.cleaned == "\n".join([*body, "Heading"])
    assert (first.cut_navigation, first.cut_boilerplate, first.cut_punctuation, first.lost_words) == (1, 1, 1, 19)
    assert clean.kept and clean.cleaned == texts[1] and clean.lost_words == 0
    assert not lost.base_failed and not lost.kept
    kept = line_rules.cleaned_documents(_docs(spark, texts).withColumn("n_chars", F.length("text").cast("bigint")))
    assert {r.doc_id: r.n_chars for r in kept.collect()} == {0: len(first.cleaned), 1: len(texts[1])}


# byte-level BPE


def test_ids_are_those_of_the_reference_encoder_and_decode_back(spark):
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    rng = random.Random(4)
    pieces = "a b s t re ' '' 1 2 é ll ve d m ! ? 漢 \0 <|endoftext|> 　   E 😀 's 'll 'S".split(" ") + [" ", "  ", "\n", "\t", "\r\n"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(2000)]
    rows = byte_bpe.encode(_docs(spark, texts), RANKS, read_back=True)
    rows = rows.withColumn("again", byte_bpe.decode(RANKS)("ids", "ends")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == encoding.encode_ordinary(text)
        assert bytes(r.decoded) == bytes(r.again) == text.encode()
        assert r.ends == np.cumsum([len(encoding.decode_single_token_bytes(i)) for i in r.ids]).tolist()


def test_blocks_of_the_scan_do_not_matter():
    functions = byte_bpe._scan_tables()[0][np.random.default_rng(0).integers(0, 9, 5000)]
    assert (byte_bpe._scan(functions, 64) == byte_bpe._scan(functions, 7)).all()


# context trees


def _kt(bits):
    zeros, ones, p = 0, 0, 1.0
    for bit in bits:
        p *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        zeros, ones = zeros + (not bit), ones + bit
    return p


def test_kt_blocks_and_mixing_match_the_definition():
    assert np.exp(ctw.block_probability(np.array([3.0]), np.array([2.0])))[0] == pytest.approx(_kt([0, 1, 0, 0, 1]))
    texts = [b"abracadabra", b"abab", b""]
    keys, counts = np.unique(ctw.grams(texts), return_counts=True)
    levels = [ctw.deepest(keys, counts)]
    for depth in range(ctw.DEPTH - 1, -1, -1):
        levels.append(levels[-1].parent(depth))
    levels = levels[::-1]

    def seen(context, node):  # zeros and ones below one context, from the texts alone
        tally = [0, 0]
        for text in texts:
            padded = b"\0" * ctw.DEPTH + text + b"\0"
            for i in range(ctw.DEPTH, len(padded)):
                symbol = padded[i] | 256
                for k in range(8):
                    if padded[i - len(context) : i] == context and symbol >> (8 - k) == node:
                        tally[(symbol >> (7 - k)) & 1] += 1
        return tally

    def weighted(context, node):
        zeros, ones = seen(context, node)
        if zeros + ones == 0:
            return 1.0
        own = _kt([0] * zeros + [1] * ones)
        if len(context) == ctw.DEPTH:
            return own
        return 0.5 * own + 0.5 * np.prod([weighted(bytes([b]) + context, node) for b in set(b"\0abcdr")])

    root = levels[0]
    for node in (1, 0b10, 0b1011):
        at = int(np.searchsorted(root.keys, node))
        assert np.exp(root.weighted[at]) == pytest.approx(weighted(b"", node))


def test_base_scores_match_brute_force_and_probabilities_sum_to_one(spark):
    texts = ODD + ["The cat sat. THE cat", "the dog", "unseen words only", "the cat"] * 3
    trains = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    condition = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    rows = ctw.score_texts(_docs(spark, texts), condition).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(t or "").translate(lower).encode().split() + [None] for t in texts]
    counts = Counter(w for own, t in zip(tokens, trains) if t for w in own)
    total = sum(counts.values())
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own))
        assert r.held_out is not trains[r.doc_id] and r.score < 0
    probe = [bytes([97, b]) for b in range(256)]
    level = ctw.deepest(*np.unique(ctw.grams([b"abac" * 9]), return_counts=True))
    p = np.ones(256)
    for node, bits in ctw._decisions(np.arange(256)):
        q = level.mix(np.zeros(256, np.int64) + 97, node, bits, None)
        p *= q
    assert p.sum() == pytest.approx(1.0) and len(probe) == 256


def test_scores_match_trees_of_one_piece_and_see_six_bytes_back(spark):
    texts = ["pabcdex qabcdey " * 20, "Pabcdex", "é😀 漢字 mixed, 12345", None, "", "qabcdey rabcdez " * 9, "pabcdey"]
    data, trains = [ctw._bytes(t) for t in texts], [i not in (1, 6) for i in range(len(texts))]
    rows = {r.doc_id: r for r in ctw.score_texts(_docs(spark, texts), ~F.col("doc_id").isin(1, 6)).collect()}
    grams = [ctw.grams([t]) for t in data]
    keys = np.unique(np.concatenate(grams))
    seen = Counter(k for g, t in zip(grams, trains) if t for k in g.tolist())
    levels = [ctw.deepest(keys, np.array([seen[k] for k in keys.tolist()]))]
    for depth in range(ctw.DEPTH - 1, -1, -1):
        levels.append(levels[-1].parent(depth))
    for i, own in enumerate(grams):
        expected = 0.0
        for node, bits in ctw._decisions(own & 255):
            p = None
            for depth, level in zip(range(ctw.DEPTH, -1, -1), levels):
                p = level.mix((own >> 8) & ((1 << (8 * depth)) - 1), node, bits, p)
            expected += np.log10(p).sum()
        assert rows[i].score == pytest.approx(expected, rel=1e-9)
    assert rows[1].score > rows[6].score + 1  # only the sixth byte back tells x from y


def test_no_texts_and_no_training_texts(spark):
    assert ctw.score_texts(_docs(spark, []), F.lit(True)).count() == 0
    (row,) = ctw.score_texts(_docs(spark, ["ab"]), F.lit(False)).collect()
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0)
    assert row.score == pytest.approx(-24 * np.log10(2))


# Jaccard join


def _components(texts, percent=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(t or "").translate(lower).encode().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = list(ODD) + ["One TWO", "one two", "a b c d e", "A B c d e"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 12, 40, 120]))]
        for _ in range(rng.choice([1, 2, 8, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.2:
                at = rng.randrange(len(copy))
                copy[at:at] = passage
            texts.append(" ".join(copy))
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 8)
    monkeypatch.setattr(jaccard_join, "COST", [1, 4, 1024][seed])
    found = jaccard_join.jaccard_components(_docs(spark, texts).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(texts)
    monkeypatch.setattr(jaccard_join, "BITS", 64)  # more wanted sets than the bitmap can tell: texts move instead
    moved = jaccard_join.jaccard_components(_docs(spark, texts).repartition(3)).collect()
    assert sorted(map(tuple, moved)) == sorted(map(tuple, found))


def test_a_chain_of_links_is_one_component_and_a_large_group_is_settled(spark):
    chain = [" ".join(f"c{i}" for i in range(k * 3, k * 3 + 60)) for k in range(30)]
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    near = [" ".join(w if rng.random() > 0.012 else f"n{rng.randrange(10**6)}" for w in base) for _ in range(300)]
    texts = chain + near
    found = jaccard_join.jaccard_components(_docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(texts)


def test_missing_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "x y"), (None, None), (4, "q r"), (4, "q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=str)
    assert found == sorted([(None, 2, 3), (3, 2, 3), (3, 1, 3), (None, 0, None), (4, 1, 4), (4, 1, 4)], key=str)
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0
    kept = jaccard_join.one_of_each(docs).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == {(3, "a b c d e f"): 1, (3, "x y"): 1, (4, "q r"): 1, (None, None): 1}


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_no_component_is_lost_where_ids_repeat(spark, parts):
    words = [f"w{i}" for i in range(80)]
    near = " ".join(["new", *words[1:]])
    rows = [(3, " ".join(words)), (7, near), (3, "another text of six words here"), (None, near), (None, "of nobody at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[4]], key=str)


@pytest.mark.parametrize("large", [4, 1 << 13])
def test_sketches_bound_the_shared_tokens(monkeypatch, large):
    monkeypatch.setattr(jaccard_join, "LARGE", large)
    rng = np.random.default_rng(large)
    for n, m, both in ((1, 1, 0), (3, 9, 2), (500, 600, 450), (40, 40, 40)):
        tokens = rng.integers(-(1 << 62), 1 << 62, n + m - both)
        x, y = np.sort(tokens[:n]), np.sort(tokens[n - both :])
        found = jaccard_join._shared_at_most(jaccard_join.sketch(x), n, jaccard_join.sketch(y), m)
        assert both <= found <= min(n, m) and found <= both + 10


def test_shingles_are_distinct_windows_in_any_chunking():
    texts = [t for t in ODD if t] + ["a b a b a b a b", "A  b\tA\nb a b a b"]
    one = [s.tolist() for s in jaccard_join.shingle_sets(texts)]
    assert one == [next(jaccard_join.shingle_sets([t])).tolist() for t in texts]
    assert one[-1] == one[-2] and len(one[-1]) == 2


# pipeline


def test_the_stages_keep_what_their_operators_keep(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    good = lambda: ".\n".join(" ".join(word() for _ in range(15)).capitalize() for _ in range(6)) + "."
    texts = [good() if i % 5 else " ".join(word() + "%%%" for _ in range(80)) for i in range(200)]
    texts += [texts[1], texts[2] + " tail.", None, "", "short text."]
    rows = [(i, t, "en", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(i, int(i % 5 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")

    current, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, current, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        path = f"{tmp_path}/{len(seen)}"
        out.write.parquet(path)
        current = spark.read.parquet(path)
        seen.append({r.doc_id for r in current.collect()})
    clean = {i for i in range(200) if i % 5}
    assert clean <= seen[0] and not seen[0] & {i for i in range(200) if i % 5 == 0}
    assert clean <= seen[1] and not seen[1] & {202, 203, 204}
    assert seen[2] == clean
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    mixed = spark.read.parquet(f"{tmp_path}/3")
    decided = {r.doc_id: r.copies for r in mixing.mix(spark.read.parquet(f"{tmp_path}/2")).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == {i: n for i, n in decided.items() if n}
    assert all(r.ids == encoding.encode_ordinary(texts[r.doc_id]) for r in current.collect())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in current.collect())


def test_an_empty_corpus_passes_all_stages(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(
        pd.DataFrame({"doc_id": []}).astype("int64"), "doc_id long"
    ).selectExpr(
        "doc_id", "'' text", "'' lang", "'' source", "0L n_chars"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
