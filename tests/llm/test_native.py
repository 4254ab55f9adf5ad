"""URL verdicts, chat formatting and the licence scan on small frames."""

import hashlib

from pyspark.sql import functions as F

from estrato.llm import chat, licenses, urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def _judge(spark, rows, rules=RULES, schema="page_id long, url string"):
    found = urls.judge_urls(spark.createDataFrame(rows, schema), spark.createDataFrame(rules, "host string, path string, verdict string"))
    return sorted(map(tuple, found.collect()), key=str)


def test_the_longest_rule_wins(spark):
    rows = [
        (1, "http://WWW.Example.com/en/a?b#c"), (2, "https://m.example.com/en/"), (3, "http://example.com/fr/"),
        (4, "http://x.net/es/1"), (5, "http://x.net/fr/1"), (6, "http://notexample.com/en/"), (7, "http://com"),
    ]
    assert [(r[0], r[3], r[4]) for r in _judge(spark, rows)] == [
        (1, "www.example.com/en/", "allow"), (2, "example.com/en/", "block"), (3, "com/", "allow"),
        (4, "net/es/", "block"), (5, None, "allow"), (6, "com/", "allow"), (7, None, "allow"),
    ]


def test_odd_urls_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "a://b://c/d"), (None, "http://a.com/"), (4, "a://b://c/d")]
    assert _judge(spark, rows) == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "b:", "//c/d", None, "allow"), (4, "b:", "//c/d", None, "allow"), (None, "a.com", "/", "com/", "allow"),
    ]


def test_deep_urls_partial_paths_and_no_rules(spark):
    deep = "http://" + "a." * 60 + "com/" + "x/" * 500 + "y"
    assert _judge(spark, [(1, deep)])[0][3] == "com/"
    rules = [("com", "/ab", "block"), ("com", "/a", "allow")]
    assert [r[3] for r in _judge(spark, [(1, "http://x.com/abc"), (2, "http://x.com/ac")], rules)] == ["com/ab", "com/a"]
    assert [r[3:] for r in _judge(spark, [(1, deep)], [])] == [(None, "allow")]
    assert _judge(spark, []) == []


def test_other_columns_of_pages_do_not_matter(spark):
    found = _judge(spark, [(1, "http://x.net/es/", "h", "r", "v", "i")], schema="page_id long, url string, host string, rule string, verdict string, id string")
    assert found == [(1, "x.net", "/es/", "net/es/", "block")]


def _chat(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_chats(frame.withColumn("parts", chat.text_part(F.col("text"))))


def test_texts_come_back_whatever_they_hold(spark):
    texts = ["</turn>\n<turn>assistant\nx", "\\l \\s \\\\ <", "", None, "é😀\n\n", "<image 0>"]
    rows = [(1, i, "assistant" if i % 2 else "us<er\n", t) for i, t in enumerate(texts)]
    row = _chat(spark, rows).select(
        chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("trained")
    ).first()
    assert [(t.role, t.text) for t in row.turns] == [(r, t or "") for _, _, r, t in rows]
    assert row.trained == "".join(t or "" for t in texts[1::2])


def test_turn_order_ties_and_missing_values(spark):
    rows = [(1, 2, "user", "c"), (1, None, None, "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (None, 0, "user", "z")]
    found = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in _chat(spark, rows).withColumn("turns", chat.turns_of(F.col("formatted"))).collect()}
    assert found == {1: [("", "a"), ("user", "b"), ("user", "b"), ("user", "c")], None: [("user", "z")]}
    assert _chat(spark, []).count() == 0


def test_typed_parts_become_numbered_placeholders(spark):
    part = "named_struct('type', {}, 'text', {}, 'ref', {}, 'width', {}, 'height', {}, 'seconds', CAST({} AS double), 'pages', {})"
    text = part.format("'text'", "'see <'", "CAST(NULL AS string)", *["CAST(NULL AS int)"] * 2, "NULL", "CAST(NULL AS int)")
    image = part.format("'image'", "CAST(NULL AS string)", "'a.png'", 57, 28, "NULL", "CAST(NULL AS int)")
    audio = part.format("'audio'", "CAST(NULL AS string)", "'b.wav'", "CAST(NULL AS int)", "CAST(NULL AS int)", "1.5", "CAST(NULL AS int)")
    pages = part.format("'document'", "CAST(NULL AS string)", "'c.pdf'", "CAST(NULL AS int)", "CAST(NULL AS int)", "NULL", 2)
    odd = part.format("CAST(NULL AS string)", "CAST(NULL AS string)", "'d'", "CAST(NULL AS int)", "CAST(NULL AS int)", "NULL", "CAST(NULL AS int)")
    frame = spark.sql(
        f"SELECT 1L conv_id, 0L turn, 'user' role, array({text}, {image}, {audio}) parts "
        f"UNION ALL SELECT 1L, 1L, 'assistant', array({pages}, {odd}, {text}) UNION ALL SELECT 1L, 2L, 'user', NULL"
    )
    row = chat.format_chats(frame).first()
    assert row.formatted == (
        "<turn>user\nsee \\l<image 0><audio 1></turn>\n<turn>assistant\n<document 2><other 3>see \\l</turn>\n<turn>user\n</turn>\n"
    )
    assert [(a.number, a.turn, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 1, "image", "a.png", 3), (1, 1, "audio", "b.wav", 38), (2, 2, "document", "c.pdf", 1024), (3, 2, "other", "d", 0),
    ]
    assert row.attachment_tokens == 1065
    (span,) = row.loss
    assert row.formatted[span.start : span.start + span.length] == "<document 2><other 3>see \\l"


def test_digests_are_those_of_the_texts(spark):
    row = _chat(spark, [(1, 0, "user", "é")]).select(F.sha2(F.col("formatted").cast("binary"), 256).alias("h")).first()
    assert row.h == hashlib.sha256("<turn>user\né</turn>\n".encode()).hexdigest()


def _scan(spark, rows, templates, least=0.8):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(templates, "template string, text string")
    return {r.doc_id: (r.n_bigrams, r.template, r.dice) for r in licenses.scan_licenses(docs, known, least=least).collect()}


def _dice(a, b):
    pairs = lambda t: {(x, y) for x, y in zip(t.split(), t.split()[1:])}
    return 2 * len(pairs(a) & pairs(b)) / (len(pairs(a)) + len(pairs(b)))


def test_licences_are_found_through_case_punctuation_and_copyright_lines(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [
        (1, "Copyright (c) 2024 Someone\n\n" + mit.upper().replace(",", " ,")), (2, "nothing of the kind here"),
        (3, None), (4, ""), (5, "word"), (6, mit + " " + "filler words " * 400 + "a b c d e f g h " * 3), (1000, mit),
    ]
    found = _scan(spark, rows, list(licenses.TEMPLATES.items()))
    assert found[1][1:] == ("MIT", 1.0) and found[1000][1:] == ("MIT", 1.0)
    assert [found[i][1] for i in (2, 3, 4, 5)] == [None] * 4 and [found[i][0] for i in (3, 4, 5)] == [0, 0, 0]


def test_common_licences_are_known_by_their_own_names(spark):
    names = ["0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC"]
    names += ["LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]
    texts = ["Copyright (c) 2020 Some One\n" + licenses.TEMPLATES[n] for n in names]
    found = _scan(spark, list(enumerate(texts)), list(licenses.TEMPLATES.items()))
    assert [found[i][1:] for i in range(len(names))] == [(n, 1.0) for n in names]
    regents = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
""" + licenses.TEMPLATES["BSD-2-Clause"].split("distribution. ")[-1].replace("COPYRIGHT HOLDERS", "REGENTS")
    assert _scan(spark, [(1, regents)], list(licenses.TEMPLATES.items()))[1][1] == "BSD-3-Clause"


def test_dice_agrees_with_brute_force_at_every_size(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 20 + i] + [f"x{i}"] * (i % 3))) for i in range(40)]
    templates = [("t40", " ".join(base[:40])), ("t60", " ".join(base)), ("same", " ".join(base[:40])), ("none", "one")]
    found = _scan(spark, rows, templates, least=0.7)
    for i, text in rows:
        best = max(((_dice(text, t), [-ord(c) for c in n], n) for n, t in templates[:3]), default=None)
        assert found[i][1:] == ((best[2], best[0]) if best[0] >= 0.7 else (None, None))
    assert _scan(spark, rows[:2], [("none", "one")]) == {0: (19, None, None), 1: (21, None, None)}


def test_the_licence_scan_reads_each_text_once_and_builds_its_bigrams_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, licenses.TEMPLATES["MIT"] if i % 2 else f"some text number {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, body string")
    known = spark.createDataFrame(list(licenses.TEMPLATES.items()), "template string, text string")
    found = licenses.scan_licenses(docs.mapInArrow(counted, docs.schema), known, text_column="body").collect()
    assert sorted(r.doc_id for r in found if r.template == "MIT") == list(range(1, 40, 2)) and len(found) == 40
    assert seen.value == 40

    plan = licenses.scan_licenses(docs, known, text_column="body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce(body#") == 1  # no filter below repeats the work


def test_repeated_rows_are_reported_each_with_the_dice_of_one(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(1, mit)] * 3 + [(1, mit + " and more")] + [(None, mit)] * 2 + [(2, "some other text")] * 2 + [(3, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([("MIT", mit), ("none", "one")], "template string, text string")
    found = sorted(((r.doc_id, r.template, r.dice) for r in licenses.scan_licenses(docs, known).collect()), key=str)
    assert [f[:2] for f in found] == [(1, "MIT")] * 4 + [(2, None)] * 2 + [(3, None)] * 2 + [(None, "MIT")] * 2
    assert [f[2] for f in found if f[1]].count(1.0) == 5 and 0.97 < min(f[2] for f in found if f[1]) < 1
