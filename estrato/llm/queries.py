"""The registered query of each operator and, where SQL can express it, its DuckDB statement."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import (
    ann_onebit,
    byte_bpe,
    chat,
    chat_repair,
    ctw,
    jaccard_join,
    licenses,
    line_rules,
    mixing,
    phrases,
    quality_gbdt,
    substring_dedup,
    urls,
)
from estrato.llm.common import read, remainder_of_id, values
from estrato.session import ship_package

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_onebit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_onebit.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences and, as further templates, the benchmark passages."""
    known = values(spark, ["template", "text"], list(licenses.TEMPLATES.items()))
    items = read(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("benchmark "), F.col("item_id").cast("string")).alias("template"), "text"
    )
    return licenses.scan_licenses(read(spark, sf_dir, "documents"), known.unionByName(items))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = values(spark, ["host", "path", "verdict"], URL_RULES)
    return urls.judge_urls(read(spark, sf_dir, "pages"), rules)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label rows that the classifier may learn from."""
    return read(spark, sf_dir, "labels").where(remainder_of_id("doc_id", 4) != 2).select("doc_id", "quality")


def op5_quality_gbdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_gbdt.classify(docs, training_labels(spark, sf_dir))
    return scored.select("doc_id", (remainder_of_id("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = docs.select("doc_id", line_rules.line_rules(with_text=False)("text").alias("quality"))
    return judged.select("doc_id", "quality.*").drop("cleaned")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), ranks, read_back=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(read(spark, sf_dir, "documents"), remainder_of_id("doc_id", 7) != 2)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = values(
        spark, rows.columns, [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    ).select([F.col(name).cast(kind) for name, kind in rows.dtypes])
    messages = rows.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    done = chat.format_chats(messages).withColumns(
        {"read": chat.turns_of(F.col("formatted")), "trained": chat.loss_text(F.col("formatted"), F.col("loss"))}
    )
    newline = F.lit("\n")
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], newline, t["text"], newline)), "")
    return done.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "attachment_tokens",
    )


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as damaged by the contract; those of which no row is left come back with zeros."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, places = chat_repair.repair(chat_repair.damage(rows))
    hashed = chat_repair.digests(chat_repair.repaired_rows(places, in_order=True))
    all_ids = rows.select("conv_id").distinct()
    for found in (report, hashed):
        own = found.withColumnRenamed("conv_id", "of")
        all_ids = all_ids.join(own, all_ids["conv_id"].eqNullSafe(own["of"]), "left").drop("of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_ids.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.without_repeats(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP6_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(15 + length(role) + length(text)
           + 2 * length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), chr(10), '')) - length(role)
           + length(text) - length(replace(replace(text, '\', ''), '<', '')))::BIGINT AS formatted_chars,
       0::BIGINT AS attachment_tokens
FROM said GROUP BY conv_id
"""


_PLAIN = """trim(regexp_replace(lower(regexp_replace(coalesce(text, ''),
    '(?i)(^|\\n)[ \\t]*(copyright|\\(c\\))[^\\n]*', chr(10), 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"""

OP2_SQL = f"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id::VARCHAR AS name, string_split({_PLAIN.format()}, ' ') AS w FROM documents
  UNION ALL SELECT 't', 'benchmark ' || item_id, string_split({_PLAIN.format()}, ' ') FROM benchmark
  UNION ALL SELECT 't', name, string_split({_PLAIN.format()}, ' ') FROM (VALUES {", ".join(
      "('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licenses.TEMPLATES.items()
  )}) v(name, text)),
sets AS (
  SELECT kind, name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM texts),
pairs AS (SELECT kind, name, len(pairs) AS size, unnest(pairs) AS pair FROM sets),
shared AS (
  SELECT d.name AS doc, t.name AS template, 2.0::DOUBLE * count(*) / (any_value(d.size) + any_value(t.size)) AS dice
  FROM pairs d JOIN pairs t USING (pair) WHERE d.kind = 'd' AND t.kind = 't' GROUP BY ALL),
best AS (
  SELECT * FROM shared WHERE dice >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc ORDER BY dice DESC, template) = 1)
SELECT name::BIGINT AS doc_id, len(pairs)::BIGINT AS n_bigrams, template, dice
FROM sets LEFT JOIN best ON doc = name WHERE kind = 'd'
"""


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')), '[^ \\t]+') AS w
  FROM documents),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, 6) s(size)),
grams AS (
  SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, count(*) AS f
  FROM places GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, size, f, phrase, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM grams)),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * c.f * n // (x.f::HUGEINT * y.f)) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = head JOIN grams y ON y.lang = c.lang AND y.phrase = rest
  JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
alone AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM grams g WHERE g.lang = s.lang AND g.phrase <> s.phrase AND g.size > 1 AND 100 * g.f >= 100 * s.a
      AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM alone QUALIFY rank <= 2000
"""


OP13_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS passage FROM places)
  QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS place FROM later, range(0, 20) r(d)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS left_over, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def _shipped(query):
    """``query`` once the workers can import this package."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    found = {
        "op1_onebit_ann": op1_onebit_ann,
        "op2_license_scan": op2_license_scan,
        "op3_source_mix": op3_source_mix,
        "op4_url_filter": op4_url_filter,
        "op5_quality_gbdt": op5_quality_gbdt,
        "op6_chat_format": op6_chat_format,
        "op7_line_rules": op7_line_rules,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_context_tree": op9_context_tree,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_chat_repair": op11_chat_repair,
        "op12_phrases": op12_phrases,
        "op13_substring_dedup": op13_substring_dedup,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": OP2_SQL,
        "op4_url_filter": OP4_SQL,
        "op6_chat_format": OP6_SQL,
        "op12_phrases": OP12_SQL,
        "op13_substring_dedup": OP13_SQL,
    }
