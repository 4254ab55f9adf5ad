"""Licence scan: normalised texts against templates by the Dice coefficient of their word bigrams.

Texts are lowered, lose lines that state a copyright, and keep only letters and digits. Sets of bigrams can only reach
a Dice threshold if their sizes are close: sizes fall into geometric buckets, and a text meets only templates of its
own and the neighbouring buckets. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.license_texts import TEXTS

# Texts of well-known licences, without their copyright lines.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
} | TEXTS

COPYRIGHT_LINE = r"(?i)(^|\n)[ \t]*(copyright|\(c\))[^\n]*"
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits with one blank between them; a null is empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "\n")
    return F.trim(F.regexp_replace(F.lower(plain), NOT_A_WORD, " "))


def bigrams(words: Column) -> Column:
    """Hashes of the distinct pairs of neighbours in a column of words.

    The column must be one of the frame: an expression in its place would be evaluated anew for each use.
    """
    last = F.size(words) - 1
    heads, tails = F.slice(words, F.lit(1), last), F.slice(words, F.lit(2), last)
    return F.array_distinct(F.zip_with(heads, tails, lambda a, b: F.xxhash64(a, b)))


def with_pairs(rows: DataFrame, text: str, *others: Column) -> DataFrame:
    """``others``, two hashes ``k1`` and ``k2`` of the normalised text, and its ``pairs``."""
    rows = rows.select(*others, normalised(F.col(text)).alias("plain"))
    kept = [c for c in rows.columns if c != "plain"]
    keys = [F.xxhash64("plain").alias("k1"), F.crc32("plain").alias("k2")]
    rows = rows.select(*kept, *keys, F.split("plain", " ").alias("words"))
    return rows.select(*kept, "k1", "k2", bigrams(F.col("words")).alias("pairs"))


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = 0.8,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_bigrams``, the best ``template`` and its ``dice``; null where none reaches ``least``.

    ``templates`` has ``template`` and ``text``. Dice is twice the shared bigrams over the sum of both sizes, on
    distinct bigrams; ties go to the template that is first by name. Null or empty texts, and texts of one word, have
    no bigrams and no template; templates without bigrams are never found. Repeated rows are reported each; other
    columns are not read; no rows give no rows, and without templates every row has none.

    A document's bigrams take part only if some template lies in reach of its size. They meet the templates' in an
    equi-join on size bucket and bigram and are counted where they meet; the count of repeated rows together, those of
    one input task at most, is divided by their number. Each row sends one null bigram along, which meets nothing and
    stands for the row, so texts are read once and no list of bigrams is written or moved. ``explode_outer`` and the
    outer joins matter: with inner ones the optimizer adds filters on the bigrams below them, and each filter builds
    the bigrams once more.
    """
    ratio = (2 - least) / least  # how many times larger a set may be and still reach ``least``
    bucket = lambda size: F.floor(F.ln(size) / F.lit(math.log(ratio) + 1e-9)).cast("int")
    met_by = F.xxhash64("bucket", "pair")
    known = (
        with_pairs(templates, "text", F.col("template"))
        .select("template", "pairs", F.size("pairs").alias("template_size"))
        .where("template_size > 0")
    )
    near = F.explode(F.sequence(bucket(F.col("template_size")) - 1, bucket(F.col("template_size")) + 1))
    known = known.withColumn("bucket", near)
    reach = known.select(F.col("bucket").alias("near")).distinct()
    known = known.withColumn("pair", F.explode("pairs")).select(met_by.alias("key"), "template", "template_size")

    rows = with_pairs(docs, text_column, F.col(id_column).alias("id"), F.spark_partition_id().alias("part"))
    rows = rows.withColumn("n_bigrams", F.size("pairs"))
    rows = rows.withColumn("bucket", bucket(F.greatest("n_bigrams", F.lit(1))))
    rows = rows.join(F.broadcast(reach), F.col("bucket") == F.col("near"), "left")
    asked = F.when(F.col("near").isNotNull(), F.col("pairs")).otherwise(F.array().cast("array<bigint>"))
    row = ["part", "id", "k1", "k2", "n_bigrams"]
    asked = rows.select(*row, "bucket", F.explode_outer(F.array_append(asked, F.lit(None).cast("bigint"))).alias("pair"))
    asked = asked.select(*row, "pair", F.when(F.col("pair").isNotNull(), met_by).alias("key"))

    met = (
        asked.join(known, "key", "left")
        .where("template_size is not null or pair is null")
        .groupBy(*row, "template", "template_size")
        .agg(F.count(F.lit(1)).alias("met"))
    )
    share = F.col("met") / (F.col("n_bigrams") + F.col("template_size"))
    order = F.when(F.col("template_size").isNotNull(), F.struct(-share, F.col("template")))
    best = met.groupBy(*row).agg(
        F.max(F.when(F.col("template_size").isNull(), F.col("met"))).cast("int").alias("copies"),
        F.min_by(F.struct("template", "template_size", "met"), order).alias("best"),
    )
    best = best.withColumn("dice", 2.0 * F.expr("best.met div copies") / (F.col("n_bigrams") + F.col("best.template_size")))
    reached = F.col("dice") >= least
    return best.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(
        F.col("id").alias(id_column),
        F.col("n_bigrams").cast("bigint").alias("n_bigrams"),
        F.when(reached, F.col("best.template")).alias("template"),
        F.when(reached, F.col("dice")).alias("dice"),
    )
