"""Line-first quality rules: clean a text line by line, then reject it if too much of it went."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import words_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SLICE = 256  # rows that are judged and rewritten at once

RESULT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,cut_navigation:bigint,cut_boilerplate:bigint,cut_punctuation:bigint,lost_words:bigint,"
    "kept:boolean,cleaned:string>"
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds. A line without a word is never judged.

    Navigation: at least ``separators`` separator characters, and at least one for ``words_per_separator`` words.
    Boilerplate: a phrase of ``phrases`` in the lower-cased line, or more than ``cluttered`` of the words holding a
    symbol or standing in capitals with an exclamation mark. Punctuation: the last character is no sentence end; a
    line of fewer than ``short_line`` words passes without one, as headings do.
    """

    separators: int = 3
    words_per_separator: float = 4.0
    separator_characters: str = "|»›•·>"
    phrases: tuple[str, ...] = (
        "all rights reserved",
        "privacy policy",
        "cookie policy",
        "terms of use",
        "terms of service",
        "enable javascript",
        "lorem ipsum",
        "click here to",
        "subscribe to our",
    )
    cluttered: float = 0.5
    sentence_ends: str = ".!?…:;\"'”’»)]。！？"
    short_line: int = 4
    most_lost: float = 0.3  # share of the words that may go
    least_words: int = 50
    most_repeated: int = 50  # per cent of the words inside repeated 3-word windows


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three words that the text holds at least twice."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)[1:]
    again = counts[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def _failure(line: str, words: list[str], rules: LineRules) -> str | None:
    """The rule that removes a line, if any."""
    bars = sum(line.count(c) for c in rules.separator_characters)
    if bars >= rules.separators and bars * rules.words_per_separator >= len(words):
        return "navigation"
    low = line.lower()
    if any(phrase in low for phrase in rules.phrases):
        return "boilerplate"
    if any(c in line for c in SYMBOLS) or "!" in line:
        cluttered = sum(any(c in w for c in SYMBOLS) or ("!" in w and w.isupper()) for w in words)
        if len(words) >= rules.short_line and cluttered > rules.cluttered * len(words):
            return "boilerplate"
    if len(words) >= rules.short_line and line.rstrip(SPACES)[-1] not in rules.sentence_ends:
        return "punctuation"
    return None


def judge(text: str | None, rules: LineRules) -> tuple:
    words = words_of(text)
    if not words:
        return 0, 0, sum((text or "").count(c) for c in SYMBOLS), 0, 0, True, 0, 0, 0, 0, False, text
    n = len(words)
    lines = text.split("\n")
    spoken = [line for line in lines if line.strip(SPACES)]
    repeats = repeated_words(words)
    cut = {"navigation": 0, "boilerplate": 0, "punctuation": 0}
    left, lost = [], 0
    for line in lines:
        own = line.split(" ") if line.isascii() and not any(c in line for c in SPACES[1:]) else None
        own = [w for w in own if w] if own is not None else [w.decode() for w in line.encode().split()]
        why = _failure(line, own, rules) if own else None
        if why:
            cut[why] += 1
            lost += len(own)
        else:
            left.append(line)
    failed = n < rules.least_words or 100 * repeats > rules.most_repeated * n
    return (
        n,
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(spoken) - len(set(spoken)),
        repeats,
        failed,
        *cut.values(),
        lost,
        not failed and lost <= rules.most_lost * n,
        "\n".join(left) if lost else text,
    )


def line_rules(rules: LineRules = LineRules(), with_text: bool = True):
    """A column function from a text to ``RESULT``.

    Counts describe the whole text as it came: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and
    ``n_repeat_words``; ``base_failed`` says that there are too few words or too many repeated ones. ``cut_*`` count
    the lines each rule removed, ``lost_words`` their words. ``kept`` is false if the base failed or more than
    ``most_lost`` of the words went. ``cleaned`` is the text without the removed lines (null unless ``with_text``).
    A null or empty text, or one without words, has no words, fails the base and is not kept; ``cleaned`` is then the
    text as given. Texts are judged one by one: order, repeated rows and other columns have no influence.
    """

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [field.split(":")[0] for field in RESULT[7:-1].split(",")]
        for texts in batches:
            out = pd.DataFrame([judge(t, rules) for t in texts], columns=names)
            if not with_text:
                out["cleaned"] = None
            yield out

    return run


def quality_lines(docs: DataFrame, text_column: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the column ``quality`` of type ``RESULT`` added; a column of that name is replaced."""
    return docs.withColumn("quality", line_rules(rules)(F.col(text_column)))


def cleaned_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept rows of ``docs`` with their cleaned texts and their lengths; other columns as they were.

    One pass judges a text, drops it or rewrites it, some ``SLICE`` rows at a time. Null, empty and wordless texts are
    not kept. ``docs`` has text and perhaps n_chars; names of other columns are free.
    """
    text = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    verdict = [field.split(":")[0] for field in RESULT[7:-1].split(",")].index("kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                judged = [judge(t.as_py(), rules) for t in part.column(text)]
                kept = pa.array([row[verdict] for row in judged], pa.bool_())
                cleaned = [row[-1] for row in judged if row[verdict]]
                columns = part.filter(kept).columns
                columns[text] = pa.array(cleaned, part.schema.field(text).type)
                if length is not None:
                    columns[length] = pa.array([len(t) for t in cleaned], part.schema.field(length).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
