"""Quality rules: how much of a text stands inside repeated word n-grams and repeated lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.text import Texts, Words, by_text, covered, lines, repeats, slices

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class RepetitionRules:
    """Base rules, and the largest part of a text's word characters that may be repetition.

    A word counts as repeated at length ``n`` if it lies in an n-word window equal to an
    earlier window of the same text; a line, if it has a word and equals an earlier line.
    """

    min_words: int = 50
    max_repeat_words_pct: int = 50
    base_gram: int = 3
    gram_limits: tuple[tuple[int, float], ...] = field(default=((5, 0.35), (8, 0.30), (12, 0.25)))
    line_limit: float = 0.35


_COLUMNS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("dup_line_chars", pa.int64()),
]


def _measure(texts: Texts, rules: RepetitionRules) -> dict[str, np.ndarray]:
    words = Words(texts)
    chars = words.chars()
    out = {"n_words": words.counts.astype(np.int64), "word_chars": by_text(chars, words.first)}
    out["n_symbols"] = texts.count(_SYMBOLS[texts.bytes])
    begins, ends, doc = lines(texts)
    total_chars = np.append(0, np.cumsum(chars))
    low, high = np.searchsorted(words.starts, begins), np.searchsorted(words.starts, ends)
    full = high > low
    begins, ends, doc, low, high = begins[full], ends[full], doc[full], low[full], high[full]
    _, later = repeats(texts.spans_hash(begins, ends), doc)
    out["n_dup_lines"] = np.bincount(doc[later], minlength=texts.rows)
    line_chars = (total_chars[high] - total_chars[low])[later]
    out["dup_line_chars"] = np.bincount(doc[later], weights=line_chars, minlength=texts.rows).astype(np.int64)
    at, key = words.grams(rules.base_gram)
    again, _ = repeats(key, words.doc[at])
    out["n_repeat_words"] = by_text(covered(len(words), at[again], rules.base_gram), words.first)
    for n, _ in rules.gram_limits:
        at, key = words.grams(n)
        _, later = repeats(key, words.doc[at])
        out[f"dup_{n}gram_chars"] = by_text(chars * covered(len(words), at[later], n), words.first)
    return out


def repetition(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept`` in front of its columns' end.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, one
    dup_<n>gram_chars per length, base_failed and kept; columns of ``docs`` with one of these names
    are replaced. All other columns, the text included, pass through. A null or empty text has
    no words, so it fails the base rules; texts of any length are measured whole; repeated
    rows are measured each by itself; an empty table gives an empty table. One pass over the
    rows: nothing is shuffled, and memory holds about 2 MB of text at a time or the longest text.
    """
    added = [*_COLUMNS, *((f"dup_{n}gram_chars", pa.int64()) for n, _ in rules.gram_limits)]
    names = {name for name, _ in added} | {"base_failed", "kept"}
    if text in names:
        raise ValueError(f"{text} is the name of a result")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            found = _measure(Texts(part.column(text)), rules)
            columns = [*part.columns, *(pa.array(found[n].astype(np.int64), t) for n, t in added)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *(n for n, _ in added)])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.LongType()) for name, _ in added)])
    out = docs.mapInArrow(run, schema)
    size = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    too_much = F.col("dup_line_chars") / size > rules.line_limit
    for n, limit in rules.gram_limits:
        too_much = too_much | (F.col(f"dup_{n}gram_chars") / size > limit)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_words_pct * F.col("n_words")
    )
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~too_much)
