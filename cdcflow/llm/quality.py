"""Quality rules under weak supervision.

Each rule looks at one figure of a text and votes good, votes bad or abstains. Most figures have two rules, a strict and a
lenient one, so a plain defect gets several bad votes and a doubtful one a single vote. No labels are used: expectation
maximisation over the counts of vote patterns estimates the share of good documents and how often each rule that votes is
right on good and on bad ones, and a document is kept if its posterior probability of being good reaches ``KEEP``. So a
rule that often votes bad on documents which all others call good loses its say, and a bad vote alone does not condemn.

What the base rules reject is decided already and teaches nothing. The beliefs to begin with (``GOOD``, ``RIGHT``) count
as ``PSEUDO`` documents, so they decide on tables of a few documents only. ``fitted`` is the form for who knows the share
of good documents and wants to hold rules to a belief of any weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import documents, free_name, lean, small_batches, stored

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_upper", "n_lower", "n_shouts"]
SYMBOLS, UPPER, LOWER = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
ENDS = (b".", b"!", b"?", b":", b'"', b")", "”".encode(), "»".encode(), "…".encode(), "。".encode())
KEEP = 0.5
# The share of good documents and how often a rule is right on good and on bad ones, to begin with, and their weight.
GOOD, RIGHT, PSEUDO = 0.8, (0.9, 0.3), 10
ROUNDS = 500
LONE, SURE, BELIEF = 5, (0.995, 0.3), (1.0, 0.02)  # of ``fitted``: rules that know one defect, their RIGHT, its weights


def repeated_words(words: list) -> int:
    """Words in three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    met: dict = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        first = met.setdefault(window, i)
        if first < i:
            covered[first : first + 3] = covered[i : i + 3] = b"\1\1\1"
    return covered.count(1)


def measured(text: str | None) -> list[int]:
    """``COUNTS`` of one text; null is the empty text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        len(words),
        len(text) - len(raw) + sum(map(len, words)),
        sum(raw.count(s) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(line.rstrip().endswith(ENDS) for line in lines),
        len(raw) - len(raw.translate(None, UPPER)),
        len(raw) - len(raw.translate(None, LOWER)),
        raw.count(b"!"),
    ]


def with_counts(docs: DataFrame, name: str = "_counts") -> DataFrame:
    """``docs`` with ``COUNTS`` of ``text`` in the struct ``name``; all other columns pass unchanged."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*map(measured, batch.column(at).to_pylist()), strict=True)) or [()] * len(COUNTS)
            counts = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, name])

    at = docs.columns.index("text")
    empty = docs.sparkSession.createDataFrame([], f"c STRUCT<{', '.join(f'{c}: BIGINT' for c in COUNTS)}>")
    schema = StructType([*docs.schema.fields, StructField(name, empty.schema[0].dataType)])
    return small_batches(docs).mapInArrow(lean(task), schema)


def base_failed(counts: str) -> Column:
    n, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def votes(counts: str) -> dict[str, Column]:
    """Each rule's vote: 1 good, 0 bad, null abstains."""
    c = {name: F.col(f"{counts}.{name}") for name in COUNTS}
    n_words, n_lines = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["n_lines"], F.lit(1))
    letters = F.greatest(c["n_upper"] + c["n_lower"], F.lit(1))
    mean, ended = c["word_chars"] / n_words, c["n_ended"] / n_lines

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, 0).when(good, 1)

    def pair(name: str, share: Column, strict: tuple[float, float], lenient: tuple[float, float]) -> dict[str, Column]:
        """Two rules on the share of a defect: good up to the first bound, bad above the second."""
        bounds = {f"{name}_some": strict, f"{name}_many": lenient}
        return {k: rule(share <= fine, share > most) for k, (fine, most) in bounds.items()}

    return {
        "length": rule(c["n_words"] >= 100, c["n_words"] < 75),
        "word_length_wide": rule((mean >= 3.5) & (mean <= 7), (mean < 2.5) | (mean > 9)),
        "word_length_near": rule((mean >= 4) & (mean <= 6), (mean < 3.5) | (mean > 7)),
        "line_ends_half": rule(ended >= 0.5, ended < 0.1),
        "line_ends_most": rule(ended >= 0.9, ended < 0.7),
        **pair("symbols", c["n_symbols"] / n_words, (0.05, 0.1), (0.1, 0.3)),
        **pair("dup_lines", c["n_dup_lines"] / n_lines, (0.1, 0.15), (0.2, 0.4)),
        **pair("repeats", c["n_repeat_words"] / n_words, (0.1, 0.2), (0.2, 0.4)),
        **pair("capitals", c["n_upper"] / letters, (0.08, 0.15), (0.2, 0.4)),
        **pair("shouts", c["n_shouts"] / n_words, (0.02, 0.05), (0.05, 0.1)),
    }


Patterns = list[tuple[tuple[int | None, ...], int]]
Rights = list[tuple[float, float]]


def _em(patterns: Patterns, defects: int, begin: tuple[float, float], sure: tuple[float, float], good: float, weight: float | None):
    """The share of good documents (as given without a ``weight``) and each rule's accuracies."""
    rules = len(patterns[0][0]) if patterns else 0
    if not rules:
        return good, [begin] * rules
    vote = np.array([[-1 if v is None else v for v in p] for p, _ in patterns])
    n = np.array([k for _, k in patterns], float)
    judged = (vote >= 0) | (np.arange(rules) >= rules - defects)
    fine = judged & (vote != 0)
    right, share = np.tile(begin, (rules, 1)), good
    for _ in range(ROUNDS):
        start, adds = weights(right.tolist(), share)
        on_good, on_bad = np.array(adds).T
        odds = start + (vote == 1) @ on_good + (vote == 0) @ on_bad
        g = n / (1 + np.exp(-np.clip(odds, -700, 700)))
        new = np.stack(
            [
                (sure[0] * begin[0] + g @ fine) / (sure[0] + g @ judged),
                (sure[1] * begin[1] + (n - g) @ (judged & ~fine)) / (sure[1] + (n - g) @ judged),
            ],
            axis=1,
        )
        moved, right = float(np.abs(new - right).max()), new
        if weight is not None:
            share = (weight * good + float(g.sum())) / (weight + float(n.sum()))
        if moved < 1e-9:
            break
    return share, [(a, b) for a, b in right.tolist()]


def estimated(patterns: Patterns) -> tuple[float, Rights]:
    """EM over vote patterns and how many documents show each: the share of good documents, and for each rule how often
    it is right on a good and on a bad document where it votes."""
    return _em(patterns, 0, RIGHT, (PSEUDO, PSEUDO), GOOD, PSEUDO)


def fitted(patterns: Patterns, defects: int = LONE, good: float = GOOD, belief: tuple[float, float] = BELIEF) -> Rights:
    """The accuracies for a share of good documents that is given. The last ``defects`` rules are right on a good document
    when they abstain; the others are judged where they vote. ``belief`` is the weight of ``SURE`` as a share of all."""
    total = sum(n for _, n in patterns)
    return _em(patterns, defects, SURE, tuple(max(1, total * b) for b in belief), good, None)[1]


def weights(right: list[tuple[float, float]], good: float = GOOD) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good before any vote, and what a good or a bad vote of each rule adds."""
    return math.log(good / (1 - good)), [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]


def posterior(pattern: tuple[int | None, ...], right: list[tuple[float, float]], good: float = GOOD) -> float:
    start, adds = weights(right, good)
    odds = start + sum(0 if v is None else add[not v] for v, add in zip(pattern, adds, strict=True))
    return 1 / (1 + math.exp(-max(-700, min(700, odds))))


def fit(counted: DataFrame, name: str = "_counts") -> Column:
    """The posterior probability of good, as an expression over the struct ``name``.

    All documents that pass the base rules count. Only the counts of vote patterns come to the driver: bounds cut a figure
    into five ranges at most, so there are 3 * 5^7 patterns at most, whatever the number of documents.
    """
    cast = votes(name)
    rows = counted.filter(~base_failed(name)).groupBy(*(v.alias(k) for k, v in cast.items())).count().collect()
    share, right = estimated(sorted(((tuple(r[:-1]), r[-1]) for r in rows), key=repr))
    start, adds = weights(right or [RIGHT] * len(cast), share)
    odds = F.lit(start)
    for vote, (on_good, on_bad) in zip(cast.values(), adds, strict=True):
        odds = odds + F.when(vote == 1, on_good).when(vote == 0, on_bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def op7_quality_rules(spark, sf_dir):
    counted = stored(with_counts(documents(spark, sf_dir).select("doc_id", "text")).drop("text"), "counts")
    good = fit(counted)
    failed = base_failed("_counts")
    return counted.select(
        "doc_id", *(f"_counts.{c}" for c in COUNTS[:5]), failed.alias("base_failed"),
        (~failed & (good >= KEEP)).alias("kept"), good.alias("p_good"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass the base rules and reach ``KEEP``, with their own columns.

    Null and empty texts have no words and fail. Rows that repeat are judged alike. An empty table stays empty.
    """
    name = free_name(docs, "_counts")
    good = fit(with_counts(docs.select("text"), name), name)
    return with_counts(docs, name).filter(~base_failed(name) & (good >= KEEP)).select(*docs.columns)
