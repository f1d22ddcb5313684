"""Quality rules and language identification."""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from cdcflow.llm import language, quality
from cdcflow.llm.common import documents

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(map(text.count, "#*$%&|<>")), dup, len(covered), failed)


def judged(rows):
    return {(r.doc_id, *(getattr(r, c) for c in quality.COUNTS[:5]), r.base_failed) for r in rows}


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r for r in documents(spark, SF_DIR).collect()}


def test_base_figures_and_verdict(spark, table):
    rows = quality.op7_quality_rules(spark, SF_DIR).collect()
    assert judged(rows) == {(i, *base(r.text)) for i, r in table.items()}
    labels = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()))
    told = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert all(kept for good, kept in told if good)


def test_junk_goes_and_clean_stays(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = quality.op7_quality_rules(spark, sf_dir).collect()
    labels = dict(map(tuple, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()))
    told = Counter((labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed)
    assert told[1, True] >= 0.995 * (told[1, True] + told[1, False])
    assert told[0, False] >= 0.9 * (told[0, True] + told[0, False])


def test_odd_rows_and_no_rows(docs):
    counted = quality.with_counts(docs(odd_rows()), "_c").select("doc_id", "_c.*").collect()
    got = Counter((r.doc_id, *(getattr(r, c) for c in quality.COUNTS[:5])) for r in counted)
    assert got == Counter((i, *base(t)[:5]) for i, t in odd_rows())
    kept = quality.keep_good(docs(odd_rows()))
    assert kept.columns == docs([]).columns
    assert not {2, 3, 4, 8, 10} & {r.doc_id for r in kept.collect()}
    assert quality.keep_good(docs([])).collect() == []


def test_em_finds_accuracies():
    rng, patterns = random.Random(2), Counter()
    right = [0.95, 0.9, 0.8, 0.7, 0.85]
    for _ in range(20_000):
        good = rng.random() < 0.7
        patterns[tuple(None if rng.random() < 0.2 else int(good == (rng.random() < a)) for a in right)] += 1
    found = quality.fitted(sorted(patterns.items(), key=repr), 0, 0.7, (0.0, 0.0))
    assert all(abs(a - x) < 0.04 for a, pair in zip(right, found, strict=True) for x in pair)


@pytest.mark.parametrize("good", [0.5, 0.7, 0.8, 0.9])
def test_a_lone_defect_condemns_unless_the_belief_is_too_kind(good):
    """Three defects that never meet, each on a few in a hundred documents, and some good texts with odd lines."""
    clean, odd = (1, 1, 1, None, None, None, None, None), (1, 1, 0, None, None, None, None, None)
    alone = [tuple(0 if k == j else v for k, v in enumerate(clean)) for j in (3, 4, 5)]
    right = quality.fitted([(clean, 9000), (odd, 10), *((p, 300) for p in alone)], good=good)
    assert quality.posterior(clean, right, good) > 0.5
    assert all(quality.posterior(p, right, good) < 0.5 for p in alone)


def test_a_bad_vote_alone_does_not_condemn(spark):
    """All-must-pass would lose these: documents with a bad vote that are kept, labelled good ones among them."""
    sf_dir = "/root/testdata/sf0.1"
    counted = quality.with_counts(documents(spark, sf_dir).select("doc_id", "text")).drop("text").cache()
    good = quality.fit(counted)
    voted_bad = functools.reduce(lambda a, b: a | b, (F.coalesce(v == 0, F.lit(False)) for v in quality.votes("_counts").values()))
    rows = counted.filter(~quality.base_failed("_counts")).select("doc_id", (good >= quality.KEEP).alias("kept"), voted_bad.alias("bad"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    told = Counter(tuple(r) for r in rows.join(labels, "doc_id").select("quality", "kept", "bad").collect())
    assert told[1, True, True] > 100 and told[1, False, True] + told[1, False, False] <= 0.005 * sum(told.values())
    assert told[0, False, True] >= 0.9 * sum(n for (q, *_), n in told.items() if not q)
    counted.unpersist()


def test_em_learns_share_and_accuracies():
    """Rules that abstain, err and stand in pairs; a rule that votes at random gets no say."""
    rng, patterns, truth = random.Random(4), Counter(), Counter()
    right = [(0.97, 0.9), (0.95, 0.8), (0.9, 0.85), (0.99, 0.6), (0.5, 0.5)]
    for _ in range(20_000):
        good = rng.random() < 0.85
        pattern = tuple(None if rng.random() < 0.2 else int(good == (rng.random() < a[not good])) for a in right)
        patterns[pattern] += 1
        truth[pattern] += good
    share, found = quality.estimated(sorted(patterns.items(), key=repr))
    assert abs(share - 0.85) < 0.03
    assert all(abs(x - y) < 0.06 for a, b in zip(right, found, strict=True) for x, y in zip(a, b, strict=True))
    sure = sum(max(truth[p], n - truth[p]) for p, n in patterns.items())
    hit = sum(truth[p] if quality.posterior(p, found, share) >= 0.5 else n - truth[p] for p, n in patterns.items())
    assert hit >= 0.995 * sure


def test_verdict_equals_em_by_hand(spark):
    """The column expression against EM of a few plain lines over the same votes."""
    counted = quality.with_counts(documents(spark, SF_DIR).select("doc_id", "text")).drop("text").cache()
    cast = quality.votes("_counts")
    rows = counted.filter(~quality.base_failed("_counts")).select("doc_id", *(v.alias(k) for k, v in cast.items()), quality.fit(counted).alias("p")).collect()
    votes = [tuple(r)[1:-1] for r in rows]
    share, right = 0.8, [(0.9, 0.3)] * len(cast)
    for _ in range(100):
        p = [by_hand(v, share, right) for v in votes]
        share = (8 + sum(p)) / (10 + len(p))
        right = []
        for j in range(len(cast)):
            on = [(v[j], g) for v, g in zip(votes, p, strict=True) if v[j] is not None]
            right.append(
                ((9 + sum(g for v, g in on if v)) / (10 + sum(g for _, g in on)), (3 + sum(1 - g for v, g in on if not v)) / (10 + sum(1 - g for _, g in on)))
            )
    assert all(abs(r.p - by_hand(v, share, right)) < 1e-3 for r, v in zip(rows, votes, strict=True))
    counted.unpersist()


def by_hand(vote, share, right):
    good, bad = share, 1 - share
    for v, (a, b) in zip(vote, right, strict=True):
        if v is not None:
            good, bad = good * (a if v else 1 - a), bad * (1 - b if v else b)
    return good / (good + bad)


def test_without_junk_nothing_goes(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1").select("doc_id")
    clean = documents(spark, SF_DIR).join(labels, "doc_id", "left_semi")
    counted = quality.with_counts(clean, "_c")
    passed = counted.filter(~quality.base_failed("_c")).count()
    assert quality.keep_good(clean).count() >= 0.99 * passed > 0


def test_held_out_accuracy(spark, table):
    rows = language.op3_language_id(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(table))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == table[r.doc_id].lang for r in held) >= 0.99 * len(held)


def test_language_of_odd_rows(spark, docs):
    rows = [(i, "der und die das ist ein " * 5) for i in range(20)] + [(i, "the and of it is a this ") for i in range(20, 40)]
    labelled = spark.createDataFrame(
        [(i, t, "de" if i < 20 else "en", "s", 1) for i, t in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    )
    odd = docs(odd_rows()).select("doc_id", "text", "lang", "source", "n_chars")
    odd = odd.withColumn("lang", odd.lang.substr(9, 1)).replace("", None, "lang")
    found = language.identified(labelled.union(odd)).collect()
    assert len(found) == len(rows) + len(odd_rows())
    assert all(r.lang_pred == ("de" if r.doc_id < 20 else "en") for r in found[:40])
    by_id = {(r.doc_id, r.lang_pred, r.score) for r in found[40:]}
    assert {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0), (None, "und", 0.0)} <= by_id
    assert not [r for r in found[40:] if r.doc_id is None and r.held_out]


def test_language_without_labels(docs):
    none = docs([(1, "some words")]).drop("lang").withColumnRenamed("source", "lang").replace("s", None, "lang")
    assert [tuple(r)[2:] for r in language.identified(none).collect()] == [("und", 0.0)]
    assert language.identified(docs([])).collect() == []


def test_ngrams_stay_in_their_text():
    orders, ends = language.ngrams(["abc", "", "d"])
    assert ends.tolist() == [4, 5, 7]
    alone, _ = language.ngrams(["d"])
    assert [o[5:7].tolist() for o in orders] == [o.tolist() for o in alone]
    assert [np.count_nonzero(o) for o in orders] == [4, 2, 1]


def test_temperature_calms_sure_errors():
    logits = np.array([[9.0, 0.0]] * 10)
    assert language.temperature(logits, np.array([0] * 7 + [1] * 3)) > 3
