"""Scores against plain counts, seating against exact probabilities, and the model on text it has not seen."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import odd_rows, words

from cdcflow.llm import lm
from cdcflow.llm.common import documents

SF_DIR = "/root/testdata/sf0.001"


def tokens_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), None]


def learnt(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def figures(rows):
    """What SQL could say: the counts and the base score."""
    c = Counter(t for i, text in rows if learnt(i) for t in tokens_of(text))
    total, kinds = sum(c.values()), len(c)
    out = []
    for i, text in rows:
        mine = tokens_of(text)
        base = sum(math.log10((c[t] + 1) / (total + kinds + 1)) for t in mine)
        out.append((i, i is not None and not learnt(i), len(mine), sum(c[t] > 0 for t in mine), total, base))
    return out


def one_table_each(rows):
    """The model with every dish at one table, by dictionaries."""
    pairs, kinds = Counter(), set()
    for i, text in rows:
        if learnt(i):
            mine = tokens_of(text)
            pairs.update(zip([None, *mine], mine, strict=False))
            kinds.update(mine)
    counts, tables, customers = Counter(), Counter(), Counter()
    for (u, w), n in pairs.items():
        counts[u] += n
        tables[u] += 1
        customers[w] += 1
    n1, n2 = (sum(n == k for n in pairs.values()) for k in (1, 2))
    d, theta, upper = lm.discount_of(n1, n2), lm.CONCENTRATION, lm.UPPER
    total, size = sum(customers.values()), len(customers)

    def score(text):
        mine, out = tokens_of(text), 0.0
        for u, w in zip([None, *mine], mine, strict=False):
            above = (customers[w] - upper * (customers[w] > 0) + (theta + upper * size) / (len(kinds) + 1)) / (theta + total)
            n = pairs[u, w]
            out += math.log10((n - d * (n > 0) + (theta + d * tables[u]) * above) / (theta + counts[u]))
        return out

    return [score(text) for _, text in rows]


def key(row):
    return (row[0] is not None, *row)


ROWS = [*odd_rows(), (20, "ABC abc É é"), (21, None), (22, "w1 w2 w3 " * 30), (23, " ".join(words(300, 5, 40))), (24, "x" * 5000)]


@pytest.mark.parametrize("chars, buckets, hot", [(8_000_000, 8, 10**6), (100, 3, 10**6), (2000, 5, 50)])
def test_counts_and_scores(spark, docs, monkeypatch, chars, buckets, hot):
    monkeypatch.setattr(lm.chunks, "bucket_count", lambda docs: buckets)
    found = sorted(map(tuple, lm.language_scores(docs(ROWS).repartition(3), chars, moves=0, hot=hot).collect()), key=key)
    wanted = sorted((f + (s,) for f, s in zip(figures(ROWS), one_table_each(ROWS), strict=True)), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in wanted], rtol=1e-6)


def test_nothing_learnt(spark, docs):
    held = [(i, "a b") for i in range(100) if not learnt(i)]
    found = lm.language_scores(docs(held)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) for r in found} == {(0, 0, 0.0, 0.0, True)}
    assert lm.language_scores(docs([])).collect() == []


@pytest.mark.parametrize("c, d, base", [(5, 0.5, 0.3), (12, 0.8, 0.02), (30, 0.6, 0.6)])
def test_seating_has_the_exact_distribution(c, d, base):
    weight = defaultdict(float, {(1, 1): 1.0})
    for n in range(1, c):
        for t in range(1, n + 2):
            weight[n + 1, t] = weight[n, t - 1] + (n - d * t) * weight[n, t]
    p = np.array([weight[c, t] * math.prod((lm.CONCENTRATION + d * j) * base for j in range(1, t)) for t in range(1, c + 1)])
    p /= p.sum()
    n = 4000
    t = np.ones(n, np.int64)
    for number in range(30):
        t = lm.moved(np.full(n, c), t, np.arange(n), t.astype(float), d, np.full(n, base), 12, [number])
    met = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(met - p).max() < 0.03


@pytest.mark.parametrize("c, d, base, start", [(300, 0.5, 0.3, 1), (2000, 0.8, 0.05, 600)])
def test_every_customer_of_a_large_dish_moves(c, d, base, start):
    log = np.full(c + 2, -np.inf)
    log[1], t = 0.0, np.arange(c + 2)
    for n in range(1, c):
        stay = np.where((t >= 1) & (t <= n), np.log(np.maximum(n - d * t, 1e-300)), -np.inf) + log
        log = np.logaddexp(np.append(-np.inf, log[:-1]), stay)
    log[1:] += np.cumsum(np.append(0, np.log((lm.CONCENTRATION + d * t[1:-1]) * base)))
    p = np.exp(log - log.max())
    mean = (p * t).sum() / p.sum()
    n = 500
    found = np.full(n, start)
    for number in range(30):
        found = lm.moved(np.full(n, c), found, np.arange(n), found.astype(float), d, np.full(n, base), lm.MOVES, [number])
    assert abs(found.mean() / mean - 1) < 0.1


def test_given_documents(spark):
    rows = [tuple(r) for r in documents(spark, SF_DIR).select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in lm.op13_pitman_yor_scores(spark, SF_DIR).collect()}
    for doc_id, *rest, base in figures(rows):
        r = found[doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == rest
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in found.values() if r.held_out]
    # Perplexity on documents that were not learnt from, well below that of the base.
    base, model = (-sum(getattr(r, k) for r in held) / sum(r.n_tokens for r in held) for k in ("base_score", "score"))
    assert model < base - 0.1
    plain = dict(zip([i for i, _ in rows], one_table_each(rows), strict=True))
    assert model < 0.02 - sum(plain[r.doc_id] for r in held) / sum(r.n_tokens for r in held)
