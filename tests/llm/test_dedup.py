"""Substring dedup and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from conftest import odd_rows, words
from pyspark.sql import functions as F

from cdcflow.llm import byte_dedup, jaccard, superkmers, word_dedup
from cdcflow.llm.common import documents
from cdcflow.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


def planted(seed=5):
    """Random texts with copies, near copies and shared passages, some within one document."""
    rng = random.Random(seed)
    passage, rows = words(70, 99), []
    for i in range(40):
        text = words(rng.randrange(1, 150), 1000 + i)
        if i % 4 == 0:
            text[rng.randrange(len(text) + 1) : 0] = passage[rng.randrange(10) :]
        if i % 10 == 0:
            text += text[:60]
        rows.append((i, " ".join(text)))
    near = rows[8][1].split()
    for i in range(40, 60):
        copy = list(near)
        copy[rng.randrange(len(copy))] = "other"
        rows.append((i, " ".join(copy)))
    rows += [(i, rows[3][1]) for i in range(60, 66)]
    return rows


def table(spark):
    return list(map(tuple, documents(spark, SF_DIR).select("doc_id", "text").collect()))


def once(rows):
    """Rows equal in doc_id and text are one document."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def removed_words(rows):
    seen, out = set(), Counter()
    for doc_id, text in once(rows):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            window = tuple(w[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[doc_id, text or ""] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return Counter((i, *out[i, t or ""]) for i, t in rows)


def removed_bytes(rows):
    counts, out = Counter(), {}
    for _, text in once(rows):
        raw = (text or "").encode()
        counts.update(raw[i : i + 200] for i in range(len(raw) - 199))
    for doc_id, text in once(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if counts[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc_id, text or ""] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return Counter((i, *out[i, t or ""]) for i, t in rows)


def component_rows(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return Counter((doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows))


OPERATORS = [
    (word_dedup.without_repeats, removed_words),
    (byte_dedup.without_repeated_bytes, removed_bytes),
    (jaccard.near_duplicates, component_rows),
]


@pytest.mark.parametrize("operator, brute", OPERATORS)
def test_planted(docs, operator, brute):
    rows = planted()
    assert Counter(map(tuple, operator(docs(rows).repartition(3)).collect())) == brute(rows)


@pytest.mark.parametrize("operator, brute", OPERATORS)
def test_small_flushes(docs, operator, brute, monkeypatch):
    for module in (word_dedup, byte_dedup, jaccard):
        monkeypatch.setattr(module, "FLUSH_CHARS", 700)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    rows = planted(6)
    assert Counter(map(tuple, operator(docs(rows).coalesce(1)).collect())) == brute(rows)


@pytest.mark.parametrize("operator, brute", OPERATORS)
def test_odd_rows(docs, operator, brute):
    assert Counter(map(tuple, operator(docs(odd_rows())).collect())) == brute(odd_rows())


@pytest.mark.parametrize("operator, brute", OPERATORS)
def test_no_documents(docs, operator, brute):
    assert operator(docs([])).collect() == []


@pytest.mark.parametrize(
    "query, brute",
    [
        (word_dedup.op8_substring_dedup, removed_words),
        (byte_dedup.op2_suffix_array_dedup, removed_bytes),
        (jaccard.op4_ngram_jaccard_join, component_rows),
    ],
)
def test_table(spark, query, brute):
    assert Counter(map(tuple, query(spark, SF_DIR).collect())) == brute(table(spark))


@pytest.mark.parametrize("operator, brute, module", [(*o, m) for o, m in zip(OPERATORS, (word_dedup, byte_dedup), strict=False)])
def test_a_passage_in_half_of_all_documents(docs, operator, brute, module):
    """Its parts rank behind all others; the ends of the passage differ in each document."""
    passage = words(60, 77)
    rows = []
    for i in range(120):
        text = words(60, 5000 + i, 100_000)
        if i % 2:
            text[30:30] = passage[i % 5 : 60 - i % 7]
        rows.append((i, " ".join(text)))
    table = superkmers.marked(docs(rows))
    common = superkmers.common_parts(table, module.text_parts)
    inside = module.text_parts(" ".join(passage[10:50]))
    assert len(common) and set(inside.tolist()) <= set(common.tolist())
    assert not set(common.tolist()) & set(module.text_parts(" ".join(words(60, 5000, 100_000))).tolist())
    assert Counter(map(tuple, operator(docs(rows).repartition(4)).collect())) == brute(rows)


def test_keep_one_leaves_one_of_each_group(docs):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z"), (3, "x y z"), (4, None), (5, ""), (None, "q")]
    kept = jaccard.keep_one(docs(rows)).select("doc_id", "text").collect()
    assert Counter(map(tuple, kept)) == Counter([(1, "a b c d e f g"), (3, "x y z"), (4, None), (5, ""), (None, "q")])


def test_blind_trie_orders_like_sorting():
    rng = random.Random(3)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 20))]
        order, common = byte_dedup.trie_order(strings, list(range(len(strings))))
        assert [strings[i] for i in order] == sorted(strings)
        pairs = zip(order, order[1:], strict=False)
        assert common[1:] == [byte_dedup.common_length(strings[a], strings[b]) for a, b in pairs]


def test_multikey_quicksort_groups_equal_rows(monkeypatch):
    import numpy as np

    monkeypatch.setattr(byte_dedup, "SMALL", 4)
    table = np.random.default_rng(1).integers(0, 3, (500, 4)).astype(np.uint64)
    groups = byte_dedup.multikey_quicksort(table, np.arange(500))
    rows = [tuple(table[g[0]].tolist()) for g in groups]
    assert rows == sorted(set(map(tuple, table.tolist())))
    assert sorted(i for g in groups for i in g) == list(range(500))


def test_minimisers_are_the_leftmost_least():
    import numpy as np

    hashes = (np.random.default_rng(2).integers(0, 9, 300).astype(np.uint64)) << np.uint64(40)
    for width in (1, 2, 5, 17):
        want = [i + int(hashes[i : i + width].argmin()) for i in range(300 - width + 1)]
        assert superkmers.minimisers(hashes, width).tolist() == want


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(30)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(105, 105), (None, 3), (100, 101)]
    found = dict(map(tuple, components(spark.createDataFrame(chain + star, "a INT, b INT")).collect()))
    assert found == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a INT, b INT")).collect() == []


@pytest.mark.parametrize(
    "operator, expected", [(word_dedup.without_repeats, removed_words), (byte_dedup.without_repeated_bytes, removed_bytes)]
)
def test_rows_of_one_doc_id_whose_short_hashes_agree(spark, docs, operator, expected):
    """Texts are told apart by more than 32 bits: a long and a short one that agree in so many are found in no time."""
    body = " ".join(words(60, 3))
    long = spark.range(150_000).selectExpr(f"concat('{body} ', id) AS a").withColumn("h", F.hash("a"))
    short = spark.range(300_000).selectExpr("concat('t', id) AS b").withColumn("h", F.hash("b"))
    a, b = long.join(short, "h").select("a", "b").first()
    rows = [(5, a), (5, b), (7, body), (None, b), (None, a)]
    found = {tuple(r) for r in operator(docs(rows)).collect()}
    assert found == {tuple(r) for r in expected(rows)}


@pytest.mark.parametrize("partitions", [7, 8])
def test_texts_whose_hashes_are_alike_in_part_do_not_link(spark, docs, partitions):
    """These two agree in 40 bits of their hashes and leave the same remainder by 8."""
    rows = [(1, "w3836257"), (2, "w4816379"), (3, "w4816379")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = jaccard.near_duplicates(docs(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 2)]


@pytest.mark.parametrize("sets", [1, 5, 4000])
def test_packets_open_to_what_was_put_in(sets):
    import numpy as np

    owner = np.sort(np.array([0, sets - 1, *[sets // 2] * 300], np.uint32))
    values = np.arange(len(owner), dtype=np.uint64) << np.uint64(50)
    back = jaccard._opened(jaccard._closed(owner, values, sets))
    assert back[0].tolist() == owner.tolist() and back[1].tolist() == values.tolist()


def test_the_bitmap_bound_of_the_first_round_loses_no_link():
    import numpy as np
    import pyarrow as pa

    rng, pairs = np.random.default_rng(3), []
    for _ in range(400):
        n = int(rng.integers(4, 600))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[int(n * rng.uniform(0, 0.4)) :], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.2)), dtype=np.uint64)])
        pairs.append((b"a", b"b", len(a), len(b), np.sort(a).tobytes(), np.sort(b).tobytes()))
    columns = [pa.array(c) for c in zip(*pairs, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, ["a", "b", "n_a", "n_b", "shared_a", "shared_b"])
    counts = {bounded: sum(out.num_rows for out in jaccard._verify(bounded)([batch])) for bounded in (False, True)}
    assert 0 < counts[False] == counts[True] < 400
