"""Alignment against the tokenizers and every overlapping pair of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cdcflow.llm import alignment, chunks
from cdcflow.llm.common import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = alignment.byte_signs()

    def pieces(text):
        found = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(signs[s] for s in t)) for i, t in zip(found.ids, found.tokens, strict=True)]
        ids = b.encode(text)
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
        return left, right

    return pieces


def spans(tokens):
    at, out = 0, []
    for n, raw in tokens:
        out.append((n, at, at + len(raw)))
        at += len(raw)
    return out


def expected(pieces, rows):
    links, out = Counter(), []
    for doc_id, text in rows:
        left, right = pieces(text) if text else ([], [])
        raw = b" " + (text or "").encode()
        if not text or any(b"".join(r for _, r in side) != raw for side in (left, right)):
            out.append((doc_id, 0, 0, [], ""))
            continue
        left, right = spans(left), spans(right)
        ends = sorted({e for *_, e in left} & {e for *_, e in right})
        groups, sides = [], [list(left), list(right)]
        for side in sides:
            side.reverse()
        for end in ends:
            taken = []
            for side in sides:
                taken.append([])
                while side and side[-1][2] <= end:
                    taken[-1].append(str(side.pop()[0]))
            groups.append("|".join(map(",".join, taken)))
        mine, first = [], 0
        for n, s, e in left:
            while right[first][2] <= s:
                first += 1
            at = first
            while at < len(right) and right[at][1] < e:
                mine.append((n, right[at][0]))
                at += 1
        links.update(mine)
        out.append((doc_id, len(left), len(right), mine, ";".join(groups)))
    best = Counter()
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    return [
        (
            doc_id, n_a, n_b, groups.count(";") + bool(groups), len(mine), sum(links[p] == best[p[1]] for p in mine),
            sum(links[p] for p in mine), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, mine, groups in out
    ]


def key(row):
    return [(x is not None, x) for x in row]


TEXTS = [
    "a <|endoftext|> b", "<s>x</s>  <0x41> <unk>", " leading", "trailing  ", "\n\ttabs\r\n", "▁ already", "日本語 текст é é ﬁ",
    "don't we'll   wide    gaps", "x" * 300, "🙂🙂 ok", "\x00 nul", "a b", "antidisestablishmentarianism" * 5, " ", "  ",
]


@pytest.mark.parametrize("chars, buckets", [(8_000_000, 8), (50, 3)])
def test_small_table(spark, docs, tools, monkeypatch, chars, buckets):
    monkeypatch.setattr(alignment.chunks, "bucket_count", lambda docs: buckets)
    rows = [*odd_rows(), *[(100 + i, t) for i, t in enumerate(TEXTS)], (100, TEXTS[0])]
    found = alignment.aligned_documents(docs(rows).repartition(3), A, B, chars).collect()
    assert sorted(map(tuple, found), key=key) == sorted(expected(tools, rows), key=key)


def test_empty_table(spark, docs):
    assert alignment.aligned_documents(docs([]), A, B).collect() == []


def test_given_documents(spark, tools):
    rows = [tuple(r) for r in documents(spark, SF_DIR).select("doc_id", "text").collect()]
    found = alignment.op12_cross_tokenizer_alignment(spark, SF_DIR).collect()
    assert sorted(map(tuple, found), key=key) == sorted(expected(tools, rows), key=key)


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return alignment.Aligner(a.read(), b.read(), remember=20)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="abst'1., -é\n\t日🙂▁<", max_size=30), min_size=1, max_size=5))
def test_windows_are_whole_and_begin_with_a_space(aligner, texts):
    texts = [t for t in texts if t] or ["x"]
    rows = alignment.chunk_rows(0, list(range(len(texts))), texts, 4, aligner)
    a, b, _, _ = aligner.ids(texts)
    assert [x.tolist() for x in b] == [x.tolist() for x in aligner.b.whole(texts)]
    for n, text, ids_a, ids_b in zip(rows[0]["n_a"], texts, a, b, strict=True):
        raw = b" " + text.encode()
        same = all(side.bytes_of(ids).tobytes() == raw for side, ids in zip(aligner.spelled, (ids_a, ids_b), strict=True))
        assert n == (len(ids_a) if text and same else 0)
        if n:
            _, distinct, sizes = alignment.windows_of(ids_a, ids_b, np.array([len(raw)]), aligner)
            assert sizes.sum() >= len(distinct)
            for window in distinct:
                ids = np.frombuffer(window, "<u4")
                first = ids[1], ids[1 + ids[0]]
                assert aligner.spelled[0].marked[first[0]] and aligner.spelled[1].marked[first[1]]


@given(st.lists(st.integers(-(2**62), 2**62)))
def test_keys_round_trip(values):
    keys = np.sort(np.array(values, np.int64))
    assert chunks.unzipped_keys(chunks.zipped_keys(keys)).tolist() == keys.tolist()


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99))))
def test_sums(pairs):
    keys, n = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    distinct, total, at = chunks.summed(keys, n)
    counts = Counter()
    for k, v in pairs:
        counts[k] += v
    assert dict(zip(distinct.tolist(), total.tolist(), strict=True)) == dict(counts)
    assert distinct[at].tolist() == keys.tolist()
