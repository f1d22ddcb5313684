"""Token files and packing against the library itself."""

from __future__ import annotations

import ctypes
import random
import zlib
from collections import defaultdict

import numpy as np
import psutil
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cdcflow.llm import packing, token_file, tokens
from cdcflow.llm.common import documents, lean
from cdcflow.llm.tokens import PieceEncoder
from cdcflow.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def reference(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=FILES)
def encoder(request):
    with open(public_tokenizers.path(request.param), encoding="utf-8") as file:
        return PieceEncoder(file.read(), remember=500)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="abR stedmvl'1².,!-é—Ü\n\t\r　日İ", max_size=40), max_size=6))
def test_pieces_agree_with_the_library(encoder, texts):
    assert encoder.encode(texts) == encoder.whole(texts)


def test_short_forms_and_blanks(encoder):
    texts = ["it's we're 'street  'll", "", " ", "  \n ", "don't '' ''s x's's \n's 's", "<|endoftext|>", "'red 're"]
    assert encoder.encode(texts) == encoder.whole(texts)


def test_letters_that_lower_case_makes_longer(encoder):
    texts = ["ȺB Ⱦ'S ɏx", "²³ 1½ aªº ½'s €’s–", "'Ⱥ"]
    assert encoder.encode(texts) == encoder.whole(texts)


@pytest.mark.parametrize("name", FILES)
def test_what_is_remembered_is_not_encoded_again(name, monkeypatch):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        own = PieceEncoder(file.read(), remember=60)
    texts = [" ".join(f"{chr(97 + i)}{chr(97 + k)}q" for k in range(25)) for i in range(3)]
    for text in texts:  # the third one fills the younger generation
        own.encode([text])
    assert len(own.older) > 40
    want, asked, words = own.whole([texts[0]]), [], own._words
    monkeypatch.setattr(own, "_words", lambda pieces: asked.extend(pieces) or words(pieces))
    fresh = " ".join(f"zz{chr(97 + k)}" for k in range(25)) + " " + " ".join(f"yy{chr(97 + k)}" for k in range(25))
    assert own.encode([f"{fresh} {texts[0]}"])[0].endswith(want[0][-8:])  # the generations change in this step
    assert len(asked) <= 52


SPELLED = ["a <|endoftext|> b", "<|endoftext|>", "it<|startoftext|>'s <|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endof text|>", "a b"]


def as_loaded(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_in_texts_are_the_library_s(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        own = PieceEncoder(file.read())
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(SPELLED)] == list(map(as_loaded(name), SPELLED))


def test_added_tokens_in_documents(spark, docs):
    rows = list(enumerate(SPELLED))
    encode = as_loaded(FILES[0])
    assert [ids for _, _, _, ids in file_rows(spark, docs(rows))] == [np.array([*encode(t), 1], "<u4").tobytes() for t in SPELLED]
    encode = as_loaded(FILES[1])
    packed = {r.doc_id: r.ids_crc32 for r in packing.pack_documents(docs(rows), public_tokenizers.path(FILES[1])).collect()}
    assert packed == {i: crc([*encode(t), 0]) for i, t in rows}


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_code_round_trip(values):
    control, data = token_file.coded(np.array(values, np.uint32))
    assert token_file.decoded(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def file_rows(spark, docs):
    path = scratch_dir(spark, "file")
    by_rank = token_file.write_token_file(docs, public_tokenizers.path(FILES[0]), 1, path)
    rows = token_file.read_token_file(spark, path, by_rank).collect()
    return sorted(((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in rows), key=lambda r: r[0])


def test_token_file_of_the_table(spark):
    encode, start, want = reference(FILES[0]), 0, []
    for doc_id, text in sorted(documents(spark, SF_DIR).select("doc_id", "text").collect()):
        ids = [*encode(text), 1]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, token_file.op1_token_file(spark, SF_DIR).collect())) == want


def test_token_file_of_odd_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 300)
    encode = reference(FILES[0])
    got = file_rows(spark, docs(odd_rows()))
    want = sorted((i if i is not None else -1, np.array([*encode(t), 1], "<u4").tobytes()) for i, t in odd_rows())
    assert sorted((-1 if i is None else i, ids) for _, i, _, ids in got) == want
    order = [-1 if i is None else i for _, i, _, _ in got]
    assert order == sorted(order)
    ends = [start + n for start, _, n, _ in got]
    assert [start for start, _, _, _ in got] == [0, *ends[:-1]]


def test_no_documents(spark, docs):
    assert file_rows(spark, docs([])) == []
    assert packing.pack_documents(docs([]), public_tokenizers.path(FILES[1])).collect() == []


def placed(rows, capacity=2048):
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id].append(r)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences, texts


def test_packing_of_the_table(spark):
    encode = reference(FILES[1])
    rows = packing.op10_best_fit_packing(spark, SF_DIR).collect()
    sequences, texts = placed(rows)
    total = 0
    for doc_id, text in documents(spark, SF_DIR).select("doc_id", "text").collect():
        ids = [*encode(text), 0]
        total += len(ids)
        pieces = sorted(texts[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert sum(r.length for r in pieces) == len(ids)
        assert all(r.length == 2048 for r in pieces[1:])
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in pieces)
    assert len(sequences) <= 1.01 * -(-total // 2048) + 1


def test_packing_of_odd_rows(spark, docs):
    rows = packing.pack_documents(docs(odd_rows()), public_tokenizers.path(FILES[1])).collect()
    placed(rows)
    encode = reference(FILES[1])
    assert sum(r.length for r in rows) == sum(len(encode(t)) + 1 for _, t in odd_rows())
    assert len([r for r in rows if r.doc_id == 5]) == 2


def fewest(sizes, capacity):
    """The least number of bins, by trying all ways."""
    best = len(sizes)

    def put(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= capacity:
                put(rest[1:], [*bins[:i], bins[i] + rest[0], *bins[i + 1 :]])
        put(rest[1:], [*bins, rest[0]])

    put(sorted(sizes, reverse=True), [])
    return best


def test_reduction_keeps_the_optimum():
    rng = random.Random(4)
    fixed_any = 0
    for _ in range(300):
        capacity = rng.randrange(6, 20)
        sizes = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        fixed, rest = packing.reduced(counts, capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        used = [s for bin_sizes, n in fixed for s in bin_sizes for _ in range(n)]
        assert sorted(left + used) == sorted(sizes)
        assert all(sum(b) <= capacity for b, _ in fixed)
        fixed_any += bool(fixed)
        assert sum(n for _, n in fixed) + fewest(left, capacity) == fewest(sizes, capacity)
    assert fixed_any > 200


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30)))
def test_plan_places_every_rank_once(counts):
    bins, ranks = defaultdict(list), defaultdict(list)
    for size, first, n, copies, sequence, offset in packing.plan(counts, 64):
        for k in range(n):
            bins[sequence + k // copies].append((offset + k % copies * size, size))
            ranks[size].append(first + k)
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items()}
    for places in bins.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= 64


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs the GNU C library")
def test_a_lean_task_gives_its_memory_back():
    def task(batches):
        held = [np.ones(2000, np.uint8) for _ in range(100_000)]
        last = np.ones(2000, np.uint8)  # behind all the others, so that they do not go by themselves
        del held
        yield last

    resident = lambda: psutil.Process().memory_info().rss / 1e6
    pins = list(task(iter([])))
    before = resident()
    pins += lean(task)(iter([]))
    assert resident() < before - 100
    done = []
    first = lean(lambda batches: (done.append(b) or b for b in batches))(iter([1, 2]))
    assert next(first) == 1 and list(first) == [2] and done == [1, 2]


def test_an_encoder_is_let_go_unless_it_is_kept(monkeypatch):
    class Rows:
        def mapInArrow(self, task, schema):
            return task

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = type("Spec", (), {"value": file.read()})
    monkeypatch.setattr(packing, "texts_of", lambda docs: Rows())
    monkeypatch.setattr(packing, "broadcast_spec", lambda docs, tokenizer: spec)
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", None])], ["doc_id", "text"])
    found = []
    for keep in (True, False):
        task = packing.document_pieces(None, "", 0, 2048, keep=keep)
        found.append([x.to_pylist() for x in task(iter([batch]))])
        assert bool(tokens._ENCODERS) == keep
    assert found[0] == found[1]


def test_packing_without_kept_encoders_gives_the_same(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    kept, fresh = (sorted(packing.pack_documents(docs([(i, f"word{i} " * 99) for i in range(30)]), path, keep=k).collect()) for k in (True, False))
    assert kept == fresh
