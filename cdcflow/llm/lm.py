"""Language model scores by a hierarchical Pitman-Yor process.

Each word is a context with a restaurant of its own for the words behind it; the first word of a text stands behind an
end. All of them share one parent restaurant of words without context, and its parent is uniform over the known words
and one for all others. A customer is an occurrence, a dish a word; of the tables of a dish, one customer each goes to
the parent. Seating is sampled by Gibbs: a customer of each dish leaves, its table with it if it sat alone, and sits
down again at a table of its dish or a new one. Only the number of tables of a dish is kept; whether a customer
sits alone is drawn by the ratio of generalised Stirling numbers, and above ``EXACT`` customers by its limit. In a round
every customer moves: all dishes of a context together, their customers one at a time, or of a dish with more than
``EXACT`` in as many equal shares. Restaurants and their parent move in turn. The predictive probabilities of the last
``SAMPLES`` rounds are averaged.

Words and pairs of words are counted over all documents by chunks and buckets (see ``chunks``); restaurants live in
buckets of contexts, the parent in buckets of words, and both sides send each other sums by bucket. A context with more
than ``HOT`` customers is dealt to several buckets by its dishes, and each takes its share of tables for the others' too.

A null text is empty and has only its end. Documents without doc_id are scored as the others, as not held out, but
nothing is learnt from them. Rows that repeat count and are returned each. Texts above the size of a chunk are
cut at white space and their parts added up. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import bucketed, documents, stored
from .tokens import texts_of

CHUNK_CHARS = 8_000_000
BURN_IN, SAMPLES, MOVES = 2, 3, 1  # rounds before the samples, samples, moves of each customer in a round
CONCENTRATION = 1.0
UPPER = 0.8  # the parent's discount; that of the contexts is taken from the counts
EXACT = 64
HOT = 1_000_000
FOLDED = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
END = b"\n"  # a word of its own: no word holds white space
UNKNOWN = 0

TOKENS = (
    "chunk BIGINT, bucket INT, words BINARY, n BINARY, doc_id ARRAY<BIGINT>, row ARRAY<BIGINT>, part ARRAY<BOOLEAN>, "
    "sizes BINARY, codes BINARY, learnt BINARY"
)
TOKEN_ROW = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("n", pa.binary()), ("doc_id", pa.list_(pa.int64())),
     ("row", pa.list_(pa.int64())), ("part", pa.list_(pa.bool_()))] + [(c, pa.binary()) for c in ("sizes", "codes", "learnt")]
)
# What buckets say: to a chunk, or to the bucket of another side.
SAID = "kind STRING, chunk BIGINT, bucket INT, origin INT, ids BINARY, a BINARY, b BINARY, c BINARY, x BIGINT, y BIGINT"
SAID_ROW = pa.schema(
    [("kind", pa.string()), ("chunk", pa.int64()), ("bucket", pa.int32()), ("origin", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "a", "b", "c")] + [("x", pa.int64()), ("y", pa.int64())]
)
RESULT = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
)


def table(rows: list[dict], schema: pa.Schema = SAID_ROW) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


# ---- words -----------------------------------------------------------------------------------------


def remainder(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def parts_of(text: str, chars: int) -> Iterator[tuple[bytes, bool]]:
    """A text in parts of about ``chars`` characters, folded and cut at white space, and whether it is the last."""
    raw, size = text.encode().translate(FOLDED), 4 * chars
    while len(raw) > size and (at := raw.find(b" ", size)) >= 0:
        yield raw[:at], False
        raw = raw[at:]
    yield raw, True


def entries(doc_ids: list, texts: list, first_row: int, chars: int) -> Iterator[list[tuple]]:
    """Chunks of ``doc_id, row, whether a part of a text, tokens with a space behind each``; the first token is only the
    context of the second: an end, or the last word of the part before."""
    held, size = [], 0
    for row, (doc_id, text) in enumerate(zip(doc_ids, texts, strict=True), first_row):
        before, part = END, False
        for raw, last in parts_of(text or "", chars):
            part = part or not last
            tokens = [before, *raw.split()]
            held.append((doc_id, row, part, b" ".join([*tokens, END, b""] if last else [*tokens, b""])))
            before, size = tokens[-1], size + len(raw)
            if size >= chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def token_rows(chunk: int, held: list[tuple], buckets: int) -> list[dict]:
    """The row of a chunk, its tokens as numbers of its distinct words, and one of its words for each bucket."""
    raw = b"".join(e[3] for e in held)
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1
    offsets = np.append(0, ends).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
    ).dictionary_encode()
    names = words.dictionary.to_pylist()
    of = np.array([zlib.crc32(w) % buckets for w in names], np.int64)
    order = np.argsort(of, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    codes = number[words.indices.to_numpy()]
    begin = np.cumsum([0, *(len(e[3]) for e in held)])
    sizes = np.diff(np.searchsorted(ends, begin, side="right"))
    learnt = np.array([remainder(e[0]) not in (2, None) for e in held], np.uint8)
    counted = np.repeat(learnt, sizes).astype(bool)
    counted[np.cumsum(sizes) - sizes] = False
    n = np.bincount(codes[counted], minlength=len(names))
    row = {"chunk": chunk, "doc_id": [e[0] for e in held], "row": [e[1] for e in held], "part": [e[2] for e in held]}
    blobs = {"sizes": sizes.astype("<u4"), "codes": codes.astype("<u4"), "learnt": learnt}
    rows = [row | {k: chunks.zipped(v) for k, v in blobs.items()}]
    at = 0
    for bucket, size in enumerate(np.bincount(of, minlength=buckets).tolist()):
        if size:
            mine = b"".join([names[i] for i in order[at : at + size].tolist()])
            packed = chunks.zstandard.compress(mine, 1)
            rows.append({"chunk": chunk, "bucket": bucket, "words": packed, "n": chunks.zipped(n[at : at + size].astype("<u4"))})
            at += size
    return rows


def word_answers(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Number and count of each word, ``UNKNOWN`` and 0 if nothing was learnt of it; numbers of a bucket are ``buckets`` apart."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
        raw = b"".join(chunks.zstandard.decompress(r["words"]) for r in rows)
        offsets = np.append(0, np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
        ).dictionary_encode()
        which = words.indices.to_numpy()
        counts = [chunks.unzipped(r["n"]) for r in rows]
        _, total, at = chunks.summed(which.astype(np.int64), np.concatenate(counts))
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        bucket = rows[0]["bucket"]
        numbers = np.where(total > 0, 1 + bucket + buckets * rank, UNKNOWN)
        if numbers.max(initial=0) >= 1 << 32:
            raise OverflowError("more words than a number of four bytes can tell apart")
        said = [{"kind": "stats", "x": int((total > 0).sum()), "y": int(total.sum())}]
        sizes = list(map(len, counts))
        for r, ids, n in zip(rows, chunks.split_at(numbers[at], sizes), chunks.split_at(total[at], sizes), strict=True):
            blobs = {"ids": chunks.zipped(ids.astype("<u4")), "a": chunks.zipped(n.astype("<i8"))}
            said.append({"kind": "words", "chunk": r["chunk"], "bucket": bucket} | blobs)
        return table(said)

    return answer


# ---- pairs -----------------------------------------------------------------------------------------


class Chunk:
    """Tokens of a chunk with the numbers and counts of its words, and its distinct pairs in the order of their buckets."""

    def __init__(self, row: dict, answers: list[dict], buckets: int, hot: int):
        blank = np.zeros(0, np.int64)
        self.ids = np.concatenate([blank, *(chunks.unzipped(r["ids"]) for r in answers)]).astype(np.int64)
        self.n = np.concatenate([blank, *(chunks.unzipped(r["a"], "<i8") for r in answers)])
        self.sizes, self.codes = (chunks.unzipped(row[k]).astype(np.int64) for k in ("sizes", "codes"))
        self.learnt = chunks.unzipped(row["learnt"], np.uint8).astype(bool)
        self.scored = np.ones(len(self.codes), bool)
        self.scored[np.cumsum(self.sizes) - self.sizes] = False
        context = np.roll(self.codes, 1)
        kinds = len(self.ids)
        local, self.at = np.unique((context * kinds + self.codes)[self.scored], return_inverse=True)
        self.context, self.word = local // max(kinds, 1), local % max(kinds, 1)
        u, w = self.ids[self.context], self.ids[self.word]
        self.asked = (u != UNKNOWN) & (w != UNKNOWN)
        self.keys = u << 32 | w
        self.parts = -(-self.n[self.context] // hot)
        share = np.where(self.parts > 1, 1 + chunks.mixed(w, 1 << 30) % np.maximum(self.parts, 1), 0)
        self.bucket = chunks.mixed(u + (share << 32), buckets)
        places = np.flatnonzero(self.asked)
        self.order = places[np.lexsort((self.keys[places], self.bucket[places]))]


def pair_rows(buckets: int, hot: int) -> Callable[[dict, list[dict]], pa.Table]:
    """The distinct pairs of a chunk with the times that they are learnt, a row for each bucket."""

    def finish(row: dict, answers: list[dict]) -> pa.Table:
        me = Chunk(row, answers, buckets, hot)
        learnt = np.repeat(me.learnt, me.sizes)[me.scored]
        n = np.bincount(me.at[learnt], minlength=len(me.keys))
        sizes = np.bincount(me.bucket[me.order], minlength=buckets).tolist()
        out = []
        for bucket, mine in enumerate(chunks.split_at(me.order, sizes)):
            if len(mine):
                large = mine[me.parts[mine] > 1]
                split = np.unique(np.stack([me.ids[me.context[large]], me.parts[large]]), axis=1)
                blobs = {"ids": chunks.zipped_keys(me.keys[mine]), "a": chunks.zipped(n[mine].astype("<u4"))}
                blobs["b"] = chunks.zipped(split.astype("<i8"))
                out.append({"kind": "pairs", "chunk": row["chunk"], "bucket": bucket} | blobs)
        return table(out)

    return finish


def by_number(ids: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sums of ``n`` by word, for each bucket of words."""
    ids, n, _ = chunks.summed(ids, n)
    of = (ids - 1) % buckets
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets).tolist()
    for bucket, mine in enumerate(chunks.split_at(order, sizes)):
        if len(mine):
            yield bucket, ids[mine], n[mine]


def sums_said(kind: str, bucket: int, ids: np.ndarray, n: np.ndarray, buckets: int) -> list[dict]:
    return [
        {"kind": kind, "bucket": to, "origin": bucket, "ids": chunks.zipped_keys(x), "a": chunks.zipped(m.astype("<i8"))}
        for to, x, m in by_number(ids, n, buckets)
    ]


def counted(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Restaurants of a bucket before any seating. Pairs met once sit alone for good, so only sums of them are kept."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
        keys = [chunks.unzipped_keys(r["ids"]) for r in rows]
        distinct, total, at = chunks.summed(np.concatenate(keys), np.concatenate([chunks.unzipped(r["a"]) for r in rows]))
        bucket, once, more = rows[0]["bucket"], distinct[total == 1], total > 1
        code = np.minimum(total, 1)
        code[more] = 2 + np.arange(more.sum())
        out = [{"kind": "stats", "x": len(once), "y": int((total == 2).sum())}]
        for r, c in zip(rows, chunks.split_at(code[at], list(map(len, keys))), strict=True):
            out.append({"kind": "codes", "chunk": r["chunk"], "bucket": bucket, "a": chunks.zipped(c.astype("<u4"))})
        contexts, alone, _ = chunks.summed(once >> 32, np.ones(len(once), np.int64))
        parts = np.concatenate([chunks.unzipped(r["b"], "<i8").reshape(2, -1) for r in rows], axis=1)
        single = {"c": chunks.zipped(np.stack([contexts, alone]).astype("<i8")), "b": chunks.zipped(np.unique(parts, axis=1))}
        seats = np.stack([total[more], np.ones(more.sum()), np.zeros(more.sum())])  # customers, tables, sum of sampled tables
        out.append({"kind": "seats", "bucket": bucket, "ids": chunks.zipped_keys(distinct[more]), "a": chunks.zipped(seats.astype("<i8"))} | single)
        out += sums_said("once", bucket, once & 0xFFFFFFFF, np.ones(len(once), np.int64), buckets)
        out += sums_said("alone", bucket, contexts, alone, buckets)
        out += sums_said("dishes", bucket, distinct[more] & 0xFFFFFFFF, np.ones(more.sum(), np.int64), buckets)
        return table(out)

    return answer


# ---- seating ---------------------------------------------------------------------------------------


def alone_ratio(discount: float) -> np.ndarray:
    """[c, t]: how likely one of c customers at t tables sits alone, S(c-1, t-1) / S(c, t), for c up to EXACT."""
    log = np.full((EXACT + 1, EXACT + 2), -np.inf)
    log[1, 1] = 0
    for c in range(1, EXACT):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = np.where(t <= c, np.log(np.maximum(c - discount * t, 1e-300)), -np.inf) + log[c, t]
        log[c + 1, t] = np.logaddexp(log[c, t - 1], stay)
    ratio = np.zeros((EXACT + 1, EXACT + 2))
    for c in range(2, EXACT + 1):
        t = np.arange(1, c + 1)
        ratio[c, t] = np.exp(log[c - 1, t - 1] - log[c, t])
    return ratio


def first_seats(c: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Where seating starts: the expected tables when ``c`` customers come in, new tables having ``weight`` all the time."""
    t, came = np.ones(len(c)), np.ones(len(c))
    while (left := c - came).any():
        step = np.minimum(left, np.maximum(1, came // 4))
        t += step * weight / (weight + np.maximum(came - discount * t, 1e-9))
        came += step
    return np.clip(np.rint(t), 1, c).astype(np.int64)


def moved(
    c: np.ndarray, t: np.ndarray, group: np.ndarray, tables: np.ndarray, discount: float, base: np.ndarray, moves: int, seed: list[int]
) -> np.ndarray:
    """The tables of dishes after a round: every customer has left and sat down again ``moves`` times, those of one dish
    after the other, those of different dishes together. ``tables`` are those of each ``group``, all its dishes together;
    ``base`` the parent's probabilities.

    The customers of a dish come in at most ``EXACT`` steps: one in each, or of a larger dish equal shares, whose chances
    are those at the beginning of the step. So a step takes away or adds about a share of discount / ``EXACT`` of its tables.
    """
    rng, order = np.random.default_rng(seed), np.argsort(-c, kind="stable")
    c, t, group, base, tables = c[order], t[order].copy(), group[order], base[order], tables.astype(float)
    ratio, large = alone_ratio(discount), int(np.searchsorted(-c, -EXACT))
    for step in range(moves * EXACT):
        step %= EXACT
        k = int(np.searchsorted(-c, -max(step, 1)))  # those with more customers than steps made, two at least
        if not k:
            continue
        n, now, where = c[:k], t[:k], group[:k]
        chance = np.where(n <= EXACT, ratio[np.minimum(n, EXACT), np.minimum(now, EXACT)], discount * (now - 1) / (n - 1 - discount))
        leaves = ((rng.random(k) < chance) & (now > 1)).astype(np.int64)
        share = (n[:large] * (step + 1)) // EXACT - (n[:large] * step) // EXACT
        leaves[:large] = np.minimum(rng.binomial(share, chance[:large]), now[:large] - 1)
        gone = leaves.astype(float)
        gone[:large] = chance[:large]  # of one customer
        new = (CONCENTRATION + discount * (tables[where] - gone)) * base[:k]
        others = n - 1 - discount * (now - gone)
        opens = (rng.random(k) * (new + others) < new).astype(np.int64)
        opens[:large] = rng.binomial(share, new[:large] / (new + others)[:large])
        after = np.minimum(now - leaves + opens, n)
        tables += np.bincount(where, (after - now).astype(float), minlength=len(tables))
        t[:k] = after
    out = np.empty_like(t)
    out[order] = t
    return out


def seated(buckets: int, number: int, parent: tuple[float, ...], discount: float, moves: int, sample: bool):
    """A round of the restaurants of a bucket, given what their parent's buckets said of each dish."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["origin"] or 0)
        (seats,) = [r for r in rows if r["kind"] == "seats"]
        bucket, keys = seats["bucket"], chunks.unzipped_keys(seats["ids"])
        c, t, sampled = chunks.unzipped(seats["a"], "<i8").reshape(3, -1)
        contexts, alone = chunks.unzipped(seats["c"], "<i8").reshape(2, -1)
        told = [r for r in rows if r["kind"] == "told"]
        names = np.concatenate([np.zeros(0, np.int64), *(chunks.unzipped_keys(r["ids"]) for r in told)])
        values = np.concatenate([np.zeros(0), *(chunks.unzipped(r["a"], "<f8") for r in told)])
        order = np.argsort(names)
        base = values[order][np.searchsorted(names[order], keys & 0xFFFFFFFF)]
        base = parent_probability(base, parent)
        own, group = np.unique(np.concatenate([keys >> 32, contexts]), return_inverse=True)
        group, ones = group[: len(keys)], np.bincount(group[len(keys) :], alone, len(own))
        parts = np.ones(len(own))
        split = chunks.unzipped(seats["b"], "<i8").reshape(2, -1)
        parts[np.searchsorted(own, split[0])] = split[1]
        if not number and moves:
            guess = (np.bincount(group, minlength=len(own)) + ones) * parts
            t = first_seats(c, (CONCENTRATION + discount * guess[group]) * base, discount)
        tables = (np.bincount(group, t, len(own)) + ones) * parts
        t = moved(c, t, group, tables, discount, base, moves, [number, bucket])
        out = [seats | {"a": chunks.zipped(np.stack([c, t, sampled + t * sample]).astype("<i8"))}]
        out += sums_said("dishes", bucket, keys & 0xFFFFFFFF, t, buckets)
        if sample:
            out += sums_said("tables", bucket, keys >> 32, t, buckets)
        return table(out)

    return answer


def parent_probability(value: np.ndarray, parent: tuple[float, ...]) -> np.ndarray:
    """A word's probability without context; ``value`` are its customers less the discount of its tables."""
    customers, tables, discount, kinds = parent
    return (value + (CONCENTRATION + discount * tables) / (kinds + 1)) / (CONCENTRATION + customers)


def parent_seated(number: int, discount: float, tables: float, kinds: int, moves: int) -> Callable[[pa.Table], pa.Table]:
    """A round of the parent restaurant, by buckets of words: the customers that tables sent, and what they sum up to."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: (r["kind"], r["origin"] or 0))
        came = [r for r in rows if r["kind"] in ("once", "dishes")]
        bucket, keys = rows[0]["bucket"], [chunks.unzipped_keys(r["ids"]) for r in came]
        ids, c, at = chunks.summed(
            np.concatenate([np.zeros(0, np.int64), *keys]),
            np.concatenate([np.zeros(0, np.int64), *(chunks.unzipped(r["a"], "<i8") for r in came)]),
        )
        base, t = np.full(len(ids), 1 / (kinds + 1)), np.ones(len(ids), np.int64)
        before = [r for r in rows if r["kind"] == "parent"]
        if not number and moves:
            t = first_seats(c, (CONCENTRATION + discount * tables) * base, discount)
        for r in before:  # every known word has customers in each round
            t = np.clip(chunks.unzipped(r["b"], "<i8"), 1, c)
        if len(ids):
            # Its tables stand in all buckets; here they count as the share that the bucket had before.
            share = max(0.0, tables - t.sum())
            t = moved(c, t, np.zeros(len(ids), np.int64), np.array([t.sum() + share]), discount, base, moves, [number, bucket, 1])
        value = c - discount * t
        sat = [(r["ids"], r["a"]) for r in rows if r["kind"] in ("alone", "tables")]
        inside, n, _ = chunks.summed(
            np.concatenate([np.zeros(0, np.int64), *(chunks.unzipped_keys(x) for x, _ in sat)]),
            np.concatenate([np.zeros(0, np.int64), *(chunks.unzipped(x, "<i8") for _, x in sat)]),
        )
        own = np.zeros(len(ids))
        found = np.searchsorted(ids, inside)
        last = inside[found == len(ids)]  # a context that nobody has as a dish cannot be
        if len(last):
            raise ValueError("a context is not among the words")
        own[found] = n
        out = [{"kind": "stats", "x": int(c.sum()), "y": int(t.sum())}]
        out.append({"kind": "parent", "bucket": bucket, "ids": chunks.zipped_keys(ids), "a": chunks.zipped(value), "b": chunks.zipped(t), "c": chunks.zipped(own)})
        ends = np.cumsum([len(k) for k in keys])
        for r, end, k in zip(came, ends.tolist(), keys, strict=True):
            if r["kind"] == "dishes":
                told = chunks.zipped(value[at[end - len(k) : end]])
                out.append({"kind": "told", "bucket": r["origin"], "origin": bucket, "ids": r["ids"], "a": told})
        return table(out)

    return answer


# ---- scores ----------------------------------------------------------------------------------------


def word_values(rows: pa.Table) -> pa.Table:
    """For the words of each chunk, by sample, their customers less the discount of their tables in the parent, and
    their tables as a context. Few words have values of their own, so they pack better than probabilities."""
    rows = rows.to_pylist()
    samples = sorted((r for r in rows if r["kind"] == "parent"), key=lambda r: r["x"])
    ids = chunks.unzipped_keys(samples[0]["ids"]) if samples else np.zeros(0, np.int64)
    columns = {k: [np.append(chunks.unzipped(r[x], "<f8"), 0).astype("<f4") for r in samples] for k, x in (("a", "a"), ("b", "c"))}
    out = []
    for r in rows:
        if r["kind"] == "words":
            mine = chunks.unzipped(r["ids"]).astype(np.int64)
            at = np.where(mine == UNKNOWN, len(ids), np.searchsorted(ids, mine))
            nothing = np.zeros(SAMPLES * len(mine), "<f4")
            blobs = {k: chunks.zipped(np.concatenate([x[at] for x in v]) if v else nothing) for k, v in columns.items()}
            out.append({"kind": "values", "chunk": r["chunk"], "bucket": r["bucket"]} | blobs)
    return table(out)


def pair_values(discount: float) -> Callable[[pa.Table], pa.Table]:
    """For the pairs of each chunk, their customers less the discount of their tables in the mean of the samples."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        (seats,) = [r for r in rows if r["kind"] == "seats"]
        c, _, sampled = chunks.unzipped(seats["a"], "<i8").reshape(3, -1)
        value = np.concatenate([[0, 1 - discount], c - discount * sampled / SAMPLES]).astype("<f4")
        return table(
            [
                {"kind": "pairs", "chunk": r["chunk"], "bucket": r["bucket"], "a": chunks.zipped(value[chunks.unzipped(r["a"])])}
                for r in rows
                if r["kind"] == "codes"
            ]
        )

    return answer


def scored(
    buckets: int, hot: int, learnt: int, kinds: int, discount: float, parents: list[tuple[float, ...]]
) -> Callable[[dict, list[dict]], pa.Table]:
    def finish(row: dict, answers: list[dict]) -> pa.Table:
        me = Chunk(row, [r for r in answers if r["kind"] == "words"], buckets, hot)
        values = [r for r in answers if r["kind"] == "values"]
        above, tables = (
            np.concatenate([chunks.unzipped(r[k], "<f4").reshape(SAMPLES, -1) for r in values], axis=1).astype(float) for k in ("a", "b")
        )
        seen = np.zeros(len(me.keys))
        pairs = [chunks.unzipped(r["a"], "<f4") for r in answers if r["kind"] == "pairs"]
        seen[me.order] = np.concatenate([np.zeros(0), *pairs])
        back = np.zeros(len(me.keys))
        for parent, value, t in zip(parents, above, tables, strict=True):
            chance = parent_probability(value, parent)
            back += (CONCENTRATION + discount * t[me.context]) * chance[me.word] / SAMPLES
        model = np.log10((seen + back) / (CONCENTRATION + me.n[me.context]))
        base = np.log10((me.n + 1) / (learnt + kinds + 1))
        sizes = me.sizes - 1
        codes = me.codes[me.scored]
        columns = {
            "doc_id": pa.array(row["doc_id"], pa.int64()),
            "held_out": pa.array([remainder(d) == 2 for d in row["doc_id"]]),
            "n_tokens": pa.array(sizes),
            "n_known": pa.array(chunks.runs((me.n[codes] > 0).astype(np.int64), sizes)),
            "base_score": pa.array(sums(base[codes], sizes)),
            "score": pa.array(sums(model[me.at], sizes)),
            "row": pa.array(row["row"], pa.int64()),
            "part": pa.array(row["part"], pa.bool_()),
        }
        return pa.table(columns)

    return finish


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As ``chunks.runs``, but a sum never depends on what stands before it."""
    ends = np.cumsum(sizes)
    return np.array([values[e - n : e].sum() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], float)


def discount_of(once: int, twice: int) -> float:
    """By how many dishes have one and two customers; within bounds where there are few."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def language_scores(docs: DataFrame, chars: int = CHUNK_CHARS, moves: int = MOVES, hot: int = HOT) -> DataFrame:
    """``RESULT`` for every whole text of ``doc_id, text``."""
    buckets = chunks.bucket_count(docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for held in entries(batch.column(0).to_pylist(), batch.column(1).to_pylist(), row, chars):
                yield pa.RecordBatch.from_pylist(token_rows(chunk, held, buckets), TOKEN_ROW)
                chunk += 1
            row += batch.num_rows

    def stats(rows: DataFrame) -> tuple[int, int]:
        x, y = rows.filter("kind = 'stats'").agg(F.sum("x"), F.sum("y")).first()
        return x or 0, y or 0

    spark = docs.sparkSession
    tokens = bucketed(texts_of(docs).mapInArrow(task, TOKENS), "tokens", "chunk")  # read by chunk twice
    rows = spark.table(tokens)
    own = rows.filter("bucket IS NULL").drop("bucket", "words", "n")
    parts = rows.filter("bucket IS NOT NULL").select("chunk", "bucket", "words", "n")
    words = stored(chunks.ask(parts, word_answers(buckets), SAID), "words")
    kinds, learnt = stats(words)
    words = words.filter("kind = 'words'")
    pairs = chunks.together(own, words, pair_rows(buckets, hot), SAID)
    said = stored(chunks.ask(pairs, counted(buckets), SAID), "pairs")
    discount = discount_of(*stats(said))
    codes, seats = said.filter("kind = 'codes'"), said.filter("kind = 'seats'")
    fixed = said.filter("kind IN ('once', 'alone')")
    moving = said.filter("kind = 'dishes'")
    parent, samples, parents = None, [], []
    tables = float(kinds)
    for number in range(BURN_IN + SAMPLES + 1):
        heard = fixed.unionByName(moving) if parent is None else fixed.unionByName(moving).unionByName(parent)
        answer = parent_seated(number, UPPER, tables, kinds, moves)
        told = stored(chunks.ask(heard, answer, SAID), "parent")
        customers, sat = stats(told)
        tables, parent = float(sat), told.filter("kind = 'parent'")
        now = (float(customers), tables, UPPER, kinds)
        if number > BURN_IN:
            samples.append(parent.withColumn("x", F.lit(number).cast("bigint")))
            parents.append(now)
        if number == BURN_IN + SAMPLES:
            break
        sample = number >= BURN_IN
        heard = seats.unionByName(told.filter("kind = 'told'"))
        said = stored(chunks.ask(heard, seated(buckets, number, now, discount, moves, sample), SAID), "seats")
        seats, moving = said.filter("kind = 'seats'"), said.filter("kind IN ('dishes', 'tables')")
    values = words
    for one in samples:
        values = values.unionByName(one)
    answers = words.unionByName(chunks.ask(values, word_values, SAID))
    answers = answers.unionByName(chunks.ask(codes.unionByName(seats), pair_values(discount), SAID))
    schema = RESULT.replace("train_tokens BIGINT, ", "") + ", row BIGINT, part BOOLEAN"
    scores = stored(chunks.together(own, answers, scored(buckets, hot, learnt, kinds, discount, parents), schema), "scores")
    spark.sql(f"DROP TABLE {tokens}")
    figures = ["n_tokens", "n_known", "base_score", "score"]
    cut = scores.filter("part").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in figures))
    whole = scores.filter("NOT part").drop("part", "row").unionByName(cut.drop("row"))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(learnt).cast("bigint").alias("train_tokens"), "base_score", "score")


def op13_pitman_yor_scores(spark, sf_dir):
    return language_scores(documents(spark, sf_dir).select("doc_id", "text"))
