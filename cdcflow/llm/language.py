"""Language identification by sparse multinomial logistic regression on TF-IDF of character n-grams.

A text is the shares of its hashed n-grams (1 to ORDERS characters, lower-cased), weighted by inverse document
frequency over all training documents. Weights are fitted by follow-the-regularised-leader with L1 and L2 penalties, on
at most PER_LABEL documents a label; a fifth of these is set apart to fit the temperature that calibrates the scores.
Counting and prediction run over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, small_batches
from .tokens import slices

ORDERS, BUCKETS, SCALE = 3, 1 << 15, 30.0
PER_LABEL, EPOCHS = 600, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"
SEPARATOR = "\0"


def ngrams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order, the bucket at each character of the joined texts, 0 where the n-gram leaves its text; and where
    each text ends."""
    joined = "".join(t.lower() + SEPARATOR for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    inside = codes != 0
    ends = np.flatnonzero(~inside) + 1
    # A zero in a text itself only cuts an n-gram there; text ends are counted from lengths.
    if len(ends) != len(texts):
        ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    out, value = [], np.zeros(len(codes), np.uint64)
    whole = np.ones(len(codes), bool)
    for k in range(ORDERS):
        shifted = np.append(codes[k:], np.zeros(k, np.uint64))
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(k + 1)
        whole &= np.append(inside[k:], np.zeros(k, bool))
        mixed = (value ^ (value >> np.uint64(32))) * np.uint64(0xD1342543DE82EF95)
        out.append(np.where(whole, (mixed >> np.uint64(40)) % np.uint64(BUCKETS - 1) + np.uint64(1), np.uint64(0)).astype(np.int32))
    return out, ends


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and how many there are; BUCKETS numbers come to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts, 300_000):
                orders, ends = ngrams(texts[a:b])
                for start, end in zip([0, *ends.tolist()], ends.tolist(), strict=False):
                    present = np.zeros(BUCKETS, bool)
                    for buckets in orders:
                        present[buckets[start:end]] = True
                    counts += present
            n += len(texts)
        counts[0] = n  # bucket 0 is no n-gram
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(task, "bucket BIGINT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():
        out[row.bucket] = row.n
    return out, int(out[0])


def sampled(docs: DataFrame, per_label: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """About ``per_label`` documents of each label, by a hash of the document: label, buckets, shares."""
    counts = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}
    if not counts:
        return []
    rate = F.create_map(*(F.lit(x) for label, n in counts.items() for x in (label, min(1.0, per_label / n))))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # Equal texts of one label teach nothing more, and might be many.
    chosen = docs.filter(part < rate[F.col("lang")]).select("lang", "text").dropDuplicates()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                orders, _ = ngrams([text])
                buckets, n = np.unique(np.concatenate(orders), return_counts=True)
                buckets, n = buckets[buckets > 0], n[buckets > 0]
                found.append((buckets.astype("<i4").tobytes(), (n / max(1, n.sum())).astype("<f4").tobytes()))
            names, shares = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), pa.array(shares, pa.binary())], ["lang", "buckets", "shares"])

    rows = chosen.mapInArrow(task, "lang STRING, buckets BINARY, shares BINARY").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.buckets)))
    return [(r.lang, np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.shares, "<f4")) for r in rows]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fitted(rows: list[tuple[int, np.ndarray, np.ndarray]], labels: int) -> np.ndarray:
    """Weights (BUCKETS, labels) by FTRL-proximal; bucket 0, which no text has, is the bias of all."""
    z, n = np.zeros((BUCKETS, labels)), np.zeros((BUCKETS, labels))

    def weights(at):
        return np.where(np.abs(z[at]) <= L1, 0, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)).tolist():
            label, at, x = rows[i]
            w = weights(at)
            miss = softmax(x @ w)
            miss[label] -= 1
            g = x[:, None] * miss
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of logits that makes held-out labels most likely, by golden section on its logarithm.

    Each label counts as if one imagined document more had another, so that a faultless sample gives no certainty.
    """
    doubt = 1 / (len(labels) + 2)

    def loss(t: float) -> float:
        log_p = np.log(np.maximum(softmax(logits / math.exp(t)), 1e-12))
        own = log_p[np.arange(len(labels)), labels]
        others = (log_p.sum(axis=1) - own) / max(1, log_p.shape[1] - 1)
        return float(-((1 - doubt) * own + doubt * others).mean())

    a, b, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    while len(labels) and b - a > 1e-3:
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return math.exp((a + b) / 2) if len(labels) else 1.0


def train(docs: DataFrame, per_label: int = PER_LABEL) -> tuple[list[str], np.ndarray] | None:
    """Labels and the weight of each bucket for each, temperature and inverse document frequency included; None without
    a labelled text. ``docs`` has ``doc_id, text, lang``."""
    docs = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    counts, total = document_counts(docs)
    if not total:
        return None
    idf = SCALE * (np.log((1 + total) / (1 + counts)) + 1)
    rows = sampled(docs, per_label)
    labels = sorted({label for label, _, _ in rows})
    ready = [
        (labels.index(label), np.append(0, at), np.append(1.0, shares * idf[at])) for label, at, shares in rows
    ]
    held = [r for i, r in enumerate(ready) if i % 5 == 4]
    weights = fitted([r for i, r in enumerate(ready) if i % 5 != 4], len(labels))
    logits = np.array([x @ weights[at] for _, at, x in held]).reshape(-1, len(labels))
    heat = temperature(logits, np.array([r[0] for r in held], np.int64))
    weights[1:] *= idf[1:, None]
    return labels, (weights / heat).astype(np.float32)


def predicted(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``; a null text, or one without letters, is UNKNOWN with 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights = shared.value or ([], None)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if labels and any(map(str.isalpha, t or ""))]
            for a, b in slices([texts[i] for i in known], 300_000):
                own = known[a:b]
                orders, ends = ngrams([texts[i] for i in own])
                starts = np.append(0, ends[:-1])
                total = np.zeros((len(own), len(labels)))
                n = np.zeros(len(own), np.int64)
                for buckets in orders:
                    values = weights[buckets]
                    values[buckets == 0] = 0
                    total += np.add.reduceat(values, starts, axis=0, dtype=np.float64)
                    n += np.add.reduceat(buckets > 0, starts, dtype=np.int64)
                p = softmax(total / np.maximum(n, 1)[:, None] + weights[0])
                best = p.argmax(axis=1)
                scores[own] = p.max(axis=1)
                for i, k in zip(own, best.tolist(), strict=True):
                    names[i] = labels[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"])

    kept = docs.select(*keep, "text")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*keep).schema)
    return kept.mapInArrow(task, f"{fields}, lang_pred STRING, score DOUBLE")


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row.

    Documents whose CRC-32 of the doc_id leaves 2 modulo 4 are held out of training, and so are null doc_ids (which are
    not marked as held out), null texts and null labels. Rows that repeat count in the document frequencies as often as
    they stand there, and once in the weights. Without a labelled text all is UNKNOWN.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = train(docs.filter(rest != 2))
    return predicted(docs.withColumn("held_out", F.coalesce(rest == 2, F.lit(False))), model, ["doc_id", "held_out"])


def op3_language_id(spark, sf_dir):
    return identified(documents(spark, sf_dir))
