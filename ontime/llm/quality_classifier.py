"""Quality by random-indexing word vectors, pooled per document, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import fold, prepare_workers, slices, training_sample
from ontime.llm.textarrays import U64, mix, powers, utf8, word_bounds, word_hashes

BUCKET_BITS = 16
DIMENSION = 64
NONZERO = 4
WINDOW = 2
HIDDEN = 16
PER_CLASS = 3000
MAX_CHARS = 20_000
EPOCHS = 60
CALIBRATION = 0.2
CUT = 0.7

BLOCK = 1 << 16  # words summed at once
BIAS = 32

SHAPE_BASE = 0xA24BAED4963EE407 | 1


def _classes() -> np.ndarray:
    kind = np.full(256, 1, dtype=np.uint8)  # letters, and all bytes of other scripts
    kind[65:91] = 2
    kind[48:58] = 3
    for c in range(128):
        if not chr(c).isalnum():
            kind[c] = 4 + c % 60
    return kind


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word, of its shape (kinds of characters, runs collapsed), and of a direct repetition (else of
    nothing: the last bucket); and where each text's words start."""
    raw, offsets = utf8(column)
    starts, ends, first = word_bounds(raw, offsets)
    shift = U64(64 - BUCKET_BITS)
    words = word_hashes(raw, starts, ends)
    kinds = _classes()[raw]
    change = np.ones(len(raw), dtype=bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[starts] = True
    rank = np.cumsum(change)
    values = np.zeros(len(raw) + 1, dtype=U64)
    if len(starts):
        base = np.repeat(rank[starts], np.diff(np.append(starts, len(raw))))
        place = np.zeros(len(raw), dtype=np.int64)
        place[starts[0] :] = rank[starts[0] :] - base
        np.cumsum(np.where(change, mix(np.arange(256, dtype=U64) + U64(77))[kinds] * powers(SHAPE_BASE, int(place.max()) + 1)[place], U64(0)), out=values[1:])
    shapes = mix(values[ends] - values[starts] + U64(3))
    again = np.zeros(len(words), dtype=bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    repeats = np.where(again, mix(np.array([9], U64)) >> shift, U64((1 << BUCKET_BITS) - 1))
    return ((words >> shift) % U64((1 << BUCKET_BITS) - 1)).astype(np.int64), ((shapes >> shift) % U64((1 << BUCKET_BITS) - 1)).astype(np.int64), repeats.astype(np.int64), first


def index_vectors() -> np.ndarray:
    """Sparse ternary vector of every bucket: ``NONZERO`` random places, half of them negative."""
    n = 1 << BUCKET_BITS
    out = np.zeros((n, DIMENSION), dtype=np.float32)
    for k in range(NONZERO):
        place = (mix(np.arange(n, dtype=U64) * U64(NONZERO) + U64(k + 1)) % U64(DIMENSION)).astype(np.int64)
        out[np.arange(n), place] += 1.0 if k % 2 == 0 else -1.0
    out[-1] = 0
    return out


@cache
def _small_index() -> np.ndarray:
    return index_vectors().astype(np.int8)


def add_neighbours(total: np.ndarray, found: tuple[np.ndarray, ...]) -> None:
    """Add to ``total``, by bucket, the index vectors of all neighbours within ``WINDOW`` words: whole numbers, so that
    neither the cut into blocks nor the order changes a sum."""
    words, shapes, repeats, first = found
    index = _small_index()
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    for a in range(0, len(words), BLOCK):
        b = min(a + BLOCK, len(words))
        lo, hi = max(a - WINDOW, 0), min(b + WINDOW, len(words))
        own = index[words[lo:hi]]  # at most 6 in a place, so 24 in the sum of four neighbours
        own += index[shapes[lo:hi]]
        own += index[repeats[lo:hi]]
        around = np.zeros_like(own)
        for d in range(1, WINDOW + 1):
            around[d:] += own[:-d]
            around[:-d] += own[d:]
            across = np.flatnonzero(doc[lo + d : hi] != doc[lo : hi - d])  # pairs of two texts: taken back
            around[across + d] -= own[across]
            around[across] -= own[across + d]
        # four places to a word of 64 bits: 1,024 rows of 0 to 56 stay within 16 bits
        packed = (around[a - lo : b - lo] + np.int8(BIAS)).astype("<u2").view("<u8")
        for ids in (words, shapes, repeats):
            part = ids[a:b].astype(np.uint16)
            order = np.argsort(part, kind="stable")
            order = order[: np.searchsorted(part[order], (1 << BUCKET_BITS) - 1)]  # not the bucket of nothing
            if len(order):
                part = part[order]
                new = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                run = np.arange(len(part)) - np.repeat(new, np.diff(np.append(new, len(part))))
                starts = np.flatnonzero(run % 1024 == 0)
                sums = np.add.reduceat(packed[order], starts, axis=0).view("<u2").astype(np.int64)
                sums -= BIAS * np.diff(np.append(starts, len(part)))[:, None]
                total[part[new]] += np.add.reduceat(sums, np.searchsorted(starts, new), axis=0)


def unit(total: np.ndarray) -> np.ndarray:
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)


def context_vectors(samples: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Unit vectors of the summed index vectors of all neighbours within ``WINDOW`` words."""
    total = np.zeros((1 << BUCKET_BITS, DIMENSION), dtype=np.int64)
    for found in samples:
        add_neighbours(total, found)
    return unit(total)


def corpus_vectors(documents: DataFrame) -> np.ndarray:
    """The same over every text of ``documents``: each task sums its own, the sums are added by bucket. What reaches the
    driver is one row per bucket, however many documents there are."""
    prepare_workers(documents.sparkSession)
    names = [f"v{j}" for j in range(DIMENSION)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BUCKET_BITS, DIMENSION), dtype=np.int64)
        for batch in slices(batches, "text", 2_000_000):
            add_neighbours(total, terms(batch.column(0)))
        used = np.flatnonzero(total.any(axis=1))
        for a in range(0, len(used), 8192):
            ids = used[a : a + 8192]
            columns = [pa.array(ids.astype(np.int32)), *(pa.array(np.ascontiguousarray(total[ids, j])) for j in range(DIMENSION))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", *names])

    parts = documents.where(F.col("text").isNotNull()).select("text").mapInArrow(
        sums, "bucket int, " + ", ".join(f"{n} long" for n in names)
    )
    found = parts.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    total = np.zeros((1 << BUCKET_BITS, DIMENSION), dtype=np.int64)
    for j, n in enumerate(names):
        total[found["bucket"].to_numpy(), j] = found[n].to_numpy()
    return unit(total)


def pooled(table: np.ndarray, found: tuple[np.ndarray, ...]) -> np.ndarray:
    """Mean over the words of each text of their rows of ``table`` (word, shape and repetition together)."""
    words, shapes, repeats, first = found
    lengths = np.diff(first)
    out = np.zeros((len(lengths), table.shape[1]), dtype=np.float32)
    full = np.flatnonzero(lengths)
    if len(full):
        rows = table[words]
        rows += table[shapes]
        rows += table[repeats]
        out[full] = np.add.reduceat(rows, first[full], axis=0) / lengths[full, None]
    return out


@dataclass
class Model:
    """First layer applied to every bucket's vector beforehand: pooling is linear, so the result is the same."""

    table: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def score(self, column: pa.Array) -> np.ndarray:
        hidden = np.tanh(pooled(self.table, terms(column)) + self.hidden_bias)
        logit = (hidden @ self.out + self.out_bias) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -500, 500)))


def _calibrated(logits: np.ndarray, marks: np.ndarray) -> float:
    """The temperature of the least log-loss, from a fixed grid."""
    def loss(t: float) -> float:
        z = logits / t
        return float(np.mean(np.logaddexp(0, z) - marks * z))

    return min(np.geomspace(0.25, 16, 121), key=loss)


def fit(texts: list[str], marks: list[int], prior: float, seed: int = 11, vectors: np.ndarray | None = None) -> Model:
    """The network on most of the given texts, its temperature on the rest. Without ``vectors`` of a larger corpus, they
    come from these texts.

    ``prior`` is the share of label 1 among all usable labels; the classes are weighted to it. With one class or none the
    model answers the prior.
    """
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    y = np.asarray(marks, dtype=np.float64)
    n_buckets = 1 << BUCKET_BITS
    if not texts or y.min() == y.max():
        flat = np.zeros((n_buckets, HIDDEN), np.float32)
        return Model(flat, np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32), float(np.log(prior / (1 - prior))), 1.0)
    rng = np.random.default_rng(seed)
    samples = [terms(pa.array(texts[a : a + 200], pa.string())) for a in range(0, len(texts), 200)]
    vectors = context_vectors(samples) if vectors is None else vectors
    x = np.concatenate([pooled(vectors, s) for s in samples]).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / scale
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    order = rng.permutation(len(y))
    held, used = order[: int(len(y) * CALIBRATION)], order[int(len(y) * CALIBRATION) :]
    params = [rng.normal(0, DIMENSION**-0.5, (DIMENSION, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for _ in range(EPOCHS):
        for a in range(0, len(used), 64):
            b = rng.choice(used, 64)
            h = np.tanh(x[b] @ params[0] + params[1])
            error = weight[b] * (1 / (1 + np.exp(-(h @ params[2] + params[3]))) - y[b]) / len(b)
            inner = np.outer(error, params[2]) * (1 - h * h)
            grads = [x[b].T @ inner + 1e-4 * params[0], inner.sum(0), h.T @ error + 1e-4 * params[2], np.array([error.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, state, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    logits = np.tanh(x[held] @ params[0] + params[1]) @ params[2] + params[3]
    temperature = float(_calibrated(logits, y[held])) if len(held) else 1.0
    first = params[0] / scale[:, None]
    return Model(
        (vectors @ first).astype(np.float32), (params[1] - mean @ first).astype(np.float32),
        params[2].astype(np.float32), float(params[3][0]), temperature,
    )


def fit_from(documents: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Model:
    """Vectors from all documents, labelled or not; the network on at most ``per_class`` usable labelled texts of each
    class, of at most ``MAX_CHARS`` characters. With fewer than two classes no vectors are needed."""
    rows = training_sample(documents, labels, "quality", usable, per_class, MAX_CHARS).collect()  # bounded by these
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"]))
    share = labels.where(usable & F.col("quality").isNotNull()).agg(F.avg("quality")).first()[0]
    vectors = corpus_vectors(documents) if len({r["y"] for r in rows}) > 1 else None
    return fit([r["text"] for r in rows], [r["y"] for r in rows], share or 0.0, vectors=vectors)


def held_out() -> Column:
    return F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))


def quality(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents``.

    Labels of held-out rows (crc32 of the doc_id as text, modulo 4, is 2) are never learned from; only their texts enter
    the word vectors and their own scores. Null and empty texts pool to nothing and are scored so; rows that repeat get theirs each; a null doc_id is not
    held out. Without usable labels every score is the prior. Empty table: empty result; other columns are ignored.
    """
    model = fit_from(documents, labels, ~held_out())
    prepare_workers(documents.sparkSession)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))], ["doc_id", "score"])

    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(scores, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
