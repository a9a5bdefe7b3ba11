"""Toxicity by averaged embeddings of character n-grams under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import fold, free_name, prepare_workers, slices, training_sample
from ontime.llm.textarrays import lower_bytes, space_bytes, utf8, word_bounds, word_hashes

GRAMS = (3, 4, 5)
BUCKET_BITS = 18
DIMENSION = 4
PER_CLASS = 3000
MAX_CHARS = 20_000
EPOCHS = 15
BATCH = 128
RATE = 0.03
SHRINK = 20
DECAY = 1e-2
CUT = 0.7


def gram_buckets(raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the ``size`` bytes from every position, and whether they lie within one word and its two borders."""
    n = max(len(raw) - size + 1, 0)
    space = space_bytes()[raw]
    low = lower_bytes()[raw].astype(np.uint32)
    low[space] = 32
    h = np.full(n, size, dtype=np.uint32)
    inner = np.zeros(n, dtype=bool)
    for j in range(size):
        h *= np.uint32(0x01000193)
        h += low[j : j + n] * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if 0 < j < size - 1:
            inner |= space[j : j + n]
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h >> np.uint32(32 - BUCKET_BITS), ~inner


@dataclass
class Model:
    """What scoring needs: as the softmax is linear in the average, each bucket has one number."""

    evidence: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        raw, offsets = utf8(column)
        low = lower_bytes()[raw]
        starts, ends, first = word_bounds(raw, offsets)
        _, sample, which = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        letters, borders = _spelled(low, starts[sample], ends[sample])
        of_word = np.zeros((2, len(sample)))
        for size in GRAMS:
            buckets, whole = gram_buckets(letters, size)
            at = np.minimum(borders, len(buckets))
            for row, values in enumerate((np.where(whole, self.evidence[buckets], 0.0), whole)):
                running = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
                of_word[row] += running[at[1:]] - running[at[:-1]]
        totals = np.zeros((2, len(which) + 1))
        np.cumsum(of_word[:, which], axis=1, out=totals[:, 1:])
        sums, counts = totals[:, first[1:]] - totals[:, first[:-1]]
        doc = np.repeat(np.arange(len(column)), np.diff(first))
        pairs = np.unique(doc * max(len(sample), 1) + which)
        distinct = np.bincount(pairs // max(len(sample), 1), minlength=len(column))
        logit = self.bias + sums / np.maximum(counts, 1) * distinct / (distinct + SHRINK)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _spelled(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given words, each between two spaces, in one row of bytes, and where each begins."""
    lengths = ends - starts + 2
    borders = np.concatenate(([0], np.cumsum(lengths)))
    inside = np.arange(borders[-1]) - np.repeat(borders[:-1], lengths)
    place = np.repeat(starts - 1, lengths) + inside
    edge = (inside == 0) | (inside == np.repeat(lengths - 1, lengths))
    place[edge] = 0
    letters = low[place] if len(low) else np.zeros(0, np.uint8)
    letters[edge] = 32
    return letters, borders


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of all texts, their shares within each text, and where each text starts.

    Shares are drawn towards zero for texts of few distinct words, whose average says little. Both grow in one block each,
    eight bytes per bucket of a text, as they are the largest that training keeps.
    """
    places, shares, starts = bytearray(), bytearray(), [0]
    for text in texts:
        raw = np.frombuffer(f" {text} ".encode(), dtype=np.uint8)
        found = []
        for size in GRAMS:
            buckets, whole = gram_buckets(raw, size)
            found.append(buckets[whole])
        ids, times = np.unique(np.concatenate(found), return_counts=True)
        distinct = len(set(lower_bytes()[raw].tobytes().split()))
        places += ids.astype(np.int32).tobytes()
        shares += (times / max(times.sum(), 1) * distinct / (distinct + SHRINK)).astype(np.float32).tobytes()
        starts.append(starts[-1] + len(ids))
    return np.frombuffer(places, np.int32), np.frombuffer(shares, np.float32), np.array(starts)


def fit(texts: list[str], marks: list[int], prior: float, seed: int = 5) -> Model:
    """Train embeddings and softmax together by Adam on shuffled batches of texts.

    ``prior`` is the share of label 1 among all usable labels: the bias is moved from the sample's share to it. With one
    class only, or none, the model answers the prior.
    """
    marks_ = np.asarray(marks, dtype=np.int64)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not texts or marks_.min() == marks_.max():
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(prior / (1 - prior))))
    rng = np.random.default_rng(seed)
    places, shares, starts = _bags(texts)
    # only buckets that occur have parameters in training; the others keep no evidence
    seen = np.zeros(1 << BUCKET_BITS, dtype=bool)
    seen[places] = True
    used, number = np.flatnonzero(seen), np.cumsum(seen) - 1
    embed = rng.normal(0, 0.1, (len(used), DIMENSION)).astype(np.float32)
    soft = rng.normal(0, 1.0, (DIMENSION, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (embed, soft, bias)]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            batch = order[a : a + BATCH]
            lengths = starts[batch + 1] - starts[batch]
            own = np.repeat(np.arange(len(batch)), lengths)
            spots = np.arange(lengths.sum()) + np.repeat(starts[batch] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
            ids, weights = number[places[spots]], shares[spots]
            weighted = embed[ids] * weights[:, None]
            pooled = np.stack([np.bincount(own, weighted[:, d], len(batch)) for d in range(DIMENSION)], 1).astype(np.float32)
            logits = pooled @ soft + bias
            exp = np.exp(logits - logits.max(1, keepdims=True))
            error = exp / exp.sum(1, keepdims=True)
            error[np.arange(len(batch)), marks_[batch]] -= 1
            error /= len(batch)
            back = (error @ soft.T)[own] * weights[:, None]
            grads = (
                np.stack([np.bincount(ids, back[:, d], len(used)) for d in range(DIMENSION)], 1).astype(np.float32)
                + np.float32(DECAY / len(used)) * embed,
                pooled.T @ error, error.sum(0),
            )
            step += 1
            for p, g, (m, v) in zip((embed, soft, bias), grads, state, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    evidence = np.zeros(1 << BUCKET_BITS, np.float32)
    evidence[used] = embed @ (soft[:, 1] - soft[:, 0])
    share = marks_.mean()
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model(evidence, float(bias[1] - bias[0] + shift))


def fit_from(documents: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` usable labelled texts of each class, longer ones than ``MAX_CHARS`` by pieces."""
    rows = training_sample(documents, labels, "toxic", usable, per_class, MAX_CHARS).collect()  # bounded by these
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"]))
    share = labels.where(usable & F.col("toxic").isNotNull()).agg(F.avg("toxic")).first()[0]
    return fit([r["text"] for r in rows], [r["y"] for r in rows], share or 0.0)


def score_texts(documents: DataFrame, model: Model, *keep: str, score_name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score of every whole text (null counts as empty)."""
    prepare_workers(documents.sparkSession)
    whole = free_name(documents, "_whole_text")
    wide = documents.select(*[F.col(f"`{c}`") for c in keep], F.coalesce("text", F.lit("")).alias(whole))
    names = [*keep, score_name]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, whole, 2_000_000):
            found = model.score(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in wide.drop(whole).schema]
    return wide.mapInArrow(scores, ", ".join([*kinds, f"`{score_name}` double"]))


def held_out() -> Column:
    return F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))


def toxicity(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents``.

    Labels of held-out rows (crc32 of the doc_id as text, modulo 3, is 1) are never learned from; only the text enters a
    score. Null and empty texts get the score of the bias; rows that repeat get theirs each; a null doc_id is not held
    out. Without usable labels every score is the prior. Empty table: empty result; other columns are ignored.
    """
    model = fit_from(documents, labels, ~held_out())
    scored = score_texts(documents, model, "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
