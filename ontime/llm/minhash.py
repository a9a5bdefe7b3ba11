"""Near-duplicate texts: minima of many universal hashes in bands, checks on signatures and full sets, components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import prepare_workers, slices, stage
from ontime.llm.components import connected_components
from ontime.llm.textarrays import U64, lower_bytes, mix, utf8, word_bounds, word_hashes

WORDS = 5
SIMILARITY = 80
BANDS = 32
ROWS = 4
BLOCK = 1024
FINE = 1024
_HASHES = BANDS * ROWS


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64))
    return (seeds[:n] | U64(1)).astype(np.uint32)[:, None], seeds[n:].astype(np.uint32)[:, None]


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles, A-Z lower-cased; the whole sequence if it is shorter."""
    raw, offsets = utf8(column)
    raw = lower_bytes()[raw]
    starts, ends, first = word_bounds(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    n = len(hashes)
    factors = mix(np.arange(101, 101 + words, dtype=U64)) | U64(1)
    rolled = np.zeros(max(n - words + 1, 0), dtype=U64)
    for j in range(words):
        rolled += mix(hashes[j : n - words + 1 + j] * factors[j] + U64(j)) if len(rolled) else U64(0)
    rolled = mix(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            # lengths below a full shingle get a start value of their own
            own = mix(np.array([b - a], U64))
            for j in range(b - a):
                own = mix(own * factors[j] + hashes[a + j])
            yield own
        else:
            yield np.zeros(0, U64)


def minima(shingles: np.ndarray, n: int = _HASHES) -> np.ndarray:
    """The least value of each of ``n`` universal hashes a * x + b modulo 2**32 over the set."""
    a, b = _coefficients(n)
    x = (shingles >> U64(32)).astype(np.uint32)
    low = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    step = (1 << 18) // n
    for start in range(0, len(x), step):
        low = np.minimum(low, (a * x[None, start : start + step] + b).min(axis=1))
    return low


def _band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ``ROWS`` minima; the band's number goes in, so that bands do not meet."""
    keys = np.arange(1, BANDS + 1, dtype=U64)
    for column in low.reshape(BANDS, ROWS).T:
        keys = mix(keys + column)
    return keys.view(np.int64)


def _sketches(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, bits): set_key is a 128-bit digest of the whole set, null without words.

    bands holds the bands' keys, bits the lowest byte of every minimum; the minima themselves are not needed later.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sizes, keys, bands, bits = [], [], [], []
            for found in shingle_sets(batch.column(1), words):
                sizes.append(len(found))
                low = minima(found) if len(found) else None
                keys.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                bands.append(_band_keys(low) if len(found) else None)
                bits.append((low & np.uint32(255)).astype(np.uint8).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["doc_id", "n_shingles", "set_key", "bands", "bits"],
            )

    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(sketch, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>, bits binary")


def _least_agreement(similarity: int, n: int) -> float:
    """Equal entries of two signatures of ``n``: a pair at the threshold falls short with a chance under 1e-9."""
    s = similarity / 100
    return n * s - 6.5 * (n * s * (1 - s)) ** 0.5


def _near(n_a: np.ndarray, n_b: np.ndarray, similarity: int) -> np.ndarray:
    return 100 * np.minimum(n_a, n_b) >= similarity * np.maximum(n_a, n_b)


def _agreeing(pairs: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose signatures and set sizes allow the similarity."""
    sides = [sketches.select(F.col("doc_id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]
    fits = F.lit(100) * F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b")
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(fits).select("a", "b", "bits_a", "bits_b")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select("a", "b").schema)
    least = _least_agreement(similarity, _HASHES)

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, _HASHES) for i in (2, 3))
                keep = pa.array((x == y).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(agree, kinds)


def _confirmed(pairs: DataFrame, documents: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked: 100 * shared >= similarity * all."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    wanted = stage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            found = [s.tobytes() for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "shingles"])

    texts = documents.join(wanted, "doc_id", "left_semi").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    full = stage(texts.mapInArrow(sets, f"doc_id {kind}, shingles binary"), "sets")
    sides = [full.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "set_a", "set_b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(x, y, similarity) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["a", "b"])

    return both.mapInArrow(confirm, f"a {kind}, b {kind}")


def _open_links(
    members: DataFrame, sketches: DataFrame, components: DataFrame, documents: DataFrame, words: int, similarity: int
) -> DataFrame:
    """Links (a, b) between documents that share a bucket but no component yet.

    A bucket is cut into blocks of about ``BLOCK`` members, and each pair of blocks is one small piece of work, so a bucket
    of any size is searched completely by many tasks. A pair is looked at in the first band alone that it shares. Here the
    documents bring signatures of ``FINE`` hashes and their full sets along, so that only confirmed links come out, and of
    these no more than join the components of a piece.
    """
    kind = sketches.schema["doc_id"].dataType.simpleString()
    placed = stage(
        members.join(components, members["doc_id"] == components["node"], "left").select(
            "bucket", "band", "doc_id", F.coalesce("component", "doc_id").alias("own")
        ),
        "placed",
    )
    mixed = placed.groupBy("bucket").agg(F.min("own").alias("_lo"), F.max("own").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    mixed = mixed.where("_lo <> _hi").select("bucket", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    left = stage(placed.join(mixed, "bucket"), "open")

    def fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets = list(shingle_sets(batch.column(1), words))
            found = [(minima(s, FINE) & np.uint32(255)).astype(np.uint8).tobytes() for s in sets]
            full = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), full], ["doc_id", "fine", "shingles"])

    texts = documents.join(stage(left.select("doc_id").distinct(), "wanted"), "doc_id", "left_semi")
    signed = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(fine, f"doc_id {kind}, fine binary, shingles binary")
    known = stage(sketches.select("doc_id", "n_shingles", "bands").join(signed, "doc_id"), "signed")

    mine = F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    spread = left.withColumn("_mine", mine).withColumn("_other", other)
    piece = F.xxhash64("bucket", F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    rows = spread.select(piece.alias("piece"), "band", "doc_id", "own").join(known, "doc_id")
    least = _least_agreement(similarity, FINE)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            pieces = table.column(0).to_numpy()
            last = int(np.searchsorted(pieces, pieces[-1])) if len(pieces) else 0  # the last piece may go on
            if last:
                yield from _pairs_within(table.slice(0, last), least, similarity)
            held = table.slice(last).to_batches()
        if held:
            yield from _pairs_within(pa.Table.from_batches(held), least, similarity)

    ordered = rows.select("piece", "band", "doc_id", "own", "n_shingles", "bands", "fine", "shingles")
    return ordered.repartition("piece").sortWithinPartitions("piece").mapInArrow(search, f"a {kind}, b {kind}").distinct()


def _pairs_within(table: pa.Table, least: float, similarity: int) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    pieces, bands, ids, own, sizes = (table.column(i).to_numpy() for i in range(5))
    keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    bits = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
    sets = table.column("shingles").combine_chunks()
    cuts = np.flatnonzero(np.diff(pieces)) + 1
    links = []
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(pieces)])), strict=True):
        roots: dict[int, int] = {}

        def root(component: int, roots: dict[int, int] = roots) -> int:
            while component in roots:
                component = roots[component]
            return component

        for i in range(a, b - 1):
            rest = slice(i + 1, b)
            fit = np.flatnonzero((own[rest] != own[i]) & _near(sizes[rest], sizes[i], similarity)) + i + 1
            if not len(fit):
                continue
            fit = fit[np.argmax(keys[fit] == keys[i], axis=1) == bands[i]]
            for j in fit[(bits[fit] == bits[i]).sum(axis=1) >= least]:
                x, y = root(own[i]), root(own[j])
                if x != y and _similar(sets[i], sets[j], similarity):
                    roots[max(x, y)] = min(x, y)
                    links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    if links:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])


def _similar(x: pa.BinaryScalar, y: pa.BinaryScalar, similarity: int) -> bool:
    p, q = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
    shared = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * shared >= similarity * (len(p) + len(q) - shared)


def near_duplicates(documents: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``documents`` (doc_id a whole number, text).

    A text's set holds its distinct shingles of ``words`` words; two documents are linked when the shared part of their
    sets is at least ``similarity`` percent of the joint one; component_id is the smallest doc_id that links reach.

    Equal sets are one class, which takes part once, whatever its size. Classes with equal minima in one of ``BANDS`` bands
    of ``ROWS`` hashes share a bucket (at the least similarity of 80 percent a pair misses all bands with a chance of
    5e-8). First each bucket's members are compared with one of them, another in each bucket, and components are built.
    Buckets that then still hold several components are searched for links between these, block by block. No pairs are dropped or capped,
    and pairs within a component need no comparison.

    Texts without words, and null texts, are linked with nothing; a null doc_id neither (its component is null, kept
    true). Rows that repeat a doc_id with the same text are equal; doc_ids are meant to be unique, and rows that repeat one
    with other texts are linked by any of these. Empty table: empty result; other columns are ignored.
    """
    prepare_workers(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stage(_sketches(documents, words), "sketches")
    usable = sketches.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    # Equal sets have equal sketches, so any row brings the sketch of its class.
    same = [F.first(c).alias(c) for c in ("n_shingles", "bands", "bits")]
    single = stage(usable.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), *same), "single")
    classes = single.select("set_key", F.col("doc_id").alias("first"))

    buckets = single.select("doc_id", F.posexplode("bands").alias("band", "bucket"))
    # The member that is smallest after its number is crossed with the bucket's: a different one in each bucket.
    crossed = F.col("doc_id").bitwiseXOR(F.col("bucket"))
    centers = buckets.groupBy("bucket").agg(F.min(crossed).alias("_low"), F.max(crossed).alias("_high"))
    shared = centers.where("_low <> _high").select("bucket", F.col("_low").bitwiseXOR(F.col("bucket")).alias("center"))
    members = stage(buckets.join(shared, "bucket"), "members")

    stars = members.where("doc_id <> center").select(F.least("center", "doc_id").alias("a"), F.greatest("center", "doc_id").alias("b")).distinct()
    agreed = stage(_agreeing(stars, single, similarity), "agreed")
    links = stage(_confirmed(agreed, documents, words, similarity), "links")
    components = connected_components(links)
    more = stage(_open_links(members.drop("center"), single, components, documents, words, similarity), "links")
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))

    named = classes.join(components, classes["first"] == components["node"], "left")
    groups = stage(named.select("set_key", F.coalesce("component", "first").alias("component_id")), "groups")
    joined = sketches.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
