"""Product codes of embeddings: a small codebook per part, fitted over all rows, with nearest entries by memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import prepare_workers, stage
from ontime.llm.textarrays import U64, mix
from ontime.llm.vectors import ROWS_PER_BATCH, matrix, on_grid, shape, sums_over

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6  # fixed by the result contract
LARGEST = 1 << 26  # entries up to here: squared distances with an index appended fit a long
CELLS = 1 << 16  # remembered cells per part and task; beyond it the memory starts anew


def cell_width(codebook: np.ndarray) -> int:
    """Edge of a grid cell: its diagonal is half the typical distance of an entry to its nearest other one."""
    gaps = np.square(codebook[:, None, :] - codebook[None, :, :]).sum(axis=2).astype(np.float64)
    np.fill_diagonal(gaps, np.inf)
    nearest = gaps.min(axis=1) if len(codebook) > 1 else np.ones(1)
    nearest = nearest[np.isfinite(nearest)]
    typical = float(np.sqrt(np.median(nearest))) if len(nearest) else 1.0
    return max(1, int(typical / 2 / np.sqrt(codebook.shape[1])))


class GridCells:
    """Nearest codebook entries of one part position, exact, with the entries worth a look remembered per grid cell.

    A cell is a box of whole numbers. An entry is dominated in it when some other entry's greatest distance to the box is
    smaller than this entry's least distance: it then is nearest to no point of the box, and no tie either. What is left
    is kept as a bit mask under the hash of the cell's coordinates; coordinates are compared, so that two cells of one
    hash are never mixed up. Only the entries of the mask are evaluated.
    """

    def __init__(self, codebook: np.ndarray, width: int | None = None, most: int = CELLS):
        self.codebook, self.most = codebook, most
        self.width = width or cell_width(codebook)
        self.evaluated = self.looked_up = 0
        self._forget()

    def _forget(self) -> None:
        m = self.codebook.shape[1]
        self.keys, self.cells = np.zeros(0, U64), np.zeros((0, m), np.int64)
        self.masks = np.zeros((0, len(self.codebook)), bool)

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        low = cells * self.width
        high = low + (self.width - 1)
        least, most = (np.zeros((len(cells), len(self.codebook)), np.int64) for _ in range(2))
        for e, entry in enumerate(self.codebook):
            below, above = low - entry, entry - high
            least[:, e] = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=1)
            most[:, e] = np.square(np.maximum(-below, -above)).sum(axis=1)
        return least <= most.min(axis=1)[:, None]

    def _hash(self, cells: np.ndarray) -> np.ndarray:
        key = np.zeros(len(cells), U64)
        for column in cells.T:
            key = mix(key * U64(0x9E3779B97F4A7C15) + column.astype(U64))
        return key

    def _masks_of(self, cells: np.ndarray) -> np.ndarray:
        """Masks of cells (rows); unseen ones are worked out once each and remembered."""
        keys, first, which = np.unique(self._hash(cells), return_index=True, return_inverse=True)
        chosen = cells[first]
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = (self.keys[at[inside]] == keys[inside]) & (self.cells[at[inside]] == chosen[inside]).all(axis=1)
        masks = np.empty((len(keys), len(self.codebook)), bool)
        masks[known] = self.masks[at[known]]
        new = ~known
        if new.any():
            masks[new] = self._undominated(chosen[new])
            if len(self.keys) + int(new.sum()) > self.most:
                self._forget()
                at = np.zeros(len(keys), np.int64)
            taken = new & ~np.isin(keys, self.keys)  # of two cells with one hash the first stays
            taken[np.flatnonzero(taken)[self.most :]] = False
            self.keys = np.insert(self.keys, at[taken], keys[taken])
            self.cells = np.insert(self.cells, at[taken], chosen[taken], axis=0)
            self.masks = np.insert(self.masks, at[taken], masks[taken], axis=0)
        out = masks[which]
        other = (cells != chosen[which]).any(axis=1)
        if other.any():  # cells that share a hash within this batch
            out[other] = self._undominated(cells[other])
        return out

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row (the lower one in a tie) and the squared distance to it."""
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        masks = self._masks_of(points // self.width)
        rows, entries = np.nonzero(masks)
        self.evaluated, self.looked_up = self.evaluated + len(rows), self.looked_up + len(points)
        distances = np.square(points[rows] - self.codebook[entries]).sum(axis=1)
        starts = np.searchsorted(rows, np.arange(len(points)))
        best = np.minimum.reduceat(distances * ENTRIES + entries, starts)
        return best % ENTRIES, best // ENTRIES


def _assigner(codebooks: np.ndarray):
    """A function that assigns the parts of a matrix of rows: codes and squared distances, one column per part."""
    cells: list[GridCells] = []

    def assign(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not cells:  # per task, so that what a task remembers ends with it
            cells.extend(GridCells(book) for book in codebooks)
        parts = x.reshape(len(x), len(codebooks), -1)
        found = [grid.nearest(np.ascontiguousarray(parts[:, p, :])) for p, grid in enumerate(cells)]
        return np.column_stack([f[0] for f in found]), np.column_stack([f[1] for f in found])

    return assign


def _fresh(codebooks: np.ndarray):
    """Counts and componentwise sums of the parts assigned to each entry, as one flat array per batch."""
    assign = _assigner(codebooks)
    n_parts, n_entries, m = codebooks.shape

    def of_batch(x: np.ndarray) -> np.ndarray:
        codes, _ = assign(x)
        parts = x.reshape(len(x), n_parts, m)
        out = np.zeros((n_parts, n_entries, m + 1), np.int64)
        for p in range(n_parts):
            order = np.argsort(codes[:, p], kind="stable")
            ordered = codes[order, p]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            out[p, ordered[starts], :m] = np.add.reduceat(parts[order, p, :], starts, axis=0)
            out[p, ordered[starts], m] = np.diff(np.r_[starts, len(ordered)])
        return out

    return of_batch


def fit_codebooks(rows: DataFrame, size: int, n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` rounds over all rows, from the rows with the smallest vec_ids.

    With fewer rows than entries the books have one entry per row. Rows of one vec_id start in the order of their values.
    """
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(n_entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), n_parts, size // n_parts).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = sums_over(rows, size, _fresh(books), np.int64).reshape(n_parts, len(first), -1)
        counts = sums[:, :, -1:]
        books = np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), books)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    embeddings: DataFrame, vector: str = "embedding", n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Every usable vector as ``n_parts`` indexes into codebooks that are fitted over all of them.

    Rows whose vector is null or holds null or non-finite entries are dropped; an entry x becomes floor(4096 x). Returns
    vec_id, code (two hex digits per part), error (squared distances to the chosen entries, summed over the parts),
    label_error (error summed over rows of the same label, nulls together) and codebooks_sha256.

    All arithmetic is on whole numbers, so results do not depend on the partitioning. Ties go to the lower index; entries
    that nothing is assigned to stay. Rows of one vec_id are kept each. Vectors of different lengths, lengths that are no
    multiple of ``n_parts`` and entries beyond ``LARGEST`` / 4096 are errors. Empty table or no usable row: empty
    result; other columns are ignored.
    """
    if not 1 <= n_entries <= ENTRIES:
        raise ValueError(f"a codebook has 1 to {ENTRIES} entries")
    spark = embeddings.sparkSession
    kinds = dict(embeddings.dtypes)
    rows = on_grid(embeddings, vector, SCALE, 0, "vec_id", "label")
    n, size, largest = shape(rows)
    if not n or not size:
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    if size % n_parts:
        raise ValueError(f"{size} entries cannot be cut into {n_parts} equal parts")
    if largest > LARGEST:
        raise ValueError(f"entries of up to {largest} / {SCALE} are too large for exact distances")
    books = fit_codebooks(rows, size, n_parts, n_entries, rounds)
    assign = _assigner(books)
    prepare_workers(spark, ROWS_PER_BATCH)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = assign(matrix(batch, size))
            texts = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts), pa.array(errors.sum(axis=1))], ["vec_id", "label", "code", "error"]
            )

    fields = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    coded = stage(rows.mapInArrow(encode, fields), "codes")
    # written, so that its size is known: small it is broadcast, else a hot label is split by the adaptive skew join
    sums = stage(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
