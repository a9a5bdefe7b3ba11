"""SentencePiece encoding by sampling distinct segmentations (Gumbel top-k over the lattice), and decoding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import prepare_workers, slices
from ontime.llm.textarrays import BASE, INVERSE, U64, mix, powers, utf8

SAMPLES = 2
SLICE_BYTES = 3_000_000
PREFIX = -3
GRID = 2.0**24
BYTE_LOG_PROB = -14.0
_MARK = 0x2581  # the piece alphabet's sign for a space
_LITERAL = 0x110000  # stands for that sign where the text itself has it
_SLOTS = 19


class Vocabulary:
    """Pieces of a SentencePiece model with byte pieces, ready for lookups of many substrings at once.

    The model's scores are ranks of merges; a piece of rank r has the log-probability of Zipf's law, -log(r + 2), less the
    same constant for all. Characters without a piece are spelled in byte pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        usual = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in usual]
        ranks = np.argsort(np.argsort([-model.get_score(i) for i in usual], kind="stable"), kind="stable")
        logs = -np.log(ranks + 2.0)
        logs -= np.log(np.exp(logs).sum())
        self.ids = np.full(n, 0.0)
        self.ids[usual] = logs
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.known = np.zeros(_LITERAL + 1, dtype=bool)
        for piece in pieces:
            self.known[[ord(c) for c in piece]] = True
        spelled = [b""] * n
        for i, piece in zip(usual, pieces, strict=True):
            spelled[i] = piece.replace(chr(_MARK), " ").encode()
        for b, i in enumerate(self.byte_ids):
            spelled[i] = bytes([b])
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.spelling = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        found = {p[:n]: PREFIX for p in pieces for n in range(1, len(p))} | dict(zip(pieces, usual, strict=True))
        keys = np.array([_hash_one(p) for p in found], dtype=U64)
        self._fill(keys, np.array(list(found.values()), dtype=np.int32))

    def _fill(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """Two tables: most keys have a slot to themselves in the first, the rest in the second."""
        size = 1 << _SLOTS
        slot = (keys >> U64(64 - _SLOTS)).astype(np.int64)
        _, first = np.unique(slot, return_index=True)
        rest = np.setdiff1d(np.arange(len(keys)), first)
        self.tables = [(np.zeros(size, U64), np.full(size, -1, np.int32))]
        self.tables[0][0][slot[first]], self.tables[0][1][slot[first]] = keys[first], ids[first]
        self.second_bits = 21
        for factor in range(3, 20001, 2):
            self.factor = mix(np.array([factor], U64))[0] | U64(1)
            place = ((keys[rest] * self.factor) >> U64(64 - self.second_bits)).astype(np.int64)
            if len(np.unique(place)) == len(rest):
                break
        else:
            raise ValueError("no free places for all pieces")
        self.tables.append((np.zeros(1 << self.second_bits, U64), np.full(1 << self.second_bits, -1, np.int32)))
        self.tables[1][0][place], self.tables[1][1][place] = keys[rest], ids[rest]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Id of each substring; ``PREFIX`` if it only begins longer pieces, -1 if there is none."""
        slot = (keys >> U64(64 - _SLOTS)).astype(np.int64)
        found = np.where(self.tables[0][0][slot] == keys, self.tables[0][1][slot], np.int32(-1))
        missed = np.flatnonzero(found == -1)
        again = keys[missed]
        slot = ((again * self.factor) >> U64(64 - self.second_bits)).astype(np.int64)
        found[missed] = np.where(self.tables[1][0][slot] == again, self.tables[1][1][slot], np.int32(-1))
        return found


def _codes(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(U64) + U64(1))


def _hash_one(piece: str) -> np.uint64:
    points = np.array([ord(c) for c in piece], dtype=np.uint32)
    return mix(np.sum(_codes(points) * powers(BASE, len(points)), dtype=U64, keepdims=True))[0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _hashed(key: np.ndarray, *parts) -> np.ndarray:
    h = key
    for part in parts:
        h = mix(h ^ (np.atleast_1d(part).astype(U64) * U64(0x9E3779B97F4A7C15) + U64(0x632BE59BD9B4E019)))
    return h


def _uniform(key: np.ndarray, *parts) -> np.ndarray:
    return ((_hashed(key, *parts) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


@dataclass
class Lattices:
    """The lattices of the distinct units of some texts, laid side by side; no piece crosses a unit's border.

    ``edge`` and ``log`` hold piece and log-probability by position and length (-2 - c: character c in bytes); ``beta`` the
    log of the summed probabilities of all ways from a position to the unit's end; ``upto`` the running shares of the
    lengths in that sum; ``several`` whether a position has more than one piece.
    """

    unit_of_doc: np.ndarray
    begins: np.ndarray
    edge: np.ndarray
    log: np.ndarray
    beta: np.ndarray
    upto: np.ndarray
    several: np.ndarray

    def shares(self, place: np.ndarray) -> np.ndarray:
        """The share of every length at the given positions, also where it is too small for ``upto``."""
        width = self.log.shape[1]
        out = np.zeros(len(place) * width)
        spots = np.flatnonzero(self.edge[place] != -1)  # few lengths have a piece: the others stay 0
        who = spots // width
        length = spots - who * width
        at = place[who]
        out[spots] = np.exp(self.log[at, length].astype(np.float64) + self.beta[at + length + 1] - self.beta[at])
        return out.reshape(-1, width)


def build_lattices(texts: Sequence[str], words: Vocabulary) -> Lattices:
    joined = "".join([" " + t for t in texts if t])
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
    points[points == _MARK] = _LITERAL
    points[points == 32] = _MARK
    lengths = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    borders = np.concatenate(([0], np.cumsum(lengths)))
    n = len(points)
    known = words.known[points]
    start = np.zeros(n + 1, dtype=bool)
    if n:
        mark = points == _MARK
        start[0] = True
        start[1:n] = (mark[1:] & ~mark[:-1]) | ~known[1:] | ~known[:-1]
    start[borders] = True
    begins = np.flatnonzero(start[:n])
    sizes = np.diff(np.append(begins, n))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(_codes(points) * powers(BASE, n), dtype=U64)))
    hashes = mix((sums[begins + sizes] - sums[begins]) * powers(INVERSE, n + 1)[begins])
    _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)

    size = sizes[sample]
    offsets = np.concatenate(([0], np.cumsum(size + 1)))  # each unit has one place more, its end
    total = int(offsets[-1])
    inside = np.arange(total) - np.repeat(offsets[:-1], size + 1)
    left = np.repeat(size, size + 1) - inside
    at = np.minimum(np.repeat(begins[sample], size + 1) + inside, max(n - 1, 0))
    active, length, hits = np.flatnonzero(left > 0), 0, []
    origin = at[active]
    before, scale = sums[origin], powers(INVERSE, n + 1)[origin]
    while len(active):  # only substrings that begin some piece are looked at further
        length += 1
        found = words.find(mix((sums[origin + length] - before) * scale))
        hit = found >= 0
        hits.append((active[hit], found[hit]))
        more = np.flatnonzero((found != -1) & (left[active] > length))
        active, origin, before, scale = active[more], origin[more], before[more], scale[more]
    width = max((i for i, (place, _) in enumerate(hits, 1) if len(place)), default=1)
    edge = np.full((total, width), -1, dtype=np.int32)
    log = np.full((total, width), -np.inf, dtype=np.float32)
    for i, (place, found) in enumerate(hits[:width]):
        edge[place, i] = found
        log[place, i] = words.ids[found]
    bare = np.flatnonzero((left > 0) & (edge[:, 0] < 0))
    edge[bare, 0] = -2 - points[at[bare]].astype(np.int32)
    log[bare, 0] = BYTE_LOG_PROB * _n_bytes(points[at[bare]])

    beta = np.zeros(total)
    upto = np.ones((total, width), dtype=np.float32)
    order = np.argsort(left, kind="stable")
    cuts = np.searchsorted(left[order], np.arange(1, int(size.max(initial=0)) + 2))
    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), 1):
        place, k = order[a:b], min(width, r)
        ways = log[place, :k] + beta[place[:, None] + np.arange(1, k + 1)]
        most = ways.max(axis=1, keepdims=True)
        shares = np.exp((ways - most).astype(np.float32))
        running = np.cumsum(shares, axis=1)  # one after the other: the same whatever the width
        whole = running[:, -1:].copy()
        beta[place] = most[:, 0] + np.log(whole[:, 0].astype(np.float64))
        running /= whole
        last = k - 1 - np.argmax(shares[:, ::-1] > 0, axis=1)
        running[np.arange(k) >= last[:, None]] = 1.0  # whatever the rounding, no length without a piece is drawn
        upto[place, :k] = running
    docs = np.searchsorted(begins, borders)
    return Lattices(docs, offsets[:-1][which], edge, log, beta, upto, (edge != -1).sum(axis=1) > 1)


def _n_bytes(points: np.ndarray) -> np.ndarray:
    p = np.where(points == _LITERAL, _MARK, points)
    return 1 + (p >= 0x80) + (p >= 0x800) + (p >= 0x10000)


@dataclass
class Path:
    """One segmentation of every text (``rows``): pieces by place and length in reading order.

    ``arrival`` holds, for each piece, when the best of the segmentations that first leave the path there would arrive
    (the perturbed bound: minus the log of the arrival is its Gumbel value), ``mass`` their probability, ``taken`` the
    lengths that are spoken for at that place.
    """

    first: np.ndarray
    unit: np.ndarray
    place: np.ndarray
    length: np.ndarray
    arrival: np.ndarray
    mass: np.ndarray
    taken: np.ndarray
    log_prob: np.ndarray
    born: np.ndarray
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _walk(lattices: Lattices, units: np.ndarray, starts: np.ndarray, keys: np.ndarray, salt: int):
    """Draw pieces from each start to the end of its unit: (unit, place, length), in order of units and within them."""
    now, active = starts.copy(), np.arange(len(units))
    ends = lattices.edge[:, 0] == -1
    drawn = _hashed(keys, salt, units)  # the same at every step
    steps = []
    step = 0
    while True:
        active = active[~ends[now[active]]]
        if not len(active):
            break
        place = now[active]
        u = _uniform(drawn[active], step).astype(np.float32)
        length = 1 + (u[:, None] <= lattices.upto[place]).argmax(axis=1)  # the first running share that u does not exceed
        steps.append((active, place, length))
        now[active] = place + length
        step += 1
    if not steps:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    who = np.concatenate([s[0] for s in steps])
    counts = np.bincount(who, minlength=len(units))
    base = np.cumsum(counts) - counts
    slot = base[who] + np.repeat(np.arange(len(steps)), [len(s[0]) for s in steps])
    place, length = np.empty(len(who), np.int64), np.empty(len(who), np.int64)
    place[slot] = np.concatenate([s[1] for s in steps])
    length[slot] = np.concatenate([s[2] for s in steps])
    return np.repeat(units, counts), place, length


def _finish(lattices: Lattices, rows, first, unit, place, length, open_from, born, keys, salt) -> Path:
    """Bounds of all departures from a path; those before ``open_from`` (per text) belong to the path it left."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(rows)), counts)
    log_q = lattices.log[place, length - 1] + lattices.beta[place + length] - lattices.beta[place]
    log_q = np.round(log_q * GRID) / GRID  # sums are exact then, and do not depend on the texts of the batch
    running = np.concatenate(([0.0], np.cumsum(log_q)))
    before = running[:-1] - running[first[:-1]][doc]
    index = np.arange(len(doc)) - first[:-1][doc]
    # beyond this depth a set's bound is e**60 times later than that of the set it was split from: it is never the best
    likely = np.flatnonzero((before > -60.0) & (index >= open_from[doc]) & lattices.several[place])
    mass, arrival = np.zeros(len(doc)), np.full(len(doc), np.inf)
    other = -np.expm1(log_q[likely])
    near = np.flatnonzero(other < 1e-4)  # the difference to 1 is rounded here: the other pieces are summed
    spot = likely[near]
    rest = lattices.shares(place[spot])
    rest[np.arange(len(spot)), length[spot] - 1] = 0.0
    other[near] = rest.sum(axis=1)
    mass[likely] = np.exp(before[likely]) * other
    wait = -np.log(_uniform(keys[doc[likely]], salt + 1, index[likely]))
    arrival[likely] = born[doc[likely]] + wait / mass[likely]
    taken = (1 << (length - 1)).astype(np.int64)
    total = np.add.reduceat(np.append(log_q, 0.0), np.minimum(first[:-1], len(log_q))) * (counts > 0) + 0.0
    return Path(first, unit, place, length, arrival, mass, taken, total, born, rows)


def sample_paths(lattices: Lattices, keys: np.ndarray, k: int) -> tuple[list[Path], np.ndarray]:
    """Up to ``k`` distinct segmentations of every text in order of their perturbed log-probability, and the arrival of the
    best one that is left (infinite when there is none).

    Best-first search over sets of segmentations: each set's bound is its arrival, an exponential waiting time of the set's
    probability that starts with the set it was split from. The best set is split into the segmentation drawn from it, which
    arrives with the set, and the sets that leave that segmentation at each of its pieces.
    """
    n = len(keys)
    units = np.arange(len(lattices.begins))
    owner = np.repeat(np.arange(n), np.diff(lattices.unit_of_doc))
    local = units - lattices.unit_of_doc[:-1][owner]
    unit, place, length = _walk(lattices, local, lattices.begins, keys[owner], 1)
    # places of the walk come in order of units, so texts follow each other
    pieces = np.bincount(np.repeat(owner, _per_unit(lattices, local, place, length)), minlength=n)
    first = np.concatenate(([0], np.cumsum(pieces)))
    born = -np.log(_uniform(keys, 0))
    rows = np.arange(n)
    paths = [_finish(lattices, rows, first, unit, place, length, np.zeros(n, np.int64), born, keys, 2)]
    for number in range(1, k):
        chosen = _best(paths, n)
        live = np.flatnonzero(np.isfinite(chosen[0]))
        if not len(live):
            break
        paths.append(_leave(lattices, paths, live, *(c[live] for c in chosen), keys, 4 * number + 1))
    return paths, _best(paths, n)[0]


def _per_unit(lattices: Lattices, local, place, length) -> np.ndarray:
    """Pieces per unit occurrence: a unit ends where the next place has no edge."""
    last = lattices.edge[place + length, 0] == -1
    ends = np.flatnonzero(last)
    return np.diff(np.concatenate(([-1], ends)))


def _best(paths: list[Path], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Earliest arrival of each text, the path it is on and the piece where it leaves."""
    when, which, where = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for number, path in enumerate(paths):
        counts = np.diff(path.first)
        full = np.flatnonzero(counts)
        if not len(full):
            continue
        least = np.minimum.reduceat(path.arrival, path.first[full])
        doc = np.repeat(np.arange(len(full)), counts[full])
        hits = np.flatnonzero(path.arrival == least[doc])
        _, one = np.unique(doc[hits], return_index=True)
        spot = hits[one] - path.first[full]
        rows = path.rows[full]
        better = least < when[rows]
        when[rows[better]], which[rows[better]], where[rows[better]] = least[better], number, spot[better]
    return when, which, where


def _leave(lattices: Lattices, paths: list[Path], live, when, which, where, keys, salt) -> Path:
    """The segmentations drawn from the sets that leave their paths at the given pieces."""
    heads = []
    for number, path in enumerate(paths):
        mine = np.flatnonzero(which == number)
        if not len(mine):
            continue
        own = np.searchsorted(path.rows, live[mine])
        spot = path.first[own] + where[mine]
        place = path.place[spot]
        width = lattices.upto.shape[1]
        shares = lattices.shares(place)
        shares *= (path.taken[spot][:, None] >> np.arange(width)) & 1 == 0
        running = np.cumsum(shares, axis=1)
        u = _uniform(keys[live[mine]], salt, where[mine]) * running[:, -1]
        length = 1 + np.minimum((u[:, None] >= running).sum(axis=1), width - 1)
        shares[np.arange(len(mine)), length - 1] = 0.0  # what is left is exactly 0 when no length is
        path.taken[spot] |= 1 << (length - 1)
        path.mass[spot] *= shares.sum(axis=1) / np.maximum(running[:, -1], 1e-300)
        wait = -np.log(_uniform(keys[live[mine]], salt + 3, where[mine]))
        with np.errstate(divide="ignore"):
            path.arrival[spot] = when[mine] + wait / path.mass[spot]
        heads.append((mine, path, own, spot, place, length))
    m = len(live)
    resume = np.zeros(m, np.int64)
    turn_unit, turn_place, turn_length = (np.zeros(m, np.int64) for _ in range(3))
    for mine, path, _, spot, place, length in heads:
        turn_unit[mine], turn_place[mine], turn_length[mine] = path.unit[spot], place, length
        resume[mine] = place + length
    # the rest of the unit in which the path is left, and all later units, are drawn afresh
    whole = np.diff(lattices.unit_of_doc)[live]
    again = whole - turn_unit
    owner = np.repeat(np.arange(m), again)
    local = _ramp(again) + turn_unit[owner]
    starts = lattices.begins[lattices.unit_of_doc[live][owner] + local]
    lead = local == turn_unit[owner]
    starts[lead] = resume
    unit, place, length = _walk(lattices, local, starts, keys[live][owner], salt + 1)
    if len(place):
        ends = lattices.edge[place + length, 0] == -1
        empty = lead & (lattices.edge[starts, 0] == -1)
        drawn = np.zeros(len(local), np.int64)
        drawn[~empty] = np.diff(np.concatenate(([-1], np.flatnonzero(ends))))
        tail = np.bincount(owner, drawn, m).astype(np.int64)
    else:
        tail = np.zeros(m, np.int64)
    counts = where + 1 + tail
    first = np.concatenate(([0], np.cumsum(counts)))
    out = [np.empty(first[-1], np.int64) for _ in range(3)]
    for mine, path, own, _, _, _ in heads:
        span = where[mine]
        source = np.repeat(path.first[own], span) + _ramp(span)
        target = np.repeat(first[mine], span) + _ramp(span)
        for values, name in zip(out, ("unit", "place", "length"), strict=True):
            values[target] = getattr(path, name)[source]
    for values, turn in zip(out, (turn_unit, turn_place, turn_length), strict=True):
        values[first[:-1] + where] = turn
    target = np.repeat(first[:-1] + where + 1, tail) + _ramp(tail)
    for values, drawn_values in zip(out, (unit, place, length), strict=True):
        values[target] = drawn_values
    return _finish(lattices, live, first, *out, where + 1, when, keys[live], salt + 2)


def _ramp(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def piece_ids(lattices: Lattices, path: Path, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a path and where each text's ids start; characters without a piece become byte pieces."""
    edge = lattices.edge[path.place, path.length - 1]
    points = -2 - edge.astype(np.int64)
    points[points == _LITERAL] = _MARK
    spelled = edge < 0
    counts = np.ones(len(edge), np.int64)
    counts[spelled] = _n_bytes(points[spelled])
    at = np.concatenate(([0], np.cumsum(counts)))
    ids = np.empty(at[-1], np.int32)
    ids[at[:-1][~spelled]] = edge[~spelled]
    if spelled.any():
        text = "".join(map(chr, points[spelled])).encode()
        ids[np.repeat(at[:-1][spelled], counts[spelled]) + _ramp(counts[spelled])] = words.byte_ids[np.frombuffer(text, np.uint8)]
    return ids, at[path.first]


def decode_ids(ids: np.ndarray, first: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each starts; the leading space that encoding put in is taken out again."""
    lengths = words.lengths[ids]
    at = np.concatenate(([0], np.cumsum(lengths)))
    raw = words.spelling[np.repeat(words.starts[ids], lengths) + _ramp(lengths)]
    borders = at[first]
    full = np.diff(borders) > 0
    keep = np.ones(len(raw), dtype=bool)
    keep[borders[:-1][full]] = False
    return raw[keep], borders - np.concatenate(([0], np.cumsum(full)))


_KINDS = "sample int, ids array<int>, log_prob double, perturbed double, inclusion double, round_trip boolean"
_NAMES = ["sample", "ids", "log_prob", "perturbed", "inclusion", "round_trip"]


def encode_batch(column: pa.Array, keys: np.ndarray, k: int, words: Vocabulary) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """For each sample number: the rows that have such a sample, and its columns."""
    lattices = build_lattices(column.to_pylist(), words)
    paths, left = sample_paths(lattices, keys, k)
    raw, offsets = utf8(column)
    for number, path in enumerate(paths):
        ids, first = piece_ids(lattices, path, words)
        spelled, borders = decode_ids(ids, first, words)
        sizes = np.diff(borders)
        same = sizes == np.diff(offsets)[path.rows]
        if same.all():
            differ = spelled != raw[np.repeat(offsets[:-1][path.rows], sizes) + _ramp(sizes)]
            wrong = np.concatenate(([0], np.cumsum(differ)))
            same = wrong[borders[1:]] == wrong[borders[:-1]]
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(np.minimum(path.log_prob + np.log(left[path.rows]), 700.0)))
        columns = [
            pa.array(np.full(len(path.rows), number + 1, np.int32)),
            pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)),
            pa.array(path.log_prob), pa.array(-np.log(path.born)), pa.array(inclusion), pa.array(same),
        ]
        yield path.rows, columns


def sample_segmentations(documents: DataFrame, k: int = SAMPLES, model_path: str | None = None, seed: int = 1) -> DataFrame:
    """Up to ``k`` different segmentations of every text, drawn without replacement: doc_id, sample (1 is the first), ids,
    log_prob, perturbed (its Gumbel value, falling with sample), inclusion (the chance to be among those drawn, given the
    best one left out), round_trip (decoding the ids gives the text back).

    Draws depend on ``seed``, the doc_id and the text alone, not on partitions or other rows. A text with fewer
    segmentations than ``k`` gives as many rows as it has, with inclusion 1; an empty or null text gives one row without
    ids. Rows that repeat give the same rows again; a null doc_id is a key like any other. Empty table: empty result; other
    columns are ignored. A space is put in front of each text, as the model's normalizer does, and taken out in decoding.
    """
    prepare_workers(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model_path or default_model())
        for batch in slices(batches, "text", SLICE_BYTES):
            keys = mix(batch.column(1).to_numpy().astype(np.int64).view(U64))
            for rows, columns in encode_batch(batch.column(2), keys, k, words):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], ["doc_id", *_NAMES])

    texts = documents.select("doc_id", F.xxhash64(F.lit(seed), "doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(encode, f"doc_id {kind}, {_KINDS}")


def decode_pieces(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with the text that their ``ids`` spell, as column ``text`` (null ids: null)."""
    prepare_workers(encoded.sparkSession)
    others = [c for c in encoded.columns if c != "text"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in others])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model_path or default_model())
        for batch in batches:
            column = batch.column(others.index("ids"))
            texts = []
            for ids in column.to_pylist():
                found = None
                if ids is not None:
                    raw, _ = decode_ids(np.array(ids, np.int64), np.array([0, len(ids)]), words)
                    found = raw.tobytes().decode("utf-8", "replace")
                texts.append(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*others, "text"])

    return rows.mapInArrow(decode, f"{kinds}, text string")
