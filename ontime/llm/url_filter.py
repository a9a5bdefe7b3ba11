"""URL rules in a sorted digest array: 64-bit keys in a memory-mapped file, binary search, full strings against collisions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import fresh_folder, prepare_workers, stage
from ontime.llm.warc import _open

# Fixed by the result contract: rule as written, and what it says.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

UNLISTED = "allow"
ARRAY_BYTES = 1 << 28  # strings of the rules in one array file; longer lists get several, which are probed in turn
ROWS_PER_BATCH = 8192

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENTRIES = pa.schema(
    [("key", pa.uint64()), ("text", pa.large_string()), ("lengths", pa.list_(pa.int32())), ("block", pa.bool_())]
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (up to ``?``, ``#``
    or the end); both empty without ``://`` and for null."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def digest(texts: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))


def _sorted_entries(texts: list[str], lengths: list, block: list, keys: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(keys, kind="stable")
    pick = pa.array(order)
    columns = [pa.array(keys[order])] + [
        pa.array(values, _ENTRIES.field(name).type).take(pick)
        for name, values in (("text", texts), ("lengths", lengths), ("block", block))
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ENTRIES)


def write_array(stream, rules: dict[tuple[str, str], bool], digest=digest) -> None:
    """Write the array of some rules, {(host, path): blocks}: two sorted lists, of the hosts with the lengths of the paths
    listed under them, and of the whole rules with their verdict."""
    lengths: dict[str, set[int]] = {}
    for host, path in rules:
        lengths.setdefault(host, set()).add(len(path))
    hosts, whole = list(lengths), [host + path for host, path in rules]
    with pa.ipc.new_file(stream, _ENTRIES) as out:
        out.write_batch(_sorted_entries(hosts, [sorted(lengths[h]) for h in hosts], [None] * len(hosts), digest(hosts)))
        out.write_batch(_sorted_entries(whole, [None] * len(whole), list(rules.values()), digest(whole)))


class DigestArray:
    """A memory-mapped array file: its pages are shared by all workers of a machine and read as they are needed."""

    def __init__(self, path: str, digest=digest):
        self.digest = digest
        reader = pa.ipc.open_file(pa.memory_map(path))
        self.hosts, self.rules = reader.get_batch(0), reader.get_batch(1)

    def _find(self, entries: pa.RecordBatch, texts: list[str]) -> np.ndarray:
        """Row of each text in the sorted entries, -1 where it is not listed."""
        out = np.full(len(texts), -1, np.int64)
        if not texts or not entries.num_rows:
            return out
        keys = entries.column(0).to_numpy(zero_copy_only=True)
        wanted = self.digest(texts)
        at = np.searchsorted(keys, wanted)
        asked = pa.array(texts, pa.large_string())
        open_rows = np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == wanted))
        while len(open_rows):  # more than once only where listed keys collide
            places = pa.array(at[open_rows])
            same = pc.equal(entries.column(1).take(places), asked.take(pa.array(open_rows))).to_numpy(zero_copy_only=False)
            out[open_rows[same]] = at[open_rows[same]]
            open_rows = open_rows[~same]
            at[open_rows] += 1
            open_rows = open_rows[at[open_rows] < len(keys)]
            open_rows = open_rows[keys[at[open_rows]] == wanted[open_rows]]
        return out

    def longest(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest rule that fits each host and path, and its verdict (None: no rule fits). Of rules of one length the
        one with the longer host counts."""
        distinct = sorted(set(hosts))
        places = {h: i for i, h in enumerate(distinct)}
        owners, suffixes = [], []
        for i, host in enumerate(distinct):
            while host:
                owners.append(i)
                suffixes.append(host)
                _, _, host = host.partition(".")
        listed: dict[int, list[tuple[str, list[int]]]] = {}
        rows = self._find(self.hosts, suffixes)
        for k in np.flatnonzero(rows >= 0).tolist():
            listed.setdefault(owners[k], []).append((suffixes[k], self.hosts.column(2)[int(rows[k])].as_py()))
        who, asked, sizes = [], [], []
        for r, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for suffix, lengths in listed.get(places[host], ()):
                for length in lengths:
                    if length <= len(path):
                        who.append(r)
                        asked.append(suffix + path[:length])
                        sizes.append((len(suffix) + length, len(suffix)))
        best: list[tuple[tuple[int, int], str, str] | None] = [None] * len(hosts)
        found = self._find(self.rules, asked)
        for k in np.flatnonzero(found >= 0).tolist():
            r = who[k]
            # the string tells the rule: a host has no "/", a path starts with one or is empty
            if best[r] is None or sizes[k] > best[r][0]:
                verdict = "block" if self.rules.column(3)[int(found[k])].as_py() else "allow"
                best[r] = (sizes[k], asked[k], verdict)
        return [b and b[1] for b in best], [b and b[2] for b in best]


def split_rule(rule: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a rule as written: the path starts at the first ``/`` and may be empty."""
    host = F.translate(F.regexp_extract(rule, r"^[^/]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rule, r"^[^/]*([\s\S]*)", 1)


def build_arrays(rules: DataFrame, folder: str, array_bytes: int = ARRAY_BYTES) -> list[str]:
    """Write the rules (rule, verdict) to array files in ``folder``; returns their paths, at least one.

    Rules are dealt by digest, one file per task, so that a list of any length is written in parallel in files of about
    ``array_bytes``. Null and empty rules are left out, and of conflicting verdicts for one rule ``block`` counts. Each
    attempt writes under a name of its own; only those of successful ones are returned.
    """
    spark = rules.sparkSession
    prepare_workers(spark, ROWS_PER_BATCH)
    host, path = split_rule(F.col("rule"))
    named = rules.where(F.col("rule").isNotNull()).select(host.alias("host"), path.alias("path"), (F.col("verdict") == "block").alias("_block"))
    single = stage(named.where("host <> ''").groupBy("host", "path").agg(F.coalesce(F.max("_block"), F.lit(False)).alias("block")), "rules")
    size = single.agg(F.sum(F.octet_length("host") + F.octet_length("path"))).first()[0] or 0
    n_files = max(1, math.ceil(size / array_bytes))
    dealt = single.withColumn("file", F.pmod(F.xxhash64("host", "path"), F.lit(n_files)).cast("int"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[int, dict[tuple[str, str], bool]] = {}
        for batch in batches:
            for host, path, block, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files.setdefault(file, {})[host, path] = block
        system, root = _open(folder)
        for held in files.values():
            name = f"rules-{uuid4().hex}.arrow"
            with system.open_output_stream(f"{root}/{name}", compression=None) as stream:
                write_array(stream, held)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    written = dealt.repartition(n_files, "file").select("host", "path", "block", "file").mapInArrow(write, "path string")
    return [r["path"] for r in stage(written, "rule-files").collect()]  # one row per file


def apply_rules(pages: DataFrame, arrays: Sequence[str], unlisted: str = UNLISTED) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` by the rules in the array files.

    Spark hands the files to the executors, whose workers map them: memory is that of the pages they touch. Files are
    probed in turn, each pass keeping the longer of its own rule and the one found so far; nothing is shuffled.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    none = F.lit(None).cast("string")
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), none.alias("rule"), none.alias("verdict"))
    prepare_workers(spark, ROWS_PER_BATCH)
    for array in arrays:
        spark.sparkContext.addFile(array)
        judged = judged.mapInArrow(_probe(array.rsplit("/", 1)[-1]), judged.schema)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(unlisted)))


def _rank(rule: str | None) -> tuple[int, int]:
    return (len(rule), len(rule.partition("/")[0])) if rule else (0, 0)


def _probe(name: str):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = None
        for batch in batches:
            array = array or DigestArray(SparkFiles.get(name))
            page, *rest = batch.columns
            hosts, paths, rules, verdicts = (c.to_pylist() for c in rest)
            for i, (rule, verdict) in enumerate(zip(*array.longest(hosts, paths), strict=True)):
                if _rank(rule) > _rank(rules[i]):
                    rules[i], verdicts[i] = rule, verdict
            yield pa.RecordBatch.from_arrays(
                [page, rest[0], rest[1], pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], batch.schema.names
            )

    return probe


def judged_urls(
    pages: DataFrame, rules: DataFrame, folder: str | None = None, unlisted: str = UNLISTED, array_bytes: int = ARRAY_BYTES
) -> DataFrame:
    """The verdict on every row of ``pages`` (page_id, url) by the rules (rule, verdict: block or allow).

    A rule ``host/path`` fits its host and all subdomains of it, if the url's path starts with the rule's (a rule without
    ``/`` fits every path); the longest one wins, by characters of host and path together, then of the host. Returns
    page_id, host, path, rule (null if none fits) and verdict: the rule's, else ``unlisted``.

    A null or relative url has an empty host and path and no rule. Hosts are compared with any port or user name they
    carry. Rows that repeat a page_id get a row each; other columns are ignored. Empty table: empty result; without rules
    every verdict is ``unlisted``.
    """
    arrays = build_arrays(rules, folder or fresh_folder(pages.sparkSession, "rules"), array_bytes)
    return apply_rules(pages, arrays, unlisted)
