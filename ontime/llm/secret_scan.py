"""Secrets in versioned texts: an incremental ledger of content-addressed blobs and rule versions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import slices, prepare_workers, stage
from ontime.llm.membership import marked


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its ``group`` has at least ``least`` characters; others are used up and dropped.

    ``hints``: a text without any of these strings, after lower-casing A-Z, cannot match (empty: always searched).
    Change ``version`` with the pattern: only unseen (blob, rule, version) triples are searched.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()
    version: int = 1


# Kinds, patterns and lengths of the result contract, in its order; further kinds follow.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12, 2, re.ASCII | re.IGNORECASE, ("passw", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18, hints=("akia",)),
    Rule("hex", r"[0-9a-f]+", 16),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, hints=("private key-----",)),
    Rule("bearer", r"Bearer\x20+[A-Za-z0-9._~+/-]+=*", 27, hints=("bearer ",)),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, hints=("eyj",)),
)
RULES = BASE_RULES + MORE_RULES

_FOUND = "blob string, kind string, version int, spans array<struct<start:int,stop:int>>"


def _matcher(rule: Rule):
    # Runs of one character class that are too short can be skipped without being matched: the same spans, much faster.
    if rule.pattern == r"[0-9a-f]+":
        return re.compile(rf"[0-9a-f]{{{rule.least},}}", rule.flags)
    return re.compile(rule.pattern, rule.flags)


def _searcher(rules: Sequence[Rule]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = {r.kind: (r, _matcher(r)) for r in rules}
        fields = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        schema = pa.schema([("blob", pa.string()), ("kind", pa.string()), ("version", pa.int32()), ("spans", fields)])
        for batch in slices(batches):
            rows: dict[str, list] = {name: [] for name in schema.names}
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("blob", "text", "kinds"))
            for blob, text, kinds in zip(*columns, strict=True):
                lowered = text.lower()
                for kind in kinds:
                    rule, matcher = tools[kind]
                    spans = []
                    if not rule.hints or any(h in lowered for h in rule.hints):
                        for m in matcher.finditer(text):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                spans.append({"start": m.start(), "stop": m.end()})
                    for name, value in zip(schema.names, (blob, kind, rule.version, spans), strict=True):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return search


def _row_key() -> Column:
    """A version of a path as one string: the blob is hexadecimal, so the first colon ends it."""
    return F.concat(F.col("blob"), F.lit(":"), F.coalesce(F.col("path").cast("string"), F.lit("null")))


def scan_versions(
    spark: SparkSession, texts: DataFrame, versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """Bring the ledger in folder ``ledger`` up to date with the versions in ``texts`` (path, blob, text).

    ``versions`` holds path and blob of the same rows, written beforehand. A blob is the text's SHA-256. One path per blob
    carries it; blobs whose (rule, version) pairs are all in the ledger are not searched again, and of the others only the
    unseen pairs are. Which rows these are is decided without shuffling their texts. The ledger has one row per searched
    pair, with or without findings (rows that repeat a path and its text add equal ones), and is appended to by one atomic
    write. Returns the ledger and the pairs that this call searched.
    """
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    try:
        seen = spark.read.schema(_FOUND).parquet(ledger)
        known = seen.select("blob", "kind", "version")
    except Exception as error:  # the first run: the folder is not there yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known = spark.createDataFrame([], "blob string, kind string, version int")
    carriers = versions.groupBy("blob").agg(F.min("path").alias("path"))
    current = known.join(wanted, ["kind", "version"], "left_semi")
    done = current.groupBy("blob").agg(F.collect_set("kind").alias("_done"))  # at most one entry per rule
    every = F.array(*[F.lit(r.kind) for r in rules])
    kinds = F.array_except(every, F.coalesce("_done", F.array().cast("array<string>")))
    todo = carriers.join(done, "blob", "left").select("blob", "path", F.sort_array(kinds).alias("kinds"))
    todo = stage(todo.where(F.size("kinds") > 0).select(_row_key().alias("_key"), "kinds"), "todo")
    keys = versions.select(_row_key().alias("_key")).distinct()
    searched = spark.createDataFrame([], _FOUND)
    prepare_workers(spark)
    # One set of unseen rules on the first run, one or two after rules changed: at most all subsets of the rules.
    for unseen in sorted(r["kinds"] for r in todo.select("kinds").distinct().collect()):
        some = F.array(*map(F.lit, unseen))
        taken = stage(todo.where(F.col("kinds") == some).select("_key"), "searched-rows")
        others = stage(keys.join(taken, "_key", "left_anti"), "other-rows")
        chosen = marked(texts, _row_key(), taken, others, "_search").where("_search")
        searched = searched.unionByName(chosen.select("blob", "text", some.alias("kinds")).mapInArrow(_searcher(rules), _FOUND))
    new = stage(searched, "findings")
    new.write.mode("append").parquet(ledger)
    return spark.read.schema(_FOUND).parquet(ledger), new


def secret_spans(documents: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row of ``documents`` (doc_id, text) with the secrets in its text, through the ledger in folder ``ledger``.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 and spans. A span is kind:start:end of the whole match in code
    points, end exclusive; lists are in order of start, then of the kinds as listed, joined by commas. base_sha256 is the
    SHA-256 of the list of the base kinds, which further kinds never change.

    A null text counts as empty: no spans, the digest of the empty list. Rows that repeat a doc_id or text each get their
    row. Empty table: empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = documents.select(F.col("doc_id").alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    narrow = stage(texts.select("path", "blob"), "blobs")
    found, _ = scan_versions(spark, texts, narrow, ledger, rules)
    order = F.array(*[F.lit(r.kind) for r in rules])
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    current = found.join(F.broadcast(wanted), ["kind", "version"], "left_semi")  # one row per rule
    spans = current.where(F.size("spans") > 0).dropDuplicates(["blob", "kind"]).groupBy("blob").agg(
        F.flatten(
            F.collect_list(
                F.transform("spans", lambda s: F.struct(s["start"].alias("a"), F.array_position(order, F.col("kind")).alias("k"), s["stop"].alias("z")))
            )
        ).alias("_spans")
    )

    def joined(entries) -> object:
        return F.concat_ws(",", F.transform(entries, lambda s: F.concat_ws(":", F.get(order, (s["k"] - 1).cast("int")), s["a"], s["z"])))

    nothing = F.array().cast("array<struct<a:int,k:bigint,z:int>>")
    listed = narrow.join(stage(spans, "spans"), "blob", "left").withColumn("_all", F.sort_array(F.coalesce("_spans", nothing)))

    def count(k: int) -> object:
        return F.size(F.filter("_all", lambda s: s["k"] == k)).cast("long")

    base = F.filter("_all", lambda s: s["k"] <= len(BASE_RULES))
    return listed.select(
        F.col("path").alias("doc_id"), count(1).alias("n_assign"), count(2).alias("n_access"), count(3).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_all")).alias("spans"),
    )

