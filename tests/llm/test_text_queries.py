"""Registered text queries on the small tables, against their SQL where there is one, and the pipeline."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from ontime.llm.queries import ORACLES, QUERIES
from ontime.llm.segmentation import decode_pieces

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    expected = connection.sql(ORACLES[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(expected.columns)
    rows = sorted(map(str, ([r[c] for c in sorted(got.columns)] for r in got.collect())))
    order = [expected.columns.index(c) for c in sorted(expected.columns)]
    assert rows == sorted(str([r[i] for i in order]) for r in expected.fetchall())


def test_pipeline_keeps_columns_and_drops_copies(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    assert docs.select("doc_id").distinct().count() == n
    result = corpus_pipeline.run(spark, SMALL)
    assert result.where("not round_trip").count() == 0 and result.count() > 0


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    """Every stage on a small table: nulls, empty and long texts, repeated rows, copies, near copies, odd columns."""
    rng = np.random.default_rng(12)
    calm = [" ".join(f"w{x}" for x in rng.integers(0, 4000, 60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(calm)]
    rows += [(1000 + i, " ".join(f"vile{x}slur" for x in rng.integers(0, 300, 80))) for i in range(200)]
    rows += [(600 + i, " ".join(f"w{x}" for x in rng.integers(0, 4000, 60))) for i in range(300)]
    rows += [(200 + i, calm[40].replace(" ", "  ")) for i in range(20)] + [(300, None), (301, ""), (302, " "), (41, calm[41])]
    rows += [(400 + i, calm[50] + f" end{i}") for i in range(15)] + [(None, "no number here"), (500, "x y z " * 30_000)]
    data = [(i, t, None if k % 9 == 0 else "ab"[k % 2], f"own{k}", f"id{k}") for k, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string, _own string, _id string").repartition(5)
    marks = [(i, 0, int(i >= 1000)) for i, _ in rows if i is not None and (i < 100 or i >= 600)]
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def held(df):
        return [(r["doc_id"], r["text"], r["source"], r["_own"], r["_id"]) for r in df.collect()]

    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text or "")

    toxicity, exact, near, mixing, last = (f for _, f in corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    calm_docs = toxicity(spark, docs, str(tmp_path))
    kept = held(calm_docs)
    assert set(kept) <= set(data) and len(kept) == len(set(kept))
    assert {r for r in data if r[0] is None or r[0] < 1000} == set(kept)

    def write(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    single = write(exact(spark, write(calm_docs, "calm"), str(tmp_path)), "single")
    least = {}
    for i, t, *_ in kept:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        least[text] = min(least.get(text, (True, 0)), (i is None, i or 0))
    left = held(single)
    assert sorted((r[0] is None, r[0] or 0) for r in left) == sorted(least.values()) and set(left) <= set(kept)

    apart = write(near(spark, single, str(tmp_path)), "apart")
    sets = {}
    for i, t, *_ in left:
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    first = {i: i for i in sets}
    numbers = [i for i in sets if i is not None and sets[i]]
    links = [(a, b) for a in numbers for b in numbers if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in numbers:  # smallest number reachable
        for a, b in links:
            first[a] = min(first[a], first[b])
    expected = {r for r in left if first[r[0]] == r[0]}
    rest = held(apart)
    assert set(rest) == expected and len(rest) == len(expected) < len(left)

    mixed = write(mixing(spark, apart, str(tmp_path)), "mixed")
    times = Counter(held(mixed))
    assert set(times) <= expected and max(times.values()) <= 2
    sizes, taken = Counter(), Counter()
    for r in rest:
        sizes[r[2]] += len(words(r[1]))
        taken[r[2]] += times[r] * len(words(r[1]))
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), (3, 1, 2), strict=False))
    targets, goal = {}, 1.5 * sum(sizes.values())
    while len(targets) < len(sizes):
        still = [s for s in sizes if s not in targets]
        level = (goal - sum(targets.values())) / sum(weights[s] for s in still)
        full = [s for s in still if level * weights[s] > 2 * sizes[s]]
        targets |= {s: 2.0 * sizes[s] for s in full} if full else {s: level * weights[s] for s in still}
    biggest = {s: max(len(words(r[1])) for r in rest if r[2] == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= biggest[s] for s in sizes)

    pieces = last(spark, mixed, str(tmp_path))
    spelled = Counter((r["doc_id"], r["text"]) for r in decode_pieces(pieces.where("sample = 1")).collect())
    assert spelled == Counter((r[0], r[1] or "") for r in times.elements())
    assert pieces.where("not round_trip").count() == 0
