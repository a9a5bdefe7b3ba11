"""URL rules, whitening and vector codes against plain versions: nulls, ties, repeats, empty tables, clashing columns."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ontime.llm import membership, url_filter, vector_codes, whitening
from ontime.llm.common import fresh_folder
from ontime.llm.url_filter import DigestArray, judged_urls, write_array

PAGES = "page_id long, url string, host string, path string, rule string, verdict string, _block int, file int"
RULES = "rule string, verdict string, host string, block int"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r", "v", 1, 2) for i, u in enumerate(urls)], PAGES)


def rules_of(spark, rules):
    return spark.createDataFrame([(r, v, "x", 3) for r, v in rules], RULES)


def _lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _judge(url, rules, unlisted="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [rest.index(c) for c in "/?#" if c in rest]
    host = _lowered(rest[: min(ends, default=len(rest))])
    path = rest[len(host) :]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = (0, 0, None, unlisted)
    for rule, verdict in rules:
        if not rule or rule.startswith("/"):
            continue
        where, slash, rest = rule.partition("/")
        where = _lowered(where)
        if (host == where or host.endswith("." + where)) and path.startswith(slash + rest):
            best = max(best, (len(where + slash + rest), len(where), where + slash + rest, verdict), key=lambda b: b[:2])
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.net/x", "https://xnet/x", "//net/x",
    "http://example.net/en/1?q=a://b", "http://Sub.Example.net/en", "ftp://example.com#/de/", "http://example.com/de/",
    "http://example.com/DE/", "http://a.b.c.org/fr/x#y", "http://org?/fr/", "http://user@a.net:80/", "http://é.net/ü",
    "http://a.net/\n", "http://.net/", "http://a..net/", "http://net./", "HTTP://A.NET/x",
]


def test_urls_of_the_contract(spark):
    found = judged_urls(pages(spark, URLS + URLS[:4]), rules_of(spark, url_filter.RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == {i: _judge(u, url_filter.RULES) for i, u in enumerate(URLS + URLS[:4])}


def test_urls_against_all_rules_in_several_arrays(spark):
    rng = random.Random(3)
    names = ["a", "b", "c.d", "example", "net", "x"]
    paths = ["/", "/p", "/p/", "/p/q", "/ü", "/p/q/r", ""]
    rules = {(".".join(rng.choices(names, k=rng.randint(1, 3))) + rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(150)}
    urls = [f"http://{'.'.join(rng.choices(names, k=rng.randint(1, 4)))}{rng.choice(paths)}{rng.choice(['', 'z', '?p'])}" for _ in range(700)]
    listed = [*rules.items(), ("a/both", "allow"), ("a/both", "block"), (None, "block"), ("", "block"), ("/p", "block"), ("X/UP", "block")]
    expected = [*rules.items(), ("a/both", "block"), ("x/UP", "block")]
    urls += ["http://a/both", "http://q.x/UP", "http://q.x/up"]
    folder = fresh_folder(spark, "test-rules")
    arrays = url_filter.build_arrays(rules_of(spark, listed), folder, array_bytes=400)
    assert len(arrays) > 2
    got = url_filter.apply_rules(pages(spark, urls).repartition(5), arrays, "unknown").collect()
    assert {r["page_id"]: tuple(r)[1:] for r in got} == {i: _judge(u, expected, "unknown") for i, u in enumerate(urls)}


def test_colliding_digests_are_told_apart(tmp_path):
    rules = {(f"h{i}.net", f"/{j}"): (i + j) % 2 == 0 for i in range(20) for j in range(5)}

    def weak(texts):
        return np.array([len(t) % 3 for t in texts], np.uint64)

    with open(tmp_path / "weak.arrow", "wb") as stream:
        write_array(stream, rules, weak)
    array = DigestArray(str(tmp_path / "weak.arrow"), weak)
    hosts = [f"www.h{i}.net" for i in range(25)] * 6
    paths = [f"/{j}/x" for j in range(6) for _ in range(25)]
    got = array.longest(hosts, paths)
    plain = [(h + p, "block" if b else "allow") for (h, p), b in rules.items()]
    expected = [_judge(f"http://{h}{p}", plain, None)[2:] for h, p in zip(hosts, paths, strict=True)]
    assert list(zip(*got, strict=True)) == expected


def test_urls_of_empty_tables(spark):
    assert judged_urls(pages(spark, []), rules_of(spark, url_filter.RULES)).count() == 0
    got = judged_urls(pages(spark, URLS), rules_of(spark, [])).collect()
    assert {(r["rule"], r["verdict"]) for r in got} == {(None, "allow")} and len(got) == len(URLS)


VECTORS = "vec_id long, embedding array<double>, label int, x string, value string, component string, code string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", "z", "c") for i, v, label in rows], VECTORS)


def _random_rows(n, size, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (4, size))
    rows = [(int(i), [float(v) for v in centres[i % 4] + rng.normal(0, 0.3, size)], None if i % 5 == 0 else int(i % 3)) for i in range(n)]
    bad = [None, [None, *[0.5] * (size - 1)], [float("nan")] * size, [*[0.5] * (size - 1), float("-inf")]]
    return rows + [(n + k, v, 1) for k, v in enumerate(bad)] + [(rows[3][0], rows[3][1], 2), (None, rows[4][1], None)]


def _usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]


@pytest.mark.parametrize(("n", "size"), [(400, 24), (60, 5), (30, 8)])
def test_whitening_against_a_full_decomposition(spark, n, size):
    rows = _random_rows(n, size)
    kept = _usable(rows)
    x = np.floor(1024 * np.array([r[1] for r in kept])) + 100_000
    values, q = np.linalg.eigh(np.cov(x.T, bias=True))
    values, q = values[::-1], q[:, ::-1]
    table = whitening.whitened(vectors(spark, rows).repartition(6))
    assert table.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = table.collect()
    k = min(8, size)
    assert len(got) == len(kept) * k and {r["n"] for r in got} == {len(kept)}
    white = (x - x.mean(axis=0)) @ q[:, :k] / np.sqrt(values[:k])
    exact = [int(v) for v in x.sum(axis=0)]
    expected = {}
    for (i, _, _), line, w in zip(kept, x, white, strict=True):
        deviation = sum((len(kept) * int(c) - s) ** 2 for c, s in zip(line, exact, strict=True))
        expected.setdefault(i, []).append((deviation, w))
    signs = {}
    for r in got:
        options = [e for e in expected[r["vec_id"]] if e[0] == r["deviation"]]
        w = options[0][1][r["component"] - 1]
        signs.setdefault(r["component"], np.sign(w * r["whitened"]))
        assert r["whitened"] == pytest.approx(signs[r["component"]] * w, abs=1e-8)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-10)
        assert r["identity_error"] < 1e-9


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None, 1), (2, [None], 1)])).count() == 0
    assert whitening.whitened(vectors(spark, [(i, [0.25, 0.5], 1) for i in range(4)])).count() == 0
    line = whitening.whitened(vectors(spark, [(i, [float(i), 2.0 * i, 0.0], 1) for i in range(6)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 6 and line[0]["explained"] == pytest.approx(1.0)
    far = whitening.whitened(vectors(spark, [(1, [4e5], 1), (2, [-4e5], 1), (3, [-4e5], 1)])).collect()
    assert sorted(r["deviation"] for r in far) == [(1024 * 800_000) ** 2] * 2 + [(2 * 1024 * 800_000) ** 2]
    huge = whitening.whitened(vectors(spark, [(1, [1e10], 1), (2, [-1e10], 1)])).collect()
    assert [r["deviation"] for r in huge] == [None, None]
    with pytest.raises(ValueError, match="vectors of 1 and of 2"):
        whitening.whitened(vectors(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)]))


@pytest.mark.parametrize("seed", range(3))
def test_leading_pairs_of_known_matrices(seed):
    rng = np.random.default_rng(seed)
    spectra = (np.ones(30), np.r_[[5.0, 4, 4], np.zeros(40)], 2.0 ** -np.arange(90), np.r_[1e4, np.linspace(1, 2, 120)], np.zeros(12))
    for spectrum in spectra:
        q = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
        a = (q * spectrum) @ q.T
        found = whitening.leading_spectrum(lambda b, a=a: a @ b, len(a))
        expected = np.sort(spectrum)[::-1][:8]
        expected = expected[expected > 0]
        assert found.values == pytest.approx(expected, rel=1e-9)
        assert found.vectors.T @ found.vectors == pytest.approx(np.eye(len(expected)), abs=1e-12)
        assert np.linalg.norm(a @ found.vectors - found.vectors * found.values) <= 1e-10 * max(spectrum.max(), 1e-300) or not len(expected)


def _plain_codes(rows, n_parts=8, n_entries=16, rounds=6):
    kept = _usable(rows)
    x = [[[int(np.floor(4096 * c)) for c in v[p * len(v) // n_parts : (p + 1) * len(v) // n_parts]] for p in range(n_parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, x[i]))[:n_entries]
    books = [[list(x[i][p]) for i in first] for p in range(n_parts)]

    def assign():
        out = []
        for row in x:
            choices = [min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book)) for part, book in zip(row, books, strict=True)]
            out.append(choices)
        return out

    for _ in range(rounds):
        chosen = assign()
        for p in range(n_parts):
            for k in range(len(first)):
                mine = [row[p] for row, c in zip(x, chosen, strict=True) if c[p][1] == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    chosen = assign()
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in c) for c in chosen]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in c), e, by_label[label], digest) for (i, _, label), c, e in zip(kept, chosen, errors, strict=True)),
        key=str,
    )


@pytest.mark.parametrize(("n", "size"), [(200, 16), (9, 8), (60, 24)])
def test_vector_codes_against_plain_rounds(spark, n, size):
    rows = _random_rows(n, size)
    table = vector_codes.vector_codes(vectors(spark, rows).repartition(7))
    assert table.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, table.collect()), key=str) == _plain_codes(rows)


def test_vector_codes_with_ties_and_degenerate_tables(spark):
    grid = [(i, [float(i % 2), float(i // 2 % 2)] * 4, None) for i in range(40)]  # repeated entries and ties
    one = vector_codes.vector_codes(vectors(spark, grid).coalesce(1)).collect()
    assert sorted(map(tuple, one), key=str) == _plain_codes(grid)
    assert vector_codes.vector_codes(vectors(spark, [])).count() == 0
    assert vector_codes.vector_codes(vectors(spark, [(1, None, 1)])).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(vectors(spark, [(1, [1.0] * 9, 1)]))
    with pytest.raises(ValueError, match="too large"):
        vector_codes.vector_codes(vectors(spark, [(1, [1e9] * 8, 1)]))


@pytest.mark.parametrize("width", [1, 37, 400, 5000])
def test_grid_cells_are_exact(monkeypatch, width):
    rng = np.random.default_rng(width)
    book = rng.integers(-900, 900, (16, 3))
    book[5] = book[2]
    points = np.vstack([rng.integers(-1500, 1500, (3000, 3)), book, (book[:1] + book[1:2]) // 2])
    squares = np.square(points[:, None, :] - book[None]).sum(axis=2)
    plain = vector_codes.GridCells(book, width)
    small = vector_codes.GridCells(book, width, most=50)
    weak = vector_codes.GridCells(book, width)
    monkeypatch.setattr(weak, "_hash", lambda cells: (cells.sum(axis=1) % 5).astype(np.uint64))
    for grid in (plain, small, weak):
        for _ in range(2):
            for start in range(0, len(points), 700):
                some = slice(start, start + 700)
                codes, errors = grid.nearest(points[some])
                assert (codes == squares[some].argmin(axis=1)).all() and (errors == squares[some].min(axis=1)).all()
    assert width > 400 or plain.evaluated < 16 * plain.looked_up
    assert len(small.keys) <= 50


def test_vector_rows_keep_their_labels(spark):
    rows = [Row(vec_id=i, embedding=[0.1 * i] * 8, label="a" if i % 2 else None) for i in range(20)]
    got = vector_codes.vector_codes(spark.createDataFrame(rows)).groupBy("label_error").agg(F.sum("error").alias("e")).collect()
    assert all(r["label_error"] == r["e"] for r in got) and len(got) in (1, 2)


@pytest.mark.parametrize("bits", [None, 1 << 15])
def test_marked_rows_are_exact(spark, monkeypatch, bits):
    """With few bits nearly every row has both of them and goes through the join."""
    if bits:
        monkeypatch.setattr(membership, "table_bits", lambda n: bits)
    wide = spark.range(60_000).select(F.expr("if(id = 7, null, id div 2)").alias("doc_id"), F.col("id").alias("i"))
    keys = wide.where("doc_id is not null").select(F.col("doc_id").alias("_key")).distinct()
    inside, outside = keys.where("_key % 3 = 0"), keys.where("_key % 3 != 0")
    got = membership.marked(wide.select("doc_id", "i"), F.col("doc_id"), inside, outside, "_flag")
    assert got.columns == ["doc_id", "i", "_flag"] and got.count() == 60_000
    assert got.where("_flag is null or _flag != coalesce(doc_id % 3 = 0, false)").count() == 0
    nothing = membership.marked(wide.select("doc_id"), F.col("doc_id"), keys.where("false"), keys, "_flag")
    assert nothing.where("_flag").count() == 0 and nothing.count() == 60_000
