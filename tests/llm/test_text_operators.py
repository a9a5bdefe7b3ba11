"""Text operators on small frames: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import re
import struct
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ontime.llm import minhash, mixing, quality_classifier, secret_scan, segmentation, token_counts, toxicity, warc
from ontime.llm.common import PIECES, free_name, fresh_folder, training_sample
from ontime.llm.components import connected_components
from ontime.llm.exact_dedup import drop_copies, exact_groups
from ontime.llm import quality_rules as quality_rules_module
from ontime.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, score string, size string, component_id string, _text string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "the cat sat on the mat and the dog ran off", "a"),
    (2, "the  cat sat\ton the mat and\nthe dog ran off", "a"),
    (3, None, None),
    (4, "", "b"),
    (5, "Ünïcode ▁ 日本語 🎉 \n\n token: abcdefghijkl0123", "b"),
    (6, LONG, "c"),
    (6, LONG, "c"),
    (None, "no identifier here at all", "c"),
    (8, "the cat sat on the mat and the dog ran off", "c"),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, s, "x", "y", "z", "w") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_exact_groups(spark):
    found = {r["row_id"]: r for r in exact_groups(docs(spark).coalesce(1)).collect()}
    rows = [found[k] for k in sorted(found)]
    assert [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows] == [
        (1, 1, 3, True), (2, 1, 3, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True), (6, 6, 2, True),
        (6, 6, 2, False), (None, None, 1, True), (8, 1, 3, False),
    ]
    assert rows[2]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    many = docs(spark, [(i, f"t{i % 7}", "a") for i in range(300)]).repartition(70)
    assert {(r["keep_id"]) for r in exact_groups(many).collect()} == set(range(7))
    assert exact_groups(docs(spark, [])).count() == 0
    kept = drop_copies(docs(spark))
    assert kept.columns == docs(spark).columns and kept.count() == 5


def test_mixing(spark):
    rows = [(i, "w " * (i % 40), "abc"[i % 3] if i % 10 else None) for i in range(900)]
    got = mixing.entropy_mix(docs(spark, rows)).collect()
    again = mixing.entropy_mix(docs(spark, rows[::-1])).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)
    sums, sizes, targets = Counter(), Counter(), {}
    for r in got:
        source = rows[r["doc_id"]][2]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["size"] == r["doc_id"] % 40
        sums[source] += r["taken"]
        sizes[source] += r["size"]
        targets[source] = r["target"]
    expected, open_sources = {}, dict(zip(["a", "b", "c", None], (3, 1, 2, 3), strict=True))
    goal = 1.5 * sum(sizes.values())
    while open_sources:
        level = (goal - sum(expected.values())) / sum(open_sources.values())
        full = [s for s, w in open_sources.items() if level * w > 2 * sizes[s]]
        if not full:
            expected |= {s: level * w for s, w in open_sources.items()}
            break
        for s in full:
            expected[s] = 2.0 * sizes[s]
            del open_sources[s]
    for source, target in targets.items():
        assert target == pytest.approx(expected[source]) and abs(sums[source] - target) <= 40
    assert mixing.entropy_mix(docs(spark, [])).count() == 0
    assert mixing.entropy_mix(docs(spark, [(1, None, None), (2, "", "a")])).agg(F.sum("taken")).first()[0] == 0
    assert mixing.mixed_documents(docs(spark, rows)).count() == sum(r["copies"] for r in got)


def test_mixing_hot_cell(spark):
    rows = [(i, "same words here", "a") for i in range(3000)] + [(5000 + i, "x " * (i + 1), "b") for i in range(50)]
    got = mixing.entropy_mix(docs(spark, rows)).groupBy("source_size").agg(F.sum("taken").alias("k"), F.first("target").alias("t"))
    assert all(abs(r["k"] - r["t"]) <= 60 for r in got.collect())


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (139, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = [[f"w{x}" for x in rng.integers(0, 5000, 120)] for _ in range(6)]
    rows = []
    for i in range(330):  # one large family with many edits, five small ones
        words = list(base[i % 6 if i < 30 else 0])
        for _ in range(int(rng.integers(0, 9))):
            words[int(rng.integers(0, 120))] = f"e{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words).replace("w1", "W1"), "a"))
    rows += [(1000, None, "a"), (1001, "", "a"), (1002, "two words", "a"), (1003, "TWO  words", "a"), (1004, "two", "a")]
    sets = {}
    for i, text, _ in rows:
        words = [w.lower() for w in WORD.findall(text or "")]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert {i: got[i]["component_id"] for i in sets} == {i: root(i) for i in sets}
    assert all(got[i]["n_shingles"] == len(sets[i]) and got[i]["kept"] == (root(i) == i) for i in sets)
    assert len({root(i) for i in sets}) > 8


def test_near_duplicates_odd_rows(spark):
    got = minhash.near_duplicates(docs(spark)).collect()
    assert len(got) == len(ROWS)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (1, 1, True), (2, 1, False), (8, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (None, None, True),
    }
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicates_repeated_ids(spark):
    one, two = (" ".join(f"{w}{i}" for i in range(40)) for w in "xy")
    rows = [(5, one, "a"), (5, one, "a"), (5, two, "a"), (7, one + " more", "a"), (9, "more " + two, "a"), (11, "else", "a")]
    got = minhash.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(5, 5), (5, 5), (5, 5), (7, 5), (9, 5), (11, 11)]


def test_open_buckets_are_searched_completely(monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    n = 6
    sets = [np.sort(np.array(list(range(100)) + [1000 + i], np.uint64)) for i in range(n)]
    keys = [minhash._band_keys(minhash.minima(s)) for s in sets]
    table = pa.table({
        "piece": np.zeros(n, np.int64), "band": [int(np.argmax(keys[0] == keys[1]))] * n,
        "doc_id": np.arange(n), "own": np.arange(n), "n_shingles": [101] * n, "bands": keys,
        "fine": [(minhash.minima(s, minhash.FINE) & np.uint32(255)).astype(np.uint8).tobytes() for s in sets],
        "shingles": [s.tobytes() for s in sets],
    })
    links = [tuple(r.values()) for b in minhash._pairs_within(table, minhash._least_agreement(85, minhash.FINE), 85) for r in b.to_pylist()]
    assert (0, 1) in links and len(links) <= n - 1


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é" + "x" * 2000
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, None), (4, "u", ""), (5, "v", "short"), (6, "w", "short"),
            (7, "z", big), (7, "z", big), (None, "q", big), (None, None, "tail\r\n\r\nWARC/1.1\r\n")]
    rows += [(100 + i, f"http://{i}", f"<html>{i} " + "body text " * (60 + i) + "</html>") for i in range(500)]
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, record_type string")
    archives = warc.write_archives(pages, str(tmp_path / "a b"))
    got = warc.read_archives(archives, with_payload=True).collect()
    assert len(got) == len(rows) == sum(r["n_records"] for r in archives.collect())
    expected = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        refers = 7 if html == big and i != 7 else None
        expected[(i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers else "response", refers)] += 1
        if not refers:
            assert any(r["page_id"] == i and r["payload"] == payload for r in got)
    assert Counter(tuple(r)[:5] for r in got) == expected
    assert warc.archived_pages(pages.limit(0)).count() == 0
    first = open(archives.first()["path"], "rb").read(4)
    assert first == (0x184D2A5D).to_bytes(4, "little")


def _spans(text):
    kinds = ((r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 12), (r"(AKIA[A-Z0-9]+)", 0, 18), (r"([0-9a-f]+)", 0, 16))
    found = [(m.start(), k, m.end()) for k, (p, f, n) in enumerate(kinds) for m in re.finditer(p, text, f) if len(m[1]) >= n]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(found))


def test_secret_ledger(spark):
    texts = ["é API_KEY = 'abcdefghijkl0123'", "token=secret:abcdefghijklmnop", "AKIAABCDEFGHIJKLMN 0123456789abcdef", "deadbeef",
             "token: 0123456789abcdef0123", "-----BEGIN RSA PRIVATE KEY----- x", "Password:\tnothing", "a" * 40, LONG, None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(90, texts[0], "s"), (None, texts[2], "s"), (0, texts[0], "s")]
    folder = fresh_folder(spark, "ledger-test")
    got = secret_scan.secret_spans(docs(spark, rows), folder).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by_id[90]["spans"] == by_id[0]["spans"] and by_id[None]["n_access"] == 1
    for i, t in enumerate(texts):
        spans = _spans(t or "")
        assert by_id[i]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest(), (i, spans, by_id[i]["spans"])
    assert by_id[5]["spans"].startswith("pem:0:") and by_id[5]["n_assign"] == 0
    # a second version of the table: only the new blob is searched; a new rule version searches that rule everywhere
    before = spark.read.parquet(folder).count()
    more = [*rows, (91, "new text token=abcdefghijklmnop", "s")]
    secret_scan.secret_spans(docs(spark, more), folder).collect()
    assert spark.read.parquet(folder).count() - before == len(secret_scan.RULES)
    rules = [*secret_scan.BASE_RULES, secret_scan.Rule("pem", "-----BEGIN [A-Z ]*KEY-----", 0, version=2)]
    assert secret_scan.secret_spans(docs(spark, more), folder, rules).count() == len(more)
    newest = spark.read.parquet(folder).where("version = 2")
    assert newest.distinct().count() == newest.select("blob").distinct().count() == len({t or "" for t in texts}) + 1
    assert secret_scan.secret_spans(docs(spark, []), fresh_folder(spark, "ledger-test")).count() == 0


def test_quality_rules(spark):
    rows = [*ROWS, (20, "a b c d e x a b c d e y a b c d e", "s"), (21, "l1 #\nl1 #\n \nl1 #\n <>", "s"), (22, "p q r s t", "s")]
    got = {}
    for r in quality_rules(docs(spark, rows), docs(spark).where("doc_id = 1")).collect():
        got.setdefault(r["doc_id"], r)
    for i, text, _ in rows:
        t = text or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        ), i
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert got[1]["llr"] > 0 > got[6]["llr"]
    assert quality_rules(docs(spark, []), docs(spark)).count() == 0


def _chained(*values, seed=42):
    """Spark's xxhash64 of several values: each is hashed with the hash so far as its seed."""
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<Q", v), seed)
    return seed


def _grams(text):
    words = WORD.findall(text or "")
    hashes = [_chained(w) for w in words]
    grams = hashes + [_chained(a, b) for a, b in zip(hashes, hashes[1:], strict=False)] + [_chained("end", w[-3:]) for w in words]
    return [g % quality_rules_module.BUCKETS for g in grams]


def test_quality_ratio_against_plain_counts(spark):
    rows = [(i, " ".join(f"w{(i * k) % 13}" for k in range(i % 29)), "s") for i in range(60)] + ROWS
    trusted = set(range(0, 60, 4)) | {5, 77}
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, _t string, _trusted string")
    got = quality_rules(frame, spark.createDataFrame([(i,) for i in [*trusted, None, 4]], "doc_id long"), -0.1).collect()
    raw, target = Counter(), Counter()
    for i, text, _ in rows:
        raw.update(_grams(text))
        target.update(_grams(text) if i in trusted else ())
    n, t, size = sum(raw.values()), sum(target.values()), quality_rules_module.BUCKETS
    scores = [round(math.log((target[b] + 1) / (t + size)) - math.log((raw[b] + 1) / (n + size)), 4) for b in range(size)]
    expected = sorted((str(i), len(g := _grams(text)) and sum(scores[b] for b in g) / len(g)) for i, text, _ in rows)
    found = sorted((str(r["doc_id"]), r["llr"], r["kept"], r["base_failed"]) for r in got)
    assert len(found) == len(expected)
    for (i, llr, kept, failed), (j, ratio) in zip(found, expected, strict=True):
        assert i == j and llr == pytest.approx(ratio, abs=2e-6) and kept == (not failed and llr >= -0.1)


def test_token_counts(spark):
    encoding = token_counts._encoding(token_counts.default_ranks())
    lengths = [len(encoding.encode_ordinary(t or "")) for _, t, _ in ROWS]
    sums = token_counts.token_counts(docs(spark)).cache()
    for r in sums.collect():
        limit = r["length"]
        assert r["n_docs"] == lengths.count(limit) and r["docs_over"] == sum(n > limit for n in lengths)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths) and r["all_tokens"] == sum(lengths)
    limits = {r["context_limit"]: r["truncated_tokens"] for r in token_counts.at_limits(sums, [0, 7, 10**6]).collect()}
    assert limits == {x: sum(min(n, x) for n in lengths) for x in (0, 7, 10**6)}
    shares = {r["share"]: r["length"] for r in token_counts.quantiles(sums, [0.5, 1.0]).collect()}
    assert shares == {0.5: sorted(lengths)[math.ceil(0.5 * len(lengths)) - 1], 1.0: max(lengths)}
    assert token_counts.token_counts(docs(spark, [])).count() == 0


def test_segmentations(spark):
    got = segmentation.sample_segmentations(docs(spark), k=3)
    rows = got.collect()
    assert all(r["round_trip"] for r in rows)
    texts = {i: t or "" for i, t, _ in ROWS}
    for r in segmentation.decode_pieces(got).collect():
        assert r["text"] == texts[r["doc_id"]]
    drawn = Counter(r["doc_id"] for r in rows)
    assert drawn[3] == drawn[4] == 1 and drawn[5] == 3 and drawn[6] == 6
    for i in (1, 5, None):
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["sample"])
        assert len({tuple(r["ids"]) for r in mine}) == 3
        assert [r["perturbed"] for r in mine] == sorted((r["perturbed"] for r in mine), reverse=True)
        assert all(0 < r["inclusion"] <= 1 for r in mine)
    again = segmentation.sample_segmentations(docs(spark, ROWS[::-1]).repartition(5), k=3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert segmentation.sample_segmentations(docs(spark, [])).count() == 0


def test_segmentations_follow_their_distribution():
    words = segmentation.vocabulary(segmentation.default_model())
    n, keys = 20_000, segmentation.mix(np.arange(1, 20_001, dtype=np.uint64))
    drawn, chance = [Counter(), Counter()], {}
    for k, (_, columns) in enumerate(segmentation.encode_batch(pa.array(["abc"] * n), keys, 2, words)):
        for ids, log_prob in zip(columns[1].to_pylist(), columns[2].to_pylist(), strict=True):
            drawn[k][tuple(ids)] += 1
            chance[tuple(ids)] = math.exp(log_prob)
    assert sum(chance.values()) == pytest.approx(1, abs=1e-3)
    for ids, p in chance.items():
        second = sum(q * p / (1 - q) for other, q in chance.items() if other != ids)
        assert drawn[0][ids] / n == pytest.approx(p, abs=0.01) and drawn[1][ids] / n == pytest.approx(second, abs=0.01)


def _classed(n, rare):
    rng = np.random.default_rng(1)
    syllables = ["ta", "ren", "mo", "sil", "ve", "kor", "dun", "a", "lip"]
    texts = []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(30, 90))]
        if i % 4 == 0:
            for k in range(0, len(words), 20):
                words[k] = rare(rng)
        texts.append(" ".join(words))
    return texts, [int(i % 4 == 0) for i in range(n)]


def test_toxicity_learns_subwords():
    def insult(rng):
        word = list(str(rng.choice(["horrid", "wretch", "zgrub"])))
        word.insert(int(rng.integers(1, len(word))), str(rng.choice(list("xqj"))))
        return "".join(word)

    texts, marks = _classed(2400, insult)
    model = toxicity.fit(texts[:2000], marks[:2000], 0.25)
    scores = model.score(pa.array(texts[2000:]))
    assert np.mean((scores >= 0.5) == np.array(marks[2000:], bool)) > 0.95
    alone = model.score(pa.array(["", texts[2001]]))
    assert alone[1] == pytest.approx(scores[1]) and 0 < alone[0] < 0.7


def test_quality_learns_shapes():
    texts, marks = _classed(600, lambda rng: "word")
    texts = [t.upper().replace(" ", "!! ") if m else t for t, m in zip(texts, marks, strict=True)]
    model = quality_classifier.fit(texts[:400], marks[:400], 0.25)
    scores = model.score(pa.array(texts[400:]))
    assert np.mean((scores >= 0.5) == np.array(marks[400:], bool)) > 0.97 and model.temperature > 0
    alone = model.score(pa.array(["", texts[400]]))
    assert alone[1] == pytest.approx(scores[0], abs=1e-5) and 0 <= alone[0] <= 1


def test_quality_word_vectors_cover_all_documents(spark):
    """Also texts without a label and over the sample's length count, each neighbour within two words once."""
    long = " ".join(f"far{i % 61}" for i in range(5000))
    assert len(long) > quality_classifier.MAX_CHARS
    texts = ["one two one two", "THREE! four", "a b c c c d", "new vocabulary outside the sample", long, None, "", "x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")

    index, total = quality_classifier.index_vectors(), np.zeros((1 << quality_classifier.BUCKET_BITS, quality_classifier.DIMENSION))
    for text in filter(None, texts):
        ids = np.array(quality_classifier.terms(pa.array([text]))[:3]).T
        for i, own in enumerate(ids):
            for j in range(max(i - 2, 0), min(i + 3, len(ids))):
                if j != i:
                    for k in own:
                        total[k] += index[ids[j]].sum(0)
    total[-1] = 0
    expected = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality_classifier.corpus_vectors(rows), expected, atol=1e-12)

    model = quality_classifier.fit_from(rows, marks, F.lit(True))
    for word in ("vocabulary", "far7"):
        assert model.table[quality_classifier.terms(pa.array([word]))[0]].any()


@pytest.mark.parametrize("score", [toxicity.toxicity, quality_classifier.quality])
def test_classifiers_without_labels_and_with_odd_rows(spark, labels, score):
    got = score(docs(spark), labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    marks = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = score(docs(spark), marks).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert score(docs(spark, []), marks).count() == 0


def test_archives_are_read_by_several_tasks(spark):
    rows = [(i, f"http://a/{i}", f"<p>page {i % 40}</p>" * 100) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12)
    archives = warc.write_archives(pages, fresh_folder(spark, "warc-test"))
    read = warc.read_archives(archives)
    assert archives.count() > 1 and read.count() == 120
    if archives.count() > 2:
        assert read.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert read.where("record_type = 'response'").count() == 40
    hot = spark.createDataFrame([(i, "u", "x" * 9 if i else "y" * 9) for i in range(2000)], pages.schema)
    assert warc.build_dictionary(hot) == b""


def test_mixing_does_not_depend_on_partitions(spark):
    rows = [(i, f"{i % 5} same words here", "a") for i in range(3000)] + [(5000 + i, "x " * (i + 1), "b") for i in range(50)]
    rows += [(7, "repeated row of five words", "a")] * 2500 + [(7, "the doc_id with other five", "a")] * 3
    frame = docs(spark, rows)

    def copies(df):
        return sorted((r["doc_id"], r["text_key"], r["copies"]) for r in mixing.entropy_mix(df).collect())

    one = copies(frame.coalesce(1))
    assert len(one) == len(rows)
    assert one == copies(frame.repartition(7)) == copies(frame.orderBy(F.col("doc_id").desc()).repartition(3))


def test_columns_named_like_helpers(spark):
    folder = Path(mixing.__file__).parent
    names = {n for f in folder.glob("*.py") for n in re.findall(r'"(_[a-z_]+)"', f.read_text())} - {"_text"}
    names |= {"row", "own", "copies", "kept", "y", "text_key", "label", "toxic", "held_out", "path", "unit"} - set(docs(spark).columns)
    extra = sorted(names)
    plain = docs(spark)
    wide = plain.select("*", *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in extra])

    def unchanged(df):
        assert df.columns == wide.columns
        for r in df.collect():
            assert all(r[n] == n + ("-" if r["doc_id"] is None else str(r["doc_id"])) for n in extra)

    unchanged(drop_copies(wide))
    unchanged(mixing.mixed_documents(wide))
    model = toxicity.fit(["a bad word", "a good word"] * 3, [1, 0] * 3, 0.5)
    name = free_name(wide, "_toxicity")
    scored = toxicity.score_texts(wide, model, *wide.columns, score_name=name)
    unchanged(scored.drop(name))
    marks = spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    for found, expected in (
        (quality_rules(wide, marks), quality_rules(plain, marks)),
        (minhash.near_duplicates(wide), minhash.near_duplicates(plain)),
        (exact_groups(wide).drop("row_id"), exact_groups(plain).drop("row_id")),
        (mixing.entropy_mix(wide), mixing.entropy_mix(plain)),
        (segmentation.sample_segmentations(wide), segmentation.sample_segmentations(plain)),
    ):
        assert found.columns == expected.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_all_segmentations_of_short_texts():
    words = segmentation.vocabulary(segmentation.default_model())
    texts = ["a", "t", "A I", "a a a", "it"]
    lattices = segmentation.build_lattices(texts, words)

    def ways(place):
        if lattices.edge[place, 0] == -1:
            return [((), 0.0)]
        found = []
        for n in np.flatnonzero(lattices.edge[place] != -1) + 1:
            q = lattices.log[place, n - 1] + lattices.beta[place + n] - lattices.beta[place]
            found += [((int(lattices.edge[place, n - 1]), *rest), q + p) for rest, p in ways(place + n)]
        return found

    expected = []
    for number in range(len(texts)):
        every = [((), 0.0)]
        for place in lattices.begins[lattices.unit_of_doc[number] : lattices.unit_of_doc[number + 1]]:
            every = [(a + b, p + q) for a, p in every for b, q in ways(place)]
        expected.append(dict(every))
    assert sum(map(len, expected)) > 2 * len(texts) and all(sum(map(math.exp, e.values())) == pytest.approx(1) for e in expected)
    most = max(map(len, expected))
    for k in (1, 2, 3, most + 1):
        drawn = [{} for _ in texts]
        keys = np.arange(1, len(texts) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for rows, columns in segmentation.encode_batch(pa.array(texts), keys, k, words):
            ids, logs, gumbels, inclusion, same = (c.to_pylist() for c in columns[1:])
            assert all(same)
            for i, row in enumerate(rows):
                drawn[row][tuple(ids[i])] = (logs[i], gumbels[i], inclusion[i])
        for found, every in zip(drawn, expected, strict=True):
            assert len(found) == min(k, len(every)) and set(found) <= set(every)
            assert all(v[0] == pytest.approx(every[s], abs=1e-5) for s, v in found.items())
            order = [v[1] for v in found.values()]
            assert order == sorted(order, reverse=True)
            assert all((v[2] == 1) or k < len(every) for v in found.values())
            assert all(0 < v[2] <= 1 for v in found.values())


def test_long_labelled_texts_are_learned_from(spark):
    long = "begin " + "mid " * 40_000 + "finish"
    frame = docs(spark, [(1, long, "a"), (2, "short", "a"), (3, None, "a"), (4, "other", "a")])
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, None), (9, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in training_sample(frame, marks, "toxic", F.lit(True), 10, 2_000).collect()}
    assert set(got) == {1, 2} and got[2]["text"] == "short"
    assert got[1]["y"] == 1 and got[1]["text"].startswith("begin mid") and got[1]["text"].endswith("finish")
    assert len(got[1]["text"]) == 2_000 + PIECES - 1


def test_toxicity_scores_against_plain_sums(spark):
    rng = np.random.default_rng(8)
    model = toxicity.Model(rng.normal(0, 3, 1 << toxicity.BUCKET_BITS).astype(np.float32), -0.3)

    def bucket(gram):
        h = len(gram)
        for byte in gram:
            h = (h * 0x01000193 + byte * 0x9E3779B1) % 2**32
            h ^= h >> 15
        h = h * 0x85EBCA6B % 2**32
        return (h ^ (h >> 13)) >> (32 - toxicity.BUCKET_BITS)

    def plain(text):
        words = [w.encode().lower() for w in WORD.findall(text or "")]
        grams = [s[i : i + n] for s in (b" " + w + b" " for w in words) for n in toxicity.GRAMS for i in range(len(s) - n + 1)]
        distinct = len(set(words))
        mean = sum(float(model.evidence[bucket(g)]) for g in grams) / max(len(grams), 1)
        return 1 / (1 + math.exp(-(model.bias + mean * distinct / (distinct + toxicity.SHRINK))))

    texts = [r[1] for r in ROWS] + ["a", "i a i", "BAD Words bad wörds\n\x0bx", " ".join(f"w{i}" for i in rng.integers(0, 90, 400))]
    got = toxicity.score_texts(docs(spark, [(i, t, "a") for i, t in enumerate(texts)]), model, "doc_id").collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({i: plain(t) for i, t in enumerate(texts)}, abs=1e-6)


def test_fitting_toxicity_keeps_few_bytes_per_bucket_of_a_text():
    import random
    import tracemalloc

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=800)) for _ in range(2000)]
    entries = len(toxicity._bags(texts)[0])
    tracemalloc.start()
    toxicity.fit(texts, [i % 2 for i in range(2000)], 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    fixed = 64 << 20  # embeddings with their moments, one batch
    assert entries > 2_000_000 and peak < fixed + 16 * entries


def test_a_walk_hashes_every_piece_once(monkeypatch):
    words = segmentation.vocabulary(segmentation.default_model())
    lattices = segmentation.build_lattices(["the quick brown fox jumps over the lazy dog " * 20], words)
    units = np.arange(len(lattices.begins))
    keys = np.full(len(units), 7, np.uint64)
    before = segmentation._walk(lattices, units, lattices.begins, keys, 1)
    hashed = []
    plain = segmentation.mix
    monkeypatch.setattr(segmentation, "mix", lambda x: hashed.append(len(x)) or plain(x))
    unit, place, length = segmentation._walk(lattices, units, lattices.begins, keys, 1)
    assert sum(hashed) <= 2 * len(units) + len(place)
    assert all((a == b).all() for a, b in zip(before, (unit, place, length), strict=True))


def test_shares_of_lengths_equal_the_dense_formula():
    words = segmentation.vocabulary(segmentation.default_model())
    lattices = segmentation.build_lattices(["sentence pieces of a text", "t", "ü 1"], words)
    place = np.flatnonzero(lattices.edge[:, 0] != -1)
    after = np.minimum(place[:, None] + np.arange(1, lattices.log.shape[1] + 1), len(lattices.beta) - 1)
    ways = np.where(lattices.edge[place] != -1, lattices.log[place].astype(np.float64) + lattices.beta[after], -np.inf)
    assert (lattices.shares(place) == np.exp(ways - lattices.beta[place][:, None])).all()
