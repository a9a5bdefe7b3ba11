"""Quality rules and a hashed n-gram log-likelihood ratio, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import SPACE, WORD, stage
from ontime.llm.membership import marked

BUCKETS = 1 << 14
WINDOW = 5
SYMBOLS = "#*$%&|<>"  # fixed by the result contract
THRESHOLD = -0.25
ENDING = 3


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it as a lambda variable in ``body``."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _n_repeat_words(hashes: Column, pairs: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` (five) words which occurs at least twice in the text."""
    n = F.size(hashes)

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(order: Column) -> Column:
            def twin(j: Column) -> Column:
                return F.coalesce(F.get(order, j)["h"], F.lit(None))

            again = F.filter(
                order,
                lambda x, j: F.coalesce(twin(j - 1) == x["h"], F.lit(False)) | F.coalesce(twin(j + 1) == x["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def length(starts: Column) -> Column:
            gaps = F.transform(starts, lambda p, j: F.least(F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        repeated = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeated, _let(placed, lambda order: _let(positions(order), length))).otherwise(0)

    # a window of five words: two neighbouring pairs and the word after them
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(F.get(pairs, i), F.get(pairs, i + 2), F.get(hashes, i + 4))
    )
    return F.when(n > WINDOW, _let(windows, covered)).otherwise(0)


def _pairs(hashes: Column) -> Column:
    """One hash per pair of neighbouring words."""
    places = F.sequence(F.lit(0), F.size(hashes) - 2)
    return F.when(
        F.size(hashes) > 1, F.transform(places, lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)))
    ).otherwise(F.array().cast("array<bigint>"))


def _ending(word: Column) -> Column:
    return F.xxhash64(F.lit("end"), F.substring(word, -ENDING, ENDING))


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1))


def _hashed(documents: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the text, its words, and hashes of the words and of pairs of neighbours."""
    texts = documents.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    words = texts.select("*", _words(F.col("_text")).alias("_words"))
    hashed = words.select("*", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    return hashed.select("*", _pairs(F.col("_hashes")).alias("_pairs"))


def gram_scores(documents: DataFrame, trusted: DataFrame) -> list[float]:
    """log P(bucket | trusted) - log P(bucket | all documents) for every bucket, in order of the bucket.

    Counts run over all documents and all trusted ones (those whose doc_id is in ``trusted``), pre-aggregated per task to
    ``BUCKETS`` counters; with add-one smoothing. Which documents are trusted is decided without shuffling their texts.
    N-grams are the single words, the pairs of neighbours, and the words' last characters. The result has a fixed size.
    """
    every = documents.select(F.col("doc_id").alias("_key")).where("_key is not null").distinct()
    ids = trusted.select(F.col("doc_id").alias("_key")).distinct()
    inside = stage(every.join(ids, "_key", "left_semi"), "trusted")
    outside = stage(every.join(inside, "_key", "left_anti"), "untrusted")
    texts = marked(documents.select("doc_id", "text"), F.col("doc_id"), inside, outside, "_trusted")
    grams = _hashed(texts, "_trusted").select(
        F.col("_trusted").cast("long").alias("_trusted"),
        F.concat("_hashes", "_pairs", F.transform("_words", _ending)).alias("_grams"),
    )
    # outer: a plain explode first filters by the size of the array, for which all of it would be made twice
    grams = grams.select("_trusted", F.explode_outer("_grams").alias("_gram"))
    counts = grams.where("_gram is not null").groupBy(_bucket(F.col("_gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("_trusted").alias("t"))
    sizes = {r["bucket"]: (r["n"], r["t"]) for r in counts.collect()}  # at most BUCKETS rows
    raw = sum(n for n, _ in sizes.values()) + BUCKETS
    target = sum(t for _, t in sizes.values()) + BUCKETS
    found = (sizes.get(b, (0, 0)) for b in range(BUCKETS))
    return [round(math.log((t + 1) / target) - math.log((n + 1) / raw), 4) for n, t in found]


def quality_rules(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts of every text, whether the base rules reject it, and the verdict of the likelihood ratio.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and llr: the sum of the
    scores of all n-grams of the text divided by their number (0 without words). A document is kept when the base rules
    pass and llr >= ``threshold``; the rule is the same for every document, whatever the table's size.

    A null text has no words and fails the base rules. Rows that repeat a doc_id are judged each on its own text. Without
    trusted rows every ratio is that of a flat target. Empty table: empty result; other columns are ignored.
    """
    scores = gram_scores(documents, trusted)
    table = F.split(F.lit(",".join(map(str, scores))), ",").cast("array<double>")
    hashed = _hashed(documents.select("doc_id", "text"), "doc_id")
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))

    def add(total: Column, gram: Column) -> Column:
        return total + F.get(table, _bucket(gram))

    ratio = F.aggregate("_words", F.lit(0.0), lambda total, word: add(total, _ending(word)))
    for grams in ("_hashes", "_pairs"):
        ratio = F.aggregate(grams, ratio, add)
    parts = hashed.select(
        "doc_id",
        F.size("_hashes").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("_hashes"), F.col("_pairs")).cast("long").alias("n_repeat_words"),
        ratio.alias("_total"),
        (2 * F.size("_hashes") + F.size("_pairs")).alias("_n_grams"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = parts.withColumn("llr", F.round(F.coalesce(F.try_divide("_total", "_n_grams"), F.lit(0.0)), 6))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr",
    )
