"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio.

The method compares two multinomials over hashed word unigrams and bigrams: the *trusted target*
(documents labelled good) and the *raw corpus* (all documents).  A document's score is the mean of
``log(p_target / p_raw)`` over its n-grams, so length does not matter, and it is kept when that
mean is at least ``threshold``: the decision is deterministic.

DataFrame functions only.  Both multinomials have a fixed number of buckets: the counts are
map-side sums over every n-gram of every document (a hot word is one row per task and bucket),
and the weights are one array of ``buckets`` doubles, read as a scalar subquery.  Up to
``BROADCAST_IDS`` trusted ids (counted) are broadcast and no document moves; beyond, each document's
buckets (two bytes an n-gram, no text) meet the ids in an ordinary join.  Results are the same.
The rules themselves are per-row expressions without any shuffle.

Defined results: NULL text counts as no words (base fails); very long texts are linear work; a document without n-grams has ratio
0; without trusted documents every ratio is 0; repeated rows are judged alike, each counts in
the raw multinomial; any further columns are carried by the caller through ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.store import written

BROADCAST_IDS = 1_000_000
BUCKETS = 1 << 13
THRESHOLD = -0.1
SMOOTHING = 1.0
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda variable, not a repeated expression)."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BLANK, -1), lambda w: w != "")


def hashed_grams(hashes: Column, buckets: int) -> Column:
    """Buckets of the unigrams and bigrams of an array of word hashes."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
                      lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i)), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def repeated_words(words: Column, hashes: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word windows that occur at least twice in the array.

    Windows are compared by hash first; only where two hashes agree are the windows themselves
    compared, as text (words hold no blanks, so joining them is reversible).
    """
    places = lambda a: F.sequence(F.lit(1), F.size(a) - (window - 1))
    hashed = lambda h: F.transform(places(h), lambda i: F.xxhash64(F.slice(h, i, window)))

    def covered(w: Column) -> Column:
        windows = F.array_sort(F.transform(places(w), lambda i: F.struct(F.array_join(F.slice(w, i, window), " ").alias("text"), i.alias("at"))))
        twice = let(windows, lambda a: F.filter(a, lambda x, j: (x["text"] == F.get(a, j - 1)["text"]) | (x["text"] == F.get(a, j + 1)["text"])
                                                | F.lit(False)))
        at = F.array_sort(F.transform(twice, lambda x: x["at"]))
        steps = let(at, lambda p: F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window)))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    any_twice = let(hashed(hashes), lambda a: F.size(F.array_distinct(a)) < F.size(a))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(
        F.when(any_twice, covered(words)).otherwise(F.lit(0).cast("long")))


def gram_counts(docs: DataFrame, ids: DataFrame, buckets: int, broadcast: bool) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents and of those in ``ids`` (distinct ``_id``)."""
    # the hashes are bound: as a plain expression they would be computed anew for every bigram
    grams = let(F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)), lambda h: hashed_grams(h, buckets))
    if broadcast:
        marked = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left")
        each = marked.select(F.explode(grams).alias("bucket"), F.col("_id").isNotNull().cast("long").alias("t"))
        return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    kind = "array<smallint>" if buckets <= 1 << 15 else "array<int>"
    raw = docs.select(F.explode(grams).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"))
    compact = docs.where("doc_id IS NOT NULL").select("doc_id", grams.cast(kind).alias("grams"))
    target = (compact.join(ids, F.col("doc_id") == F.col("_id")).select(F.explode(F.col("grams").cast("array<int>")).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("target")))
    return raw.join(target, "bucket", "left").fillna(0, ["target"])


def corpus_weights(counts: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row, ``weights``: log(p_target / p_raw) per bucket, from (bucket, raw, target) rows."""
    sums = counts.agg(F.collect_list(F.struct("bucket", "raw", "target")).alias("rows"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    by_bucket = F.map_from_entries(F.transform("rows", lambda x: F.struct(x["bucket"], x)))
    target = lambda x: (F.coalesce(x["target"], F.lit(0)) + smoothing) / (F.col("n_target") + smoothing * buckets)
    raw = lambda x: (F.coalesce(x["raw"], F.lit(0)) + smoothing) / (F.col("n_raw") + smoothing * buckets)
    each = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: let(F.col("_m")[b], lambda x: F.log(target(x) / raw(x))))
    flat = F.array_repeat(F.lit(0.0), buckets)
    return sums.withColumn("_m", by_bucket).select(F.when(F.col("n_target") > 0, each).otherwise(flat).alias("weights"))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
          smoothing: float = SMOOTHING, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    The trusted target is all documents labelled good; the raw corpus is all of ``docs``.  One row
    per row of ``docs``.
    """
    base = docs.select("doc_id", F.col("text").alias("text"))
    ids = written(labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct(), "trusted")
    weights = corpus_weights(gram_counts(base, ids, buckets, ids.count() <= broadcast_ids), buckets, smoothing)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    body = base.select("doc_id", word_array(F.col("text")).alias("words"), weights.scalar().alias("weights"),
                       F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                       let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"))

    def measured(w: Column) -> Column:
        def by_hash(h: Column) -> Column:
            grams = hashed_grams(h, buckets)
            ratio = let(F.struct(grams.alias("g"), F.col("weights").alias("w")),
                        lambda s: F.aggregate(s["g"], F.lit(0.0), lambda total, g: total + F.get(s["w"], g))
                        / F.greatest(F.size(s["g"]), F.lit(1)))
            return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                            repeated_words(w, h).alias("n_repeat_words"), ratio.alias("ratio"))
        return let(F.transform(w, lambda x: F.xxhash64(x)), by_hash)

    out = body.select("doc_id", "n_symbols", "n_dup_lines", let(F.col("words"), measured).alias("m"))
    out = out.select("doc_id", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.ratio")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      (~failed & (F.col("ratio") >= threshold)).alias("kept"), F.round("ratio", 9).alias("ratio"))
