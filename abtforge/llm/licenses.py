"""License scan: ordered signature rules behind a keyword prefilter.

Texts are normalised to words with single blanks.  Gates, keywords and rules all read this form, so
it does not matter what separates the words of a text.  Texts that hold none of the gate strings
get their word count and nothing else; on the others every rule whose keyword they hold is tried,
and its detections are intervals of the normalised text.  A detection that lies inside another one
of a better or equal level is suppressed, so "Apache License 2.0" is not also reported as an
unversioned Apache license.

DataFrame functions only, one pass, no shuffle: rules are an array constant, detections are arrays
per row, and suppression is one ordered pass over a row's detections with the furthest end seen
per level.

Defined results: NULL text is empty; without words or detections the labels are empty strings, the
score 0 and the word positions NULL; base labels always stay, whatever the method suppresses;
repeated rows are scanned alike; further columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.license_rules import CONFIDENCE, GATES, all_rules

# phrase and label: fixed values
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def single_blanks(text: Column) -> Column:
    """The words of a text in any case, with one blank between them."""
    return F.trim(F.regexp_replace(text, F.lit(_BETWEEN_WORDS), F.lit(" ")))


def word_count(spaced: Column) -> Column:
    """Number of words of a text with single blanks."""
    blanks = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", 0).otherwise(blanks + 1).cast("long")


def _whole(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _before(text: Column, characters: Column) -> Column:
    """Words in the first ``characters`` characters of a text that starts with a blank."""
    return F.regexp_count(F.substring(text, F.lit(1), characters), F.lit(" ")).cast("long") - 1


def _places(text: Column, pattern: Column) -> Column:
    """(start, end) character offsets of all matches, from the pieces between them."""
    found, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    zipped = F.transform(found, lambda m, i: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["size"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("s"), (acc["at"] + x["gap"] + x["size"]).alias("e")))).alias("out"))
    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def detections(text: Column, rules: list[tuple[int, str, str, str]]) -> Column:
    """Unsuppressed (label, level) of a normalised text."""
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(level).alias("level"), F.lit(label).alias("label"), F.lit(" " + keyword).alias("keyword"),
                               F.lit(_whole(pattern)).alias("pattern")) for i, (level, label, keyword, pattern) in enumerate(rules)])
    tried = F.filter(table, lambda r: F.contains(text, r["keyword"]))
    every = F.flatten(F.transform(tried, lambda r: F.transform(_places(text, r["pattern"]), lambda p: F.struct(
        p["s"].alias("s"), (-p["e"]).alias("e"), r["level"].alias("level"), r["i"].alias("i"), r["label"].alias("label")))))
    ordered = F.array_sort(every)  # by start, longest first, then level and rule
    none = F.array(*[F.lit(0)] * len(CONFIDENCE))
    start = F.struct(none.alias("ends"), F.array().cast("array<struct<label:string,level:int>>").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        inside = F.array_max(F.slice(acc["ends"], F.lit(1), d["level"] + 1)) >= -d["e"]
        ends = F.transform(acc["ends"], lambda x, i: F.when(i == d["level"], F.greatest(x, -d["e"])).otherwise(x))
        kept = F.concat(acc["kept"], F.array(F.struct(d["label"].alias("label"), d["level"].alias("level"))))
        return F.struct(ends.alias("ends"), F.when(inside, acc["kept"]).otherwise(kept).alias("kept"))

    return F.aggregate(ordered, start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, rules: list[tuple[int, str, str, str]] | None = None, gates: tuple[str, ...] = GATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per row."""
    rules = all_rules() if rules is None else rules
    spaced = docs.select("doc_id", single_blanks(F.coalesce(F.col("text"), F.lit(""))).alias("spaced"))
    # lower() keeps every ASCII match, so it can open the gate; the rules read exactly the ASCII letters in lower case
    opened = spaced.select("doc_id", "spaced", F.concat(F.lit(" "), F.lower("spaced"), F.lit(" ")).alias("lowered"))
    gate = F.lit(False)
    for words in gates:
        gate = gate | F.contains(F.col("lowered"), F.lit(words))
    normal = F.concat(F.lit(" "), F.translate(F.col("spaced"), string.ascii_uppercase, string.ascii_lowercase), F.lit(" "))
    rows = opened.select("doc_id", word_count(F.col("spaced")).alias("n_words"), F.when(gate, normal).alias("normal"))

    def measured(t: Column) -> Column:
        counts = [F.regexp_count(t, F.lit(_whole(p))).cast("long") for p, _ in BASE]
        firsts = [F.when(n > 0, _before(t, F.regexp_instr(t, F.lit(_whole(p))) - 1)) for n, (p, _) in zip(counts, BASE)]
        last_gap = [F.length(F.element_at(F.split(t, _whole(p), -1), -1)) for p, _ in BASE]
        lasts = [F.when(n > 0, _before(t, F.length(t) - gap - len(p))) for n, gap, (p, _) in zip(counts, last_gap, BASE)]
        labels = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(counts, BASE)]))
        return F.struct((counts[0] + counts[1] + counts[2]).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
                        F.array_sort(labels).alias("base"), detections(t, rules).alias("kept"))

    scanned = rows.select("doc_id", "n_words", F.when(F.col("normal").isNotNull(), let(F.col("normal"), measured)).alias("m"))
    confidence = F.array(*[F.lit(c) for c in CONFIDENCE])
    score = F.array_max(F.transform("m.kept", lambda d: F.get(confidence, d["level"])))
    every = F.array_sort(F.array_distinct(F.concat("m.base", F.transform("m.kept", lambda d: d["label"]))))
    return scanned.select("doc_id", "n_words", F.coalesce("m.n_base", F.lit(0).cast("long")).alias("n_base"), "m.first_word", "m.last_word",
                          F.coalesce(F.array_join("m.base", ","), F.lit("")).alias("base_labels"), F.coalesce(F.array_join(every, ","), F.lit("")).alias("labels"),
                          F.coalesce(score, F.lit(0.0)).alias("score"))
