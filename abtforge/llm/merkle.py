"""Merkle manifest of a dataset: a digest per row, a tree per source, one root, a proof per row.

A leaf is the digest of a row's fields.  Within a source the leaves go by id, and runs of ``ARITY``
consecutive nodes become nodes of the next level until one is left, the subroot; the subroots, by
source, become the root in the same way.  A row's proof is its siblings on the way up: a reader who
trusts the root checks a row with them and nothing else.

Nested-interval labels: the leaves of a tree are ranked, and each node carries the interval
[lo, hi) of the ranks that it covers.  At level l nodes are bucketed by lo / ARITY^l, so a node meets
its ancestor of a level by an equality of tree and bucket and the containment of the intervals.
Within a parent the siblings are the difference: the children that end at or before the node's
interval, and those that begin at or after its end.

Data flow: texts are read once and never move; a leaf row holds id, source and digests.  Ranks come
from one range partitioning of these rows by (source, id, leaf, row number), so a source or id with
most rows is spread over many tasks, and from counts per source and partition.  A run is a grouping of ``ARITY``
rows at most, written per level; each level is ``ARITY`` times smaller.  The way down joins a level
with the labels of the one above, one row per run, until every run of leaves holds its path; the
last step opens the run into its rows.  The driver holds the number of levels only.

Defined results: NULL fields and empty texts have digests of their own; a NULL source is a source,
before all others; NULL ids come first in their source, are leaves like any other and are never
tampered; rows of equal id go by their leaf, so equal rows may change places, but not the result as
a whole; very long texts cost linear work; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.ranking import ranked
from abtforge.llm.store import written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5


def field_text(value: Column) -> Column:
    """``-`` for NULL, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: tuple[Column, ...]) -> Column:
    """Digest of a row: the sha256 of its fields' texts, one after the other."""
    return F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def runs(nodes: DataFrame, level: int, payload: tuple[str, ...] = ()) -> DataFrame:
    """The nodes of ``level`` with their children: (tree, n, bucket, lo, hi, digest, children).

    A tree of one leaf keeps that leaf's digest, without a level of its own.
    """
    child = F.struct("lo", "hi", "digest", *payload)
    grouped = (nodes.withColumn("bucket", F.floor(F.col("lo") / F.lit(ARITY ** level)))
               .groupBy("tree", "n", "bucket").agg(F.array_sort(F.collect_list(child)).alias("children")))
    digests = F.concat_ws("", F.col("children.digest"))
    return grouped.select("tree", "n", "bucket", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
                          F.when(F.col("n") > 1, F.sha2(digests.cast("binary"), 256)).otherwise(digests).alias("digest"), "children")


def levels(nodes: DataFrame, name: str, payload: tuple[str, ...] = ()) -> list[DataFrame]:
    """The runs of level 1, 2, ... of every tree in ``nodes`` (tree, n, lo, hi, digest, payload), each written."""
    out = [written(runs(nodes, 1, payload), f"{name}-runs")]
    most = out[0].agg(F.max("n")).first()[0] or 0
    while ARITY ** len(out) < most:
        level = len(out)
        upper = out[-1].where(F.col("n") > ARITY ** level).select("tree", "n", "lo", "hi", "digest")
        out.append(written(runs(upper, level + 1), f"{name}-runs"))
    return out


def is_top(level: int) -> Column:
    """True for a node of ``level`` that is the last of its tree."""
    return F.col("n") <= ARITY ** level if level == 1 else (F.col("n") <= ARITY ** level) & (F.col("n") > ARITY ** (level - 1))


def tops(by_level: list[DataFrame]) -> DataFrame:
    """(tree, n, digest): the root of every tree."""
    found = [r.where(is_top(i + 1)).select("tree", "n", "digest") for i, r in enumerate(by_level)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def opened(labelled: DataFrame, carried: list[str], payload: tuple[str, ...] = ()) -> DataFrame:
    """One row per child of labelled runs, its siblings put before the path of its parent."""
    each = labelled.select("tree", "n", "children", "path", *carried, F.explode("children").alias("_c"))
    own = F.col("_c")
    joined = lambda found: F.concat_ws("", F.transform(found, lambda x: x["digest"]))
    left = joined(F.filter("children", lambda x: x["hi"] <= own["lo"]))
    right = joined(F.filter("children", lambda x: x["lo"] >= own["hi"]))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return each.select("tree", "n", own["lo"].alias("lo"), own["hi"].alias("hi"), own["digest"].alias("digest"), *(own[p].alias(p) for p in payload),
                       F.when(F.col("n") > 1, F.concat(step, F.col("path"))).otherwise(F.col("path")).alias("path"), *carried)


def with_paths(by_level: list[DataFrame], roots: DataFrame, carried: list[str], payload: tuple[str, ...] = ()) -> DataFrame:
    """The leaves of all trees with ``path`` (array of left and right siblings, leaf to root).

    ``roots`` has (tree, n, path, carried): the path above each tree's root.
    """
    above = None
    for level in range(len(by_level), 0, -1):
        top = roots.where(is_top(level)).select("tree", "n", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), "path", *carried)
        above = top if above is None else above.select(*top.columns).unionByName(top)
        labels = above.select(F.col("tree").alias("_tree"), F.floor(F.col("lo") / F.lit(ARITY ** level)).alias("_bucket"),
                              F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *carried)
        inside = (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_bucket")) & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
        above = opened(by_level[level - 1].join(labels, inside), carried, payload if level == 1 else ())
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)


def manifest(leaves: DataFrame, payload: tuple[str, ...] = ()) -> DataFrame:
    """tree, lo, hi, n, digest, path, subroot, root and payload of every leaf.

    ``leaves`` has (tree, digest, row, payload): ``tree`` a text without NULLs, whose order is that
    of the trees, ``row`` a number that tells rows apart; leaves go by the payload's first column.
    """
    by_level = levels(ranked(leaves, "tree", [*payload[:1], "digest", "row"], "merkle"), "merkle", payload)
    subroots = tops(by_level).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.col("n").alias("leaves"))
    upper = levels(ranked(subroots, "tree", ["name"], "merkle-sources"), "merkle-sources", ("name", "leaves"))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    root = tops(upper).select("tree", "n", empty.alias("path"), F.col("digest").alias("root"))
    named = with_paths(upper, root, ["root"], ("name", "leaves"))
    roots = written(named.select(F.col("name").alias("tree"), F.col("leaves").alias("n"), "path", F.col("digest").alias("subroot"), "root"), "merkle-roots")
    return with_paths(by_level, roots, ["subroot", "root"], payload)


def manifest_report(docs: DataFrame, modulus: int = TAMPER_MODULUS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source: one row per row of ``docs``.

    Every ``modulus``-th row, by the crc32 of its id, is checked as if its text had been lower-cased.
    """
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0, F.lit(False))
    changed = leaf_digest(tuple((fields | {"text": lower_ascii(F.col("text"))}).values()))
    leaves = docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("tree"), leaf_digest(tuple(fields.values())).alias("digest"),
                         F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.when(tampered, changed).alias("changed"))
    out = manifest(written(leaves, "merkle-leaves"), ("doc_id", "changed"))
    out = out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                     folded(F.coalesce("changed", "digest"), F.col("path")).alias("folded_root"), "tree")
    source = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), source.alias("source"))
