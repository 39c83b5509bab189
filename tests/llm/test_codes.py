import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtforge.llm import codebooks, merkle
from conftest_llm import AWKWARD, make_docs, sentence  # noqa: F401

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def plain_codes(rows, parts, entries, rounds):
    """(vec_id, code, error, label) rows and the codebook digest, in plain Python."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = lambda x: (lambda n, d: 4096 * n // d)(*x.as_integer_ratio())
    length = len(fine[0][1])
    cuts = np.cumsum([0] + [len(x) for x in np.array_split(np.arange(length), parts)])
    split = lambda v: [tuple(whole(x) for x in v[a:b]) for a, b in zip(cuts, cuts[1:])]
    cut = {i: split(r[1]) for i, r in enumerate(fine) if len(r[1]) == length}
    first = [cut[i] for i in range(min(entries, len(fine))) if i in cut]
    books = [[v[p] for v in first] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return {i: [min((away(v[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for i, v in cut.items()}

    for _ in range(rounds):
        members = defaultdict(list)
        for i, found in assign().items():
            for p, (_, k) in enumerate(found):
                members[p, k].append(cut[i][p])
        for (p, k), vs in members.items():
            books[p][k] = tuple(sum(x) // len(vs) for x in zip(*vs))
    last = assign()
    out = [(r[0], "".join(f"{k:02x}" for _, k in last[i]) if i in last else None, min(sum(d for d, _ in last[i]), (1 << 63) - 1) if i in last else None, r[2])
           for i, r in enumerate(fine)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vectors(n, length, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, length))
    return [(i, [float(np.float32(x)) for x in centres[i % 7] + spread * rng.normal(size=length)], None if i % 5 == 0 else i % 3) for i in range(n)]


AWKWARD_VECTORS = [(900, None, 1), (901, [None] * 12, 1), (902, [float("nan")] + [0.0] * 11, 1), (903, [float("inf")] + [0.0] * 11, None), (None, [0.25] * 12, 1),
                   (3, [0.5] * 12, 2), (3, [0.5] * 12, 2), (904, [0.1] * 5, 7), (905, [], 7), (906, [-0.0] * 12, None)]


@pytest.mark.parametrize("rows", [vectors(150, 12) + AWKWARD_VECTORS, vectors(9, 12), [(i, [0.5] * 12, 1) for i in range(40)],
                                  vectors(60, 12) + [(70, [1e30] * 12, 1), (71, [-1e300] + [3.0] * 11, 2)], vectors(40, 13), vectors(30, 5)])
def test_codes_match_plain_python(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("x")).withColumn("vector", F.lit(1)).withColumn("error", F.lit(2))
    for limit in (100, 0):
        got = codebooks.compress_report(df.repartition(5), rounds=3, broadcast_labels=limit).collect()
        want, digest = plain_codes(rows, 8, 16, 3)
        assert sorted(((r.vec_id, r.code, r.error, r.label) for r in got), key=str) == sorted(want, key=str)
        assert {r.codebooks_sha256 for r in got} == {digest}
        sums = defaultdict(int)
        for _, _, error, label in want:
            sums[label] += error or 0
        assert all(r.label_error == min(sums[r.label], (1 << 63) - 1) or r.label_error is None and r.label == 7 for r in got)


def test_codes_of_nothing(spark):
    assert codebooks.compress_report(spark.createDataFrame([], VECTORS)).collect() == []
    assert codebooks.compress_report(spark.createDataFrame(AWKWARD_VECTORS[:2], VECTORS)).collect() == []
    with pytest.raises(ValueError):
        codebooks.compress_report(spark.createDataFrame([], VECTORS), entries=300)


small = st.lists(st.integers(-6, 6), min_size=3, max_size=3)


@settings(max_examples=200, deadline=None)
@given(st.lists(small, min_size=1, max_size=40), st.lists(small, min_size=1, max_size=30), st.integers(2, 6), st.sampled_from([1, 1000, 1 << 22]))
def test_the_tree_finds_the_first_nearest_entry(entries, points, degree, scale):
    """Small coordinates make very many ties and repeated entries."""
    entries, points = np.array(entries) * scale, np.array(points) * scale
    at, best = codebooks.nearest_entries(codebooks.Gnat(entries, degree=degree), points)
    squares = ((points[:, None, :] - entries[None]) ** 2).sum(2)
    assert at.tolist() == squares.argmin(1).tolist() and best.tolist() == squares.min(1).tolist()


def test_the_tree_leaves_subtrees_out():
    rng = np.random.default_rng(5)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    entries = (centres[:, None] + rng.integers(-50, 50, (16, 16, 8))).reshape(-1, 8)
    points = entries[rng.integers(0, len(entries), 500)] + rng.integers(-20, 20, (500, 8))
    best, at = np.full(500, 1 << 62), np.full(500, 999)
    work = codebooks.Gnat(entries).search(points, np.arange(500), best, at)
    assert work < 0.5 * len(entries) * len(points)
    assert at.tolist() == ((points[:, None, :] - entries[None]) ** 2).sum(2).argmin(1).tolist()


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) per row, in plain Python."""
    lower = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def build(nodes):
        """Root and, per node, its proof as (left, right) lists."""
        paths, place = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, at in enumerate(place):
                first = at - at % 16
                paths[i].append((nodes[first:at], nodes[at + 1:first + 16]))
                place[i] = at // 16
            nodes = [digest(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        return nodes[0], paths

    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = digest(*map(field, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        trees[source].append((doc_id, leaf, digest(*map(field, (doc_id, source, lang, n_chars, lower(text)))) if hit else leaf))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = []
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        below.append(build([r[1] for r in trees[name]]))
    root, above = build([subroot for subroot, _ in below])
    out = []
    for name, (subroot, paths), upper in zip(names, below, above):
        for (doc_id, leaf, changed), path in zip(trees[name], paths):
            node = changed
            for left, right in path + upper:
                node = digest(*left, node, *right)
            out.append((doc_id, leaf, subroot, root, digest(*(d for left, right in path + upper for d in left + right)), node, node == root, name))
    return out


def check_manifest(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in ("tree", "lo", "digest", "leaf", "row", "path")})
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.source) for r in merkle.manifest_report(docs.repartition(7)).collect()]
    want = plain_manifest(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    return want


def test_manifest_matches_plain_python(spark):
    rows = [(i, f"Text No. {i} " + sentence(i, i % 7), "en", f"s{0 if i % 3 else i % 41}", i) for i in range(700)]  # one source with two thirds of the rows
    want = check_manifest(spark, rows)
    assert 0 < sum(not r[6] for r in want) < len(want) / 3
    check_manifest(spark, rows[:1])
    check_manifest(spark, rows[:17])


def test_manifest_of_awkward_rows(spark):
    rows = [(i, t, None if i == 7 else "en", None if i in (1, 2, 4) else "é" if i == 5 else "" if i == 8 else "Z", len(t or "")) for i, t in AWKWARD]
    rows += [(5, "A" * 300_000, "de", None, None), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(77, "HOT Id", "en", "hot", 1)] * 300 + [(77, f"Hot id {i}", "en", "hot", 1) for i in range(40)]
    want = check_manifest(spark, rows)
    assert len(want) == len(rows)
    assert merkle.manifest_report(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")).collect() == []


def test_nested_intervals_and_ranks(spark):
    leaves = spark.range(5000).selectExpr("concat('s', if(id % 3 = 0, 0, id % 5)) AS tree", "sha2(cast(id AS string), 256) AS digest", "id AS row", "id * 7 % 5003 AS key")
    ranks = merkle.ranked(leaves.repartition(13), "tree", ["key"], "t").collect()
    by_tree = defaultdict(list)
    for r in ranks:
        by_tree[r.tree].append(r)
    for rows in by_tree.values():
        rows.sort(key=lambda r: r.lo)
        assert [r.lo for r in rows] == list(range(len(rows))) and all(r.hi == r.lo + 1 and r.n == len(rows) for r in rows)
        assert [r.key for r in rows] == sorted(r.key for r in rows)
    runs = merkle.levels(merkle.ranked(leaves, "tree", ["key"], "t"), "t")
    assert len(runs) == 3
    for level, frame in enumerate(runs, 1):
        for r in frame.collect():
            assert r.lo == r.bucket * 16 ** level and r.hi == min(r.n, r.lo + 16 ** level)
            assert [c.lo for c in r.children] == list(range(r.lo, r.hi, 16 ** (level - 1))) and r.children[-1].hi == r.hi
