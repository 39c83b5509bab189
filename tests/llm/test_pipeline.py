"""The whole pipeline against plain Python, stage by stage chained over the rows that the votes keep."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from abtforge.llm import quality
from abtforge.session import work_dir
from conftest_llm import DOCS, LABELS, sentence
from test_dedup import brute_components, brute_fingerprint
from test_mix_pack import brute_targets

SIZE = re.compile(r"[^\x20\x09-\x0D]+")


def fixture_rows():
    shared = sentence(700, 60)
    rows = [(i, sentence(i, 60 + i % 7), f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, f"{sentence(200 + i, 40)} {shared} {sentence(300 + i, 30)}", "s1") for i in range(6)]  # a passage that repeats
    rows += [(120 + i, sentence(5, 65) + (" é" if i else ""), "s2") for i in range(4)]  # near copies of row 5
    rows += [(140, None, "s0"), (141, "", None), (142, " \n", "s3"), (None, sentence(800, 50), "s1"), (143, sentence(801, 5000), None)]
    rows += [(7, sentence(7, 60), "s3")] * 2  # repeated rows
    rows += [(200 + i, " | ".join(sentence(i, 50).split()).replace("w", "W"), "junk") for i in range(20)]
    labels = [(i, 1, 0) for i in range(40)] + [(200 + i, 0, 0) for i in range(20)] + [(100, 1, 0), (143, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark):
    rows, labels = fixture_rows()
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    base = work_dir(spark, "t_pipeline")
    for c in ("score", "fp", "root", "spans", "copies", "turn", "digest", "_row", "key"):  # names that stages use themselves
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{base}/labels.parquet")
    return base


def without_repeats(texts, length=200):
    """Texts without each byte under a string of ``length`` bytes that starts anywhere else."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for t, b in zip(texts, raw):
        cut = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cut[p:p + length] = b"\1" * length
        parts, at = [], 0
        for m in re.finditer(rb"\x01+", bytes(cut)):
            parts.append(b[at:m.start()])
            at = m.end()
        out.append(t if not any(cut) else "".join(p.decode("utf-8", "ignore") for p in [*parts, b[at:]]))
    return out


def draws(rows):
    """Copies of each row (doc_id, text, source)."""
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(SIZE.findall(t or ""))
    target, turns, out = brute_targets(dict(sizes)), collections.Counter(), []
    for i, t, s in sorted(rows, key=lambda r: (r[2] is not None, r[2] or "")):
        digest = hashlib.md5((t or "").encode()).hexdigest()
        turn = turns[i, digest]
        turns[i, digest] += 1
        rate = target[s] / sizes[s] if sizes[s] else 1.0
        draw = int(hashlib.md5(f"mix-1:{'' if i is None else i}:{digest}:{turn}".encode()).hexdigest()[:8], 16) / 2 ** 32
        out.append((i, t, int(rate) + (draw < rate - int(rate))))
    return out


def test_pipeline_matches_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    voted = {(r.doc_id, r.score >= quality.THRESHOLD) for r in quality.quality_report(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    rows, _ = fixture_rows()
    kept = [r for r in rows if (r[0], True) in voted]
    assert 20 <= sum(1 for r in rows if (r[0], False) in voted) < len(rows) / 2
    values = [brute_fingerprint(t) for _, t, _ in kept]
    groups = brute_components(values, [i for i, _, _ in kept])
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0))
    first = {}
    for k in order:
        first.setdefault((groups[k], values[k]) if groups[k] is None else groups[k], k)
    near = [kept[k] for k in sorted(first.values())]
    cut = [(i, t, s) for (i, _, s), t in zip(near, without_repeats([t for _, t, _ in near]))]
    assert sum(len(t or "") for _, t, _ in cut) < sum(len(t or "") for _, t, _ in near)
    mixed = draws(cut)
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t, n in mixed:
        for at, x in enumerate([*tokens.encode(t or "", add_special_tokens=False).ids, 1]):
            want[i, at, x] += n
    got, windows = collections.Counter(), collections.Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length
        windows[r.sequence_id] += r.length
        for k, x in enumerate(ids.tolist()):
            got[r.doc_id, r.start + k, x] += 1
    assert got == +want
    assert all(n <= 2048 for n in windows.values())


def test_pipeline_of_an_empty_table(spark, folder):
    base = work_dir(spark, "t_pipeline_empty")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{base}/{name}.parquet")
    assert corpus_pipeline.run(spark, base).collect() == []
