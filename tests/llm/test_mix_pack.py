import collections
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from abtforge.llm import mixing, packing
from conftest_llm import AWKWARD, SF_SMALL, make_docs, sentence  # noqa: F401


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest, open_ = total - sum(cap * sizes[s] for s in capped), [s for s in order if s not in capped]
        level = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if level[s] > cap * sizes[s]}
        if not over:
            return level | {s: float(cap * sizes[s]) for s in capped}
        capped |= over


def test_mix_targets_and_copies(make_docs):
    rows = [(i, sentence(i, 5 + i % 40), ["a", "b", "c", "d", None][i % 5] if i % 7 else "hot") for i in range(700)]
    rows += [(1000 + i, None if i % 2 else " ", "empty") for i in range(4)] + [(2000, sentence(1, 3), "tiny"), (2000, sentence(1, 3), "tiny"), (None, "x y", "z")]
    got = mixing.mix_report(make_docs(rows).withColumnRenamed("lang", "target").withColumnRenamed("n_chars", "copies")).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(dict(sizes))
    taken = collections.Counter()
    for r in got:
        assert (r.source_size, pytest.approx(r.target)) == (sizes[r.source], want[r.source])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        assert r.copies in ((int(r.target / r.source_size), int(r.target / r.source_size) + 1) if r.source_size else (1,))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] + 60 for s in sizes)
    again = mixing.mix_report(make_docs(rows).repartition(5)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in got)


@pytest.mark.parametrize("same_text", [False, True])
def test_rows_that_share_an_id_draw_for_themselves(make_docs, same_text):
    """A third of the rows has no id, a third one id; with one text they are equal rows."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, sentence(1 if same_text and i % 3 < 2 else i, 4), "ab"[i // 3 % 2]) for i in range(3000)]
    docs = make_docs(rows).repartition(4)
    got = mixing.mix_report(docs).collect()
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
    want = brute_targets(dict(collections.Counter({"a": 6000, "b": 6000})))
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] for s in want), (taken, want)
    for key in (None, 7):  # within the hot ids as well
        part = [r for r in got if r.doc_id == key and r.source == "a"]
        assert abs(sum(r.taken for r in part) - sum(r.size for r in part) * want["a"] / 6000) <= 0.1 * sum(r.size for r in part)
    out = mixing.mix(docs).groupBy("source").count().collect()
    assert {r["source"]: 4 * r["count"] for r in out} == dict(taken)


def test_mix_emits_whole_rows(make_docs):
    rows = [(i, sentence(i, 20), "ab"[i % 2]) for i in range(60)] + [(None, None, None)]
    docs = make_docs(rows).withColumnRenamed("lang", "copies")
    report = {r.doc_id: r.copies for r in mixing.mix_report(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == {i: n for i, n in report.items() if n}
    assert mixing.mix(make_docs([])).collect() == [] and mixing.mix_report(make_docs([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7000), min_size=1, max_size=80))
def test_bucket_covers_every_token_without_padding(lengths):
    lengths = np.array(lengths) + 1
    pieces = packing.pack_bucket(lengths)
    at = collections.defaultdict(list)
    inside = collections.defaultdict(list)
    for doc, start, size, seq, offset in pieces:
        assert size > 0
        at[doc].append((start, size))
        inside[seq].append((offset, size))
    for doc, n in enumerate(lengths):
        assert [s for s, _ in sorted(at[doc])] == [sum(x[1] for x in sorted(at[doc])[:i]) for i in range(len(at[doc]))]
        assert sum(s for _, s in at[doc]) == n
    for parts in inside.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x[1] for x in parts[:i]) for i in range(len(parts))]
        total = sum(s for _, s in parts)
        assert total <= 2048 and total & (total - 1) == 0
    assert set(inside) == set(range(len(inside)))


def test_solution_explains_an_exact_histogram():
    histogram = np.zeros(101, int)
    for lengths, n in (((40, 60, 0), 30), ((20, 30, 50), 12)):
        for v in lengths:
            histogram[v] += n if v else 0
    plan = dict(packing.plan_remainders(histogram, 100))
    used = np.zeros(101, int)
    for combination, n in plan.items():
        assert sum(combination) == 100
        for v in combination:
            used[v] += n
    assert (used <= histogram).all() and used.sum() >= 0.9 * histogram.sum()


def test_pack_round_trip(make_docs):
    import public_tokenizers

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = AWKWARD + [(20, "two  blanks \n\n and\tmore "), (21, "<|endoftext|> inside"), (22, sentence(4, 2500)), (23, " lead"), (24, "it's we'll '\u2019s\u00a0x")]
    got = packing.pack(make_docs(rows).withColumnRenamed("lang", "offset").coalesce(1), bucket_tokens=9000).collect()
    ids = [exact.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows]
    parts = collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        parts[(r.doc_id, r.doc_tokens)].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    built = {k: sum((x for _, x in sorted(v)), []) for k, v in parts.items()}
    for (i, _), want in zip(rows, ids):
        if i != 4:
            assert built[(i, len(want))] == want
    assert sum(len(x) for v in parts.values() for _, x in v) == sum(map(len, ids))
    windows = collections.Counter()
    for r in got:
        windows[r.sequence_id] += r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in windows.values())
    assert packing.pack(make_docs([])).collect() == []


def test_ranks_equal_the_tokenizer_file():
    encoder = packing.Encoder("byte_bpe_50k.json")
    assert encoder._fast is not None
    for text in (sentence(8, 400), "Ärger über\nÖl  und\u2003Weite\x1c \x1f x", "'s 'S 12³ ab12 $$$ ok\r\n", "\n", " ", "a \n b"):
        assert encoder.ids(text).tolist() == encoder._exact.encode(text, add_special_tokens=False).ids


def test_pipeline_on_the_smallest_tables(spark):
    from abtforge.llm import quality, simhash, suffix_dedup
    from abtforge.llm.store import table

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "source mixing", "packing"]
    docs = table(spark, SF_SMALL, "documents")
    kinds = docs.dtypes
    kept = corpus_pipeline.quality_classifier(spark, docs, SF_SMALL)
    assert kept.dtypes == kinds
    wanted = {r.doc_id for r in quality.quality_report(docs, table(spark, SF_SMALL, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == wanted
    near = corpus_pipeline.simhash_near_dedup(spark, kept, SF_SMALL)
    assert near.dtypes == kinds
    assert {r.doc_id for r in near.collect()} == {r.component_id for r in simhash.near_duplicates(kept).collect()}
    cut = corpus_pipeline.suffix_array_dedup(spark, near, SF_SMALL)
    assert cut.dtypes == kinds
    removed = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.removal_report(near).collect()}
    assert all(0 <= removed[r.doc_id] - len(r.text.encode()) <= 6 * 20 for r in cut.collect())
    mixed = corpus_pipeline.source_mixing(spark, cut, SF_SMALL)
    assert mixed.dtypes == kinds
    packed = corpus_pipeline.run(spark, SF_SMALL)
    per = collections.Counter(r.doc_id for r in packed.where("start = 0").collect())
    assert per == collections.Counter(r.doc_id for r in mixed.collect())
