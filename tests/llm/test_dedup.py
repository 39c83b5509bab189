import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from abtforge.llm import simhash, suffix_dedup
from abtforge.llm.components import component_labels, components
from conftest_llm import AWKWARD, make_docs, sentence  # noqa: F401


def brute_removal(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = []
    for b in raw:
        cut = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cut[p:p + length] = b"\1" * length
        kept = bytes(c for c, x in zip(b, cut) if not x)
        runs = sum(1 for i, x in enumerate(cut) if x and (i == 0 or not cut[i - 1]))
        out.append((len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages():
    shared, other = sentence(900, 60), sentence(901, 45)
    rows = [(i, f"{sentence(i, 25)} {shared if i % 2 else other} {sentence(i + 500, 20)}") for i in range(12)]
    rows += [(20, shared), (21, shared[:250]), (22, shared[100:299]), (23, shared[100:300]), (24, shared + shared), (25, "ab" * 400),
             (26, "ab" * 300), (27, "z" * 199), (28, "z" * 200), (29, "é" * 150 + other[:220])]
    return rows + AWKWARD


@pytest.mark.parametrize("limit", [50_000, 1])
def test_removal_matches_brute_force(spark, make_docs, limit):
    rows = passages()
    got = suffix_dedup.removal_report(make_docs(rows).repartition(3), group_limit=limit).collect()
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute_removal([t for _, t in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_keys_that_collide_are_told_apart(make_docs):
    """Keys of 7 bits: some rows share theirs with others."""
    rows = [r for r in passages() if r[0] != 6] + [(40, sentence(900, 60))] * 3
    docs = make_docs(rows).repartition(3)
    assert len({r.k for r in docs.select(suffix_dedup.row_key(bits=7).alias("k")).collect()}) < len(set(rows))
    keys = docs.select("doc_id", "text", suffix_dedup.exact_key(docs, bits=7).alias("k")).distinct().collect()
    assert len({r.k for r in keys}) == len(keys) == len(set(rows))
    got = suffix_dedup.removal_report(docs, bits=7).collect()
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute_removal([t for _, t in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_many_equal_rows_keep_short_span_lists(make_docs):
    rows = [(5, sentence(3, 60))] * 400 + [(6, sentence(4, 60))]
    docs = make_docs(rows).repartition(8)
    spans = suffix_dedup.repeated_spans(docs, suffix_dedup.exact_key(docs)).collect()
    assert len(spans) == 1 and len(spans[0].spans) < 12
    got = suffix_dedup.removal_report(docs).collect()
    assert {(r.doc_id, r.n_removed == r.n_bytes) for r in got} == {(5, True), (6, False)} and len(got) == 401


def test_windows_that_only_several_partners_explain():
    """Left and right neighbours differ: the per-window comparison must find the third partner."""
    core, a, b, c, d = (sentence(i, 30).encode()[:80] for i in range(5))
    texts = [a + core + c, a + core + d, b + core + c, b + core + d, a[40:] + core + c[:40] + b, d + a[40:] + core + c[:40]]
    before = np.array([80, 80, 80, 80, 40, 120])
    length = 160
    windows = np.array([len(t) - length + 1 for t in texts])
    windows = np.minimum(windows, before + 1)
    flags = suffix_dedup.repeated_offsets(texts, before, windows, np.zeros(6, int), length)
    for i, t in enumerate(texts):
        for off in range(before[i] - windows[i] + 1, before[i] + 1):
            w = t[before[i] - off:before[i] - off + length]
            others = [u[before[j] - off:before[j] - off + length] for j, u in enumerate(texts)
                      if j != i and before[j] - windows[j] < off <= before[j]]
            assert flags[i, off] == (w in others), (i, off)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=30))
def test_suffix_sort_orders(texts):
    raw = [t.encode() for t in texts]
    before = np.array([len(t) // 2 for t in raw])
    group = np.sort(np.arange(len(raw)) % 3)
    s = suffix_dedup.Suffixes(raw, before, group)
    order = s.sort(True)
    assert [(group[i], raw[i][before[i]:]) for i in order] == sorted((g, t[b:]) for g, t, b in zip(group, raw, before))
    order = s.sort(False)
    assert [(group[i], raw[i][:before[i]][::-1]) for i in order] == sorted((g, t[:b][::-1]) for g, t, b in zip(group, raw, before))


def test_long_text_in_pieces(monkeypatch, make_docs):
    text = sentence(77, 400)
    data = np.frombuffer(text.encode(), np.uint8)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    starts = []
    for _, part, offsets, at in suffix_dedup._pieces(data, np.array([0, len(data)]), 200):
        h, anchor, lo, hi, row = suffix_dedup.find_anchors(part, offsets, 200, 40)
        starts += [int(at[0]) + p for a, b in zip(lo, hi) for p in range(a, b + 1)]
    assert starts == list(range(len(data) - 199))


def test_empty_table_and_cut_text(make_docs):
    assert suffix_dedup.removal_report(make_docs([])).collect() == []
    shared = sentence(5, 50)
    docs = make_docs([(1, "ä" + shared + "ö"), (2, "ü" + shared + "ß"), (3, None)])
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs.withColumnRenamed("lang", "spans")).collect()}
    assert (got[1].text, got[2].text, got[3].text) == ("ä", "ü", None)  # ö and ß share their first byte
    assert (got[1].n_chars, got[3].n_chars, got[1].spans) == (1, None, "en")


def brute_fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ([" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(values, ids):
    n = len(values)
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((ids[j] for j in range(n) if group[j] == group[i] and ids[j] is not None), default=None) for i in range(n)]


def test_near_duplicates_match_brute_force(make_docs):
    rows = [(i, sentence(i // 4, 120) + (f" tail{i}" if i % 4 else "")) for i in range(40)]
    rows += [(100 + i, sentence(60, 80)) for i in range(30)]  # copies
    rows += [(i and 500 + i, t) for i, t in AWKWARD] + [(600, "One  two\tTHREE"), (601, "one two three")]
    values = [brute_fingerprint(t) for _, t in rows]
    want = sorted((str(i), f"{v:016x}", str(c)) for (i, _), v, c in zip(rows, values, brute_components(values, [i for i, _ in rows])))
    got = simhash.near_duplicates(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.one_per_group(make_docs(rows).withColumnRenamed("lang", "fp"))
    assert kept.columns == ["doc_id", "text", "fp", "source", "n_chars"]
    groups = {c for c in brute_components(values, [i for i, _ in rows])}
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(g) for g in groups)
    assert simhash.near_duplicates(make_docs([])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), max_size=4, unique=True))
def test_every_pair_within_four_bits_shares_a_key(value, flips):
    other = value
    for b in flips:
        other ^= 1 << b
    import pyarrow as pa

    fps = np.array([value, other], np.uint64).view(np.int64)
    rows = pa.Table.from_batches(simhash._emit_keys([pa.RecordBatch.from_arrays([pa.array(fps)], ["fp"])])).to_pylist()
    keys = [{(r["key"], r["offered"]) for r in rows if r["fp"] == f} for f in fps.tolist()]
    assert any((k, 0) in keys[1] and ((k, 0) in keys[0] or (k, 1) in keys[0]) for k, _ in keys[0])


def test_golay_code_is_perfect():
    tables = simhash._golay_tables()
    message = np.arange(1 << 12)
    index = simhash.codeword_index(message << 11, tables)
    assert len(np.unique(tables[1])) == 2048 and (np.bitwise_count(tables[1]) <= 3).all()
    assert len(np.unique(index)) > 1


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i + 1, i) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(path + star + [(5, 5)], "u long, v long")).collect())
    assert all(got[i] == 1 for i in range(2, 61)) and all(got[i] == 1000 for i in range(1001, 1100))
    assert component_labels(np.array([4, 3]), np.array([3, 1]), 6).tolist() == [0, 1, 2, 1, 1, 5]
