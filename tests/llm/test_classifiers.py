import collections
import re
import zlib

import numpy as np
import pyarrow as pa

from abtforge.llm import quality, toxicity
from abtforge.llm.textarrays import ALNUM, SPACE, blocks, mix, prefix_hash, span_hash, words
from conftest_llm import AWKWARD, make_docs, make_labels, sentence  # noqa: F401


def corpus():
    rows = [(i, sentence(i, 80)) for i in range(150)]
    rows += [(200 + i, " | ".join(sentence(i, 60).split()).replace("w", "W")) for i in range(60)]
    labels = [(i, 1, 0) for i in range(150)] + [(200 + i, 0, 0) for i in range(60)]
    return rows, labels


def test_quality_on_held_out_rows(make_docs, make_labels):
    rows, labels = corpus()
    labels += [(None, 1, 0), (3, 1, 0), (77, None, None), (99999, 0, 1)]
    docs = make_docs(rows + AWKWARD).withColumnRenamed("lang", "score").withColumnRenamed("source", "y")
    got = quality.quality_report(docs, make_labels(labels)).collect()
    assert len(got) == len(rows) + len(AWKWARD)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 9}
    assert all(r.predicted == (i < 200) for i, r in by_id.items() if r.held_out)
    kept = quality.keep_quality(make_docs(rows).withColumnRenamed("lang", "_score"), make_labels(labels))
    assert kept.columns == ["doc_id", "text", "_score", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} >= set(range(150))


def test_quality_votes_match_brute_force():
    rng = np.random.default_rng(0)
    counts, labels = rng.poisson(1.0, (60, quality.TERMS)).astype(np.float32), rng.integers(0, 2, 60).astype(np.float32)
    model = quality.LatentVotes.fit(counts, labels, rank=8)
    asked = rng.poisson(1.0, (9, quality.TERMS)).astype(np.float32)
    z = model.weighted(asked) @ model.axes
    for row, score in zip(z, model.score(asked, neighbours=7, sharpness=2)):
        cos = model.vectors @ row / np.linalg.norm(row)
        near = np.argsort(-cos)[:7]
        w = np.maximum(cos[near], 0).astype(float) ** 2
        assert abs(score - (w * labels[near]).sum() / w.sum()) < 1e-5


def test_quality_without_labels_or_rows(make_docs, make_labels):
    got = quality.quality_report(make_docs(AWKWARD), make_labels([])).collect()
    assert {r.score for r in got} == {0.5}
    assert quality.quality_report(make_docs([]), make_labels([(1, 1, 0)])).collect() == []


def test_toxicity_on_held_out_rows(make_docs, make_labels):
    bad = ["zorgface", "you utter grubling"]
    rows = [(i, sentence(i, 60) + (f" {bad[i % 2].title()}, " if i % 3 == 0 else " ") + sentence(i + 900, 40)) for i in range(10, 410)]
    docs = make_docs(rows + AWKWARD).withColumnRenamed("lang", "score").withColumnRenamed("source", "x")
    labels = make_labels([(i, 1, int(i % 3 == 0)) for i, _ in rows] + [(None, 1, 1), (500, 1, 1)])
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(rows) + len(AWKWARD)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id >= 10]
    assert sum(r.predicted for r in held if r.doc_id % 3 == 0) >= 0.9 * sum(r.doc_id % 3 == 0 for r in held)
    assert not any(r.predicted for r in held if r.doc_id % 3)
    assert {r.score for r in toxicity.toxicity_report(make_docs(AWKWARD), make_labels([])).collect()} == {0.5}
    assert toxicity.toxicity_report(make_docs([]), make_labels([])).collect() == []


def test_ftrl_follows_its_definition():
    model = toxicity.Ftrl(np.zeros(5), np.zeros(5))
    z, n, w = np.zeros(5), np.zeros(5), np.zeros(5)
    for x, y in (([0, 1], 1), ([1, 2], 0), ([0, 3], 1)) * 30:
        at = [*x, 4]
        for i in at:
            l1 = 0 if i == 4 else toxicity.L1
            w[i] = 0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((toxicity.BETA + np.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)
        p = 1 / (1 + np.exp(-sum(w[i] for i in at)))
        for i in at:
            g = (p - y) * (toxicity.TOXIC_WEIGHT if y else 1)
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / toxicity.ALPHA
            z[i] += g - s * w[i]
            n[i] += g * g
        model.learn(np.array(x), y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def plain_features(text, buckets):
    """Bucket set of one text, with the module's hashes but plain loops."""
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    h = lambda b: span_hash(prefix_hash(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)]))
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", data)
    one = [h(w) for w in found]
    out = [int(x[0]) for x in one]
    for step, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        out += [int(mix(a * np.uint64(salt) + b)[0]) for a, b in zip(one, one[step:])]
    for size in toxicity.STEMS:
        often = collections.Counter(w[:size] for w in found if len(w) > size)
        out += [int(mix(h(stem) + np.array([0x8EBC6AF09C88C6E3], np.uint64) * np.uint64(n + 1))[0]) for stem, k in often.items() for n in range(min(k, 4))]
    return {x % buckets for x in out}


def test_toxicity_scores_match_plain_training(make_docs, make_labels):
    """The whole way, features to scores, against plain Python over the same sample."""
    buckets, rounds = 1 << 16, 2
    rows = [(i, sentence(i % 40, 12) + (" zorgface grublings" if i % 4 == 0 else "") + " Same-stem01 samestem02 SAMESTEM03") for i in range(10, 130)]
    y = {i: int(i % 4 == 0) for i, _ in rows}
    train = sorted(i for i in y if zlib.crc32(str(i).encode()) % 3 != 1)
    xs = {i: plain_features(t, buckets) for i, t in rows}
    z, n = collections.Counter(), collections.Counter()

    def weight(i):
        l1 = 0 if i == buckets else toxicity.L1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for turn in range(rounds):
        for i in sorted(train, key=lambda i: (int(mix(np.array([i], np.uint64) + np.uint64(turn + 1))[0]), i)):
            at = [*xs[i], buckets]
            w = {k: weight(k) for k in at}
            p = 1 / (1 + np.exp(-sum(w.values())))
            g = (p - y[i]) * (toxicity.TOXIC_WEIGHT if y[i] else 1)
            for k in at:
                s = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / toxicity.ALPHA
                z[k] += g - s * w[k]
                n[k] += g * g
    model = toxicity.train(make_docs(rows), make_labels([(i, 1, v) for i, v in y.items()]), rounds=rounds, buckets=buckets)
    want = {k: weight(k) for k in z if k < buckets and weight(k)}
    assert dict(zip(model[0].tolist(), np.round(model[1], 9))) == {k: round(v, 9) for k, v in sorted(want.items())} and want
    assert abs(model[2] - weight(buckets)) < 1e-9
    got = toxicity.with_toxicity(make_docs(rows + AWKWARD), model, buckets=buckets).collect()
    for r in got:
        total = weight(buckets) + sum(want.get(k, 0.0) for k in plain_features(r.text, buckets))
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(total, -35, 35)))) < 2e-6
    few = toxicity.train(make_docs(rows), make_labels([(i, 1, v) for i, v in y.items()]), rounds=1, buckets=buckets, features_limit=100)
    assert len(few[0]) <= len(want)


def test_text_blocks_and_words():
    texts = ["one two", None, "", " three\n", "a", "b" * 50]
    seen, keys = [], {}
    for limit in (1, 8, 1 << 20):
        rows = 0
        for block in blocks(pa.array(["skip", *texts]).slice(1), limit, most=4):
            rows += block.rows
            s, e, r = words(block.data, block.offsets, ~SPACE)
            for h, a, b, row in zip(span_hash(prefix_hash(block.data), s, e), s, e, r):
                word = block.data[a:b].tobytes()
                assert keys.setdefault(word, h) == h
                seen.append((limit, block.first + int(row), word))
        assert rows == len(texts)
    assert [x[1:] for x in seen if x[0] == 1] == [x[1:] for x in seen if x[0] == 8] == \
        [(0, b"one"), (0, b"two"), (3, b"three"), (4, b"a"), (5, b"b" * 50)]
    assert words(np.frombuffer("a-é".encode(), np.uint8), np.array([0, 4]), ALNUM)[0].tolist() == [0, 2]
