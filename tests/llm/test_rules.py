import collections
import math
import re
import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F

from abtforge.llm import license_rules, licenses, quality_rules, url_filter
from conftest_llm import AWKWARD, make_docs, make_labels, sentence  # noqa: F401


def base_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_match_brute_force(make_docs, make_labels):
    eight = "one two three four five six seven eight"
    rows = AWKWARD + [(20, eight + " " + eight), (21, eight + " x " + eight + " " + eight), (22, "la " * 40), (23, "la " * 8),
            (24, "a b\na b\n\n\nc\nc \nc"), (25, "# $ | <b> 50%"), (26, sentence(3, 200)), (27, sentence(4, 19)), (28, sentence(5, 3000))]
    docs = make_docs(rows).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "bucket")
    got = quality_rules.judge(docs, make_labels([(26, 1, 0), (28, 1, 0), (26, 1, 0), (None, 1, 0), (27, None, 0), (22, 0, 0)])).collect()
    seen = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert seen == sorted((str(i), *base_counts(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert {r.doc_id for r in got if r.kept} >= {26, 28}


def test_ratio_prefers_the_trusted_language(make_docs, make_labels):
    good = [(i, " ".join(f"good{(i * 7 + j) % 40}" for j in range(60))) for i in range(40)]
    bad = [(100 + i, " ".join(f"junk{(i * 11 + j) % 40}" for j in range(60))) for i in range(20)]
    got = {r.doc_id: r for r in quality_rules.judge(make_docs(good + bad), make_labels([(i, 1, 0) for i in range(30)])).collect()}
    assert all(got[i].ratio > got[100].ratio for i in range(40))
    assert not any(got[100 + i].kept for i in range(20)) and sum(got[i].base_failed for i in range(40)) == sum(not got[i].kept for i in range(40))


def plain_ratios(rows, good, buckets, smoothing):
    """The ratio of every row, in plain Python: (doc_id, ratio) pairs."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v

    def grams(t):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        two = [signed(xxhash.xxh64_intdigest(struct.pack("<q", a), seed=xxhash.xxh64_intdigest(struct.pack("<q", b), seed=42))) for a, b in zip(h, h[1:])]
        return [v % buckets for v in h + two]

    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(grams(t))
        target.update(grams(t) if i in good else [])
    weight = [math.log((target[b] + smoothing) / (target.total() + smoothing * buckets) / ((raw[b] + smoothing) / (raw.total() + smoothing * buckets)))
              for b in range(buckets)]
    return [(i, sum(weight[b] for b in g) / max(len(g), 1)) for i, t in rows for g in [grams(t)]]


def test_ratio_and_verdict_match_plain_python(make_docs, make_labels):
    rows = AWKWARD + [(20 + i, sentence(i % 11, 30) + " tail " * (i % 3)) for i in range(60)] + [(20, sentence(77, 40)), (None, sentence(78, 25))]
    good = {20 + i for i in range(0, 60, 3)} | {6}
    for ids in (1000, 0):
        got = quality_rules.judge(make_docs(rows), make_labels([(i, 1, 0) for i in good] + [(21, 0, 0)]), buckets=512, broadcast_ids=ids).collect()
        want = sorted(plain_ratios(rows, good, 512, quality_rules.SMOOTHING), key=str)
        seen = sorted(((r.doc_id, r.ratio) for r in got), key=str)
        assert collections.Counter((str(i), round(v, 6)) for i, v in seen) == collections.Counter((str(i), round(v, 6)) for i, v in want)
        assert all(r.kept == (not r.base_failed and r.ratio >= quality_rules.THRESHOLD) for r in got) and len({r.kept for r in got}) == 2


def test_without_labels_or_rows(make_docs, make_labels):
    rows = quality_rules.judge(make_docs([(1, sentence(1, 50))]), make_labels([])).collect()
    assert [(r.ratio, r.kept) for r in rows] == [(0.0, True)]
    assert quality_rules.judge(make_docs([]), make_labels([])).collect() == []


def test_every_trusted_document_counts(spark, make_labels):
    docs = spark.range(20_500).selectExpr("id AS doc_id", "concat('a', id % 97, ' b', id % 89) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert {r.ratio for r in quality_rules.judge(docs, labels).select("ratio").distinct().collect()} == {0.0}  # target and corpus are the same


def test_trusted_ids_broadcast_or_joined(make_docs, make_labels):
    docs = make_docs(AWKWARD + [(20 + i, sentence(i % 9, 30)) for i in range(40)] + [(20, sentence(77, 40)), (None, sentence(78, 25))])
    labels = make_labels([(i, int(i % 3 == 0), 0) for i in range(60)] + [(21, 1, 0), (21, 1, 0), (4, 1, 0), (None, 1, 0), (999, 1, 0)])
    rows = [sorted(map(str, quality_rules.judge(docs, labels, broadcast_ids=n).collect())) for n in (1000, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == docs.count()
    assert len({r.ratio for r in quality_rules.judge(docs, labels).collect()}) > 5


def base_licenses(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_scan_base_matches_brute_force(make_docs):
    rows = AWKWARD + [
        (20, "Released under the MIT License."), (21, "mit-license MIT\nLicense, mit license mit license"), (22, "The GNU General Public License v3.0"),
        (23, "permit license mitlicense"), (24, "Apache License, Version 2.0 and the Apache\tlicense"), (25, "MİT LİCENSE mit license"), (26, "license mit"),
        (27, "general public mit license general public license é mit license"), (28, "MIT License " * 2000)]
    got = licenses.scan(make_docs(rows).withColumnRenamed("lang", "labels").withColumnRenamed("source", "normal")).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == \
        sorted(map(str, ((i, *base_licenses(t)) for i, t in rows)))
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_license_priorities_and_containment(make_docs):
    cases = {"SPDX-License-Identifier: Apache-2.0": "apache-2.0", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0,license-statement",
             "GNU Lesser General Public License version 2.1": "gpl,lgpl-2.1", "BSD 3-Clause": "bsd-3-clause", "nothing of that kind": "",
             "This is free and unencumbered software released into the public domain": "unlicense", "All rights reserved.": "proprietary",
             "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later"}
    got = {r.doc_id: r for r in licenses.scan(make_docs(list(enumerate(cases)))).collect()}
    assert {i: got[i].labels for i in got} == dict(enumerate(cases.values()))
    assert got[0].score == 1.0 and got[6].score == 0.5 and got[4].score == 0.0
    assert licenses.scan(make_docs([])).collect() == []


def test_license_rules_hold_their_keywords():
    rules = license_rules.all_rules()
    assert len(rules) > 250
    for level, label, keyword, pattern in rules:
        re.compile(pattern)
        assert 0 <= level < len(license_rules.CONFIDENCE) and label == label.lower()


def samples(pattern):
    """Strings that a rule's pattern matches: every alternative, optional parts left out and taken, one choice per repeated or wild character."""
    def of(node):
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return [chr(arg)]
        if op in ("ANY", "NOT_LITERAL"):
            return ["x"]
        if op == "IN":
            return [chr(a) for o, a in arg if str(o) == "LITERAL"] or ["w"]
        if op == "SUBPATTERN":
            return sequence(arg[3])
        if op == "BRANCH":
            return [t for branch in arg[1] for t in sequence(branch)]
        assert op in ("MAX_REPEAT", "MIN_REPEAT"), op
        low, high, inner = arg
        return [t * n for n in sorted({low, min(int(high), low + 1)}) for t in sequence(inner)]

    def sequence(nodes):
        out = [""]
        for node in nodes:
            out = [a + b for a in out for b in of(node)]
        return out

    found = [" ".join(t.split()) for t in sequence(re._parser.parse(pattern))]
    return [t for t in found if re.fullmatch(pattern, t)]


def test_every_alternative_of_a_license_rule_holds_its_keyword_and_opens_the_gate(make_docs):
    for level, label, keyword, pattern in license_rules.all_rules():
        texts = samples(pattern)
        assert texts
        for t in texts:
            assert f" {keyword}" in f" {t} ", (label, keyword, t)
            assert any(g in f" {t} " for g in license_rules.GATES), (label, t)
    cases = {"PSF License Version 2": "psf-2.0", "All rights are reserved.": "proprietary",
             "See the licence for details": "license-statement"}
    assert {r.doc_id: r.labels for r in licenses.scan(make_docs(list(enumerate(cases)))).collect()} == dict(enumerate(cases.values()))


def test_license_labels_do_not_depend_on_what_separates_the_words(make_docs):
    texts = [t for *_, p in license_rules.all_rules() for t in (min(samples(p), key=len), max(samples(p), key=len))]
    rows = [(i, f"x{gap}" + t.replace(" ", gap) + f"{gap}y") for i, t in enumerate(texts) for gap in ("\n", "\t", "-", '"', " / ")]
    opened = {r.doc_id: r for r in licenses.scan(make_docs([(i, f"x {t} y") for i, t in enumerate(texts)]), gates=("",)).collect()}
    wrong = [(texts[r.doc_id], r.labels) for r in licenses.scan(make_docs(rows)).collect()
             if (r.labels, r.score) != (opened[r.doc_id].labels, opened[r.doc_id].score)]
    assert wrong == []
    cases = {"released into the public\ndomain": "public-domain", "Creative\nCommons Attribution 4.0": "cc-by-4.0", "CC\tBY 4.0": "cc-by-4.0",
             "all rights\nreserved": "proprietary", "without\nwarranty of any kind": "warranty-disclaimer", "see\n'MPL-2.0'": "mpl-2.0", 'provided "as is"': "warranty-disclaimer"}
    assert {r.doc_id: r.labels for r in licenses.scan(make_docs(list(enumerate(cases)))).collect()} == dict(enumerate(cases.values()))


PAGES = "page_id long, url string, html string, host string"


def judged(spark, rows):
    return {r.page_id: r for r in url_filter.judge_pages(spark.createDataFrame([(*r, "x") for r in rows], PAGES)).collect()}


def test_url_parts_and_rules(spark):
    urls = {1: "https://A.Example.NET/en/x?y#z", 2: "http://example.net/EN/", 3: "http://x.net", 4: "http://x.net/", 5: "https://example.com/de/", 6: "https://notexample.com/de/",
            7: "ftp://b.org/fr/1", 8: "b.org/fr/1", 9: None, 10: "", 11: "http://net/", 12: "a://b://c/d", 13: "http://h?x/y", 14: "http://h#f", 15: "//example.net/en/"}
    got = judged(spark, [(i, u, None) for i, u in urls.items()])
    want = {1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/EN/", "net/", "block"), 3: ("x.net", "", None, "allow"), 4: ("x.net", "/", "net/", "block"),
            5: ("example.com", "/de/", "example.com/de/", "block"), 6: ("notexample.com", "/de/", None, "allow"), 7: ("b.org", "/fr/1", "org/fr/", "allow"),
            8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("net", "/", "net/", "block"), 12: ("b:", "//c/d", None, "allow"),
            13: ("h", "", None, "allow"), 14: ("h", "", None, "allow"), 15: ("", "", None, "allow")}
    for i in (3, 5):  # a host of blocked pages only is itself blocked
        assert got[i].distrust >= 0.5
    want[3] = ("x.net", "", None, "block")
    assert {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()} == want


def plain_ranks(rows, damping=0.85):
    """{host: (trust, distrust, neutral)} converged, by solving the linear systems."""
    pages, edges = collections.defaultdict(list), collections.Counter()
    rules = dict((rule, verdict) for verdict, rule in url_filter.RULES)
    for _, url, text in rows:
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url).groups()
        host = host.lower()
        fit = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        pages[host].append(rules[max(fit, key=len)] if fit else None)
        for other in re.findall(r"""(?:href|src)=["']?(?:https?:)?//([^/"' >]+)""", text or ""):
            if other.lower() != host:
                edges[host, other.lower()] += 1
    domains = set()
    for host in pages:
        while host.count(".") > 1 and not re.fullmatch(r"[\d.:]+", host):
            up = host.split(".", 1)[1]
            domains |= {(host, up), (up, host)}
            host = up
    links = edges + collections.Counter(domains)
    names = sorted(set(pages) | {h for pair in links for h in pair})
    at = {h: i for i, h in enumerate(names)}
    forward = np.zeros((len(names), len(names)))
    for (s, t), n in links.items():
        forward[at[s], at[t]] += n

    def rank(kind, graph):
        seeds = np.array([sum(v == kind for v in pages[h]) / len(pages[h]) if h in pages else 0 for h in names])
        out = graph.sum(axis=1, keepdims=True)
        step = np.divide(graph, out, out=np.zeros_like(graph), where=out > 0)
        return np.linalg.solve(np.eye(len(names)) - damping * step.T, seeds)

    return dict(zip(names, zip(rank("allow", forward), rank("block", forward.T), rank(None, forward))))


def test_ranks_match_brute_force(spark):
    link = lambda *hosts: " ".join(f'<a href="http://{h}/p">' for h in hosts)
    rows = [(1, "http://bad.net/a", ""), (2, "http://a.com/x", link("bad.net", "bad.net", "b.com")), (3, "http://b.com/x", link("a.com")),
            (4, "http://good.org/fr/x", link("c.com", "C.com")), (5, "http://c.com/x", "<img src='//d.com/i'>"), (6, "http://d.com/x", None), (7, "http://sub.d.com/x", link("bad.net")),
            (8, "http://deep.er.sub.d.com/y", ""), (9, "http://10.0.0.1/x", link("a.com")), (10, "http://lone.com/x", link("worse.net")), (11, "http://worse.net/x", "")]
    rows += [(20 + i, f"http://ring{i}.com/x", link(f"ring{(i + 1) % 5}.com")) for i in range(5)]  # a cycle
    rows += [(40 + i, f"http://chain{i}.com/x", link(f"chain{i + 1}.com")) for i in range(30)] + [(70, "http://chain30.com/x", link("ring0.com"))]  # a long chain
    rows += [(71, "http://ring2.com/y", link("bad.net")), (72, "http://good.org/fr/z", link("chain0.com", "ring1.com"))]
    got = judged(spark, rows)
    want = plain_ranks(rows)
    for r in got.values():
        for have, exact in zip((r.trust, r.distrust, r.neutral), want[r.host]):
            assert exact - 0.05 <= have <= exact + 1e-5, (r.host, have, exact)
        t, d, n = want[r.host]
        if r.rule is None and abs(d - t) > 0.1 and abs(d - url_filter.THRESHOLD * (t + d + n)) > 0.1:
            assert r.verdict == ("block" if d > t and d >= url_filter.THRESHOLD * (t + d + n) else "allow")
    verdicts = {r.host: r.verdict for r in got.values() if r.rule is None}
    assert verdicts["d.com"] == "allow" and sorted(set(verdicts.values())) == ["allow", "block"], verdicts
    assert judged(spark, []) == {}


def test_domains_without_pages_pass_distrust_on(spark):
    rows = [(i, f"http://s{i}.shop.example.com/de/x", None) for i in range(4)] + [(9, "http://blog.shop.example.com/en/", None), (10, "http://other.org/en/", None)]
    got = judged(spark, rows)
    assert got[9].verdict == "block" and got[9].decided_by == "method" and got[9].distrust > 0
    assert got[10].verdict == "allow" and got[10].distrust == 0


def test_pages_of_one_host_very_long_html_and_clashing_names(spark):
    rows = [(i, "http://hot.com/x", f"<a href='http://t{i % 3}.com/'>") for i in range(2000)] + [(5000, "http://long.com/x", "<a href='http://hot.com/'> " * 40_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("path", "rule", "trust", "distrust", "neutral", "verdict", "by_rule", "mass", "_host", "links"):
        frame = frame.withColumn(c, F.lit("x"))
    out = url_filter.judge_pages(frame).collect()
    assert len(out) == 2001 and {r.verdict for r in out} == {"allow"}
