"""The registered queries of this package and, where SQL can express them, their DuckDB SQL.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abtforge.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors by integer inner product, for every vector with id % 50 = 0."""
    from abtforge.llm.topk import quantised, top_k

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into windows of 2048 tokens."""
    from abtforge.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    from abtforge.llm.quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from abtforge.llm.toxicity import toxicity_report

    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document as parts of repeated 200-byte strings."""
    from abtforge.llm.suffix_dedup import removal_report

    return removal_report(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from abtforge.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    from abtforge.llm.url_filter import judge_pages

    return judge_pages(table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the weighted mix takes of every document."""
    from abtforge.llm.mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY doc_id, coalesce(text, '') ORDER BY source NULLS FIRST) - 1 AS turn FROM documents
), p AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM d GROUP BY source
), rounds AS (
  SELECT 0 AS n, CAST([] AS VARCHAR[]) AS capped
  UNION ALL
  SELECT n + 1, now_capped FROM (
    SELECT r.n, r.capped,
           (SELECT coalesce(list(coalesce(source, chr(1)) ORDER BY source NULLS LAST), []) FROM p WHERE list_contains(r.capped, coalesce(source, chr(1)))
              OR ((SELECT sum(s) FROM p) - (SELECT coalesce(sum(3 * s), 0) FROM p c WHERE list_contains(r.capped, coalesce(c.source, chr(1))))) * w
                 > 3 * s * (SELECT sum(w) FROM p c WHERE NOT list_contains(r.capped, coalesce(c.source, chr(1))))) AS now_capped
    FROM rounds r) WHERE now_capped <> capped OR n = 0 AND now_capped <> capped
), last AS (
  SELECT capped FROM rounds ORDER BY n DESC LIMIT 1
), t AS (
  SELECT source, s, CASE WHEN list_contains(capped, coalesce(source, chr(1))) THEN CAST(3 * s AS DOUBLE)
    ELSE CAST((SELECT sum(s) FROM p) - (SELECT coalesce(sum(3 * s), 0) FROM p c WHERE list_contains(capped, coalesce(c.source, chr(1)))) AS DOUBLE) * w
         / CAST((SELECT sum(w) FROM p c WHERE NOT list_contains(capped, coalesce(c.source, chr(1)))) AS DOUBLE) END AS target
  FROM p, last
), j AS (
  SELECT d.doc_id, d.source, d.size, t.s AS source_size, t.target,
         CASE WHEN t.s > 0 THEN t.target / t.s ELSE 1.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.digest || ':' || d.turn), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
       CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies, source
FROM j
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    from abtforge.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the likelihood-ratio verdict of every document."""
    from abtforge.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors after six rounds of codebook refinement."""
    from abtforge.llm.codebooks import compress_report

    return compress_report(table(spark, sf_dir, "embeddings"))


def _op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds written out: c0, a1, c1, ... a6, c6, then the last assignment."""
    ctes = [f"""v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS n,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""", f"""p AS MATERIALIZED (
  SELECT n, t.part, list_slice(e, CAST(t.part * (len(e) // {parts}) + 1 AS BIGINT), CAST((t.part + 1) * (len(e) // {parts}) AS BIGINT)) AS x
  FROM v, range({parts}) t(part)
)""", f"c0 AS MATERIALIZED (SELECT part, n AS entry, x FROM p WHERE n < {entries})"]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT p.part, p.n, min(CAST(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + c.entry) AS k
  FROM p JOIN c{r} c ON p.part = c.part GROUP BY p.part, p.n
)""")
        if r < rounds:
            ctes.append(f"""m{r} AS MATERIALIZED (
  SELECT part, entry, list((s - ((s % cnt) + cnt) % cnt) // cnt ORDER BY i) AS x FROM (
    SELECT part, entry, i, CAST(sum(val) AS BIGINT) AS s, count(*) AS cnt FROM (
      SELECT a.part, a.k % {entries} AS entry, unnest(p.x) AS val, unnest(range(len(p.x))) AS i FROM a{r} a JOIN p ON a.part = p.part AND a.n = p.n
    ) GROUP BY part, entry, i
  ) GROUP BY part, entry
)""")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.part = m.part AND c.entry = m.entry)")
    return "WITH " + ",\n".join(ctes) + f""", r AS (
  SELECT n, string_agg(printf('%02x', k % {entries}), '' ORDER BY part) AS code, CAST(sum(k // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY n
), o AS (
  SELECT vec_id, label, code, error FROM v JOIN r ON v.n = r.n
), d AS (
  SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, i)) AS digest
  FROM (SELECT part, entry, unnest(x) AS val, unnest(range(len(x))) AS i FROM c{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256, label FROM o, d
"""


OP11_SQL = _op11_sql()


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from abtforge.llm.html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and checked proof of every document."""
    from abtforge.llm.merkle import manifest_report

    return manifest_report(table(spark, sf_dir, "documents"))


def _op13_sql(depth: int = 6, source_depth: int = 4) -> str:
    """Levels written out: enough for 16^6 documents a source and 16^4 sources."""

    def tree(name: str, key: str, levels: int) -> list[str]:
        """Node tables {name}0 .. {name}<levels> with (key, i, n, d), and siblings {name}_s<level>."""
        out = []
        for k in range(levels):
            out.append(f"""{name}_s{k} AS MATERIALIZED (
  SELECT a.{key}, a.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
         coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.{key} = b.{key} AND a.i // 16 = b.i // 16 WHERE a.n > {16 ** k} GROUP BY a.{key}, a.i)""")
            out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT {key}, i // 16 AS i, n, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}{k} WHERE n > {16 ** k} GROUP BY {key}, i // 16, n)""")
        return out

    def last(name: str, key: str, levels: int) -> str:
        return " UNION ALL ".join(f"SELECT {key}, d FROM {name}{k} WHERE n <= {16 ** k}" + (f" AND n > {16 ** (k - 1)}" if k else "") for k in range(levels + 1))

    field = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    digest = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"x{k}" for k in range(depth)] + [f"y{k}" for k in range(source_depth)]
    siblings = " || ".join(f"coalesce({a}.l || {a}.r, '')" for a in steps)
    joins = "\n".join(f"LEFT JOIN t_s{k} x{k} ON x{k}.tree = t.tree AND x{k}.i = t.i // {16 ** k}" for k in range(depth))
    joins += "\n" + "\n".join(f"LEFT JOIN u_s{k} y{k} ON y{k}.one = 1 AND y{k}.i = u.i // {16 ** k}" for k in range(source_depth))
    return f"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab
), c AS (
  SELECT DISTINCT doc_id AS id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda a, b: xor(a // 256, tab[CAST(xor(a % 256, b) + 1 AS BIGINT)])), 4294967295) AS crc FROM documents, crc WHERE doc_id IS NOT NULL
), leaves AS MATERIALIZED (
  SELECT documents.doc_id, source, coalesce('s' || source, '') AS tree, {digest("text")} AS leaf, CASE WHEN crc.crc % 5 = 0 THEN {digest(lower)} END AS changed
  FROM documents LEFT JOIN c AS crc ON crc.id = documents.doc_id
), t AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), t0 AS (SELECT tree, i, n, leaf AS d FROM t), {", ".join(tree("t", "tree", depth))},
u AS MATERIALIZED (
  SELECT 1 AS one, tree, d, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM ({last("t", "tree", depth)})
), u0 AS (SELECT one, i, n, d FROM u), {", ".join(tree("u", "one", source_depth))},
root AS ({last("u", "one", source_depth)}),
p AS (
  SELECT t.doc_id, t.source, t.leaf, u.d AS subroot, root.d AS root, sha256({siblings}) AS proof_sha256, coalesce(t.changed, t.leaf) AS f0,
         {", ".join(f"{a}.l AS {a}l, {a}.r AS {a}r" for a in steps)}
  FROM t JOIN u ON u.tree = t.tree JOIN root ON root.one = u.one
{joins}
), {", ".join(f"p{k} AS (SELECT * REPLACE (CASE WHEN {a}l IS NULL THEN f0 ELSE sha256({a}l || f0 || {a}r) END AS f0) FROM {'p' if k == 0 else f'p{k - 1}'})" for k, a in enumerate(steps))}
SELECT doc_id, leaf, subroot, root, proof_sha256, f0 AS folded_root, f0 = root AS verified, source FROM p{len(steps) - 1}
"""


OP13_SQL = _op13_sql()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline (``corpus_pipeline.py``) over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL: dict[str, tuple[Query, str | None]] = {
    "op1_topk_search": (op1_topk_search, OP1_SQL),
    "op2_packing": (op2_packing, None),
    "op3_quality_classifier": (op3_quality_classifier, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_suffix_dedup": (op5_suffix_dedup, None),
    "op6_simhash": (op6_simhash, None),
    "op7_url_filter": (op7_url_filter, None),
    "op8_source_mixing": (op8_source_mixing, OP8_SQL),
    "op9_license_scan": (op9_license_scan, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_vector_codes": (op11_vector_codes, OP11_SQL),
    "op12_html_extraction": (op12_html_extraction, None),
    "op13_merkle_manifest": (op13_merkle_manifest, OP13_SQL),
    "pipeline": (pipeline, None),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
