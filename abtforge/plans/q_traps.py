"""Queries over a dirty stand-in: orders as CSV files with planted faults.

The fault of a row follows from its order key modulo 50 (``FAULTS``); the rest is sound.  Text keys come as
plain, signed, decimal and scientific numbers and as codes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from abtforge.operators import clean, joins, quality, quarantine, split
from abtforge.plans import standins as T
from abtforge.plans.registry import register
from abtforge.session import work_dir
from abtforge.sources import tables

# order key modulo 50 -> what is planted
FAULTS = {0: "missing client", 1: "blank client", 2: "missing obligation", 3: "decimal obligation", 4: "scientific obligation", 5: "missing date", 6: "impossible date",
          7: "malformed cell", 8: "code as obligation", 9: "signed obligation", 10: "row written twice", 11: "missing label"}

_DIRTY_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 50 AS m, o_custkey, o_orderdate, o_orderstatus FROM orders),
dirty AS (
  SELECT k, m, 'f' || k % 3 AS file, CASE WHEN m = 0 THEN '' WHEN m = 1 THEN '   ' ELSE CAST(o_custkey AS VARCHAR) END AS num_doc,
         CASE m WHEN 2 THEN '' WHEN 3 THEN k || '.0' WHEN 4 THEN k || 'E0' WHEN 8 THEN 'ABC' || k WHEN 9 THEN '+' || k ELSE CAST(k AS VARCHAR) END AS obl17,
         CASE m WHEN 5 THEN '' WHEN 6 THEN '2024-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS f_analisis,
         CASE WHEN m IN (7, 11) THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS var_rta
  FROM o JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR m = 10
), keyed AS (
  SELECT *, trim(num_doc) AS num_doc_key, CASE WHEN m = 2 THEN NULL WHEN m = 8 THEN obl17 ELSE CAST(k AS VARCHAR) END AS obl17_key, TRY_CAST(f_analisis AS DATE) AS fecha FROM dirty
)"""


def dirty_clientes(spark, d):
    """The planted rows, read back from CSV files f0, f1, f2 with ``_file`` and ``_corrupt_record``."""
    o = T.table(spark, d, "orders")
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 50
    text = k.cast("string")
    rows = o.select(
        (k % 3).alias("f"), F.when(m == 0, "").when(m == 1, "   ").otherwise(F.col("o_custkey").cast("string")).alias("num_doc"),
        F.when(m == 2, "").when(m == 3, F.concat(text, F.lit(".0"))).when(m == 4, F.concat(text, F.lit("E0"))).when(m == 8, F.concat(F.lit("ABC"), text))
        .when(m == 9, F.concat(F.lit("+"), text)).otherwise(text).alias("obl17"),
        F.when(m == 5, "").when(m == 6, "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("f_analisis"),
        F.when(m == 7, "zz").when(m == 11, "").when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("var_rta"),
        F.explode(F.when(m == 10, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
    base = work_dir(spark, "dirty_clientes")
    for i in range(3):
        (rows.where(F.col("f") == i).drop("f").write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{base}/f{i}.csv"))
    read = tables.read_csv(spark, f"{base}/*.csv", "num_doc string, obl17 string, f_analisis string, var_rta int", allow_bad_rows=True)
    return read.withColumn("_file", F.regexp_extract(F.input_file_name(), r"/(f\d)\.csv/", 1))


def _split(spark, d):
    return quarantine.split_rows(dirty_clientes(spark, d), work_dir(spark, "key_quality"))


_FAULT_SQL = """CASE WHEN m = 7 THEN 'malformed_row' WHEN m IN (0, 1) THEN 'no_client' WHEN m = 2 THEN 'no_obligation'
       WHEN m = 5 THEN 'no_date' WHEN m = 6 THEN 'bad_date' WHEN m = 10 THEN 'duplicate_grain' END"""


@register("key_quality_ledger", oracle=_DIRTY_SQL + f""", r AS (SELECT file, {_FAULT_SQL} AS reason FROM keyed)
SELECT file, count(*) AS n_rows, count_if(reason IS NULL) AS n_good, count_if(reason IS NOT NULL) AS n_set_aside, {", ".join(
    f"count_if(coalesce(reason = '{x}', false)) AS {x}" for x in quarantine.REASONS)} FROM r GROUP BY file""")
def key_quality_ledger(spark, d):
    return _split(spark, d).ledger


@register("key_quality_set_aside", oracle=_DIRTY_SQL + f"""
SELECT file, trim(num_doc) AS num_doc, obl17, f_analisis, {_FAULT_SQL} AS reasons FROM keyed WHERE {_FAULT_SQL} IS NOT NULL""")
def key_quality_set_aside(spark, d):
    rows = _split(spark, d).set_aside
    text = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c)
    return rows.select(F.col("_file").alias("file"), text("num_doc"), text("obl17"), text("f_analisis"), F.array_join("reasons", ",").alias("reasons"))


@register("canonical_keys_mixed", oracle=_DIRTY_SQL + """
SELECT num_doc_key, obl17_key, fecha AS f_analisis, count(*) AS n FROM keyed WHERE obl17_key IS NOT NULL GROUP BY 1, 2, 3""")
def canonical_keys_mixed(spark, d):
    keyed = clean.drop_null_keys(clean.add_key_columns(dirty_clientes(spark, d)))
    return keyed.groupBy(F.coalesce("num_doc_key", F.lit("")).alias("num_doc_key"), "obl17_key", "f_analisis").agg(F.count(F.lit(1)).alias("n"))


@register("null_key_counts_dirty", oracle=_DIRTY_SQL + """
SELECT 'clientes' AS table_name, 'num_doc' AS column_name, count(*) AS n_rows, count_if(num_doc_key = '') AS n_nulls FROM keyed
UNION ALL SELECT 'clientes', 'obl17_key', count(*), count_if(obl17_key IS NULL) FROM keyed
UNION ALL SELECT 'clientes', 'f_analisis', count(*), count_if(fecha IS NULL) FROM keyed""")
def null_key_counts_dirty(spark, d):
    keyed = clean.add_key_columns(clean.clean_dataset(dirty_clientes(spark, d))).withColumn("num_doc", F.nullif("num_doc", F.lit("")))
    return quality.null_key_counts({"clientes": keyed}, ["num_doc", "obl17_key", "f_analisis"])


@register("orphans_with_missing_keys", oracle=_DIRTY_SQL + """
SELECT count(*) AS n_orphans FROM keyed WHERE num_doc_key NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 7 <> 0)""")
def orphans_with_missing_keys(spark, d):
    keyed = clean.add_key_columns(dirty_clientes(spark, d)).withColumn("num_doc_key", F.nullif("num_doc_key", F.lit("")))
    known = T.table(spark, d, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").cast("string").alias("c"))
    return joins.orphan_count(keyed, known, ["num_doc_key"], ["c"])


@register("temporal_split_dirty", oracle=_DIRTY_SQL + """
SELECT CASE WHEN fecha IS NULL THEN NULL WHEN fecha < DATE '1998-01-01' THEN 'TRAIN' WHEN fecha >= DATE '1998-01-01' AND fecha < DATE '2000-01-01' THEN 'TEST' ELSE 'OOT' END AS split_group,
       var_rta AS target_final, count(*) AS n FROM keyed GROUP BY 1, 2""")
def temporal_split_dirty(spark, d):
    df = split.with_temporal_split(dirty_clientes(spark, d), "1998-01-01", "1998-01-01", "2000-01-01")
    return df.groupBy("split_group", "target_final").agg(F.count(F.lit(1)).alias("n"))
