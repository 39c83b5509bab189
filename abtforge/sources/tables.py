"""Tables, files and views.

Layers (raw, silver, gold, model_results, ...) are catalog databases.  Files are read with
an explicit schema where one is given (keys as text avoids float round trips of ids), and
every sink is a single write.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Source file -> raw table name.
FILES_MAPPING = {
    "clientes.csv": "clientes",
    "canales.csv": "canales",
    "moras.csv": "moras",
    "gestiones.csv": "gestiones",
    "excedente.csv": "excedentes",
    "tanque_movimiento.csv": "tanque_movimiento",
}

LAYERS = ("raw", "silver", "gold", "model_results")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    """CREATE DATABASE IF NOT EXISTS for every layer (S3)."""
    for name in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


CORRUPT = "_corrupt_record"
# Key columns, which inference must leave as text (leading zeros, 17 digits).
TEXT_KEYS = ("num_doc", "obl17")


def infer_csv_schema(spark: SparkSession, path: str, text_columns: Sequence[str] = TEXT_KEYS) -> T.StructType:
    """Column types from all rows of the file; ``text_columns`` stay text."""
    found = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    return T.StructType([T.StructField(f.name, T.StringType() if f.name.strip().lower() in text_columns else f.dataType) for f in found])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, allow_bad_rows: bool = False) -> DataFrame:
    """CSV with a header row; explicit schema when given, else inferred from all rows (keys as text).

    A malformed cell fails the read; with ``allow_bad_rows`` it is NULL, and the text of its row
    is kept in the column ``_corrupt_record``.
    """
    if schema is None:
        schema = infer_csv_schema(spark, path)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = spark.read.option("header", True)
    if not allow_bad_rows:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)


def ingest_csv_files(spark: SparkSession, folder: str, mapping: Mapping[str, str] = FILES_MAPPING,
                     database: str = "raw", schemas: Mapping[str, T.StructType | str] | None = None,
                     location: str | None = None, allow_bad_rows: bool = False) -> dict[str, int]:
    """Load each mapped CSV file into ``database.<table>``, replacing the table.

    A missing folder raises; a missing file is logged and skipped.  Malformed rows fail the load,
    unless ``allow_bad_rows``: then they stay visible in the table's column ``_corrupt_record``.
    Returns row counts of the written tables (from the written files' footers).
    """
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"CSV folder not found: {folder}")
    create_layers(spark, [database])
    counts = {}
    for fname, table in mapping.items():
        src = f"{folder.rstrip('/')}/{fname}"
        if not path_exists(spark, src):
            log.warning("CSV file not found, skipped: %s", src)
            continue
        df = read_csv(spark, src, (schemas or {}).get(table), allow_bad_rows)
        path = f"{location.rstrip('/')}/{database}/{table}" if location else None
        save_table(df, table, database, mode="overwrite", path=path)
        counts[table] = spark.table(f"`{database}`.`{table}`").count()
    return counts


def _registered(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def _next_name(table: str) -> str:
    return f"{table}__next"


def recover_table(spark: SparkSession, database: str, table: str) -> bool:
    """Finish a replacement that stopped between its last two steps; True if there was one.

    ``<table>__next`` exists only after it was written, read back and counted.
    """
    if _registered(spark, database, table) or not _registered(spark, database, _next_name(table)):
        return False
    spark.sql(f"ALTER TABLE `{database}`.`{_next_name(table)}` RENAME TO `{database}`.`{table}`")
    return True


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return _registered(spark, database, table) or recover_table(spark, database, table)


def read_table(spark: SparkSession, table: str, database: str = "raw", *, refresh: bool = False,
               limit: int | None = None) -> DataFrame:
    """Scan a catalog table (S4); ``refresh`` drops cached file listings first."""
    name = f"`{database}`.`{table}`"
    if not table_exists(spark, database, table):
        raise LookupError(f"table {database}.{table} does not exist")
    if refresh:
        spark.catalog.refreshTable(name)
    df = spark.table(name)
    return df.limit(limit) if limit is not None else df


def table_versions(spark: SparkSession, base: str) -> list[str]:
    """The version folders of a table, oldest first."""
    fs, p = _hadoop_fs(spark, base)
    if not fs.exists(p):
        return []
    return sorted(x.getPath().toString() for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName().startswith("v_"))


def _replace(df: DataFrame, table: str, database: str, base: str, keep_versions: int, expected_rows: int | None, options: Callable) -> None:
    """Write a new version beside the current one, check it, then point the table's name to it."""
    spark = df.sparkSession
    version = f"{base}/v_{dt.datetime.now(dt.timezone.utc).strftime('%Y%m%dT%H%M%S%f')}_{uuid.uuid4().hex[:8]}"
    stage = f"{table}__stage_{uuid.uuid4().hex[:8]}"
    try:
        options(df).option("path", version).saveAsTable(f"`{database}`.`{stage}`")
        stored = spark.table(f"`{database}`.`{stage}`").count()  # reads every file's footer
        if not path_exists(spark, f"{version}/_SUCCESS"):
            raise RuntimeError(f"{database}.{table}: the write was not committed; the old version stays")
        if expected_rows is not None and stored != expected_rows:
            raise RuntimeError(f"{database}.{table}: {expected_rows} rows expected, {stored} rows stored; the old version stays")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{stage}`")
        fs, p = _hadoop_fs(spark, version)
        fs.delete(p, True)
        raise
    # all tables are external: these steps change names only
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{_next_name(table)}`")
    spark.sql(f"ALTER TABLE `{database}`.`{stage}` RENAME TO `{database}`.`{_next_name(table)}`")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    recover_table(spark, database, table)
    for old in table_versions(spark, base)[:-1 - keep_versions]:
        fs, p = _hadoop_fs(spark, old)
        fs.delete(p, True)


def save_table(df: DataFrame | None, table: str, database: str, *, mode: str = "skip",
               path: str | None = None, partition_by: Sequence[str] = (),
               bucket_by: Sequence[str] = (), buckets: int | None = None,
               sort_by: Sequence[str] = (), keep_versions: int = 1, expected_rows: int | None = None) -> bool:
    """Write ``df`` as ``database.table``.

    ``skip`` leaves an existing table alone; ``overwrite`` replaces it.  Each write goes to a version
    folder of its own under ``path`` (or the database's folder), is read back and counted (against
    ``expected_rows``, where given), and only then takes the table's name: a job that fails midway leaves the
    old table as it was, and a job that dies between the last steps is finished by the next access.  ``df`` may read the table
    that it replaces.  ``keep_versions`` older versions stay for readers that have begun.
    ``bucket_by``/``buckets``/``sort_by`` write a bucketed table: equality filters on the
    bucket column read one bucket, and joins on it need no shuffle of this side.
    Returns True when data was written.
    """
    if df is None:
        raise ValueError("nothing to save: df is None")
    if mode not in ("skip", "overwrite"):
        raise ValueError("mode must be 'skip' or 'overwrite'")
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if mode == "skip" and table_exists(spark, database, table):
        return False
    if partition_by and not bucket_by:
        # one writer per partition value would put a hot value (a month with a third of the
        # rows) in one task; the rebalance hint lets AQE split such partitions evenly
        df = df.hint("rebalance", *partition_by)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        # one task per bucket: files are buckets, not tasks x buckets
        df = df.repartition(n, *bucket_by)

    def options(frame: DataFrame):
        w = frame.write.mode("overwrite").format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            w = w.bucketBy(n, *bucket_by)
            if sort_by:
                w = w.sortBy(*sort_by)
        return w

    base = path or f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"
    _replace(df, table, database, base.rstrip("/"), keep_versions, expected_rows, options)
    return True


def ensure_table(spark: SparkSession, table: str, build: Callable[[DataFrame], DataFrame], *,
                 source_database: str = "raw", target_database: str = "silver",
                 path: str | None = None) -> DataFrame:
    """Read-or-build (S7): the target table if it exists, else build it from the source
    table, save it and read it back."""
    if not table_exists(spark, target_database, table):
        src = read_table(spark, table, source_database)
        save_table(build(src), table, target_database, mode="overwrite", path=path)
    return spark.table(f"`{target_database}`.`{table}`")


def read_parquet_folder(spark: SparkSession, folder: str, pattern: str = "part-*.parquet") -> DataFrame:
    """Parquet files of a folder by glob (S8); a missing folder or no match raises."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"Parquet folder not found: {folder}")
    fs, p = _hadoop_fs(spark, f"{folder.rstrip('/')}/{pattern}")
    matches = fs.globStatus(p)
    if matches is None or len(matches) == 0:
        raise FileNotFoundError(f"no files match {pattern} in {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{pattern}")


def create_view(df: DataFrame, name: str, global_view: bool = False) -> DataFrame:
    """Create or replace a view (S10) and return a DataFrame over it."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
        return df.sparkSession.table(f"global_temp.{name}")
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, folder: str, prefix: str, when: dt.datetime | None = None) -> str:
    """CSV export with header into ``<folder>/<prefix>_<YYYYmmdd_HHMMSS>`` (S12); returns the path."""
    stamp = (when or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{folder.rstrip('/')}/{prefix}_{stamp}"
    (df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
    return path


def list_schemas(spark: SparkSession) -> DataFrame:
    """The layers, by name."""
    return spark.createDataFrame(sorted((x.name,) for x in spark.catalog.listDatabases()), "schema_name string")


def list_tables(spark: SparkSession, database: str, pattern: str | None = None) -> DataFrame:
    """Tables of a layer, by name; ``pattern`` filters names like SQL's ILIKE."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    out = spark.createDataFrame(sorted(rows), "table_name string, table_type string, is_temporary boolean")
    return out.where(F.col("table_name").ilike(pattern)) if pattern else out


def columns_by_type(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, data_type, n_columns) of a layer (S14): metadata only."""
    rows = [(t.name, c.dataType) for t in spark.catalog.listTables(database) if not t.isTemporary
            for c in spark.catalog.listColumns(f"{database}.{t.name}")]
    found = spark.createDataFrame(rows, "table_name string, data_type string")
    return found.groupBy("table_name", "data_type").agg(F.count(F.lit(1)).alias("n_columns")).orderBy("table_name", "data_type")


def list_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Columns in ordinal order with their type."""
    rows = [(i + 1, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(f"{database}.{table}"))]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string")


def describe(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a DataFrame."""
    return df.sparkSession.createDataFrame([(n, t) for n, t in df.dtypes], "column_name string, data_type string")


def preview(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None,
            order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (S15, K5), optionally of some columns; with ``order_by`` repeatable."""
    out = df.select(*columns) if columns else df
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(n)


def query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Parameterised SQL (S17): values are bound (``:name`` markers), never pasted into text."""
    return spark.sql(sql, args=dict(params or {}))


def query_one(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> dict | None:
    row = query(spark, sql, params).limit(1).first()
    return None if row is None else row.asDict()


def exec_sql(spark: SparkSession, statements: str) -> None:
    """Run one or more ';'-separated statements (DDL, CTAS, INSERT) for their effect."""
    for stmt in (x.strip() for x in statements.split(";")):
        if stmt:
            spark.sql(stmt)
