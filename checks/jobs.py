"""Queries for archives, sinks, quality checks and browsing, with their DuckDB equivalents."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapter import bench_table, models, raw_table
from checks.oracle_models import over_raw, raw_sql
from rostrum.operators import browse, quality
from rostrum.pipeline import materialise
from rostrum.plans import MODELS
from rostrum.schemas import FEEDS, RAW_TABLES
from rostrum.session import configure, shared_folder
from rostrum.sinks.publish import content_digest, loaded_digest, publish_tables, stage_tables
from rostrum.sources.archive import folder_key, json_documents, unzip

# --- archives ----------------------------------------------------------------

_ARCHIVE = 200
_PATHS = """case cast(doc_id % 6 as int) when 0 then 'json/acteur/A' || cast(doc_id as string) || '.json'
    when 1 then 'json/organe/O' || cast(doc_id as string) || '.json'
    when 2 then 'json/acteur/' || lang || '/' || cast(doc_id as string) || '.xml'
    when 3 then lang || '/' || cast(doc_id as string) || '.json'
    when 4 then 'json/' || cast(doc_id as string) || '.json'
    else 'seul' || cast(doc_id as string) || '.json' end"""


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zip the rows of a partition into archives of a bounded number of documents."""
    for batch in batches:
        for first in range(0, batch.num_rows, _ARCHIVE):
            part = batch.slice(first, _ARCHIVE)
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.mkdir("json")
                for entry, body in zip(part["entry"].to_pylist(), part["body"].to_pylist()):
                    archive.writestr(entry, body)
            yield pa.RecordBatch.from_pylist([{"path": "a.zip", "content": buffer.getvalue()}])


def _documents_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)  # bounds what a Python task holds: else 10,000 documents, or all archives of a task
    documents = bench_table(spark, sf_dir, "documents")
    archives = documents.selectExpr(f"{_PATHS} as entry", "text as body").mapInArrow(
        _pack, "path string, content binary"
    )
    return unzip(archives).select("entry", "body")


def _read_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_documents(_documents_from_archives(spark, sf_dir), "json/acteur/")


def _archive_folder_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = bench_table(spark, sf_dir, "documents").selectExpr(f"{_PATHS} as entry")
    return documents.select("entry", folder_key(F.col("entry")).alias("folder"))


# --- sinks -------------------------------------------------------------------


def _scratch(spark: SparkSession) -> tuple[str, str]:
    """A new folder in the shared one and a new database that lives there."""
    run = uuid4().hex
    folder = f"{shared_folder(spark)}/check_{run}"
    database = f"check_{run}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    return folder, database


def _raw(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name) for name in names}


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _counted(name: str, table: DataFrame) -> DataFrame:
    return browse.count_rows(table).select(F.lit(name).alias("table_name"), "row_count")


def _contents(name: str, stored: DataFrame, written: str | None) -> DataFrame:
    """Size and digest of stored rows, and the digest taken when they were written."""
    return stored.agg(
        F.count(F.lit(1)).alias("row_count"), content_digest(stored).alias("digest")
    ).select(F.lit(name).alias("table_name"), "row_count", "digest", F.lit(written).alias("written"))


def _published(spark: SparkSession, database: str, names: tuple[str, ...] | list[str]) -> DataFrame:
    return _union(
        [_contents(n, spark.table(f"{database}.{n}"), loaded_digest(spark, database, n)) for n in names]
    )


def _stage_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _scratch(spark)
    staged = stage_tables(spark, _raw(spark, sf_dir, FEEDS["amendments"]), folder, "run")
    return _union([_contents(s.table, spark.read.parquet(s.path), s.digest) for s in staged.values()])


def _publish_twice(spark: SparkSession, sf_dir: str) -> str:
    """Publishes twice, so that the second load replaces the first."""
    folder, database = _scratch(spark)
    tables = _raw(spark, sf_dir, FEEDS["ballots"])
    emptied = {name: table.limit(0) for name, table in tables.items()}
    publish_tables(spark, emptied, root=folder, database=database)
    publish_tables(spark, tables, root=folder, database=database)
    return database


def _publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_publish_twice(spark, sf_dir)}.scrutin_votes_individuels")


def _publish_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, _publish_twice(spark, sf_dir), FEEDS["ballots"])


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, database = _scratch(spark)
    tables = _raw(spark, sf_dir, FEEDS["files"])
    counts = publish_tables(spark, tables, root=folder, database=database)
    rows = [(name, n, loaded_digest(spark, database, name)) for name, n in counts.items()]
    return spark.createDataFrame(rows, "table_name string, row_count long, written string")


def _materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, database = _scratch(spark)
    materialise(spark, models(spark, sf_dir), root=folder, database=database)
    stored = _published(spark, database, [n for n, model in MODELS.items() if model.stored])
    return stored.select("table_name", "row_count", (F.col("digest") == F.col("written")).alias("intact"))


def _contents_sql(names: tuple[str, ...] | list[str], *digests: str) -> str:
    """Sizes of tables, and the digest of their rows under each of the given names."""
    named = [(n, "raw_documents" if n == "documents" else n) for n in names]
    digest = "coalesce(sum(('0x' || left(md5(line), 15))::bigint), 0)::varchar"
    columns = ", ".join(f"{digest} as {name}" for name in digests)
    return over_raw(
        " union all ".join(
            f"select '{n}' as table_name, count(*) as row_count, {columns}"
            " from (select concat_ws(chr(31), *columns(*)) as line"
            f" from (select coalesce('=' || columns(*)::varchar, '') from {t}))"
            for n, t in named
        )
    )


def _counts_sql(names: tuple[str, ...] | list[str], cte: dict[str, str] | None = None) -> str:
    named = [(n, "raw_documents" if n == "documents" else n) for n in names]
    return over_raw(
        " union all ".join(
            f"select '{n}' as table_name, count(*) as row_count from {t}" for n, t in named
        )
    )


# --- quality -----------------------------------------------------------------

_AUDITED = ("acteurs", "mandats", "interventions", "scrutin_votes_individuels", "amendements")
_KEYS = (*quality.NOT_NULL, ("stg_documents", "dossier_uid"), ("stg_interventions", "depute_uid"))
_UNIQUES = (*quality.UNIQUE, ("stg_mandats", "depute_uid"), ("stg_documents", "dossier_uid"))


def _dq_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    def audit(name: str) -> DataFrame:
        table = raw_table(spark, sf_dir, name)
        counts = quality.missing_counts(table, table.columns)
        return counts.select(F.lit(name).alias("table_name"), "column_name", "missing")

    return _union([audit(name) for name in _AUDITED])


def _dq_required_sql() -> str:
    from rostrum.schemas import SCHEMAS

    return over_raw(
        " union all ".join(
            f"select '{t}' as table_name, '{c}' as column_name,"
            f" count(case when {c} is null or cast({c} as varchar) = '' then 1 end) as missing"
            f" from {t}"
            for t in _AUDITED
            for c in SCHEMAS[t].names
        )
    )


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return _union(
        [
            quality.null_rows(m[model], column)
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")
            for model, column in _KEYS
        ]
    )


def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return _union(
        [
            quality.repeated_values(m[model], column).select(
                F.lit(model).alias("model"), F.col(column).alias("value"), "n_records"
            )
            for model, column in _UNIQUES
        ]
    )


def _dq_no_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some mandates are loaded twice or three times, a few with another load time."""
    mandates = models(spark, sf_dir)["stg_mandats"]
    again = mandates.where("preseance in (3, 7)")
    later = mandates.where("preseance = 7").withColumn(
        "ingested_at", F.lit("2024-08-01 00:00:00").cast("timestamp")
    )
    return quality.exact_duplicates(_union([mandates, again, later]))


def _dq_sources_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds are published; every source is reported, with its rows where it is there."""
    folder, database = _scratch(spark)
    tables = _raw(spark, sf_dir, (*FEEDS["files"], *FEEDS["deputies"]))
    publish_tables(spark, tables, root=folder, database=database)
    missing = set(quality.missing_sources(spark, database))
    reports = []
    for name in quality.REQUIRED_SOURCES:
        if name in missing:
            empty = raw_table(spark, sf_dir, name).limit(0)
            counted = _counted(name, empty)
        else:
            counted = _counted(name, spark.table(f"{database}.{name}"))
        reports.append(counted.withColumn("present", F.lit(name not in missing)))
    return _union(reports)


def _dq_sources_present_sql() -> str:
    there = (*FEEDS["files"], *FEEDS["deputies"])
    parts = []
    for name in quality.REQUIRED_SOURCES:
        table = "raw_documents" if name == "documents" else name
        if name in there:
            parts.append(f"select '{name}' as table_name, count(*) as row_count, true as present from {table}")
        else:
            parts.append(f"select '{name}' as table_name, 0 as row_count, false as present")
    return over_raw(" union all ".join(parts))


# --- browsing ----------------------------------------------------------------


def _browse_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables with their rows; the view beside them must not be listed."""
    folder, database = _scratch(spark)
    tables = _raw(spark, sf_dir, FEEDS["questions"])
    publish_tables(spark, tables, root=folder, database=database)
    spark.sql(f"CREATE VIEW {database}.a_view AS SELECT * FROM {database}.questions_ecrites")
    listed = browse.list_tables(spark, database)
    return _union([_counted(name, spark.table(f"{database}.{name}")) for name in listed])


def _browse_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _raw(spark, sf_dir, RAW_TABLES)
    return _union([_counted(name, table) for name, table in tables.items()])


def _browse_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.preview(raw_table(spark, sf_dir, "acteurs").orderBy("uid"))


QUERIES = {
    "read_archive": _read_archive,
    "read_archive_all": _documents_from_archives,
    "archive_folder_key": _archive_folder_key,
    "stage_tables": _stage_tables,
    "publish_tables": _publish_tables,
    "publish_digests": _publish_digests,
    "load_counts": _load_counts,
    "materialise": _materialise,
    "dq_required": _dq_required,
    "dq_not_null": _dq_not_null,
    "dq_unique": _dq_unique,
    "dq_no_exact_duplicates": _dq_no_exact_duplicates,
    "dq_sources_present": _dq_sources_present,
    "browse_list_tables": _browse_list_tables,
    "browse_count_rows": _browse_count_rows,
    "browse_preview": _browse_preview,
}

_ENTRIES = f"select {_PATHS} as entry, text as body from documents"

SQL = {
    "read_archive": f"select * from ({_ENTRIES}) where entry like 'json/acteur/%.json'",
    "read_archive_all": _ENTRIES,
    "archive_folder_key": f"""
        select entry, case when entry not like '%/%' then 'inconnu'
                           when entry like 'json/%' then split_part(entry, '/', 2)
                           else split_part(entry, '/', 1) end as folder
        from (select {_PATHS} as entry from documents)""",
    "stage_tables": _contents_sql(FEEDS["amendments"], "digest", "written"),
    "publish_tables": raw_sql("scrutin_votes_individuels"),
    "publish_digests": _contents_sql(FEEDS["ballots"], "digest", "written"),
    "load_counts": _contents_sql(FEEDS["files"], "written"),
    # Rows of marts are compared under the marts' own names; here, that they are stored as built.
    "materialise": "select *, true as intact from ("
    + _counts_sql([n for n, model in MODELS.items() if model.stored])
    + ")",
    "dq_required": _dq_required_sql(),
    "dq_not_null": over_raw(
        " union all ".join(
            f"select '{m}' as model, '{c}' as column_name,"
            f" count(case when {c} is null then 1 end) as failures from {m}"
            for m, c in _KEYS
        )
    ),
    "dq_unique": over_raw(
        " union all ".join(
            f"select '{m}' as model, {c} as value, count(*) as n_records from {m}"
            f" where {c} is not null group by {c} having count(*) > 1"
            for m, c in _UNIQUES
        )
    ),
    "dq_no_exact_duplicates": over_raw("""
        select * exclude (ingested_at),
               case preseance when 3 then 2 when 7 then 3 end as row_count
        from stg_mandats where preseance in (3, 7)"""),
    "dq_sources_present": _dq_sources_present_sql(),
    "browse_list_tables": _counts_sql(FEEDS["questions"]),
    "browse_count_rows": _counts_sql(RAW_TABLES),
    "browse_preview": over_raw("select * from acteurs order by uid limit 20"),
}
