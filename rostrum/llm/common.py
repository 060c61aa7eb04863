"""What the operators share: rows of documents, and tables kept between stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.session import shared_folder

SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` only, a null text being empty; other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def keep(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Cuts the lineage with files that outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_and_bytes(docs: DataFrame) -> tuple[int, int]:
    """Documents, and UTF-8 bytes of their texts."""
    found = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return int(found[0]), int(found[1])


def in_fold(doc_id: Column, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod 5 is ``remainder``; false for a null id."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(fold == remainder, F.lit(False))


def map_batches(
    df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with columns cast to what ``schema`` asks for."""
    return df.mapInArrow(make, schema)


def per_row_batches(
    batches: Iterator[pa.RecordBatch], make: Callable[[pa.RecordBatch], dict], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_pydict(make(batch), schema=schema)


def each_batch(
    df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: pa.Schema, ddl: str
) -> DataFrame:
    """One output batch, given as columns by name, for each batch of rows."""
    return df.mapInArrow(partial(per_row_batches, make=make, schema=schema), ddl)
