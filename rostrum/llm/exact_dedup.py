"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest with one row per distinct
text ever admitted. A batch is reduced to one row per digest, sort-merge
anti-joined with the index, and what is new is appended; so neither the index
nor the texts of earlier batches are shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.llm.common import SPACES, keep

INDEX_BUCKETS = 64


def digest() -> Column:
    """SHA-256 of the text with white space runs made one space."""
    return F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " "), 256)


class DigestIndex:
    """The table ``name`` of digests, made when missing; ``buckets`` is fixed for its life."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = INDEX_BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            self._write(spark.createDataFrame([], "digest string, keep_id bigint"))

    def _append(self, rows: DataFrame) -> None:
        # One file per bucket, however many partitions the session deals out.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        self._write(rows.repartition(self.buckets, bucket))

    def _write(self, rows: DataFrame) -> None:
        (
            rows.write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, docs: DataFrame) -> DataFrame:
        """Deduplicate ``docs`` against the index and themselves, and append what is new.

        Returns one row per document: ``doc_id, text_sha256, keep_id,
        group_size, kept``. ``keep_id`` is the document that stays: the one
        admitted earlier, else the smallest id of the batch; ``group_size``
        counts the batch. A null text is empty, a null id comes after all
        others, and of repeated rows with one id one is kept. No documents give
        no rows and leave the index as it is.
        """
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest().alias("_digest"))
        # Repeated rows fold first; then a digest has one row per map task in the shuffle.
        ids = keep(rows.groupBy("doc_id", "_digest").agg(F.count(F.lit(1)).alias("_rows")))
        groups = keep(
            ids.groupBy(F.col("_digest").alias("digest")).agg(
                F.min("doc_id").alias("first_id"), F.sum("_rows").alias("group_size")
            )
        )
        earlier = self.table().select("digest", F.col("keep_id").alias("earlier_id"))
        known = groups.hint("merge").join(earlier.hint("merge"), "digest", "left_semi")
        # Decided before the append, so that it does not see this batch.
        decided = keep(
            known.join(earlier, "digest")
            .select("digest", F.col("earlier_id").alias("keep_id"), "group_size")
            .withColumn("new", F.lit(False))
            .unionByName(
                groups.hint("merge")
                .join(earlier.hint("merge"), "digest", "left_anti")
                .select("digest", F.col("first_id").alias("keep_id"), "group_size")
                .withColumn("new", F.lit(True))
            )
        )
        self._append(decided.where("new").select("digest", "keep_id"))
        # Both sides are plain exchanges, so adaptive execution can split a digest of many rows.
        return (
            ids.join(decided, ids["_digest"] == decided["digest"])
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
            .select(
                "doc_id",
                "keep_id",
                "group_size",
                (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
                F.col("digest").alias("text_sha256"),
            )
        )

    def first_copies(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that :meth:`admit` keeps, with all their columns."""
        kept = self.admit(docs).where("kept").select(
            F.col("doc_id").alias("_keep_doc"), F.col("text_sha256").alias("_keep_digest")
        )
        rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("doc_id"), digest().alias("digest"))
        same = rows["doc_id"].eqNullSafe(kept["_keep_doc"]) & (rows["digest"] == kept["_keep_digest"])
        copies = Window.partitionBy("doc_id", "digest").orderBy("digest")
        return (
            rows.join(kept, same)
            .withColumn("copy", F.row_number().over(copies))
            .where("copy = 1")
            .select("doc.*")
        )
