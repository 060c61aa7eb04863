"""Shared reading of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions.nodes import bind
from rostrum.sources.archive import json_documents


def _fail(message: str) -> Column:
    return F.raise_error(F.concat(F.lit(message + " in "), F.coalesce("entry", F.lit("?"))))


def parse_documents(
    documents: DataFrame,
    prefix: str,
    root: str,
    schema: T.DataType,
    *,
    bad_json: str = "fail",
    no_root: str = "skip",
) -> DataFrame:
    """``(entry, doc)`` with the ``root`` node of every JSON document under ``prefix``.

    ``bad_json`` and ``no_root`` say whether a document that is not JSON, or one
    without that node, fails the job or is left out.
    """
    # Read as the only element of a list, a body may hold nothing before or after
    # its document: more documents make more elements, other text bad JSON.
    listed = F.concat(F.lit("["), "body", F.lit("]"))
    shape = T.ArrayType(T.StructType([T.StructField(root, schema)]))
    parsed = F.from_json(listed, shape, {"allowSingleQuotes": "false"})
    one = F.try_variant_get(F.try_parse_json(listed), "$", "array<variant>")
    nodes = T.ArrayType(schema)
    none = F.array().cast(nodes)
    lacking = _fail(f"no {root}").cast(nodes) if no_root == "fail" else none
    malformed = _fail("bad JSON").cast(nodes) if bad_json == "fail" else none

    def read(found: Column) -> Column:
        doc = F.get(found, 0)[root]
        kept = (F.size(found) == 1) & doc.isNotNull()
        return F.when(kept, F.array(doc)).when(F.size(one) == 1, lacking).otherwise(malformed)

    # All checks stand in one generator: as filters each of them would parse the document again, or
    # be written out so often that the generated code is too long to be compiled.
    return json_documents(documents, prefix).select("entry", F.explode(bind(parsed, read)).alias("doc"))
