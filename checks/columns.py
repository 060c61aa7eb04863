"""Column functions over text derived from whole benchmark tables, with their DuckDB equivalents.

The text expressions are plain SQL both engines read the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapter import RUN_TIME, bench_table
from rostrum.functions import coerce
from rostrum.functions.nodes import organe_refs
from rostrum.sources.transcripts import mixed_text

_DAY = "cast(cast(o_orderdate as date) as string)"
_COMPACT = f"replace({_DAY}, '-', '')"
_WORD = """case cast(l_orderkey % 7 as int) when 0 then '1' when 1 then ' 1 ' when 2 then 'true'
    when 3 then 'FALSE ' when 4 then '0' when 5 then ''  end"""
_NUMBER = """case cast(l_orderkey % 6 as int) when 0 then cast(l_partkey as string)
    when 1 then ' -' || cast(l_partkey as string) || ' ' when 2 then cast(l_quantity as string)
    when 3 then '+' || cast(l_suppkey as string) when 4 then l_returnflag end"""
_DATE_TEXT = f"""case cast(o_orderkey % 7 as int) when 0 then {_DAY}
    when 1 then {_DAY} || 'T10:11:12' when 2 then {_COMPACT} when 3 then {_COMPACT} || '150000000'
    when 4 then substr({_DAY}, 1, 4) when 5 then substr({_DAY}, 1, 8) || '32' end"""
_TS_TEXT = f"""case cast(o_orderkey % 7 as int) when 0 then {_DAY} || 'T10:11:12Z'
    when 1 then {_DAY} || 'T10:11:12.5+02:00' when 2 then {_DAY} when 3 then {_DAY} || ' 10:11'
    when 4 then substr({_DAY}, 1, 4) when 5 then {_DAY} || 'T25:00:00' end"""
_LOOSE_DAY = f"""case cast(o_orderkey % 6 as int) when 0 then {_DAY} when 1 then {_COMPACT}
    when 2 then substr({_DAY}, 1, 5) || '7-1' when 3 then substr({_DAY}, 1, 4)
    when 4 then {_DAY} || ' 10:00' end"""
_REFS = """case cast(o_orderkey % 6 as int)
    when 0 then '{"organeRef":"PO' || cast(o_custkey as string) || '"}'
    when 1 then '{"organeRef":["PO' || cast(o_custkey as string) || '",null,"PX"]}'
    when 2 then '{"organeRef":[]}' when 3 then '{}'
    when 4 then '{"autre":1,"organeRef":"PY"}' end"""
_PADDED = """case when doc_id % 5 = 0 then '  ' || chr(9) || chr(10)
    else chr(9) || ' ' || text || chr(160) || chr(10) end"""
_MARKUP = (
    "'<texte> ' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10), '<br/>')"
    " || ' <i> (<b> ' || role || ' </b>) </i></texte>'"
)


def _over(
    table: str, keys: tuple[str, ...], text: str, function: Callable, name: str
) -> tuple[Callable[[SparkSession, str], DataFrame], Callable[[str], str]]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        source = bench_table(spark, sf_dir, table).selectExpr(*keys, f"{text} as source_text")
        return source.select(*keys, function(F.col("source_text")).alias(name))

    def sql(expected: str) -> str:
        source = f"select *, {text} as x from {table}"
        return f"select {', '.join(keys)}, {expected} as {name} from ({source})"

    return query, sql


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_BLANK = "' ' || chr(9) || chr(10) || chr(160)"

_CASES = {
    "to_str": (
        _over("documents", ("doc_id",), _PADDED, coerce.to_str, "value"),
        f"nullif(trim(x, {_BLANK}), '')",
    ),
    "to_date": (
        _over("orders", ("o_orderkey",), _DATE_TEXT, coerce.to_date, "value"),
        "case when length(x) >= 8 and x not like '%-%'"
        " then cast(try_strptime(substr(x, 1, 8), '%Y%m%d') as date)"
        " when substr(x, 5, 1) = '-' and length(x) >= 10 then try_cast(substr(x, 1, 10) as date) end",
    ),
    "to_ts": (
        _over("orders", ("o_orderkey",), _TS_TEXT, coerce.to_ts, "value"),
        "case cast(o_orderkey % 7 as int)"
        " when 0 then cast(o_orderdate as date) + interval '10 hours 11 minutes 12 seconds'"
        " when 1 then cast(o_orderdate as date) + interval '8 hours 11 minutes 12.5 seconds'"
        " when 2 then cast(cast(o_orderdate as date) as timestamp)"
        " when 3 then cast(o_orderdate as date) + interval '10 hours 11 minutes' end",
    ),
    "to_int": (
        _over("lineitem", _LINE, _NUMBER, coerce.to_int, "value"),
        "case when regexp_full_match(trim(x), '[+-]?[0-9]+')"
        " then cast(replace(trim(x), '+', '') as bigint) end",
    ),
    "to_bool": (_over("lineitem", _LINE, _WORD, coerce.to_bool, "value"), "trim(x) = '1'"),
    "to_bool_loose": (
        _over("lineitem", _LINE, _WORD, coerce.to_bool_loose, "value"),
        "case lower(trim(x)) when 'true' then true when '1' then true"
        " when 'false' then false when '0' then false end",
    ),
    "to_bool_word": (
        _over("lineitem", _LINE, _WORD, coerce.to_bool_word, "value"),
        "lower(x) = 'true'",
    ),
    "organe_refs": (
        _over(
            "orders",
            ("o_orderkey",),
            _REFS,
            lambda c: F.array_join(organe_refs(c), "|", "NULL"),
            "refs",
        ),
        "case cast(o_orderkey % 6 as int) when 0 then 'PO' || cast(o_custkey as varchar)"
        " when 1 then 'PO' || cast(o_custkey as varchar) || '|NULL|PX' when 4 then 'PY' else '' end",
    ),
    "ingested_at": (
        _over(
            "customer",
            ("c_custkey",),
            "c_name",
            lambda _: coerce.ingested_at(datetime.fromisoformat(RUN_TIME)),
            "ingested_at",
        ),
        f"timestamp '{RUN_TIME}'",
    ),
    "safe_cast_date": (
        _over("orders", ("o_orderkey",), _LOOSE_DAY, coerce.safe_cast_date, "value"),
        "case when regexp_full_match(x, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')"
        " then make_date(cast(split_part(x, '-', 1) as int), cast(split_part(x, '-', 2) as int),"
        " cast(split_part(x, '-', 3) as int)) end",
    ),
    "mixed_text": (
        _over("conversations", ("conv_id", "turn"), _MARKUP, mixed_text, "texte"),
        "trim(trim(text, ' ' || chr(10)) || case when right(text, 1) = chr(10) then chr(10) else '' end"
        " || ' (' || role || ')', ' ' || chr(10))",
    ),
}

QUERIES = {name: query for name, ((query, _), _) in _CASES.items()}
SQL = {name: sql(expected) for name, ((_, sql), expected) in _CASES.items()}
