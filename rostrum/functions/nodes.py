"""Column helpers for document nodes that are "one value or a list of values".

Such a node is declared STRING when its document is parsed, which keeps its raw
JSON text; these functions then read that text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions.coerce import to_str


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it.

    Parsing a node is dear and Spark would repeat it at every mention.
    """
    return F.get(F.transform(F.array(value), use), 0)


def fields(*names: str | tuple[str, T.DataType]) -> T.StructType:
    """Struct of text fields; a pair gives a field another type."""
    pairs = [(n, T.StringType()) if isinstance(n, str) else n for n in names]
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


def objects(text: Column, schema: T.StructType) -> Column:
    """Array of the objects in an object-or-list node; other members are left out."""
    whole = F.from_json(text, T.ArrayType(schema))
    members = F.filter(F.from_json(text, "array<string>"), lambda m: m.startswith("{"))
    picked = F.transform(members, lambda m: F.from_json(m, schema))
    return F.filter(F.coalesce(whole, picked), lambda m: m.isNotNull())


def first_object(text: Column, schema: T.StructType) -> Column:
    """The node itself when it is an object, else the first object of its list."""
    return F.get(objects(text, schema), 0)


def values(text: Column) -> Column:
    """Array of the values in a value-or-list node, NULL members kept in place."""
    return F.when(text.startswith("["), F.from_json(text, "array<string>")).when(
        text.isNotNull(), F.array(text)
    )


def organe_refs(node: Column) -> Column:
    """Body references of a mandate's ``organes`` node as an array.

    No node or no reference gives an empty array, one string gives one element,
    a list is taken as it is. Anything else is an error in the feed.
    """
    none = F.array().cast("array<string>")
    other = F.raise_error(F.concat(F.lit("organeRef must be text or a list in "), node))
    parsed = F.from_json(node, fields("organeRef")).organeRef
    refs = bind(
        parsed,
        lambda r: F.when(r.isNull(), none)
        .when(r.startswith("["), F.from_json(r, "array<string>"))
        .otherwise(F.array(r)),
    )
    unfit = node.rlike(r'"organeRef"\s*:\s*[^"\[\s]')
    return F.when(unfit, other.cast("array<string>")).otherwise(F.coalesce(refs, none))


def voters(container: Column, schema: T.StructType) -> Column:
    """Voters of a container: ``{votant: one or many}``, a bare list, or one voter.

    An empty object holds no voter. Voters have a field ``votant`` besides those of ``schema``.
    """
    voter = T.StructType([T.StructField("votant", T.StringType(), True), *schema.fields])

    def read(found: Column) -> Column:
        one = F.get(found, 0)
        filled = F.coalesce(*[one[name] for name in schema.names]).isNotNull()
        return (
            F.when(container.startswith("["), found)
            .when(one.votant.isNotNull(), objects(one.votant, voter))
            .when(filled & ~container.contains('"votant"'), found)
            .otherwise(_rare_voters(container, voter))
        )

    return bind(objects(container, voter), read)


def _rare_voters(container: Column, voter: T.StructType) -> Column:
    """Voters of an object of which the known fields do not say whether it is or holds a voter."""
    keyed = F.from_json(container, "map<string,string>")
    node = bind(
        keyed,
        lambda k: F.when(F.map_contains_key(k, "votant"), k["votant"]).when(F.size(k) > 0, container),
    )
    return bind(node, lambda n: objects(n, voter))


def text_or_uid(text: Column) -> Column:
    """A reference written either as text or as an object holding ``uid``."""
    return to_str(
        F.when(text.startswith("{"), F.get_json_object(text, "$.uid")).otherwise(text)
    )
