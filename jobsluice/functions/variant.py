"""Reading loosely typed payloads held as VARIANT.

Casts from VARIANT are lenient ("true" and 1 both become true), so every typed
read first looks at the stored type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.binding import bind


def strict_json(text: Column) -> Column:
    """VARIANT of a text that is one JSON value as a whole, else NULL.

    Spark's parser stops after the first value. Here the text is the first element of a list
    that ends with the text's own digest, so anything after the value breaks the list.
    """
    mark = F.md5(text)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    whole = lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == mark, child(v, "$[0]"))
    return bind(listed, whole)


def child(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind(v: Column) -> Column:
    """Stored type: ``OBJECT<..>``, ``ARRAY<..>``, ``STRING``, ``BIGINT``, ``VOID`` …; NULL if absent."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def is_number(v: Column) -> Column:
    return F.coalesce(kind(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def string_at(v: Column, path: str) -> Column:
    """The value if it is a string, else NULL."""
    node = child(v, path)
    return F.when(kind(node) == "STRING", F.try_variant_get(v, path, "string"))


def integer_at(v: Column, path: str) -> Column:
    """The value if it is an integer, else NULL ("5" and 5.0 are no integers)."""
    node = child(v, path)
    return F.when(kind(node) == "BIGINT", F.try_variant_get(v, path, "bigint"))


def number_at(v: Column, path: str) -> Column:
    """The value as DOUBLE if it is a number, else NULL."""
    return F.when(is_number(child(v, path)), F.try_variant_get(v, path, "double"))


def boolean_at(v: Column, path: str) -> Column:
    """The value if it is true or false, else NULL."""
    node = child(v, path)
    return F.when(kind(node) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))


# JSON texts of what counts as empty.
FALSY = ('""', "0", "0.0", "false", "null", "[]", "{}")


def truthy_text(v: Column, path: str) -> Column:
    """Text of a value, NULL if it is absent, null, "", 0, false, [] or {}."""
    literal = F.to_json(child(v, path))
    text = F.when(literal == "true", F.lit("True")).otherwise(F.try_variant_get(v, path, "string"))
    return F.when(~literal.isin(*FALSY), text)


def list_items(v: Column, path: str) -> Column:
    """array<variant> if the value is a list, else NULL."""
    return F.try_variant_get(v, path, "array<variant>")


def with_truthy_texts(df: DataFrame, node: str, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add one column per field: the first truthy text among its paths below the column ``node``.

    Every path is read once, in a step of its own.
    """
    paths = sorted({path for options in fields.values() for path in options})
    reads = {}
    for n, path in enumerate(paths):
        reads[f"_json{n}"] = F.to_json(child(F.col(node), path))
        reads[f"_text{n}"] = F.try_variant_get(node, path, "string")
    rows = df.withColumns(reads)
    texts = {
        path: F.when(F.col(f"_json{n}") == "true", "True").when(~F.col(f"_json{n}").isin(*FALSY), F.col(f"_text{n}"))
        for n, path in enumerate(paths)
    }
    rows = rows.withColumns({name: F.coalesce(*[texts[p] for p in options]) for name, options in fields.items()})
    return rows.drop(*reads)
