"""Text columns: Unicode whitespace, entities, cleaning, prompt text."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from html import unescape as _unescape_text

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that count as whitespace, as a regex class and as
# a trim set.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Entities decoded inside the JVM. "&amp;" comes last, so that
# "&amp;lt;" becomes "&lt;". Any other reference goes through the full table.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "\xa0",
    "&copy;": "©",
    "&middot;": "·",
    "&eacute;": "é",
    "&egrave;": "è",
    "&agrave;": "à",
    "&ccedil;": "ç",
    "&rsquo;": "’",
    "&amp;": "&",
}
_OTHER_ENTITY = "&(?!(?:" + "|".join(e[1:] for e in ENTITIES) + r"))[^\t\n\f <&;]"


def strip(c: Column) -> Column:
    """Drop Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Every run of whitespace becomes one space; the ends are trimmed."""
    return F.btrim(F.regexp_replace(c, WS + "+", " "))


def filled(c: Column) -> Column:
    """NULL for the empty string; blanks are kept."""
    return F.nullif(c, F.lit(""))


def stripped(c: Column) -> Column:
    """Stripped text, NULL if nothing is left."""
    return filled(strip(c))


def first_filled(*cols: Column) -> Column:
    """The first value that is neither NULL nor the empty string."""
    return F.coalesce(*[filled(c) for c in cols])


# Fixed value: bytes of values that a Python step holds as Python objects at once, unless one value has more.
PIECE_BYTES = 1 << 20


def mapped(values: pa.Array, use: Callable, kind: pa.DataType) -> pa.Array:
    """``use`` of every value, by pieces of bounded bytes; an array without a value is passed at once."""
    if values.null_count == len(values):
        return pa.nulls(len(values), kind)
    step = max(1, len(values) * PIECE_BYTES // max(1, values.nbytes))
    parts = [pa.array(map(use, values.slice(at, step).to_pylist()), kind) for at in range(0, len(values), step)]
    return pa.concat_arrays(parts)


# One call for each batch: Spark gives all such values of a step to the same Python worker, which it does not for
# functions on iterators.
@F.arrow_udf(StringType())
def _decode_all(part: pa.Array) -> pa.Array:
    return mapped(part, lambda text: None if text is None else _unescape_text(text), pa.string())


# Python stages are marked as not deterministic: Spark then keeps them as one step and
# does not run them again for a filter above.
_unescape_rest = _decode_all.asNondeterministic()


def unescape(c: Column) -> Column:
    """Decode character references. Pass a plain column, it is used several times.

    Only values holding a reference outside ``ENTITIES`` travel to Python; for
    all others the Arrow column carries NULL.
    """
    decoded = c
    for entity, char in ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    rare = c.rlike(_OTHER_ENTITY)
    return F.coalesce(_unescape_rest(F.when(rare, c)), F.when(F.contains(c, F.lit("&")), decoded).otherwise(c))


def first_chars(c: Column, n: int | None) -> Column:
    """The first ``n`` code points, all of them if ``n`` is None."""
    return c if n is None else F.substring(c, 1, n)


def with_clean_text(df: DataFrame, limits: Mapping[str, int | None]) -> DataFrame:
    """Clean the named string columns in place: decode, collapse, cut to code points.

    A limit of None keeps the whole text. An empty result is NULL. The cut is the
    last step, a trailing space it may leave is kept.
    """
    decoded = df.withColumns({name: unescape(F.col(name)) for name in limits})
    squeezed = decoded.withColumns({name: collapse(F.col(name)) for name in limits})
    return squeezed.withColumns({name: filled(first_chars(F.col(name), n)) for name, n in limits.items()})
