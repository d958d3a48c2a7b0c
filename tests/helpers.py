"""Helpers of the tests."""


def values(df, *columns):
    """Rows as plain tuples."""
    rows = df.select(*columns) if columns else df
    return [tuple(r) for r in rows.collect()]
