"""Small helpers of the tests."""

from collections import Counter


def bag(df):
    """The rows of a DataFrame, without order."""
    return Counter(tuple(r) for r in df.collect())


def keyed(df, *keys):
    """Rows by key columns, the other columns as a tuple."""
    rest = [c for c in df.columns if c not in keys]
    return {tuple(r[k] for k in keys): tuple(r[c] for c in rest) for r in df.collect()}


def physical(df):
    return df._jdf.queryExecution().toString()
