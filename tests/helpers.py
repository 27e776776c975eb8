from __future__ import annotations


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def ts(text):
    from pyspark.sql import functions as F
    return F.lit(text).cast("timestamp")
