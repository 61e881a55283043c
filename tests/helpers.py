from collections import Counter


def rows(df):
    """Rows as a multiset of tuples in column order."""
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    """The physical plan Spark would run, as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The physical plan after adaptive execution, as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
