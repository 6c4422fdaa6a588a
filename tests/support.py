"""Helpers for looking at rows and plans."""



def rows(df):
    """Rows as tuples in a stable order that also holds NULLs."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df):
    """The physical plan without adaptive wrapping of finished stages."""
    return plan(df).split("== Initial Plan ==")[-1]
