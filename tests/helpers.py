"""Helpers that several test files share."""


def rows(df):
    """Rows as sorted tuples, nulls first."""
    return sorted(
        (tuple(row) for row in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r]
    )


def plan(df) -> str:
    """The physical plan as text; after an action it is the executed one."""
    return df._jdf.queryExecution().executedPlan().toString()
