"""Reading facts off executed plans."""

from __future__ import annotations


def executed(df) -> str:
    """Runs the query and returns its final physical plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]
