"""Steps and their composition. Catalyst collapses a chain of projections into one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def step_exprs(*expressions: str) -> Step:
    """A step of SQL expressions, e.g. ``step_exprs("id", "n * 2 doubled")``."""
    return lambda df: df.selectExpr(*expressions)


def chain(*steps: Step) -> Step:
    """One step that applies ``steps`` from left to right."""

    def chained(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return chained


def sql_step(query: str, **parameters) -> Step:
    """A step of SQL text that names its input ``{src}``; other parameters are passed on to Spark."""
    return lambda df: df.sparkSession.sql(query, src=df, **parameters)
