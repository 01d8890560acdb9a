"""Expectations about a table, all evaluated in one aggregation over it."""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ROWS = "rows"

# Fixed values, below: names and wording of the checks' results, which alerts match.


@dataclass(frozen=True)
class Expectation:
    """Named measures to aggregate, and the verdict and wording drawn from them."""

    check: str
    measures: dict[str, Column]
    passed: Column
    detail: Column


def _count() -> Column:
    return F.count(F.lit(1))


def unique(column: str, *more: str) -> Expectation:
    """All values differ. NULL counts as one value: a single NULL passes, two fail. With
    ``more`` columns the values are those of all of them together."""
    named = ", ".join((column, *more))
    nulls, values = f"nulls_{named}", f"values_{named}"
    value = F.when(F.col(column).isNotNull(), F.struct(column, *more)) if more else F.col(column)
    distinct = F.col(values) + (F.col(nulls) > 0).cast("int")
    return Expectation(
        check=f"unique[{named}]",
        measures={
            ROWS: _count(),
            nulls: F.count_if(F.col(column).isNull()),
            values: F.count_distinct(value),
        },
        passed=F.col(ROWS) == distinct,
        detail=F.format_string("%d rows / %d distinct", F.col(ROWS), distinct),
    )


def not_null(column: str, max_ratio: float) -> Expectation:
    """The share of NULLs is at most ``max_ratio``; an empty table has none."""
    nulls = f"nulls_{column}"
    ratio = F.coalesce(F.try_divide(F.col(nulls), F.col(ROWS)), F.lit(0.0))
    return Expectation(
        check=f"not_null[{column}]",
        measures={ROWS: _count(), nulls: F.count_if(F.col(column).isNull())},
        passed=ratio <= max_ratio,
        detail=F.format_string(f"null ratio %.4f <= {max_ratio}", ratio),
    )


def min_rows(least: int, label: str) -> Expectation:
    return Expectation(
        check=f"min_rows[{label}]",
        measures={ROWS: _count()},
        passed=F.col(ROWS) >= least,
        detail=F.format_string(f"%d >= {least}", F.col(ROWS)),
    )


def non_negative(column: str) -> Expectation:
    """No value is below zero; NULLs pass."""
    below = f"negative_{column}"
    return Expectation(
        check=f"non_negative[{column}]",
        measures={below: F.count_if(F.col(column) < 0)},
        passed=F.col(below) == 0,
        detail=F.format_string("%d negative values", F.col(below)),
    )


def evaluate(df: DataFrame, *expectations: Expectation) -> DataFrame:
    """One row ``(check, passed, detail)`` per expectation, from one pass over ``df``.

    Measures shared between expectations are aggregated once.
    """
    measures = {name: column for e in expectations for name, column in e.measures.items()}
    verdicts = [
        F.struct(F.lit(e.check).alias("check"), e.passed.alias("passed"), e.detail.alias("detail"))
        for e in expectations
    ]
    measured = df.agg(*[column.alias(name) for name, column in measures.items()])
    return measured.select(F.inline(F.array(*verdicts)))


class ExpectationsFailed(ValueError):
    """Raised by ``gate``; the message lists the failed checks, ``results`` has all."""

    def __init__(self, message: str, results: Iterable[Row]):
        super().__init__(message)
        self.results = list(results)


def gate(results: Iterable[Row], fail_on_error: bool = True) -> list[Row]:
    """The failed results; raises if there are any, unless told only to report.

    Takes collected results: one row per check, however large the tables were.
    """
    results = list(results)
    failed = [r for r in results if not r["passed"]]
    if failed and fail_on_error:
        named = ", ".join(f"{r['check']} ({r['detail']})" for r in failed)
        raise ExpectationsFailed(f"Data quality checks failed: {named}", results)
    return failed
