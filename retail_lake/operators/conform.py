"""Column rules as data: typed output columns plus named reasons to reject a row."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"
RECORD = "record"
_RAW = "_raw"


def raw_column(name: str) -> Column:
    """A column of the raw row, for use in a rejection."""
    return F.col(f"{_RAW}.{name}")


@dataclass(frozen=True)
class Conformed:
    """A table whose rows all carry the reason they were rejected for, or NULL."""

    labelled: DataFrame

    @property
    def accepted(self) -> DataFrame:
        return self.labelled.where(F.col(REASON).isNull()).drop(REASON, RECORD)

    @property
    def rejected(self) -> DataFrame:
        """Reason and original row (as JSON) of everything that was turned away."""
        return self.labelled.where(F.col(REASON).isNotNull()).select(REASON, RECORD)


@dataclass(frozen=True)
class Rules:
    """``columns`` are computed from the raw row; ``rejects`` are predicates on the
    result, or on the raw row through ``raw_column``.

    The first matching rejection names the reason. A predicate that is NULL does
    not reject, so each rule says itself what an unknown value means.
    """

    columns: Mapping[str, Column]
    rejects: Mapping[str, Column] = field(default_factory=dict)

    def apply(self, df: DataFrame, record: Sequence[str] = ()) -> Conformed:
        """``record`` names the columns that make up the raw row, if not all do."""
        typed = df.select(
            *[column.alias(name) for name, column in self.columns.items()],
            F.struct(*(record or df.columns)).alias(_RAW),
        )
        reason = F.lit(None).cast("string")
        for name, rejected in reversed(self.rejects.items()):
            reason = F.when(rejected, name).otherwise(reason)
        record = F.when(F.col(REASON).isNotNull(), F.to_json(_RAW))
        return Conformed(
            typed.withColumn(REASON, reason).withColumn(RECORD, record).drop(_RAW)
        )
