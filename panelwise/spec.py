"""What the columns of a statement panel mean."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a panel: many rows per ``key``, ordered by ``ts`` and then ``tiebreak``.

    Spark tables have no row order, so "first", "last" and "previous" always mean the order
    ``(ts, *tiebreak)``. Pass enough tiebreak columns to make that order total inside each key.
    ``numeric`` may be left out: every numeric column without another role is then taken.
    """

    key: str
    ts: str
    tiebreak: Sequence[str] = ()
    categorical: Sequence[str] = ()
    numeric: Sequence[str] | None = None
    exclude: Sequence[str] = ("target",)

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tiebreak]

    def order_struct(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def numeric_columns(self, panel: DataFrame) -> list[str]:
        if self.numeric is not None:
            return list(self.numeric)
        taken = {self.key, *self.order, *self.categorical, *self.exclude}
        return [
            f.name
            for f in panel.schema.fields
            if f.name not in taken and isinstance(f.dataType, T.NumericType)
        ]

    def categorical_columns(self, panel: DataFrame) -> list[str]:
        return [c for c in self.categorical if c in panel.columns]

    def roles(self, panel: DataFrame) -> dict[str, str]:
        """Role of every panel column: key, order, numeric, categorical or unused."""
        numeric, categorical = self.numeric_columns(panel), self.categorical_columns(panel)

        def role(c: str) -> str:
            if c == self.key:
                return "key"
            if c in self.order:
                return "order"
            if c in categorical:
                return "categorical"
            return "numeric" if c in numeric else "unused"

        return {c: role(c) for c in panel.columns}

    def prepare(self, panel: DataFrame) -> DataFrame:
        """Drop rows without a key; give ``ts`` a timestamp type (it may be a string or a date)."""
        panel = panel.where(F.col(self.key).isNotNull())
        if isinstance(panel.schema[self.ts].dataType, (T.StringType, T.DateType)):
            return panel.withColumn(self.ts, F.col(self.ts).cast("timestamp_ntz"))
        return panel
