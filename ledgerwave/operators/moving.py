"""Moving statistics over row frames of one window.

All frames share one partitioning and order, so however many there are, the
rows are exchanged once and sorted once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerwave.operators.series import Series

_FUNCTIONS = {
    "avg": "avg", "std": "stddev_samp", "var": "var_samp", "min": "min", "max": "max",
}


@dataclass(frozen=True)
class Moving:
    """Statistic of the ``length`` rows that end ``shift`` rows back."""

    measure: str
    variable: str
    length: int
    shift: int = 0

    @property
    def name(self) -> str:
        return f"_{self.measure}_{self.variable}_{self.length}_{self.shift}"

    def sql(self, series: Series) -> str:
        first, last = self.length - 1 + self.shift, self.shift
        end = f"{last} preceding" if last else "current row"
        return (
            f"{_FUNCTIONS[self.measure]}({self.variable}) over ({series.sql} "
            f"rows between {first} preceding and {end})"
        )


def add_moving(df: DataFrame, wanted: list[Moving], series: Series) -> DataFrame:
    """``df`` with one helper column per wanted statistic."""
    return df.withColumns({m.name: F.expr(m.sql(series)) for m in dict.fromkeys(wanted)})
