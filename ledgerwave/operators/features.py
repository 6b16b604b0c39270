"""Window features over entities ordered in time.

A feature is described, not executed: it names the window helpers it needs and
the expression that combines them. ``with_features`` gathers the helpers of all
requested features, computes each distinct helper once, and leaves one exchange
and one sort for the whole set. Sets whose frames are long are computed from the
sorted rows in Arrow batches (``frames``), with the same results.

Frames count rows. ``moving`` and ``beta`` look at the current row and the n
before it; breakouts and strength look at the n rows before the current one.
Variants with ``fixed=True`` compute what the name suggests and carry the
suffix ``_fixed``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ledgerwave.operators.frames import Frames, Values, Vector, in_batches
from ledgerwave.operators.moving import Moving, add_moving
from ledgerwave.operators.series import MAX_ROWS, Series, over_series


@dataclass(frozen=True)
class Lag:
    """A column some rows back."""

    variable: str
    rows: int

    @property
    def name(self) -> str:
        return f"_lag_{self.variable}_{self.rows}"

    def sql(self, series: Series) -> str:
        return f"lag({self.variable}, {self.rows}) over ({series.sql})"


@dataclass(frozen=True)
class FrameSum:
    """Sum of an expression over helpers, for the ``length`` rows that end
    ``shift`` rows back."""

    name: str
    term: str
    length: int
    shift: int


@dataclass(frozen=True)
class Feature:
    """A named expression over input columns and helpers."""

    name: str
    value: str
    lookback: int
    lags: tuple[Lag, ...] = ()
    moving: tuple[Moving, ...] = ()
    sums: tuple[FrameSum, ...] = ()
    # Window expressions over input columns and helpers: (name, before, frame).
    windows: tuple[tuple[str, str, int], ...] = ()
    # The same value over arrays of doubles, and the columns that it reads.
    vector: Vector | None = None
    reads: tuple[str, ...] = ()
    is_flag: bool = False


_MEASURES = {"mean": "avg", "std": "std", "var": "var", "min": "min", "max": "max"}


def _change(variable: str, before: str) -> str:
    return f"try_divide({variable} - {before}, abs({before}))"


def _changed(frames: Frames, variable: str, n: int) -> Values:
    before = frames.lag(variable, n)
    return (frames[variable] - before).over(abs(before))


def _flag(rows: np.ndarray) -> Values:
    return Values(rows.astype(np.int32), np.ones(len(rows), bool))


def lag_feature(
    variable: str, n: int, period: str = "", period_text: str | None = None,
    kind: str = "amt", measure: str = "tot",
) -> Feature:
    lag = Lag(variable, n)
    span = period_text if period_text is not None else f"{n}{period}"
    return Feature(
        f"{kind}_{measure}_{variable}_{span}_lag", lag.name, n, lags=(lag,),
        vector=lambda frames: frames.lag(variable, n), reads=(variable,),
    )


def pct_change(
    variable: str, n: int, period: str = "", period_text: str | None = None
) -> Feature:
    """Change relative to the size of the earlier value; null on 0 or null."""
    lag = Lag(variable, n)
    span = period_text if period_text is not None else f"{n}{period}"
    return Feature(
        f"pct_tx_{variable}_{span}", _change(variable, lag.name), n, lags=(lag,),
        vector=lambda frames: _changed(frames, variable, n), reads=(variable,),
    )


def moving(variable: str, n: int, measure: str) -> Feature:
    stat = Moving(_MEASURES[measure], variable, n + 1)
    return Feature(
        f"amt_{_MEASURES[measure]}_{variable}_{n}", stat.name, n, moving=(stat,),
        vector=lambda frames: frames.moving(stat), reads=(variable,),
    )


def beta(variable: str, n: int, fixed: bool = False) -> Feature:
    """Distance from the own mean against distance from the lagged mean.

    The mean of the one-row-lagged values over the frame is the mean of the
    values over the frame moved back by one row, so no second window level is
    needed. The fixed variant is the slope of the value on the lagged value.
    """
    name = f"amt_beta_{variable}_{n + 1}"
    if fixed:
        lag = Lag(variable, 1)
        cov, var = f"_cov_{variable}_{n}", f"_varlag_{variable}_{n}"
        x = f"if({variable} is null, null, {lag.name})"
        return Feature(
            f"{name}_fixed", f"try_divide({cov}, {var})", n + 1, lags=(lag,),
            windows=((cov, f"covar_samp({variable}, {lag.name})", n), (var, f"var_samp({x})", n)),
        )
    own, earlier = Moving("avg", variable, n + 1), Moving("avg", variable, n + 1, 1)
    x, y = f"({variable} - {own.name})", f"({variable} - {earlier.name})"

    def vector(frames: Frames) -> Values:
        x, y = (frames[variable] - frames.moving(m) for m in (own, earlier))
        return (x * y).over(x * x)

    return Feature(
        name, f"try_divide({x} * {y}, {x} * {x})", n + 1, moving=(own, earlier),
        vector=vector, reads=(variable,),
    )


def broke_high(variable: str, n: int) -> Feature:
    high = Moving("max", variable, n, 1)
    return Feature(
        f"cat_{variable}_broke_high_{n}", f"if({variable} > {high.name}, 1, 0)", n, moving=(high,),
        vector=lambda frames: _flag(frames[variable].above(frames.moving(high))), reads=(variable,),
        is_flag=True,
    )


def broke_low(variable: str, n: int, fixed: bool = False) -> Feature:
    """Flag against the lowest of the n rows before: set when above it; the
    fixed variant is set when below it."""
    low, sign = Moving("min", variable, n, 1), "<" if fixed else ">"
    name = f"cat_{variable}_broke_low_{n}" + ("_fixed" if fixed else "")

    def vector(frames: Frames) -> Values:
        value, lowest = frames[variable], frames.moving(low)
        return _flag(lowest.above(value) if fixed else value.above(lowest))

    return Feature(
        name, f"if({variable} {sign} {low.name}, 1, 0)", n, moving=(low,),
        vector=vector, reads=(variable,), is_flag=True,
    )


def ifr(variable: str, n: int, fixed: bool = False) -> Feature:
    """Strength index: the mean price of the n rows before, booked as up or down
    by the sign of the day's change, and summed over the n rows before. The
    fixed variant sums gains and losses over the last n changes."""
    lag, v = Lag(variable, 1), variable
    if fixed:
        suffix, helpers, shift, lookback = "_fixed", (), 0, n
        gain, loss = (
            f"if({lag.name} is null, null, greatest({a} - {b}, 0D))"
            for a, b in ((v, lag.name), (lag.name, v))
        )
    else:
        mean = Moving("avg", v, n, 1)
        suffix, helpers, shift, lookback = "", (mean,), 1, 2 * n + 1
        gain, loss = (
            f"if({_change(v, lag.name)} {sign} 0, coalesce(nanvl({mean.name}, 0D), 0D), 0D)"
            for sign in "><"
        )
    up = FrameSum(f"_up_{v}_{n}{suffix}", gain, n, shift)
    down = FrameSum(f"_down_{v}_{n}{suffix}", loss, n, shift)
    value = f"100D - try_divide(100D, 1D + try_divide({up.name}, {down.name}))"

    def vector(frames: Frames) -> Values:
        price, change = frames.moving(helpers[0]), _changed(frames, v, 1)
        none = Values(np.zeros(len(price.data)), np.ones(len(price.data), bool))
        booked = np.where(price.known & ~np.isnan(price.data), price.data, 0.0)
        ups, downs = (
            frames.total(Values(np.where(rows, booked, 0.0), none.known), n, 1)
            for rows in (change.above(none), none.above(change))
        )
        ratio = ups.over(downs)
        rest = Values(np.full(len(ratio.data), 100.0), ratio.known).over(Values(1.0 + ratio.data, ratio.known))
        return Values(100.0 - rest.data, rest.known)

    return Feature(
        f"amt_IFR_{v}_{n}{suffix}", value, lookback, lags=(lag,), moving=helpers, sums=(up, down),
        vector=None if fixed else vector, reads=(v,),
    )


def _add_sums(df: DataFrame, sums: list[FrameSum], series: Series) -> DataFrame:
    """Plain frame sums: a NaN or infinity leaves with its row, and rounding does
    not depend on where a long entity is cut."""
    return df.withColumns({
        s.name: F.expr(
            f"sum({s.term}) over ({series.sql} rows between {s.length - 1 + s.shift} preceding "
            f"and {f'{s.shift} preceding' if s.shift else 'current row'})"
        )
        for s in sums
    })


# Rows that the frames of a set read for each row from which Arrow batches pay:
# below, native frames cost less than the way to Python and back.
LONG_FRAMES = 500
_PLACE = "_place"


def round_sql(value: str, digits: int) -> str:
    """Rounded, with negative zero turned into zero."""
    r = f"round({value}, {digits})"
    return f"if({r} = 0, 0D, {r})"


def with_features(
    df: DataFrame,
    features: list[Feature],
    keys: list[str],
    order: list[str],
    max_rows: int | None = MAX_ROWS,
    digits: dict[str, int] | None = None,
) -> DataFrame:
    """Input columns followed by the features, in the given order.

    ``max_rows`` as in ``over_series``. ``digits`` rounds the features it names.
    """
    columns, digits = df.columns, digits or {}

    def gathered(kind: str) -> list:
        return list(dict.fromkeys(x for f in features for x in getattr(f, kind)))

    lags, stats, sums, windows, reads = (
        gathered(k) for k in ("lags", "moving", "sums", "windows", "reads")
    )
    depth = max(f.lookback for f in features)
    types = {x.name: x.dataType for x in df.schema}
    doubles = all(f.vector for f in features) and all(types.get(v) == DoubleType() for v in reads)

    def finished(f: Feature) -> str:
        return round_sql(f"({f.value})", digits[f.name]) if f.name in digits else f.value

    def compute(data: DataFrame, series: Series) -> DataFrame:
        extra = [c for c in data.columns if c not in columns]
        if stats:
            data = add_moving(data, stats, series)
        if lags:
            data = data.withColumns({x.name: F.expr(x.sql(series)) for x in lags})
        if sums:
            data = _add_sums(data, sums, series)
        if windows:
            data = data.withColumns({
                name: F.expr(f"{call} over ({series.sql} rows between {n} preceding and current row)")
                for name, call, n in windows
            })
        return data.select(
            *columns, *[F.expr(finished(f)).alias(f.name) for f in features], *extra
        )

    def compute_in_batches(data: DataFrame, series: Series) -> DataFrame:
        # The window numbers the rows of each entity and leaves them dealt and sorted.
        placed = data.withColumn(_PLACE, F.expr(f"row_number() over ({series.sql})"))
        made = [StructField(f.name, IntegerType() if f.is_flag else DoubleType()) for f in features]
        wanted = [(f.name, f.vector, digits.get(f.name)) for f in features]
        run = in_batches(reads, _PLACE, wanted, stats, depth)
        done = placed.mapInArrow(run, StructType([*data.schema.fields, *made]))
        return done.select(*columns, *[f.name for f in features], *[c for c in data.columns if c not in columns])

    read = sum(x.length for x in [*stats, *sums])
    way = compute_in_batches if doubles and read >= LONG_FRAMES else compute
    return over_series(df, keys, order, depth, way, max_rows)
