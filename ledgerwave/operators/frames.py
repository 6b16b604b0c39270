"""Row frames over ordered rows, many rows at a time.

A native sliding frame feeds every row of the frame to its aggregates anew, for
every row. With frames of hundreds of rows that is most of the time of a feature
set. Here the rows of a batch and the rows just before them are numpy arrays, and
a frame is read offset by offset, oldest row first, for all rows at once. Each sum
and moment is formed in the order of the native frame, so values have the same bits.

Nulls are kept apart from NaN: ``known`` marks the rows that have a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view

from ledgerwave.operators.moving import Moving

CHUNK = 5_000  # rows worked on at a time: some 60 MB where frames reach 360 rows back
_NONE_YET = 1e-300  # a count of zero that may be divided by; adding one gives one


@dataclass
class Values:
    data: np.ndarray
    known: np.ndarray

    def __sub__(self, other: Values) -> Values:
        return Values(self.data - other.data, self.known & other.known)

    def __mul__(self, other: Values) -> Values:
        return Values(self.data * other.data, self.known & other.known)

    def __abs__(self) -> Values:
        return Values(np.abs(self.data), self.known)

    def over(self, other: Values) -> Values:
        """Null where the divisor is null or zero."""
        return Values(self.data / other.data, self.known & other.known & (other.data != 0))

    def above(self, other: Values) -> np.ndarray:
        """NaN is above every number; false where either side is null."""
        higher = (self.data > other.data) | (np.isnan(self.data) & ~np.isnan(other.data))
        return higher & self.known & other.known


class _Offsets:
    """A variable at every offset up to ``depth`` rows back, the furthest first."""

    def __init__(self, values: Values, place: np.ndarray, depth: int):
        n = len(place)
        self.depth, self.place = depth, place
        self.whole = bool(values.known.all())
        self.nan = bool(np.isnan(values.data).any())
        back = np.arange(depth, -1, -1)
        self.known = place[None, :] >= back[:, None]
        if not self.whole:
            self.known &= sliding_window_view(np.concatenate([np.zeros(depth, bool), values.known]), n)
        self._data = sliding_window_view(np.concatenate([np.zeros(depth), values.data]), n)
        self._filled: dict[str, np.ndarray] = {}

    def rows(self, length: int, shift: int) -> slice:
        return slice(self.depth - (length - 1 + shift), self.depth - shift + 1)

    def filled(self, value: float) -> np.ndarray:
        """The offsets with another value where there is no row, or a null."""
        if (key := str(value)) not in self._filled:
            self._filled[key] = np.where(self.known, self._data, value)
        return self._filled[key]

    def weights(self) -> np.ndarray:
        if "weights" not in self._filled:
            self._filled["weights"] = self.known.astype(float)
        return self._filled["weights"]

    def count(self, length: int, shift: int) -> np.ndarray:
        if self.whole:
            return np.clip(self.place + 1 - shift, 0, length)
        return np.count_nonzero(self.known[self.rows(length, shift)], axis=0)

    def total(self, length: int, shift: int) -> np.ndarray:
        return np.add.reduce(self.filled(0.0)[self.rows(length, shift)], axis=0) + 0.0

    def highest(self, length: int, shift: int) -> np.ndarray:
        return np.maximum.reduce(self.filled(-np.inf)[self.rows(length, shift)], axis=0)

    def lowest(self, length: int, shift: int) -> np.ndarray:
        if self.nan:  # NaN is the largest value: the lowest only where there is nothing else
            return np.fmin.reduce(self.filled(np.nan)[self.rows(length, shift)], axis=0)
        return np.minimum.reduce(self.filled(np.inf)[self.rows(length, shift)], axis=0)

    def moment(self, length: int, shift: int) -> np.ndarray:
        """Sum of squared distances from the mean, updated row by row."""
        rows, n = self.rows(length, shift), len(self.place)
        count, mean, squares = np.full(n, _NONE_YET), np.zeros(n), np.zeros(n)
        delta, step = np.empty(n), np.empty(n)
        for x, weight in zip(self.filled(0.0)[rows], self.weights()[rows]):
            count += weight
            np.subtract(x, mean, out=delta)
            if not self.whole:  # else the rows left out come first, where all are zero
                delta *= weight
            np.divide(delta, count, out=step)
            mean += step
            np.subtract(delta, step, out=step)
            step *= delta
            squares += step
        return squares


class Frames:
    """Rows in order, each with its place in its entity (0 for the first)."""

    def __init__(self, place: np.ndarray, columns: dict[str, Values], reach: dict[str, int]):
        self.place, self.columns, self.reach = place, columns, reach
        self._offsets: dict[str, _Offsets] = {}
        self._made: dict[tuple, Values] = {}

    def __getitem__(self, variable: str) -> Values:
        return self.columns[variable]

    def back(self, values: Values, rows: int) -> Values:
        """Values some rows back in the entity."""
        data, known = np.zeros(len(self.place)), np.zeros(len(self.place), bool)
        left = max(0, len(data) - rows)
        data[rows:], known[rows:] = values.data[:left], values.known[:left]
        return Values(data, known & (self.place >= rows))

    def lag(self, variable: str, rows: int) -> Values:
        return self.back(self[variable], rows)

    def moving(self, wanted: Moving) -> Values:
        key = (wanted.measure, wanted.variable, wanted.length, wanted.shift)
        if key not in self._made:
            self._made[key] = self._moving(wanted)
        return self._made[key]

    def _moving(self, wanted: Moving) -> Values:
        if wanted.variable not in self._offsets:
            self._offsets[wanted.variable] = _Offsets(
                self[wanted.variable], self.place, self.reach[wanted.variable]
            )
        rows, frame = self._offsets[wanted.variable], (wanted.length, wanted.shift)
        count = rows.count(*frame)
        if wanted.measure == "max":
            return Values(rows.highest(*frame), count > 0)
        if wanted.measure == "min":
            return Values(rows.lowest(*frame), count > 0)
        if wanted.measure == "avg":
            return Values(rows.total(*frame) / count, count > 0)
        if wanted.measure == "std":
            var = self.moving(Moving("var", wanted.variable, *frame))
            return Values(np.sqrt(var.data), var.known)
        return Values(rows.moment(*frame) / (count - 1), count > 1)

    def total(self, values: Values, length: int, shift: int) -> Values:
        rows = _Offsets(values, self.place, length - 1 + shift)
        return Values(rows.total(length, shift), rows.count(length, shift) > 0)


def rounded(values: Values, digits: int) -> Values:
    """Rounded half up as a decimal number, with negative zero turned into zero.

    The nearest whole number of the last decimal is exact unless the value lies next to
    a tie or is too large; those are rounded as decimal numbers, one by one.
    """
    x = np.where(values.known, values.data, 0.0)
    size, scale = np.abs(x), 10.0 ** abs(digits)
    units = size * scale if digits >= 0 else size / scale
    below = np.floor(units)
    near = np.abs(units - below - 0.5) <= units * 2.0**-50
    whole = np.where(units - below > 0.5, below + 1, below)
    out = whole / scale if digits >= 0 else whole * scale
    out = np.where(np.isfinite(x), np.copysign(out, x), x)
    place = Decimal(1).scaleb(-digits)
    for i in np.flatnonzero(near & np.isfinite(x)):
        d = Decimal(repr(float(x[i])))
        if d.as_tuple().exponent < -digits:
            d = (d / place).to_integral_value(ROUND_HALF_UP) * place
        out[i] = float(d)
    return Values(out + 0.0, values.known)


Vector = Callable[[Frames], Values]


def _values(column: pa.Array) -> Values:
    known = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    return Values(column.fill_null(0.0).to_numpy(zero_copy_only=False), known)


def in_batches(
    variables: list[str], place: str, features: list[tuple[str, Vector, int | None]],
    stats: list[Moving], depth: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Appends features to batches of ordered rows. ``place`` numbers the rows of an
    entity from 1 and is dropped; ``stats`` are the moving statistics that features read;
    ``depth`` rows before a batch are kept for it."""
    reach = {v: max((m.length - 1 + m.shift for m in stats if m.variable == v), default=0) for v in variables}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(0, int), {v: Values(np.zeros(0), np.zeros(0, bool)) for v in variables}
        for whole in batches:
            for start in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(start, CHUNK)
                held = len(before[0])
                at = np.concatenate([before[0], batch.column(place).to_numpy() - 1])
                data = {}
                for v, old in before[1].items():
                    new = _values(batch.column(v))
                    data[v] = Values(
                        np.concatenate([old.data, new.data]), np.concatenate([old.known, new.known])
                    )
                frames, made = Frames(at, data, reach), []
                with np.errstate(all="ignore"):
                    for _, vector, digits in features:
                        got = vector(frames)
                        got = Values(got.data[held:], got.known[held:])
                        if digits is not None:
                            got = rounded(got, digits)
                        made.append(pa.array(got.data, mask=~got.known))
                kept = [n for n in batch.schema.names if n != place]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in kept] + made, kept + [n for n, *_ in features]
                )
                last = max(0, len(at) - depth)
                before = at[last:], {v: Values(x.data[last:], x.known[last:]) for v, x in data.items()}

    return run
