"""Names and grid of a set of series, and the slot arithmetic built on them."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970 of a timestamp, free of any time zone."""
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    ).cast("bigint")


def from_epoch_seconds(seconds: Column) -> Column:
    """Inverse of :func:`epoch_seconds`; gives ``timestamp_ntz``."""
    zero = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(zero, zero, zero, seconds)


def shift_time(ts: Column, seconds: Column | int) -> Column:
    """``ts`` moved by a whole number of seconds."""
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, secs)


@dataclass(frozen=True)
class SeriesKeys:
    """Which columns identify a series, its time and value, and its grid step.

    ``chunk`` is the number of grid slots one window task handles at a time. All
    ordered operators work on ``(ids, chunk)`` groups, never on a whole series,
    so one very long series spreads over the cluster like many short ones.
    """

    ids: tuple[str, ...] = ("unique_id",)
    time: str = "ds"
    target: str = "y"
    step: int = 900
    chunk: int = 8192

    def __post_init__(self) -> None:
        object.__setattr__(self, "ids", tuple(self.ids))
        if self.step <= 0 or self.chunk <= 0:
            raise ValueError("step and chunk must be positive")

    @property
    def key(self) -> list[str]:
        return [*self.ids, self.time]

    def slot(self) -> Column:
        """Grid position of a row: whole steps since 1970."""
        t = f"`{self.time}`"
        seconds = f"unix_date(to_date({t})) * 86400L + hour({t}) * 3600 + minute({t}) * 60 + second({t})"
        return F.expr(f"floor(({seconds}) / {self.step})")

    def with_(self, **changes) -> "SeriesKeys":
        return replace(self, **changes)
