"""The reporting period. No operator reads the clock; all take a ReportPeriod."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

REFERENCE = "reference"
CORRECTED = "corrected"


def check_semantics(semantics: str) -> str:
    if semantics not in (REFERENCE, CORRECTED):
        raise ValueError(f"semantics must be {REFERENCE!r} or {CORRECTED!r}, got {semantics!r}")
    return semantics


@dataclass(frozen=True)
class ReportPeriod:
    """Half-open range of days ``[start, end)`` seen from the instant ``as_of`` (naive UTC)."""

    start: date
    end: date
    as_of: datetime
    label: str

    def __post_init__(self) -> None:
        if self.end <= self.start:
            raise ValueError(f"empty period: {self.start} .. {self.end}")
        if self.as_of.tzinfo is not None:
            object.__setattr__(self, "as_of", self.as_of.astimezone(timezone.utc).replace(tzinfo=None))

    @classmethod
    def for_previous_month(cls, as_of: datetime, semantics: str = REFERENCE) -> "ReportPeriod":
        """The calendar month before ``as_of``.

        The label names the month of fourteen days ago, which is another month than
        the data's from the 15th on; ``corrected`` labels by the data.
        """
        check_semantics(semantics)
        end = as_of.date().replace(day=1)
        start = (end - timedelta(days=1)).replace(day=1)
        named = start if semantics == CORRECTED else as_of - timedelta(days=14)
        return cls(start, end, as_of, named.strftime("%Y-%m"))

    @property
    def last_day(self) -> date:
        return self.end - timedelta(days=1)

    def cutoff(self, semantics: str = REFERENCE) -> date:
        """Midnight that closes the period: the last day's own midnight, or ``end`` if corrected."""
        return self.end if check_semantics(semantics) == CORRECTED else self.last_day

    @property
    def start_ms(self) -> int:
        return _epoch_ms(self.start)

    @property
    def end_ms(self) -> int:
        return _epoch_ms(self.end)


def _epoch_ms(day: date) -> int:
    return int(datetime.combine(day, time(), timezone.utc).timestamp()) * 1000
