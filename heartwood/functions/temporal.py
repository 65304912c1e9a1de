"""Time expressions. Every rule gets its clock as ``as_of``; none reads the wall clock."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def to_datetime(as_of: datetime | date | str) -> datetime:
    """A datetime without zone, like the stored ones; one with zone is moved to UTC."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if not isinstance(as_of, datetime):
        return datetime(as_of.year, as_of.month, as_of.day)
    return as_of.astimezone(UTC).replace(tzinfo=None) if as_of.tzinfo else as_of


def as_of_moment(as_of: datetime | date | str) -> Column:
    return F.lit(to_datetime(as_of).isoformat(" ")).cast("timestamp_ntz")


def as_of_day(as_of: datetime | date | str) -> Column:
    return F.lit(to_datetime(as_of).date().isoformat()).cast("date")


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days, rounded down: -25 hours are -2 days."""
    return F.floor(elapsed_micros(start, end) / F.lit(float(MICROS_PER_DAY)))


def elapsed_hours_rounded(start: Column, end: Column) -> Column:
    """Hours with one digit, exact, halves away from zero."""
    hours = elapsed_micros(start, end).cast("decimal(20,0)") / F.lit(
        MICROS_PER_HOUR
    ).cast("decimal(10,0)")
    return F.round(hours, 1).cast("double")


def sla_breached(
    created: Column, resolved: Column, sla_hours: Column, as_of: datetime
) -> Column:
    """Past its hours when resolved, or by ``as_of`` if still unresolved.

    An unknown start or limit is no breach. Compared in microseconds, so exact.
    """
    taken = elapsed_micros(created, F.coalesce(resolved, as_of_moment(as_of)))
    limit = sla_hours.cast("bigint") * F.lit(MICROS_PER_HOUR)
    return F.coalesce(taken > limit, F.lit(False))


def next_renewal_date(renewal_date: Column, as_of: datetime) -> Column:
    """The renewal date moved on by whole 365-day cycles until it is not past."""
    cycle = fixed.RENEWAL_CYCLE_DAYS
    overdue = F.datediff(as_of_day(as_of), renewal_date)
    cycles = F.greatest(F.lit(0), F.ceil(overdue / F.lit(float(cycle))).cast("int"))
    # greatest() skips NULL, so an unknown date has to be kept apart
    return F.when(renewal_date.isNotNull(), F.date_add(renewal_date, cycles * cycle))
