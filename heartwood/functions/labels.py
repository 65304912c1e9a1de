"""Status labels and the texts derived from scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions.numeric import whole_number_text


def classify_status(score: Column) -> Column:
    label = F.lit(fixed.STATUS_OUTSIDE_BANDS)
    for low, high, status in reversed(fixed.STATUS_BANDS):
        label = F.when(score.between(low, high), F.lit(status)).otherwise(label)
    return label


def risk_drivers(score_of: dict[str, Column]) -> Column:
    """The weak components with their scores, joined by ``"; "``.

    ``score_of`` maps the component columns of ``RISK_DRIVER_TEXTS`` to scores.
    """
    parts = [
        F.when(
            score_of[name] < bound,
            F.concat(F.lit(before), whole_number_text(score_of[name]), F.lit(after)),
        )
        for name, bound, before, after in fixed.RISK_DRIVER_TEXTS
    ]
    joined = F.concat_ws("; ", *parts)
    return F.when(joined == "", F.lit(fixed.NO_RISK_DRIVERS)).otherwise(joined)


def _by_status(status: Column, position: int) -> Column:
    return reduce(
        lambda rest, rule: F.when(status == rule[0], F.lit(rule[position])).otherwise(rest),
        reversed(fixed.RISK_ACTIONS),
        F.lit(None),
    )


def renewal_is_near(days_to_renewal: Column) -> Column:
    within = days_to_renewal.between(0, fixed.RENEWAL_WINDOW_DAYS)
    return F.coalesce(within, F.lit(False))


def recommended_action(status: Column, days_to_renewal: Column) -> Column:
    action = _by_status(status, 1)
    before, after = (F.lit(text) for text in fixed.RENEWAL_NOTE)
    note = F.concat(action, before, days_to_renewal.cast("string"), after)
    return F.when(renewal_is_near(days_to_renewal), note).otherwise(action)


def due_in_days(status: Column, days_to_renewal: Column) -> Column:
    days = _by_status(status, 2)
    urgent = F.least(days, F.lit(fixed.RENEWAL_URGENT_DUE_DAYS))
    return F.when(renewal_is_near(days_to_renewal), urgent).otherwise(days)
