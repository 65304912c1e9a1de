"""Engagement: late against early usage of each account.

The score compares an account's first and last quarter of usage rows, ordered by date.
Ranking rows in a window per account would put all rows of an account into one task.
Instead rows are first summed per account and day (map-side combine, and spread by day), and
an account's days become one array, of which there are only as many as calendar days (times
the sets of missing metrics). The days on which its quarters end are found in that array.
Where a quarter ends between rows of one day, the usage ids of just these days decide. They are
placed by their leading bits, then the next ones, then the rest, so that no group ordered in one
task has more than 2^22 members, however many rows a day has.
A row's index is linear in its metrics, so sums over rows are all it takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import clip_score, np_round

_METRICS = [name for name, _ in fixed.USAGE_WEIGHTS]
_LAST_DAY = 2**31 - 1
_LAST_ID = 2**63 - 1
_ID_PREFIXES = {"id_top": 42, "id_middle": 21}  # column, bits shifted out


def _usage_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Row counts and metric sums per key and set of missing metrics."""
    return rows.groupBy(*keys, "missing").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(name).alias(name) for name in _METRICS],
    )


def _index() -> Column:
    """Index sum of the rows of one sum: metrics against the account's means, weighted."""
    return sum(
        (
            weight
            * F.when(F.col(f"{name}_mean") == 0, F.col("rows").cast("double")).otherwise(
                F.try_divide(F.col(name).cast("double"), F.col(f"{name}_mean"))
            )
            for name, weight in fixed.USAGE_WEIGHTS
        ),
        F.lit(0.0),
    )


def _end_day(days: Column, wanted: Column) -> Column:
    """The day in which the ``wanted``-th row of an array of sums lies, counted from its start."""
    start = F.struct(F.lit(0).cast("bigint").alias("rows"), F.lit(None).cast("int").alias("day"))

    def count(so_far: Column, sums: Column) -> Column:
        rows = so_far["rows"] + sums["rows"]
        reached = so_far["day"].isNull() & (rows >= wanted)
        return F.struct(rows.alias("rows"), F.when(reached, sums["day"]).otherwise(so_far["day"]).alias("day"))

    return F.aggregate(days, start, count, lambda end: end["day"])


def _account_states(sums: DataFrame) -> DataFrame:
    """One row per account: what its days give to both quarters, and the days that are cut.

    ``cuts`` has at most two days, with their rows and how many of them the quarters want;
    all other days count in whole or not at all.
    """
    means = {}
    for bit, name in enumerate(_METRICS):
        present = F.when(F.col("missing").bitwiseAND(1 << bit) == 0, F.col("rows"))
        means[f"{name}_mean"] = F.try_divide(F.sum(name).cast("double"), F.sum(present))
    state = sums.groupBy("account_id").agg(
        F.sort_array(F.collect_list(F.struct("day", "missing", "rows", *_METRICS))).alias("days"),
        F.sum("rows").alias("account_rows"),
        *[mean.alias(name) for name, mean in means.items()],
    )
    state = state.withColumn(
        "wanted", F.greatest(F.lit(1), F.floor(F.col("account_rows") / 4)).cast("bigint")
    )
    state = state.withColumns(
        {
            "early_day": _end_day(F.col("days"), F.col("wanted")),
            "late_day": _end_day(F.reverse("days"), F.col("wanted")),
        }
    )
    account = ["account_rows", "wanted", "early_day", "late_day", *means]
    days = state.select("account_id", *account, F.inline("days")).withColumn("index", _index())
    counted = F.when(F.col("index").isNotNull(), F.col("rows"))
    inside = {
        "early": F.col("day") < F.col("early_day"),
        "late": F.col("day") > F.col("late_day"),
    }
    totals = []
    for end, within in inside.items():
        last = F.col("day") == F.col(f"{end}_day")
        for place, condition in (("inside", within), ("last", last)):
            totals += [
                F.sum(F.when(condition, F.col("rows"))).alias(f"{end}_{place}"),
                F.sum(F.when(condition, F.col("index"))).alias(f"{end}_{place}_index"),
                F.sum(F.when(condition, counted)).alias(f"{end}_{place}_rows"),
            ]
    states = days.groupBy("account_id").agg(*[F.first(c).alias(c) for c in account], *totals)
    left, cut = {}, {}
    for end in inside:
        left[end] = F.col("wanted") - F.coalesce(F.col(f"{end}_inside"), F.lit(0))
        cut[end] = left[end] < F.col(f"{end}_last")

    def give(end: str, kind: str) -> Column:
        whole = F.when(~cut[end], F.col(f"{end}_last_{kind}"))
        parts = (F.col(f"{end}_inside_{kind}"), whole)
        return sum((F.coalesce(part.cast("double"), F.lit(0.0)) for part in parts), F.lit(0.0))

    def cut_day(end: str) -> Column:
        """The day on which a quarter ends, and what both quarters want of it."""
        day = F.col(f"{end}_day")
        wants = [
            F.when(cut[e] & (F.col(f"{e}_day") == day), left[e]).otherwise(F.lit(0))
            .cast("bigint").alias(f"want_{e}")
            for e in inside
        ]
        return F.struct(day.alias("day"), F.col(f"{end}_last").alias("split_rows"), *wants)

    cuts = F.array_distinct(F.array_compact(F.array(*[F.when(cut[e], cut_day(e)) for e in inside])))
    return states.select(
        "account_id",
        "account_rows",
        *means,
        *[give(end, kind).alias(f"{end}_{kind}") for kind in ("index", "rows") for end in inside],
        cuts.alias("cuts"),
    )


def _cut_totals(rows: DataFrame, cuts: DataFrame, *orders: str) -> DataFrame:
    """What the rows of cut days give to both quarters, in the order of their usage ids.

    ``orders`` lead from the first bits of an id to the id. Values of each are placed among
    those that agree in the bits before, from where these begin. Rows that agree even in
    their id count in part.
    """
    keys = ["account_id", "day"]
    # moved before the joins, so that adaptive execution knows how few days there are, if any
    begins = cuts.withColumn("offset", F.lit(0).cast("bigint")).repartition(*keys)
    carried = [name for name in cuts.columns if name not in keys]
    for order in orders:
        # one row of ``begins`` for each group of rows, so its columns ride along
        here = rows.join(begins, keys)
        taken = [F.first(name).alias(name) for name in (*carried, "offset")]
        last = order == orders[-1]
        counts = [F.count(F.lit(1)).alias("rows")]
        counts += [F.sum(name).alias(name) for name in _METRICS] if last else []
        counted = here.groupBy(*keys, order, *(["missing"] if last else [])).agg(*counts, *taken)
        upto = W.partitionBy(*keys).orderBy(order)
        total = F.sum("rows")
        placed = counted.select(
            "*",
            total.over(upto.rangeBetween(W.unboundedPreceding, -1)).alias("before"),
            total.over(upto.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("through"),
        ).withColumns(
            {
                "before": F.coalesce("before", F.lit(0)) + F.col("offset"),
                "through": F.col("through") + F.col("offset"),
            }
        )
        keys = [*keys, order]
        begins = placed.select(*keys, *carried, F.col("before").alias("offset"))
    size = F.col("through") - F.col("before")
    taken = {
        "early": F.col("want_early") - F.col("before"),
        "late": F.col("want_late") - (F.col("split_rows") - F.col("through")),
    }
    share = {end: F.least(size, F.greatest(F.lit(0), n)) / size for end, n in taken.items()}
    placed = placed.withColumns({"index": _index(), **{f"{e}_share": x for e, x in share.items()}})
    counted = F.when(F.col("index").isNotNull(), F.col("rows"))
    return placed.groupBy("account_id").agg(
        *[F.sum(F.col("index") * F.col(f"{end}_share")).alias(f"part_{end}_index") for end in share],
        *[F.sum(counted * F.col(f"{end}_share")).alias(f"part_{end}_rows") for end in share],
    )


def score_engagement(usage: DataFrame) -> DataFrame:
    """Late against early usage of each account; 60 where it has fewer than four rows."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(1 << bit)).otherwise(F.lit(0))
        for bit, name in enumerate(_METRICS)
    ]
    usage_id = F.coalesce(F.col("usage_id").cast("bigint"), F.lit(_LAST_ID))
    rows = usage.filter(F.col("account_id").isNotNull()).select(
        "account_id",
        F.coalesce(F.unix_date("usage_date"), F.lit(_LAST_DAY)).alias("day"),
        usage_id.alias("usage_id"),
        *[F.shiftright(usage_id, bits).alias(name) for name, bits in _ID_PREFIXES.items()],
        *_METRICS,
        sum(missing, F.lit(0)).alias("missing"),
    )
    states = _account_states(_usage_sums(rows, "account_id", "day"))
    cuts = states.select(
        "account_id", *[f"{name}_mean" for name in _METRICS], F.inline("cuts")
    )
    parts = _cut_totals(rows, cuts, *_ID_PREFIXES, "usage_id")
    ends = ["early_index", "late_index", "early_rows", "late_rows"]
    totals = states.join(parts, "account_id", "left").select(
        "account_id",
        "account_rows",
        *[(F.col(end) + F.coalesce(F.col(f"part_{end}"), F.lit(0.0))).alias(end) for end in ends],
    )

    early = F.try_divide(F.col("early_index"), F.col("early_rows"))
    late = F.try_divide(F.col("late_index"), F.col("late_rows"))
    change = F.when(early == 0, F.lit(0.0)).otherwise(
        F.try_divide(late - early, early + F.lit(fixed.ENGAGEMENT_EPSILON))
    )
    score = F.lit(fixed.ENGAGEMENT_MIDPOINT) + change * F.lit(fixed.ENGAGEMENT_SLOPE)
    return totals.select(
        "account_id",
        F.when(
            F.col("account_rows") < fixed.ENGAGEMENT_MIN_ROWS,
            F.lit(fixed.ENGAGEMENT_SHORT_HISTORY),
        )
        .otherwise(np_round(clip_score(score), 2))
        .alias("engagement_score"),
    )
