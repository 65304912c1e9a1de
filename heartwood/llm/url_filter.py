"""URL lists in time: each capture is judged by the entries that were active when it was fetched.

Dated additions and removals become validity intervals. A capture looks up its host, the domains
above it, and its path with the directories above that, with and without a final slash; the lookup
is an equi-join on that key, and the as-of condition picks the intervals that hold the fetch day. Ended intervals are cut at the borders of
periods, and the period is part of the join key, so a key that was listed over and over is met only
in the capture's own period. Of intervals without end a list has at most one for a key.

No broadcast is asked for, a host with many captures is split by adaptive execution (the joins are
inner), and matches are summed per capture before they are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: days of a period
PERIOD = 64

HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH = r"^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and trailing dot; empty without a scheme."""
    return F.rtrim(F.regexp_extract(F.lower(F.trim(url)), HOST, 1), F.lit("."))


def path_of(url: Column) -> Column:
    """The path as written, ``/`` if there is none."""
    path = F.regexp_extract(F.trim(url), "(?i)" + PATH, 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def lookup_keys(url: Column) -> Column:
    """Array of (kind, pattern): the host and the domains above it; the host with the whole path,
    and with each directory, with and without its final slash."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.lit("domain").alias("kind"),
            F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"),
        ),
    )
    parts = F.split(path_of(url), "/")
    # the parts before the i-th slash, without and with it; the whole path has no slash behind it
    paths = F.transform(
        F.concat(
            F.transform(
                F.sequence(F.lit(1), F.size(parts)),
                lambda i: F.array_join(F.slice(parts, 1, i), "/"),
            ),
            F.transform(
                F.sequence(F.lit(1), F.size(parts) - 1),
                lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")),
            ),
        ),
        lambda path: F.struct(
            F.lit("url").alias("kind"), F.concat(host_of(url), path).alias("pattern")
        ),
    )
    return F.when(
        F.length(host_of(url)) > 0, F.array_distinct(F.concat(domains, paths))
    )


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Intervals (list, kind, pattern, since, until): active on ``since`` and before ``until``,
    which is null where the entry was not removed.

    ``entries`` has list, kind (domain or url), pattern, action (add or remove) and day. Of
    several actions on one day the removal counts. Rows with a null in any of these columns or
    another action play no role; patterns are compared in lower case for domains.
    """
    columns = ["list", "kind", "pattern"]
    daily = (
        entries.select(*columns, "action", "day")
        .dropna()
        .where(F.col("action").isin("add", "remove"))
        .withColumn(
            "pattern",
            F.when(F.col("kind") == "domain", F.lower("pattern")).otherwise(F.col("pattern")),
        )
        .groupBy(*columns, "day")
        .agg(F.bool_and(F.col("action") == "add").alias("active"))
    )
    order = Window.partitionBy(*columns).orderBy("day")
    changes = daily.withColumn("was", F.lag("active", 1, False).over(order)).where(
        F.col("active") != F.col("was")
    )
    return (
        changes.withColumn("until", F.lead("day").over(order))
        .where("active")
        .select(*columns, F.col("day").alias("since"), "until")
    )


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD).cast("int")


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, fetched_on, n_active, first_pattern, blocked for each row of ``captures``.

    ``captures`` has capture_id, url and fetched_on (a day). n_active counts the entries (list, kind,
    pattern) that match the URL and were active on that day, first_pattern is the smallest
    matching pattern (null: none), blocked says whether there is any. A domain entry matches its
    host and the hosts below it. A url entry is a host with a path, without scheme, query and
    fragment, and matches by whole parts: ``h/a/b.html`` and ``h/a`` match that page and what lies
    below it (``h/a`` also ``h/a/`` and ``h/a/c``, not ``h/ab``), ``h/a/`` what lies in the
    directory, ``h`` every page of the host ``h`` alone. A missing URL, one without
    scheme and host, and a missing day match nothing. Rows with one capture_id are one capture
    if they agree in URL and day, and are all returned. An empty list blocks nothing; an empty
    table of captures gives an empty result. Other columns play no role.
    """
    rows = captures.select("capture_id", "fetched_on", F.coalesce("url", F.lit("")).alias("url"))
    keys = (
        rows.where("fetched_on is not null")
        .select("capture_id", "fetched_on", "url", F.explode(lookup_keys(F.col("url"))).alias("k"))
        .select("capture_id", "fetched_on", "url", "k.*")
    )
    intervals = validity_intervals(entries)
    ended = intervals.where("until is not null").withColumn(
        "period",
        F.explode(F.sequence(_period(F.col("since")), _period(F.date_sub("until", 1)))),
    )
    on = ["kind", "pattern"]
    past = keys.withColumn("period", _period(F.col("fetched_on"))).join(ended, [*on, "period"])
    now = keys.join(intervals.where("until is null"), on)
    hit = ["capture_id", "fetched_on", "url", "list", "kind", "pattern"]
    matches = (
        past.where("since <= fetched_on and fetched_on < until")
        .select(*hit)
        .union(now.where("since <= fetched_on").select(*hit))
        .distinct()
        .groupBy("capture_id", "fetched_on", "url")
        .agg(F.count("*").alias("n_active"), F.min("pattern").alias("first_pattern"))
    )
    same = (
        F.col("r.capture_id").eqNullSafe(F.col("m.capture_id"))
        & (F.col("r.url") == F.col("m.url"))
        & (F.col("r.fetched_on") == F.col("m.fetched_on"))
    )
    return (
        rows.alias("r")
        .join(matches.alias("m"), same, "left")
        .select(
            "r.capture_id",
            "r.fetched_on",
            F.coalesce("n_active", F.lit(0)).alias("n_active"),
            "first_pattern",
            (F.coalesce("n_active", F.lit(0)) > 0).alias("blocked"),
        )
    )
