"""Data-quality checks, the issue report and the quality score.

Checks come as rows (table, check, severity, record_count, detail). All orphan checks against
one parent share one shuffle on the key, after counting per key, and the row checks of the child
tables are counted along; duplicates are counted per key too. So no check moves rows before they
are aggregated, and a key that owns much of a table is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import count_where, py_round

CRITICAL, WARNING, SIZE = "critical", "warning", "size"
Rule = tuple[str, str, tuple]
Numbered = tuple[int, Rule]


def _check_name(kind: str, args: tuple) -> str:
    return fixed.QUALITY_TEXTS[kind][1].format(*args)


def _severity(kind: str) -> str:
    return fixed.QUALITY_TEXTS[kind][0]


def _detail(table: str, kind: str, args: tuple) -> str:
    """The text that follows the count."""
    return fixed.QUALITY_TEXTS[kind][2].format(*args, table=table)


def _row_predicate(kind: str, args: tuple) -> Column:
    if kind == "missing":
        return F.col(args[0]).isNull()
    if kind == "order":
        return F.col(args[1]) < F.col(args[0])
    if kind == "range":
        return (F.col(args[0]) < args[1]) | (F.col(args[0]) > args[2])
    if kind == "status":
        return (F.col(args[0]) == args[2]) & F.col(args[1]).isNull()
    return F.lit(True)


def _as_check_rows(counts: DataFrame, rules: Sequence[Numbered]) -> DataFrame:
    """One row per rule from a one-row frame with a column ``c<number>`` for each."""
    rows = []
    for number, (table, kind, args) in rules:
        count = F.coalesce(F.col(f"c{number}"), F.lit(0)).cast("bigint")
        rows.append(
            F.struct(
                F.lit(number).alias("rule"),
                F.lit(table).alias("table"),
                F.lit(_check_name(kind, args)).alias("check"),
                F.lit(_severity(kind)).alias("severity"),
                count.alias("record_count"),
                F.concat(count.cast("string"), F.lit(_detail(table, kind, args))).alias("detail"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def _row_counts(rules: Sequence[Numbered]) -> list[Column]:
    return [
        count_where(_row_predicate(kind, args)).alias(f"c{number}")
        for number, (_, kind, args) in rules
    ]


def _row_checks(df: DataFrame, rules: Sequence[Numbered]) -> DataFrame:
    return _as_check_rows(df.agg(*_row_counts(rules)), rules)


def _duplicate_check(df: DataFrame, rule: Numbered, row_rules: Sequence[Numbered]) -> DataFrame:
    """Rows beyond the first of each key; NULL keys duplicate each other.

    ``row_rules`` of the table are counted on the way.
    """
    number, (_, _, (key,)) = rule
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *_row_counts(row_rules))
    totals = per_key.agg(
        F.sum(F.col("rows") - 1).alias(f"c{number}"),
        *[F.sum(f"c{n}").alias(f"c{n}") for n, _ in row_rules],
    )
    return _as_check_rows(totals, [rule, *row_rules])


def _orphan_checks(
    tables: Mapping[str, DataFrame],
    rules: Sequence[Numbered],
    row_rules: Mapping[str, Sequence[Numbered]],
) -> DataFrame:
    """Child rows whose key no parent row has; a NULL key matches a NULL parent key.

    All rules given refer to one parent table and key. The ``row_rules`` of the children are
    counted on the way, so a child is read once.
    """
    _, (_, _, (_, parent_table, parent_key)) = rules[0]
    left = dict(row_rules)
    counted = [*rules, *[entry for own in row_rules.values() for entry in own]]
    children = []
    for number, (table, _, args) in rules:
        here = {number: F.lit(True)}
        here.update({n: _row_predicate(kind, a) for n, (_, kind, a) in left.pop(table, ())})
        children.append(
            tables[table].select(
                F.col(args[0]).alias("reference"),
                *[F.coalesce(here.get(n, F.lit(False)), F.lit(False)).alias(f"c{n}")
                  for n, _ in counted],
            )
        )
    per_key = (
        reduce(DataFrame.unionByName, children)
        .groupBy("reference")
        .agg(*[count_where(F.col(f"c{n}")).alias(f"c{n}") for n, _ in counted])
    )
    present = tables[parent_table].select(F.col(parent_key).alias("key")).distinct()
    present = present.withColumn("present", F.lit(True))
    orphan = {n for n, _ in rules}
    lost = F.col("present").isNull()
    totals = per_key.join(present, F.col("reference").eqNullSafe(F.col("key")), "left").agg(
        *[
            F.sum(F.when(lost, F.col(f"c{n}")) if n in orphan else F.col(f"c{n}")).alias(f"c{n}")
            for n, _ in counted
        ]
    )
    return _as_check_rows(totals, counted)


def _applies(tables: Mapping[str, DataFrame], rule: Rule) -> bool:
    """Rules on absent tables are skipped, as are row rules on absent columns.

    A status rule and the key rules need their columns, so they are not skipped.
    """
    table, kind, args = rule
    if table not in tables:
        return False
    needed = {"missing": args[:1], "order": args[:2], "range": args[:1]}.get(kind, ())
    return all(column in tables[table].columns for column in needed)


def run_checks(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule] = fixed.QUALITY_RULES
) -> DataFrame:
    """The count of every applicable rule, zero counts included."""
    numbered = [(n, rule) for n, rule in enumerate(rules) if _applies(tables, rule)]
    row: dict[str, list[Numbered]] = {}
    duplicate: list[Numbered] = []
    orphan: dict[tuple, list[Numbered]] = {}
    for entry in numbered:
        table, kind, args = entry[1]
        if kind == "duplicate":
            duplicate.append(entry)
        elif kind == "orphan":
            orphan.setdefault(args[1:], []).append(entry)
        else:
            row.setdefault(table, []).append(entry)

    # row rules ride on a scan that their table needs anyway, one of their foreign key if any
    parts = []
    for rules in orphan.values():
        own = {t: row.pop(t) for t in dict.fromkeys(r[0] for _, r in rules) if t in row}
        parts.append(_orphan_checks(tables, rules, own))
    for entry in duplicate:
        table = entry[1][0]
        parts.append(_duplicate_check(tables[table], entry, row.pop(table, [])))
    for table, rules in row.items():
        parts.append(_row_checks(tables[table], rules))
    return reduce(DataFrame.unionByName, parts)


def rules_of(*kinds: str) -> list[Rule]:
    return [rule for rule in fixed.QUALITY_RULES if rule[1] in kinds]


# --- single checks ----------------------------------------------------------


def check_missing_required_fields(
    df: DataFrame, table: str, required: Sequence[str]
) -> DataFrame:
    return run_checks({table: df}, [(table, "missing", (column,)) for column in required])


def check_duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    return run_checks({table: df}, [(table, "duplicate", (key,))])


def check_orphan_records(
    child: DataFrame, child_table: str, fk: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    tables = {child_table: child, "parent of " + child_table: parent}
    rule = (child_table, "orphan", (fk, "parent of " + child_table, parent_key))
    return run_checks(tables, [rule])


def check_date_logic(df: DataFrame, table: str, start: str, end: str) -> DataFrame:
    return run_checks({table: df}, [(table, "order", (start, end))])


def check_value_range(df: DataFrame, table: str, column: str, low, high) -> DataFrame:
    return run_checks({table: df}, [(table, "range", (column, low, high))])


def check_status_consistency(
    df: DataFrame, table: str, status: str, date: str, status_requiring_date: str
) -> DataFrame:
    return run_checks({table: df}, [(table, "status", (status, date, status_requiring_date))])


# --- report -----------------------------------------------------------------


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of the catalogue, plus one ``size`` row per table."""
    sizes = [(table, "size", ()) for table in tables]
    return run_checks(tables, [*fixed.QUALITY_RULES, *sizes])


def quality_issues(report: DataFrame) -> DataFrame:
    """The checks that found something, in rule order."""
    found = (F.col("record_count") > 0) & (F.col("severity") != SIZE)
    return report.filter(found).orderBy("rule").drop("rule")


def quality_score(report: DataFrame) -> DataFrame:
    """One row: records checked, critical and warning records, and the score.

    100 less the share of issue records in percent, critical ones counted twice;
    not below 0, and 100 without records.
    """

    def records(severity: str) -> Column:
        hits = F.sum(F.when(F.col("severity") == severity, F.col("record_count")))
        return F.coalesce(hits, F.lit(0))

    summed = report.agg(
        records(SIZE).alias("total_records_checked"),
        records(CRITICAL).alias("critical_issue_records"),
        records(WARNING).alias("warning_issue_records"),
    )
    weighted = (
        F.col("critical_issue_records") * fixed.CRITICAL_ISSUE_PENALTY
        + F.col("warning_issue_records") * fixed.WARNING_ISSUE_PENALTY
    )
    penalty = F.try_divide(weighted, F.col("total_records_checked")) * 100
    score = py_round(F.greatest(F.lit(0.0), F.lit(100.0) - penalty), 2)
    no_records = F.col("total_records_checked") == 0
    return summed.withColumn(
        "data_quality_score", F.when(no_records, F.lit(100.0)).otherwise(score)
    )
