"""The digest document as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import whole_number_text


def _text(value: Column) -> Column:
    """A missing value prints as None."""
    return F.coalesce(value.cast("string"), F.lit(fixed.DIGEST_MISSING))


def _bold_name(listed: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adds ``name``: the company, or ``Account <id>`` for an unknown account."""
    names = accounts.select("account_id", _text(F.col("company_name")).alias("_name"))
    fallback = F.concat(F.lit(fixed.DIGEST_UNKNOWN_ACCOUNT), F.col("account_id").cast("string"))
    named = listed.join(names, "account_id", "left")
    before, after = (F.lit(text) for text in fixed.DIGEST_NAME_TEXTS)
    return named.withColumn("name", F.concat(before, F.coalesce("_name", fallback), after))


def _fixed_lines(summary: DataFrame, lines: dict[int, Column]) -> DataFrame:
    """Lines of the one-row ``summary`` by block."""
    rows = [
        F.struct(
            F.lit(block).alias("block"),
            F.lit(0.0).alias("sort_value"),
            F.lit(0).cast("bigint").alias("account_id"),
            line.alias("line"),
        )
        for block, line in lines.items()
    ]
    return summary.select(F.inline(F.array(*rows)))


def _listing(items: DataFrame, block: int, sort_value: Column, line: Column) -> DataFrame:
    """One line per item."""
    return items.select(
        F.lit(block).alias("block"),
        sort_value.cast("double").alias("sort_value"),
        "account_id",
        line.alias("line"),
    )


def _none_lines(lists: DataFrame, texts: dict[int, str]) -> DataFrame:
    """The text of each block in ``texts`` that has no line in ``lists``."""
    one = lists.sparkSession.range(1)
    present = lists.select("block").distinct()
    lines = _fixed_lines(one, {block: F.lit(text) for block, text in texts.items()})
    return lines.join(present, "block", "left_anti")


def digest_lines(
    summary: DataFrame,
    newly_critical: DataFrame,
    score_drops: DataFrame,
    urgent_actions: DataFrame,
    accounts: DataFrame,
    current_date: Column,
    previous_date: Column,
) -> DataFrame:
    """The document: ordered by block, sort_value and account_id, ``line`` is its text.

    The lists come in any order, nothing below sorts. ``summary`` is the one-row run summary; the dates are literals or scalars, the
    previous one NULL on a first run.
    """

    def both(*parts) -> Column:
        texts = [F.lit(p) if isinstance(p, str) else _text(p) for p in parts]
        return F.concat(*texts)

    blank = F.lit("")
    compared = F.coalesce(previous_date.cast("string"), F.lit(fixed.DIGEST_FIRST_RUN))
    head = [
        both(fixed.DIGEST_TITLE, current_date),
        blank,
        both(fixed.DIGEST_COMPARED, compared),
        blank,
        F.lit(fixed.DIGEST_SUMMARY_HEADING),
        *[
            both(*[F.col(p) if k % 2 else p for k, p in enumerate(parts)], end)
            for parts, end in fixed.DIGEST_SUMMARY_LINES
        ],
        blank,
        F.lit(fixed.DIGEST_NEW_CRITICAL_HEADING),
    ]
    first_list = len(head)
    second_list = first_list + 3
    third_list = second_list + 3

    score = whole_number_text(F.col("overall_score"))
    name, before = F.col("name"), whole_number_text(F.col("overall_score_previous"))
    texts = fixed.DIGEST_CRITICAL_TEXTS
    critical_line = both(name, texts[0], score, texts[1], F.col("risk_drivers"))
    texts = fixed.DIGEST_DROP_TEXTS
    drop = whole_number_text(F.col("drop"))
    drop_line = both(name, texts[0], before, texts[1], score, texts[2], drop, texts[3])
    shown = ("company_name", "risk_level", "recommended_action", "owner", "due_date")
    urgent_line = both(
        *[p for text, c in zip(fixed.DIGEST_URGENT_TEXTS, shown) for p in (text, F.col(c))]
    )
    lists = [
        _listing(_bold_name(newly_critical, accounts), first_list, F.lit(0), critical_line),
        _listing(_bold_name(score_drops, accounts), second_list, -F.col("drop"), drop_line),
        _listing(urgent_actions, third_list, F.unix_date("due_date"), urgent_line),
    ]
    listed = reduce(DataFrame.unionByName, lists)
    none = {
        first_list: fixed.DIGEST_NEW_CRITICAL_NONE,
        second_list: fixed.DIGEST_NONE,
        third_list: fixed.DIGEST_NONE,
    }
    fixed_lines = dict(enumerate(head)) | {
        first_list + 1: blank,
        first_list + 2: F.lit(fixed.DIGEST_DROPS_HEADING),
        second_list + 1: blank,
        second_list + 2: F.lit(fixed.DIGEST_URGENT_HEADING),
        third_list + 1: blank,
    }
    parts = [listed, _none_lines(listed, none), _fixed_lines(summary, fixed_lines)]
    return reduce(DataFrame.unionByName, parts)
