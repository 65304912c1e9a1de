"""SQL with bound parameters as a source, and result tables of a catalog with their defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.sources import schemas

#: what a column of a result table holds when a row is inserted without it
DEFAULTS = {
    "action_center": {"status": "'Open'", "created_at": "localtimestamp()"},
}

_NAMES = "SELECT account_id, company_name FROM {accounts} WHERE array_contains(:ids, account_id)"


def _literal(value: object) -> Column:
    """An element of an array: all must have one type, so whole numbers are always wide."""
    whole = isinstance(value, int) and not isinstance(value, bool)
    return F.expr(f"{value:d}L") if whole else F.lit(value)


def read_sql(
    spark: SparkSession,
    text: str,
    parameters: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """The rows of a SQL query over catalog tables, views and the frames given by name.

    ``:name`` in the text is bound to a parameter: a number, text, date, or a list of them,
    which is an array. Values never become part of the text. ``{name}`` stands for a frame.
    """
    bound = {
        name: F.array(*map(_literal, value)) if isinstance(value, list) else value
        for name, value in (parameters or {}).items()
    }
    return spark.sql(text, args=bound, **tables)


def names_of(accounts: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Names of the accounts among ``ids``, a list bound as one array; unknown ids give no row.

    For the ids a caller holds. Ids that are rows of a table are joined
    (``snapshots.account_names``).
    """
    if not ids:  # an array of nothing has no type
        return accounts.select("account_id", "company_name").limit(0)
    return read_sql(accounts.sparkSession, _NAMES, {"ids": list(ids)}, accounts=accounts)


def create_result_tables(spark: SparkSession, database: str) -> None:
    """Tables of a catalog for the results, with column defaults; those that exist are kept.

    An ``INSERT`` that names only some columns gets the defaults for the others.
    """
    for name, schema in schemas.RESULT_SCHEMAS.items():
        defaults = DEFAULTS.get(name, {})
        columns = ", ".join(
            f"{column} {kind}" + (f" DEFAULT {defaults[column]}" if column in defaults else "")
            for column, kind in schema.items()
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
