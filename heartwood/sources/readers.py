"""Sources: the raw tables as a dict of lazy DataFrames, keyed by table name."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.operators.snapshots import last_two_dates
from heartwood.sources import commits, schemas


# quotes inside a value are doubled and blanks belong to the value, as pandas writes them
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _read_csv(spark: SparkSession, path: str, types: dict[str, str], options: dict):
    """Columns by the names in the header, so in any order; unknown ones are text.

    In a folder of files all headers have to agree. A value that does not fit its type stops
    the read instead of becoming NULL. So does a line break inside a value, unless ``multiLine`` is set (then a file is one split).
    """
    settings = {**CSV_OPTIONS, "mode": "FAILFAST", "enforceSchema": False, **options}
    names = spark.read.options(**settings).csv(path).columns
    schema = ", ".join(f"`{name}` {types.get(name, 'string')}" for name in names)
    return spark.read.schema(schema).options(**settings).csv(path)


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns of the schema in its types, others as they are."""
    return df.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def jdbc_options(name: str, options: dict) -> dict:
    """Reader options for one table: the connection, and a read split by the table's key.

    ``options`` has the connection and ``partitions``: for each table a dict of
    numPartitions, lowerBound and upperBound (and partitionColumn, if not the table's first
    column). The bounds only say how to split; rows outside them are read too. Without an entry
    a whole table would come through one connection, which is an error.
    """
    split = options.get("partitions", {}).get(name)
    needed = {"numPartitions", "lowerBound", "upperBound"}
    if not split or not needed <= set(split):
        raise ValueError(f"jdbc: give {', '.join(sorted(needed))} for {name} in 'partitions'")
    key = next(iter(schemas.RAW_SCHEMAS[name]))
    connection = {k: v for k, v in options.items() if k != "partitions"}
    return {
        "preferTimestampNTZ": True, **connection, "partitionColumn": key, **split, "dbtable": name
    }


def _is_absent(error: Exception) -> bool:
    """Whether a read failed for want of the table; a database says so in its own words."""
    if isinstance(error, AnalysisException):
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return True
    text = str(error).lower()
    return any(t in text for t in ("sqlexception", "psqlexception")) and any(t in text for t in fixed.ABSENT_TABLE_MESSAGES)


def _read(spark: SparkSession, name: str, location: str, fmt: str, options: dict):
    types = schemas.RAW_SCHEMAS[name]
    if fmt == "csv":
        return _read_csv(spark, f"{location}/{name}.csv", types, options)
    if fmt == "table":
        return _typed(spark.table(f"{location}.{name}"), types)
    if fmt == "jdbc":
        settings = jdbc_options(name, options)
        return _typed(spark.read.format("jdbc").options(**settings).load(), types)
    state = commits.manifest(spark, location) if fmt == "parquet" else None
    if state is not None and name in state.tables:
        return commits.read(spark, location, name, schemas.ddl(types), state)
    reader = spark.read.schema(schemas.ddl(types)).format(fmt).options(**options)
    return reader.load(f"{location}/{name}")


def load_tables(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    options: dict | None = None,
    optional: bool = False,
) -> dict[str, DataFrame]:
    """The eight raw tables under ``location``.

    ``fmt`` is a file format (``parquet``, ``csv``, ``orc``, ...; Parquet tables that were
    committed are those of the newest commit), ``table`` for
    catalog tables of the database ``location``, or ``jdbc`` with the connection and each
    table's split in ``options`` (see :func:`jdbc_options`).
    With ``optional`` a table that is absent is left out of the dict.
    """
    tables = {}
    for name in schemas.RAW_SCHEMAS:
        try:
            tables[name] = _read(spark, name, location, fmt, options or {})
        except PySparkException as error:
            if not (optional and _is_absent(error)):
                raise
    return tables


def read_result(
    spark: SparkSession, root: str, name: str, version: int | None = None
) -> DataFrame:
    """One of the result tables under ``root``, as of the newest commit or an earlier one.

    Where nothing was committed, a folder of the table's name is read as it is.
    """
    schema = schemas.ddl(schemas.RESULT_SCHEMAS[name])
    state = commits.manifest(spark, root, version)
    if state is None:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    return commits.read(spark, root, name, schema, state)


def snapshot_days(spark: SparkSession, root: str, name: str = "health_scores") -> list[date]:
    """The days of which a result table has a snapshot, newest first.

    From the ledger of the commits; only where there is none, from the table itself.
    """
    known = commits.days(spark, root, name)
    if known is None:
        newest = last_two_dates(read_result(spark, root, name)).collect()
        known = [row["score_date"] for row in newest]
    return known
