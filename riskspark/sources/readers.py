"""Reading the four source tables and the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalars import count_where
from riskspark.schemas import PRIMARY_KEYS, SOURCE_FILES, STAGING


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in STAGING[table]])


#: The raw text of a record that does not fit the header.
UNREADABLE = "_unreadable"


def _quotes_over_lines(spark: SparkSession, path: str) -> bool:
    """Whether quoted fields hold line breaks: a parallel count of lines with an odd number of quotes.

    Such lines come in pairs, one that opens a field and one that closes it. An odd number of
    them means a quote that is never closed; the file is then read line by line, so that the
    quote spoils no record but its own.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = spark.read.text(path).agg(count_where(quotes % 2 == 1)).first()[0]
    return odd > 0 and odd % 2 == 0


def line_breaks(spark: SparkSession, folder: str) -> dict[str, bool]:
    """For each CSV source whether it has quoted line breaks; for ``multi_line``, where a folder is read twice."""
    return {table: _quotes_over_lines(spark, f"{folder}/{name}") for table, name in SOURCE_FILES.items()}


def _records(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame:
    """All records of a CSV source as text, by the names in the header, with the raw text of those that do not fit it."""
    multi_line = _quotes_over_lines(spark, path) if multi_line is None else multi_line
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names = [c.strip() for c in reader.csv(path).columns]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, UNREADABLE)])
    # Without pruning every record is parsed whole, whatever is asked of it, so that its fields are counted.
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("columnPruning", False)
        .csv(path)
    )


def _of(multi_line: bool | dict[str, bool] | None, table: str) -> bool | None:
    return multi_line.get(table) if isinstance(multi_line, dict) else multi_line


def read_sources(
    spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool | dict[str, bool] | None = None
) -> dict[str, DataFrame]:
    """The four raw tables of a folder, by table name.

    CSV columns come back as text, so that a bad value can be counted instead of
    being lost while parsing. They are found by the names in the header, in any order;
    further columns are ignored and a missing one is refused. Records with more or fewer
    fields than the header are left out here; ``read_unreadable`` has them. Quoted line breaks
    belong to their record; a file that has some is read by one task. ``multi_line`` says
    whether there are any, for all files or by table (``line_breaks``), otherwise a count of the quotes does.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported source format: {fmt}")
    tables = {}
    for table, file_name in SOURCE_FILES.items():
        if fmt == "csv":
            found = _records(spark, f"{folder}/{file_name}", _of(multi_line, table))
            wanted = text_schema(table).names
            if missing := sorted(set(wanted) - set(found.columns)):
                raise ValueError(f"{file_name} lacks the columns {missing}")
            # Spark refuses to read a source for this column alone, as counting rows would: the
            # second condition, which always holds, asks for one more.
            read = F.col(UNREADABLE).isNull() & (F.coalesce(F.length(PRIMARY_KEYS[table]), F.lit(0)) >= 0)
            tables[table] = found.where(read).select(*wanted)
        else:
            tables[table] = spark.read.parquet(f"{folder}/{table}.parquet")
    return tables


def read_unreadable(spark: SparkSession, folder: str, multi_line: bool | dict[str, bool] | None = None) -> DataFrame:
    """The records of the CSV sources that do not fit their header, as quarantine rows.

    ``row`` is the raw text, ``key`` the id as far as it could be read.
    """
    parts = []
    for table, file_name in SOURCE_FILES.items():
        found = _records(spark, f"{folder}/{file_name}", _of(multi_line, table)).where(F.col(UNREADABLE).isNotNull())
        key = F.trim(F.col(PRIMARY_KEYS[table])).try_cast("bigint").alias("key")
        parts.append(found.select(F.lit(table).alias("table_name"), key, F.lit("unreadable_record").alias("reason"), F.col(UNREADABLE).alias("row")))
    return reduce(DataFrame.unionByName, parts)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
