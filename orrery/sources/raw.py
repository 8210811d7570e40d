"""Raw CSV scans: all text, no-value tokens nulled, then typed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.text import na_to_null
from orrery.operators.first_rows import ROW_ORDER
from orrery.schemas import AGENCY_RAW, RETAIL_RAW


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise ``FileNotFoundError`` naming the first path that does not exist."""
    for path in paths:
        try:
            spark.read.text(path).schema
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(path) from error


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # Writers that allow gaps in a whole-number column spell 2 as 2.0.
        # A cast that fails costs an exception for the row, so a text with a point is not tried as a whole number.
        number = text.try_cast("decimal(38,6)")
        return F.coalesce(F.when(~text.contains("."), text.try_cast(kind)), F.when(number == F.floor(number), number).try_cast(kind))
    return text.try_cast(kind)


def normalize(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Null the no-value tokens of the layout's columns and give them their types.

    Text that does not fit a numeric column becomes null, so that the cleansing
    rules can account for the row; a whole number may be written ``2.0``.
    """
    return df.withColumns({f.name: _typed(na_to_null(F.col(f.name)), f.dataType) for f in layout.fields})


# The text of a line that has fewer or more fields than the header; null for every other line.
MALFORMED = "_malformed_line"
MALFORMED_REASON = "malformed_line"


def set_apart(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows without the ``MALFORMED`` column, and the malformed ones with it.

    A table that was read without that column has no malformed rows.
    """
    if MALFORMED not in df.columns:
        return df, df.withColumn(MALFORMED, F.lit(None).cast("string")).where("false")
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED), df.where(F.col(MALFORMED).isNotNull())


def read_csv(spark: SparkSession, path: str, layout: T.StructType, keep_malformed: bool = False, **options: str) -> DataFrame:
    """One raw file or folder with header, plus ``_row_order``.

    Columns are bound by their name in the header, in any order; other columns are
    left out, a missing one raises ``ValueError``. All files of a folder must have
    the same header, which Spark checks while it reads them.

    Short lines are filled with nulls and what is too much is left off, unless ``keep_malformed``
    asks for their text in the column ``MALFORMED``. Whole lines must be parsed then, whatever
    columns a query needs.

    Spark tables have no row order; the file, the position of the split in it and
    the running id inside the split restore the order of the rows in the file,
    whatever the split size.
    """
    def reader() -> DataFrameReader:
        return spark.read.option("header", True).option("escape", '"').options(**options)

    header = reader().csv(path).columns
    missing = [name for name in layout.names if name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    found = T.StructType([T.StructField(name, T.StringType()) for name in header])
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    scan, extra = reader().option("enforceSchema", False), []
    if keep_malformed:
        found = found.add(MALFORMED, T.StringType())
        scan = scan.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        # Spark refuses a scan of the line's text alone, so it is tied to the first column, whatever that holds.
        read = F.coalesce(F.octet_length(header[0]), F.lit(0)) >= 0
        extra = [F.when(read, F.col(MALFORMED)).alias(MALFORMED)]
    rows = scan.schema(found).csv(path)
    return normalize(rows.select(*layout.names, *extra, order.alias(ROW_ORDER)), layout)


def _read_all(
    spark: SparkSession, root: str, layouts: Mapping[str, T.StructType], suffix: str, keep_malformed: bool = False
) -> dict[str, DataFrame]:
    paths = {name: f"{root}/{name}{suffix}" for name in layouts}
    require_inputs(spark, paths.values())
    return {name: read_csv(spark, paths[name], layout, keep_malformed) for name, layout in layouts.items()}


def read_retail_raw(
    spark: SparkSession, root: str, suffix: str = "_raw.csv", keep_malformed: bool = False
) -> dict[str, DataFrame]:
    """customers, products, orders, order_items and sessions."""
    return _read_all(spark, root, RETAIL_RAW, suffix, keep_malformed)


def read_agency_raw(spark: SparkSession, root: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """managers, clients, campaigns, ad_performance and client_billing."""
    tables = _read_all(spark, root, AGENCY_RAW, suffix)
    return {name: df.drop(ROW_ORDER) for name, df in tables.items()}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of every table, as one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
