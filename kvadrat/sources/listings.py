"""Listing table source (S1-S5): read, turn missing-value tokens into nulls, type, validate.

Files are read with every column as a string, so a malformed number never fails the scan;
typing is ``try_cast`` and the parse check (S4) and row-count check (S5) are one
aggregate over the same scan. ``_ord`` records the file position of each row
(file, split offset, position inside the split) so "keep first" is the file's first.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.text import strip
from kvadrat.sources import quoted_csv

class ListingsValidationError(ValueError):
    """The listings table does not match the expected shape."""

def na_to_null(c: Column | str, tokens: list[str] | None = None) -> Column:
    """The CSV missing-value tokens become null."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(~x.isin(*(tokens or S.NA_TOKENS)), x)

def position_order() -> Column:
    """File position of a row: (file path, split start, running id inside the task)."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )

def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S1 scan: every column as it is in the file (strings for CSV) plus ``_ord``, the file's rank or
    path, the split and the place in it."""
    try:
        if fmt == "csv":  # in as many tasks as the files have splits, line breaks in quotes or not
            return quoted_csv.read(spark, path)
        df = spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Dataset file does not exist: {path}") from exc
        raise
    return df.withColumn("_ord", position_order())

def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """S3: expected columns absent from the frame, in expected order."""
    return [c for c in (required or S.RAW_COLUMNS) if c not in df.columns]

def numeric_problems(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """S4 + S5 as one aggregate: row count and, per numeric column, the number of values
    that are present, not blank and do not parse as a number."""
    columns = columns or S.NUMERIC_RAW_COLUMNS
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        text = F.col(c).cast("string")
        bare = strip(text)
        bad = text.isNotNull() & (bare != "") & bare.try_cast("double").isNull()
        aggs.append(F.count_if(bad).alias(c))
    return df.agg(*aggs)

def validate(df: DataFrame, min_rows: int = 1000, required: list[str] | None = None) -> dict:
    """Raise ``ListingsValidationError`` on missing columns, too few rows or
    unparseable numbers; otherwise return the shape summary."""
    required = required or S.RAW_COLUMNS
    missing = missing_columns(df, required)
    if missing:
        raise ListingsValidationError(f"Missing required columns: {', '.join(missing)}")
    stats = numeric_problems(df).first()
    if stats["rows"] < min_rows:
        raise ListingsValidationError(f"Dataset must contain at least {min_rows} rows; found {stats['rows']}")
    invalid = [c for c in S.NUMERIC_RAW_COLUMNS if stats[c] > 0]
    if invalid:
        raise ListingsValidationError(f"Numeric columns contain unparseable values: {', '.join(invalid)}")
    return {
        "rows": int(stats["rows"]),
        "columns": len([c for c in df.columns if not c.startswith("_")]),
        "target_column": S.TARGET,
        "expected_columns": list(required),
        "modeling_columns": list(S.MODELING_COLUMNS),
        "numeric_columns": list(S.NUMERIC_RAW_COLUMNS),
    }

def typed(df: DataFrame) -> DataFrame:
    """NA tokens to null on text columns, numbers via ``try_cast`` (NaN to null)."""
    numbers = [c for c in S.RAW_COLUMNS if c in S.NUMERIC_RAW_COLUMNS]
    # one step after the other: what a step names twice is made once
    bare = df.withColumns({c: strip(F.col(c).cast("string")) for c in numbers})
    read = bare.withColumns({c: na_to_null(c).try_cast("double") for c in numbers})
    out = {c: F.when(~F.isnan(c), F.col(c)) if c in numbers else na_to_null(F.col(c).cast("string")) for c in S.RAW_COLUMNS}
    return read.withColumns(out)

def load_listings(
    spark: SparkSession, path: str, fmt: str = "csv", min_rows: int = 1000, validate_data: bool = True
) -> DataFrame:
    """Load, validate (always, unless told not to) and type the listings table."""
    raw = read_raw(spark, path, fmt)
    if validate_data:
        validate(raw, min_rows=min_rows)
    else:
        missing = missing_columns(raw)
        if missing:
            raise ListingsValidationError(f"Missing required columns: {', '.join(missing)}")
    return typed(raw).select(*S.RAW_COLUMNS, "_ord")

