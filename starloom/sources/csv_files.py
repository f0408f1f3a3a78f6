"""Review and catalogue files: read every column as text, prune on request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts the source files use for "no value" (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path}: no header line")
    line = first[0][0].lstrip("\ufeff")
    return [name.strip().strip('"') for name in line.split(",")]


def _read_text_columns(spark: SparkSession, pattern: str, header: list[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    # enforceSchema=False makes a file with another header fail instead of
    # being read into the wrong columns.
    return _reader(spark, multi_line).schema(schema).option("enforceSchema", False).csv(pattern)


def _tokens_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in columns})


def _retailer_flag(header: list[str]) -> dict[str, str]:
    return {n: "retailer_exclusive" for n in header if n.endswith("_exclusive")}


def read_catalogue(spark: SparkSession, pattern: str, columns: list[str] | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Catalogue files a glob matches, as text columns; ``columns`` prunes the scan."""
    header = _header(spark, pattern)
    df = _read_text_columns(spark, pattern, header, multi_line).withColumnsRenamed(_retailer_flag(header))
    if columns:
        df = df.select(*columns)
    return _tokens_to_null(df, df.columns)


def read_reviews(spark: SparkSession, pattern: str, columns: list[str] | None = None,
                 multi_line: bool = True, with_path: bool = False) -> DataFrame:
    """All review files a glob matches, as text columns.

    The unnamed first column becomes ``source_row_id`` and every row carries the
    name of its file in ``source_file`` (``with_path`` adds the whole path); they stay when
    ``columns`` prunes. Quoted line breaks are legal in review texts, so by default one file
    is read by one task; ``multi_line=False`` splits files that are known to have none.
    """
    header = _header(spark, pattern)
    df = _read_text_columns(spark, pattern, header, multi_line)
    kept = [n for n in header[1:] if n != "source_file" and (not columns or n in columns)]
    paths = [F.col("_metadata.file_path").alias("source_path")] if with_path else []
    df = df.select(
        F.col(f"`{header[0]}`" if header[0] else "``").alias("source_row_id"),
        *kept,
        F.col("_metadata.file_name").alias("source_file"), *paths,
    )
    return _tokens_to_null(df, ["source_row_id", *kept])


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write a cleaned frame as CSV files with a header, nulls as empty fields.

    ``by`` writes one folder per value of that column, which is then no column of the files.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    (writer.partitionBy(by) if by else writer).csv(path)
