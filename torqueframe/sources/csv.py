"""CSV sources of the original extracts (A1–A4, A6) with declared schemas.

Dates are read as strings and parsed with ``try_to_timestamp`` so a bad value
becomes null instead of failing the job (the original's ``parse_dates``
leaves unparseable values as text). Keys are strings, keeping leading zeros.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import months_to_years
from ..operators.clean import lower_column_names, rename
from ..operators.ordered import sorted_positions


def _parse_ts(c: str, fmt: str | None) -> Column:
    if fmt:
        return F.to_timestamp_ntz(F.try_to_timestamp(F.col(c), F.lit(fmt)))
    return F.to_timestamp_ntz(F.try_to_timestamp(F.col(c)))


def _decimal(c: str, thousands: str | None = None) -> Column:
    num = F.replace(F.col(c), F.lit(thousands), F.lit("")) if thousands else F.col(c)
    return F.replace(num, F.lit(","), F.lit(".")).try_cast("double")


def unparsable_counts(raw: DataFrame, cols: Sequence[str], thousands: str | None = None) -> DataFrame:
    """One row: per decimal column, how many non-null texts are no number."""
    return raw.agg(*[F.count_if(F.col(c).isNotNull() & _decimal(c, thousands).isNull()).alias(c) for c in cols])


def read_delimited(spark: SparkSession, path, sep: str = ";", header: bool = True, encoding: str = "UTF-8",
                   columns: Sequence[str] | None = None, date_cols: Sequence[str] = (),
                   date_format: str | None = None, decimal_comma_cols: Sequence[str] = (),
                   types: Mapping[str, str] | None = None, thousands: str | None = None) -> DataFrame:
    """Read a delimited text file with every column as string, then type it.

    ``columns`` names the fields of a headerless file (positional names);
    ``decimal_comma_cols`` are numbers written with a decimal comma (a decimal
    point is read too); ``thousands`` is a separator to strip from them first.
    What is no number becomes null (``unparsable_counts`` tells how often)."""
    reader = spark.read.option("sep", sep).option("header", header).option("encoding", encoding) \
                       .option("inferSchema", False).option("mode", "PERMISSIVE")
    df = reader.csv(path)
    if columns:
        df = df.toDF(*columns)
    out = []
    types = dict(types or {})
    for c in df.columns:
        if c in date_cols:
            out.append(_parse_ts(c, date_format).alias(c))
        elif c in decimal_comma_cols:
            out.append(_decimal(c, thousands).alias(c))
        elif c in types:
            out.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


VISIT_DATES = ["Vehicle_In_Date", "Registration_Date_PSE", "Registration_Date_VHE"]


def read_visits(spark: SparkSession, paths, date_format: str | None = None) -> DataFrame:
    """Visit extracts (A1): ';'-separated UTF-8, string keys, three dates,
    names lower-cased, ``(no column name)`` → ``total``. The original uses
    file order as time order; ``source_file`` and ``source_row`` (the row's place
    in the files by name, from 0) make that order explicit columns. They hang on
    file, place in the file and nothing else: other splits give the same rows."""
    df = read_delimited(spark, paths, ";", True, "UTF-8", date_cols=VISIT_DATES, date_format=date_format,
                        types={"NLR_Code": "bigint", "Kms": "bigint", "SLR_Document_Account": "bigint"})
    df = df.withColumns({"source_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
                         "_at": F.monotonically_increasing_id()})  # rises within a block
    df = sorted_positions(df, [F.asc("source_file"), F.asc("_block"), F.asc("_at")], position="source_row").withColumn(
        "source_row", F.col("source_row") - 1).drop("_block", "_at")
    df = lower_column_names(df)
    if "(no column name)" in df.columns:
        df = rename(df, {"(no column name)": "total"}).withColumn("total", F.replace(F.col("total"), F.lit(","), F.lit(".")).try_cast("double"))
    return df


def read_contracts_ca(spark: SparkSession, path, date_format: str | None = None) -> DataFrame:
    """Plate contracts (A2): 6 columns kept and renamed."""
    df = read_delimited(spark, path, ";", True, date_cols=["DATA_INICIO", "DATA_FIM", "DATA_REMOCAO"],
                        date_format=date_format, types={"ANOS": "double", "KILOMETROS": "double"})
    # the franchise text (VIA_MAR_DES) is not kept
    df = df.select("MATRICULA", "ANOS", "KILOMETROS", "DATA_INICIO", "DATA_FIM", "DATA_REMOCAO")
    return rename(df, {"MATRICULA": "registration_number", "ANOS": "cm_years", "KILOMETROS": "cm_km",
                       "DATA_INICIO": "cm_date_start", "DATA_FIM": "cm_date_end",
                       "DATA_REMOCAO": "cm_date_removal"})


def read_contracts_crp(spark: SparkSession, path) -> DataFrame:
    """Chassis contracts (A3): headerless ',' latin-1, day-first dates,
    positional names; months → years."""
    df = read_delimited(spark, path, ",", False, "ISO-8859-1",
                        columns=["_c0", "chassis_number", "cm_months", "cm_km", "cm_date_start", "cm_date_end"],
                        date_cols=["cm_date_start", "cm_date_end"], date_format="dd/MM/yyyy",
                        types={"cm_months": "double", "cm_km": "double"})
    return df.withColumn("cm_years", months_to_years("cm_months")).drop("_c0", "cm_months")


def read_option_lines(spark: SparkSession, paths, date_format: str | None = None,
                      thousands: str | None = None) -> DataFrame:
    """Option lines (A4): ';'-separated, decimal comma in money columns, two
    dates; several files (G3) are read as one input."""
    return read_delimited(spark, paths, ";", True, date_cols=["Data Compra", "Data Venda"], date_format=date_format,
                          decimal_comma_cols=["Custo", "Margem"], thousands=thousands)


def preview_headerless(spark: SparkSession, path, n: int = 5, sep: str = ";") -> DataFrame:
    """First rows of a headerless extract."""
    return spark.read.option("sep", sep).option("header", False).csv(path).limit(n)
