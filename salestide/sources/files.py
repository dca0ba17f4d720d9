"""S1-S5: read the four relations from files with explicit schemas.

No schema inference (an extra full scan per file, and types that drift with
the data).  CSV columns are bound by *header name*, in any order; a column
the files do not have is NULL, one the schema does not have is ignored, and
files of one read whose headers differ raise.  Values are read as text and
parsed, so a row that does not fit is known: too many or too few fields, or
a value that is there but does not parse.  Such rows are kept out of the
relation and available, with the reason, from ``rejected_rows``.

CSV files written by an append-only consumer may repeat their header line
mid-file; Spark strips only each file's first line, so the repeats arrive as
rows that hold the column names.  They are dropped by default;
``keep_repeated_headers`` keeps them, values that are no text being NULL (the
original job counted them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.functions.timefns import parse_timestamp
from salestide.schemas import RELATIONS


_CORRUPT = "_corrupt_record"


def _csv_text(spark: SparkSession, path: str | list[str], options: dict) -> tuple[DataFrame, list[str]]:
    """The files' columns as text, by header name, and the raw line of rows
    with another number of fields."""
    options = {"header": True, **options}
    names = spark.read.options(**{**options, "inferSchema": False}).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    # enforceSchema off: files of another column order raise instead of binding by position
    df = (spark.read.schema(schema)
          .options(**{**options, "mode": "PERMISSIVE", "enforceSchema": False,
                      "columnNameOfCorruptRecord": _CORRUPT}).csv(path))
    return df, names


def _parsed(text: Column, to: T.DataType) -> Column:
    if isinstance(to, T.StringType):
        return text
    if isinstance(to, T.TimestampNTZType):
        return parse_timestamp(text)
    return F.trim(text).try_cast(to)


def _checked(spark: SparkSession, path, schema: T.StructType, options: dict):
    """(text rows, parsed columns by name, is it a repeated header, why it is rejected)."""
    raw, names = _csv_text(spark, path, options)
    by_name = {n.strip().lower(): n for n in names}
    text = {f.name: F.col(f"`{by_name[f.name.lower()]}`") if f.name.lower() in by_name
            else F.lit(None).cast("string") for f in schema.fields}
    header = reduce(lambda a, b: a & b, [
        F.trim(F.col(f"`{n}`")).eqNullSafe(F.lit(n.strip())) for n in names])
    parsed = {f.name: _parsed(text[f.name], f.dataType) for f in schema.fields}
    bad = [F.when(text[f.name].isNotNull() & parsed[f.name].isNull(), F.lit(f.name))
           for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    fields = F.when(F.col(_CORRUPT).isNotNull(), F.lit("number of fields"))
    reason = F.concat_ws(", ", fields, *bad)
    return raw, parsed, header, reason


def rejected_rows(spark: SparkSession, path: str | list[str], relation: str,
                  schema: T.StructType | None = None, **options) -> DataFrame:
    """The CSV rows that ``read_relation`` leaves out: their text columns and
    ``reason`` (the columns that do not parse, or the number of fields).
    Repeated header lines are not listed."""
    schema = schema or RELATIONS[relation][0]
    raw, _parsed_by_name, header, reason = _checked(spark, path, schema, options)
    return raw.withColumn("reason", reason).where(~header & (F.col("reason") != ""))


def read_relation(spark: SparkSession, path: str | list[str], relation: str,
                  fmt: str = "csv", schema: T.StructType | None = None,
                  keep_repeated_headers: bool = False, **options) -> DataFrame:
    """Read one relation (``customers``, ``products``, ``orders``,
    ``order_items``) from CSV, JSON or Parquet files.  ``schema`` overrides
    the canonical one (e.g. integer ids).  Order items gain ``line_amount =
    quantity * unit_price`` when the files carry no such column."""
    schema = schema or RELATIONS[relation][0]
    if fmt == "csv":
        raw, parsed, header, reason = _checked(spark, path, schema, options)
        keep = (header | (reason == "")) if keep_repeated_headers else (~header & (reason == ""))
        df = raw.where(keep).select(*[c.alias(n) for n, c in parsed.items()])
    else:
        df = spark.read.schema(schema).options(**options).format(fmt).load(path)
    if relation == "order_items" and "line_amount" not in df.columns:
        df = df.withColumn("line_amount", F.col("quantity") * F.col("unit_price"))
    return df
