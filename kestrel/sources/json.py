"""JSON-lines scan and nested schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that a line goes to which does not fit; no field of the data may have this name.
_CORRUPT = "_corrupt_line"


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines.  Without a schema Spark infers one in an extra pass (all
    fields nullable, absent keys NULL); production jobs pass the schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _walk(dtype: T.DataType, path: str, nullable: bool, out: list):
    out.append((path, dtype.simpleString(), nullable))
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            _walk(f.dataType, f"{path}.{f.name}" if path else f.name, f.nullable, out)
    elif isinstance(dtype, T.ArrayType):
        _walk(dtype.elementType, f"{path}.element", dtype.containsNull, out)
    elif isinstance(dtype, T.MapType):
        _walk(dtype.keyType, f"{path}.key", False, out)
        _walk(dtype.valueType, f"{path}.value", dtype.valueContainsNull, out)


def schema_rows(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """Flatten a (nested) schema into (path, type, nullable) rows."""
    out: list = []
    for f in schema.fields:
        _walk(f.dataType, f.name, f.nullable, out)
    return out


def schema_report(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``printSchema`` as a table.  The schema is metadata (its size depends
    on the column count, not on the data), so building it on the driver is
    bounded."""
    return spark.createDataFrame(schema_rows(df.schema), "path string, type string, nullable boolean")


def read_json_lines(lines: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects (line)) of JSON lines in ``value``, by a known schema, from one parse.

    Absent keys are null at any depth.  A line that is no JSON object, or whose values do not fit the schema, is kept aside whole.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wanted = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = lines.select("value", F.from_json("value", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("x"))
    bad = F.col("x").isNull() | F.col(f"x.{_CORRUPT}").isNotNull()
    return parsed.where(~bad).select(*[F.col("x")[f.name].alias(f.name) for f in schema.fields]), parsed.where(bad).select(F.col("value").alias("line"))


def inferred_schema(lines: DataFrame) -> str:
    """The merged schema of JSON lines as Spark's variant type describes it; lines that are no JSON do not count.

    One aggregate over all lines: fields that only some lines have are found wherever they are.
    """
    found = lines.select(F.try_parse_json("value").alias("v")).agg(F.schema_of_variant_agg("v").alias("schema")).first()
    return found.schema
