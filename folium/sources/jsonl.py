"""JSON artifacts: one object per line, or one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, lenient: bool = False) -> DataFrame:
    """Typed rows of JSON lines; blank lines are skipped. Strict: a bad line is an error when read; lenient: bad lines and lines that are no object are left out."""
    s = _schema(schema)
    if not lenient:
        return spark.read.schema(s).option("mode", "FAILFAST").json(path)
    # a text scan keeps columns prunable, and tells a bad line from an empty object
    lines = spark.read.text(path).where(F.trim("value") != "").where(F.ltrim("value").startswith("{"))
    row = F.from_json("value", StructType(s.fields).add("_bad", "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select(row.alias("r")).where(F.col("r").isNotNull() & F.col("r._bad").isNull()).select(*[F.col("r")[f.name].alias(f.name) for f in s.fields])


def read_json_any(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A .json file holds one object or a list of them, anything else JSON lines."""
    if path.lower().endswith(".json"):
        return spark.read.schema(_schema(schema)).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    return read_jsonl(spark, path, schema)
