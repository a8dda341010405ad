"""Raw line-delimited JSON records and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuerank import schemas


def join_path(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def read_json(spark: SparkSession, base: str, filename: str, entity: str) -> DataFrame:
    """Scan one entity file with its fixed schema; a malformed line becomes a row of nulls."""
    reader = spark.read.schema(schemas.RAW[entity]).option("mode", "PERMISSIVE")
    return reader.json(join_path(base, filename))


def malformed_lines(spark: SparkSession, base: str, filename: str, entity: str) -> DataFrame:
    """The lines `read_json` could not read, as `malformed`; blank lines aren't among them."""
    schema = T.StructType([*schemas.RAW[entity].fields, T.StructField("malformed", T.StringType())])
    lines = spark.read.text(join_path(base, filename)).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
    return lines.select(parsed.getField("malformed").alias("malformed")).filter(F.col("malformed").isNotNull())


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Stored table; metro names stay text even when they look like numbers."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    df = spark.read.parquet(join_path(base, name))
    return with_metro_fallback(df)


def with_metro_fallback(df: DataFrame) -> DataFrame:
    """Tables written before metros existed carry the city only."""
    if "metro_area" not in df.columns and "city" in df.columns:
        return df.withColumn("metro_area", F.col("city"))
    return df


def ratings(enriched: DataFrame) -> DataFrame:
    return enriched.select("review_id", "user_id", "business_id", F.col("stars").cast("float").alias("stars"))


def cell_stars(enriched: DataFrame) -> DataFrame:
    return enriched.select("grid_cell", "stars")


def labelled_text(enriched: DataFrame) -> DataFrame:
    return enriched.select("review_id", "text", "stars")
