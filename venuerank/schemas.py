"""Explicit schemas of the raw records and column lists of the derived tables."""

from pyspark.sql import types as T

BUSINESS_RAW = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("is_open", T.IntegerType()),
    T.StructField("categories", T.StringType()),
])

REVIEW_RAW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("date", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("useful", T.LongType()),
    T.StructField("funny", T.LongType()),
    T.StructField("cool", T.LongType()),
])

USER_RAW = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
])

RAW = {"business": BUSINESS_RAW, "review": REVIEW_RAW, "user": USER_RAW}

BUSINESS_COLUMNS = [
    "business_id", "is_open", "name", "city", "state",
    "latitude", "longitude", "categories", "review_count",
]
REVIEW_COLUMNS = ["review_id", "business_id", "user_id", "stars", "date", "text"]

# Attributes a venue's scores are grouped by; all are functions of the business record.
SCORE_KEYS = [
    "business_id", "name", "metro_area", "city",
    "latitude", "longitude", "grid_cell", "categories",
]
SCORE_COLUMNS = [*SCORE_KEYS, "avg_rating", "review_count", "recency_score", "popularity_score"]
PROFILE_COLUMNS = [
    "business_id", "name", "metro_area", "city", "latitude", "longitude",
    "avg_rating", "review_count", "popularity_score", "profile_text",
]
RECOMMENDATION_COLUMNS = ["user_id", "business_id", "predicted_rating", "rank"]
SENTIMENT_COLUMNS = ["grid_cell", "sentiment_score", "positive_count", "negative_count"]

# Unique key of each serving table. A grid cell can straddle two metros.
PRIMARY_KEYS = {
    "business_scores": ["business_id"],
    "grid_aggregates": ["grid_cell", "metro_area"],
    "als_recommendations": ["user_id", "business_id"],
    "grid_sentiment": ["grid_cell"],
    "business_profiles": ["business_id"],
}

# Widths of text columns and indexed columns of the serving tables in a relational store.
TEXT_WIDTHS = {"business_id": 50, "user_id": 50, "city": 100, "metro_area": 100, "grid_cell": 20}
INDEXES = {
    "business_scores": ["city", "metro_area"],
    "grid_aggregates": ["metro_area"],
    "als_recommendations": ["user_id", "business_id"],
    "business_profiles": ["metro_area"],
}
SQL_TYPES = {"double": "DOUBLE PRECISION", "float": "DOUBLE PRECISION", "int": "INT", "bigint": "BIGINT", "string": "TEXT"}


def sql_type(column: T.StructField) -> str:
    if column.name in TEXT_WIDTHS:
        return f"VARCHAR({TEXT_WIDTHS[column.name]})"
    return SQL_TYPES[column.dataType.simpleString()]


def create_statements(table: str, columns: T.StructType) -> list[str]:
    """SQL that makes a serving table with its primary key and indexes where they are missing."""
    typed = ", ".join(f"{c.name} {sql_type(c)}" for c in columns.fields)
    keys = ", ".join(PRIMARY_KEYS[table])
    made = [f"CREATE TABLE IF NOT EXISTS {table} ({typed}, PRIMARY KEY ({keys}))"]
    return made + [f"CREATE INDEX IF NOT EXISTS idx_{table}_{c} ON {table} ({c})" for c in INDEXES.get(table, [])]
