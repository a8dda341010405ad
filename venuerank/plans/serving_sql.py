"""Serving queries as SQL with named parameters, over any tables that are passed in.

Values only ever reach a statement as parameters, never as part of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATEMENTS = {
    "venues_of_city": "SELECT * FROM {scores} WHERE city = :city",
    # a parameter that is null or "All" lets everything pass; wildcards in it stand for themselves
    "venues_by_cuisine": """
        SELECT * FROM {scores}
        WHERE :cuisine IS NULL OR :cuisine IN ('', 'All')
           OR coalesce(lower(categories) LIKE concat('%', regexp_replace(lower(:cuisine), '([%_!])', '!$1'), '%') ESCAPE '!', false)""",
    "users_matching_taste": """
        SELECT user_id, count(*) AS matches, avg(predicted_rating) AS avg_pred
        FROM {recommendations} JOIN {scores} USING (business_id)
        WHERE metro_area = :metro
          AND exists(:cuisines, c -> c IN ('', 'All') OR coalesce(contains(lower(categories), lower(c)), false))
        GROUP BY user_id""",
}


def serve(spark: SparkSession, name: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """The answer of a statement over `tables`, for the named parameters; null ones stay null."""
    return spark.sql(STATEMENTS[name], args=parameters, **tables)
