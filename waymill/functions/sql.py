"""The engine's rules for SQL text: temporary SQL functions, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "way_haversine_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE, radius DOUBLE) RETURNS DOUBLE": "2 * radius * asin(sqrt(least(1.0D, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
    "way_metric(raw STRING) RETURNS DOUBLE": "try_cast(trim(translate(lower(trim(raw)), 'tm', '')) AS DOUBLE)",
    "way_road_base(highway STRING) RETURNS STRING": "nullif(regexp_replace(lower(trim(highway)), '_link$', ''), '')",
    "way_access_no(value STRING) RETURNS BOOLEAN": "coalesce(lower(trim(value)) IN ('no', 'false', '0', 'private'), false)",
}


def register(spark: SparkSession) -> None:
    """Create or replace them in the session."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
