"""The functions a SQL user calls by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.functions.places import geohash6_sql


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``geo(lat, lng)``, ``isNotBlank(text)`` and ``getCnt(bitmap)`` for SQL text.

    They expand to built-in expressions when the query is analyzed, so nothing leaves the JVM and
    code generation stays whole.  The bitmap aggregates need no registration:
    ``bitmap_construct_agg(bitmap_bit_position(id))`` and ``bitmap_or_agg(bitmap)`` are built in.
    """
    spark.sql(
        "create or replace temporary function geo(lat double, lng double) returns string "
        f"return {geohash6_sql('lat', 'lng')}"
    )
    spark.sql(
        "create or replace temporary function isNotBlank(txt string) returns boolean "
        r"return coalesce(txt rlike r'\P{javaWhitespace}', false)"
    )
    spark.sql(
        "create or replace temporary function getCnt(bitmap binary) returns bigint "
        "return bitmap_count(bitmap)"
    )
