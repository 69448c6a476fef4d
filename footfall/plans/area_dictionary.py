"""Area tree to geohash dictionary."""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.operators.area import area_dictionary
from footfall.sources import read_areas_jdbc, read_table, replace_table


def run(
    spark: SparkSession,
    areas: str,
    dictionary: str,
    url: str | None = None,
    properties_file: str | None = None,
    read_partitions: int = 8,
    system: str = "bd09",
) -> None:
    """Rebuild the dictionary table from the area table.

    With ``url`` the area table is one of that database, read in ``read_partitions`` ranges of its id; the file
    has a ``name=value`` line for each connection property (user, password, driver).  ``system`` is the coordinate system of
    the log's positions: ``bd09``, like that of the areas, ``gcj02`` or ``wgs84``.
    """
    if url is None:
        tree = read_table(spark, areas)
    else:
        tree = read_areas_jdbc(spark, url, areas, read_properties(properties_file), int(read_partitions))
    replace_table(area_dictionary(tree, system), dictionary)


def read_properties(path: str | None) -> dict[str, str]:
    if path is None:
        return {}
    with open(path) as file:
        pairs = [line.strip().partition("=") for line in file if "=" in line]
    return {name.strip(): value.strip() for name, _, value in pairs}
