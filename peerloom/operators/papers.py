"""The output: one row for each family, with the metadata of its latest version and how many rounds it went through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rounds import latest_versions

COLUMNS = ["family_key", "doi", "target_value", "title", "title_from", "authors", "authors_from", "year", "year_from", "rounds"]


def papers(versions: DataFrame, merged: DataFrame, targets: DataFrame) -> DataFrame:
    """COLUMNS for each family of versions; metadata is null where the latest version has no answer.

    Targets are unique by value; of several rows with a value the highest DOI counts."""
    latest = latest_versions(versions).join(versions.groupBy("family_key").agg(F.count("*").alias("rounds")), "family_key").withColumnRenamed("latest", "target_value")
    dois = targets.groupBy("target_value").agg(F.max("doi").alias("doi"))
    rows = latest.join(merged, "target_value", "left").join(dois, "target_value", "left").withColumn("doi", F.coalesce("doi", F.lit("")))
    return rows.select(*COLUMNS)
