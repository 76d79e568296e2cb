"""The whole run: tables in, papers, issues and a report out. python -m peerloom.plans.pipeline TABLES OUT"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, merge, papers, rounds, threads, validate
from ..sources.tables import table
from .stages import Settings, places, run_stage, write_report


def run(spark: SparkSession, tables: str, out: str, settings: Settings = Settings()) -> bool:
    """Run all stages under out, each only if its inputs changed; gives whether the papers have no issue."""
    where = places(out)
    run_stage(spark, where["reviews"], "reviews", settings, {}, lambda: dedup.unique_records(table(spark, tables, "reviews"), "review_id", "harvested_at"))

    def enrich(reviews: DataFrame) -> DataFrame:
        wanted = reviews.select(F.col("target.value").alias("target_value")).distinct()
        answers = merge.ranked_answers(table(spark, tables, "provider_metadata"), table(spark, tables, "providers"))
        return wanted.join(merge.merge_answers(answers), "target_value", "left")

    run_stage(spark, where["metadata"], "metadata", settings, {"reviews": where["reviews"]}, enrich)

    def build(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
        return papers.papers(rounds.target_versions(reviews), metadata, table(spark, tables, "targets"))

    run_stage(spark, where["papers"], "papers", settings, {"reviews": where["reviews"], "metadata": where["metadata"]}, build)

    def check(reviews: DataFrame, papers: DataFrame) -> DataFrame:
        events = threads.thread_events(reviews, table(spark, tables, "author_responses"), table(spark, tables, "discussion_comments"))
        single = validate.breaches(papers, "family_key", validate.paper_constraints(1900, 2100))
        return single.unionByName(validate.repeated_families(papers)).unionByName(validate.round_shape(events)).unionByName(validate.shape(papers, PAPER_COLUMNS))

    issues = run_stage(spark, where["issues"], "issues", settings, {"reviews": where["reviews"], "papers": where["papers"]}, check)
    return write_report(spark, where["report"], issues)


PAPER_COLUMNS = papers.COLUMNS


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("tables", help="folder of the parquet tables")
    parser.add_argument("out", help="folder for the stages, shared by all executors")
    parser.add_argument("--allow-partial", action="store_true", help="go on from a scan that did not end")
    given = parser.parse_args(arguments)
    return int(not run(SparkSession.builder.getOrCreate(), given.tables, given.out, Settings(allow_partial=given.allow_partial)))


if __name__ == "__main__":
    raise SystemExit(main())
