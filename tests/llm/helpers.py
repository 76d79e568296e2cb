"""Small tables in the shape of the real ones."""

import datetime as dt

REVIEW = "review_id string, comment string, record_url string, title_hint string, creators array<string>, creator_orcids array<string>, harvested_at timestamp"
COMMENT = "comment_id string, content string, record_url string, creators array<string>"
METADATA = "provider_record_id long, target_value string, provider string, title string, authors array<string>, year string, venue_candidates array<string>, fields array<string>, retrieved_at timestamp"
DOCUMENT = "doc_id long, text string, lang string, source string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def reviews(spark, rows):
    return spark.createDataFrame([(i, t, "https://depot.example/r/1", h, c, [], None) for i, t, h, c in rows], REVIEW)


def comments(spark, rows):
    return spark.createDataFrame([(i, t, "https://depot.example/c/1", []) for i, t in rows], COMMENT)


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENT)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
