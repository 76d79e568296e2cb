"""JSON pages and artifacts, attachments, XML entries and CSV: readers and writers."""

from __future__ import annotations

import csv
import json
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..storage import delete, exists, publish_text, read_text

SCHEMA_VERSION = 1


class PageSource(DataSource):
    """spark.read.format("pages").option("path", folder).load(): a row for each record of numbered page files.

    Pages are page-<n>.json with hits.hits and hits.total (a number or {value}). One partition a page; the first number
    without a file ends the scan, or maxPages where that option is given. All executors must see the folder."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "page int, pos int, total long, record_id string, record string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.most = options["path"], options.get("maxPages")

    def partitions(self) -> list[InputPartition]:
        numbers = []
        while (self.most is None or len(numbers) < int(self.most)) and os.path.exists(f"{self.folder}/page-{len(numbers) + 1}.json"):
            numbers.append(len(numbers) + 1)
        return [InputPartition(n) for n in numbers] or [InputPartition(0)]

    def read(self, partition: InputPartition):
        import json as j

        path = f"{self.folder}/page-{partition.value}.json"
        if not os.path.exists(path):
            return
        with open(path, encoding="utf-8") as f:
            hits = (j.load(f) or {}).get("hits") or {}
        total = hits.get("total")
        total = total.get("value") if isinstance(total, dict) else total
        for pos, r in enumerate(hits.get("hits") or []):
            key = next((str(r[k]) for k in ("id", "recid", "doi") if r.get(k)), None)
            yield (partition.value, pos, total, key, j.dumps(r))


def scan(pages: DataFrame) -> DataFrame:
    """The first row of each record id by page and position, ready for parse_json; rows without id are left out."""
    return pages.where("record_id is not null").groupBy("record_id").agg(F.min_by(F.struct("page", "pos", "total", "record"), F.struct("page", "pos")).alias("r")).select("record_id", "r.*")


def scan_report(pages: DataFrame) -> DataFrame:
    """records, unique_records, dropped, total, complete: complete if as many unique records came as were announced."""
    n = pages.agg(F.count("*").alias("records"), F.countDistinct("record_id").alias("unique_records"), F.max("total").alias("total"))
    return n.select("records", "unique_records", (F.col("records") - F.col("unique_records")).alias("dropped"), "total", F.coalesce(F.col("unique_records") >= F.col("total"), F.lit(False)).alias("complete"))


def read_json(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON artifact, null where there is none; corrupt parts become _corrupt_record rows rather than failures."""
    if not exists(spark, path):
        return None
    return spark.read.option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def entries_of_feed(feeds: DataFrame, xml: str) -> DataFrame:
    """title, authors, published of the first entry of Atom feeds, without a parser outside the JVM."""
    x = F.col(xml)
    return feeds.withColumn("title", F.xpath_string(x, F.lit("//entry/title"))).withColumn("authors", F.xpath(x, F.lit("//entry/author/name/text()"))).withColumn("published", F.xpath_string(x, F.lit("//entry/published")))


def write_bytes(value: bytes, path: str) -> None:
    """A small file of the driver, written beside its place and moved into it."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f"{target.name}.{uuid.uuid4().hex}.part")
    part.write_bytes(value)
    os.replace(part, target)


def write_json(value: object, path: str) -> None:
    """A small report of the driver."""
    write_bytes(json.dumps(value, ensure_ascii=False, indent=2).encode("utf-8"), path)


def word_list(spark: SparkSession, path: str) -> frozenset[str]:
    """The words of a list, one a line, in lower case, for unwrap; empty where there is no list."""
    return frozenset(w for line in (read_text(spark, path) or "").splitlines() if (w := line.strip().lower()).isalpha())


def write_table(df: DataFrame, path: str, stage: str, complete: bool = True, made_from: str = "") -> None:
    """A stage's table with a manifest that says which stage and schema it is of and where its data lie.

    Data go to a folder of their own and the manifest is moved into place last: whoever reads sees the table before or the
    new one, never half of one. Data of the table before are deleted after that."""
    spark = df.sparkSession
    before = _manifest(spark, path)
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{data}")
    publish_text(spark, f"{path}/manifest.json", json.dumps({"stage": stage, "schema_version": SCHEMA_VERSION, "complete": complete, "columns": df.columns, "made_from": made_from, "data": data}))
    if before:
        delete(spark, f"{path}/{before['data']}")


def _manifest(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, f"{path}/manifest.json")
    return json.loads(text) if text else None


def read_table(spark: SparkSession, path: str, stage: str, allow_partial: bool = False) -> DataFrame:
    """A stage's table. A missing one, another stage or version, and a partial one unless allowed, are refused."""
    manifest = _manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"{path} holds no table: run stage {stage} first")
    if (manifest.get("stage"), manifest.get("schema_version")) != (stage, SCHEMA_VERSION):
        raise ValueError(f"{path} is not a table of stage {stage}, version {SCHEMA_VERSION}: run the stage before again")
    if manifest.get("complete") is not True and not allow_partial:
        raise ValueError(f"{path} is of a scan that did not end; say so to use it")
    return spark.read.parquet(f"{path}/{manifest['data']}")


def as_text_columns(df: DataFrame) -> DataFrame:
    """Lists, structs and maps as JSON text, null as an empty string: the shape of a CSV."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
    return df.select(*[(F.to_json(c) if c in nested else F.col(c).cast("string")).alias(c) for c in df.columns]).fillna("")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts whose texts come back as they were: quotes doubled, blanks kept, empty as empty."""
    as_text_columns(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path).fillna("")


def export_csv(df: DataFrame, path: str) -> int:
    """One CSV file with a byte-order mark, written row by row and moved into its place; gives the number of rows."""
    flat, part, n = as_text_columns(df), f"{path}.{uuid.uuid4().hex}.part", 0
    with open(part, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(flat.columns)
        for row in flat.toLocalIterator():
            out.writerow(row)
            n += 1
    os.replace(part, path)
    return n
