"""Writers: tables, pages, payloads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one (a local one only where none is named and the master is local)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='quorumtext-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quorumtext-export-{uuid.uuid4().hex}"


def export_table(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """SNK-01: zstd parquet; one file only where a table is known to be small."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("compression", "zstd").parquet(path)


def export_catalog(spark: SparkSession, folder: str) -> list[str]:
    """SNK-01 for every table and view of the current database."""
    names = sorted(t.name for t in spark.catalog.listTables())
    for name in names:
        export_table(spark.table(name), f"{folder}/{name}")
    return names


def write_pages(rows: DataFrame, path: str, page: str = "pdf_page") -> None:
    """SNK-05: a folder of JSON for each page."""
    rows.write.mode("overwrite").partitionBy(page).json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """SNK-06"""
    rows.write.mode("overwrite").json(path)


def write_truth(rows: DataFrame, path: str, key: str = "id", text: str = "text") -> None:
    """SNK-11: key TAB text in the order of the key."""
    line = F.concat_ws("\t", F.col(key).cast("string"), F.coalesce(F.col(text), F.lit("")))
    rows.orderBy(key).select(line.alias("value")).write.mode("overwrite").text(path)


def replace_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-03: the old rows whose key is not renewed, and the new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def search_payload(entries: DataFrame, year: str, page: str, text: str) -> Column:
    """SNK-07: [year, page, text] as JSON."""
    return F.to_json(F.array(F.col(year).cast("string"), F.col(page).cast("string"), F.col(text)))
