"""Sinks: JSON, text and CSV per key, the stage trace, and exports."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, key: str = "paper_id", folders: bool = False) -> None:
    """A JSON line for each key, overwritten; columns in the order of their names. folders: a folder for
    each key instead, for as many keys as a folder may hold."""
    rows = df.select(key, *sorted(c for c in df.columns if c != key)).write.mode("overwrite")
    (rows.partitionBy(key) if folders else rows).json(path)


def write_text(df: DataFrame, path: str, column: str, key: str = "paper_id", folders: bool = False) -> None:
    """One text per key (full texts, reports), as a table of key and value; folders: as a text file in a
    folder for each key."""
    rows = df.select(key, F.col(column).alias("value")).write.mode("overwrite")
    rows.partitionBy(key).text(path) if folders else rows.parquet(path)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """Flat tables as CSV with headers, one folder per sheet."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/{name}")


def pretty_json(payload: dict) -> str:
    return json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row, one-column result (a report, a summary) into a local file."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(df.first()[0] or "", encoding="utf-8")


def collect_summaries(runs: DataFrame, path: str) -> int:
    """Copy runs' summaries (run_id, value), one per run; how many."""
    runs.select("run_id", "value").write.mode("overwrite").partitionBy("run_id").text(path)
    return runs.select("run_id").distinct().count()


def copied_pdf(source: str, folder: str, filename: str) -> str:
    """The copy's path, or the source's where it can't be copied."""
    try:
        Path(folder).mkdir(parents=True, exist_ok=True)
        return str(shutil.copy2(source, Path(folder, filename)))
    except OSError:
        return source
