"""Several tables published at once: readers see all of one version or all of another.

A version is a folder of its own. When all of its tables are written, one small file that did not exist before is renamed into place
and names it; nothing that a reader may have open is replaced. Readers take the newest such file, which pins their version, and a
version stays for the ``keep`` publications that follow it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .shared_tables import _file, create_text, make_folder, read_text, remove_folder


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    system, p = _file(spark, f"{folder}/published")
    if not system.exists(p):
        return []
    names = [s.getPath().getName() for s in system.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _pointer(folder: str, number: int) -> str:
    return f"{folder}/published/{number:09d}.json"


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame], keep: int = 2) -> int:
    """Write the tables and publish them together; the number of their version. Where two publish at once, both do, one after the
    other."""
    folder = folder.rstrip("/")
    data = f"{folder}/data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{data}/{name}")
    make_folder(spark, f"{folder}/published")
    text = json.dumps({"data": data, "tables": {name: df.schema.jsonValue() for name, df in tables.items()}})
    while True:
        numbers = _numbers(spark, folder)
        number = numbers[-1] + 1 if numbers else 1
        if create_text(spark, _pointer(folder, number), text):
            break
    for old in numbers[: max(0, len(numbers) - keep)]:
        gone = json.loads(read_text(spark, _pointer(folder, old)))["data"]
        remove_folder(spark, _pointer(folder, old))
        remove_folder(spark, gone)
    return number


def latest(spark: SparkSession, folder: str) -> int | None:
    """The version that was published last."""
    return max(_numbers(spark, folder.rstrip("/")), default=None)


def pinned(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, or of the last one; each DataFrame stays with it, whatever is published later."""
    from pyspark.sql import types as T

    folder = folder.rstrip("/")
    number = latest(spark, folder) if number is None else number
    if number is None:
        raise LookupError(f"nothing is published in {folder}")
    if number not in _numbers(spark, folder):
        raise LookupError(f"version {number} is not kept in {folder}")
    said = json.loads(read_text(spark, _pointer(folder, number)))
    return {name: spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{said['data']}/{name}") for name, schema in said["tables"].items()}
