"""Versions of a table or an index, each published by one small file.

Data files are written under names of their own and never changed. What a
version consists of is a JSON file ``_versions/<number>.json``; it is written
under another name and renamed once it is complete. So a reader sees the last
version or the one before it, never a mixture, and a job that dies before the
rename leaves the last version as it was. Two writers that start from the same
version cannot both publish: the second finds its number taken and fails.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

from sparkretrieve.session import file_system

VERSIONS = "_versions"


class VersionTaken(RuntimeError):
    """Another writer has published the version this one was to become."""


def versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the versions that are there, oldest first."""
    fs, folder = file_system(spark, f"{base}/{VERSIONS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_version(spark: SparkSession, base: str, number: int | None = None) -> tuple[int, dict[str, Any]] | None:
    """(number, content) of a version (default: the last); None before the first."""
    if number is None:
        there = versions(spark, base)
        if not there:
            return None
        number = there[-1]
    path = f"{base}/{VERSIONS}/{number:010d}.json"
    text = spark.read.option("wholetext", True).text(path).first()
    return number, json.loads(text["value"])


def publish(spark: SparkSession, base: str, content: dict[str, Any], after: int) -> int:
    """Make ``content`` the version that follows ``after`` (0 for the first)."""
    number = after + 1
    fs, target = file_system(spark, f"{base}/{VERSIONS}/{number:010d}.json")
    _, draft = file_system(spark, f"{base}/{VERSIONS}/.{number:010d}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode("utf-8")))
    out.close()
    if fs.exists(target) or (versions(spark, base) or [0])[-1] != after or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise VersionTaken(f"version {number} of {base} exists already")
    return number
