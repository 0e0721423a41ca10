"""Commits over several tables at once (OP10, SNK4).

A state made of parts of several tables is named by one small numbered file, written last
and by renaming: readers take the newest file and read the parts it names, nothing else.
Parts are never written over while a file names them, so a job that dies at any point
leaves the state before it, and what it had written is not part of any state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from . import runner

FOLDER = "manifest"
#: Files kept beside the newest, for those who want to know what was before.
KEEP = 1


def _numbers(spark: SparkSession, tables: str) -> list[int]:
    return sorted(int(name.removesuffix(".json"))
                  for name in runner.children(spark, f"{tables}/{FOLDER}")
                  if name.endswith(".json") and not name.startswith("."))


def latest(spark: SparkSession, tables: str) -> tuple[int, dict]:
    """Number and content of the newest commit; 0 and nothing before the first."""
    known = _numbers(spark, tables)
    if not known:
        return 0, {}
    return known[-1], json.loads(runner.read_text(spark, _path(tables, known[-1])))


def _path(tables: str, number: int) -> str:
    return f"{tables}/{FOLDER}/{number:012d}.json"


def commit(spark: SparkSession, tables: str, number: int, content: Mapping) -> None:
    """Make ``content`` the state of ``number``, which must be new: of two writers that
    started from one state, the later one fails."""
    if runner.exists(spark, _path(tables, number)):
        raise ValueError(f"{tables} already has a commit {number}")
    draft = f"{tables}/{FOLDER}/.{number}-{uuid.uuid4().hex}"
    runner.write_text(spark, draft, json.dumps(content, sort_keys=True))
    if not runner.rename(spark, draft, _path(tables, number)):
        raise ValueError(f"{tables}: commit {number} could not be made")
    for old in _numbers(spark, tables):
        if old < number - KEEP:
            runner.remove(spark, _path(tables, old))


def new_part(table: str) -> str:
    """A name for a part of ``table`` that no earlier try has used."""
    return f"{table}/{uuid.uuid4().hex}"
