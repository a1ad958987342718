"""Runs published as a whole: folders of their own, and a manifest, written last, that names them.

A run writes its outputs to fresh folders that nothing else touches. Then one manifest of the day, a small table with a version
number, says where they are; it counts once it is complete. Readers follow the newest manifest of a day and so see all outputs of one
run or all of another, never some of each. A run that ends early leaves folders that no manifest names, and may be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from staffcast.sources.snapshots import _list


@dataclass(frozen=True)
class Run:
    """A published run: its day, the version of its manifest, and the folder of each output."""

    day: date
    version: int
    places: Mapping[str, str]


def _versions(spark: SparkSession, folder: str, complete: bool = True) -> list[int]:
    found = [n for n in _list(spark, folder) if n.startswith("version=")]
    if complete:
        found = [n for n in found if "_SUCCESS" in _list(spark, f"{folder}/{n}")]
    return sorted(int(n.split("=")[1]) for n in found)


def publish(spark: SparkSession, path: str, day: date, writers: Mapping[str, Callable[[str], None]]) -> Run:
    """Let each writer write its output to a new folder below ``path``, then publish them together for ``day``.

    A version number is taken once: of two runs that publish at the same time, the second takes the next number.
    """
    own = f"runs/{day.isoformat()}-{uuid.uuid4().hex}"
    places = {name: f"{own}/{name}" for name in writers}
    for name, write in writers.items():
        write(f"{path}/{places[name]}")
    folder = f"{path}/published/day={day.isoformat()}"
    manifest = spark.createDataFrame([(json.dumps(places),)], "value string").coalesce(1)
    while True:
        # Numbers of unfinished manifests are not used again.
        version = max(_versions(spark, folder, complete=False), default=0) + 1
        try:
            manifest.write.mode("error").text(f"{folder}/version={version}")
        except AnalysisException as taken:
            if "PATH_ALREADY_EXISTS" not in str(taken.getCondition()):
                raise
        else:
            return _read(spark, path, day, version)


def _read(spark: SparkSession, path: str, day: date, version: int) -> Run:
    text = spark.read.text(f"{path}/published/day={day.isoformat()}/version={version}").first()["value"]
    return Run(day, version, {name: f"{path}/{place}" for name, place in json.loads(text).items()})


def published_days(spark: SparkSession, path: str) -> list[date]:
    """Days with a published run, in order; lists folders, reads no data."""
    days = [n.split("=")[1] for n in _list(spark, f"{path}/published") if n.startswith("day=")]
    return [date.fromisoformat(d) for d in sorted(days) if _versions(spark, f"{path}/published/day={d}")]


def find_run(spark: SparkSession, path: str, day: date | None = None) -> Run:
    """The newest run of ``day``, or of the last day that has one."""
    days = published_days(spark, path)
    wanted = day if day is not None else max(days, default=None)
    if wanted not in days:
        raise FileNotFoundError(f"no published run below {path}" + (f" for {day}" if day else ""))
    return _read(spark, path, wanted, _versions(spark, f"{path}/published/day={wanted.isoformat()}")[-1])


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A Parquet output of all days, of each day that of its newest run."""
    places = [find_run(spark, path, day).places[name] for day in published_days(spark, path)]
    if not places:
        raise FileNotFoundError(f"no published run below {path}")
    return spark.read.parquet(*places)
