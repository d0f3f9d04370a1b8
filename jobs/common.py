"""What the jobs' command lines share. Paths may be remote: files are read by Spark only."""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging

from pyspark.sql import SparkSession

from topicloom.session import build_session

log = logging.getLogger("jobs")


def settings(spark: SparkSession, kind: type, path: str | None):
    """A job's settings from a JSON file of some or all of their names; an unknown name is an error."""
    if not path:
        return kind()
    given = json.loads(spark.read.text(path, wholetext=True).first()[0])
    unknown = set(given) - {f.name for f in dataclasses.fields(kind)}
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return kind(**given)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).limit(0)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return True


def command(name: str, about: str, arguments: dict[str, str], work) -> None:
    """Parses paths and --config, creates the session, runs work(spark, arguments) and stops the session."""
    parser = argparse.ArgumentParser(prog=name, description=about)
    for argument, text in arguments.items():
        parser.add_argument(argument, help=text)
    parser.add_argument("--config", help="a JSON file of settings")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session(name)
    try:
        work(spark, given)
    finally:
        spark.stop()
