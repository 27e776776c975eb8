"""Manifests: small files that say which folders make up a table.

A table that is changed in place is a set of folders that are never changed;
the manifest names the valid ones.  A new manifest is written aside and then
moved to its number, so readers see the old or the new one, never a half.
Two writers that start from the same number cannot both succeed.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

FOLDER = "_manifest"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    fs, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def read_manifest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """The latest manifest and its number; 0 and an empty one if there is none."""
    numbers = [int(n[:-5]) for n in names(spark, f"{table}/{FOLDER}") if n.endswith(".json") and n[0] != "."]
    if not numbers:
        return 0, {}
    text = spark.read.text(f"{table}/{FOLDER}/{max(numbers):012d}.json", wholetext=True).first()[0]
    return max(numbers), json.loads(text)


def write_manifest(spark: SparkSession, table: str, number: int, content: dict) -> None:
    """Make ``content`` the manifest after the one with the number before."""
    fs, target = _file_system(spark, f"{table}/{FOLDER}/{number:012d}.json")
    _, aside = _file_system(spark, f"{table}/{FOLDER}/.{number:012d}-{spark._jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(aside)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise RuntimeError(f"{table} was changed by another writer")
    for old in names(spark, f"{table}/{FOLDER}"):
        if old.endswith(".json") and old[0] != "." and int(old[:-5]) < number - 1:
            delete(spark, f"{table}/{FOLDER}/{old}")
