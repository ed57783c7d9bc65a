"""What a snapshot table shows: small files that name, for every month, the run that holds it.

Files are numbered; the one with the highest number is in force.  A file is written
beside its name first and then renamed, so it is there whole or not at all, and all
months it changes become visible together.  Of two runs that publish at the same
time one finds its number taken, reads again what is in force, and goes after the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import SparkSession

FOLDER = "published"


class Shown(NamedTuple):
    """One month: the run that wrote it, its folders below that run, its rows, and the buckets they lie in, if any."""

    run: str
    folders: list[str]
    rows: int
    # Column and number.
    buckets: list | None = None


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system it names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def names_below(spark: SparkSession, path: str) -> list[str]:
    folder, files = file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, Shown]]:
    """The number in force and the months shown; rows without a month stand under the empty name."""
    numbers = [int(n.removesuffix(".json")) for n in names_below(spark, f"{path}/{FOLDER}") if n[0].isdigit() and n.endswith(".json")]
    if not numbers:
        return 0, {}
    file, files = file_system(spark, f"{path}/{FOLDER}/{max(numbers):012d}.json")
    stream = files.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), {month: Shown(**shown) for month, shown in json.loads(text).items()}


def change(spark: SparkSession, path: str, new: Callable[[dict[str, Shown]], dict[str, Shown]], tries: int = 20) -> dict[str, Shown]:
    """Put what ``new`` makes of the months shown in force."""
    for _ in range(tries):
        number, shown = current(spark, path)
        wanted = new(dict(shown))
        if wanted == shown:
            return shown
        text = json.dumps({m: s._asdict() for m, s in sorted(wanted.items())}, indent=1)
        aside, files = file_system(spark, f"{path}/{FOLDER}/.{uuid.uuid4().hex}")
        target, _ = file_system(spark, f"{path}/{FOLDER}/{number + 1:012d}.json")
        stream = files.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not files.exists(target) and files.rename(aside, target):
            return wanted
        files.delete(aside, False)
    raise RuntimeError(f"{path}: other runs published {tries} times in between")
