"""Versions of models in any store that Spark reaches, safe beside other writers.

A writer claims the next number by creating a file that must not exist, writes below it, and
lists the version by renaming a complete file. A write that breaks off leaves a claim and no listed
version. The claim is as safe as the store's exclusive creation; on a local disk, where Hadoop checks
before it creates, writers of one process take turns.
"""

import json
import uuid
from collections.abc import Callable
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from bondscope.storage import file_system

_LOCAL = Lock()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, place = file_system(spark, folder)
    if not files.exists(place):
        return []
    found = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name) for name in found if name.isdigit())


def _created(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file; False if it is there already."""
    files, place = file_system(spark, path)
    with _LOCAL:
        try:
            stream = files.create(place, False)
        except Py4JJavaError as error:
            if files.exists(place):
                return False
            raise error
    stream.write(text.encode())
    stream.close()
    return True


def claim(spark: SparkSession, base: str, model_id: str) -> int:
    """A version number that no other writer gets."""
    folder = f"{base}/{model_id}/claims"
    number = max(_numbers(spark, folder), default=0) + 1
    while not _created(spark, f"{folder}/{number}"):
        number += 1
    return number


def publish(
    spark: SparkSession,
    base: str,
    model_id: str,
    write: Callable[[str], None],
    **facts,
) -> int:
    """Claim a version, ``write`` to its path, and list it with its facts (such as its parent)."""
    version = claim(spark, base, model_id)
    write(version_path(base, model_id, version))
    draft = f"{base}/{model_id}/drafts/{version}-{uuid.uuid4().hex}"
    _created(spark, draft, json.dumps(facts))
    listed = f"{base}/{model_id}/versions/{version}"
    files, place = file_system(spark, listed)
    files.mkdirs(place.getParent())
    if not files.rename(file_system(spark, draft)[1], place):
        raise RuntimeError(f"version {version} of {model_id} could not be listed")
    return version


def version_path(base: str, model_id: str, version: int) -> str:
    return f"{base}/{model_id}/data/{version}"


def versions(spark: SparkSession, base: str, model_id: str) -> list[int]:
    """Complete versions, the oldest first."""
    return _numbers(spark, f"{base}/{model_id}/versions")


def facts(spark: SparkSession, base: str, model_id: str, version: int) -> dict:
    """What was listed with a version."""
    rows = spark.read.text(f"{base}/{model_id}/versions/{version}", wholetext=True).collect()
    return json.loads(rows[0][0]) if rows else {}
