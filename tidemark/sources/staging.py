"""Intermediate results written to the shared folder.

Later steps read only the columns they need of a staged table, its rows are worked out once however often
it is used, and after the loss of an executor files are read again instead of everything done over.
"""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir

#: Folders staged by this driver and not dropped so far, by session.
_STAGED: dict[str, SparkSession] = {}

#: Tables that hold whole texts: packed tighter, as a pass stages its texts several times.
WHOLE_TEXTS = set("landed posts-landed posts tweets-landed tweets entries-landed intake wanted enriched page-streams".split())

#: What each thread stages inside of :func:`noted`.
_NOTED = threading.local()


def staged(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written below the shared folder and read back; the folder goes with :func:`drop` or the driver."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED[path] = spark
    if getattr(_NOTED, "folders", None) is not None:
        _NOTED.folders.append(path)
    rows.write.parquet(path, compression="zstd" if name in WHOLE_TEXTS else None)
    return spark.read.schema(rows.schema).parquet(path)


def staged_last(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``build()`` staged; what it staged on its way is removed then."""
    before = set(_STAGED)
    rows = build()
    passing = [p for p in _STAGED if p not in before]
    try:
        return staged(rows, name)
    finally:
        for path in passing:
            if path in _STAGED:
                _delete(_STAGED.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Remove the folders of staged ``tables`` that no later step reads."""
    for table in tables:
        folders = {file.rpartition("/")[0] for file in table.inputFiles()}
        for path in [p for p in _STAGED if any(f.endswith(p.rpartition(":")[2]) for f in folders)]:
            _delete(_STAGED.pop(path), path)


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that this thread, and no other, stages inside; for :func:`remove`."""
    outer, made = getattr(_NOTED, "folders", None), []
    _NOTED.folders = made
    try:
        yield made
    finally:
        _NOTED.folders = outer
        if outer is not None:
            outer.extend(made)


def remove(folders: list[str]) -> None:
    """Remove staged ``folders`` that no later step reads."""
    for path in folders:
        if path in _STAGED:
            _delete(_STAGED.pop(path), path)


@contextlib.contextmanager
def scope():
    """Everything staged inside is removed at the end, whether the work ended well or not."""
    before = set(_STAGED)
    try:
        yield
    finally:
        for path in [p for p in _STAGED if p not in before]:
            _delete(_STAGED.pop(path), path)


@atexit.register
def _at_exit() -> None:
    for path, spark in list(_STAGED.items()):
        with contextlib.suppress(Exception):  # the session may have ended
            _delete(spark, path)
