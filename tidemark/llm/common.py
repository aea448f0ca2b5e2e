"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def by_value(module: str) -> None:
    """Functions of ``module`` travel whole to the workers, which then need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)

def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, after which what it took goes back to the machine: else an idle worker, of which an
    executor has several, keeps the most it ever took."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


#: Bytes at which an Arrow batch to a Python worker ends.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of this session end at ``BATCH_BYTES`` from here on, if they don't end earlier already: a batch lies
    in the executor's direct memory and, as text, twice in the worker's."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if size > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """A text, the empty one where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def slices(batches: Iterator[pd.DataFrame], budget: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` in frames of about ``budget`` characters of ``text``, so that long texts
    don't make a batch's working memory long."""
    for batch in batches:
        if len(batch) == 0:
            continue
        block = np.cumsum([len(t) if isinstance(t, str) else 0 for t in batch["text"]]) // budget
        for _, part in batch.groupby(block, sort=True):
            yield part.reset_index(drop=True)


def strings(values: list) -> pd.Series:
    """A column of strings or lists that Arrow takes as one array even where it is empty."""
    return pd.Series(values, dtype=object)


__all__ = ["DOCUMENT_COLUMNS", "AnalysisException", "by_value", "lean", "slices", "small_batches", "strings", "table", "whole_text"]
