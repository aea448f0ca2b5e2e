"""A caller's own function over documents."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def map_documents(
    docs: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType
) -> DataFrame:
    """Apply ``function`` to batches of documents, in parallel and in no particular order.

    The result has the columns of ``schema`` plus ``error``. A batch in which a document fails is halved and done
    again until the failing ones stand alone; only they come back with ``error`` set and nulls elsewhere.
    """
    names = schema.fieldNames()
    full = T.StructType([*schema.fields, T.StructField("error", T.StringType())])

    def attempt(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return function(batch)[names].assign(error=None)
        except Exception as failure:
            if len(batch) == 1:
                return pd.DataFrame([{**dict.fromkeys(names), "error": f"{type(failure).__name__}: {failure}"}])
            half = len(batch) // 2
            return pd.concat([attempt(batch.iloc[:half]), attempt(batch.iloc[half:])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield attempt(batch)

    return docs.mapInPandas(run, full)
