"""Batch prediction functions over Arrow batches (``mapInPandas``).

A wrapped model object exposes ``predict(frame) -> values``. It is broadcast, so that an
executor gets it once however many tasks it runs, and applied to each Arrow batch, so
per-row Python never runs; only the input columns named here cross into Python.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# The functions and wrappers below run inside Python workers; ship them by value so the
# workers need only pandas/numpy, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BatchModel(Protocol):
    def predict(self, frame: pd.DataFrame) -> pd.Series: ...


def decode_series(values: pd.Series, mapping: dict) -> pd.Series:
    """Map values; unmapped ones pass through unchanged."""
    return values.map(mapping).where(values.isin(list(mapping)), values)


class ThresholdModel:
    """Two-class rule model: ``above`` when ``column >= threshold`` else ``below``."""

    def __init__(self, column: str, threshold: float, above: str, below: str) -> None:
        self.column, self.threshold, self.above, self.below = column, threshold, above, below

    def predict(self, frame: pd.DataFrame) -> pd.Series:
        x = frame[self.column].to_numpy()
        return pd.Series(np.where(x >= self.threshold, self.above, self.below), index=frame.index)


class ModelWrapper:
    """predict(context, frame): run the wrapped model, then decode its labels."""

    def __init__(self, model: BatchModel, labels: dict | None = None) -> None:
        self.model, self.labels = model, labels or {}

    def predict(self, context, frame: pd.DataFrame) -> pd.Series:  # noqa: ARG002 - context kept for the interface
        out = pd.Series(self.model.predict(frame), index=frame.index).astype(object)
        return decode_series(out, self.labels) if self.labels else out


def score_batches(df: DataFrame, wrapper: ModelWrapper, inputs: list[str], keep: list[str], out: str = "prediction") -> DataFrame:
    """Apply ``wrapper`` per Arrow batch; output ``keep`` columns plus the string ``out``."""
    cols = list(dict.fromkeys([*keep, *inputs]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    schema = f"{schema}, `{out}` string" if schema else f"`{out}` string"

    shared = df.sparkSession.sparkContext.broadcast(wrapper)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for frame in batches:
            result = frame[keep].copy()
            result[out] = model.predict(None, frame[inputs]).to_numpy()
            yield result

    return df.select(*cols).mapInPandas(run, schema)
