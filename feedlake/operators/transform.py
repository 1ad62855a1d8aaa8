"""User transforms.

T1 dataset scope: ``fn(DataFrame) -> DataFrame`` over the whole stream
(the default, D1). T2 batch scope: a pandas function per Arrow batch via
``mapInPandas`` (the reference's per-10,000-row behaviour; only row-local
logic gives layout-independent results). T3 fail-safe: a transform that
raises, returns ``None`` or is missing leaves the raw rows in place, and
the failure is reported rather than failing the run.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedlake.operators.land import apply_failsafe, land_full


def apply_dataset(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Whole-dataset transform."""
    return df if fn is None else df.transform(fn)


def apply_batched(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame | None],
    schema: str | None = None,
    failsafe: bool = True,
) -> DataFrame:
    """``fn`` on each Arrow batch (``spark.sql.execution.arrow.maxRecordsPerBatch``
    rows, 10,000 by default). With ``failsafe`` a batch whose call raises or returns
    ``None`` is passed through unchanged, which needs ``schema`` equal to the input's."""
    out_schema = schema or df.schema
    same = schema is None or T.StructType.fromDDL(schema) == T.StructType.fromDDL(df.schema.simpleString()[7:-1])

    def run(batches):
        for pdf in batches:
            try:
                res = fn(pdf)
            except Exception:  # noqa: BLE001 - fail-safe per batch (T3)
                if not (failsafe and same):
                    raise
                res = None
            yield pdf if res is None else res

    return df.mapInPandas(run, out_schema)


def land_failsafe(df: DataFrame, fn, path: str, compression: str = "zstd") -> dict:
    """T3 at run time: errors raised while the transformed rows are computed only
    surface in the write job; then the raw rows are landed instead and the error
    is returned for the run ledger. The failed attempt publishes nothing."""
    out, err = apply_failsafe(df, fn)
    if err is None:
        try:
            land_full(out, path, compression)
            return {"transformed": True, "error": None}
        except Exception as e:  # noqa: BLE001
            err = f"{type(e).__name__}: {e}"
    land_full(df, path, compression)
    return {"transformed": False, "error": err}
