"""Apply a fitted preparation to a stream.

Every ``apply_*`` step of the batch run is a stateless projection with fitted
literals (fill values, fences, kept columns) or a join with the static label
dictionary, so a preparation fitted on a batch runs unchanged on
``readStream``: no state store, no watermark.  The fits may come from the run
itself or, on another driver, from its store (``RunStore.load_fits``).  (The
reference has no streaming; this only reuses the batch operators on
micro-batches.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import features as FE
from ..operators import impute as IM
from ..operators import outliers as OU
from ..operators import select as SE
from ..operators import types as TY


def apply_fitted(df: DataFrame, fits: dict, outlier_action: str | None = None) -> DataFrame:
    """Replay the fitted stages of ``prepare(...).fits`` or ``store.load_fits(run_id)`` on any DataFrame, batch or
    streaming.  The outlier action is the saved run's unless given (``clip`` for fits that name none).  Labels join the
    dictionary table; a label that the fit has not seen becomes -1."""
    begun = fits.get("run", {})
    outlier_action = outlier_action or begun.get("outlier_action", "clip")
    t = fits["types"]
    out = TY.apply_types(df, t)
    out = IM.apply_impute(out, fits["missing"])
    if outlier_action == "drop":
        out = OU.drop_rows(out, fits["outliers"])
    else:
        out = OU.apply_outliers(out, fits["outliers"], outlier_action)
    enc = fits.get("encode", fits.get("features"))
    out, _ = FE.engineer(out, t.semantic, fits.get("polynomial", begun.get("polynomial", False)), encode_fit=enc)
    return SE.apply_select(out, fits["select"])


def start(stream: DataFrame, fits: dict, sink_path: str, checkpoint: str, outlier_action: str | None = None,
          trigger_once: bool = True):
    """Start an append-mode file sink of the prepared stream.  ``checkpoint``
    must be a shared folder so a restarted query resumes exactly once."""
    q = (apply_fitted(stream, fits, outlier_action).writeStream.format("parquet")
         .option("path", sink_path).option("checkpointLocation", checkpoint).outputMode("append"))
    q = q.trigger(availableNow=True) if trigger_once else q
    return q.start()
