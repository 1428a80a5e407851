"""Fitted state of a run as a table: saved stage by stage, loaded by a resumed run, a stream or another driver (A5, I2, I3).

Every fit is a few values per column.  Each is one row of the store's log with
its version and its body, JSON in which every value that JSON cannot hold
carries its type.  The label dictionary may
be large: it stays a Parquet table in the store and the body names its folder.
"""

from __future__ import annotations

import base64
import dataclasses
import datetime
import decimal
import json
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import EncodeFit
from ..operators.impute import ColumnAction, ImputeFit
from ..operators.outliers import Fence, OutlierFit
from ..operators.profile import AuditFit
from ..operators.select import SelectFit
from ..operators.types import TypesFit

VERSION = 1
KINDS = {k.__name__: k for k in (AuditFit, TypesFit, ColumnAction, ImputeFit, Fence, OutlierFit, EncodeFit, SelectFit)}
_CODES = "column string, value string, code int"


class FitVersionError(ValueError):
    """A saved fit of a form that this version does not read."""


def pack(value):
    """JSON form of a value; what JSON lacks is ``{"__": type, ...}``."""
    if dataclasses.is_dataclass(value):
        return {"__": type(value).__name__,
                "fields": {f.name: pack(getattr(value, f.name)) for f in dataclasses.fields(value)}}
    if isinstance(value, dict):                     # keys may be None or no text: pairs
        return {"__": "dict", "items": [[pack(k), pack(v)] for k, v in value.items()]}
    if isinstance(value, tuple):
        return {"__": "tuple", "items": [pack(v) for v in value]}
    if isinstance(value, list):
        return [pack(v) for v in value]
    if isinstance(value, datetime.datetime):
        return {"__": "datetime", "text": value.isoformat()}
    if isinstance(value, datetime.date):
        return {"__": "date", "text": value.isoformat()}
    if isinstance(value, decimal.Decimal):
        return {"__": "decimal", "text": str(value)}
    if isinstance(value, (bytes, bytearray)):
        return {"__": "bytes", "text": base64.b64encode(value).decode()}
    if isinstance(value, float) and not (float("-inf") < value < float("inf")):
        return {"__": "float", "text": repr(value)}
    if hasattr(value, "item"):                      # a numpy scalar
        return pack(value.item())
    if value is None or isinstance(value, (str, int, float, bool)):
        return value
    raise TypeError(f"a fit holds a {type(value).__name__}, which has no saved form")


def unpack(value):
    if isinstance(value, list):
        return [unpack(v) for v in value]
    if not isinstance(value, dict):
        return value
    kind = value["__"]
    if kind == "dict":
        return {unpack(k): unpack(v) for k, v in value["items"]}
    if kind == "tuple":
        return tuple(unpack(v) for v in value["items"])
    if kind in KINDS:
        return KINDS[kind](**{k: unpack(v) for k, v in value["fields"].items()})
    read = {"datetime": datetime.datetime.fromisoformat, "date": datetime.date.fromisoformat, "decimal": decimal.Decimal,
            "bytes": base64.b64decode, "float": float}
    return read[kind](value["text"])


def saved_form(root: str, run_id: str, fit) -> str:
    """JSON of one fit.  A dictionary is copied into the store first, so no row names a folder that is not there."""
    extra = {}
    if isinstance(fit, EncodeFit) and fit.table is not None:
        path = os.path.join(root, "dictionaries", run_id, uuid.uuid4().hex)
        fit.table.select("column", "value", "code").write.partitionBy("column").parquet(path)
        fit, extra = dataclasses.replace(fit, table=None), {"dictionary": path}
    return json.dumps({"fit": pack(fit), **extra})


def read_fits(table: DataFrame, run_id: str) -> dict:
    """``{stage: fit}`` of a run, the latest of each stage; one row per stage reaches the driver."""
    spark, out = table.sparkSession, {}
    latest = table.where(F.col("run_id") == run_id).groupBy("stage").agg(
        F.max_by(F.struct(F.col("metric").alias("version"), F.col("value").alias("body")), "at").alias("x"))
    for r in latest.select("stage", "x.*").collect():
        if r["version"] != str(VERSION):
            raise FitVersionError(f"stage {r['stage']!r} of run {run_id!r} was saved in version {r['version']}; "
                                  f"this one reads {VERSION}")
        body = json.loads(r["body"])
        fit = unpack(body["fit"])
        if "dictionary" in body:
            fit = dataclasses.replace(fit, table=spark.read.schema(_CODES).parquet(body["dictionary"]))
        out[r["stage"]] = fit
    return out
