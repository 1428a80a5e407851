"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: white space of the word rules ``[^\x20\x09-\x0D]+``
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: bytes table: A-Z to a-z, everything else as it is
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def id_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % divisor


def with_fields(fields, ddl: str) -> StructType:
    """Schema of the given fields followed by those of ``ddl``."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as a compressed Parquet table in the same shared folder."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"cut-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_alphabet() -> dict[str, int]:
    """Fixed rule of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes for U+0100 onwards."""
    plain = {b for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(lo, hi + 1)}
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


def map_slices(df: DataFrame, make: Callable[[], Callable], schema: str | StructType, rows: int = 512,
               most_bytes: int = 32_000_000, arrow: bool = False) -> DataFrame:
    """``mapInArrow`` in slices of at most ``rows`` rows (fewer where they hold more than ``most_bytes``).

    ``make()`` runs once per task and returns ``f(*columns) -> columns`` over
    Python lists (with ``arrow`` over Arrow arrays), so a task holds one slice
    of decoded texts at a time.  If ``f`` has an attribute ``finish``, its
    columns follow the last slice.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = to_arrow_schema(st)

    def run(batches):
        f = make()

        def batch(cols):
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kind.types)], schema=kind)

        for b in batches:
            for s in _slices(b, rows, most_bytes):
                yield batch(f(*[c if arrow else c.to_pylist() for c in s.columns]))
        finish = getattr(f, "finish", None)
        if finish is not None:
            yield batch(finish())

    return df.mapInArrow(run, st)


def _slices(batch: pa.RecordBatch, rows: int, most_bytes: int):
    at = 0
    while at < batch.num_rows:
        part = batch.slice(at, rows)
        while part.num_rows > 1 and part.nbytes > most_bytes:
            part = part.slice(0, part.num_rows // 2)
        yield part
        at += part.num_rows
