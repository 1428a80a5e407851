"""tableprep: table preparation for machine learning on Spark.

Main entry points::

    from tableprep import prepare, read_any
    res = prepare(read_any(spark, path, "parquet"), target="label")
"""

from .plans.prepare import Prepared, StageError, prepare
from .sources.ingest import read_any

__all__ = ["prepare", "Prepared", "StageError", "read_any"]
__version__ = "0.1.0"
