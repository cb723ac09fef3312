"""Ready-made queries over the driver's tables, each with an SQL counterpart.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` maps the
same name to SQL that DuckDB answers from the same Parquet tables.
"""

from . import bronze, capture, evolution, lineage, modelling, storage, vault  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
