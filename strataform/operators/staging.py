"""Extract: source table -> staging copy with lineage columns.

No business transformation: the staging table has the source columns (all
nullable) plus ``_source_table`` (the source table name) and ``_loaded_at``
(the load time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sources.io import conform


def extract(source: DataFrame, table: str) -> DataFrame:
    """Copy one source table to its staging shape (``INSERT .. SELECT`` of all
    source columns; lineage columns filled by their defaults)."""
    cols = [f.name for f in schemas.SOURCE[table].fields]
    staged = source.select(*cols).withColumns({
        "_source_table": F.lit(table),
        "_loaded_at": F.current_timestamp(),
    })
    return conform(staged, schemas.STAGING[f"stg_{table}"])

