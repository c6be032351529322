"""Reporting over entity-attribute-value records, on Spark DataFrames.

`sources` loads the tables, `functions` holds column expressions, `operators`
the reusable DataFrame steps, `plans` the reports and `catalog` the queries
that are checked against SQL.
"""

from wardline.sources.tables import (
    Tables,
    from_catalog,
    from_frames,
    from_jdbc,
    from_parquet,
    ignoring_case,
    plain_text,
    without_deleted,
)

__all__ = [
    "Tables",
    "from_catalog",
    "from_frames",
    "from_jdbc",
    "from_parquet",
    "ignoring_case",
    "plain_text",
    "without_deleted",
]
