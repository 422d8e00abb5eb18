"""Sources: Parquet / JDBC / CSV / JSON scans and the stand-in activity profiles."""

from cohortlens.sources.activity import ActivityData  # noqa: F401
from cohortlens.sources.files import (  # noqa: F401
    read_csv,
    read_jdbc,
    read_json_map,
    read_json_records,
    read_metrics,
    read_table,
)
from cohortlens.sources.json_split import read_json_object  # noqa: F401
