from podium.sources.published import Version, publish_parquet, read_published, versions
from podium.sources.scratch import (
    materialize,
    remove,
    scratch_dir,
    scratch_root,
    scratch_scope,
    session_settings,
)
from podium.sources.tables import (
    RejectedRows,
    list_files,
    read_csv,
    read_csv_checked,
    read_parquet,
    results_manifest,
    write_parquet,
)

__all__ = [
    "RejectedRows",
    "Version",
    "list_files",
    "materialize",
    "publish_parquet",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "read_published",
    "remove",
    "results_manifest",
    "scratch_dir",
    "scratch_root",
    "scratch_scope",
    "session_settings",
    "versions",
    "write_parquet",
]
