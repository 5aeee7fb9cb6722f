"""Sources and sinks: typed CSV/Parquet/table reads, script corpus, catalog writes, rules."""

from tablewatch.sources.catalog import (  # noqa: F401
    append_results,
    append_results_table,
    preview,
    read_results,
    table_inventory,
    write_table,
)
from tablewatch.sources.files import read_csv, read_job_scripts, read_scripts, read_table  # noqa: F401
from tablewatch.sources.metadata import create_metadata_tables  # noqa: F401
from tablewatch.sources.rules import ForeignKey, Rules, TableRule, load_rules, rules_from_dict  # noqa: F401
from tablewatch.sources.versioned import VersionedTable, current, repair, replace_table  # noqa: F401
