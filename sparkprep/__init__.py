"""sparkprep: standardise messy source tables into clean, versioned ones on Spark.

The main entry points, re-exported here:

* ``standardize_table(df, data_types, mask_data=None)`` - F1
* ``process_source(spark, spec, ...)`` - F2 (freshness, input, F1, snapshot)
* readers: ``read_delimited``, ``read_raw_lines``, ``read_table_query``,
  ``read_two_row_header``, ``read_latest``, ``read_on_date``, ``read_as_of``,
  ``read_named``; writer: ``write_snapshot``
* operators: ``lines_to_table``, ``mask_columns``, ``restrict_to_universe``,
  ``run_script``, ``run_sql_script``
"""

from .operators.lines import LineSpec, lines_to_table
from .operators.mask import mask_columns, mask_keyed
from .operators.relational import group_by_date_part, look_back, restrict_to_universe
from .plans.process import process_source, standardize_table
from .plans.script import register_aux, run_script, run_sql_script
from .session import get_spark
from .sources.delimited import read_delimited
from .sources.headers import drop_unnamed, flatten_multilevel_header, read_two_row_header
from .sources.jdbc import read_table_query
from .sources.raw_lines import read_raw_lines
from .sources.snapshots import read_as_of, read_latest, read_named, read_on_date, write_snapshot

__all__ = [
    "LineSpec", "drop_unnamed", "flatten_multilevel_header", "get_spark", "group_by_date_part", "lines_to_table",
    "look_back", "mask_columns", "mask_keyed", "process_source", "read_as_of", "read_delimited", "read_latest",
    "read_named", "read_on_date", "read_raw_lines", "read_table_query", "read_two_row_header", "register_aux",
    "restrict_to_universe", "run_script", "run_sql_script", "standardize_table", "write_snapshot",
]
