"""cellfold: tables <-> a schema-independent key-value form, on Spark.

Every cell of a table becomes one row ``(key = "id,num", val = text)``; the
table's name and column types travel in the same two-column shape (row id 0),
so any table can be stored and merged as one uniform dataset and later
restored to its exact schema.
"""

from cellfold.operators.columns import (
    any_column_matches,
    clear_columns,
    id_num_columns,
    prefix_columns,
    rows_matching,
    string_columns,
)
from cellfold.operators.ids import with_row_ids
from cellfold.operators.keyvalue import (
    cells_to_key_value,
    combined_cells,
    combined_export,
    key_value_columns,
    melt_cells,
    meta_cells,
    meta_columns,
    number_cells,
    plain_columns,
    restore,
    restore_key_value,
    schema_frame,
    schema_name,
)
from cellfold.operators.nested import (
    array_column,
    array_to_struct,
    convert_struct_column,
    explode_column,
    split_struct_column,
)
from cellfold.operators.partitions import (
    add_partition_column,
    max_partition_length,
    partitions_length,
)

from cellfold.operators.audit import audit_round_trip, describe_table
from cellfold.operators.partitions import spread_input
from cellfold.plans.jobs import (
    load_key_value,
    read_cells,
    read_key_value,
    restore_table,
    write_key_value,
)
from cellfold.session import Stages
from cellfold.sinks.csv import write_csv
from cellfold.sinks.workbook import write_workbooks
from cellfold.sinks.zipped import write_zipped_csv
from cellfold.sources.csv import read_csv
from cellfold.sources.workbook import read_workbooks
from cellfold.sources.zipped import read_zipped_csv
from cellfold.streaming.melt import start_key_value_stream, stream_key_value

__version__ = "0.1.0"
