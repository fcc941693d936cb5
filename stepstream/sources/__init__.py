from stepstream.sources.landing import BatchQueue, RowLanding
from stepstream.sources.rows import generate_rows, generate_rows_stream, int_range, literal_rows
from stepstream.sources.tables import read_table, table_stream
from stepstream.sources.text import text_stream

__all__ = [
    "BatchQueue",
    "RowLanding",
    "generate_rows",
    "generate_rows_stream",
    "int_range",
    "literal_rows",
    "read_table",
    "table_stream",
    "text_stream",
]
