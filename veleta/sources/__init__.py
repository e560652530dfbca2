from veleta.sources.jdbc import jdbc_options, read_jdbc
from veleta.sources.pages import pages_to_records
from veleta.sources.tables import as_table, load_path, query, read_any, records_frame, scan

__all__ = [
    "as_table", "jdbc_options", "load_path", "pages_to_records", "query", "read_any",
    "read_jdbc", "records_frame", "scan",
]
