from veleta.sinks.tables import (
    assert_written, create_table, load_to_new_table, open_lakehouse, save_path, write_table,
)

__all__ = ["assert_written", "create_table", "load_to_new_table", "open_lakehouse", "save_path", "write_table"]
