"""Zone writers and catalog registration."""

from roadlake.sinks.writers import (register_table, run_folder, write_csv,
                                    write_landing, write_table)

__all__ = ["register_table", "run_folder", "write_csv", "write_landing", "write_table"]
