from .files import peek_line, read_columnar, read_delimited, read_delimited_parts, reconcile_counts, write_and_read
from .tables import TABLES, table, use_all_slots

__all__ = ["TABLES", "peek_line", "read_columnar", "read_delimited", "read_delimited_parts", "reconcile_counts", "table", "use_all_slots",
           "write_and_read"]
