from .files import flat_for_csv, with_row_index, write_csv, write_snapshot
from .jdbc import write_jdbc
from .tables import CommitConflict, TableStore

__all__ = ["flat_for_csv", "with_row_index", "write_csv", "write_snapshot", "write_jdbc",
           "CommitConflict", "TableStore"]
