from tallyboard.sinks.files import (append_new, append_table, land, overwrite_partitions, write_rank_csv,
                                    write_report_csv, write_table)
from tallyboard.sinks.ledger import BatchChangedError, append_batch, append_batch_jdbc, applied_batches, read_batches
from tallyboard.sinks.published import PublishConflict, current_version, drop_versions, publish, read_published
from tallyboard.sinks.relational import DatabaseWriteError, append_jdbc, existing_keys, new_rows

__all__ = ["BatchChangedError", "DatabaseWriteError", "PublishConflict", "append_batch", "append_batch_jdbc", "append_jdbc", "append_new",
           "append_table", "applied_batches", "current_version", "drop_versions", "existing_keys", "land", "new_rows", "overwrite_partitions",
           "publish", "read_batches", "read_published", "write_rank_csv", "write_report_csv", "write_table"]
