from tallyboard.streaming.ingest import (BatchSink, append_batches, append_named_objects, append_new_to_jdbc,
                                         event_keys, ingest_new_files)
from tallyboard.streaming.notices import NoticeSink, land_noticed_objects, landed_objects, missing_objects
from tallyboard.streaming.ranks import stream_rank_history

__all__ = ["BatchSink", "NoticeSink", "append_batches", "append_named_objects", "append_new_to_jdbc", "event_keys", "ingest_new_files",
           "land_noticed_objects", "landed_objects", "missing_objects", "stream_rank_history"]
