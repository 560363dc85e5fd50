"""tidelog — fast log ingest into queryable Parquet tables, on Spark.

JSON log records are decoded under a declared schema, given event-date,
application and batch-minute partitions and appended as partitioned Parquet
per micro-batch; a logical table unions the fresh write area with a
compacted read area so that every row is visible exactly once; a compaction
job folds committed batches into larger files and publishes the result in
one atomic step while ingest keeps running.
"""

from tidelog.functions.decode import decode_json
from tidelog.functions.derive import derive_partitions
from tidelog.plans.compact import compact, vacuum
from tidelog.plans.table import LogicalTable, PublishConflict, State, TableMissing
from tidelog.session import build_session, prepare, shared_dir
from tidelog.sources.schema import TableSpec, from_catalog, from_template
from tidelog.streaming.apps import compaction_app, ingest_app
from tidelog.streaming.ingest import decode_and_derive, ingest_batch, start_ingest

__all__ = [
    "LogicalTable", "PublishConflict", "State", "TableMissing", "TableSpec",
    "build_session", "compact", "compaction_app", "decode_and_derive", "ingest_app", "decode_json", "derive_partitions",
    "from_catalog", "from_template", "ingest_batch", "prepare", "shared_dir",
    "start_ingest", "vacuum",
]
