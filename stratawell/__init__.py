"""Layered ingestion and reporting on Spark.

Landing files and event streams -> append-only raw layer -> refined layer ->
the aggregated tables a dashboard reads.  Every function takes and returns
ordinary Spark DataFrames; only sinks and namespaces have side effects.
"""

from stratawell.functions.cleaning import Field
from stratawell.functions.measures import (
    distinct_count,
    exact_avg,
    exact_sum,
    row_count,
)
from stratawell.operators.bronze import bronze_append, with_lineage
from stratawell.operators.conform import conform, split_valid, tag_valid
from stratawell.operators.decode import decode_json
from stratawell.operators.dedup import dedup
from stratawell.operators.incremental import (
    high_water_mark,
    new_keys,
    read_since,
    redeal_partitions,
    upsert,
    upsert_partitions,
)
from stratawell.operators.key_filter import append_new
from stratawell.operators.namespace import create_layers
from stratawell.operators.offsets import Offsets, commit_offsets, offset_ranges, take_offsets
from stratawell.operators.reporting import headline, measures, time_series, top_n
from stratawell.operators.row_rules import Refers, Unique, Usual, tag_row_rules
from stratawell.operators.series import filled_series, running, trailing
from stratawell.plans.clustered import curve_place, read_clustered, write_clustered
from stratawell.plans.dashboard import (
    Grouped,
    Headline,
    Ranking,
    Series,
    dashboard_dataset,
)
from stratawell.plans.history import change_points, read_history, update_history
from stratawell.plans.panels import Measure, merge_loads, read_panels, update_panels
from stratawell.plans.silver import Silver, SilverRules, read_silver, silver_build, silver_update
from stratawell.plans.snapshots import read_snapshot, snapshot_changes, store_snapshot
from stratawell.sources.drift import drift_report, widened
from stratawell.sources.events import ENVELOPE, event_replay, event_stream
from stratawell.sources.files import csv_source, file_stream, read_layer
from stratawell.streaming.dedup import dedup_stream, rows_without_time
from stratawell.streaming.late import ingest_deduplicated, stored_watermark
from stratawell.streaming.sink import Taken, ingest_incremental, stream_sink

__all__ = [
    "ENVELOPE",
    "Field",
    "Grouped",
    "Headline",
    "Measure",
    "Offsets",
    "Ranking",
    "Refers",
    "Series",
    "Silver",
    "SilverRules",
    "Taken",
    "Unique",
    "Usual",
    "append_new",
    "bronze_append",
    "change_points",
    "commit_offsets",
    "conform",
    "create_layers",
    "csv_source",
    "curve_place",
    "dashboard_dataset",
    "decode_json",
    "dedup",
    "dedup_stream",
    "distinct_count",
    "drift_report",
    "event_replay",
    "event_stream",
    "exact_avg",
    "exact_sum",
    "file_stream",
    "filled_series",
    "headline",
    "high_water_mark",
    "ingest_deduplicated",
    "ingest_incremental",
    "measures",
    "merge_loads",
    "new_keys",
    "offset_ranges",
    "read_clustered",
    "read_history",
    "read_layer",
    "read_panels",
    "read_silver",
    "read_since",
    "read_snapshot",
    "redeal_partitions",
    "row_count",
    "rows_without_time",
    "running",
    "silver_build",
    "silver_update",
    "snapshot_changes",
    "split_valid",
    "store_snapshot",
    "stored_watermark",
    "stream_sink",
    "tag_row_rules",
    "tag_valid",
    "take_offsets",
    "time_series",
    "top_n",
    "trailing",
    "update_history",
    "update_panels",
    "upsert",
    "upsert_partitions",
    "widened",
    "with_lineage",
    "write_clustered",
]
