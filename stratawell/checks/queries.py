"""One query per operator, over the given tables.

Each takes (spark, sf_dir), stages what it needs in a fresh workspace, runs the
operator over the whole of it and returns a DataFrame.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import stratawell as sw
from stratawell.checks import fixtures as fx
from stratawell.functions.storage import workspace
from stratawell.plans import panels

MARK = datetime.datetime(2024, 1, 15)
REPEAT_DELAY = "10 days"
MAX_BYTES = 64 << 20

TYPED_EVENT = [
    sw.Field("event_id", "bigint"),
    sw.Field("ts", "timestamp_ntz"),
    sw.Field("user_id", "bigint"),
    sw.Field("event_type", lower=True),
    sw.Field("value", "double"),
]


def _valid_event() -> dict[str, Column]:
    return {"ts": F.col("ts").isNotNull(), "value": F.col("value").isNotNull()}


def _order_figures() -> dict[str, Column]:
    return {"n": sw.row_count(), "revenue": sw.exact_sum("o_totalprice", 2)}


def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    path = fx.stage_csv(orders, f"{workspace(spark)}/csv")
    return sw.csv_source(spark, path, orders.schema, **fx.TIME_FORMAT)


def malformed_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    path = fx.stage_csv(fx.dirty_orders(orders), f"{workspace(spark)}/csv")
    return sw.csv_source(
        spark, path, orders.schema, corrupt_col="_corrupt", **fx.TIME_FORMAT
    ).select(*orders.columns, F.col("_corrupt").isNotNull().alias("is_corrupt"))


def _landed(spark: SparkSession, landing: str, schema: T.StructType) -> DataFrame:
    return sw.file_stream(spark, landing, "json", schema, **fx.TIME_FORMAT)


def file_stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    fx.land_events(events, f"{work}/landing")
    stream = _landed(spark, f"{work}/landing", events.schema)
    sw.ingest_incremental(stream, f"{work}/layer", f"{work}/checkpoint")
    return sw.read_layer(spark, f"{work}/layer")


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    arrivals = [(0, 1), (2, 3), ()]
    for run_no, parts in enumerate(arrivals, start=1):
        if parts:
            fx.land_events(events, f"{work}/landing", parts)
        stream = _landed(spark, f"{work}/landing", events.schema)
        stream = stream.withColumn("run_no", F.lit(run_no))
        sw.ingest_incremental(stream, f"{work}/layer", f"{work}/checkpoint")
    layer = sw.read_layer(spark, f"{work}/layer")
    counted = [
        F.count_if(F.col("run_no") == n).alias(f"added_{n}") for n in range(1, len(arrivals) + 1)
    ]
    runs = F.array(
        *[
            F.struct(
                F.lit(n).alias("run_no"),
                F.col(f"added_{n}").alias("rows_added"),
                sum((F.col(f"added_{m}") for m in range(1, n + 1)), F.lit(0)).alias("rows_total"),
            )
            for n in range(1, len(arrivals) + 1)
        ]
    )
    return layer.agg(*counted).select(F.inline(runs))


def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    fx.land_events(events, f"{work}/landing")
    for _ in range(2):
        query = sw.stream_sink(
            _landed(spark, f"{work}/landing", events.schema), f"{work}/layer", f"{work}/checkpoint"
        )
        query.awaitTermination()
    return sw.measures(
        sw.read_layer(spark, f"{work}/layer"),
        ["event_type"],
        {"n": sw.row_count(), "distinct_ids": sw.distinct_count("event_id")},
    )


def _replayed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    fx.stage_parquet(fx.event_envelopes(events), f"{work}/archive")
    return sw.event_replay(spark, f"{work}/archive"), work


def event_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, work = _replayed(spark, sf_dir)
    sw.ingest_incremental(stream, f"{work}/layer", f"{work}/checkpoint")
    return sw.measures(
        sw.read_layer(spark, f"{work}/layer"),
        ["topic", F.col("partition").alias("partition_id")],
        {
            "n": sw.row_count(),
            "first_offset": F.min("offset"),
            "last_offset": F.max("offset"),
        },
    )


def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, work = _replayed(spark, sf_dir)
    schema = fx.table(spark, sf_dir, "events").schema
    decoded = sw.decode_json(stream, schema, raw_col="raw", **fx.TIME_FORMAT)
    sw.ingest_incremental(decoded, f"{work}/layer", f"{work}/checkpoint")
    corrupt = F.col("_corrupt").isNotNull()
    return sw.read_layer(spark, f"{work}/layer").select(
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("event_offset"),
        *[F.when(~corrupt, F.col(c)).alias(c) for c in schema.names],
        corrupt.alias("corrupt"),
        F.col("raw").isNotNull().alias("has_payload"),
    )


def _drifting(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, T.StructType]:
    """Landed events of which some have fields outside the schema, and that schema."""
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    fx.land_drifting_events(events, f"{work}/landing")
    stream = sw.file_stream(
        spark, f"{work}/landing/wave=*", "json", events.schema, rest_col="rest", **fx.TIME_FORMAT
    )
    sw.ingest_incremental(sw.with_lineage(stream), f"{work}/layer", f"{work}/checkpoint")
    layer = sw.read_layer(spark, f"{work}/layer")
    return layer.withColumn("wave", F.regexp_extract("source_file", "wave=([0-9])", 1)), events.schema


def rest_of_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields outside the schema come through as they landed."""
    landed, _ = _drifting(spark, sf_dir)
    return landed.select(
        "event_id",
        "value",
        "wave",
        F.col("rest")["zz"].cast("string").alias("zz"),
        F.variant_get(F.col("rest")["more"], "$.p", "bigint").alias("p"),
    )


def field_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields came outside the schema in which files, of what type, and the schema with them."""
    landed, schema = _drifting(spark, sf_dir)
    report = sw.drift_report(landed, "rest", "wave").withColumnRenamed("file", "wave")
    new = sw.widened(landed, "rest", schema).fields[len(schema) :]
    wide = [("all", field.name, field.dataType.simpleString(), 0) for field in new]
    return report.unionByName(spark.createDataFrame(wide, report.schema))


def offset_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over an archive that holds a replay and a gap; the replay is dropped."""
    work = workspace(spark)
    reports = []
    for run, envelopes in enumerate(fx.offset_runs(fx.table(spark, sf_dir, "events")), start=1):
        archive = fx.stage_parquet(envelopes, f"{work}/archive{run}")
        taken = sw.take_offsets(spark.read.parquet(archive), f"{work}/offsets", block=512)
        taken.events.write.mode("append").parquet(f"{work}/bronze")
        reports.append(taken.report.select(F.lit(run).alias("run"), "*"))
        sw.commit_offsets(spark, taken)
    counted = spark.read.parquet(f"{work}/bronze").groupBy("topic", "partition")
    events = counted.agg(F.count(F.lit(1)).alias("first"), F.count_distinct("offset").alias("last"))
    reports.append(events.select(F.lit(0).alias("run"), "*", F.lit("events").alias("kind")))
    found = reduce(DataFrame.unionByName, reports)
    return found.drop("topic").withColumnRenamed("partition", "partition_id")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    fx.land_events(events, f"{work}/landing")
    stream = sw.with_lineage(_landed(spark, f"{work}/landing", events.schema))
    sw.ingest_incremental(stream, f"{work}/layer", f"{work}/checkpoint")
    return sw.read_layer(spark, f"{work}/layer").select(
        "event_id",
        F.col("source_file").contains("/landing/").alias("has_file"),
        (F.col("source_time") <= F.col("ingested_at")).alias("has_times"),
    )


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that are repeated with fewer partitions, and with no rows; codes keep their zeros.

    A call without a load is refused, as readers would not see its rows.
    """
    event_id = F.col("event_id").cast("bigint")
    code = F.element_at(F.array(F.lit("007"), F.lit(""), F.lit("12")), (event_id % 3 + 1).cast("int"))
    dirty = fx.dirty_events(fx.table(spark, sf_dir, "events")).withColumn("code", code)
    out = f"{workspace(spark)}/bronze"
    loads = [
        (0, event_id % 2 == 0),
        (1, event_id % 2 == 1),
        (2, event_id % 5 == 0),
        (0, (event_id % 2 == 0) & (code == "007")),
        (2, F.lit(False)),
    ]
    for load, rows in loads:
        sw.bronze_append(dirty.filter(rows), out, load, partition_by=["code"])
    for other in ({}, {"partition_by": ["code"]}, {"load": 3}):
        try:
            sw.bronze_append(dirty, out, **other)
        except ValueError:
            continue
        raise AssertionError(f"{out} took rows that cannot be read: {other}")
    return sw.read_layer(spark, out)


def create_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = workspace(spark)
    run = work.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    layers = {f"bronze_{run}": "bronze", f"silver_{run}": "silver"}
    sw.create_layers(spark, layers, work)
    events = fx.table(spark, sf_dir, "events")
    fx.dirty_events(events).write.saveAsTable(f"bronze_{run}.events")
    bronze = spark.table(f"bronze_{run}.events")
    silver, quarantined = sw.silver_build(bronze, _event_rules(), f"{work}/judged")
    silver.write.saveAsTable(f"silver_{run}.events")
    quarantined.write.saveAsTable(f"silver_{run}.quarantined_events")
    tables = {
        "bronze": f"bronze_{run}.events",
        "silver": f"silver_{run}.events",
        "quarantined": f"silver_{run}.quarantined_events",
    }
    counts = [
        spark.table(table).agg(sw.row_count().alias("n")).select(F.lit(layer).alias("layer"), "n")
        for layer, table in tables.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def layer_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{workspace(spark)}/bronze"
    fx.stage_parquet(fx.table(spark, sf_dir, "lineitem"), out)
    return (
        sw.read_layer(spark, out).filter(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity")
    )


def _bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = fx.dirty_events(fx.table(spark, sf_dir, "events"))
    return sw.read_layer(spark, fx.stage_parquet(dirty, f"{workspace(spark)}/bronze"))


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.conform(_bronze_events(spark, sf_dir), [*TYPED_EVENT, sw.Field("props")])


def validity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = sw.conform(_bronze_events(spark, sf_dir), TYPED_EVENT)
    accepted, quarantined = sw.split_valid(typed, _valid_event())
    sides = accepted.select(F.lit("accepted").alias("outcome"), F.lit("").alias("reason")).unionByName(
        quarantined.select(
            F.lit("quarantined").alias("outcome"), F.array_join("reasons", ",").alias("reason")
        )
    )
    return sw.measures(sides, ["outcome", "reason"], {"n": sw.row_count()})


def _event_rules() -> sw.SilverRules:
    k = F.get_json_object("props", "$.k")
    return sw.SilverRules(
        mapping=[*TYPED_EVENT, sw.Field("k", "int", source=k)],
        valid=_valid_event(),
        keys=["event_id"],
        order=[F.col("ts").desc()],
    )


def _both_sides(silver: sw.Silver) -> DataFrame:
    names = [c for c in silver.accepted.columns]
    accepted = silver.accepted.select(
        F.lit("accepted").alias("outcome"),
        *names,
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("raw_value"),
        F.lit(None).cast("string").alias("raw_id"),
    )
    quarantined = silver.quarantined.select(
        F.lit("quarantined").alias("outcome"),
        *names,
        F.array_join("reasons", ",").alias("reason"),
        F.get_json_object("raw", "$.value").alias("raw_value"),
        F.get_json_object("raw", "$.event_id").alias("raw_id"),
    )
    return accepted.unionByName(quarantined)


def silver_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    out = f"{work}/bronze"
    fx.stage_parquet(fx.dirty_events(events), out)
    fx.stage_parquet(
        fx.dirty_events(events.filter(F.col("event_id") % fx.REVISED_EVERY == 0)), out
    )
    bronze = sw.read_layer(spark, out)
    return _both_sides(sw.silver_build(bronze, _event_rules(), f"{work}/silver"))


def silver_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that are replaced and emptied after they were taken: equal to a full rebuild.

    The first comes with wrong rows at first, and with too few; the second has newer versions of some
    events; the third is taken back.
    """
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    out = f"{work}/bronze"
    wrong = events.filter(F.col("event_id") % 3 != 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    more = later.withColumn("event_id", F.col("event_id") + 5_000_000)
    loads = [
        (0, wrong),
        (1, fx.revised_events(events)),
        (2, later.filter(F.col("event_id") % 4 == 0).unionByName(more)),
        (0, events),
        (2, events.limit(0)),
    ]
    for load, rows in loads:
        sw.bronze_append(fx.dirty_events(rows), out, load)
        bronze = sw.read_layer(spark, out)
        sw.silver_update(bronze, _event_rules(), f"{work}/silver", "load_no", buckets=8)
    return _both_sides(sw.read_silver(bronze, _event_rules(), f"{work}/silver"))


def key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of 50 keys, some of them deletions, arriving late, in turns and twice."""
    event_id = F.col("event_id")
    changes = fx.table(spark, sf_dir, "events").select(
        (event_id % 50).alias("user_id"),
        # cut to the hour, so that keys have several changes at one time
        F.expr("ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts))").alias("ts"),
        "event_id",
        "event_type",
        "value",
        (event_id % 7 == 3).alias("gone"),
    )
    path = f"{workspace(spark)}/history"
    for turn in (2, 0, 1, 0):
        some = changes.filter(event_id % 3 == turn)
        newest = [F.col("event_id").desc()]
        sw.update_history(spark, path, some, ["user_id"], "ts", "gone", newest, buckets=8)
    readings = {"all": sw.read_history(spark, path), "as_of": sw.read_history(spark, path, MARK)}
    named = [rows.select(F.lit(name).alias("reading"), "*") for name, rows in readings.items()]
    return named[0].unionByName(named[1])


def _order_copies(spark: SparkSession, sf_dir: str) -> str:
    """The orders, and then a copy with some changed, some gone, some new and some twice."""
    orders = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = F.when(key % 500 == 7, "X").otherwise(F.col("o_orderstatus"))
    new = orders.filter(key % 300 == 11).withColumn("o_orderkey", key + 10_000_000)
    later = orders.filter(key % 400 != 9).withColumn("o_orderstatus", status)
    later = later.unionByName(new).unionByName(orders.filter(key % 1000 == 50))
    path = f"{workspace(spark)}/copies"
    for copy in (orders, later):
        sw.store_snapshot(copy, ["o_orderkey"], path, buckets=256)
    return path


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.snapshot_changes(spark, _order_copies(spark, sf_dir), 1, 2)


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.read_snapshot(spark, _order_copies(spark, sf_dir))


def dedup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    versions = events.unionByName(fx.revised_events(events))
    return sw.dedup(versions, ["event_id"], [F.col("ts").desc()])


@contextmanager
def _state_partitions(spark: SparkSession) -> Iterator[None]:
    """No more state partitions than cores: each is opened and committed in every batch."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    work = workspace(spark)
    for wave in fx.repeat_waves(events):
        fx.stage_parquet(wave, f"{work}/landing")
        with _state_partitions(spark):
            stream = sw.file_stream(
                spark, f"{work}/landing", "parquet", events.schema, max_bytes=MAX_BYTES
            )
            once = sw.dedup_stream(stream, ["event_id"], "ts", REPEAT_DELAY)
            sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
    return sw.read_layer(spark, f"{work}/layer").select("event_id", "event_type")


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with repeats, and at the end old and untimed ones: these are kept, repeats are not."""
    events = fx.table(spark, sf_dir, "events")
    event_id = F.col("event_id")
    quarter = events.agg(F.max(event_id)).first()[0] // 4
    old = events.filter((event_id % 10 == 3) & (event_id < quarter))
    untimed = events.filter(event_id % 50 == 7).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    last = old.withColumn("event_id", event_id + 10_000_000).unionByName(
        untimed.withColumn("event_id", event_id + 20_000_000)
    )
    work = workspace(spark)
    for wave in [*fx.repeat_waves(events), last]:
        fx.stage_parquet(wave, f"{work}/landing")
        with _state_partitions(spark):
            stream = sw.file_stream(
                spark, f"{work}/landing", "parquet", events.schema, max_bytes=MAX_BYTES
            )
            sw.ingest_deduplicated(
                stream, ["event_id"], "ts", REPEAT_DELAY, f"{work}/layer", f"{work}/checkpoint"
            )
    return sw.read_layer(spark, f"{work}/layer").select("outcome", "event_id", "event_type")


def read_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.read_since(fx.table(spark, sf_dir, "events"), "ts", MARK)


def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    loaded = orders.filter(F.col("o_orderkey") % 3 != 0)
    return sw.new_keys(orders, loaded, ["o_orderkey"])


def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of orders, the later ones mostly known already; each key keeps its first row."""
    orders = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    path = f"{workspace(spark)}/table"
    loads = [(key % 3 != 0, None), (key % 7 != 0, "L2"), (F.lit(True), "L3"), (key % 5 == 0, "L4")]
    for rows, status in loads:
        some = orders.filter(rows)
        some = some if status is None else some.withColumn("o_orderstatus", F.lit(status))
        sw.append_new(spark, path, some, ["o_orderkey"], expected_keys=200_000, buckets=8)
    return sw.read_layer(spark, path)


def row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come twice under other ids, of users that are not known, or with odd values."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    event_id = F.col("event_id")
    again = events.filter(event_id % 50 == 0).withColumn("event_id", event_id + 1_000_000)
    odd = events.filter(event_id % 500 == 1).withColumn("event_id", event_id + 3_000_000)
    odd = odd.withColumn("value", F.lit(1e9))
    users = events.select("user_id").filter(F.col("user_id") % 9 != 4)
    path = f"{workspace(spark)}/events"
    rows = spark.read.parquet(fx.stage_parquet(events.unionByName(again).unionByName(odd), path))
    rules = {
        "twice": sw.Unique(["user_id", "value"], "event_id"),
        "user": sw.Refers(["user_id"], users),
        "odd": sw.Usual("value", 1000.0),
    }
    tagged = sw.tag_row_rules(rows, rules)
    # The bounds of the sketch are its own.
    reasons = F.transform("reasons", lambda r: F.regexp_replace(r, "^odd:.*", "odd"))
    return tagged.select("event_id", F.array_join(reasons, ",").alias("reasons"))


def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines clustered by part and date, read by ranges of both; most files are not opened."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    path = f"{workspace(spark)}/lines"
    sw.write_clustered(lines, path, ["l_partkey", "l_shipdate"], files=32)
    dates = datetime.datetime(1995, 1, 1), datetime.datetime(1996, 3, 31)
    rows = sw.read_clustered(spark, path, {"l_partkey": (50, 90), "l_shipdate": dates})
    read, there = len(rows.inputFiles()), len(sw.read_clustered(spark, path).inputFiles())
    if 3 * read > there:
        raise AssertionError(f"{read} of {there} files are read")
    return rows


def _event_changes(events: DataFrame) -> DataFrame:
    added = events.filter(F.col("event_id") % 50 == 0).withColumn(
        "event_id", F.col("event_id") + 1_000_000
    )
    return fx.revised_events(events).unionByName(added)


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    return sw.upsert(events, _event_changes(events), ["event_id"], [F.col("ts").desc()])


def upsert_unique_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target with repeated keys, some of them changed; no broadcast.  Unchanged ones stay."""
    events = fx.table(spark, sf_dir, "events")
    again = events.filter(F.col("event_id") % 4 == 0)
    target = events.unionByName(again)
    newest = [F.col("ts").desc()]
    return sw.upsert(target, _event_changes(events), ["event_id"], newest, broadcast_rows=0)


def upsert_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes some of which remove their key, into a stored table, the same ones twice."""
    events = fx.table(spark, sf_dir, "events")
    changes = fx.revised_events(events).withColumn("gone", F.col("event_id") % 20 == 0)
    path, newest = f"{workspace(spark)}/table", [F.col("ts").desc()]
    sw.upsert_partitions(spark, path, events, ["event_id"], newest, buckets=8)
    for _ in range(2):
        sw.upsert_partitions(spark, path, changes, ["event_id"], newest, buckets=8, deleted="gone")
    return sw.read_layer(spark, path)


def grouped_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.measures(
        fx.table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "n": sw.row_count(),
            "qty": sw.exact_sum("l_quantity", 2),
            "price": sw.exact_sum("l_extendedprice", 2),
        },
    )


def time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.time_series(
        fx.table(spark, sf_dir, "orders"), "o_orderdate", "month", _order_figures()
    )


def filled_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a tenth of the customers, empty ones included, with running and trailing figures."""
    orders = fx.table(spark, sf_dir, "orders").filter(F.col("o_custkey") % 10 == 3)
    price = F.col("o_totalprice").cast("decimal(18,2)")
    dims = ["o_orderstatus"]
    figures = {"n": sw.row_count(), "revenue": F.sum(price)}
    series = sw.filled_series(orders, "o_orderdate", "month", figures, dims, fill={"n": 0})
    path = f"{workspace(spark)}/series"
    series.write.parquet(path)
    series = spark.read.parquet(path)
    so_far = sw.running(series, {"n_so_far": "n", "revenue_so_far": "revenue"}, dims, block=16)
    recent = {"n_quarter": F.sum("n"), "best": F.max("revenue")}
    done = sw.trailing(so_far, 3, recent, dims, block=16)
    money = ("revenue", "revenue_so_far", "best")
    done = done.withColumns({name: F.col(name).cast("double") for name in money})
    return done.withColumn("nr", F.col("nr").cast("bigint"))


def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.headline(
        fx.table(spark, sf_dir, "orders"),
        {**_order_figures(), "customers": sw.distinct_count("o_custkey")},
    )


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.top_n(
        fx.table(spark, sf_dir, "orders"),
        ["o_custkey"],
        {"revenue": sw.exact_sum("o_totalprice", 2)},
        10,
    )


def dashboard_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "by_status": sw.Grouped(["o_orderstatus", "o_orderpriority"], _order_figures()),
        "by_month": sw.Series("o_orderdate", "month", _order_figures(), ["o_orderstatus"]),
        "totals": sw.Headline(_order_figures()),
        "largest": sw.Ranking(["o_custkey"], {"revenue": sw.exact_sum("o_totalprice", 2), "n": sw.row_count()}, 10),
    }
    tables = sw.dashboard_dataset(fx.table(spark, sf_dir, "orders"), spec, f"{workspace(spark)}/panels")
    return _in_one(tables, ["n", "revenue"])


def _in_one(panels: dict[str, DataFrame], figures: list[str]) -> DataFrame:
    """All panels as one table, with NULL for what a panel has not."""
    dims = {
        "o_orderstatus": "string",
        "o_orderpriority": "string",
        "month": "date",
        "o_custkey": "bigint",
    }
    named = [
        rows.select(
            F.lit(name).alias("panel"),
            *[
                (F.col(dim) if dim in rows.columns else F.lit(None).cast(kind)).alias(dim)
                for dim, kind in dims.items()
            ],
            *figures,
        )
        for name, rows in panels.items()
    ]
    return reduce(DataFrame.unionByName, named)


def dashboard_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panels over four loads, two of which come again; equal to panels of all orders.

    The sketches are compared with exact figures, as they are not the same in SQL: within five
    standard errors for distinct values, and within 3 per cent of ranks for the median.
    """
    orders = fx.table(spark, sf_dir, "orders")
    figures = {
        "n": panels.rows(),
        "revenue": panels.total("o_totalprice", 2),
        "most": panels.largest("o_totalprice"),
    }
    about = {
        "customers": panels.about_distinct("o_custkey"),
        "median": panels.about_quantile("o_totalprice", 0.5),
    }
    spec = {
        "by_status": sw.Grouped(["o_orderstatus", "o_orderpriority"], figures),
        "by_month": sw.Series("o_orderdate", "month", figures, ["o_orderstatus"]),
        "totals": sw.Headline(figures | about),
        "largest": sw.Ranking(["o_custkey"], {"revenue": figures["revenue"]} | figures, 10),
    }
    out = f"{workspace(spark)}/panels"
    load = F.col("o_orderkey") % 4
    wrong = orders.filter(load < 2).withColumn("o_totalprice", F.col("o_totalprice") * 3)
    for number, rows in [(0, wrong), (1, orders.filter(load == 1)), (2, wrong), (3, orders.filter(load == 3))]:
        sw.update_panels(rows, spec, out, number)
    for number in (0, 2):
        sw.update_panels(orders.filter(load == number), spec, out, number)
    tables = sw.read_panels(spark, spec, out)
    exact = orders.agg(F.count_distinct("o_custkey").alias("customers_then"))
    ranks = orders.crossJoin(F.broadcast(tables["totals"].select("median"))).agg(
        F.avg((F.col("o_totalprice") <= F.col("median")).cast("double")).alias("rank")
    )
    near = F.abs(F.col("customers") - F.col("customers_then")) <= 0.08 * F.col("customers_then")
    totals = tables["totals"].crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(ranks))
    tables["totals"] = totals.withColumn("close", near & F.col("rank").between(0.47, 0.53))
    for name in ("by_status", "by_month", "largest"):
        tables[name] = tables[name].withColumn("close", F.lit(None).cast("boolean"))
    return _in_one(tables, ["n", "revenue", "most", "close"])


def events_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files to report: events and total value per day and type."""
    bronze = file_stream_source(spark, sf_dir)
    typed = sw.conform(bronze, TYPED_EVENT)
    figures = {"n": sw.row_count(), "total": sw.exact_sum("value", 2)}
    return sw.time_series(typed, "ts", "day", figures, dims=["event_type"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        csv_source,
        file_stream_source,
        incremental_ingest,
        event_source,
        bronze_append,
        silver_build,
        silver_update,
        create_layers,
        dashboard_dataset,
        dashboard_updates,
        rest_of_fields,
        field_drift,
        offset_continuity,
        filled_series,
        key_history,
        snapshot_changes,
        snapshot_read,
        stream_sink,
        payload_decode,
        layer_read,
        conform,
        validity_split,
        dedup_batch,
        dedup_stream,
        late_rows,
        read_since,
        new_keys,
        append_new,
        row_rules,
        clustered_read,
        upsert,
        upsert_unique_target,
        upsert_deletes,
        lineage,
        grouped_measures,
        time_series,
        headline,
        top_n,
        malformed_capture,
        events_per_day,
    )
}
