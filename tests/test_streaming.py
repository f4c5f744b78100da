import datetime
import glob
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import stratawell as sw
from stratawell.checks import fixtures as fx
from tests.helpers import fresh, same_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def stream_of(spark, work, events):
    return sw.file_stream(spark, f"{work}/landing", "parquet", events.schema)


def ingest(spark, work, events):
    sw.ingest_incremental(
        stream_of(spark, work, events), f"{work}/layer", f"{work}/checkpoint"
    )
    return sw.read_layer(spark, f"{work}/layer")


def local(path):
    return path.removeprefix("file:")


def test_each_run_takes_only_new_files(spark, events):
    work = fresh(spark)
    events.filter("event_id < 300").write.mode("append").parquet(f"{work}/landing")
    assert ingest(spark, work, events).count() == 300
    events.filter("event_id >= 300").write.mode("append").parquet(f"{work}/landing")
    assert same_rows(ingest(spark, work, events), events)
    assert same_rows(ingest(spark, work, events), events)


def test_restart_after_lost_commit_writes_nothing_twice(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    ingest(spark, work, events)
    for commit in glob.glob(f"{local(work)}/checkpoint/commits/*") + glob.glob(
        f"{local(work)}/checkpoint/commits/.*"
    ):
        os.remove(commit)
    assert same_rows(ingest(spark, work, events), events)


def test_restart_after_lost_sink_commit_loses_nothing(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    ingest(spark, work, events)
    for folder in ("checkpoint/commits", "layer/_spark_metadata"):
        for entry in glob.glob(f"{local(work)}/{folder}/*") + glob.glob(
            f"{local(work)}/{folder}/.*"
        ):
            os.remove(entry)
    assert same_rows(ingest(spark, work, events), events)


def test_fresh_checkpoint_over_old_output_is_refused(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    ingest(spark, work, events)
    with pytest.raises(ValueError, match="already holds data"):
        sw.stream_sink(stream_of(spark, work, events), f"{work}/layer", f"{work}/other")


def test_old_checkpoint_over_fresh_output_is_refused(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    ingest(spark, work, events)
    with pytest.raises(ValueError, match="belongs to"):
        sw.stream_sink(stream_of(spark, work, events), f"{work}/other", f"{work}/checkpoint")


def test_lost_output_is_noticed(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    ingest(spark, work, events)
    os.rename(f"{local(work)}/layer", f"{local(work)}/moved")
    with pytest.raises(ValueError, match="has lost"):
        ingest(spark, work, events)


def test_foreign_checkpoint_is_refused(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    query = (
        stream_of(spark, work, events)
        .writeStream.format("noop")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    with pytest.raises(ValueError, match="another query"):
        ingest(spark, work, events)


def test_batch_and_stream_do_not_share_an_output(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    sw.bronze_append(events, f"{work}/layer")
    with pytest.raises(ValueError, match="already holds data"):
        ingest(spark, work, events)
    streamed = fresh(spark)
    events.write.parquet(f"{streamed}/landing")
    ingest(spark, streamed, events)
    with pytest.raises(ValueError, match="written by a stream"):
        sw.bronze_append(events, f"{streamed}/layer")


def test_failed_run_raises_and_can_be_repeated(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    stream = stream_of(spark, work, events)
    broken = stream.withColumn("event_type", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sw.ingest_incremental(broken, f"{work}/layer", f"{work}/checkpoint")
    assert same_rows(ingest(spark, work, events), events)


def test_partitioned_sink(spark, events):
    work = fresh(spark)
    events.write.parquet(f"{work}/landing")
    sw.ingest_incremental(
        stream_of(spark, work, events),
        f"{work}/layer",
        f"{work}/checkpoint",
        partition_by=["event_type"],
    )
    layer = sw.read_layer(spark, f"{work}/layer")
    assert same_rows(layer, events)
    plan = layer.filter("event_type = 'view'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type)" in plan
    assert any("event_type__part=view" in f for f in layer.inputFiles())


def test_row_wise_steps_give_the_same_on_a_stream(spark, events):
    work = fresh(spark)
    dirty = fx.dirty_events(events)
    dirty.write.parquet(f"{work}/landing")
    mapping = [sw.Field("event_id", "bigint"), sw.Field("value", "double")]
    rules = {"value": F.col("value") > 5}
    stream = sw.file_stream(spark, f"{work}/landing", "parquet", dirty.schema)
    streamed = sw.split_valid(sw.conform(stream, mapping), rules)
    batch = sw.split_valid(sw.conform(dirty, mapping), rules)
    for i, side in enumerate(streamed):
        sw.ingest_incremental(side, f"{work}/layer{i}", f"{work}/checkpoint{i}")
        assert same_rows(sw.read_layer(spark, f"{work}/layer{i}"), batch[i])


def deduped(spark, work, events, **kwargs):
    once = sw.dedup_stream(stream_of(spark, work, events), ["event_id"], "ts", "60 days", **kwargs)
    sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
    return sw.read_layer(spark, f"{work}/layer")


@pytest.mark.parametrize("salts", [8, 1, 3])
def test_key_holding_a_third_of_all_rows_comes_out_once(spark, events, salts):
    work = fresh(spark)
    hot = events.withColumn(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id"))
    )
    want = sorted(r.event_id for r in hot.select("event_id").distinct().collect())
    for _ in range(2):
        hot.repartition(6).write.mode("append").parquet(f"{work}/landing")
        got = deduped(spark, work, events, salts=salts)
        assert sorted(r.event_id for r in got.collect()) == want


def test_hot_key_sends_few_rows_to_its_reducer(spark, events):
    work = fresh(spark)
    events.withColumn("event_id", F.lit(7)).repartition(6).write.parquet(f"{work}/landing")
    once = sw.dedup_stream(stream_of(spark, work, events), ["event_id"], "ts", "60 days")
    query = sw.stream_sink(once, f"{work}/layer", f"{work}/checkpoint")
    query.awaitTermination()
    progress = next(p for p in query.recentProgress if p["numInputRows"])
    last, first = [op["numRowsUpdated"] for op in progress["stateOperators"]]
    assert last == 1 and 1 <= first <= 8
    dropped = [
        op["customMetrics"]["numDroppedDuplicateRows"] for op in progress["stateOperators"]
    ]
    assert dropped[0] <= 7 and sum(dropped) == events.count() - 1


def test_time_without_zone_passes_untouched_in_any_session_zone(spark, events):
    work = fresh(spark)
    gap = [datetime.datetime(2024, 3, 10, 2, 30), datetime.datetime(2024, 11, 3, 1, 30)]
    rows = [(i, t, 0, "x", 0.0, "{}") for i, t in enumerate(gap)]
    spark.createDataFrame(rows, events.schema).write.parquet(f"{work}/landing")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        once = sw.dedup_stream(stream_of(spark, work, events), ["event_id"], "ts", "400 days")
        sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
        got = sw.read_layer(spark, f"{work}/layer").orderBy("event_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.ts for r in got] == gap


def test_late_rows_are_dropped(spark, events):
    work = fresh(spark)
    day = datetime.timedelta(days=1)
    start = datetime.datetime(2024, 1, 1)
    for i, time in enumerate([start + 10 * day, start, start + 9 * day]):
        row = [(i, time, 0, "x", 0.0, "{}")]
        spark.createDataFrame(row, events.schema).write.mode("append").parquet(f"{work}/landing")
        once = sw.dedup_stream(stream_of(spark, work, events), ["event_id"], "ts", "2 days")
        sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
    got = sw.read_layer(spark, f"{work}/layer").collect()
    assert sorted(r.event_id for r in got) == [0, 2]


def test_rows_without_a_time_go_aside_and_late_ones_are_counted(spark, events):
    work = fresh(spark)
    start = datetime.datetime(2024, 1, 1)
    for i, time in enumerate([None, start + datetime.timedelta(days=90), None, start]):
        rows = [(5, time, 0, "x", 0.0, "{}"), (6, None, 0, "x", 0.0, "{}"), (7 + i, time or start, 0, "x", 0.0, "{}")]
        spark.createDataFrame(rows, events.schema).write.mode("append").parquet(f"{work}/landing")
        once = sw.dedup_stream(stream_of(spark, work, events), ["event_id"], "ts", "60 days")
        taken = sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
        assert taken.rows == [1, 2, 0, 0][i], (i, taken)
    assert taken.late == 2
    got = sorted(r.event_id for r in sw.read_layer(spark, f"{work}/layer").collect())
    assert got == [5, 7, 8]
    aside = sw.rows_without_time(stream_of(spark, work, events), "ts")
    assert sw.ingest_incremental(aside, f"{work}/aside", f"{work}/aside_checkpoint").rows == 6


def test_restart_under_other_settings(spark, events):
    work, name = fresh(spark), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        for partitions, part in ((1, 0), (8, 1)):
            spark.conf.set(name, str(partitions))
            events.filter(F.col("event_id") % 2 <= part).write.mode("append").parquet(f"{work}/landing")
            got = deduped(spark, work, events)
    finally:
        spark.conf.set(name, before)
    assert same_rows(got, events)


def test_of_two_checkpoints_one_gets_the_output(spark, events):
    """Bound before either has written, and started at once: the other is refused, then and later."""
    from stratawell.streaming.sink import bind_checkpoint

    work = fresh(spark)
    events.repartition(4).write.parquet(f"{work}/landing")
    bind_checkpoint(spark, f"{work}/bound", f"{work}/one")
    for _ in range(2):
        with pytest.raises(ValueError, match="already belongs"):
            bind_checkpoint(spark, f"{work}/bound", f"{work}/two")
    bind_checkpoint(spark, f"{work}/bound", f"{work}/one")

    stream = stream_of(spark, work, events)
    with ThreadPoolExecutor(2) as pool:
        runs = [
            pool.submit(sw.ingest_incremental, stream, f"{work}/layer", f"{work}/own{i}") for i in (0, 1)
        ]
    failed = [i for i, run in enumerate(runs) if run.exception()]
    assert len(failed) == 1 and "already" in str(runs[failed[0]].exception())
    with pytest.raises(ValueError, match="already"):
        sw.ingest_incremental(stream, f"{work}/layer", f"{work}/own{failed[0]}")
    assert same_rows(sw.read_layer(spark, f"{work}/layer"), events)


def test_passed_repeats_and_late_rows_are_the_input(spark):
    """Over runs whose rows are repeated, late by more and less than the delay, and without a time."""
    rng = random.Random(5)
    work, rows, kept = fresh(spark), [], {}
    schema = "k int, ts timestamp_ntz, n int"
    start = datetime.datetime(2024, 1, 1)
    for run in range(5):
        some = []
        for _ in range(40):
            hours = 24 * run + rng.randrange(-60, 24)
            time = None if rng.random() < 0.1 else start + datetime.timedelta(hours=max(0, hours))
            some.append((rng.randrange(60), time, len(rows) + len(some)))
        rows += some
        spark.createDataFrame(some, schema).repartition(2).write.mode("append").parquet(f"{work}/landing")
        stream = sw.file_stream(spark, f"{work}/landing", "parquet", spark.createDataFrame([], schema).schema, max_files=1)
        before = sw.stored_watermark(spark, f"{work}/checkpoint")
        taken = sw.ingest_deduplicated(stream, ["k"], "ts", "1 day", f"{work}/layer", f"{work}/checkpoint", salts=1)
        layer = sw.read_layer(spark, f"{work}/layer").collect()
        new = {r["n"]: r["outcome"] for r in layer if r["n"] not in kept}
        assert taken.late == 0 and taken.rows == len(new) and len(layer) == len(kept) + len(new)
        for k, time, n in some:
            stamp = None if time is None else time.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000
            if time is None:
                assert new[n] == "untimed"
            elif before is not None and stamp <= before:
                assert new[n] == "late"
            else:  # passed, or a repeat of a row that passed
                passed = [r["k"] for r in layer if r["outcome"] == "passed"]
                assert new.get(n, "passed") == "passed" and k in passed
        kept |= new
    outcomes = set(kept.values())
    assert outcomes == {"passed", "late", "untimed"} and len(kept) < len(rows)
    with pytest.raises(ValueError, match="outcome"):
        named = stream.withColumn("outcome", F.lit(1))
        sw.ingest_deduplicated(named, ["k"], "ts", "1 day", f"{work}/l", f"{work}/c")
