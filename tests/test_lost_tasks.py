"""Results stay whole when tasks die half-way and run again."""

import pytest
from pyspark.sql import functions as F

import stratawell as sw
from tests.helpers import fresh, same_rows

SF = "/root/testdata/sf0.001"


def die_once(batches):
    from pyspark import TaskContext

    context = TaskContext.get()
    for batch in batches:
        yield batch
        if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
            raise RuntimeError("lost")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def flaky(df):
    return df.repartition(6, "event_id").mapInPandas(die_once, df.schema)


def test_batch_operators(events):
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")))
    loaded = events.filter("user_id % 2 = 0")
    plain = hot.join(loaded.select("user_id"), ["user_id"], "left_anti")
    assert same_rows(sw.new_keys(flaky(hot), loaded, ["user_id"], hot_rows=20), plain)
    newest = [F.col("ts").desc()]
    assert same_rows(
        sw.dedup(flaky(hot), ["user_id"], newest), sw.dedup(hot, ["user_id"], newest)
    )
    changes = hot.filter("event_id < 300")
    assert same_rows(
        sw.upsert(flaky(events), flaky(changes), ["event_id"], newest, broadcast_rows=0),
        sw.upsert(events, changes, ["event_id"], newest),
    )
    totals = {"n": sw.row_count(), "total": sw.exact_sum("value", 2), "users": sw.distinct_count("user_id")}
    assert sw.headline(flaky(events), totals).collect() == sw.headline(events, totals).collect()


def test_sinks(spark, events):
    work = fresh(spark)
    sw.bronze_append(flaky(events), f"{work}/bronze", load=1)
    assert same_rows(sw.read_layer(spark, f"{work}/bronze").drop("load_no"), events)
    events.repartition(6).write.parquet(f"{work}/landing")
    stream = sw.file_stream(spark, f"{work}/landing", "parquet", events.schema)
    once = sw.dedup_stream(stream.mapInPandas(die_once, events.schema), ["event_id"], "ts", "60 days")
    sw.ingest_incremental(once, f"{work}/layer", f"{work}/checkpoint")
    assert same_rows(sw.read_layer(spark, f"{work}/layer"), events)
