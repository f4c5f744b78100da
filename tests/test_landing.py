"""Fields outside a schema, offsets from run to run, series without holes, counts of long backlogs."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import stratawell as sw
from tests.helpers import fresh

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.TimestampNTZType())])


def landed(spark, *files):
    """Lines of JSON, a file for each list, read as a stream into a layer."""
    work = fresh(spark)
    for i, lines in enumerate(files):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{work}/land/f{i}")
    stream = sw.file_stream(spark, f"{work}/land/*", "json", SCHEMA, rest_col="rest")
    sw.ingest_incremental(sw.with_lineage(stream), f"{work}/out", f"{work}/checkpoint")
    rows = sw.read_layer(spark, f"{work}/out")
    return rows.withColumn("file", F.regexp_extract("source_file", "/(f[0-9])/", 1))


def test_nothing_that_lands_is_lost(spark):
    lines = [
        '{"a":1,"t":"2024-01-01T00:00:00"}', '{"a":2,"zz":5}', "", '{"a":3,"zz":5.5,"o":{"p":1}}', "{bad",
        '{"a":4,"zz":"x","o":{"q":[1,2]}}', '{"a":"nan","zz":null}', '{"A":7,"a":8}', '{"a":9},"x":1', "[1]",
        '{"zz":null}', '{"a":1,"a b":true,"ü":[{"k":1}]}',
    ]
    rows = landed(spark, lines[:5], lines[5:]).collect()
    assert len(rows) == len(lines) - 1  # but for the empty one
    corrupt = {r["_corrupt"] for r in rows if r["_corrupt"] is not None}
    assert corrupt == {"{bad", '{"a":"nan","zz":null}', '{"a":9},"x":1', "[1]"}
    for row in rows:
        if row["_corrupt"] is None:
            kept = {name: json.loads(value.toJson()) for name, value in (row["rest"] or {}).items()}
            kept |= {name: row[name] for name in ("a",) if row[name] is not None}
            kept |= {"t": row["t"].isoformat()} if row["t"] else {}
            assert kept in [json.loads(line) for line in lines if line and line not in corrupt]


def test_drift_is_reported_and_taken_into_the_schema(spark):
    rows = landed(
        spark,
        ['{"a":1,"zz":5,"o":{"p":1},"n":null}', '{"zz":2.5,"l":[1]}', '{"a":2}'],
        ['{"zz":7,"o":{"q":true},"l":["x"],"s":"u"}'],
    )
    found = {(r["file"], r["field"]): (r["type"], r["n"]) for r in sw.drift_report(rows, "rest", "file").collect()}
    assert found["f0", "o"] == ("OBJECT<p: BIGINT>", 1) and found["f1", "o"] == ("OBJECT<q: BOOLEAN>", 1)
    assert found["f0", "zz"][1] == 2 and found["f0", "zz"][0].startswith(("DECIMAL", "DOUBLE"))
    assert found["f1", "zz"] == ("BIGINT", 1) and found["f0", "n"] == ("VOID", 1)
    wide = sw.widened(rows, "rest", SCHEMA)
    kinds = {f.name: f.dataType.simpleString() for f in wide}
    assert wide.names == ["a", "t", "l", "n", "o", "s", "zz"]
    assert kinds["o"] == "struct<p:bigint,q:boolean>" and kinds["n"] == kinds["s"] == "string"
    assert kinds["l"] == "array<variant>"
    assert sw.drift_report(rows.limit(0), "rest").collect() == []
    assert sw.widened(rows.limit(0), "rest", SCHEMA) == SCHEMA
    with pytest.raises(ValueError, match="outside their schema"):
        sw.file_stream(spark, "x", "csv", SCHEMA, rest_col="rest")


def test_a_payload_cannot_leave_its_object(spark):
    texts = [
        '{"a":1}', '{"a":1},"x":2', '{"a":1},"payload":{"a":7}', '{"a":1},"seal":"x"', '{"a":1}}', '{"a":1}{"a":2}',
        '{"payload":1,"seal":2,"a":3}', None, "", '{"a":1},"corrupt":"x"',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = {r["i"]: r for r in sw.decode_json(df, SCHEMA).collect()}
    assert [i for i, r in got.items() if r["_corrupt"] is None] == [0, 6, 7]
    assert got[0]["a"] == 1 and got[6]["a"] == 3
    loose = spark.createDataFrame([("{'a':1}",), ("{'a':1},'x':2",)], "value string")
    assert [r["_corrupt"] is None for r in sw.decode_json(loose, SCHEMA).collect()] == [True, False]
    bare = spark.createDataFrame([("{a:1}",), ("{a:1},x:2",)], "value string")
    assert [r["_corrupt"] is None for r in sw.decode_json(bare, SCHEMA).collect()] == [False, False]
    read = sw.decode_json(bare, SCHEMA, allowUnquotedFieldNames="true").collect()
    assert [r["_corrupt"] is None for r in read] == [True, False]


def test_a_bad_record_fails_whatever_is_selected(spark):
    path = f"{fresh(spark)}/csv"
    spark.createDataFrame([("a,b",), ("1,2",), ("3,x",)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    for wrong in (lambda df: df.select("a").collect(), lambda df: df.count(), lambda df: df.collect()):
        with pytest.raises(Exception, match="(?i)malformed|x"):
            wrong(sw.csv_source(spark, path, schema, whole=True))
    kept = sw.csv_source(spark, path, schema, whole=True, mode="DROPMALFORMED")
    assert kept.count() == 1 and kept.select("a").count() == 1
    kept = sw.csv_source(spark, path, schema, mode="DROPMALFORMED")
    assert kept.collect() == [(1, 2)]


def test_all_batches_are_counted(spark):
    work = fresh(spark)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(12).repartition(6).write.parquet(f"{work}/landing")
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        stream = sw.file_stream(spark, f"{work}/landing", "parquet", events.schema, max_files=1)
        taken = sw.ingest_incremental(stream, f"{work}/out", f"{work}/checkpoint")
        assert (taken.batches, taken.rows) == (6, 12) and spark.conf.get(name) == "2"
    finally:
        spark.conf.set(name, before)


# offsets

EVENTS = "topic string, partition int, offset bigint, v int"


def brute_ranges(offsets):
    out = []
    for o in sorted(offsets):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return out


@pytest.mark.parametrize("block", [4, 1000])
def test_offsets_from_run_to_run(spark, block):
    rng = random.Random(block)
    path, seen, written = f"{fresh(spark)}/offsets", {}, 0
    for run in range(4):
        rows = []
        for p in range(3):
            start = rng.randrange(40) + 10 * run
            rows += [("t", p, o, rng.randrange(9)) for o in range(start, start + 25) if rng.random() < 0.9]
        rows += rng.sample(rows, 5) + [("t", 0, None, 1), (None, None, run, 1)]
        if run == 2:  # a run that dies before it is committed
            sw.take_offsets(spark.createDataFrame(rows[:10], EVENTS), path, block=block)
        taken = sw.take_offsets(spark.createDataFrame(rows, EVENTS).repartition(3), path, block=block)
        want = []
        for place in {r[:2] for r in rows} | set(seen):
            new = {r[2] for r in rows if r[:2] == place and r[2] is not None}
            old = seen.setdefault(place, set())
            for kind, some in (("new", new - old), ("replay", new & old)):
                # a range ends where another kind begins, and where offsets are missing
                want += [(*place, a, b, kind) for a, b in brute_ranges(some)]
            every = new | old
            if every:
                missing = set(range(min(every), max(every))) - every
                want += [(*place, a, b, "gap") for a, b in brute_ranges(missing)]
        assert sorted(map(tuple, taken.report.collect()), key=str) == sorted(want, key=str)
        fresh_rows = [tuple(r) for r in taken.events.collect()]
        expected = {(t, p, o) for t, p, o, _ in rows if o is not None and o not in seen[t, p]}
        placed = [r[:3] for r in fresh_rows if r[2] is not None]
        assert sorted(placed, key=str) == sorted(expected, key=str)
        assert len(fresh_rows) - len(placed) == 1
        sw.commit_offsets(spark, taken)
        for t, p, o, _ in rows:
            if o is not None:
                seen[t, p].add(o)


def test_ranges_of_a_large_partition_and_of_none(spark):
    df = spark.range(5000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    holes = df.filter("offset % 1000 != 7")
    got = sw.offset_ranges(holes, block=64).orderBy("first").collect()
    assert [(r["first"], r["last"]) for r in got] == [(0, 6), (8, 1006), (1008, 2006), (2008, 3006), (3008, 4006), (4008, 4999)]
    assert sw.offset_ranges(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="kind"):
        sw.take_offsets(df.withColumn("kind", F.lit(1)), "x", by=["kind"])


# series


def brute_series(points, n):
    """(nr, value, running sum, trailing sum, trailing largest) of values by place."""
    out, total = [], None
    for i, v in enumerate(points):
        total = v if total is None else total + (v or 0)
        last = [x for x in points[max(0, i - n + 1) : i + 1] if x is not None]
        out.append((i, v, total, sum(last) if last else None, max(last, default=None)))
    return out


@pytest.mark.parametrize(("block", "n"), [(1, 1), (4, 3), (5, 12), (1000, 7)])
def test_running_and_trailing_against_brute_force(spark, block, n):
    rng = random.Random(block)
    series = {d: [rng.choice([None, rng.randrange(-9, 9)]) for _ in range(40)] for d in ("x", "y", None)}
    rows = [(d, i, v) for d, values in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "d string, nr int, v int").repartition(4)
    got = sw.running(df, {"total": "v"}, ["d"], block=block)
    got = sw.trailing(got, n, {"recent": F.sum("v"), "most": F.max("v")}, ["d"], block=block)
    assert got.columns == ["d", "nr", "v", "total", "recent", "most"]
    want = [(d, *row) for d, values in series.items() for row in brute_series(values, n)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_one_long_series_is_worked_on_by_several_tasks(spark):
    path = f"{fresh(spark)}/series"
    spark.range(20_000).select(F.col("id").alias("nr"), (F.col("id") % 7).alias("v")).write.parquet(path)
    series = spark.read.parquet(path)
    done = sw.trailing(sw.running(series, {"total": "v"}, block=1000), 30, {"recent": F.sum("v")}, block=1000)
    counts = done.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) > 2
    last = done.filter("nr = 19999").first()
    assert last["total"] == sum(i % 7 for i in range(20_000))
    assert last["recent"] == sum(i % 7 for i in range(19_970, 20_000))


def test_empty_buckets_appear(spark):
    def at(day):
        return datetime.datetime(2024, 1, day, 12)

    rows = [("a", at(2), 1), ("a", at(5), 2), ("b", at(4), 3), ("b", None, 9), (None, at(2), 4)]
    df = spark.createDataFrame(rows, "d string, t timestamp_ntz, v int")
    figures = {"n": sw.row_count(), "sum": F.sum("v")}
    got = sw.filled_series(df, "t", "day", figures, ["d"], fill={"n": 0})
    found = {(r["d"], r["day"].day): (r["nr"], r["n"], r["sum"]) for r in got.collect()}
    assert len(found) == 12 and found["a", 3] == (1, 0, None) and found["b", 4] == (2, 1, 3)
    assert found[None, 2] == (0, 1, 4) and found[None, 5] == (3, 0, None)
    wide = sw.filled_series(df, "t", "month", figures, start="2023-11-15", end="2024-02-01")
    assert [(str(r["month"]), r["n"]) for r in wide.orderBy("nr").collect()] == [
        ("2023-11-01", None), ("2023-12-01", None), ("2024-01-01", 4), ("2024-02-01", None),
    ]
    for grain in ("week", "quarter", "year"):
        assert sw.filled_series(df, "t", grain, figures, ["d"]).count() == 3
    assert sw.filled_series(df.limit(0), "t", "day", figures, ["d"]).collect() == []
    with pytest.raises(ValueError, match="nr"):
        sw.filled_series(df, "t", "day", {"nr": sw.row_count()})


def test_dashboard_columns_may_have_inner_names(spark):
    df = spark.sql("SELECT 1 AS _dim0, 2 AS _panel0, 3 AS v")
    tables = sw.dashboard_dataset(
        df, {"p": sw.Grouped(["_dim0"], {"n": sw.row_count()}), "q": sw.Headline({"s": F.sum("v")})}, f"{fresh(spark)}/d"
    )
    assert tables["p"].collect() == [(1, 1)] and tables["q"].collect() == [(3,)]
