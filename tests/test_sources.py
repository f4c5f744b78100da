import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import stratawell as sw
from stratawell.sources.events import event_options
from tests.helpers import same_rows

SCHEMA = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("s", T.StringType()),
    ]
)


def write(directory, name, text):
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, name), "w") as out:
        out.write(text)


@pytest.fixture
def mixed(tmp_path):
    path = str(tmp_path / "mixed")
    write(path, "a.csv", "k,p,s\n1,2.5,x\n2,bad,y\n3,4.5\n4,5.5,z,extra\n5,6.5,\n")
    return path


def test_csv_keeps_malformed_text_and_usable_values(spark, mixed):
    df = sw.csv_source(spark, mixed, SCHEMA, corrupt_col="_corrupt")
    assert sorted(df.collect()) == [
        (1, 2.5, "x", None),
        (2, None, "y", "2,bad,y"),
        (3, 4.5, None, "3,4.5"),
        (4, 5.5, "z", "4,5.5,z,extra"),
        (5, 6.5, None, None),
    ]


def test_corrupt_flag_does_not_depend_on_selected_columns(spark, mixed):
    df = sw.csv_source(spark, mixed, SCHEMA, corrupt_col="_corrupt")
    flagged = df.filter(F.col("_corrupt").isNotNull()).select("k").collect()
    assert sorted(r.k for r in flagged) == [2, 3, 4]
    assert df.select(F.count("_corrupt")).first()[0] == 3
    assert df.filter("_corrupt IS NULL").count() == 2


def test_csv_schema_argument_is_left_alone(spark, mixed):
    before = list(SCHEMA.names)
    sw.csv_source(spark, mixed, SCHEMA, corrupt_col="_corrupt")
    assert SCHEMA.names == before


def test_csv_header_in_another_order_fails(spark, tmp_path):
    write(str(tmp_path), "a.csv", "p,k,s\n1,2,x\n")
    with pytest.raises(Exception, match="header"):
        sw.csv_source(spark, str(tmp_path), SCHEMA).collect()


def test_csv_without_header(spark, tmp_path):
    write(str(tmp_path), "a.csv", "1,2.5,x\n")
    assert sw.csv_source(spark, str(tmp_path), SCHEMA, header=False).collect() == [(1, 2.5, "x")]


def test_csv_reads_only_selected_columns(spark, mixed):
    plan = sw.csv_source(spark, mixed, SCHEMA).select("k")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<k:bigint>" in plan


def drain(stream, tmp_path, name):
    out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    sw.ingest_incremental(stream, out, checkpoint)
    return sw.read_layer(stream.sparkSession, out)


@pytest.mark.parametrize("bound", [{}, {"max_files": 1}, {"max_bytes": 20}])
def test_file_stream_takes_everything_under_any_bound(spark, tmp_path, bound):
    landing = str(tmp_path / "landing")
    for i in range(4):
        write(landing, f"{i}.json", json.dumps({"k": i, "p": i / 2, "s": "x"}))
    got = drain(sw.file_stream(spark, landing, "json", SCHEMA, **bound), tmp_path, "out")
    assert same_rows(got, spark.read.schema(SCHEMA).json(landing))


def test_file_stream_rejects_two_bounds(spark, tmp_path):
    with pytest.raises(ValueError):
        sw.file_stream(spark, str(tmp_path), "json", SCHEMA, max_files=1, max_bytes=1)


def test_file_stream_keeps_malformed_text(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write(landing, "a.json", '{"k":1,"p":2.5,"s":"x"}\n{"k":2,"p":"bad"}\n{"k":\n')
    stream = sw.file_stream(spark, landing, "json", SCHEMA, corrupt_col="_corrupt")
    flagged = stream.select("k", F.col("_corrupt").isNotNull().alias("bad"))
    got = drain(flagged, tmp_path, "out")
    assert sorted((r.k or 0, r.bad) for r in got.collect()) == [(0, True), (1, False), (2, True)]


def test_corrupt_flag_with_nested_and_required_columns(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write(landing, "a.json", '{"k":1,"m":{"a":1},"r":{"x":1}}\n{"k":2,"m":{"a":"z"},"r":{"x":1}}\n')
    write(landing, "b.json", '{"k":3,"m":{},"r":{"x":"z"}}\n{"k":"z","m":{},"r":{"x":1}}\n')
    schema = T.StructType(
        [
            T.StructField("k", T.LongType(), nullable=False),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("r", T.StructType([T.StructField("x", T.IntegerType())]), nullable=False),
        ]
    )
    stream = sw.file_stream(spark, landing, "json", schema, corrupt_col="_corrupt")
    got = drain(stream.select(F.col("_corrupt").isNotNull().alias("bad")), tmp_path, "out")
    assert sorted(r.bad for r in got.collect()) == [False, True, True, True]


def test_file_stream_csv_equals_batch(spark, mixed, tmp_path):
    stream = sw.file_stream(spark, mixed, "csv", SCHEMA, corrupt_col="_corrupt", header=True)
    batch = sw.csv_source(spark, mixed, SCHEMA, corrupt_col="_corrupt")
    assert same_rows(drain(stream, tmp_path, "out"), batch)


def test_lineage_columns(spark, mixed):
    row = sw.with_lineage(sw.csv_source(spark, mixed, SCHEMA)).first()
    assert row.source_file.endswith("/a.csv")
    assert row.source_time <= row.ingested_at


def test_event_options_split_busy_partitions_unless_told(spark):
    assert event_options({"subscribe": "t"}, 64) == {"subscribe": "t", "minPartitions": "64"}
    assert event_options({"minPartitions": "8"}, 64) == {"minPartitions": "8"}


def test_event_stream_without_connector_says_so(spark):
    with pytest.raises(Exception, match="kafka"):
        sw.event_stream(spark, {"kafka.bootstrap.servers": "none:1", "subscribe": "t"})


def test_event_replay_has_the_envelope_columns(spark, tmp_path):
    archive = str(tmp_path / "archive")
    spark.createDataFrame([], sw.ENVELOPE).write.parquet(archive)
    stream = sw.event_replay(spark, archive, max_files=5)
    assert stream.isStreaming and stream.columns == sw.ENVELOPE.names


PAYLOAD = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_decode_keeps_every_undecodable_text(spark):
    rows = [
        (1, b'{"a":1,"b":"x"}'),
        (2, b'{"a'),
        (3, b'{"a":"zz","b":"y"}'),
        (4, b""),
        (5, b"  "),
        (6, None),
        (7, b"[]"),
        (8, b'{"a":1,"b":"x"}{"a":2}'),
        (9, b'{"a":1,"b":"x"} junk'),
        (10, b'{"a":1,"b":"\xff"}'),
        (11, b' {"a":1,"b":"x"}\n'),
        (12, b'{"a":1},"seal":"x"}'),
        (13, b"null"),
        (14, b'{"a":1,"b":"x"}]'),
        (15, b'{"a":1,"zz":[1,{"q":"}"}],"b":"x\\"}"}'),
        (16, b'{"a":1}, "payload":{"a":2}'),
    ]
    df = sw.decode_json(spark.createDataFrame(rows, "id int, value binary"), PAYLOAD)
    assert df.columns == ["id", "a", "b", "_corrupt"]
    got = {r.id: (r.a, r.b, r._corrupt) for r in df.collect()}
    assert got[1] == (1, "x", None)
    assert got[2] == (None, None, '{"a')
    assert got[3] == (None, "y", '{"a":"zz","b":"y"}')
    assert got[4] == (None, None, "")
    assert got[5] == (None, None, "  ")
    assert got[6] == (None, None, None)
    for i in (7, 8, 9, 12, 13, 14):
        assert got[i][2] == rows[i - 1][1].decode(), i
    assert got[10][2] == '{"a":1,"b":"\ufffd"}'
    assert got[11] == (1, "x", None) and got[15] == (1, 'x"}', None)
    alone = {r.id: r._corrupt for r in df.select("id", "_corrupt").collect()}
    assert alone == {i: v[2] for i, v in got.items()}


def test_decode_parses_once(spark):
    df = spark.createDataFrame([(b"{}",)], "value binary")
    plan = sw.decode_json(df, PAYLOAD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_decode_keeps_the_payload_and_refuses_clashing_names(spark):
    rows = [(1, b'{"a":1,"zz":5}'), (2, b"\xff{"), (3, None)]
    df = spark.createDataFrame(rows, "id int, value binary")
    got = {r.id: r for r in sw.decode_json(df, PAYLOAD, raw_col="raw").collect()}
    assert [bytes(got[i].raw) if got[i].raw is not None else None for i in (1, 2, 3)] == [v for _, v in rows]
    for clash in ({"corrupt_col": "ID"}, {"raw_col": "a"}):
        with pytest.raises(ValueError, match="two columns"):
            sw.decode_json(df, PAYLOAD, **clash)
    inner = df.selectExpr("id AS source", "id AS text", "id AS found", "id AS wanted", "id AS _0", "value")
    kept = sw.decode_json(inner, PAYLOAD).orderBy("source")
    assert tuple(kept.first())[:6] == (1, 1, 1, 1, 1, 1)


def test_csv_without_a_corrupt_column_fails_on_bad_records(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    for i, line in enumerate(("1,bad", "2,3.5,extra")):
        path = tmp_path / f"{i}.csv"
        path.write_text(f"a,b\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            sw.csv_source(spark, str(path), schema).collect()
        lenient = sw.csv_source(spark, str(path), schema, mode="PERMISSIVE").collect()
        assert lenient[0].a == i + 1


def test_formats_without_corrupt_records_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no corrupt records"):
        sw.file_stream(spark, str(tmp_path), "parquet", PAYLOAD, corrupt_col="_corrupt")
