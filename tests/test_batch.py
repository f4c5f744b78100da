import datetime
import json

import pytest
from pyspark.sql import functions as F

import stratawell as sw
from stratawell.checks import fixtures as fx
from tests.helpers import fresh, plan_of, same_rows, token

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


@pytest.fixture
def shuffled_joins(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


# bronze


def test_repeating_a_load_replaces_it(spark, events):
    out = f"{fresh(spark)}/bronze"
    sw.bronze_append(events.filter("event_id < 500"), out, load=1)
    sw.bronze_append(events.filter("event_id >= 500"), out, load=2)
    sw.bronze_append(events.filter("event_id >= 500"), out, load=2)
    assert same_rows(sw.read_layer(spark, out).drop("load_no"), events)


def test_append_without_load_adds(spark, events):
    out = f"{fresh(spark)}/bronze"
    sw.bronze_append(events, out)
    sw.bronze_append(events, out)
    assert same_rows(sw.read_layer(spark, out), events.unionByName(events))


def test_partitioned_append_rebalances(spark, events):
    out = f"{fresh(spark)}/bronze"
    sw.bronze_append(events, out, partition_by=["event_type"])
    layer = sw.read_layer(spark, out)
    assert same_rows(layer, events)
    assert len(layer.inputFiles()) == events.select("event_type").distinct().count()


def test_hot_partition_value_is_written_by_several_tasks(spark):
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256KB")
    try:
        work = fresh(spark)
        out = f"{work}/bronze"
        kind = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("hot")
        events.withColumn("event_type", kind).repartition(16).write.parquet(f"{work}/many")
        many = spark.read.parquet(f"{work}/many")
        sw.bronze_append(many, out, partition_by=["event_type"])
    finally:
        spark.conf.set(name, before)
    layer = sw.read_layer(spark, out)
    assert same_rows(layer, many)
    assert sum("event_type__part=hot" in f for f in layer.inputFiles()) > 1


# conform and validity


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_become_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(" 7 ", " 2024-03-10 02:30:00 ", " Ab ", "x"), ("seven", "", None, "y")]
        df = spark.createDataFrame(rows, "n string, t string, s string, old string")
        got = sw.conform(
            df,
            [
                sw.Field("n", "int"),
                sw.Field("t", "timestamp_ntz"),
                sw.Field("s", lower=True),
                sw.Field("as_is", source="s", trim=False),
                sw.Field("new", source="old"),
                sw.Field("twice", "bigint", source=F.col("n").try_cast("int") * 2),
            ],
        ).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got[0] == (7, datetime.datetime(2024, 3, 10, 2, 30), "ab", " Ab ", "x", 14)
    assert got[1] == (None, None, None, None, "y", None)


def test_conform_leaves_typed_columns_alone(spark, events):
    mapping = [sw.Field(f.name, f.dataType.simpleString()) for f in events.schema.fields]
    assert same_rows(sw.conform(events, mapping), events)


def test_split_conserves_rows_and_names_reasons(spark, events):
    df = events.withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    rules = {"small": F.col("value") < 50, "view": F.col("event_type") == "view"}
    accepted, quarantined = sw.split_valid(df, rules)
    assert same_rows(accepted.unionByName(quarantined.drop("reasons")), df)
    assert accepted.filter("NOT (value < 50 AND event_type = 'view')").isEmpty()
    for row in quarantined.collect():
        broken = []
        if row.value is None or row.value >= 50:
            broken.append("small")
        if row.event_type != "view":
            broken.append("view")
        assert row.reasons == broken and broken
    tagged = sw.tag_valid(df, rules)
    assert tagged.filter(F.size("reasons") == 0).count() == accepted.count()


def test_accepting_rules_reach_the_scan(events):
    accepted, _ = sw.split_valid(events, {"value": F.col("value") > 5})
    assert "GreaterThan(value,5.0)" in plan_of(accepted)


def test_rule_set_must_not_be_empty(events):
    with pytest.raises(ValueError):
        sw.split_valid(events, {})


# dedup


def test_dedup_does_not_depend_on_partitioning(lineitem):
    keys, order = ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]
    want = sw.dedup(lineitem, keys, order)
    assert want.count() == lineitem.select(*keys).distinct().count()
    for other in (lineitem.repartition(5, "l_partkey"), lineitem.orderBy(F.rand(3)).coalesce(3)):
        assert same_rows(sw.dedup(other, keys, order), want)


def test_dedup_against_brute_force_with_a_hot_key(spark, events):
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")))
    hot = hot.withColumn("user_id", F.when(F.col("event_id") % 11 != 0, F.col("user_id")))
    best = {}
    for r in hot.collect():
        rank = (-r.value, r.event_id)
        if r.user_id not in best or rank < best[r.user_id][0]:
            best[r.user_id] = (rank, r)
    got = sw.dedup(hot, ["user_id"], [F.col("value").desc(), "event_id"], ties=[])
    assert sorted(got.collect(), key=str) == sorted((r for _, r in best.values()), key=str)


def test_dedup_keeps_one_row_per_key_and_partition_before_the_shuffle(events):
    plan = plan_of(sw.dedup(events, ["user_id"], ["ts"]))
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


# incremental


def test_read_since_is_pushed_to_the_scan(events):
    mark = datetime.datetime(2024, 1, 15)
    assert "GreaterThan(ts,2024-01-15T00:00)" in plan_of(sw.read_since(events, "ts", mark))
    assert "GreaterThan(event_id,10)" in plan_of(sw.read_since(events, "event_id", 10))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("dtype", ["timestamp_ntz", "timestamp", "string", "date"])
def test_marks_chain_loads_without_gap_or_overlap(spark, events, zone, dtype):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        typed = events.withColumn("ts", F.col("ts").cast(dtype))
        half = typed.orderBy("event_id").filter("event_id = 400").first().ts
        first = typed.filter(F.col("ts") <= F.lit(str(half)).cast(dtype))
        mark = sw.high_water_mark(first, "ts")
        rest = sw.read_since(typed, "ts", mark)
        assert first.count() > 300 and rest.count() > 300
        assert same_rows(first.unionByName(rest), typed)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_mark_means_everything(events):
    assert sw.high_water_mark(events.limit(0), "ts") is None
    assert same_rows(sw.read_since(events, "ts", None), events)


def plain_anti(incoming, target, keys):
    return incoming.join(target.select(*keys), list(keys), "left_anti").select(*incoming.columns)


@pytest.mark.parametrize("hot_rows, salts", [(1, 64), (20, 1), (50, 5), (10**6, 64), (None, 64)])
@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "event_type"]])
def test_new_keys_equals_plain_join_whatever_is_hot(events, keys, hot_rows, salts):
    key = F.col("event_id")
    incoming = events.withColumn(
        "user_id",
        F.when(key % 3 == 0, 1).when(key % 3 == 1, 2).when(key % 7 != 0, F.col("user_id")),
    )
    target = events.filter("user_id % 2 = 0").unionByName(
        events.withColumn("user_id", F.lit(2)).withColumn("event_type", F.lit("view"))
    )
    got = sw.new_keys(incoming, target, keys, hot_rows, salts)
    assert same_rows(got, plain_anti(incoming, target, keys))


def test_new_keys_of_loaded_rows_is_empty(events):
    assert sw.new_keys(events, events, ["event_id"], hot_rows=1).isEmpty()


@pytest.mark.parametrize("size", [0, 5000])
def test_new_keys_spreads_many_and_long_hot_keys(spark, shuffled_joins, size):
    """More hot keys than fit one list, of any length: no reducer gets much more than its share."""
    key = F.rpad(F.concat(F.lit("k"), (F.col("id") % 1500).cast("string")), size or 6, ".")
    rows = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.rpad(F.lit("one"), size or 6, ".")).otherwise(key).alias("k"),
        F.lit("same").alias("v"),
    )
    got = sw.new_keys(rows, rows.filter("k LIKE 'k7%'"), ["k"], hot_rows=10)
    assert same_rows(got, plain_anti(rows, rows.filter("k LIKE 'k7%'"), ["k"]))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8


@pytest.mark.parametrize("null_key", [False, True])
def test_new_keys_spreads_a_hot_key(spark, events, shuffled_joins, null_key):
    hot = F.lit(None if null_key else -5).cast("bigint")
    key = F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("event_id"))
    incoming = events.withColumn("event_id", key)
    target = events.filter("event_id % 3 = 1")
    got = sw.new_keys(incoming, target, ["event_id"], hot_rows=100)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert same_rows(got, plain_anti(incoming, target, ["event_id"]))
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * got.count() / 8


def test_new_keys_spreads_exact_copies(spark, events, shuffled_joins):
    copy = events.filter("event_id = 4").withColumn("event_id", F.lit(-5).cast("bigint"))
    copies = copy.join(F.broadcast(spark.range(500)), how="cross").drop("id").repartition(32)
    incoming = events.repartition(32).unionByName(copies)
    got = sw.new_keys(incoming, events.filter("event_id % 2 = 1"), ["event_id"], hot_rows=100)
    copied = got.filter("event_id = -5")
    sizes = copied.groupBy(F.spark_partition_id()).count().collect()
    assert copied.count() == 500 and got.count() == 1000
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 500 / 2


def changes_of(events):
    return fx.revised_events(events).unionByName(
        events.filter("event_id % 50 = 0").withColumn("event_id", F.col("event_id") + 1_000_000)
    )


NEWEST = "ts"


LIMITS = [{}, {"broadcast_rows": 0}, {"broadcast_bytes": 0}]


@pytest.mark.parametrize("limits", LIMITS)
def test_upsert_is_idempotent(events, limits):
    changes, newest = changes_of(events), [F.col(NEWEST).desc()]
    once = sw.upsert(events, changes, ["event_id"], newest, **limits)
    twice = sw.upsert(once, changes, ["event_id"], newest, **limits)
    assert same_rows(once, twice)
    assert once.count() == events.count() + events.filter("event_id % 50 = 0").count()


@pytest.mark.parametrize("limits", LIMITS)
def test_upsert_leaves_other_keys_alone_at_any_size(spark, limits):
    schema = "k int, t int, v string"
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], schema)
    changes = spark.createDataFrame([(2, 9, "z")], schema)
    got = sw.upsert(target, changes, ["k"], [F.col("t").desc()], **limits)
    want = [(1, 1, "a"), (1, 2, "b"), (2, 9, "z"), (None, 1, "d")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_upsert_with_a_hot_change_and_null_keys(events):
    key = F.when(F.col("event_id") % 3 == 0, 5).when(F.col("event_id") % 7 != 0, F.col("event_id"))
    changes = events.withColumn("event_id", key).withColumn("value", F.col("value") + 1)
    target = events.withColumn("event_id", F.when(F.col("event_id") != 9, F.col("event_id")))
    newest = [F.col(NEWEST).desc()]
    full = sw.upsert(target, changes, ["event_id"], newest)
    assert full.filter("event_id IS NULL").count() == 1
    assert full.filter("event_id = 5").count() == 1
    for limits in LIMITS:
        assert same_rows(full, sw.upsert(target, changes, ["event_id"], newest, **limits))


def test_upsert_change_wins_a_tie_and_loses_when_older(spark):
    schema = "k int, t int, v string"
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, 5, "old")], schema)
    changes = spark.createDataFrame([(1, 5, "new"), (2, 4, "new"), (4, 1, "new")], schema)
    for limits in LIMITS:
        got = sw.upsert(target, changes, ["k"], [F.col("t").desc()], **limits)
        assert sorted(got.collect()) == [(1, 5, "new"), (2, 5, "old"), (3, 5, "old"), (4, 1, "new")]


def test_untouched_target_rows_are_not_shuffled(events):
    got = sw.upsert(events, changes_of(events), ["event_id"], ["ts"])
    plan = plan_of(got)
    assert plan.count("LeftAnti, BuildRight") >= 1 and "SortMergeJoin" not in plan


def test_user_columns_of_any_name_and_maps_survive(spark):
    names = ["_rank", "_change", "_changed_k", "_salt", "_place", "_hash", "_hot"]
    target = spark.range(6).selectExpr(
        "id % 3 AS k", "id AS t", "map('x', id) AS m", "array(map(id, 'y')) AS deep",
        *[f"id * 10 AS {name}" for name in names],
    )
    changes = target.filter("t = 3").withColumn("t", F.lit(9).cast("bigint"))
    got = sw.upsert(target, changes, ["k"], [F.col("t").desc()])
    assert got.columns == target.columns
    assert sorted((r.k, r.t, r.m["x"], r["_change"]) for r in got.collect()) == [
        (0, 9, 3, 30), (1, 1, 1, 10), (1, 4, 4, 40), (2, 2, 2, 20), (2, 5, 5, 50),
    ]
    once = sw.dedup(target, ["k"], [F.lit(1)])
    assert once.columns == target.columns and once.count() == 3
    new = sw.new_keys(target, target.filter("k = 1"), ["k"], hot_rows=1)
    assert new.columns == target.columns and new.count() == 4


def test_upsert_writes_only_touched_partitions(spark, events):
    path, newest = f"{fresh(spark)}/table", [F.col(NEWEST).desc()]
    assert sw.upsert_partitions(spark, path, events, ["event_id"], newest, 16) == 16
    before = set(spark.read.parquet(path).inputFiles())
    changes = fx.revised_events(events).filter("event_id = 10")
    assert sw.upsert_partitions(spark, path, changes, ["event_id"], newest, 16) == 1
    after = set(spark.read.parquet(path).inputFiles())
    assert len(before & after) >= len(before) - 1
    want = sw.upsert(events, changes, ["event_id"], newest)
    assert same_rows(sw.read_layer(spark, path), want)
    assert sw.upsert_partitions(spark, path, changes.limit(0), ["event_id"], newest, 16) == 0
    with pytest.raises(ValueError, match="buckets"):
        sw.upsert_partitions(spark, path, changes, ["event_id"], newest, 8)


# reporting


def test_exact_figures_do_not_depend_on_order(lineitem):
    aggs = {"s": sw.exact_sum("l_extendedprice", 2), "a": sw.exact_avg("l_extendedprice", 2)}
    once = sw.headline(lineitem, aggs).first()
    again = sw.headline(lineitem.orderBy(F.rand(1)), aggs).first()
    cents = sum(round(r.l_extendedprice * 100) for r in lineitem.collect())
    assert once == again and once.s == cents / 100
    assert once.a == pytest.approx(cents / 100 / lineitem.count(), rel=1e-12)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sum_of_hard_values(spark, ansi):
    import duckdb

    nan, inf = float("nan"), float("inf")
    cases = {
        "nan": [nan, 1.0], "inf": [inf, 1.0], "both": [inf, -inf], "large": [1e17, 1.0, -1e17, 0.01],
        "many": [9e16] * 3000, "none": [None, None], "mixed": [None, 0.1, 0.2, -0.3], "huge": [1e300, 1.0],
        "edge": [10995116277.76, 0.01, -10995116277.77], "tiny": [0.005, 0.015, 0.025],
    }
    rows = [(name, v) for name, values in cases.items() for v in values]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(rows, "name string, v double")
        figures = {"s": sw.exact_sum("v", 2), "a": sw.exact_avg("v", 2)}
        got = {r["name"]: (r["s"], r["a"]) for r in sw.measures(df, ["name"], figures).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    for name in ("large", "many", "mixed", "edge"):
        values = ", ".join(f"({v if v is not None else 'NULL'}::DOUBLE)" for v in cases[name])
        sql = f"SELECT CAST(sum(CAST(v AS DECIMAL(38,2))) AS DOUBLE) FROM (VALUES {values}) t(v)"
        assert got[name][0] == duckdb.sql(sql).fetchall()[0][0], name
    assert got["nan"][0] != got["nan"][0] and got["both"][0] != got["both"][0]
    assert got["inf"][0] == inf and got["none"] == (None, None) and got["huge"][0] == 1e300
    assert got["many"][0] == 2.7e20 and got["tiny"][0] == 0.04


@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter", "year"])
def test_time_buckets_against_brute_force(spark, events, grain):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = {r[0]: r.n for r in sw.time_series(events, "ts", grain, {"n": sw.row_count()}).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

    def bucket(day):
        if grain == "week":
            return day - datetime.timedelta(days=day.weekday())
        if grain == "month":
            return day.replace(day=1)
        if grain == "quarter":
            return day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1)
        if grain == "year":
            return day.replace(month=1, day=1)
        return day

    want = {}
    for r in events.collect():
        key = bucket(r.ts.date())
        want[key] = want.get(key, 0) + 1
    assert got == want


def test_unknown_grain_is_refused(events):
    with pytest.raises(ValueError):
        sw.time_series(events, "ts", "fortnight", {"n": sw.row_count()})


def test_top_n_breaks_ties_by_key_and_is_not_a_full_sort(spark, events):
    got = sw.top_n(events, ["user_id"], {"n": sw.row_count()}, 7)
    counts = {}
    for r in events.collect():
        counts[r.user_id] = counts.get(r.user_id, 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:7]
    assert [tuple(r) for r in got.collect()] == want
    assert "TakeOrderedAndProject" in plan_of(got)
    assert sw.top_n(events, ["user_id"], {"n": sw.row_count()}, 10**6).count() == len(counts)


def test_reports_combine_before_the_shuffle(events):
    plan = plan_of(sw.measures(events, ["event_type"], {"n": sw.row_count()}))
    assert "partial_count" in plan and plan.count("Exchange") == 1
    assert "ReadSchema: struct<event_type:string>" in plan


def test_dashboard_builds_every_panel(spark, events):
    figures = {"n": sw.row_count(), "total": sw.exact_sum("value", 2)}
    tables = sw.dashboard_dataset(
        events,
        {
            "by_type": sw.Grouped(["event_type"], figures),
            "by_day": sw.Series("ts", "day", figures, dims=["event_type"]),
            "totals": sw.Headline({**figures, "users": sw.distinct_count("user_id")}),
            "busiest": sw.Ranking(["user_id"], {"n": sw.row_count()}, 3),
        },
        f"{fresh(spark)}/panels",
    )
    total = events.count()
    assert tables["by_type"].agg(F.sum("n")).first()[0] == total
    assert tables["by_day"].agg(F.sum("n")).first()[0] == total
    assert tables["totals"].collect() == [
        (total, tables["totals"].first().total, events.select("user_id").distinct().count())
    ]
    assert tables["busiest"].columns == ["user_id", "n"] and tables["busiest"].count() == 3


def test_panels_can_be_built_from_a_summary_layer(spark, events):
    out = f"{fresh(spark)}/summary"
    figures = {"n": sw.row_count(), "total": sw.exact_sum("value", 2)}
    sw.bronze_append(sw.time_series(events, "ts", "day", figures, dims=["event_type"]), out)
    again = {"n": F.sum("n"), "total": sw.exact_sum("total", 2)}

    def panels(aggs, time_col):
        return {
            "by_type": sw.Grouped(["event_type"], aggs),
            "by_month": sw.Series(time_col, "month", aggs),
            "totals": sw.Headline(aggs),
        }

    raw = sw.dashboard_dataset(events, panels(figures, "ts"), f"{fresh(spark)}/raw")
    layer = sw.read_layer(spark, out)
    summed = sw.dashboard_dataset(layer, panels(again, "day"), f"{fresh(spark)}/summed")
    for name, table in raw.items():
        assert same_rows(table, summed[name])


# silver and namespaces


@pytest.fixture
def rules(spark):
    return sw.SilverRules(
        mapping=[
            sw.Field("event_id", "bigint"),
            sw.Field("value", "double"),
            sw.Field("user_id", "bigint"),
        ],
        valid={"value": F.col("value").isNotNull()},
        keys=["event_id"],
        order=["value"],
    )


def test_silver_accepts_or_quarantines_every_record(spark, events, rules):
    odd = F.when(F.col("event_id") == 7, "abc").otherwise(F.col("user_id"))
    dirty = fx.dirty_events(events).withColumn("user_id", odd)
    silver = sw.silver_build(dirty, rules, f"{fresh(spark)}/silver")
    assert silver.accepted.count() + silver.quarantined.count() == events.count()
    rows = silver.quarantined.collect()
    assert {tuple(r.reasons) for r in rows} == {("unfit:value", "value"), ("unfit:user_id",)}
    raw = {json.loads(r.raw)["event_id"]: json.loads(r.raw) for r in rows}
    assert raw["7"]["user_id"] == "abc" and raw["97"]["value"] == "n/a" and "props" in raw["97"]
    assert plan_of(silver.accepted).count("Exchange") == 1


def test_silver_update_equals_a_rebuild_and_takes_each_load_once(spark, events, rules):
    work = fresh(spark)
    loads = [events.filter("event_id < 600"), fx.revised_events(events), events.filter("event_id >= 600")]
    written = []
    for load, rows in enumerate(loads):
        sw.bronze_append(fx.dirty_events(rows), f"{work}/bronze", load)
        bronze = sw.read_layer(spark, f"{work}/bronze")
        written.append(sw.silver_update(bronze, rules, f"{work}/silver", "load_no", buckets=8))
        assert sw.silver_update(bronze, rules, f"{work}/silver", "load_no", buckets=8) == 0
    assert all(written)
    kept = sw.read_silver(bronze, rules, f"{work}/silver")
    rebuilt = sw.silver_build(bronze, rules, f"{work}/rebuilt")
    assert same_rows(kept.accepted, rebuilt.accepted)
    assert kept.quarantined.count() == rebuilt.quarantined.count() > 0
    one = fx.dirty_events(events.filter("event_id = 3"))
    sw.bronze_append(one, f"{work}/bronze", 9)
    bronze = sw.read_layer(spark, f"{work}/bronze")
    assert sw.silver_update(bronze, rules, f"{work}/silver", "load_no", buckets=8) == 1


def test_a_zoned_text_is_an_instant(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = [
        "2024-01-01T00:00:00+05:00", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "2024-01-01",
        "2024-01-01 00:00:00 Europe/Paris", "2024-01-01 00:00:00.25-0330", "nonsense", "",
    ]
    want = [
        datetime.datetime(2023, 12, 31, 19), datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1),
        datetime.datetime(2024, 1, 1), None, datetime.datetime(2024, 1, 1, 3, 30, 0, 250000), None, None,
    ]
    for session in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", session)
        try:
            df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
            got = sw.conform(df, [sw.Field("i", "int"), sw.Field("t", "timestamp_ntz")]).orderBy("i")
            assert [r.t for r in got.collect()] == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([("2024-07-01T00:00:00Z",)], "t string")
    got = sw.conform(df, [sw.Field("t", "timestamp_ntz", zone="Europe/Paris")])
    assert got.first().t == datetime.datetime(2024, 7, 1, 2)


def test_loads_are_replaced_whole_and_keep_their_values(spark):
    out = f"{fresh(spark)}/bronze"
    rows = spark.createDataFrame([("007", 1), ("", 2), ("12", 3)], "code string, v int")
    sw.bronze_append(rows, out, load="0012", partition_by=["code"])
    assert same_rows(sw.read_layer(spark, out).drop("load_no"), rows)
    assert {r.load_no for r in sw.read_layer(spark, out).collect()} == {"0012"}
    sw.bronze_append(rows.filter("v = 1"), out, load="0012", partition_by=["code"])
    assert same_rows(sw.read_layer(spark, out).drop("load_no"), rows.filter("v = 1"))
    schema = sw.read_layer(spark, out).schema
    sw.bronze_append(rows.limit(0), out, load="0012", partition_by=["code"])
    assert sw.read_layer(spark, out, schema).collect() == []
    assert sw.read_layer(spark, f"{out}/nowhere", schema).collect() == []
    with pytest.raises(ValueError, match="load_no"):
        sw.bronze_append(rows.withColumn("load_no", F.lit(77)), out, load=1)
    with pytest.raises(ValueError, match="code__part"):
        sw.bronze_append(rows.withColumn("code__part", F.lit(1)), out, partition_by=["code"])


def test_read_since_up_to_a_mark_taken_before(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "m int")
    assert sorted(r.m for r in sw.read_since(rows, "m", None, 2).collect()) == [1, 2]
    assert sorted(r.m for r in sw.read_since(rows, "m", 2, 3).collect()) == [3]


def test_layers_are_created_once_and_in_place(spark, events):
    root, name = f"{fresh(spark)}/it's here", f"layer_{token()}"
    first = sw.create_layers(spark, [name], root)
    assert first == sw.create_layers(spark, [name], root)
    events.write.saveAsTable(f"{name}.events")
    assert spark.read.parquet(f"{first[name]}/events").count() == events.count()
    with pytest.raises(ValueError, match="lies at"):
        sw.create_layers(spark, [name], fresh(spark))


def test_workspace_lies_in_a_folder_that_all_share(spark):
    from stratawell.functions.storage import workspace

    class Session:
        def __init__(self, **settings):
            self.conf = settings

    known = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.sql.warehouse.dir": "s3a://b/w"}
    both, one = Session(**known), Session(**{"spark.sql.warehouse.dir": "s3a://b/w"})
    assert workspace(both).startswith("hdfs:///shared/stratawell/")
    assert workspace(one).startswith("s3a://b/w/stratawell/")
