"""Random small tables with repeats, ties and NULLs, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import stratawell as sw

SCHEMA = "a int, b string, t int, v int"


def rows(rng, n):
    def maybe(value, share=0.15):
        return None if rng.random() < share else value

    # A third of all rows share one key.
    return [
        (7, "x", rng.randrange(9), rng.randrange(4))
        if rng.random() < 1 / 3
        else tuple(
            maybe(value)
            for value in (rng.randrange(12), rng.choice("xyz"), rng.randrange(9), rng.randrange(4))
        )
        for _ in range(n)
    ]


def nulls_first(value):
    return (value is not None, value if value is not None else 0)


def nulls_last_desc(value):
    return (value is None, -value if value is not None else 0)


def first_per_key(candidates, rank):
    best = {}
    for row in candidates:
        key = row[:2]
        if key not in best or rank(row) < rank(best[key]):
            best[key] = row
    return best


def ordered(found):
    return sorted((tuple(r) for r in found), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    old, new = rows(rng, 150), rows(rng, 150)
    target = spark.createDataFrame(old, SCHEMA).repartition(4)
    changes = spark.createDataFrame(new, SCHEMA).repartition(4)
    keys, newest = ["a", "b"], [F.col("t").desc()]

    def rank(row):
        return (nulls_last_desc(row[2]), nulls_first(row[2]), nulls_first(row[3]))

    kept = first_per_key(old, rank)
    unique = sw.dedup(target, keys, newest)
    assert ordered(unique.collect()) == ordered(kept.values())

    def rank_changed(tagged):
        row, change = tagged[2]
        return (nulls_last_desc(row[2]), -change, nulls_first(row[2]), nulls_first(row[3]))

    changed = {r[:2] for r in new}
    for base, start in ((target, old), (unique, list(kept.values()))):
        tagged = [(*r[:2], (r, 0)) for r in start if r[:2] in changed]
        tagged += [(*r[:2], (r, 1)) for r in new]
        want = [entry[2][0] for entry in first_per_key(tagged, rank_changed).values()]
        want += [r for r in start if r[:2] not in changed]
        for limits in ({}, {"broadcast_rows": 0}):
            got = sw.upsert(base, changes, keys, newest, **limits)
            assert ordered(got.collect()) == ordered(want)

    known = {r[:2] for r in old if None not in r[:2]}
    want = [r for r in new if None in r[:2] or r[:2] not in known]
    for hot_rows in (1, 5, 10**6, None):
        got = sw.new_keys(changes, target, keys, hot_rows=hot_rows)
        assert ordered(got.collect()) == ordered(want)

    rules = {"t": F.col("t") > 2, "v": F.col("v") != F.col("t")}
    accepted, quarantined = sw.split_valid(target, rules)

    def broken(row):
        t, v = row[2], row[3]
        reasons = [] if t is not None and t > 2 else ["t"]
        return reasons + ([] if None not in (t, v) and v != t else ["v"])

    assert ordered(accepted.collect()) == ordered(r for r in old if not broken(r))
    got = [(*r[:4], tuple(r.reasons)) for r in quarantined.collect()]
    assert ordered(got) == ordered((*r, tuple(broken(r))) for r in old if broken(r))
