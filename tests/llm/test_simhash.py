import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stratawell.llm import queries, simhash
from stratawell.llm.common import Steps
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts


def brute_fingerprint(text, n=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, distance=4):
    """Smallest id in the component of each row."""
    group = list(range(len(ids)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[top(i)] = top(j)
    least = {}
    for i, one in enumerate(ids):
        if one is not None:
            least[top(i)] = min(least.get(top(i), one), one)
    return [least.get(top(i)) for i in range(len(ids))]


def expected(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    found = brute_components([i for i, _ in rows], prints)
    return sorted(
        ((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, found)), key=str
    )


def test_query_against_brute_force(spark):
    got = queries.op1_simhash_dedup(spark, DATA)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(real_texts(spark))


def test_hard_rows(spark):
    rows = [(r[0], r[1]) for r in hard_rows()]
    got = simhash.simhash_groups(hard_docs(spark))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_no_rows(spark):
    assert simhash.simhash_groups(no_docs(spark)).collect() == []
    assert simhash.drop_near_copies(no_docs(spark)).collect() == []


def test_stage_keeps_one_of_each_component(spark):
    docs = hard_docs(spark)
    groups = {r[0]: r[2] for r in simhash.simhash_groups(docs).collect() if r[0] is not None}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    assert sorted(r[0] for r in rows if r[0] is not None) == sorted(set(groups.values()))
    assert [r[1] for r in rows if r[0] is None] == ["nothing like it at all"]
    alone = docs.filter("doc_id IS NULL AND text = 'one'")
    assert simhash.drop_near_copies(alone.unionByName(alone)).count() == 1


def _around(rng, centre, n, bits):
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randrange(bits + 1)):
            x ^= 1 << b
        out.add(x)
    return out


def test_dense_groups_and_full_keys(spark, monkeypatch):
    """Blocks of a key find the same components as one piece, within groups and along chains."""
    rng = random.Random(3)
    values = _around(rng, rng.getrandbits(64), 300, 3) | {rng.getrandbits(64) for _ in range(200)}
    chain = rng.getrandbits(64)
    for b in rng.sample(range(64), 40):
        values.add(chain)
        chain ^= 1 << b
    values = sorted(values)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in values]
    want = brute_components(list(range(len(values))), values)
    for block in (16, 4096):
        monkeypatch.setattr(simhash, "BLOCK", block)
        steps = Steps(spark)
        fps = spark.createDataFrame(signed, "fp bigint")
        edges = simhash.links(steps, fps, 4)
        from stratawell.llm.components import components

        found = dict(map(tuple, components(steps, edges).collect()))
        named = [found.get(s, s) for (s,) in signed]
        assert len(set(zip(named, want))) == len(set(named)) == len(set(want))


def test_every_pair_within_distance_meets(spark):
    """Each number of differing bits up to four is found wherever the bits are."""
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for bits in range(1, 5):
        for _ in range(40):
            a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
            b = a
            for at in rng.choice(64, bits, replace=False):
                b ^= 1 << int(at)
            rows += [(x - (1 << 64) if x >> 63 else x,) for x in (a, b)]
            n += 1
    edges = simhash.links(Steps(spark), spark.createDataFrame(rows, "fp bigint"), 4)
    assert edges.distinct().count() == n


def test_smaller_distance(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "A b c d e"), (3, "z")], "doc_id int, text string")
    got = simhash.simhash_groups(docs.select("doc_id", "text", F.lit(1).alias("fp")), distance=0)
    assert {(r[0], r[2]) for r in got.collect()} == {(1, 1), (2, 1), (3, 3)}
