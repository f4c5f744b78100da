
import numpy as np
from pyspark.sql import functions as F

from stratawell.llm import queries, site_quality
from tests.llm.cases import DATA, hard_docs, no_docs

BIG = DATA.replace("0.001", "0.1")


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, measured on the others."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    models = site_quality.fit_text(
        docs.join(labels.filter(half), "doc_id"), "text", ["quality", "toxic"], F.xxhash64("doc_id")
    )
    scored = site_quality.site_quality(docs, models, F.col("source"), F.col("lang"))
    truth = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.filter(~half).collect()}
    rows = {r["doc_id"]: r for r in scored.collect()}
    right = [
        ((rows[i]["quality"] >= 0.5) == bool(q), (rows[i]["toxic"] >= 0.5) == bool(t))
        for i, (q, t) in truth.items()
    ]
    assert np.mean([r[0] for r in right]) > 0.97 and np.mean([r[1] for r in right]) > 0.96


def test_query_covers_all(spark):
    got = queries.op8_site_quality(spark, DATA)
    assert got.count() == got.select("doc_id").distinct().count() == 200
    assert got.filter("kept IS NULL OR quality NOT BETWEEN 0 AND 1").count() == 0


def test_posteriors_against_brute_force(spark):
    rows = [("a", "x", 2.0), ("a", "x", 1.0), ("a", "y", -3.0), ("b", "x", -1.0), (None, None, 0.5)] * 9
    scored = spark.createDataFrame(rows, "host string, path string, t double")
    from stratawell.llm.common import Steps

    odds, mean = site_quality._site_odds(Steps(spark), scored, "t")
    p = [(h, s, 1 / (1 + np.exp(-x))) for h, s, x in rows]
    assert np.isclose(mean, np.mean([x for *_, x in p]))

    def worth(groups):
        n = np.array([len(g) for g, _ in groups])
        means = np.array([np.mean(g) for g, _ in groups])
        prior = np.array([m for _, m in groups])
        spread, chance = (n * (means - prior) ** 2).sum(), (prior * (1 - prior)).sum()
        between = (spread - chance) / n.sum()
        return min(1e6, max(1.0, (prior * (1 - prior)).mean() / between - 1)) if between > 0 else 1e6

    hosts = {h: [x for a, _, x in p if a == h] for h, *_ in p}
    k = worth([(g, mean) for g in hosts.values()])
    prior = {h: (sum(g) + k * mean) / (len(g) + k) for h, g in hosts.items()}
    paths = {(h, s): [x for a, b, x in p if (a, b) == (h, s)] for h, s, _ in p}
    k = worth([(g, prior[h]) for (h, _), g in paths.items()])
    for row in odds.collect():
        g, h = paths[row["host"], row["path"]], row["host"]
        want = (sum(g) + k * prior[h]) / (len(g) + k)
        assert np.isclose(row["odds"], np.log(want / (1 - want)))


def test_hard_rows(spark):
    docs = hard_docs(spark).withColumn("q", F.col("doc_id") % 2)
    models = site_quality.fit_text(docs, "text", ["q"], F.xxhash64("doc_id"))
    got = site_quality.site_quality(docs, models, F.col("source"), F.col("lang"))
    assert got.columns == ["doc_id", "host", "path", "q"]
    assert got.count() == docs.count() and got.filter("q NOT BETWEEN 0 AND 1").count() == 0


def test_no_rows(spark):
    docs = no_docs(spark).withColumn("q", F.lit(1))
    models = site_quality.fit_text(docs, "text", ["q"], F.xxhash64("doc_id"))
    assert site_quality.site_quality(docs, models, F.col("source"), F.col("lang")).collect() == []
