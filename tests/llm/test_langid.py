import zlib

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratawell.llm import langid, queries
from tests.llm.cases import DATA, hard_docs, no_docs, table


def test_held_out_accuracy(spark):
    got = queries.op5_language_id(spark, DATA.replace("0.001", "0.01"))
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in rows) < 0.005 * len(rows)


def _docs(spark):
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    return docs.filter("lang IS NOT NULL").select("doc_id", "text", "lang")


def _right(spark, model, docs):
    rows = langid.identify(docs, model).collect()
    rows = [r for r in rows if r["lang_pred"] != "und"]
    return sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows), sum(r["lang_rejected"] for r in rows) / len(rows)


def test_wrong_labels_and_junk_change_nothing(spark):
    docs = _docs(spark)
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect())
    fewest = min(r["count"] for r in docs.groupBy("lang").count().collect())
    # of each language as many get the label of the next: one in twenty of the smallest
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit("wrong"))))
    following = F.create_map(*[F.lit(x) for pair in zip(langs, langs[1:] + langs[:1]) for x in pair])
    docs = docs.withColumn("nth", nth)
    some, others = F.col("nth") <= fewest // 20, F.element_at(following, F.col("lang"))
    junk = F.when(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("junk")), F.lit(50)) == 0, "qzx wvq jjx zzk " * 9)
    spoilt = docs.withColumn("lang", F.when(some, others).otherwise(F.col("lang")))
    spoilt = spoilt.withColumn("text", F.coalesce(junk, F.col("text")))
    right, rejected = _right(spark, langid.fit(spoilt, "text", "lang", F.xxhash64("doc_id")), docs)
    assert right > 0.97 and rejected < 0.01


def test_short_clean_texts_stay_and_foreign_texts_go(spark):
    docs = _docs(spark)
    model = langid.fit(docs, "text", "lang", F.xxhash64("doc_id"))
    words = F.split(F.trim("text"), r"\s+")
    for n in (1, 2, 5, 20):
        some = docs.filter(F.size(words) >= n + 5).withColumn("text", F.array_join(F.slice(words, 4, n), " "))
        rows = [r for r in langid.identify(some, model).collect() if r["lang_pred"] != "und"]
        assert sum(r["lang_rejected"] for r in rows) < 0.05 * len(rows), n
    foreign = [
        "\u0397 \u03b3\u03c1\u03ae\u03b3\u03bf\u03c1\u03b7 \u03b1\u03bb\u03b5\u03c0\u03bf\u03cd \u03c0\u03b7\u03b4\u03ac\u03b5\u03b9 \u03c0\u03ac\u03bd\u03c9 \u03b1\u03c0\u03cc \u03c4\u03bf \u03c3\u03ba\u03c5\u03bb\u03af",
        "xqzk wvjq zzxk qqkz jxvw kqzj vvqx " * 4,
        "\u0411\u044b\u0441\u0442\u0440\u0430\u044f \u043a\u043e\u0440\u0438\u0447\u043d\u0435\u0432\u0430\u044f \u043b\u0438\u0441\u0430 \u043f\u0440\u044b\u0433\u0430\u0435\u0442 \u0447\u0435\u0440\u0435\u0437 \u0441\u043e\u0431\u0430\u043a\u0443",
    ]
    rows = langid.identify(spark.createDataFrame([(t,) for t in foreign], "text string"), model).collect()
    assert all(r["lang_rejected"] for r in rows)


def test_fit_against_brute_force(spark):
    """IDF from all texts, and floors from pieces of the sample: here all texts."""
    docs = table(spark, "documents").filter("lang IS NOT NULL")
    model = langid.fit(docs, "text", "lang", F.xxhash64("doc_id"))
    place = docs.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "text").collect()
    texts = [langid.letters(r["text"]) for r in place]
    counts = np.array([langid.gram_counts(t) > 0 for t in texts if t])
    assert np.allclose(model.idf, np.log((1 + len(counts)) / (1 + counts.sum(axis=0))) + 1)
    for lang in set(model.langs):
        mine = [i for i, x in enumerate(model.langs) if x == lang]
        centroids = model.vectors[mine]
        assert np.allclose(np.linalg.norm(centroids, axis=1), 1, atol=1e-4)
        cosines = []
        for text in (langid.letters(r["text"]) for r in place if r["lang"] == lang):
            if len(text.split()) >= 16:
                cosines.append(float((centroids @ langid.vector(text, model.idf)).max()))
        assert (model.floors[mine] == model.floors[mine[0]]).all()
        assert 0 < model.floors[mine[0]][0] < model.floors[mine[0]][4] < max(cosines)


def test_prediction_against_brute_force(spark):
    docs = table(spark, "documents")
    model = langid.fit(docs, "text", "lang", F.xxhash64("doc_id"))
    for row in langid.identify(docs, model).limit(40).collect():
        found = langid.letters(row["text"])
        grams = {}
        for n in langid.GRAMS:
            for i in range(len(found) - n + 1):
                code = n
                for byte in found[i : i + n]:
                    code = (code * 256 + byte) % 2**32
                bucket = code * 2654435761 % 2**32 >> 32 - 14
                grams[bucket] = grams.get(bucket, 0) + 1
        weights = np.zeros(langid.BUCKETS)
        for bucket, count in grams.items():
            weights[bucket] = np.log1p(count) * model.idf[bucket]
        cosines = model.vectors @ (weights / np.linalg.norm(weights))
        assert abs(cosines.max() - row["lang_score"]) < 1e-5
        assert row["lang_pred"] == model.langs[int(cosines.argmax())]


def test_hard_rows(spark):
    docs = hard_docs(spark)
    model = langid.fit(docs, "text", "lang", F.xxhash64("doc_id"))
    assert set(model.langs) == {"en", "de"}
    got = langid.identify(docs, model)
    assert got.columns == [*docs.columns, "_lang_pred", "_lang_score", "lang_rejected"]
    rows = {r["doc_id"]: r for r in got.collect()}
    for doc in (0, 1, 2, 10, 19):
        assert rows[doc]["_lang_pred"] == ("und" if doc != 10 else "und")
        assert rows[doc]["lang_rejected"] and rows[doc]["_lang_score"] == 0
    assert rows[7]["_lang_pred"] in ("en", "de")


def test_no_rows(spark):
    model = langid.fit(no_docs(spark), "text", "lang", F.xxhash64("doc_id"))
    assert langid.identify(no_docs(spark), model).collect() == []
    assert {r["lang_pred"] for r in langid.identify(table(spark, "documents"), model).collect()} == {"und"}


def test_long_texts_are_counted_in_slices(monkeypatch):
    text = langid.letters("the quick brown fox " * 200)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_SLICE", 7)
    assert (langid.gram_counts(text) == whole).all()
