"""Rows that are hard on operators, and plain Python twins."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
DATA = "/root/testdata/sf0.001"
#: Names that operators use inside.
CLASHING = [
    "id", "ids", "fp", "slot", "bits", "blocks", "pair", "members", "component", "node", "lo", "hi",
    "least", "part", "piece", "start", "length", "rank", "before", "first", "end", "sequence",
    "copies", "at", "count", "_kept", "private", "_email", "lang_pred", "lang_score", "_language",
    "rejected", "h", "pos", "hash", "place", "nth", "word", "words", "chunk", "score", "removed",
]


def hard_rows():
    rng = random.Random(7)
    words = [f"w{rng.randrange(300)}" for _ in range(30_000)]
    passage = " ".join(f"p{i}" for i in range(60))
    long_text = " ".join(words)
    texts = [
        None, "", " \t\n ", "one", "One TWO", "one two three four", "ONE two three FOUR",
        long_text, long_text + " tail", "x" * 20_000, "1 " * 3000, "ß İ Σς ﬁ é é 日本語 \U0001f600",
        f"begin here {passage} end here", f"other start {passage} other end", f"{passage} {passage}",
        "a b c\x0bd\x0ce\x1cf", "don't it's we'll I'm 12 345 !!", "<|endoftext|> </s> <unk> <0x41>",
        "▁a ▁▁b  c", "%%% *** 123", "mail a.b@c.de, then x@y.z_q@r.st and +1 (212) 555-1234.",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112, ip 1.2.3.4.5.6.7.8 and 300.1.1.1",
        "iban GB82 WEST 1234 5698 7654 32 or DE89370400440532013000 or DE89370400440532013001",
        "one two three four", "one",
    ]
    rows = [(i, t, ["en", "de", None][i % 3], "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[8]]  # repeated rows
    rows += [(None, "one", None, None, None), (None, "nothing like it at all", "en", None, 3)]
    return rows


def hard_docs(spark, clashing=True):
    docs = spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)
    if clashing:
        for name in CLASHING:
            docs = docs.withColumn(name, F.lit(name))
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def real_texts(spark):
    return [(r[0], r[1]) for r in table(spark, "documents").select("doc_id", "text").collect()]
