import math
import os
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest

from stratawell.llm import kneser_ney, queries
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts

END, START = "</s>\n", "<s>\n"


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w] + [END]


def discounts(counts):
    n = [sum(1 for c in counts if c == i) for i in range(1, 5)]
    if not all(n):
        return [0, 0.5, 0.75, 0.9] if n[0] else [0, 0, 0, 0]
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return [0, *(min(max(d, 0), m) for d, m in zip(found, (0.999, 1.999, 2.999)))]


def brute(train, texts, order=3):
    """(n_tokens, n_known, train_tokens, base, score) of each text."""
    single = Counter()
    counts = {length: Counter() for length in range(1, order + 1)}
    for text in train:
        found = tokens(text)
        single.update(found)
        padded = [START] * (order - 1) + found
        counts[order].update(tuple(padded[i : i + order]) for i in range(len(found)))
    for length in range(order - 1, 0, -1):
        counts[length] = Counter(gram[1:] for gram in counts[length + 1])
    n, v = sum(single.values()), len(single)
    taken = {length: discounts(counts[length].values()) for length in counts}
    after = {length: defaultdict(list) for length in counts}
    for length, grams in counts.items():
        for gram, c in grams.items():
            after[length][gram[:-1]].append(c)
    known = {}

    def p(gram):
        if gram not in known:
            length = len(gram)
            low = p(gram[1:]) if length > 1 else 1 / (v + 1)
            follow = after[length].get(gram[:-1], [])
            if follow:
                d, c = taken[length], counts[length][gram]
                freed = sum(d[min(x, 3)] for x in follow)
                low = max(c - d[min(c, 3)], 0) / sum(follow) + freed / sum(follow) * low
            known[gram] = low
        return known[gram]

    out = []
    for text in texts:
        found, base, score = tokens(text), 0.0, 0.0
        padded = [START] * (order - 1) + found
        for i, w in enumerate(found):
            base += math.log10((single[w] + 1) / (n + v + 1))
            score += math.log10(p(tuple(padded[i : i + order])))
        out.append((len(found), sum(w in single for w in found), n, base, score))
    return out


def same(got, want):
    assert got[:3] == want[:3]
    assert got[3:5] == pytest.approx(want[3:5], rel=1e-9)


def test_query_against_brute_force(spark):
    rows = real_texts(spark)[:]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    want = brute([t for (_, t), h in zip(rows, held) if not h], [t for _, t in rows])
    got = {r["doc_id"]: r for r in queries.op3_kneser_ney(spark, DATA).collect()}
    assert len(got) == len(rows)
    for (i, _), h, w in zip(rows, held, want):
        assert got[i]["held_out"] == h
        same(tuple(got[i])[2:7], w)
    # better than add-one on what it has not seen
    assert sum(got[i]["score"] for (i, _), h in zip(rows, held) if h) > sum(
        got[i]["base_score"] for (i, _), h in zip(rows, held) if h
    )


@pytest.mark.parametrize(("order", "frequent"), [(2, 1), (3, 1), (3, 3), (3, None), (3, 10**9), (5, 2)])
def test_hard_rows(spark, order, frequent):
    texts = [r[1] for r in hard_rows()]
    docs = hard_docs(spark)
    model = kneser_ney.fit(docs, order=order, frequent=frequent)
    got = kneser_ney.score(docs, model).collect()
    want = brute(texts, texts, order)
    by = lambda r: (str(r[0]), r[1], r[2])
    pairs = zip(sorted(map(tuple, got), key=by), sorted(((r[0], *w) for r, w in zip(hard_rows(), want)), key=by))
    for g, w in pairs:
        assert g[0] == w[0]
        same(g[1:6], w[1:])


def test_no_rows(spark):
    model = kneser_ney.fit(no_docs(spark))
    assert kneser_ney.score(no_docs(spark), model).collect() == []
    row = kneser_ney.score(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), model).collect()[0]
    assert tuple(row)[:4] == (1, 3, 0, 0) and row["score"] == 0 == row["base_score"]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_probabilities_sum_to_one(spark, order):
    docs = spark.createDataFrame([(0, "a b a c"), (1, "b a"), (2, "a b a b")], "doc_id int, text string")
    model = kneser_ney.fit(docs, order=order)
    for context in ("", "a", "b", "c", "zzz", "a b", "b a b", "zzz a"):
        texts = [(i, f"{context} {w}".strip()) for i, w in enumerate(["a", "b", "c", "new"])]
        rows = spark.createDataFrame([*texts, (9, context)], "doc_id int, text string")
        import numpy as np

        hashes = [kneser_ney.token_hashes(t) for _, t in rows.collect()]
        prefix = kneser_ney._scores(model, [kneser_ney.token_hashes(context)])[3][0]
        end_of = {}
        total = 0.0
        for (i, text), h in zip([*texts, (9, context)], hashes):
            words = text.split()
            # log10 of the last word given the context: the text without its end token
            alone = kneser_ney._scores(model, [h[:-1]])[3][0] if len(words) else 0.0
            end_of[i] = alone
        head = end_of[9]
        total = sum(10 ** (end_of[i] - head) for i in range(4)) + 10 ** (prefix - head)
        assert np.isclose(total, 1.0), context


def test_files_that_cannot_be_seen_are_an_error(spark):
    """A worker without the folder does not score as if nothing were known."""
    import dataclasses

    docs = spark.createDataFrame([(1, "a b a c"), (2, "b c")], "doc_id int, text string")
    model = kneser_ney.fit(docs)
    lost = dataclasses.replace(model, folder=f"{model.folder}-elsewhere")
    with pytest.raises(Exception, match="not mounted"):
        kneser_ney.score(docs, lost).collect()
    words = dataclasses.replace(model.words, folder=f"{model.words.folder}-elsewhere")
    with pytest.raises(Exception, match="not mounted"):
        kneser_ney.score(docs, dataclasses.replace(model, words=words)).collect()


def test_longer_ngrams_tell_more(spark):
    """The third word tells the fourth, so an order of four is surest; what no order allows is refused."""
    lines = ["a x y b", "c x y d", "a x z d", "c x z b"] * 5
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")
    total = {}
    for order in (2, 3, 4):
        rows = kneser_ney.score(docs, kneser_ney.fit(docs, order=order)).collect()
        total[order] = sum(r["score"] for r in rows)
    assert total[2] < total[4] and total[3] < total[4]
    for order in (1, 9):
        with pytest.raises(ValueError):
            kneser_ney.fit(docs, order=order)


def test_bytes_that_are_not_text(spark):
    rows = spark.createDataFrame([(1, bytearray(b"a \xff b")), (2, bytearray(b"a \xef\xbf\xbd b"))], "doc_id int, text binary")
    docs = rows.selectExpr("doc_id", "cast(text as string) text")
    got = [tuple(r)[1:] for r in kneser_ney.score(docs, kneser_ney.fit(docs)).orderBy("doc_id").collect()]
    assert got[0] == got[1]


def test_counting_n_grams_holds_few_arrays_at_a_time():
    n = 1 << 18
    hashes = kneser_ney._mixed(np.arange(n, dtype=np.uint64) % np.uint64(5000) + np.uint64(1))
    known = np.unique(hashes)
    words = SimpleNamespace(starts=(0, len(known)), numbers=lambda sought: (np.searchsorted(known, sought), None))
    tracemalloc.start()
    try:
        grams, counts = kneser_ney._distinct(kneser_ney._grams(words, [hashes[:7], hashes[7:]], 3), None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counts.sum() == n and {column.dtype for column in grams} == {np.dtype("<u4")}
    assert peak < 85 * n  # 90 with columns of 64 bits and arrays kept beside their copies


def test_counts_that_a_byte_does_not_hold(spark):
    """Counts and contexts around 255, and a word with 300 others behind it."""
    texts = [f"p{n} q{n} r{n} " * n for n in (1, 2, 253, 254, 255, 256, 257, 700)]
    texts += [f"many {i}" for i in range(300)] + ["often again", "often again " * 400, "many many"]
    rows = list(enumerate(texts))
    asked = [*texts, "p255 q255 r254", "q256 r256 p256 r256", "many often", "again again often 7"]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for frequent in (None, 10):
        model = kneser_ney.fit(docs, frequent=frequent)
        got = kneser_ney.score(spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string"), model).collect()
        for g, w in zip(sorted(got), brute(texts, asked)):
            same(tuple(g)[1:6], w)


def test_files_of_a_model_are_small(spark):
    """Statistics and counts take a byte each, and no shuffle files of a step are left."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    lines = [" ".join(pick.choices(words, k=6)) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(lines * 3)), "doc_id int, text string").localCheckpoint()
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        paths = (files.apply(i).getPath() for i in range(files.size()))
        return {path for path in paths if os.path.basename(path).startswith("shuffle_")}

    before = shuffled()
    model = kneser_ney.fit(docs)
    left = sum(os.path.getsize(path) for path in shuffled() - before if os.path.exists(path))
    files = [x for x in Path(model.folder).rglob("*") if x.is_file() and "step" not in str(x.relative_to(model.folder))]
    triples = Counter()
    for line in lines * 3:
        found = [START] * 2 + tokens(line)
        triples.update(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    grams = {3: triples, 2: Counter(gram[1:] for gram in triples)}
    most = 24 * (model.distinct + 100)  # words, and how many are in front
    for length, counts in grams.items():
        # 12 bytes for a context, 9 for an n-gram; the rest is apart
        most += 12 * len({gram[:-1] for gram in counts}) + 9 * len(counts)
        most += sum(136 for x in files if x.parent.name == str(length)) + 4000
    assert sum(x.stat().st_size for x in files) < most
    assert left < model.distinct  # a byte for each word; the counts of words alone take more
