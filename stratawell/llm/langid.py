"""Language of a text by its nearest centroid.

A text is a vector of hashed byte n-grams of its letters, weighted by TF-IDF and of length one.
Each language has several centroids, found by spherical k-means on a sample of its texts.  The
language is that of the centroid with the largest cosine; a text too far from it is rejected.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratawell.llm.common import Steps, lowest_hashes, unused

#: Hashed n-grams: so many buckets, for these lengths in bytes.
BUCKETS = 1 << 14
GRAMS = (2, 3)
#: Texts for each language that centroids are fitted on, and centroids for each language.
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 12
#: This share of a sample may be junk or have a wrong label: it neither makes a centroid nor sets a floor.
OUTLIERS = 0.1
#: Numbers of words for which a language has a floor, from pieces of its sample of that length.  A text is
#: rejected below the floor for its words: this share of what all but the outliers reach.
PIECES = (1, 2, 4, 8, 16, 32, 64, 128, 256)
REJECT_SHARE = 0.5
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]+")
#: Words are cut off here for counting n-grams only piece by piece, which bounds memory.
_SLICE = 1 << 20


def letters(text: str | None) -> bytes:
    """The words of a text in lower case, each between spaces; empty if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return f" {_NO_LETTER.sub(' ', text.lower()).strip()} ".encode()


def gram_counts(text: bytes) -> np.ndarray:
    """How often each bucket occurs among the n-grams of a text."""
    counts = np.zeros(BUCKETS)
    reach = max(GRAMS) - 1
    for at in range(0, len(text), _SLICE):
        some = np.frombuffer(text[at : at + _SLICE + reach], dtype=np.uint8).astype(np.uint32)
        for n in GRAMS:
            # each n-gram starts in exactly one slice
            size = min(_SLICE, len(some) - n + 1)
            if size > 0:
                code = np.full(size, n, dtype=np.uint32)
                for i in range(n):
                    code = code * np.uint32(256) + some[i : i + size]
                code = code * np.uint32(2654435761) >> np.uint32(32 - BUCKETS.bit_length() + 1)
                counts += np.bincount(code, minlength=BUCKETS)
    return counts


def vector(found: bytes, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vector, of length one, of what ``letters`` gives for a text with letters."""
    weights = np.log1p(gram_counts(found)) * idf
    return (weights / np.linalg.norm(weights)).astype(np.float32)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """For each bucket the number of texts that have it, and the number of texts with letters."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in rows:
            for text in batch.column(0):
                found = letters(text.as_py())
                if found:
                    total += gram_counts(found) > 0
                    n += 1
        if n:
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(there, -1)), pa.array(np.append(total[there], n))],
                names=["bucket", "n"],
            )

    counts = texts.mapInArrow(batches, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n"))
    frequency, n = np.zeros(BUCKETS), 0
    for bucket, found in counts.collect():  # at most one row for each bucket
        if bucket < 0:
            n = found
        else:
            frequency[bucket] = found
    return frequency, n


def _sample(steps: Steps, rows: DataFrame) -> DataFrame:
    """The ``SAMPLE`` texts with letters of each language whose places are smallest.

    Texts are ranked within a share of all that should hold enough of them; where few texts have
    letters, within all.
    """
    first = Window.partitionBy("lang").orderBy("place", "text")
    lettered = rows.filter(F.col("text").rlike(r"\p{L}"))
    # one row for each language
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    near = F.lit(False)
    for lang, count in counts.items():
        near |= (F.col("lang") == lang) & lowest_hashes(F.col("place"), count, SAMPLE)

    def ranked(texts: DataFrame) -> DataFrame:
        nth = F.row_number().over(first)
        return steps.save(texts.withColumn("nth", nth).filter(F.col("nth") <= SAMPLE))

    sample = ranked(lettered.filter(near))
    found = {row["lang"]: row["count"] for row in sample.groupBy("lang").count().collect()}
    short = [x for x, n in counts.items() if n > 4 * SAMPLE and found.get(x, 0) < SAMPLE]
    if short:
        again = ranked(lettered.filter(F.col("lang").isin(short)))
        sample = sample.filter(~F.col("lang").isin(short)).unionByName(again)
    return sample


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of vectors of length one."""
    centre = vectors.mean(axis=0)
    chosen = [int((vectors @ centre).argmax())]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        # far from those chosen, but not among the outliers
        chosen.append(int(np.argsort(near, kind="stable")[int(OUTLIERS * len(near))]))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(ROUNDS):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.array([vectors[nearest == i].sum(axis=0) for i in range(len(centroids))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    # What few texts are near to may be a centroid of outliers.
    share = np.bincount((vectors @ centroids.T).argmax(axis=1), minlength=len(centroids)) / len(vectors)
    return centroids[(share >= OUTLIERS) | (share == share.max())]


def _piece(found: bytes, n: int, nth: int) -> bytes | None:
    """``n`` words of a text from somewhere in it, which depends on its number; None if it has fewer."""
    words = found.split()
    if len(words) < n:
        return None
    start = nth * 7919 % (len(words) - n + 1)
    return b" %b " % b" ".join(words[start : start + n])


def _floors(texts: list[bytes], centroids: np.ndarray, idf: np.ndarray) -> list[float]:
    """For each number of words the cosine below which a text is none of the language's."""
    floors: list[float] = []
    for n in PIECES:
        pieces = [piece for i, text in enumerate(texts) if (piece := _piece(text, n, i))]
        if not pieces:
            floors.append(floors[-1])
            continue
        cosines = [float((centroids @ vector(piece, idf)).max()) for piece in pieces]
        floors.append(REJECT_SHARE * float(np.quantile(cosines, OUTLIERS)))
    return floors


class Centroids:
    """A fitted model: languages, their centroids, and for numbers of words the cosines below which each rejects."""

    def __init__(self, idf: np.ndarray, langs: list[str], vectors: np.ndarray, floors: np.ndarray):
        self.idf, self.langs, self.vectors, self.floors = idf, langs, vectors, floors

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine from 0 to 1, and whether the text is too far from all centroids."""
        found = letters(text)
        if not self.langs or not found:
            return UNKNOWN, 0.0, True
        cosines = self.vectors @ vector(found, self.idf)
        best = int(cosines.argmax())
        score = min(1.0, max(0.0, float(cosines[best])))
        words = max(1, len(found.split()))
        floor = self.floors[best][bisect_right(PIECES, words) - 1]
        return self.langs[best], score, bool(score < floor)


def fit(train: DataFrame, text_col: str, lang_col: str, place: Column) -> Centroids:
    """Centroids of the languages in ``train``.

    IDF counts every text.  Centroids are fitted on the ``SAMPLE`` texts with letters of each
    language that have the smallest ``place``, a 64-bit hash of the row.  A tenth of them may be junk
    or wrongly labelled.  How close to a centroid a text of the language must be depends on its number
    of words, as short texts are never very close; it is learned from pieces of the sample.  Rows with a NULL language or text
    take no part.  Equal cosines go to the language that sorts first.
    """
    steps = Steps(train.sparkSession)
    rows = train.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    frequency, n = document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    sample = _sample(steps, rows)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        found = [letters(text) for text in group["text"]]
        found = [x for x in found if x]
        if not found:
            return pd.DataFrame({"lang": [], "floors": [], "centroid": []})
        centroids = _cluster(np.array([vector(x, idf) for x in found]), CENTROIDS)
        floors = _floors(found, centroids, idf)
        return pd.DataFrame(
            {
                "lang": group["lang"].iloc[0],
                "floors": [floors] * len(centroids),
                "centroid": [x.astype("<f4").tobytes() for x in centroids],
            }
        )

    fitted = (
        sample.groupBy("lang")
        .applyInPandas(cluster, "lang string, floors array<double>, centroid binary")
        .collect()  # CENTROIDS rows for each language
    )
    fitted.sort(key=lambda row: (row["lang"], bytes(row["centroid"])))
    vectors = np.array([np.frombuffer(row["centroid"], dtype="<f4") for row in fitted])
    return Centroids(
        idf,
        [row["lang"] for row in fitted],
        vectors.reshape(-1, BUCKETS),
        np.array([row["floors"] for row in fitted]).reshape(-1, len(PIECES)),
    )


def identify(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """All rows and columns, with ``lang_pred``, ``lang_score`` and ``lang_rejected`` added.

    A NULL text or one without letters is ``und``, has score 0 and is rejected.  A model of no
    languages rejects everything.  The new names get a leading underscore where they are taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages * CENTROIDS vectors

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(text) for text in texts]
        return pd.DataFrame(found, columns=["lang", "score", "rejected"])

    call = unused(docs, "_language")
    names = [unused(docs, name) for name in ("lang_pred", "lang_score", "lang_rejected")]
    return docs.withColumn(call, predicted(F.col(text_col))).select(
        *[F.col(f"`{name}`") for name in docs.columns],
        *[F.col(f"{call}.{f}").alias(n) for f, n in zip(("lang", "score", "rejected"), names)],
    )
