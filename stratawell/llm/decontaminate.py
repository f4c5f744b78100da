"""Passages of benchmark items in documents, by a prefix-filtered join, with DataFrame functions only.

An item is cut into windows of consecutive words, and a window into shingles.  A stretch of a document
that holds enough of a window's shingles in their places holds at least one of any few of them, so the
few that are rarest in the documents are enough to find it: only these, the window's prefix, are joined.
What they find must leave room for the whole window, and is then compared shingle by shingle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratawell.llm.common import Steps

#: A run of characters that are no ASCII punctuation, space or control character.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What is broadcast at a time has about this many bytes at most; more goes in blocks, each with a
#: pass of its own over the documents.
BLOCK_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none for NULL."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    found = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _shingle(hashes: Column, at: Column, size: int) -> Column:
    """The hash of ``size`` words from a place on, by the hashes of the words."""
    return F.xxhash64(*[F.get(hashes, at + F.lit(i)) for i in range(size)])


def _hashes(words: str) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


class _Documents:
    """Documents as places of their words, one row each."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        text = F.col(text_col)
        rows = docs.select(
            F.col(id_col).alias("id"),
            # With the id these tell texts apart; equal rows are counted instead.
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit(1), text).alias("h2"),
            words_of(text).alias("words"),
        )
        self.rows = rows.select(
            "*", F.size("words").alias("n_words"), _hashes("words").alias("hashes")
        )

    def places(self, sizes: list[int]) -> DataFrame:
        """A row for each shingle, and one at -1 with no hash for each document."""
        at = self.rows.withColumn("at", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)))

        def fits(size: int) -> Column:
            there = (F.col("at") >= 0) & (F.col("at") + size <= F.col("n_words"))
            return F.when(there, _shingle(F.col("hashes"), F.col("at"), size))

        if len(sizes) == 1:
            return at.withColumn("hash", fits(sizes[0]))
        none = F.array(F.lit(None).cast("bigint"))
        of_sizes = F.when(F.col("at") < 0, none).otherwise(F.array(*map(fits, sizes)))
        return at.withColumn("hash", F.explode(of_sizes))


def _windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, window): each run of ``window`` words, or all words where these are fewer."""
    words = items.select(F.col(item_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    size = F.least(F.lit(window), F.size("words"))
    cut = F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1),
        lambda at: F.slice(F.col("words"), at, size),
    )
    return words.filter(F.size("words") > 0).select("item", F.explode(cut).alias("window"))


def _with_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Windows with their number of words, the size of their shingles and the shingles' hashes."""
    rows = windows.select(
        "*",
        F.size("window").alias("length"),
        F.least(F.lit(shingle), F.size("window")).alias("shingle"),
        _hashes("window").alias("hashes"),
    )

    def of_size(size: int) -> Column:
        places = F.sequence(F.lit(0), F.col("length") - size)
        return F.transform(places, lambda at: _shingle(F.col("hashes"), at, size))

    shingles = F.when(F.col("shingle") == 1, of_size(1))
    for size in range(2, shingle + 1):
        shingles = shingles.when(F.col("shingle") == size, of_size(size))
    return rows.withColumn("shingles", shingles).drop("hashes")


def _prefixes(windows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """The rarest shingles of each window, as many as at least one must be found of."""
    each = windows.select("window_id", F.size("shingles").alias("n"), F.posexplode("shingles"))
    each = each.join(counts, F.col("col") == F.col("hash"), "left").select(
        "window_id", "n", F.col("pos").alias("offset"), F.col("col").alias("hash"), "count"
    )
    rarest = Window.partitionBy("window_id").orderBy(
        F.coalesce("count", F.lit(0)), "hash", "offset"
    )
    needed = F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    return each.withColumn("nth", F.row_number().over(rarest)).filter(F.col("nth") <= needed)


def _blocks(table: DataFrame, size: int, key: str) -> list[DataFrame]:
    """A table of a measured number of bytes in parts that may be broadcast."""
    n = max(1, -(-size // BLOCK_BYTES))
    if n == 1:
        return [F.broadcast(table)]
    block = F.pmod(F.xxhash64(key), F.lit(n))
    return [F.broadcast(table.filter(block == i)) for i in range(n)]


def _same_shingles(share: float) -> Column:
    """Whether enough of the window's shingles stand in their places from ``start`` on."""
    if share >= 1:
        return F.slice("words", F.col("start") + 1, F.col("length")) == F.col("window")
    size = F.col("shingle")

    def same(at: Column) -> Column:
        theirs = F.slice(F.col("words"), F.col("start") + at + 1, size)
        return theirs == F.slice(F.col("window"), at + 1, size)

    places = F.sequence(F.lit(0), F.col("length") - size)
    return F.size(F.filter(places, same)) >= F.ceil(F.col("n") * share - 1e-9)


def _merged(matches: Column) -> Column:
    """Spans that together cover the same words, from matches in the order of their starts."""
    start = F.expr(
        "named_struct('done', CAST(array() AS array<struct<start:int,end:int>>), 'start', -1, 'end', -1)"
    )

    def closed(state: Column) -> Column:
        last = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(state["start"] >= 0, F.concat(state["done"], last)).otherwise(state["done"])

    def add(state: Column, match: Column) -> Column:
        joined = match["start"] <= state["end"]
        return F.struct(
            F.when(joined, state["done"]).otherwise(closed(state)).alias("done"),
            F.when(joined, state["start"]).otherwise(match["start"]).alias("start"),
            F.greatest(state["end"], match["end"]).alias("end"),
        )

    return F.aggregate(matches, start, add, closed)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    shingle: int = 3,
    share: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id_col, n_words, n_hit, spans, items): where documents hold windows of items, a row each.

    A window is ``window`` words of an item in a row, or all of an item that has fewer.  A stretch of
    as many words of a document is hit if at least ``share`` of the window's shingles of ``shingle``
    words (or of the whole window, if that is shorter) stand in their places in it; at 1.0 it is the
    same words.  ``spans`` are the hit words as disjoint (start, end), counted in words from 0, end
    exclusive; ``items`` are the ids of the items whose windows hit, each once, in order.

    Words are runs of characters other than ASCII spaces, punctuation and control characters, A-Z in
    lower case.  NULL and empty texts have no words: such documents come with no hits, such items hit
    nothing.  NULL ids of documents are kept; items with a NULL id hit, but are not in ``items``.
    Repeated documents each give a row, repeated items count once.  Other columns are ignored.  No
    documents give no rows.
    """
    steps = Steps(docs.sparkSession)
    item_windows = steps.save(_windows(items, item_col, item_text_col, window).distinct())
    distinct = item_windows.select("window").distinct()
    windows = steps.save(
        _with_shingles(distinct, shingle).withColumn("window_id", F.monotonically_increasing_id())
    )
    window_items = steps.save(
        item_windows.join(windows.select("window", "window_id"), "window")
        .filter("item IS NOT NULL")
        .select("window_id", "item")
    )
    sizes = sorted(r[0] for r in windows.select("shingle").distinct().collect()) or [shingle]

    documents = _Documents(docs, id_col, text_col)
    places = documents.places(sizes)
    vocabulary = steps.save(windows.select(F.explode("shingles").alias("hash")).distinct())
    counts = None
    for block in _blocks(vocabulary, vocabulary.count() * 16, "hash"):
        part = places.join(block, "hash").groupBy("hash").agg(F.count(F.lit(1)).alias("count"))
        counts = part if counts is None else counts.unionByName(part)
    prefixes = steps.save(
        _prefixes(windows, steps.save(counts), share)
        .filter("count > 0")  # what no document holds finds none
        .select("window_id", "n", "offset", "hash")
        .join(windows.select("window_id", "window", "length", "shingle"), "window_id")
    )

    size = prefixes.agg(F.sum(F.length(F.array_join("window", " ")) + 12 * F.col("length") + 64)).first()
    found = None
    for i, block in enumerate(_blocks(prefixes, size[0] or 0, "window_id")):
        start = F.col("at") - F.col("offset")
        fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
        met = places.join(block, "hash", "left").withColumn("start", F.when(fits, start))
        hit = F.col("start").isNotNull() & _same_shingles(share)
        met = met.filter(hit | (F.col("at") < 0) if i == 0 else hit).select(
            "id",
            "h1",
            "h2",
            "n_words",
            F.when(
                F.col("start").isNotNull(),
                F.struct("start", (F.col("start") + F.col("length")).alias("end"), "window_id"),
            ).alias("match"),
        )
        found = met if found is None else found.unionByName(met)

    key = ["id", "h1", "h2"]
    each = found.groupBy(*key, "n_words").agg(
        F.sort_array(F.collect_set("match")).alias("matches"),
        F.count_if(F.col("match").isNull()).alias("copies"),
    )
    each = each.select(
        *key,
        "n_words",
        "copies",
        _merged(F.col("matches")).alias("spans"),
        F.array_distinct(F.transform("matches", lambda m: m["window_id"])).alias("windows"),
    )
    named = each.withColumn("window_id", F.explode_outer("windows")).drop("windows")
    if window_items.count() * 32 <= BLOCK_BYTES:
        window_items = F.broadcast(window_items)
    named = (
        named.join(window_items, "window_id", "left")
        .groupBy(*key, "n_words", "copies")
        .agg(F.first("spans").alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    )
    # Equal rows were counted as one.
    named = named.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    n_hit = F.aggregate("spans", F.lit(0), lambda n, span: n + span["end"] - span["start"])
    return named.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.cast("bigint").alias("n_hit"),
        "spans",
        "items",
    )
