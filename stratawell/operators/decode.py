"""Event payloads to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.sources.drift import rest_of


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    col: str = "value",
    corrupt_col: str = "_corrupt",
    raw_col: str | None = None,
    rest_col: str | None = None,
    **options,
) -> DataFrame:
    """Replace a JSON payload by the columns of ``schema``.

    A payload is one JSON object in UTF-8 and nothing else.  The text of any
    other is kept in ``corrupt_col``; look there and nowhere else, because a
    broken payload may still fill some columns.  Bytes that are not UTF-8 appear
    in that text as replacement characters.  A NULL payload gives NULL columns
    and no corrupt text.  Fields outside ``schema`` are dropped, unless ``rest_col``
    names a column for them: a map from names to VARIANT, NULL where there are none
    (see ``sources.drift``).  With ``raw_col`` the whole payload stays there as it came.

    The payload is parsed once per row, and once more for the rest; the names around
    it are looked through.  A name that the payload's columns share
    with each other or with columns that stay is refused.
    """
    kept = [c for c in df.columns if c != col]
    names = [*kept, *schema.names, corrupt_col, *[c for c in (raw_col, rest_col) if c]]
    known: set[str] = set()
    for name in names:
        if name.lower() in known:
            raise ValueError(f"two columns would be called {name}")
        known.add(name.lower())
    binary = isinstance(df.schema[col].dataType, T.BinaryType)
    # The parser stops at the end of the first value.  So the payload is put between a start and
    # an end of our own, and the end, which a payload cannot know, must be found behind it.
    source = F.col(f"`{col}`")
    text = F.make_valid_utf8(source.cast("string")) if binary else source
    seal = F.hex(F.xxhash64(text, F.lit("end")))
    sealed = F.concat(F.lit('{"payload":'), text, F.lit(',"seal":"'), seal, F.lit('"}'))
    full = T.StructType(
        [
            T.StructField("payload", schema),
            T.StructField("seal", T.StringType()),
            T.StructField("corrupt", T.StringType()),
        ]
    )
    found = F.from_json(
        sealed, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", **options}
    )
    inner = [f"_{i}" for i in range(len(kept))]
    work = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner)],
        source.alias("source"),
        text.alias("text"),
        seal.alias("wanted"),
        sealed.alias("sealed"),
        (F.is_valid_utf8(source.cast("string")) if binary else F.lit(True)).alias("valid"),
        found.alias("found"),
    )
    # A payload might close the object's first field and open others, so its names are looked at.
    names = F.json_object_keys("sealed")
    if any(option.lower().startswith("allow") for option in options):
        names = F.map_keys(F.from_json("sealed", "map<string,string>", {"mode": "PERMISSIVE", **options}))
    alone = names == F.array(F.lit("payload"), F.lit("seal"))
    sound = (
        F.col("valid")
        & F.coalesce(alone, F.lit(False))
        & F.col("found.corrupt").isNull()
        & F.col("found.payload").isNotNull()
        & (F.col("found.seal") == F.col("wanted"))
    )
    broken = F.col("text").isNotNull() & ~F.coalesce(sound, F.lit(False))
    return work.select(
        *[F.col(n).alias(c) for c, n in zip(kept, inner)],
        *[F.col(f"found.payload.`{f.name}`").alias(f.name) for f in schema.fields],
        F.when(broken, F.col("text")).alias(corrupt_col),
        *([F.col("source").alias(raw_col)] if raw_col else []),
        *([F.when(~broken, rest_of("text", schema, options)).alias(rest_col)] if rest_col else []),
    )
