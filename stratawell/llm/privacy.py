"""Personal data in texts, by DataFrame functions only.

A pattern for each kind proposes spans, checks such as Luhn's and the remainder by 97 confirm
them, and words near a span, before it or behind it, raise its score.  What does not reach
``LEAST_SCORE`` is not reported.  Spans are in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import unused

#: Characters before and behind a span in which context words count, and what they add to its score.
CONTEXT = 40
CONTEXT_BONUS = 0.3
#: Spans below this score are not reported.
LEAST_SCORE = 0.5


def _count(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


def _parts_are_bytes(hit: Column) -> Column:
    """Each number between the dots is 255 at most."""
    plain = F.transform(F.split(hit, r"\."), lambda part: F.regexp_replace(part, "^0+(?=[0-9])", ""))
    return F.forall(
        plain, lambda n: (F.length(n) < 3) | ((F.length(n) == 3) & (n <= F.lit("255")))
    )


def _luhn(hit: Column) -> Column:
    """13 to 19 digits whose sum, every second from the right doubled, ends in 0."""
    digits = F.reverse(F.regexp_replace(hit, "[^0-9]", ""))
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add)
    return F.when(size.between(13, 19), total % 10 == 0).otherwise(False)


def _remainder_97(hit: Column) -> Column:
    """15 to 34 characters which, first four last and letters as numbers from 10, leave 1."""
    plain = F.regexp_replace(hit, "[^A-Z0-9]", "")
    turned = F.concat(
        F.substring(plain, F.lit(5), F.lit(64)), F.substring(plain, F.lit(1), F.lit(4))
    )

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    rest = F.aggregate(F.split(turned, ""), F.lit(0), add)
    return F.when(F.length(plain).between(15, 34), rest == 1).otherwise(False)


#: Characters of an IBAN by country, those that use IBANs without being registered included.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR",
        27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _iban(hit: Column) -> Column:
    """The longest part of a hit, from its start to a space or its end, that is an IBAN, or NULL.

    Its length is that of its country; with an unknown country any that the remainder allows.
    """
    groups = F.split(hit, " ")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, 1, n), " ")
    )
    known = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])

    def good(head: Column) -> Column:
        length = _count(head, "\\x20")
        wanted = F.try_element_at(known, F.substring(head, 1, 2))
        return (F.coalesce(wanted, length) == length) & _remainder_97(head)

    found = F.filter(heads, good)
    return F.get(found, F.size(found) - 1)


#: How card numbers are printed: in one run, or in the groups of the large issuers.
_PRINTED = (
    r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}(?:[\x20-][0-9]{1,3})?"
    r"|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5})$"
)


def _card_part(hit: Column) -> Column:
    """The longest part of a hit, from its start to the end of a group, that is a card number, or NULL."""
    groups = F.split(hit, r"(?=[\x20-])")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, 1, n), "")
    )
    found = F.filter(heads, _luhn)
    return F.get(found, F.size(found) - 1)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``must`` is a character, and ``needs`` a pattern, without which no span is possible.  ``score`` may depend on the span; below
    ``LEAST_SCORE`` it takes context to be reported.  Spans that overlap one of the kind named by
    ``besides`` are left out.  ``tag`` is what stands for a span in a masked text.  The possessive quantifiers and the
    looks behind keep the patterns linear: a run of characters is tried from its start only, or
    from the end of the span before.

    Where ``part`` is given, the pattern says how far a span may reach, and ``part`` which part from
    its start is one, or NULL.  The next is then sought from every place behind that start.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float | Callable[[Column], Column]
    context: str
    must: str = ""
    part: Callable[[Column], Column] | None = None
    needs: str = ""
    besides: str = ""
    tag: str = ""


EMAIL = Kind(
    "email",
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    lambda hit: F.lit(True),
    0.9,
    r"(?i)\b(e-?mail|contact|write)",
    "@",
)
IP = Kind(
    "ip",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    _parts_are_bytes,
    0.6,
    r"(?i)\b(ip|address|host|server)\b",
    ".",
)
CARD = Kind(
    "card",
    r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    _luhn,
    0.6,
    r"(?i)\b(card|credit|visa|payment)",
)
PHONE = Kind(
    "phone",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    lambda hit: _count(hit, "[^0-9]").between(9, 15),
    0.6,
    r"(?i)\b(phone|call|tel|mobile|fax)",
    "+",
)
IBAN = Kind(
    "iban",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    lambda hit: F.lit(True),
    0.5,
    r"(?i)\b(iban|account|bank|konto|cuenta|compte)",
    part=_iban,
)
#: A card number beside other digits, where CARD takes them all together and Luhn's check fails.
#: In groups of other sizes it may be any digits, so it takes context.
INNER_CARD = Kind(
    "inner_card",
    r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++){0,18}+",
    lambda hit: F.lit(True),
    lambda hit: F.when(hit.rlike(_PRINTED), 0.5).otherwise(0.3),
    r"(?i)\b(card|credit|visa|payment)",
    part=_card_part,
    needs=r"[0-9](?:[\x20-]?[0-9]){12}",
    besides="card",
    tag="CARD",
)
BASE = (EMAIL, IP, CARD, PHONE)
KINDS = (*BASE, IBAN, INNER_CARD)

_SPANS = "array<struct<start:int,end:int,score:double>>"


def _spans(text: Column, kind: Kind) -> Column:
    """The spans of one kind, in order."""
    if kind.part:
        # Hits of no width, as they may overlap; the space keeps the first off the start, where
        # a split drops the empty gap.
        hits = F.regexp_extract_all(text, F.lit(f"(?=({kind.pattern}))"), F.lit(1))
        gaps = F.split(F.concat(F.lit(" "), text), f"(?={kind.pattern})", -1)
        hits = F.transform(hits, kind.part)
    else:
        hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        gaps = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
    )
    at = -1 if kind.part else 0
    start = F.expr(f"named_struct('at', {at}, 'past', 0, 'found', CAST(array() AS {_SPANS}))")

    def add(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        end = first + F.length(pair["hit"])
        if kind.part:  # what is before may be in hits that overlap
            before = F.substring(text, F.greatest(first - CONTEXT, F.lit(0)) + 1, F.least(first, F.lit(CONTEXT)))
        else:
            before = F.substring(pair["gap"], F.lit(-CONTEXT), F.lit(CONTEXT))
        behind = F.substring(text, end + 1, F.lit(CONTEXT))
        near = before.rlike(kind.context) | behind.rlike(kind.context)
        alone = kind.score(pair["hit"]) if callable(kind.score) else F.lit(kind.score)
        score = alone + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(
            first.alias("start"), end.alias("end"), F.least(score, F.lit(1.0)).alias("score")
        )
        good = kind.valid(pair["hit"])
        if kind.part:
            good = pair["hit"].isNotNull() & (first >= state["past"]) & good
        if callable(kind.score) or kind.score < LEAST_SCORE:
            good &= score >= LEAST_SCORE
        return F.struct(
            (first if kind.part else end).alias("at"),
            F.when(good, end).otherwise(state["past"]).alias("past"),
            F.when(good, F.concat(state["found"], F.array(span)))
            .otherwise(state["found"])
            .alias("found"),
        )

    found = F.aggregate(pairs, start, add, lambda state: state["found"])
    none = F.expr(f"CAST(array() AS {_SPANS})")
    if kind.needs:
        return F.when(text.rlike(kind.needs), found).otherwise(none)
    return F.when(F.contains(text, F.lit(kind.must)), found).otherwise(none) if kind.must else found


def find_private(
    docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, into: str = "private"
) -> DataFrame:
    """All rows and columns, with an array of (kind, start, end, score) added.

    Spans come in the order of the kinds, then of their starts; spans of one kind do not overlap.  The score is that of the kind, more where a context word of it is near, and 1 at most.
    A NULL or empty text has none.  The new name gets a leading underscore where it is taken.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    new = unused(docs, into)
    parts = [unused(docs, f"_{kind.name}") for kind in kinds]
    found = docs.select("*", *[_spans(text, kind).alias(p) for kind, p in zip(kinds, parts)])

    def named(name: str) -> Callable[[Column], Column]:
        return lambda s: F.struct(F.lit(name).alias("kind"), s["start"], s["end"], s["score"])

    place = {kind.name: part for kind, part in zip(kinds, parts)}

    def apart(kind: Kind) -> Column:
        spans = F.col(place[kind.name])
        others = place.get(kind.besides)
        if others is None:
            return spans

        def overlaps(s: Column) -> Column:
            return F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))

        return F.filter(spans, lambda s: ~overlaps(s))

    all_spans = [F.transform(apart(kind), named(kind.name)) for kind in kinds]
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.concat(*all_spans).alias(new))


def _tags(kinds: tuple[Kind, ...]) -> Column:
    pairs = [F.lit(x) for kind in kinds for x in (kind.name, f"<{kind.tag or kind.name.upper()}>")]
    return F.create_map(*pairs)


def mask(text: Column, spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """The text with each span replaced by the tag of its kind; overlapping ones by one."""
    tags = _tags(kinds)
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"], (-s["end"]).alias("turned"), s["kind"], s["end"])
        )
    )
    start = F.expr("named_struct('at', 0, 'out', '')")

    def add(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        tag = F.try_element_at(tags, span["kind"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, tag)).otherwise(state["out"]).alias("out"),
        )

    masked = F.aggregate(
        ordered,
        start,
        add,
        lambda state: F.concat(
            state["out"], F.substring(text, state["at"] + 1, F.length(text) - state["at"])
        ),
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def mask_private(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The documents with personal data masked, and ``n_chars`` of the texts that changed renewed.

    A NULL text stays NULL.  Rows and other columns stay as they are.
    """
    spans = unused(docs, "private")
    found = find_private(docs, "text", kinds, spans)
    text = mask(F.col("text"), F.col(spans), kinds)
    hit = F.size(spans) > 0
    masked = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn(
            "n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])
