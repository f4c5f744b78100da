"""Column expressions that turn raw text into typed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_OFFSET = r"^(.*[0-9][T ][0-9:.]+)\s*(?:Z|z|([+-])([0-9]{1,2}):?([0-9]{2})?)$"
_NAMED_ZONE = r"[0-9]\s*[A-Za-z][A-Za-z/_]*([+-][0-9:]+)?\s*(\[.*)?$"
#: Neither of these matches it, and most texts are told by it alone: it never goes back.
_PLAIN = r"^[0-9]+-[0-9]+-[0-9]+[T ][0-9:.]+$"


def wall_time(text: Column, zone: str) -> Column:
    """A time without zone from text; NULL if it is none.

    A text with an offset, or ``Z``, names an instant: its wall time in ``zone``
    is taken, whatever the zone of the session.  A text with the name of a zone
    is not understood, and NULL.
    """
    part = [F.regexp_extract(text, _OFFSET, i) for i in range(5)]
    minutes = F.coalesce(part[3].try_cast("int"), F.lit(0)) * 60 + F.coalesce(
        part[4].try_cast("int"), F.lit(0)
    )
    east = F.when(part[2] == "-", -minutes).otherwise(minutes)
    utc = part[1].try_cast("timestamp_ntz") - F.make_dt_interval(mins=east)
    there = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    read = text.try_cast("timestamp_ntz")
    plain = F.when(~text.rlike(_NAMED_ZONE), read)
    return F.when(text.rlike(_PLAIN), read).when(part[1] != "", there).otherwise(plain)


@dataclass(frozen=True)
class Field:
    """One column of a refined table.

    ``source`` is a column name or expression; left out, it is ``name`` itself.
    Trimming and lower-casing apply to text sources only.  A text with an offset
    becomes a time without zone as the wall time in ``zone``.
    """

    name: str
    type: str = "string"
    source: str | Column | None = None
    trim: bool = True
    lower: bool = False
    zone: str = "UTC"

    def raw(self) -> Column:
        source = self.name if self.source is None else self.source
        return (F.col(source) if isinstance(source, str) else source).alias(self.name)

    def typed(self, raw_type: T.DataType) -> Column:
        """The column cast to its type; a value that does not fit becomes NULL."""
        value = self.raw()
        if isinstance(raw_type, T.StringType):
            value = F.trim(value) if self.trim else value
            value = F.lower(value) if self.lower else value
            if self.type.strip().lower() == "timestamp_ntz":
                return wall_time(value, self.zone).alias(self.name)
        return value.try_cast(self.type).alias(self.name)

    def there(self, raw_type: T.DataType) -> Column:
        """Whether there is a value that is not blank."""
        value = self.raw()
        if isinstance(raw_type, T.StringType):
            return F.coalesce(F.trim(value) != "", F.lit(False))
        return value.isNotNull()

    def failed(self, raw_type: T.DataType) -> Column:
        """Whether there is a value, not blank, that does not fit the type."""
        return self.there(raw_type) & self.typed(raw_type).isNull()
