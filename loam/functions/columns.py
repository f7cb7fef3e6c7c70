"""Column expressions that several operators share. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_type(kind: Column, synonyms: dict[str, str] | None = None) -> Column:
    """Lower case, with `_` and spaces as `-`. `dataModel` becomes `datamodel`: give synonyms where that matters."""
    out = F.translate(F.lower(kind), "_ ", "--")
    for name, meant in (synonyms or {}).items():
        out = F.when(out == name, meant).otherwise(out)
    return out


def join_key(value: Column) -> Column:
    """Ids compare without case and surrounding spaces."""
    return F.lower(F.trim(value))


def org_slug(url: Column) -> Column:
    """The fourth segment of a URL, null if it has fewer."""
    return F.get(F.split(url, "/"), F.lit(3))


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def legacy_flag(log_name: Column, current_mark: str = "wal_ds_") -> Column:
    """True unless the name has the mark of the current naming; a null name is legacy."""
    return F.coalesce(~F.contains(F.lower(log_name), F.lit(current_mark)), F.lit(True))


def whole_days(since: Column, as_of: Column) -> Column:
    """Whole 24-hour spans between two timestamps; null if one is."""
    return F.timestamp_diff("DAY", since, as_of)


def naive_timestamp(text: Column, to_utc: bool = False) -> Column:
    """ISO 8601 text as a timestamp without zone: the offset is discarded, or applied with to_utc."""
    if to_utc:
        return F.to_utc_timestamp(F.to_timestamp(text), F.current_timezone()).cast("timestamp_ntz")
    return F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").cast("timestamp_ntz")


def units(size: Column, unit: int, digits: int) -> Column:
    """Bytes in units, rounded; null counts as 0."""
    return F.round(F.coalesce(size, F.lit(0)).cast("double") / float(unit), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Null if the whole is 0."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), digits)


def path_text(path: Column) -> Column:
    """A path given as a list of parts."""
    return F.array_join(path, "/")
