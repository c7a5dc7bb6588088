"""Scalar column functions. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import Column, functions as F

#: First three letters of the month names, in order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """Characters whose full case folding is not their lower case: those with one character, what they become, and the others."""
    odd = {c: f for c in map(chr, range(0x80, 0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (f := c.casefold()) != c.lower()}
    one = {c: f for c, f in odd.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in odd.items() if len(f) > 1}


def casefold(value: Column) -> Column:
    """Full Unicode case folding (FN-16): lower case, and where that is not enough what the rule says, as ``ss`` for sharp s."""
    one, to, more = _folding()
    folded = F.translate(value, one, to)
    odd = "[" + "".join(more) + "]"
    table = F.create_map(*[F.lit(x) for pair in more.items() for x in pair])  # a constant to the plan: one lookup a character
    long = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.translate(F.lower(F.when(value.rlike(odd), long).otherwise(folded)), "ς", "σ")  # lower case knows a final sigma


def collapse_space(value: Column) -> Column:
    """Runs of Unicode white space as one space, trimmed (FN-02)."""
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def normalize_doi(value: Column) -> Column:
    """Identifier without resolver or ``doi:`` prefix, trailing stops and case; null if nothing is left (FN-01)."""
    bare = F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
    bare = F.regexp_replace(bare, r"(?i)^https?://(dx\.)?doi\.org/", "")
    bare = F.regexp_replace(bare, r"(?iU)^doi:\s*", "")
    bare = F.rtrim(F.regexp_replace(bare, r"(?U)^\s+|\s+$", ""), F.lit(". "))
    return F.nullif(casefold(bare), F.lit(""))


def first_year(value: Column) -> Column:
    """First year of the 20th or 21st century in a text, as text; empty if none (FN-04)."""
    return F.regexp_extract(value, r"(?:19|20)\d{2}", 0)


def partial_date(year: Column, month: Column, day: Column, medline: Column | None = None) -> Column:
    """Struct ``value``, ``precision``, ``year`` of a date whose parts may be missing or unusable (FN-03).

    A month is a number or a name known by three letters; a bad month leaves the year, a bad day the
    month. Days run to 31 in every month. Null if the year is no number.
    """
    y = F.coalesce(year, F.lit(""))
    if medline is not None:
        y = F.when(y == "", first_year(F.coalesce(medline, F.lit("")))).otherwise(y)
    named = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)])
    m = F.coalesce(month, F.lit(""))
    number = F.when(m.rlike(r"^[0-9]+\z"), m.try_cast("int")).otherwise(F.try_element_at(named, F.lower(F.substring(m, 1, 3))))
    number = F.when(number.between(1, 12), number)
    d = F.coalesce(day, F.lit(""))
    on = F.when(d.rlike(r"^[0-9]+\z"), d.try_cast("int"))
    on = F.when(on.between(1, 31), on)
    yyyy, mm, dd = F.lpad(y.try_cast("int").cast("string"), 4, "0"), F.lpad(number.cast("string"), 2, "0"), F.lpad(on.cast("string"), 2, "0")
    precision = F.when(number.isNull(), "year").when(on.isNull(), "month").otherwise("day")
    value = F.when(number.isNull(), yyyy).when(on.isNull(), F.concat_ws("-", yyyy, mm)).otherwise(F.concat_ws("-", yyyy, mm, dd))
    return F.when(y.rlike(r"^[0-9]+\z"), F.struct(value.alias("value"), precision.alias("precision"), y.try_cast("int").alias("year")))


def publication_date(candidates: Sequence[Column]) -> Column:
    """The first candidate that is a date; without any, precision ``unknown``."""
    none = F.struct(F.lit(None).cast("string").alias("value"), F.lit("unknown").alias("precision"), F.lit(None).cast("int").alias("year"))
    return F.coalesce(*candidates, none)


def first_date(dates: str) -> Column:
    """``publication_date`` over an array of structs of ``year``, ``month``, ``day`` and ``medline``, null ones left out."""
    tried = F.transform(F.filter(dates, lambda d: d.isNotNull()), lambda d: partial_date(d["year"], d["month"], d["day"], d["medline"]))
    return publication_date([F.get(F.filter(tried, lambda d: d.isNotNull()), F.lit(0))])


def matched(patterns: Sequence[str], text: Column) -> Column:
    """The patterns that a text contains, in rule order, without regard to case (FN-05)."""
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?iuU){p}"), F.lit(p)) for p in patterns])) if patterns else F.array().cast("array<string>")


def hash_rank(seed: str, key: Column) -> Column:
    """Order of a deterministic sample: hex SHA-256 of ``seed:key`` (FN-08)."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)


def batch_id(sample_id: Column, prompt_version: Column, ids: Column) -> Column:
    """24 hex digits that name a batch by its sample, prompt and ordered ids (FN-09)."""
    return F.substring(F.sha2(F.concat_ws("\n", sample_id, prompt_version, F.array_join(ids, "\n")).cast("binary"), 256), 1, 24)


def spaced_list(values: Column) -> Column:
    """A list of strings as JSON with a space behind each comma (FN-12); null for null."""
    quoted = F.transform(values, lambda x: F.substring(F.to_json(F.array(x)), F.lit(2), F.length(F.to_json(F.array(x))) - 2))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def ordered_distinct(values: Column) -> Column:
    """Distinct non-empty values in order of first occurrence (FN-23)."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def all_digits(value: Column) -> Column:
    return value.rlike(r"^[0-9]+\z")


def years_between(start: Column, end: Column) -> Column:
    """Calendar years that a window touches, as an array (FN-19)."""
    return F.sequence(F.year(start), F.year(end))


def year_bounds(year: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """First and last day of a year within a window (FN-18)."""
    return F.greatest(F.make_date(year, F.lit(1), F.lit(1)), start), F.least(F.make_date(year, F.lit(12), F.lit(31)), end)


def midpoint(left: Column, right: Column) -> Column:
    """Last day of the left half of a closed interval (FN-20); half of a negative length is rounded down, as Python's ``//`` does."""
    return F.date_add(left, F.floor(F.datediff(right, left) / 2).cast("int"))


def share_of(n: Column, fraction: float) -> Column:
    """``ceil(n * fraction)`` in double arithmetic (FN-21)."""
    return F.ceil(n.cast("double") * F.lit(fraction).cast("double"))


def coverage_status(expected: Column, observed: Column) -> Column:
    return F.when(expected == observed, "match").otherwise("discrepancy")


def journal_query(title: Column, start: Column, end: Column) -> Column:
    """Query text of a title and a publication window, inner quotes escaped (FN-17)."""
    quoted = F.replace(title, F.lit('"'), F.lit('\\"'))
    return F.format_string('"%s"[jour] AND ("%s"[Date - Publication] : "%s"[Date - Publication])', quoted, start.cast("string"), end.cast("string"))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
