"""The rules of a classifier record, as one table that column checks and checks of decoded JSON both follow (VAL-01, VAL-02)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, functions as F

from strataflow.functions.scalars import all_digits
from strataflow.functions.vocabularies import MODALITIES, PROVENANCE_FIELDS, RECORD_ENUMS


@dataclass(frozen=True)
class Rule:
    """A field, the kind of check and what it takes, and the message of a record that fails it."""

    field: str
    kind: str
    message: str
    takes: tuple = ()
    shown: bool = False  # the message goes on with the value that was found


def rules(provenance: bool = True) -> list[Rule]:
    """In the order in which they are reported."""
    texts = ("pmid", "rationale", *(PROVENANCE_FIELDS if provenance else ()))
    return [
        *[Rule(name, "one of", f"Invalid {name}", values, True) for name, values in RECORD_ENUMS.items()],
        Rule("data_modalities", "distinct", "data_modalities must be a non-empty unique list"),
        Rule("data_modalities", "all of", "Invalid data modality", MODALITIES),
        Rule("computational_centrality", "whole", "computational_centrality must be an integer from 0 to 3", (0, 3)),
        Rule("confidence", "number", "confidence must be from 0 to 1", (0, 1)),
        *[Rule(name, "text", f"{name} must be a non-empty string") for name in texts],
        Rule("pmid", "digits", "pmid must contain only digits"),
        *([Rule("screened_at", "time", "screened_at must be an ISO date-time")] if provenance else []),
    ]


def iso_time(text: str) -> bool:
    try:
        datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return False
    return True


def is_iso_time(value: Column) -> Column:
    """A calendar date, or a date and a time, with or without zone, as ISO 8601 writes them."""
    shaped = value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?)?)?\z")
    return shaped & F.try_to_timestamp(F.regexp_replace(F.substring(F.concat(value, F.lit("")), 1, 19), "T", " ")).isNotNull() | (shaped & (F.length(value) == 10) & value.try_cast("date").isNotNull())


def _number(value: object, *kinds: type) -> bool:
    """JSON's true and false are no numbers."""
    return isinstance(value, kinds) and not isinstance(value, bool)


#: Of each kind, what it asks of a column of a typed record, and of a decoded value.
KINDS: dict[str, tuple[Callable[..., Column], Callable[..., bool]]] = {
    "one of": (lambda c, *v: c.isin(*v), lambda x, *v: isinstance(x, str) and x in v),
    "distinct": (lambda c: (F.size(c) > 0) & (F.size(F.array_distinct(c)) == F.size(c)), lambda x: isinstance(x, list) and 0 < len(x) == len({str(k) for k in x})),
    "all of": (lambda c, *v: F.size(F.array_except(c, F.array(*map(F.lit, v)))) == 0, lambda x, *v: all(isinstance(k, str) and k in v for k in x)),
    "whole": (lambda c, a, z: c.between(a, z), lambda x, a, z: _number(x, int) and a <= x <= z),
    "number": (lambda c, a, z: c.between(a, z), lambda x, a, z: _number(x, int, float) and a <= x <= z),
    "text": (lambda c: c.rlike(r"(?U)\S"), lambda x: isinstance(x, str) and bool(x.strip())),
    "digits": (all_digits, lambda x: x.isascii() and x.isdigit()),
    "time": (is_iso_time, iso_time),
}


def column_rules(provenance: bool = True) -> list[tuple[str, Column]]:
    """Message and condition of each rule, for typed records."""
    return [(r.message, KINDS[r.kind][0](F.col(r.field), *r.takes)) for r in rules(provenance)]


def broken_rule(record: dict, provenance: bool = True) -> str | None:
    """Message of the first rule that a decoded record with all fields breaks."""
    for r in rules(provenance):
        value = record[r.field]
        if not KINDS[r.kind][1](value, *r.takes):
            return f"{r.message}: {value!r}" if r.shown else r.message
    return None
