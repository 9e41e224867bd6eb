"""Column names of a scanned symbol.  No Spark job is needed to know them."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import count

#: The symbol kinds, the value fields, and the limits of a symbol.
KINDS = ("Set", "Parameter", "Variable", "Equation", "Alias")
FIELDS = ("level", "marginal", "lower", "upper", "scale")
MAX_DIM, MAX_LABEL_BYTES = 20, 255
UNIVERSE = "*"


def value_name(kind: str, value_field: str | None = None) -> str:
    """The value column: ``value``, or for variables and equations the chosen field.

    Sets, parameters and aliases always show their first field; the choice is checked, then ignored.
    """
    if value_field is not None and value_field not in FIELDS:
        raise ValueError(f"unknown value field {value_field!r}; choose one of {', '.join(FIELDS)}")
    return (value_field or FIELDS[0]) if kind in ("Variable", "Equation") else "value"


def stored_field(kind: str, value_field: str | None = None) -> str:
    """The stored column behind the value column."""
    name = value_name(kind, value_field)
    return FIELDS[0] if name == "value" else name


def key_names(domains: Iterable[str], reserved: Iterable[str] = ()) -> list[str]:
    """A distinct name per dimension, none of them reserved.

    A dimension's stem is its domain, or ``dim_<i>`` without one.  It is followed by as many repeats of
    ``_<i>`` as make the name differ from the reserved names and those of earlier dimensions.
    """
    blocked, names = frozenset(reserved), []
    for i, domain in enumerate(domains):
        stem = f"dim_{i}" if domain in ("", UNIVERSE) else domain
        spellings = (stem + f"_{i}" * n for n in count())
        names.append(next(s for s in spellings if s not in blocked and s not in names))
    return names


def check_names(keys: list[str], value: str, case_sensitive: bool = True) -> None:
    """Refuse names that a DataFrame of the session could not tell apart."""
    every = [*keys, value]
    for n, name in enumerate(every):
        if name in every[:n]:
            raise ValueError(f"column {name!r} occurs twice among {', '.join(every)}")
        if not case_sensitive and name.lower() in [x.lower() for x in every[:n]]:
            raise ValueError(f"column {name!r} differs from another in case only; give other names as keys, or set spark.sql.caseSensitive")


def hidden_names(count_: int, visible: Iterable[str]) -> tuple[list[str], str]:
    """Names of the label numbers and of the record's place that no visible column has, in any case."""
    taken, mark = {v.lower() for v in visible}, "_"
    while any(f"{mark}{x}" in taken for x in [*(f"u{i}" for i in range(count_)), "at"]):
        mark += "_"
    return [f"{mark}u{i}" for i in range(count_)], f"{mark}at"
