"""Partition specs and the column predicates made from them.

A spec selects hours of the lake: ``{"year": 2025, "month": 8}`` means every hour of that
month, and the empty spec, ``all`` in text, every hour there is. Values are compared as integers,
so ``08`` and ``8`` select the same directory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PARTITION_COLS

Spec = dict[str, int]
ALL_HOURS = "all"
Specs = str | Mapping[str, int] | Iterable[Mapping[str, int]]


def parse_partition_specs(
    text: str | None, partition_cols: Sequence[str] = PARTITION_COLS
) -> list[Spec]:
    """Parse ``year=2025,month=8;year=2025,month=9`` into specs; reject anything malformed."""
    if not text or not text.strip():
        return []
    return [_parse_one(group, partition_cols) for group in text.split(";")]


def _parse_one(group: str, partition_cols: Sequence[str]) -> Spec:
    spec: Spec = {}
    if group.strip() == ALL_HOURS:
        return spec
    for item in group.split(","):
        name, equals, value = (part.strip() for part in item.partition("="))
        if not equals:
            raise ValueError(f"partition spec {group!r}: {item!r} is not of the form name=value")
        if name not in partition_cols:
            raise ValueError(f"partition spec {group!r}: {name!r} is not one of {list(partition_cols)}")
        if name in spec:
            raise ValueError(f"partition spec {group!r}: {name!r} is given twice")
        if not (value.isascii() and value.isdigit()):
            raise ValueError(f"partition spec {group!r}: {name!r} needs an integer, not {value!r}")
        spec[name] = int(value)
    return spec


def as_specs(
    specs: Specs | None,
    partition_cols: Sequence[str] = PARTITION_COLS,
) -> list[Spec]:
    """Accept spec text, one mapping or several; values are validated in every case."""
    if specs is None or isinstance(specs, str):
        return parse_partition_specs(specs, partition_cols)
    if isinstance(specs, Mapping):
        specs = [specs]
    return [_parse_one(format_spec(spec), partition_cols) for spec in specs]


def format_spec(spec: Mapping[str, int]) -> str:
    return ",".join(f"{name}={value}" for name, value in spec.items()) or ALL_HOURS


def partition_spec_for(when: dt.date | dt.datetime, grain: str = "day") -> Spec:
    """The spec of the day (or year, month, hour) that contains ``when``."""
    names = PARTITION_COLS[: PARTITION_COLS.index(grain) + 1]
    return {name: int(getattr(when, name)) for name in names}


def partition_predicate(specs: Sequence[Mapping[str, int]]) -> Column:
    """AND within a spec, OR across specs; false for no specs.

    The predicate touches partition columns only, so it prunes directories. The disjunction is
    built as a balanced tree to keep the expression shallow for long spec lists.
    """
    terms = [_conjunction(spec) for spec in specs]
    if not terms:
        return F.lit(False)
    while len(terms) > 1:
        paired = [left | right for left, right in zip(terms[::2], terms[1::2])]
        terms = paired + terms[len(paired) * 2 :]
    return terms[0]


def _conjunction(spec: Mapping[str, int]) -> Column:
    condition = F.lit(True)
    for name, value in spec.items():
        condition = condition & (F.col(name) == F.lit(int(value)))
    return condition


def hour_key() -> Column:
    """One sortable number per hour directory, e.g. 2025081011; -1 for the null partition.

    It is a function of partition columns only: comparisons with it prune directories
    statically, joins on it prune them dynamically.
    """
    key = F.col("year").cast("bigint")
    for name in PARTITION_COLS[1:]:
        key = key * 100 + F.col(name)
    return F.coalesce(key, F.lit(-1).cast("bigint"))


def hour_key_of(ts: Column) -> Column:
    """The key of the hour that contains ``ts``."""
    key = F.year(ts).cast("bigint")
    for part in (F.month, F.dayofmonth, F.hour):
        key = key * 100 + part(ts)
    return key
