"""Constraints of the declared schemas, counted by the pass that writes a table.

``violations`` gives a predicate for each rule of a schema: a column that must not be
null, a text longer than its declared length, a flag other than 0 and 1.
``write_checked`` counts them in an ``Observation`` on the write itself, so nothing
is scanned twice, and raises ``ConstraintViolation`` when any row breaks a rule.  The
caller publishes a table only after that, so no reader sees such rows.

``fingerprint`` is an order-free digest of a table's contents, taken the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

R = TypeVar("R")
_RULE = "_rule_"


class ConstraintViolation(RuntimeError):
    """Rows break declared constraints; ``counts`` holds rows by rule."""

    def __init__(self, table: str, counts: Mapping[str, int]):
        self.table, self.counts = table, dict(counts)
        listed = "; ".join(f"{rule} ({n} rows)" for rule, n in sorted(self.counts.items()))
        super().__init__(f"{table}: {listed}")


def violations(schema: T.StructType) -> dict[str, Column]:
    """Rule -> whether a row breaks it (never null)."""
    rules: dict[str, Column] = {}
    for field in schema.fields:
        value = F.col(field.name)
        if not field.nullable:
            rules[f"{field.name} is null"] = value.isNull()
        if isinstance(field.dataType, T.StringType) and field.name in schemas.TEXT_LENGTHS:
            longest = schemas.TEXT_LENGTHS[field.name]
            rules[f"{field.name} has more than {longest} characters"] = F.coalesce(
                F.char_length(value) > longest, F.lit(False))
        if field.name in schemas.FLAGS:
            rules[f"{field.name} is neither 0 nor 1"] = F.coalesce(
                ~value.isin(0, 1), F.lit(False))
    return rules


def rule_counts(schema: T.StructType) -> list[Column]:
    """Metrics for an ``Observation``: rows that break each rule."""
    return [F.count_if(broken).alias(f"{_RULE}{rule}") for rule, broken in violations(schema).items()]


def raise_violations(table: str, observed: Mapping[str, object]) -> None:
    """Fail if observed ``rule_counts`` are not all zero."""
    broken = {name[len(_RULE):]: n for name, n in observed.items() if name.startswith(_RULE) and n}
    if broken:
        raise ConstraintViolation(table, broken)


def write_checked(df: DataFrame, table: str, schema: T.StructType,
                  write: Callable[[DataFrame], R]) -> R:
    """Run ``write`` on ``df``; fail if a row written breaks a rule of ``schema``."""
    observation = Observation(f"constraints.{table}")
    written = write(df.observe(observation, F.count(F.lit(1)).alias("rows"), *rule_counts(schema)))
    raise_violations(table, observation.get)
    return written


def fingerprint(fields: Sequence[T.StructField]) -> Column:
    """Sum of the 64-bit hashes of the rows over ``fields`` (cast to their declared
    types), in a decimal that holds 10^18 rows.  Two tables with equal counts and
    equal sums hold the same rows in any order, but for a chance of 2^-64."""
    values = [F.col(f.name).cast(f.dataType) for f in fields]
    # A null would leave the hash as it was, so that nulls of two columns could not
    # be told apart: hash which columns are null as well.
    nulls = [F.col(f.name).isNull() for f in fields]
    return F.sum(F.xxhash64(*values, *nulls).cast("decimal(38,0)"))
