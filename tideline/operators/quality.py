"""Named data-quality rules: warn, drop the row, or fail the update.

A row passes a rule only when its condition is TRUE; NULL is a violation. All rules of a dataset
are evaluated on the same input row in one pass: counters are taken first, then one filter
applies the fail and drop rules together. Two chained filters would let a drop rule hide a
failing row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INPUT_ROWS = "input_rows"
DROPPED_ROWS = "dropped_rows"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str | Column
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"rule {self.name}: unknown action {self.action}")

    @property
    def holds(self) -> Column:
        condition = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(condition, F.lit(False))


def expect(name: str, condition: str | Column) -> Rule:
    return Rule(name, condition, "warn")


def expect_or_drop(name: str, condition: str | Column) -> Rule:
    return Rule(name, condition, "drop")


def expect_or_fail(name: str, condition: str | Column) -> Rule:
    return Rule(name, condition, "fail")


def _all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.holds for r in rules], F.lit(True))


def _by_action(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def _fails_update(rules: Sequence[Rule]) -> Column:
    """Raise with the name of the first broken fail rule."""
    check = F.lit(True)
    for rule in reversed(_by_action(rules, "fail")):
        broken = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
        check = F.when(~rule.holds, broken).otherwise(check)
    return check


def counters(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates behind the quality counters; ``failed_<i>`` follows the order of ``rules``."""
    kept = _all_hold(_by_action(rules, "drop"))
    return [F.count(F.lit(1)).alias(INPUT_ROWS),
            F.count_if(~kept).alias(DROPPED_ROWS),
            *[F.count_if(~r.holds).alias(f"failed_{i}") for i, r in enumerate(rules)]]


def apply_expectations(df: DataFrame, rules: Sequence[Rule], observe_as=None) -> DataFrame:
    """Keep the rows the rules allow; abort the job on a row that breaks a fail rule.

    ``observe_as`` (an Observation, or a metric name on a stream) collects ``counters`` over the
    rows before any drop, also where there are no rules. Without it, drop rules are plain filters that
    reach the scan.
    """
    if observe_as is not None:
        df = df.observe(observe_as, *counters(rules))
    if not rules:
        return df
    drops, fails = _by_action(rules, "drop"), _by_action(rules, "fail")
    if fails:
        verdict = _all_hold(drops)
        checked = F.when(_all_hold(fails), verdict).otherwise(_fails_update(rules))
        return df.where(checked)
    for rule in drops:
        df = df.where(rule.condition)
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule], inverse: str | Column | None = None) -> DataFrame:
    """Rows that a drop or fail rule rejects.

    By default the exact complement of the rules, so clean plus quarantine is the input. A
    hand-written ``inverse`` predicate is applied literally instead; rows for which it is NULL
    are then in neither table.
    """
    if inverse is not None:
        return df.where(inverse)
    binding = [r for r in rules if r.action != "warn"]
    return df.where(~_all_hold(binding))


def expectation_counts(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: dataset, name, passed_records, failed_records.

    A single partial aggregate; only the one-row result is turned into rows.
    """
    totals = df.agg(*counters(rules))
    entries = [F.struct(F.lit(dataset).alias("dataset"), F.lit(r.name).alias("name"),
                        (F.col(INPUT_ROWS) - F.col(f"failed_{i}")).alias("passed_records"),
                        F.col(f"failed_{i}").alias("failed_records"))
               for i, r in enumerate(rules)]
    return totals.select(F.inline(F.array(*entries)))
