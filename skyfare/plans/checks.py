"""Running a list of data-quality checks over the built tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyfare.operators import quality
from skyfare.scratch import hold
from skyfare.sinks.tables import materialize


_SUMMARY = "position int, check string, model string, column string, detail string, failures bigint"


@dataclass(frozen=True)
class Check:
    """One check: `kind` on `column` of `model`; what `args` holds depends on the kind.

    not_null, unique: nothing. accepted_values: the values. relationships: (parent model, parent
    column). unique_combination: the columns. expression_is_true: (expression,).
    """

    kind: str
    model: str
    column: str
    args: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.model}__{self.column}"


class ChecksFailed(Exception):
    """At least one check has failing rows; `failed` lists (check name, failures)."""

    def __init__(self, failed: Sequence[tuple[str, int]]):
        self.failed = list(failed)
        super().__init__(", ".join(f"{name}: {n}" for name, n in failed))


def failing_rows(models: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """Failing rows of one check."""
    df = models[check.model]
    if check.kind == "not_null":
        return quality.not_null(df, check.column)
    if check.kind == "unique":
        return quality.unique(df, check.column)
    if check.kind == "accepted_values":
        return quality.accepted_values(df, check.column, check.args)
    if check.kind == "relationships":
        parent, parent_column = check.args
        return quality.relationships(df, check.column, models[parent], parent_column)
    if check.kind == "unique_combination":
        return quality.unique_combination(df, check.args)
    if check.kind == "expression_is_true":
        return quality.expression_is_true(df, check.args[0])
    raise ValueError(f"unknown kind of check: {check.kind}")


def _row_failure(check: Check) -> Column | None:
    """Condition of a failing row, for the checks that look at one row at a time."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "expression_is_true":
        return ~F.expr(check.args[0])
    return None


def _labels(position: int, check: Check) -> list[Column]:
    detail = check.args[0] if check.kind == "expression_is_true" else ""
    return [
        F.lit(position).alias("position"),
        F.lit(check.kind).alias("check"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        F.lit(detail).alias("detail"),
    ]


def _row_checks_summary(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """All row-at-a-time checks of one table, in one aggregate over one scan."""
    counts = df.agg(*[F.count_if(_row_failure(check)).alias(f"c{i}") for i, check in checks])
    lines = [F.struct(*_labels(i, check), F.col(f"c{i}").alias("failures")) for i, check in checks]
    return counts.select(F.inline(F.array(*lines)))


def _group_check_summary(models: Mapping[str, DataFrame], position: int, check: Check) -> DataFrame:
    if check.kind == "relationships":
        parent, parent_column = check.args
        orphans = quality.orphan_values(
            models[check.model], check.column, models[parent], parent_column
        )
        failures = F.coalesce(F.sum("n_records"), F.lit(0))
    else:
        orphans = failing_rows(models, check)
        failures = F.count(F.lit(1))
    return orphans.agg(failures.alias("failures")).select(*_labels(position, check), "failures")


def _summary(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check, with its position in the list."""
    by_model: dict[str, list[tuple[int, Check]]] = {}
    parts: list[DataFrame] = []
    for i, check in enumerate(checks):
        if _row_failure(check) is not None:
            by_model.setdefault(check.model, []).append((i, check))
        else:
            parts.append(_group_check_summary(models, i, check))
    parts += [_row_checks_summary(models[model], group) for model, group in by_model.items()]
    if not parts:
        return SparkSession.active().createDataFrame([], _SUMMARY)
    return reduce(DataFrame.unionByName, parts)


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, model, column, detail, failures.

    Checks on single rows cost one scan per table however many there are.
    """
    return _summary(models, checks).drop("position")


def check_names(checks: Sequence[Check]) -> list[str]:
    """A name for each check; those of one kind on one column are numbered."""
    names = [c.name for c in checks]
    return [n if names.count(n) == 1 else f"{n}__{names[:i].count(n) + 1}" for i, n in enumerate(names)]


def enforce_checks(
    models: Mapping[str, DataFrame],
    checks: Sequence[Check],
    store_prefix: str | None = None,
    store_path: str | None = None,
) -> DataFrame:
    """Run the checks; with a `store_prefix`, keep the failing rows of each failed check in table
    `<store_prefix>_<check name>`; raise ChecksFailed if any check failed, else return the summary.
    """
    if len(set(checks)) < len(checks):
        raise ValueError("a check is listed twice")
    summary = hold(_summary(models, checks), "check-summary").df
    counts = {r.position: r.failures for r in summary.collect()}  # as small as the list of checks
    failed = []
    for i, (check, name) in enumerate(zip(checks, check_names(checks), strict=True)):
        if not counts[i]:
            continue
        failed.append((name, counts[i]))
        if store_prefix is not None:
            path = f"{store_path}/{name}" if store_path else None
            materialize(failing_rows(models, check), f"{store_prefix}_{name}", path=path)
    if failed:
        raise ChecksFailed(failed)
    return summary.drop("position")
