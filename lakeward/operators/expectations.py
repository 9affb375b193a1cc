"""Named row expectations: pass/fail counters, optional row dropping.

A rule is ``name -> SQL boolean text``. A row *passes* a rule only when the
predicate is TRUE; FALSE and NULL both count as failed (the same rows a
``WHERE rule`` filter would drop), so ``passed + failed = count(*)`` always.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("table_name", "expectation", "passed_records", "failed_records")


def merge_rules(*rule_sets: Mapping[str, str]) -> dict[str, str]:
    """Union of rule dicts; a later dict wins on a repeated name."""
    merged: dict[str, str] = {}
    for rules in rule_sets:
        merged.update(rules)
    return merged


def _passed_alias(i: int) -> str:
    return f"_passed_{i}"


def passed_exprs(rules: Mapping[str, str]) -> list[Column]:
    """One ``count_if(rule)`` per rule plus the row count, for ``agg`` or ``observe``."""
    exprs = [F.count_if(F.coalesce(F.expr(pred), F.lit(False))).alias(_passed_alias(i))
             for i, pred in enumerate(rules.values())]
    exprs.append(F.count(F.lit(1)).alias("_rows"))
    return exprs


def rule_metrics(df: DataFrame, rules: Mapping[str, str], table_name: str) -> DataFrame:
    """Long metrics ``(table_name, expectation, passed_records, failed_records)``.

    All rules are counted in ONE pass: a single global aggregate of
    ``count_if``s (partial per task, one tiny final merge), then the single
    result row is unpivoted. No shuffle of data rows at any size.
    """
    if not rules:
        raise ValueError("rule_metrics needs at least one rule")
    wide = df.agg(*passed_exprs(rules))
    entries = F.array(*[
        F.struct(F.lit(name).alias("expectation"),
                 F.col(_passed_alias(i)).alias("passed_records"))
        for i, name in enumerate(rules)])
    return (wide.select(F.col("_rows"), F.inline(entries))
            .select(F.lit(table_name).alias("table_name"), "expectation", "passed_records",
                    (F.col("_rows") - F.col("passed_records")).alias("failed_records")))


def metrics_from_observation(values: Mapping[str, int], rules: Mapping[str, str],
                             table_name: str) -> list[dict]:
    """Observed ``passed_exprs`` values -> counter dicts (driver side; one per rule)."""
    rows = int(values.get("_rows", 0) or 0)
    out = []
    for i, name in enumerate(rules):
        passed = int(values.get(_passed_alias(i), 0) or 0)
        out.append({"dataset": table_name, "name": name,
                    "passed_records": passed, "failed_records": rows - passed})
    return out


def all_rules_hold(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for pred in rules.values():
        cond = cond & F.coalesce(F.expr(pred), F.lit(False))
    return cond


def drop_failing(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Drop severity: keep only rows for which every rule is TRUE."""
    return df.filter(all_rules_hold(rules))


FAILED_RULES = "_failed_rules"


def failed_rules(rules: Mapping[str, str]) -> Column:
    """Names of the rules that a row fails, in the order of the rules (an empty array: none)."""
    names = [F.when(~F.coalesce(F.expr(pred), F.lit(False)), F.lit(name)) for name, pred in rules.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
