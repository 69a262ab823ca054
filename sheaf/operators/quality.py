"""Row expectations and row filters.

An expectation is a named SQL predicate; a row whose predicate is false or
NULL violates it. ``warn`` only counts, ``drop`` removes violating rows,
``fail`` stops the job at the first violating row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _ok(rule: str | Column) -> Column:
    c = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(c, F.lit(False))


def expect(
    df: DataFrame,
    warn: dict[str, str] | None = None,
    drop: dict[str, str] | None = None,
    fail: dict[str, str] | None = None,
    name: str | None = None,
) -> tuple[DataFrame, Observation | None]:
    """Apply expectations. Returns the checked DataFrame and, for a batch
    DataFrame with warn or drop rules, an ``Observation`` whose metrics
    (after an action) hold ``<rule>_failed`` counts. A streaming DataFrame
    reports the same counts per micro-batch under ``name`` in the query's
    progress (observed metrics); no Observation is returned."""
    out = df
    counted = {**(warn or {}), **(drop or {})}
    obs = None
    if counted:
        label = name or f"expectations_{uuid.uuid4().hex[:8]}"
        metrics = [F.count_if(~_ok(r)).alias(f"{n}_failed") for n, r in counted.items()]
        if df.isStreaming:
            # streams report named metrics per micro-batch in the query's
            # progress (``lastProgress["observedMetrics"][label]``)
            out = out.observe(label, *metrics)
        else:
            obs = Observation(label)
            out = out.observe(obs, *metrics)
    for n, r in (fail or {}).items():
        # A filter cannot be pruned away, unlike an unused projected column.
        out = out.filter(F.when(_ok(r), F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation '{n}' failed: {r}"))))
    if drop:
        keep = F.lit(True)
        for r in drop.values():
            keep = keep & _ok(r)
        out = out.filter(keep)
    return out, obs


def expectation_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per expectation: passed and failed row counts, from a single
    aggregation pass."""
    aggs = []
    for n, r in rules.items():
        aggs += [F.count_if(_ok(r)).alias(f"p_{len(aggs)}"), F.count_if(~_ok(r)).alias(f"f_{len(aggs) + 1}")]
    row = df.agg(*aggs)
    stacked = F.explode(
        F.array(*[
            F.struct(F.lit(n).alias("expectation"), F.col(f"p_{2 * i}").alias("passed"), F.col(f"f_{2 * i + 1}").alias("failed"))
            for i, n in enumerate(rules)
        ])
    )
    return row.select(stacked.alias("e")).select("e.*")


def row_filter(df: DataFrame, predicate: str | Column | None) -> DataFrame:
    """Published-table row filter; NULL keeps nothing."""
    if predicate is None:
        return df
    return df.filter(_ok(predicate))
