"""Registry of the runnable queries: name -> f(spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` (through the derived
views of :mod:`tvlens.sources.tables`) and runs over them whole.  Double
columns are rounded to 6 decimals at the very end so that results compare
across engines whose floating sums associate differently; the library
functions themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, FloatType

from tvlens.operators.overlap import overlap_ratio
from tvlens.plans import gold, serving
from tvlens.plans.operator_queries import OPERATORS
from tvlens.plans.shared import (
    AS_OF,
    shared_c360,
    shared_crm,
    shared_daily,
    shared_device,
    shared_logs,
    shared_partner,
)
from tvlens.sources.tables import load_views

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (for cross-engine comparison only).

    Computed as ``round(x * 10^d) / 10^d`` in binary floating point, the way
    DuckDB's ``round(x, d)`` works, so equal inputs round to bit-equal
    outputs in both engines (Spark's own ``round(x, d)`` rounds the decimal
    form and can differ at half-way points).
    """
    scale = f"{float(10**digits)}D"
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.selectExpr(*[f"round(`{c}` * {scale}) / {scale} AS `{c}`" if c in doubles else f"`{c}`" for c in df.columns])


_logs = shared_logs
_crm = shared_crm
_partner = shared_partner
_c360 = shared_c360
_daily = shared_daily
_device = shared_device


GOLD: dict[str, Query] = {
    # derived inputs
    "viewing_logs": _logs,
    "crm": _crm,
    "partner": _partner,
    # Q1-Q11
    "customer_base": lambda s, sf: gold.customer_base(_crm(s, sf)),
    "viewing_summary": lambda s, sf: gold.viewing_summary(_logs(s, sf)),
    "engagement_scores": lambda s, sf: gold.engagement_scores(_crm(s, sf), _logs(s, sf)),
    "customer_360": _c360,
    "programme_analytics": lambda s, sf: gold.programme_analytics(_logs(s, sf)),
    "peak_times": lambda s, sf: gold.peak_times(_logs(s, sf)),
    "device_analytics": _device,
    "daily_summary": _daily,
    # Q12-Q14
    "top_customers": lambda s, sf: gold.top_customers(_c360(s, sf), 100),
    "top_programmes": lambda s, sf: gold.top_programmes(_logs(s, sf), AS_OF, 7, 50),
    "peak_hours": lambda s, sf: gold.peak_hours(_logs(s, sf), AS_OF, 7),
}

SERVING: dict[str, Query] = {
    # Q15-Q19 validations and set-up checks
    "segment_summary": lambda s, sf: serving.segment_summary(_c360(s, sf)),
    "latest_days": lambda s, sf: serving.latest_days(_daily(s, sf), 10),
    "device_events": lambda s, sf: serving.device_events(_logs(s, sf)),
    "crm_count": lambda s, sf: serving.crm_count(_crm(s, sf)),
    "overlap_ratio": lambda s, sf: overlap_ratio(_crm(s, sf), _partner(s, sf)),
    # Q20-Q28 dashboard
    "platform_kpis_7": lambda s, sf: serving.platform_kpis(_daily(s, sf), AS_OF, 7, _logs(s, sf)),
    "platform_kpis_30": lambda s, sf: serving.platform_kpis(_daily(s, sf), AS_OF, 30, _logs(s, sf)),
    "platform_kpis_90": lambda s, sf: serving.platform_kpis(_daily(s, sf), AS_OF, 90, _logs(s, sf)),
    "platform_kpis_all": lambda s, sf: serving.platform_kpis(_daily(s, sf), AS_OF, None, _logs(s, sf)),
    "daily_trend": lambda s, sf: serving.daily_trend(_daily(s, sf), AS_OF, 30),
    "device_distribution": lambda s, sf: serving.device_distribution(_device(s, sf)),
    "segment_clv": lambda s, sf: serving.segment_clv(_c360(s, sf)),
    "top_customers_table": lambda s, sf: serving.top_customers_table(_c360(s, sf), 20),
    "top_programmes_table": lambda s, sf: serving.top_programmes_table(_logs(s, sf), AS_OF, 7, 20),
    "busiest_cells": lambda s, sf: serving.busiest_cells(gold.peak_hours(_logs(s, sf), AS_OF, 7), 24),
    "device_detail": lambda s, sf: serving.device_detail(_device(s, sf), 20),
    "qoe_trend": lambda s, sf: serving.qoe_trend(_daily(s, sf), AS_OF, 30),
}


SURVEY_IDS: dict[str, str] = {
    "viewing_logs": "S2 R11 R13 F1 F6 F10 F17 F20 P4",
    "crm": "S2 R1 R18 P4 P5 F3 J7",
    "partner": "S3 F1 F3",
    "customer_base": "Q1 P5 P8",
    "viewing_summary": "Q2 A1-A9 A14 A15 P19",
    "engagement_scores": "Q3 Q4 Q5 J1 P7 P15",
    "customer_360": "Q7 Q6 J2 P13 F22",
    "programme_analytics": "Q8 A7 A10 A12 A16 F17 F18",
    "peak_times": "Q9 A11 F19 P4",
    "device_analytics": "Q10 A9 A11",
    "daily_summary": "Q11 A11 A13 S7",
    "top_customers": "Q12 L4",
    "top_programmes": "Q13 P18 L4",
    "peak_hours": "Q14 A18 A19",
    "segment_summary": "Q15 A18",
    "latest_days": "Q16 L3 L4",
    "device_events": "Q17 (D3)",
    "crm_count": "Q18 A17",
    "overlap_ratio": "Q19 J6 A20",
    "platform_kpis_7": "Q20 P17 P18 A17",
    "platform_kpis_30": "Q20 P17 P18 A17",
    "platform_kpis_90": "Q20 P17 P18 A17",
    "platform_kpis_all": "Q20 P17 A17",
    "daily_trend": "Q21 P17 L3",
    "device_distribution": "Q22 A18 (D5)",
    "segment_clv": "Q23 A18 P19",
    "top_customers_table": "Q24 L5",
    "top_programmes_table": "Q25 L5",
    "busiest_cells": "Q26 L2 L4",
    "device_detail": "Q27 L2 L4",
    "qoe_trend": "Q28 P17 L3",
    "cyclic_lookup": "J3 R2 J7 J8 F10",
    "cyclic_lookup_shuffled": "J3 R2 W2",
    "dense_index": "W2",
    "row_number": "W1 W6",
    "assign_quota": "R1 W1",
    "substitute_from_source": "R4 J3",
    "stable_ids": "F8",
    "attach_fraction": "R3 P11",
    "null_out": "R5 F15",
    "near_duplicates": "R6 W5 U1 P20 F4 F5",
    "hash_category": "R7 F14",
    "expand_rows": "R8 J5",
    "capped_sample": "R10 W3 W4",
    "exact_sample": "L6 S13",
    "fraction_sample": "L7",
    "half_hour_slots": "R11 F6 F20",
    "slot_grid": "R11 F20 F21",
    "variant_fields": "F26",
    "case_map": "P4 P6 P7",
    "string_funcs": "F1-F5 F7",
    "date_funcs": "F17-F25 T1 T2",
    "math_funcs": "F9-F13 P9 P15 T3",
    "cross_one_row": "J4 A20",
    "scalar_subquery": "J7 J8",
    "overlap_flags": "J6",
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (GOLD, SERVING, OPERATORS):
        out.update(group)
    return {name: _rounded(fn) for name, fn in out.items()}


def registered() -> dict[str, Query]:
    """All queries, those of the dashboard over the stored tables."""
    from tvlens.plans.stored import STORED

    return all_queries() | {name: _rounded(fn) for name, fn in STORED.items()}


def _rounded(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return load_views(spark, sf_dir, AS_OF)
