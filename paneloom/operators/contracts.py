"""Contracts of source and factor tables, as rules for `checks.check_rules`."""

from __future__ import annotations

# Enumerations, families and fields that the contracts name. -------------------------------------------------------------
SOURCE_STATUS = ["success", "unstable", "failed", "candidate", "prototype"]
READINESS = ["ready_for_builder", "needs_pit_alignment", "needs_event_window_design", "needs_membership_asof", "raw_source_only", "deferred"]
BUILT_FAMILIES = ["technical_liquidity", "margin_leverage", "market_regime"]
RANKING_EVENT, RANKING_OUTCOMES = "stock_lhb_detail_em", ["上榜后1日", "上榜后2日", "上榜后5日", "上榜后10日"]
RELEASE_EVENT, RELEASE_OUTCOMES = "stock_restricted_release_detail_em", ["解禁后20日涨跌幅"]


def _required(*columns: str) -> list[dict]:
    return [{"name": f"{c} is empty", "kind": "required", "column": c} for c in columns]


def _implies(name: str, when: str, then: str) -> dict:
    return {"name": name, "kind": "implies", "if": when, "then": then}


def _lists(event: str, fields: list[str]) -> dict:
    return _implies(f"{event} lists its outcomes", f"source_api = '{event}'", " AND ".join(f"contains(post_event_outcome_fields, '{f}')" for f in fields))


SOURCE_INVENTORY = [
    *_required("api_name", "source_family", "pit_quality", "research_value"),
    {"name": "status is known", "kind": "enum", "column": "status", "values": SOURCE_STATUS},
]
ADAPTER_COVERAGE = [
    *_required("adapter_function", "module", "api_name", "source_family", "status"),
    *[{"name": f"{c} is true or false", "kind": "bool_like", "column": c} for c in ("raw_only", "computes_factors", "parameterized")],
    _implies("computes_factors stays false", "lower(computes_factors) = 'true'", "false"),
]
FAMILY_TAXONOMY = [
    *_required("factor_family", "current_status", "source_families", "intended_role"),
    {"name": "factor_family is unique", "kind": "unique", "column": "factor_family"},
    {"name": "families exist", "kind": "must_exist", "column": "factor_family", "values": ["technical_liquidity", "fundamental_quality"]},
    _implies("technical_liquidity is built", "factor_family = 'technical_liquidity'", "trim(current_status) = 'builder_v0_exists'"),
    _implies("fundamental_quality is a prototype", "factor_family = 'fundamental_quality'", "trim(current_status) = 'prototype_source_only' OR lower(notes) LIKE '%pit%' OR lower(notes) LIKE '%disclosure%'"),
]
FAMILY_READINESS = [
    *_required("factor_family", "current_status", "recommended_next_step", "priority"),
    {"name": "factor_family is unique", "kind": "unique", "column": "factor_family"},
    {"name": "builder_readiness is known", "kind": "enum", "column": "builder_readiness", "values": READINESS},
    {"name": "families exist", "kind": "must_exist", "column": "factor_family", "values": ["technical_liquidity", "fundamental_quality"]},
    _implies("technical_liquidity is ready", "factor_family = 'technical_liquidity'", "builder_readiness = 'ready_for_builder'"),
    _implies("fundamental_quality is not ready", "factor_family = 'fundamental_quality'", "builder_readiness <> 'ready_for_builder'"),
    _implies("risks need a safety note", "trim(forbidden_field_risks) <> '' AND trim(builder_readiness) = 'ready_for_builder'", "lower(notes) LIKE '%safety%' OR lower(notes) LIKE '%blacklist%'"),
]
BUILDER_COVERAGE = [
    *_required("factor_family", "builder_function", "module", "current_status"),
    {"name": "factor_family is unique", "kind": "unique", "column": "factor_family"},
    {"name": "families exist", "kind": "must_exist", "column": "factor_family", "values": BUILT_FAMILIES},
    *[{"name": f"{c} is true or false", "kind": "bool_like", "column": c} for c in ("allowed_for_real_data_runner", "computes_signals", "runs_backtest")],
    *[_implies(f"{c} stays false", f"lower({c}) = 'true'", "false") for c in ("computes_signals", "runs_backtest")],
]
INDUSTRY_CONTRACT = _required("source_api", "source_family", "date_field", "symbol_field", "industry_code_field", "asof_rule", "usable_for_historical_backtest")
EVENT_CONTRACT = [
    *_required("source_api", "source_family", "event_type", "primary_event_date", "pit_requirement", "builder_readiness"),
    _implies("outcomes are forbidden", "trim(post_event_outcome_fields) <> ''", "trim(forbidden_usage) <> ''"),
    {"name": "events exist", "kind": "must_exist", "column": "source_api", "values": [RANKING_EVENT, RELEASE_EVENT]},
    _lists(RANKING_EVENT, RANKING_OUTCOMES),
    _lists(RELEASE_EVENT, RELEASE_OUTCOMES),
]
