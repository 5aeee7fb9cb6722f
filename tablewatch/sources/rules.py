"""Check rules: thresholds and per-table check definitions (small, driver-side)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent_table: str
    parent_column: str


@dataclass(frozen=True)
class TableRule:
    name: str
    key_columns: tuple[str, ...] = ()
    null_check_columns: tuple[str, ...] = ()
    freshness_check: bool = False
    referential_integrity: tuple[ForeignKey, ...] = ()


@dataclass(frozen=True)
class Rules:
    # Defaults are the documented thresholds: null 1.0 %, duplicate 0.5 %, staleness 24 h.
    max_null_rate_pct: float = 1.0
    max_duplicate_rate_pct: float = 0.5
    fail_on_any_orphan: bool = True
    max_staleness_hours: float = 24
    fail_on_column_removed: bool = True
    fail_on_type_changed: bool = True
    warn_on_column_added: bool = True
    tables: tuple[TableRule, ...] = field(default_factory=tuple)


def rules_from_dict(cfg: dict) -> Rules:
    """Build rules from the ``data_quality`` section of a config mapping."""
    dq = cfg.get("data_quality", cfg)
    tables = tuple(
        TableRule(
            name=t["name"],
            key_columns=tuple(t.get("key_columns") or ()),
            null_check_columns=tuple(t.get("null_check_columns") or ()),
            freshness_check=bool(t.get("freshness_check", False)),
            referential_integrity=tuple(
                ForeignKey(fk["column"], fk["parent_table"], fk["parent_column"])
                for fk in (t.get("referential_integrity") or ())
            ),
        )
        for t in dq.get("tables", ())
    )
    return Rules(
        max_null_rate_pct=dq.get("null_checks", {}).get("max_null_rate_pct", 1.0),
        max_duplicate_rate_pct=dq.get("duplicate_checks", {}).get("max_duplicate_rate_pct", 0.5),
        fail_on_any_orphan=dq.get("referential_integrity", {}).get("fail_on_any_orphan", True),
        max_staleness_hours=dq.get("freshness_checks", {}).get("max_staleness_hours", 24),
        fail_on_column_removed=dq.get("schema_drift", {}).get("fail_on_column_removed", True),
        fail_on_type_changed=dq.get("schema_drift", {}).get("fail_on_type_changed", True),
        warn_on_column_added=dq.get("schema_drift", {}).get("warn_on_column_added", True),
        tables=tables,
    )


def load_rules(path: str) -> Rules:
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - yaml is optional
        raise RuntimeError("PyYAML is needed to read a YAML rules file; pass a dict to rules_from_dict") from exc
    with open(path, encoding="utf-8") as fh:
        return rules_from_dict(yaml.safe_load(fh))
