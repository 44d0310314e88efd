"""Declarative contracts for change events and metric tables.

A contract is data. It is read once on the driver and compiled to Column expressions, so tasks never
load it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "FieldRule",
    "Contract",
    "contract_from_dict",
    "load_contracts",
    "evolution_violations",
    "constraint_column",
    "CDC_CONTRACTS",
    "METRIC_CONTRACTS",
    "TOPIC_ENTITIES",
]

# Contract type names and the Spark types they stand for.
TYPE_NAMES = {
    "int64": "bigint",
    "int32": "int",
    "string": "string",
    "timestamp": "timestamp",
    "date": "date",
    "double": "double",
    "boolean": "boolean",
}

# Decimal settings of the change-capture connector and how they write a decimal.
DECIMAL_HANDLING = {"precise": "bytes", "double": "number", "string": "number"}

# Source topics and their entities.
TOPIC_ENTITIES = {
    "dbserver_docker.public.users": "users",
    "dbserver_docker.public.orders": "orders",
    "dbserver_docker.public.payments": "payments",
}


@dataclass(frozen=True)
class FieldRule:
    type: str = "string"
    nullable: bool = True
    allowed_values: tuple = ()
    constraints: tuple[str, ...] = ()
    pii: bool = False
    has_default: bool = False
    #: how the source writes decimals: ``number``, or ``bytes`` for base64 text of the unscaled integer
    encoding: str = "number"

    @property
    def spark_type(self) -> str:
        return TYPE_NAMES.get(self.type, self.type)


@dataclass(frozen=True)
class Contract:
    entity: str
    primary_key: tuple[str, ...]
    fields: Mapping[str, FieldRule] = field(default_factory=dict)
    required_fields: tuple[str, ...] = ()
    required_envelope_fields: tuple[str, ...] = ()
    allowed_ops: tuple[str, ...] = ("c", "u", "d", "r")
    after_required_ops: tuple[str, ...] = ()
    delete_after_must_be_null: bool = False
    delete_before_should_exist: bool = False
    evolution: Mapping[str, bool] = field(default_factory=dict)

    @property
    def payload_schema(self) -> T.StructType:
        """Typed schema of ``before`` and ``after``."""
        return T.StructType(
            [T.StructField(n, _data_type(r.spark_type), True) for n, r in self.fields.items()]
        )

    def with_decimals(self, handling: str) -> Contract:
        """The contract for a connector with this decimal setting; fields that are no decimals stay as they are."""
        coded = DECIMAL_HANDLING[handling]
        return replace(
            self, fields={n: replace(r, encoding=coded) if r.spark_type.startswith("decimal") else r for n, r in self.fields.items()}
        )

    def allows(self, change: str) -> bool:
        """Evolution policy for ``add_column``, ``drop_column`` or ``change_type``."""
        return self.evolution.get(change, change == "add_column")


def _data_type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = (int(n) for n in re.findall(r"\d+", name))
        return T.DecimalType(precision, scale)
    return {
        "bigint": T.LongType(),
        "int": T.IntegerType(),
        "string": T.StringType(),
        "timestamp": T.TimestampType(),
        "date": T.DateType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
    }[name]


def _names(value) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value or ())


def contract_from_dict(doc: Mapping) -> Contract:
    """Contract from a parsed document; a document in the flat layout has no typed fields."""
    rules = doc.get("payload_rules") or {}
    deletes = rules.get("delete_rules") or {}
    declared = (doc.get("schema") or {}).get("fields") or {}
    return Contract(
        entity=doc.get("entity") or doc["table"],
        primary_key=_names(doc.get("primary_key")),
        fields={
            name: FieldRule(
                type=spec.get("type", "string"),
                nullable=spec.get("nullable", True),
                allowed_values=tuple(spec.get("allowed_values") or ()),
                constraints=tuple(spec.get("constraints") or ()),
                pii=bool(spec.get("pii", False)),
                has_default="default" in spec,
                encoding=spec.get("encoding", "number"),
            )
            for name, spec in declared.items()
        },
        required_fields=_names(doc.get("required_fields")),
        required_envelope_fields=_names(doc.get("required_envelope_fields")),
        allowed_ops=_names((doc.get("op_semantics") or {}).get("allowed_ops")) or ("c", "u", "d", "r"),
        after_required_ops=_names(rules.get("after_required_when_op")),
        delete_after_must_be_null=bool(deletes.get("after_must_be_null", False)),
        delete_before_should_exist=bool(deletes.get("before_should_exist", False)),
        evolution={
            change: bool((policy or {}).get("allowed", False))
            for change, policy in (doc.get("schema_evolution_policy") or {}).items()
        },
    )


def load_contracts(folder: str) -> dict[str, Contract]:
    """All ``*.yaml`` and ``*.json`` contracts of a folder, by entity."""
    root = Path(folder)
    if not root.is_dir():
        raise FileNotFoundError(f"contract folder not found: {folder}")
    found = {}
    for path in sorted([*root.glob("*.yaml"), *root.glob("*.json")]):
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            doc = json.loads(text)
        else:
            try:
                import yaml
            except ImportError as err:
                raise RuntimeError("reading YAML contracts needs PyYAML; JSON works without") from err
            doc = yaml.safe_load(text)
        contract = contract_from_dict(doc)
        found[contract.entity] = contract
    return found


def evolution_violations(old: Contract, new: Contract) -> list[str]:
    """Changes between two versions that the old version's policy forbids."""
    problems = []
    if not old.allows("drop_column"):
        problems += [f"dropped field {n}" for n in old.fields if n not in new.fields]
    if not old.allows("change_type"):
        problems += [
            f"field {n} changed type from {rule.type} to {new.fields[n].type}"
            for n, rule in old.fields.items()
            if n in new.fields and new.fields[n].type != rule.type
        ]
    problems += [
        f"new field {n} must be nullable or have a default"
        for n, rule in new.fields.items()
        if n not in old.fields and not rule.nullable and not rule.has_default
    ]
    return problems


_CONSTRAINT = re.compile(r"^\s*(>=|<=|>|<|=|!=)\s*(-?\d+(?:\.\d+)?|[A-Za-z_]\w*)\s*$")


def constraint_column(column: Column, text: str, resolve=F.col) -> Column:
    """Condition for a declared constraint: an operator and a number or another field."""
    match = _CONSTRAINT.match(text)
    if not match:
        raise ValueError(f"unsupported constraint {text!r}")
    op, operand = match.groups()
    numeric = operand[0] == "-" or operand[0].isdigit()
    right = F.expr(operand) if numeric else resolve(operand)
    return {
        ">=": column >= right,
        "<=": column <= right,
        ">": column > right,
        "<": column < right,
        "=": column == right,
        "!=": column != right,
    }[op]


_ADDITIVE = {"add_column": True, "drop_column": False, "change_type": False}


def _cdc(entity: str, key: str, fields: dict[str, FieldRule]) -> Contract:
    return Contract(
        entity=entity,
        primary_key=(key,),
        fields=fields,
        required_envelope_fields=("op", "ts_ms", "source"),
        after_required_ops=("c", "u", "r"),
        delete_after_must_be_null=True,
        delete_before_should_exist=True,
        evolution=_ADDITIVE,
    )


# Fields, types and allowed values of the published contracts.
CDC_CONTRACTS: dict[str, Contract] = {
    "users": _cdc(
        "users",
        "user_id",
        {
            "user_id": FieldRule("int64", nullable=False),
            "email": FieldRule("string", pii=True),
            "status": FieldRule("string", allowed_values=("active", "blocked", "deleted")),
            "created_at": FieldRule("timestamp"),
            "updated_at": FieldRule("timestamp"),
        },
    ),
    "orders": _cdc(
        "orders",
        "order_id",
        {
            "order_id": FieldRule("int64", nullable=False),
            "user_id": FieldRule("int64", nullable=False),
            "order_ts": FieldRule("timestamp"),
            "status": FieldRule(
                "string", allowed_values=("created", "paid", "shipped", "cancelled", "refunded")
            ),
            "total_amount": FieldRule("decimal(18,2)", constraints=(">= 0",)),
            "updated_at": FieldRule("timestamp"),
        },
    ),
    "payments": _cdc(
        "payments",
        "payment_id",
        {
            "payment_id": FieldRule("int64", nullable=False),
            "order_id": FieldRule("int64", nullable=False),
            "amount": FieldRule("decimal(18,2)", constraints=(">= 0",)),
            "status": FieldRule(
                "string",
                allowed_values=("created", "authorized", "captured", "failed", "refunded", "cancelled"),
            ),
            "failure_reason": FieldRule("string"),
            "updated_at": FieldRule("timestamp"),
        },
    ),
}

METRIC_CONTRACTS: dict[str, Contract] = {
    "kpis": Contract(
        entity="kpis",
        primary_key=("kpi_date", "metric_version"),
        required_fields=("kpi_date", "total_gmv", "order_count", "metric_version"),
        evolution=_ADDITIVE,
        fields={
            "kpi_date": FieldRule("date", nullable=False),
            "total_gmv": FieldRule("decimal(18,2)", nullable=False, constraints=(">= 0",)),
            "order_count": FieldRule("int64", nullable=False, constraints=(">= 0",)),
            "active_users": FieldRule("int64", constraints=(">= 0",)),
            "payment_count": FieldRule("int64", constraints=(">= 0",)),
            "captured_amount": FieldRule("decimal(18,2)", constraints=(">= 0", "<= total_gmv")),
            "payment_success_rate": FieldRule("double", constraints=(">= 0", "<= 1")),
            "metric_version": FieldRule("string", nullable=False, allowed_values=("v1", "v2")),
        },
    ),
    "user_segments": Contract(
        entity="user_segments",
        primary_key=("user_id", "segment_date"),
        required_fields=("user_id", "segment_date", "value_segment", "activity_segment"),
        evolution=_ADDITIVE,
        fields={
            "user_id": FieldRule("int64", nullable=False),
            "segment_date": FieldRule("date", nullable=False),
            "value_segment": FieldRule(
                "string", allowed_values=("high_value", "medium_value", "low_value")
            ),
            "activity_segment": FieldRule("string", allowed_values=("churn_risk", "active", "dormant")),
            "last_90d_gmv": FieldRule("decimal(18,2)", constraints=(">= 0",)),
            "is_churn_risk": FieldRule("int32", allowed_values=(0, 1)),
            "is_active": FieldRule("int32", allowed_values=(0, 1)),
        },
    ),
}
