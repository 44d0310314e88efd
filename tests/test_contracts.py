import json

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import (
    CDC_CONTRACTS, METRIC_CONTRACTS, Contract, FieldRule, constraint_column, contract_from_dict, evolution_violations, load_contracts,
)

from tidemark.operators.merge import EntitySpec

DOC = {
    "entity": "things",
    "primary_key": ["thing_id"],
    "required_envelope_fields": ["op"],
    "payload_rules": {"after_required_when_op": ["c"], "delete_rules": {"after_must_be_null": True}},
    "schema": {"fields": {"thing_id": {"type": "int64", "nullable": False}, "price": {"type": "decimal(10,3)", "constraints": [">= 0"]}}},
    "schema_evolution_policy": {"drop_column": {"allowed": False}, "change_type": {"allowed": True}},
}


def test_load_json_and_yaml(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOC))
    (tmp_path / "b.yaml").write_text("table: flat\nprimary_key: flat_id\nrequired_fields: [flat_id]\n")
    found = load_contracts(str(tmp_path))
    assert set(found) == {"things", "flat"}
    assert found["things"].payload_schema.simpleString() == "struct<thing_id:bigint,price:decimal(10,3)>"
    assert found["flat"].primary_key == ("flat_id",) and not found["flat"].fields
    with pytest.raises(FileNotFoundError):
        load_contracts(str(tmp_path / "missing"))


def test_builtin_contracts():
    assert set(CDC_CONTRACTS) == {"users", "orders", "payments"}
    assert set(METRIC_CONTRACTS) == {"kpis", "user_segments"}
    assert CDC_CONTRACTS["users"].primary_key == ("user_id",)
    assert "pending" not in CDC_CONTRACTS["payments"].fields["status"].allowed_values


def test_evolution():
    old = contract_from_dict(DOC)
    dropped = Contract("things", ("thing_id",), {"thing_id": FieldRule("string")})
    assert evolution_violations(old, dropped) == ["dropped field price"]
    strict = contract_from_dict({**DOC, "schema_evolution_policy": {}})
    assert "field thing_id changed type from int64 to string" in evolution_violations(strict, dropped)
    added = Contract("things", ("thing_id",), {**old.fields, "x": FieldRule(nullable=False), "y": FieldRule(nullable=False, has_default=True), "z": FieldRule()})
    assert evolution_violations(old, added) == ["new field x must be nullable or have a default"]


def test_constraints(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, 0.0), (3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(constraint_column(F.col("a"), ">= 0")).collect()] == [True, False, True]
    assert [r[0] for r in df.select(constraint_column(F.col("a"), "<= b")).collect()] == [True, True, None]
    for bad in ("> 1; drop", "between 1 and 2", ""):
        with pytest.raises(ValueError):
            constraint_column(F.col("a"), bad)


def test_decimal_setting_of_the_connector_names_the_encoding():
    orders = CDC_CONTRACTS["orders"].with_decimals("precise")
    assert {n: r.encoding for n, r in orders.fields.items() if r.encoding != "number"} == {"total_amount": "bytes"}
    assert EntitySpec.from_contract(orders).encodings == (("total_amount", "bytes"),)
    assert EntitySpec.from_contract(orders.with_decimals("string")).encodings == ()
    doc = {"entity": "x", "primary_key": "id", "schema": {"fields": {"id": {"type": "int64"}, "v": {"type": "decimal(9,2)", "encoding": "bytes"}}}}
    assert EntitySpec.from_contract(contract_from_dict(doc)).encodings == (("v", "bytes"),)
    with pytest.raises(KeyError):
        orders.with_decimals("guess")
