"""The rules of one table as its catalog extract states them, ready for the report over its data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.columns import dedupe, type_columns
from tidegate.operators.spec import TargetColumn, table_spec
from tidegate.plans.report import migration_report
from tidegate.sources.catalog_csv import catalog_records


@dataclass(frozen=True)
class Reference:
    """A foreign key: its columns, and the table and columns of the constraint it names."""

    columns: tuple[str, ...]
    parent: tuple[str, str]
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableRules:
    spec: tuple[TargetColumn, ...]
    unique: Mapping[str, tuple[str, ...]]
    references: Mapping[str, Reference]
    checks: Mapping[str, str]


def _columns_by(rows: list, name: str) -> dict[str, tuple[str, ...]]:
    """The columns under each constraint, in order of COLUMN_ID, which is all the order an extract has."""
    found: dict[str, dict[str, int]] = {}
    for row in rows:
        if row[name]:
            found.setdefault(row[name], {}).setdefault(row["COLUMN_NAME"], int(row["COLUMN_ID"]))
    return {key: tuple(sorted(columns, key=lambda c: (columns[c], c))) for key, columns in found.items()}


def table_rules(extract: DataFrame, owner: str, table: str) -> TableRules:
    """Spec, unique keys, references and conditions of one table of a full extract.

    What comes to the driver is the table's own rows and those of the constraints it refers to. The
    conditions must be ones that Spark SQL understands.
    """
    one = (F.col("OWNER") == owner) & (F.col("TABLE_NAME") == table)
    spec = table_spec(type_columns(dedupe(catalog_records(extract.filter(one)))), owner, table)
    rows = extract.filter(one).collect()
    wanted = sorted({r["REFERENCED_CONSTRAINT"] for r in rows if r["REFERENCED_CONSTRAINT"]})
    named = F.col("PK_CONSTRAINT_NAME").isin(wanted) | F.col("UK_CONSTRAINT_NAME").isin(wanted)
    parents: dict[str, tuple[tuple[str, str], tuple[str, ...]]] = {}
    others = extract.filter(named).collect() if wanted else []
    for field in ("UK_CONSTRAINT_NAME", "PK_CONSTRAINT_NAME"):
        for name, columns in _columns_by(others, field).items():
            home = next((r["OWNER"], r["TABLE_NAME"]) for r in others if r[field] == name)
            parents[name] = (home, columns)
    references = {}
    for name, columns in _columns_by(rows, "FK_CONSTRAINT_NAME").items():
        target = next(r["REFERENCED_CONSTRAINT"] for r in rows if r["FK_CONSTRAINT_NAME"] == name)
        if target not in parents:
            raise ValueError(f"{name} refers to {target}, which the extract does not hold")
        references[name] = Reference(columns, *parents[target])
    checks = {r["CK_CONSTRAINT_NAME"]: r["SEARCH_CONDITION"] for r in rows if r["CK_CONSTRAINT_NAME"]}
    return TableRules(spec, _columns_by(rows, "UK_CONSTRAINT_NAME"), references, checks)


def catalog_report(rules: TableRules, tables: Mapping[tuple[str, str], DataFrame], name: tuple[str, str]) -> DataFrame:
    """The migration report of a table's data under the rules of its catalog."""
    parents = {
        key: (tables[ref.parent], dict(zip(ref.columns, ref.parent_columns, strict=True)))
        for key, ref in rules.references.items()
    }
    unique = {key: list(columns) for key, columns in rules.unique.items()}
    return migration_report(tables[name], rules.spec, unique, parents, rules.checks)
