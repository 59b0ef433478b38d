"""One tidy report of everything that would break when a table moves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import audits
from tidegate.operators.spec import TargetColumn


def migration_report(
    df: DataFrame,
    spec: Sequence[TargetColumn],
    unique: Mapping[str, Sequence[str]] | None = None,
    parents: Mapping[str, tuple[DataFrame, Mapping[str, str]]] | None = None,
    checks: Mapping[str, str] | None = None,
) -> DataFrame:
    """``check, subject, violations``: types, lengths, NOT NULL, conditions, keys and references.

    Everything about single rows is counted in one scan (per ``audits.COLUMNS_PER_SCAN`` entries);
    all keys and references are one more scan and one shuffle (``broken_keys``). For keys, violations are the
    rows under a broken key.
    """
    checks = checks or {}
    rows: list[dict[str, object]] = []

    def add(check: str, subject: str, broken) -> None:
        rows.append({"check": check, "subject": subject, "violations": F.count_if(broken)})

    for column in spec:
        value = audits.fit(df, column)
        add("type", column.name, value.misfit)
        add("rounding", column.name, value.rounded)
        if not column.nullable:
            add("not null", column.name, F.col(f"`{column.name}`").isNull())
    for column in audits.text_columns(df, spec):
        if column.length is not None:
            add("length", column.name, audits.too_long(column))
    for name, condition in checks.items():
        add("check", name, ~F.expr(condition))
    report = audits.count_tall(df, rows, "check string, subject string, violations long")

    keys = [c.name for c in spec if c.primary_key]
    rules = [Rule("primary key", ", ".join(keys), tuple(keys))] if keys else []
    rules += [Rule("unique", name, tuple(columns)) for name, columns in (unique or {}).items()]
    for name, (parent, pairs) in (parents or {}).items():
        rules.append(Rule("foreign key", name, tuple(pairs.keys()), parent, tuple(pairs.values())))
    return report.unionByName(broken_keys(df, rules)) if rules else report


@dataclass(frozen=True)
class Rule:
    """A key of a table, and for a foreign key the table that it refers to."""

    check: str
    subject: str
    columns: tuple[str, ...]
    parent: DataFrame | None = None
    parent_columns: tuple[str, ...] = ()


@dataclass
class _Key:
    """Columns that are counted once for all rules about them, in the types in which they meet their parents.

    ``cells`` are the columns of a stream that hold them. ``source`` is the larger key whose counts it is counted from.
    """

    columns: tuple[str, ...]
    types: tuple[T.DataType, ...]
    cells: tuple[str, ...]
    parents: list[tuple[DataFrame, tuple[str, ...]]] = field(default_factory=list)
    source: int | None = None

    def values(self) -> list[Column]:
        return [F.col(cell) for cell in self.cells]


@dataclass(frozen=True)
class _Side:
    """Rows of a stream: where ``only`` holds, a row with these values of ``key``, or with none."""

    number: int
    only: Column
    key: _Key | None = None
    values: Sequence[Column] = ()


# A parent is one bit of a bigint; further ones are met in a second count of the same columns.
PARENTS_PER_KEY = 62
# Types whose equal values have equal hashes.
HASHED = (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _key_types(df: DataFrame, rule: Rule) -> list[T.DataType]:
    """The types of a rule's columns: widened as in a union with the parent's, integers to bigint."""
    both = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rule.columns)])
    if rule.parent is not None:
        both = both.union(rule.parent.select(*[F.col(f"`{c}`") for c in rule.parent_columns]))
    return [T.LongType() if isinstance(f.dataType, T.IntegralType) else f.dataType for f in both.schema]


def _gather(df: DataFrame, rules: Sequence[Rule]) -> tuple[list[_Key], list[tuple[Rule, int, int]]]:
    """The keys of all rules, and every rule with its place among them and its parent's place there."""
    keys: list[_Key] = []
    placed = []
    shared: dict[tuple[T.DataType, int], str] = {}
    for rule in rules:
        types = _key_types(df, rule)
        # Integers come first, and of those the wider columns: they tell more keys apart than narrow ones.
        other = [not isinstance(t, T.LongType) for t in types]
        held = df.select(*[F.col(f"`{c}`") for c in rule.columns]).schema
        narrow = [not isinstance(f.dataType, T.LongType) for f in held]
        order = sorted(range(len(types)), key=lambda i: (other[i], narrow[i], rule.columns[i]))
        columns, kinds = tuple(rule.columns[i] for i in order), tuple(types[i] for i in order)
        same = (k for k, key in enumerate(keys) if (key.columns, key.types) == (columns, kinds))
        at = next((k for k in same if rule.parent is None or len(keys[k].parents) < PARENTS_PER_KEY), len(keys))
        if at == len(keys):
            first = ["lead"] if kinds and not other[order[0]] else []
            rest = kinds[len(first) :]
            places = [(kind, rest[:i].count(kind)) for i, kind in enumerate(rest)]
            cells = [shared.setdefault(place, f"c{len(shared)}") for place in places]
            keys.append(_Key(columns, kinds, (*first, *cells)))
        placed.append((rule, at, len(keys[at].parents)))
        if rule.parent is not None:
            keys[at].parents.append((rule.parent, tuple(rule.parent_columns[i] for i in order)))
    for key in keys:
        typed = set(zip(key.columns, key.types))
        larger = [k for k, other in enumerate(keys) if typed < set(zip(other.columns, other.types))]
        key.source = max(larger, key=lambda k: len(set(keys[k].columns)), default=None)
    return keys, placed


def _whole(values: Sequence[Column]) -> Column:
    return reduce(lambda found, value: found & value.isNotNull(), values, F.lit(True))


def _lead(key: _Key, values: Sequence[Column]) -> Column | None:
    """What a stream is grouped by first where that is no value of the key: a hash."""
    plain = all(isinstance(t, HASHED) or t == T.StringType() for t in key.types)
    return F.xxhash64(*values) if values and plain and "lead" not in key.cells else None


def _stream(df: DataFrame, sides: Sequence[_Side], cells: Sequence[str], rows: Column, parent: int = 0) -> DataFrame:
    """``lead``, the ``cells``, ``key``, ``rows`` and ``parents``: a row of ``df`` for each side that wants it.

    Cells of other keys are NULL.
    """
    numbers = [F.lit(side.number) for side in sides]
    each = df.withColumn("side", F.explode(F.array(*numbers)) if len(sides) > 1 else numbers[0])
    kept = F.lit(False)
    shown: dict[str, Column] = {}
    for side in sides:
        here = F.col("side") == side.number
        kept = kept | (here & side.only)
        if side.key is not None:
            held = dict(zip(side.key.cells, side.values, strict=True))
            lead = _lead(side.key, side.values)
            for cell, value in (held if lead is None else {"lead": lead, **held}).items():
                shown[cell] = F.when(here, value).otherwise(shown.get(cell, F.lit(None)))
    found = [shown.get(cell, F.lit(None)).alias(cell) for cell in ("lead", *cells)]
    long_parent = F.lit(parent).cast("long").alias("parents")
    return each.filter(kept).select(*found, F.col("side").alias("key"), rows.cast("long").alias("rows"), long_parent)


def _table_stream(
    df: DataFrame, sides: Sequence[tuple[int, _Key, Sequence[str], bool]], cells: Sequence[str], rows: int, parent: int = 0
) -> DataFrame:
    """The stream of the named columns of a table; the last field of a side keeps rows with a NULL in them."""
    needed = list(dict.fromkeys(c for _, _, columns, _ in sides for c in columns))
    lines = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(needed)])
    found = []
    for number, key, columns, nulls in sides:
        names = [f"v{needed.index(c)}" for c in columns]
        held = [(F.col(v), lines.schema[v].dataType, kind) for v, kind in zip(names, key.types)]
        values = [value if kind == wanted else value.cast(wanted) for value, kind, wanted in held]
        found.append(_Side(number, F.lit(True) if nulls else _whole(values), key, values))
    return _stream(lines, found, cells, F.lit(rows), parent)


def _counted(stream: DataFrame, keys: Mapping[int, _Key], cells: Sequence[str]) -> DataFrame:
    """Rows and parents of every key of ``stream``, which the parents' own streams join."""
    for number, key in keys.items():
        for bit, (parent, columns) in enumerate(key.parents):
            stream = stream.unionByName(_table_stream(parent, [(number, key, columns, False)], cells, 0, 1 << bit))
    found = [F.sum("rows").alias("rows")]
    if any(key.parents for key in keys.values()):
        found.append(F.bit_or("parents").alias("parents"))
    return stream.groupBy("lead", *cells, "key").agg(*found)


def _cells(keys: Mapping[int, _Key]) -> list[str]:
    return list(dict.fromkeys(cell for key in keys.values() for cell in key.cells if cell != "lead"))


def _broken(rule: Rule, key: _Key, bit: int) -> Column:
    """Whether a counted key breaks the rule."""
    whole = _whole(key.values())
    if rule.check == "primary key":
        return (F.col("rows") > 1) | ~whole
    if rule.parent is None:
        return (F.col("rows") > 1) & whole
    return (F.col("parents").bitwiseAND(F.lit(1 << bit)) == 0) & whole


def broken_keys(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``check, subject, violations`` of keys and references: the rows of ``df`` under a broken one.

    All rules are one stream of (key, value) rows, from one scan of ``df`` and one of every parent, counted per task
    before it is shuffled. Rules about the same columns are one key; a key whose columns are part of a larger key's is
    counted in a second step, from the larger key's counts, and keys share columns of the same type: so that a task
    has few and short rows to count. A primary key is broken by a NULL or a second row, a unique key by a second row,
    a foreign key by the lack of a parent row; child and parents meet as counts of one key. Types of both sides of a
    reference are widened as in a union.

    A task that has more keys than memory sorts them, by the first column that they are grouped by; so that one,
    ``lead``, differs from key to key: an integer of the key, or a hash.
    """
    keys, placed = _gather(df, sorted(rules, key=lambda r: r.check != "primary key"))
    outer = {k: key for k, key in enumerate(keys) if key.source is None}
    inner = {k: key for k, key in enumerate(keys) if key.source is not None}
    # Rows with a NULL in a key count for a primary key, and for the keys within it.
    nulls = {k for rule, k, _ in placed if rule.check == "primary key"}
    sides = [(k, key, key.columns, k in nulls or any(i.source == k for i in inner.values())) for k, key in outer.items()]
    counted = _counted(_table_stream(df, sides, _cells(outer), 1), outer, _cells(outer))
    lost = []
    if inner:
        steps = []
        for k, key in inner.items():
            values = dict(zip(keys[key.source].columns, keys[key.source].values()))
            values = [values[c] for c in key.columns]
            here = F.col("key") == key.source
            steps.append(_Side(k, here if k in nulls else here & _whole(values), key, values))
        for place, (rule, k, bit) in enumerate(placed):
            if k in outer:  # what breaks a rule here only needs to be summed up
                steps.append(_Side(-1 - place, (F.col("key") == k) & _broken(rule, keys[k], bit)))
        counted = _counted(_stream(counted, steps, _cells(inner), F.col("rows")), inner, _cells(inner))
    for place, (rule, k, bit) in enumerate(placed):
        if inner and k in outer:
            broken = F.col("key") == -1 - place
        else:
            broken = (F.col("key") == k) & _broken(rule, keys[k], bit)
        lost.append(F.coalesce(F.sum(F.when(broken, F.col("rows"))), F.lit(0)))
    found = [{"check": r.check, "subject": r.subject, "violations": n} for (r, *_), n in zip(placed, lost)]
    return audits.count_tall(counted, found, "check string, subject string, violations long")
