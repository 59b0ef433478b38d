"""Split reading of CSV, positions that do not depend on splits, and plans that read their input once or twice."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegate.operators import columns, layout
from tidegate.operators.spec import SourceColumn, resolve
from tidegate.plans import queries
from tidegate.plans import report as report_module
from tidegate.plans.ddl import ddl_lines, table_ddl
from tidegate.plans.report import Rule, broken_keys, migration_report
from tidegate.sinks import files
from tidegate.sources import catalog_csv
from tidegate.sources.catalog_csv import judged_files, quoted_records, read_catalog_csv, read_csv_text, well_formed_files

HEADER = "TABLE_NAME,COLUMN_NAME,COMMENTS"


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "400")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def scans(frame, what="FileScan"):
    return frame._jdf.queryExecution().executedPlan().toString().count(what)


def _comment(rng):
    word = "".join(rng.choice("ab é가") for _ in range(rng.randint(0, 8)))
    return rng.choice([word, f'"{word}"', f'"say ""{word}"", or"', f'"two\nlines {word}\n\n"', f'"a,{word}\n""\n"', '""'])


def _lines(seed, end="\n", count=300):
    rng = random.Random(seed)
    rows = [f"T{rng.randint(0, 5)},C{i},{_comment(rng)}" for i in range(count)]
    for _ in range(10):
        rows.insert(rng.randint(0, len(rows)), "")
    return "\n".join([HEADER, *rows, ""]).replace("\n", end)


def _shape(spark, path):
    judged = judged_files(spark, path).first()
    if judged["plain"]:
        return "plain"
    return "quoted" if well_formed_files(quoted_records(spark, path)).count() else "odd"


def _same_as_multi_line(spark, path, shape, encoding="UTF-8"):
    assert _shape(spark, path) == shape
    expected = sorted(tuple(r) for r in read_csv_text(spark, path, encoding).collect())
    got = read_catalog_csv(spark, path).select("table_name", "column_name", "column_comment").collect()
    assert sorted(tuple(r) for r in got) == [r for r in expected if r[0]]
    return expected


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_breaks_in_quotes_are_read_in_splits(spark, tmp_path, small_splits, seed, end):
    path = tmp_path / "a.csv"
    path.write_bytes(_lines(seed, end).encode())
    assert len(_same_as_multi_line(spark, str(path), "quoted")) == 300
    records = quoted_records(spark, str(path))
    assert records.select("block").distinct().count() > 5


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    long = "\n".join(f"line {i} of ""one"" text" for i in range(300))
    path.write_text(f'{HEADER}\nT,A,x\nT,B,"{long}"\nT,C,"{long}\n"\nT,D,z\n')
    _same_as_multi_line(spark, str(path), "quoted")


def test_plain_files_are_split(spark, tmp_path, small_splits):
    path = tmp_path / "plain.csv"
    text = "\n".join([HEADER, *[f'T{i % 3},"C, {i}","say ""{i}"""' for i in range(200)]])
    path.write_text(text)
    _same_as_multi_line(spark, str(path), "plain")
    assert read_csv_text(spark, str(path), multi_line=False).rdd.getNumPartitions() > 5
    assert read_csv_text(spark, str(path)).rdd.getNumPartitions() == 1


@pytest.mark.parametrize(
    "body",
    [
        'T,A,5" pipe\nT,B,"x\ny"\nT,C,z\n',  # a quote inside a field, and a break in another
        'T,A,"x" y\nT,B,"x\ny"\n',  # text after the closing quote
        'T,A,x\r\nT,B,"x\ny"\nT,C,z\n',  # two kinds of line ends
        '   \nT,A,"x\ny"\n',  # a blank line that is not empty
    ],
)
def test_odd_files_are_left_to_the_multi_line_reader(spark, tmp_path, body):
    path = tmp_path / "odd.csv"
    path.write_bytes(f"{HEADER}\n{body}".encode())
    shape = _shape(spark, str(path))
    expected = sorted(tuple(r) for r in read_csv_text(spark, str(path)).collect())
    got = read_catalog_csv(spark, str(path), split_bytes=0).select("table_name", "column_name", "column_comment").collect()
    assert sorted(tuple(r) for r in got) == [r for r in expected if r[0]] and shape in ("odd", "quoted")


def test_korean_breaks_and_several_files(spark, tmp_path, small_splits):
    folder = tmp_path / "in"
    folder.mkdir()
    body = "".join(f'고객,이름{i},"첫 줄\n""둘째"" 줄 {i}"\n' for i in range(60))
    (folder / "a.csv").write_bytes(f"{HEADER}\n{body}".encode("cp949"))
    (folder / "b.csv").write_text(f"{HEADER}\n{body.replace('고객', '샵')}")
    (folder / "c.csv").write_text(f"{HEADER}\n{body.replace('고객', '밖')}")
    rows = read_catalog_csv(spark, str(folder)).collect()
    assert len(rows) == 180 and {r.table_name for r in rows} == {"고객", "샵", "밖"}
    assert {r.column_comment for r in rows if r.column_name == "이름7"} == {'첫 줄\n"둘째" 줄 7'}
    (folder / "d.csv").write_text('TABLE_NAME,COLUMN_NAME,OTHER\nX,Y,"a\nb"\n')
    with pytest.raises(ValueError, match="header"):
        read_catalog_csv(spark, str(folder), split_bytes=0)


def test_positions_are_the_same_for_any_split(spark, tmp_path, small_splits):
    rng = random.Random(2)
    rows = [(f"T{rng.randint(0, 3)}", f"C{i}", rng.choice(["", " ", "x", str(rng.randint(1, 400))])) for i in range(400)]
    for quoted in (False, True):
        path = tmp_path / f"{quoted}.csv"
        tail = '"a\nb"' if quoted else "z"
        path.write_text("TABLE_NAME,COLUMN_NAME,COLUMN_ID,COMMENTS\n" + "".join(f"{','.join(r)},{tail}\n" for r in rows))
        small = {tuple(r) for r in read_catalog_csv(spark, str(path)).select("table_name", "column_name", "column_id").collect()}
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        whole = {tuple(r) for r in read_catalog_csv(spark, str(path)).select("table_name", "column_name", "column_id").collect()}
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        most, expected = {}, set()
        for t, _, place in rows:
            if place.strip().isdigit():
                most[t] = max(most.get(t, 0), int(place))
        for t, c, place in rows:
            if place.strip().isdigit():
                expected.add((t, c, int(place)))
            else:
                most[t] = most.get(t, 0) + 1
                expected.add((t, c, most[t]))
        assert small == whole == expected


def test_numbered_frames_refuse_gaps(spark):
    frame = spark.createDataFrame([("T", "A", "1"), ("T", "B", "")], "TABLE_NAME string, COLUMN_NAME string, COLUMN_ID string")
    with pytest.raises(Exception, match="no COLUMN_ID: T.B"):
        catalog_csv.catalog_records(frame, numbered=True).collect()
    assert {(r.column_name, r.column_id) for r in catalog_csv.catalog_records(frame).collect()} == {("A", 1), ("B", 2)}


# --- how often an input is read ------------------------------------------------------------------------


def _stored(spark, sf_dir, tmp_path):
    """A typed catalog that is one scan."""
    path = str(tmp_path / "typed")
    records = queries.samples.wide_catalog(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    columns.type_columns(records).write.parquet(path)
    return spark.read.parquet(path)


def test_definitions_read_their_input_once_or_twice(spark, sf_dir, tmp_path):
    typed = _stored(spark, sf_dir, tmp_path)
    assert scans(table_ddl(typed)) == 1
    lines = ddl_lines(typed)
    assert scans(lines) == 2
    rows = queries.files.merged_ddl(lines, columns.table_count(typed), datetime(2026, 1, 2))
    assert scans(rows) == 3  # one for the count of tables
    joined = {r.table_name: r.ddl for r in table_ddl(typed).collect()}
    ordered = sorted(lines.collect(), key=lambda r: (r.table_name, r.section, r.position, r.tie))
    for name, text in joined.items():
        assert "\n".join(r.line for r in ordered if r.table_name == name) == text


def test_csv_is_parsed_once(spark, sf_dir):
    plan = queries.csv_to_ddl(spark, sf_dir)
    text = plan._jdf.queryExecution().executedPlan().toString().lower()
    assert "filescan csv" not in text and "filescan text" not in text and "csv-stage" in text


def test_catalog_to_ddl_evaluates_the_extract_once(spark, sf_dir):
    one = scans(queries.QUERIES["extract_full"](spark, sf_dir))
    assert scans(queries.catalog_to_ddl(spark, sf_dir)) <= one


def test_report_reads_its_table_twice(spark, sf_dir):
    plan = queries.report(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert sum("l_orderkey" in line for line in plan.splitlines() if "FileScan" in line) == 2
    assert sum("o_orderkey" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_broken_keys_equal_single_audits(spark):
    rng = random.Random(4)

    def pick():
        return rng.choice([None, *range(12)])

    rows = [(pick(), pick(), rng.choice([None, "a", "b", "c"]), pick() if rng.random() < 0.5 else 3) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a int, b long, c string, d int").withColumn("e", F.col("d") * 1.0)
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (3, "a"), (None, "c")], "x long, y string")
    rules = [
        Rule("primary key", "a, b", ("a", "b")),
        Rule("unique", "c and d", ("c", "d")),
        Rule("unique", "e", ("e",)),
        Rule("foreign key", "one", ("a", "c"), parents, ("x", "y")),
        Rule("foreign key", "other", ("d",), parents, ("x",)),
        Rule("foreign key", "self", ("a",), frame, ("d",)),
        Rule("foreign key", "none", ("a",), parents.limit(0), ("x",)),
    ]
    from collections import Counter

    keys = Counter((a, b) for a, b, _, _ in rows)
    pairs = Counter((c, d) for _, _, c, d in rows if c is not None and d is not None)
    singles = Counter(d for *_, d in rows if d is not None)
    expected = {
        "a, b": sum(n for k, n in keys.items() if n > 1 or None in k),
        "c and d": sum(n for n in pairs.values() if n > 1),
        "e": sum(n for n in singles.values() if n > 1),
        "one": sum(1 for a, _, c, _ in rows if a is not None and c is not None and (a, c) not in {(1, "a"), (2, "b"), (3, "a")}),
        "other": sum(1 for *_, d in rows if d is not None and d not in (1, 2, 3)),
        "self": sum(1 for a, *_ in rows if a is not None and a not in singles),
        "none": sum(1 for a, *_ in rows if a is not None),
    }
    got = {r.subject: r.violations for r in broken_keys(frame, rules).collect()}
    assert got == expected
    assert {r.subject: r.violations for r in broken_keys(frame, rules[1:]).collect()} == {k: v for k, v in expected.items() if k != "a, b"}
    assert {r.violations for r in broken_keys(frame.limit(0), rules).collect()} == {0}


def test_report_counts_few_and_narrow_rows(spark, sf_dir):
    report = queries.report(spark, sf_dir)
    grouped = [line for line in report._jdf.queryExecution().executedPlan().toString().splitlines() if "HashAggregate(keys=[lead" in line]
    # Two keys in a first step, and two within them in a second one: a count before and after either shuffle.
    assert len(grouped) == 4
    widths = [len(line.split("keys=[")[1].split("]")[0].split(", ")) for line in grouped]
    assert sorted(widths) == [2, 2, 3, 3]


def test_keys_within_keys(spark):
    """Keys of other types, columns in other orders and NULLs are counted as by the single audits."""
    from collections import Counter

    rng = random.Random(7)

    def pick(n):
        return rng.choice([None, *range(n)])

    rows = [(pick(5), pick(4), rng.choice([None, "x", "y"]), rng.choice([None, 0.0, -0.0, 1.5])) for _ in range(200)]
    rows += [(100 + n, 1, "x", 2.0) for n in range(5)] + [(None, 2, None, 1.5)] * 3
    frame = spark.createDataFrame(rows, "a long, b int, c string, d double")
    pairs = spark.createDataFrame([(1, 2), (3, 0), (None, 1)], "b int, a short")
    names = spark.createDataFrame([("x",), (None,)], "n string")
    numbers = spark.createDataFrame([(1.0,), (2.5,)], "f double")
    rules = [
        Rule("unique", "d c a", ("d", "c", "a")),
        Rule("foreign key", "b a", ("b", "a"), pairs, ("b", "a")),
        Rule("foreign key", "a b", ("a", "b"), pairs.filter("b = 3"), ("a", "b")),
        Rule("unique", "a", ("a",)),
        Rule("unique", "c", ("c",)),
        Rule("foreign key", "c", ("c",), names, ("n",)),
        Rule("foreign key", "a as double", ("a",), numbers, ("f",)),
        Rule("unique", "d", ("d",)),
    ]

    def twice(*places):
        found = Counter(tuple(r[p] for p in places) for r in rows if None not in [r[p] for p in places])
        return sum(n for n in found.values() if n > 1)

    def lost(known, *places):
        cells = [tuple(r[p] for p in places) for r in rows]
        return sum(1 for c in cells if None not in c and c not in known)

    expected = {
        "d c a": twice(3, 2, 0), "b a": lost({(1, 2), (3, 0)}, 1, 0), "a b": lost({(0, 3)}, 0, 1), "a": twice(0),
        "c": twice(2), "a as double": lost({(1,)}, 0), "d": twice(3),
    }
    for places in ((), (1, 2, 0), (0,)):  # without a primary key, around other keys, and within one
        every = Counter(tuple(r[p] for p in places) for r in rows)
        primary = sum(n for k, n in every.items() if n > 1 or None in k)
        extra = [Rule("primary key", "pk", tuple("abCd"[p] for p in places))] if places else []
        got = [(r.check, r.subject, r.violations) for r in broken_keys(frame, [*rules, *extra]).collect()]
        assert len(got) == len(rules) + len(extra)
        single = {s: v for check, s, v in got if (check, s) != ("foreign key", "c")}
        assert single == expected | ({"pk": primary} if extra else {})
        assert ("foreign key", "c", lost({("x",)}, 2)) in got


def test_many_parents_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(report_module, "PARENTS_PER_KEY", 2)
    frame = spark.createDataFrame([(n % 4, n) for n in range(20)], "a int, b int")
    rules = [Rule("foreign key", str(n), ("a",), spark.createDataFrame([(n,)], "x int"), ("x",)) for n in range(5)]
    got = {r.subject: r.violations for r in broken_keys(frame, [*rules, Rule("primary key", "a, b", ("a", "b"))]).collect()}
    assert got == {"0": 15, "1": 15, "2": 15, "3": 15, "4": 20, "a, b": 0}


def test_report_without_keys(spark):
    frame = spark.createDataFrame([(1,), (None,)], "a int")
    report = migration_report(frame, resolve([SourceColumn("a", "NUMBER", "5", "0", nullable="N")])).collect()
    assert {(r.check, r.violations) for r in report} == {("type", 0), ("rounding", 0), ("not null", 1)}


# --- expiry of stored tables ----------------------------------------------------------------------------


def test_expired_days_go_without_a_scan(spark, tmp_path):
    days = [date(2024, 1, d) for d in range(1, 11)]
    rows = [(i, datetime(d.year, d.month, d.day, 12)) for i, d in enumerate(days)] + [(99, None)]
    frame = layout.with_day(spark.createDataFrame(rows, "id int, ts timestamp_ntz"), "ts")
    for name, path in (("expiring_inside", None), ("expiring_outside", str(tmp_path / "table"))):
        layout.save_table(frame, name, partition_by=["day"], path=path)
        assert layout.partition_days(spark, name) == days
        # Old files that cannot be read do not matter: nothing opens them.
        location = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Location")
        root = __import__("pathlib").Path(location.removeprefix("file:"))
        for file in (root / "day=2024-01-02").iterdir():
            file.write_bytes(b"damaged")
        assert layout.drop_expired(spark, name, date(2024, 1, 11), 5) == days[:5]
        assert layout.partition_days(spark, name) == days[5:]
        assert sorted(p.name for p in root.iterdir() if p.is_dir()) == [
            *[f"day={d}" for d in days[5:]], "day=__HIVE_DEFAULT_PARTITION__",
        ]
        assert sorted(r.id for r in spark.table(name).collect()) == [5, 6, 7, 8, 9, 99]
        assert layout.drop_expired(spark, name, date(2024, 1, 11), 5) == []
        spark.sql(f"DROP TABLE {name}")


def test_folders_left_by_a_lost_driver_go_too(spark, tmp_path):
    frame = layout.with_day(spark.createDataFrame([(1, datetime(2024, 1, d)) for d in (1, 2)], "id int, ts timestamp_ntz"), "ts")
    layout.save_table(frame, "expiring_lost", partition_by=["day"], path=str(tmp_path / "table"))
    spark.sql("ALTER TABLE expiring_lost DROP PARTITION (day = DATE '2024-01-01')")
    assert (tmp_path / "table" / "day=2024-01-01").exists()
    assert layout.drop_expired(spark, "expiring_lost", date(2024, 1, 3), 1) == [date(2024, 1, 1)]
    assert not (tmp_path / "table" / "day=2024-01-01").exists()
    spark.sql("DROP TABLE expiring_lost")


def test_written_csv_is_read_back_with_breaks(spark, tmp_path):
    values = [("T", f"C{i}", f'a "{i}"\n\nb, c') for i in range(50)]
    frame = spark.createDataFrame(values, "TABLE_NAME string, COLUMN_NAME string, COMMENTS string").repartition(3)
    files.write_catalog_csv(frame, str(tmp_path / "out"))
    rows = read_catalog_csv(spark, str(tmp_path / "out")).collect()
    assert sorted((r.table_name, r.column_name, r.column_comment) for r in rows) == sorted(values)
