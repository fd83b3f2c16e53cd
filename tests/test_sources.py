"""Dialects, control files, catalogue, archives."""

from __future__ import annotations

import datetime as dt
import json
import tempfile

import pytest
from fixtures import CASES, DATE, rows, write, zip_file
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epilake.layout import Batch, LakeLayout
from epilake.session import scratch_path
from epilake.sinks.files import write_rows
from epilake.sinks.pointers import write_pointer
from epilake.sources.archive import ArchiveStore, archive_members, inflate, read_zipped_delimited
from epilake.sources.catalog import CATALOG_SCHEMA_PERIODS, landing_plan, read_catalog
from epilake.sources.control import ControlFileError, latest_batches, read_control_files
from epilake.sources.delimited import discover_schema, read_delimited
from epilake.sources.dialect import STAGED, CsvDialect

CASES_ROWS = [line.split(";") for line in CASES.splitlines()[1:]]


def texts(df):
    return sorted([value or "" for value in row] for row in df.collect())


@pytest.mark.parametrize(
    ("dialect", "convert"),
    [
        (CsvDialect(), lambda text: text),
        (CsvDialect(encoding="ISO-8859-1"), lambda text: text),
        (CsvDialect(sep=",", quote_all=True), lambda text: _quoted(text)),
        (CsvDialect(line_sep="\r\n"), lambda text: text.replace("\n", "\r\n")),
        (CsvDialect(sep="\t"), lambda text: text.replace(";", "\t")),
    ],
    ids=["plain", "latin-1", "quoted commas", "crlf", "tabs"],
)
def test_dialects_give_the_same_rows(spark, tmp_path, dialect, convert):
    path = write(tmp_path / "casos.csv", convert(CASES), dialect.encoding)
    frame = read_delimited(spark, path, dialect)
    assert frame.columns == CASES.splitlines()[0].split(";")
    assert texts(frame) == sorted(CASES_ROWS)
    zipped = zip_file(tmp_path / "casos.zip", {"a/casos.csv": convert(CASES).encode(dialect.encoding)})
    assert texts(read_zipped_delimited(spark, zipped, dialect)) == sorted(CASES_ROWS)


def _quoted(text):
    return rows(*(",".join(f'"{v}"' for v in line.split(";")) for line in text.splitlines()))


def test_line_quoted_whole_is_one_column_of_its_own_dialect(spark, tmp_path):
    path = write(tmp_path / "q.csv", rows('"a;b"', '"1;2"'))
    assert read_delimited(spark, path, CsvDialect(sep=",")).columns == ["a;b"]


def test_part_without_header_is_rejected(spark, tmp_path):
    write(tmp_path / "d/part-0.csv", rows("a;b", "1;2"))
    write(tmp_path / "d/part-1.csv", rows("3;4", "5;6"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, str(tmp_path / "d"), CsvDialect()).collect()


def test_header_with_blank_names_needs_a_lenient_dialect(spark, tmp_path):
    path = write(tmp_path / "d.csv", rows("Data;Total de casos;;", "2022-11-03;1;;"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, path, CsvDialect()).collect()
    frame = read_delimited(spark, path, CsvDialect(strict_header=False))
    assert frame.columns[:2] == ["Data", "Total de casos"] and len(frame.collect()) == 1


def test_corrupt_records_are_kept_aside(spark, tmp_path):
    path = write(tmp_path / "d.csv", rows("a;b", "1;2", "1;2;3", "1"))
    frame = read_delimited(spark, path, CsvDialect(), corrupt_column="_corrupt")
    found = {row["_corrupt"] for row in frame.collect()}
    assert found == {None, "1;2;3", "1"}


def test_discovered_types(spark, tmp_path):
    path = write(tmp_path / "d.csv", rows("a;b;c;d", "2022-11-03;03/11/2022;1,5;FALSE"))
    types = dict(
        (field.name, field.dataType.simpleString())
        for field in discover_schema(spark, path, CsvDialect())
    )
    assert types == {"a": "date", "b": "string", "c": "string", "d": "boolean"}


value = st.text(
    st.characters(codec="utf-8", exclude_characters="\r\n\0", exclude_categories=["Cs"]), max_size=12
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(value, value), min_size=1, max_size=30))
def test_staged_text_survives(spark, pairs):
    path = scratch_path(spark, "staged")
    frame = spark.createDataFrame(pairs, "a string, `b ` string")
    write_rows(frame, path, "csv", STAGED)
    back = read_delimited(spark, path, STAGED)
    assert back.columns == ["a", "b "]
    assert texts(back) == sorted([a, b] for a, b in pairs)


def layout_at(path) -> LakeLayout:
    return LakeLayout(f"{path}/raw", f"{path}/curated")


def control(tmp_path, dataset, text):
    write(tmp_path / f"raw/{dataset}/Control_file_{dataset}.txt", text)


def test_control_files_in_one_scan(spark, tmp_path):
    layout = layout_at(tmp_path)
    control(tmp_path, "quoted", '"20221103"|"u-1"\n')
    control(tmp_path, "two_rows", "20221103|a\n20221104|b\n")
    control(tmp_path, "three_fields", "20221103|a|b\n")
    write_pointer(spark, layout, Batch("vacinação + 100%", DATE, "u-2"))
    names = ["quoted", "two_rows", "three_fields", "vacinação + 100%"]
    assert latest_batches(spark, layout, names) == {
        "quoted": Batch("quoted", "20221103", "u-1"),
        "two_rows": Batch("two_rows", "20221104", "b"),
        "three_fields": Batch("three_fields", "20221103", "a"),
        "vacinação + 100%": Batch("vacinação + 100%", DATE, "u-2"),
    }
    assert read_control_files(spark, layout, names).dtypes == [
        ("dataset", "string"),
        ("process_date", "string"),
        ("uuid", "string"),
        ("sequence", "bigint"),
        ("written", "timestamp"),
    ]


def test_pointer_moves(spark, tmp_path):
    layout = layout_at(tmp_path)
    for uuid in ("z", "a"):  # the later run wins, whatever its id
        write_pointer(spark, layout, Batch("d", DATE, uuid))
    assert latest_batches(spark, layout, ["d"])["d"].uuid == "a"
    parts = sorted((tmp_path / "raw/d/Control_file_d.txt").glob("*.csv"))
    assert [part.read_text() for part in parts] == [f'"{DATE}"|"z"\n', f'"{DATE}"|"a"\n']


def test_empty_control_file_names_the_dataset(spark, tmp_path):
    control(tmp_path, "vazio", "")
    control(tmp_path, "cheio", "20221103|a\n")
    with pytest.raises(ControlFileError, match="vazio"):
        latest_batches(spark, layout_at(tmp_path), ["vazio", "cheio"])


def test_missing_control_file_names_the_dataset(spark, tmp_path):
    with pytest.raises(Exception, match="Control_file_nenhum"):
        latest_batches(spark, layout_at(tmp_path), ["nenhum"])


def test_paths():
    layout = LakeLayout("abfss://raw@lake/", "s3a://curated", raw_format="csv")
    batch = Batch("d", DATE, "u")
    assert layout.batch_path(batch) == f"abfss://raw@lake/d/{DATE}/u/d.csv"
    assert layout.control_path("d") == "abfss://raw@lake/d/Control_file_d.txt"
    assert layout.curated_path("o", DATE) == f"s3a://curated/o/process_date={DATE}"
    with pytest.raises(ValueError, match="unknown layer format"):
        LakeLayout("a", "b", raw_format="txt")


def catalog_file(tmp_path, periods):
    items = [
        {"base": "b/", "source": "s1", "dataset": "d1", "type": "csv", "Atualizacao": periods[0]},
        {"base": "b/", "source": "s2", "dataset": "d2", "type": "zip", "Atualizacao": periods[0]},
        {"base": "b/", "source": "s3", "dataset": "d3", "type": "xls", "Atualizacao": periods[0]},
        {"base": "b/", "source": "s4", "dataset": "d4", "type": "csv", "Atualizacao": periods[1]},
    ]
    return write(tmp_path / "covidsource.json", json.dumps(items, indent=2))


@pytest.mark.parametrize("as_list", [False, True])
def test_landing_plan(spark, tmp_path, as_list):
    if as_list:
        path = catalog_file(tmp_path, (["diaria", "mensal"], ["mensal"]))
        catalog = read_catalog(spark, path, CATALOG_SCHEMA_PERIODS)
    else:
        catalog = read_catalog(spark, catalog_file(tmp_path, ("diaria e mensal", "mensal")))
    plan = landing_plan(catalog, "diaria", dt.date(2022, 1, 9), "run")
    assert sorted(tuple(row) for row in plan.collect()) == [
        ("d1", "csv", "b/2022/01/20220109_s1.csv", "20220109", "run"),
        ("d2", "zip", "b/s2.zip", "20220109", "run"),
    ]


def test_archives_in_a_tree(spark, tmp_path):
    zip_file(tmp_path / "z/one.zip", {"x/": "", "x/a.csv": rows("k;v", "1;a", "", "2;b")})
    zip_file(tmp_path / "z/deep/two.zip", {"b.csv": "\ufeff" + rows("k;v", '3;"c;c"'), "c.csv": "k;v"})
    members = archive_members(spark, str(tmp_path / "z"), recursive=True)
    lines = inflate(members, CsvDialect(), origin=True)
    name = F.substring_index("archive", "/", -1)
    assert set(map(tuple, lines.select(name, "member", "line_no", "line").collect())) == {
        ("one.zip", "a.csv", 0, "k;v"),
        ("one.zip", "a.csv", 1, "1;a"),
        ("one.zip", "a.csv", 2, ""),
        ("one.zip", "a.csv", 3, "2;b"),
        ("two.zip", "b.csv", 0, "k;v"),
        ("two.zip", "b.csv", 1, '3;"c;c"'),
        ("two.zip", "c.csv", 0, "k;v"),
    }
    paths = [str(tmp_path / "z/one.zip"), str(tmp_path / "z/deep/two.zip")]
    frame = read_zipped_delimited(spark, paths, CsvDialect())
    assert texts(frame) == [["1", "a"], ["2", "b"], ["3", "c;c"]]
    tree = read_zipped_delimited(spark, str(tmp_path / "z"), CsvDialect(), recursive=True, spread=3)
    assert texts(tree) == texts(frame)


def test_archive_members_with_another_header_are_rejected(spark, tmp_path):
    paths = [
        zip_file(tmp_path / "1.zip", {"a.csv": rows("k;v", "1;a")}),
        zip_file(tmp_path / "2.zip", {"a.csv": rows("v;k", "b;2")}),
    ]
    with pytest.raises(Exception, match="header of a.csv in"):
        read_zipped_delimited(spark, paths, CsvDialect()).collect()


def test_archive_without_text(spark, tmp_path):
    with pytest.raises(ValueError, match="no text"):
        read_zipped_delimited(spark, zip_file(tmp_path / "1.zip", {"a/": ""}), CsvDialect())


def test_archive_without_header(spark, tmp_path):
    path = zip_file(tmp_path / "1.zip", {"a.csv": rows("1;a", "2;b")})
    frame = read_zipped_delimited(spark, path, CsvDialect(header=False))
    assert frame.columns == ["_c0", "_c1"]
    assert texts(frame) == [["1", "a"], ["2", "b"]]


def test_long_member_is_streamed_in_batches(spark, tmp_path):
    count = 45_000
    path = zip_file(tmp_path / "1.zip", {"a.csv": rows("k", *map(str, range(count)))})
    frame = read_zipped_delimited(spark, path, CsvDialect())
    total = frame.agg(F.count("k"), F.sum(F.col("k").cast("bigint"))).head()
    assert tuple(total) == (count, count * (count - 1) // 2)


def test_members_are_inflated_by_tasks_of_their_own(spark, tmp_path):
    members = {f"{k}.csv": rows("k", *map(str, range(1000 * k, 1000 * k + 1000))) for k in range(40)}
    path = zip_file(tmp_path / "um ç 50%.zip", members)
    lines = inflate(archive_members(spark, path), CsvDialect(), "k").filter("line_no > 0")
    tasks = lines.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in tasks) == 40_000 and len(tasks) > 15
    assert sorted(int(row["line"]) for row in lines.collect()) == list(range(40_000))


def test_archive_paths_of_known_and_unknown_stores(spark):
    store = ArchiveStore({"region": "sa-east-1"})
    assert store.uri("s3a://lake/a b.zip") == "s3://lake/a%20b.zip?region=sa-east-1"
    assert store.uri("file:///x/a b.zip") == store.uri("/x/a b.zip") == "/x/a b.zip"
    with pytest.raises(ValueError, match="'wasbs' store"):
        archive_members(spark, "wasbs://raw@lake/a.zip")


DIALECTS = {
    "records": (CsvDialect(), rows("a;b", "1;2;LOST", "3;4", "5")),
    "other line ends": (CsvDialect(line_sep="|"), "a;b|1;2|3;4"),
    "carriage returns": (CsvDialect(), "a;b\r\n1;2\r3;4\r\n"),
    "quoted line breaks": (CsvDialect(multi_line=True), rows("a;b", '1;"x\ny;\\"z\n\n"', "2;c")),
    "blank names": (CsvDialect(strict_header=False), rows("a;;", "1;2;3")),
    "repeated names": (CsvDialect(strict_header=False), rows("a;b;A", "1;2;3")),
    "other order": (CsvDialect(strict_header=False), rows("b;a", "1;2")),
}


@pytest.mark.parametrize("case", DIALECTS)
def test_files_and_archives_read_alike(spark, tmp_path, case):
    dialect, text = DIALECTS[case]
    plain = read_delimited(spark, write(tmp_path / "a.csv", text), dialect, corrupt_column="_c")
    zipped = read_zipped_delimited(spark, zip_file(tmp_path / "a.zip", {"a.csv": text}), dialect, "_c")
    assert zipped.columns == plain.columns
    assert texts(zipped) == texts(plain)


def test_files_and_archives_replace_invalid_bytes(spark, tmp_path):
    data = b"a;b\n1;caf\xe9 x\n2;\xff\n"
    (tmp_path / "a.csv").write_bytes(data)
    plain = read_delimited(spark, str(tmp_path / "a.csv"), CsvDialect())
    zipped = read_zipped_delimited(spark, zip_file(tmp_path / "a.zip", {"a.csv": data}), CsvDialect())
    assert texts(zipped) == texts(plain) == [["1", "caf\ufffd x"], ["2", "\ufffd"]]


@pytest.mark.parametrize("header", ["a;;", "a;A"])
def test_strict_headers_fail_alike(spark, tmp_path, header):
    text = rows(header, "1;2;3")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, write(tmp_path / "a.csv", text), CsvDialect()).collect()
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_zipped_delimited(spark, zip_file(tmp_path / "a.zip", {"a.csv": text}), CsvDialect())


def test_scratch_path_follows_the_session(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir())
