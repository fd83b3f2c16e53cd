"""Land, transform and export the fixtures, in both layer formats."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

import pytest
from fixtures import DATE, SOURCES, publish, write
from pyspark.sql import functions as F

from epilake.layout import Batch, LakeLayout
from epilake.plans.jobs import LOADS, JobError, Written, export, run_all, run_daily, run_monthly
from epilake.plans.landing import LandingError, land
from epilake.sinks.files import read_curated, write_batch, write_curated
from epilake.sinks.jdbc import JdbcTarget, count_table, read_table
from epilake.sinks.pointers import write_pointer
from epilake.sources.catalog import CATALOG_SCHEMA, read_catalog
from epilake.sources.control import latest_batches
from epilake.sources.dialect import CsvDialect
from epilake.sources.registry import BEDS, CASES, REGISTRY, VACCINES, DatasetSpec, read_batch, read_landed

RUN_DATE = dt.date(2022, 11, 3)
DAY_SCHEMA = "nome_munic string, codigo_ibge string, casos_novos string"
DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def memory_database() -> JdbcTarget:
    """A database inside this JVM; it opens no port."""
    return JdbcTarget(
        f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", {"driver": DERBY}, connections=2
    )


@pytest.fixture(scope="module", params=["parquet", "csv"])
def lake(spark, tmp_path_factory, request):
    root = tmp_path_factory.mktemp("lake")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated", request.param, request.param)
    catalog = read_catalog(spark, publish(root))
    landed = land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    assert {batch.dataset for batch in landed} == {source[0] for source in SOURCES}
    return layout


@pytest.fixture(scope="module")
def curated(spark, lake):
    written = run_daily(spark, lake) + run_monthly(spark, lake, RUN_DATE)

    def output(name: str):
        return [tuple(row) for row in read_curated(spark, lake, name, DATE).collect()]

    output.written = {entry.output: entry for entry in written}
    return output


def test_landing_writes_batch_and_pointer(spark, lake):
    batch = latest_batches(spark, lake, [CASES.name])[CASES.name]
    assert batch == Batch(CASES.name, DATE, "run-1")
    rows = read_batch(spark, lake, CASES, batch)
    assert dict(rows.dtypes)["casos_novos"] == "bigint"
    assert dict(rows.dtypes)["datahora"] == "string"  # unlisted columns pass as text
    assert rows.count() == 8


def test_clean_cases_drop_placeholder_and_null(curated):
    names = {row[0] for row in curated("clean_casos_obitos")}
    assert names == {"Águas", "Zeta", "abc"}
    assert len(curated("clean_casos_obitos")) == 6


def test_city_codes_in_byte_order(curated):
    assert curated("cidades_codigo") == [("Zeta", 3500204), ("abc", 3500303), ("Águas", 3500105)]


def test_days_without_cases(curated):
    assert curated("sem_casos_novos") == [("Águas", 2), ("Zeta", 1)]


def test_latest_beds(curated):
    rows = {drs: (day, beds) for day, drs, beds in curated("last_date_leitos")}
    assert {drs: str(day) for drs, (day, _) in rows.items()} == {
        "DRS 1": "2022-11-03",
        "DRS 2": "2022-11-02",
        "DRS 3": "None",
    }
    assert int(rows["DRS 1"][1]) == 30  # the tie goes to the greater remaining column
    assert curated.written["last_date_leitos"].rejected == 1


def test_applied_doses(spark, lake, curated):
    frame = read_curated(spark, lake, "aplicacao_doses", DATE)
    assert frame.columns == [
        "Cidade",
        "Rank_em_relacao_populacao_geral",
        "Dose_1",
        "Populacao_senso_2020",
        "Porcentagem_aplicação_Dose_1",
    ]
    assert sorted(curated("aplicacao_doses")) == [
        ("Zeta", 2, 90, 300, "1.234,56"),
        ("Águas", 1, 100, 200, "3,5"),
    ]


def test_vaccine_statistics(spark, lake, curated):
    frame = read_curated(spark, lake, "estaticas_gerais_clean", DATE)
    assert frame.columns == [
        "VACINA",
        "DOSE_1",
        "DOSE_2",
        "Dose_Unica",
        "DOSE_ADICIONAL_1",
        "DOSE_REFORCO_2",
        "DOSE_REFORCO_3",
        "DOSE_REFORCO_4",
        "REFORCO_FORA_DO_ESQUEMA_VACINAL",
    ]
    assert curated("estaticas_gerais_clean") == [("CORONAVAC", 1, 2, 3, 4, 5, 6, 7, 8)]


def test_known_conditions(spark, lake, curated):
    frame = read_curated(spark, lake, "clean_microdados", DATE)
    kept = {int(row["id"]): str(row["condition"]).lower() for row in frame.collect()}
    assert kept == {2: "true", 3: "true", 4: "true"}


def test_professional_cases_sorted(spark, lake, curated):
    frame = read_curated(spark, lake, "profissionais_casos_confirmados", DATE)
    assert frame.columns == ["Ocupação", "casos_confirmados_COVID-19"]
    assert curated("profissionais_casos_confirmados") == [
        ("Técnico", 50),
        ("Enfermeiro", 5),
        ("Auxiliar", 5),
        ("Médico", None),
    ]


def test_indigenous_cases_stamped(curated):
    assert sorted(curated("etnias_indigenas"), key=str) == [
        ("Zeta", None, RUN_DATE),
        ("Águas", 3, RUN_DATE),
        ("Águas", 3, RUN_DATE),
    ]


def test_outcomes(curated):
    assert curated("total_obitos") == [
        ("Zeta", "DRS 2", 80, None, "M", "CONFIRMADO", 1),
        ("Águas", "DRS 1", 70, "BRANCA", "F", "CONFIRMADO", 2),
    ]
    assert curated("total_curados") == [
        ("Águas", "DRS 1", 70, "BRANCA", "F", "CONFIRMADO", 1),
        ("Zeta", "DRS 2", 9, "PARDA", "M", "CONFIRMADO", 1),
    ]


def test_test_scoreboard(curated):
    rows = sorted(curated("total_testes"), key=lambda row: row[2])
    assert rows == [
        (RUN_DATE, "RT-PCR", 10),
        (None, "RT-PCR", 11),
        (None, "RT-PCR", 12),
        (None, "RT-PCR", 13),
    ]
    assert curated.written["total_testes"].rejected == 2


def test_export_twice_loads_once(spark, lake, curated):
    target = memory_database()
    for _ in range(2):
        tables = export(spark, lake, target, DATE)
    assert len(tables) == 12
    counts = {table: count_table(spark, target, table) for table in tables}
    assert counts["tb_raca_cor"] == 6
    assert counts["tb_etnias_indigenas"] == 3
    assert counts["tb_total_curados"] == 2
    assert counts["tb_clean_microdados"] == 3
    codes = read_table(spark, target, "tb_cidades_codigo")
    assert {tuple(row) for row in codes.collect()} == {
        ("Zeta", 3500204),
        ("abc", 3500303),
        ("Águas", 3500105),
    }


def test_transform_then_load(spark, lake):
    target = memory_database()
    assert len(run_all(spark, lake, target)) == 12
    assert count_table(spark, target, "tb_total_obitos") == 2


def test_rerun_of_one_date_leaves_others(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    catalog = read_catalog(spark, publish(tmp_path))
    land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    run_daily(spark, layout)

    # The next day brings no zero day at all, and is run twice.
    later = Batch(CASES.name, "20221104", "run-2")
    day = spark.createDataFrame([("Zeta", "1", "5")], DAY_SCHEMA)
    write_batch(day, layout, later)
    write_pointer(spark, layout, later)
    for _ in range(2):
        run_daily(spark, layout)
    assert read_curated(spark, layout, "sem_casos_novos", "20221104").count() == 0
    assert read_curated(spark, layout, "clean_casos_obitos", "20221104").count() == 1
    assert read_curated(spark, layout, "sem_casos_novos", DATE).count() == 2
    every = read_curated(spark, layout, "clean_casos_obitos")
    later = every.filter("process_date = '20221104'")
    assert every.count() == 7 and later.count() == 1
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(process_date" in plan


def test_rerun_with_empty_result_clears_the_date(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    land(spark, layout, read_catalog(spark, publish(tmp_path)), "diaria", RUN_DATE, "run-1")
    run_daily(spark, layout)
    again = Batch(CASES.name, DATE, "run-2")
    day = spark.createDataFrame([("Zeta", "1", "5")], DAY_SCHEMA)
    write_batch(day, layout, again)
    write_pointer(spark, layout, again)
    run_daily(spark, layout)
    assert read_curated(spark, layout, "sem_casos_novos", DATE).count() == 0


def test_failed_dataset_keeps_its_pointer_and_spares_the_others(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    catalog = read_catalog(spark, publish(tmp_path))
    land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    (tmp_path / f"site/2022/11/{DATE}_leitos.csv").unlink()
    with pytest.raises(LandingError, match="failed 1: leitos_interna") as raised:
        land(spark, layout, catalog, "diaria", RUN_DATE, "run-2")
    assert len(raised.value.landed) == len(SOURCES) - 1
    batches = latest_batches(spark, layout, list(REGISTRY))
    assert {name for name, batch in batches.items() if batch.uuid == "run-1"} == {
        "leitos_internações_por_diretoria_regionaldesaude"
    }


def test_datasets_can_be_run_alone_and_may_be_empty(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    batch = Batch(BEDS.name, DATE, "run-1")
    write_batch(spark.createDataFrame([], "datahora string, nome_drs string"), layout, batch)
    write_pointer(spark, layout, batch)
    assert run_daily(spark, layout, [BEDS]) == [Written("last_date_leitos", DATE, 0)]
    assert read_curated(spark, layout, "last_date_leitos", DATE).dtypes == [
        ("datahora", "date"),
        ("nome_drs", "string"),
    ]
    [load] = [load for load in LOADS if load.spec is BEDS]
    target = memory_database()
    assert export(spark, layout, target, loads=[load]) == ["tb_last_date_leitos"]
    assert count_table(spark, target, "tb_last_date_leitos") == 0


def test_more_columns_can_be_typed(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    batch = Batch(CASES.name, DATE, "run-1")
    day = spark.createDataFrame([("Zeta", "1", "0", "7")], DAY_SCHEMA + ", pop string")
    write_batch(day, layout, batch)
    write_pointer(spark, layout, batch)
    wider = replace(CASES, columns={**CASES.columns, "pop": "bigint"})
    run_daily(spark, layout, [wider])
    clean = read_curated(spark, layout, "clean_casos_obitos", DATE)
    assert dict(clean.dtypes)["pop"] == "bigint"
    assert [tuple(row) for row in clean.collect()] == [("Zeta", 1, 0, 7)]


def test_views_for_sql_users(spark, curated):
    assert spark.sql("SELECT count(*) FROM clean_table").head()[0] == 6
    assert spark.sql("SELECT count(*) FROM `table` WHERE obito").head()[0] == 3


def test_reads_raw_files_that_others_landed(spark, tmp_path):
    """A plain file and a quoted one-line pointer, as an importer leaves them."""
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated", "csv", raw_dialect=CsvDialect())
    batch = Batch(CASES.name, DATE, "933dc255")
    write(tmp_path / f"raw/{CASES.name}/Control_file_{CASES.name}.txt", f'"{DATE}"|"933dc255"\n')
    write(tmp_path / f"raw/{CASES.name}/{DATE}/933dc255/{CASES.name}.csv", SOURCES[0][3])
    assert latest_batches(spark, layout, [CASES.name]) == {CASES.name: batch}
    assert read_batch(spark, layout, CASES, batch).count() == 8


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_failed_rerun_leaves_the_date_as_it_was(spark, tmp_path, fmt):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated", fmt, fmt)
    rows = spark.range(5).select("id", F.lit("a").alias("v"))
    write_curated(rows, layout, "saida", DATE)
    failing = rows.withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        write_curated(failing, layout, "saida", DATE)
    assert {row["v"] for row in read_curated(spark, layout, "saida", DATE).collect()} == {"a"}
    write_curated(rows.limit(0), layout, "saida", DATE)
    cleared = read_curated(spark, layout, "saida", DATE)
    assert cleared.count() == 0 and cleared.dtypes == [("id", "bigint"), ("v", "string")]
    write_curated(rows, layout, "saida", DATE)
    assert read_curated(spark, layout, "saida", DATE).count() == 5


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_all_dates_are_lined_up(spark, tmp_path, fmt):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated", fmt, fmt)
    write_curated(spark.sql("SELECT 1 AS a, 2 AS b, 'x' AS c"), layout, "saida", "20221103")
    write_curated(spark.sql("SELECT 'k' AS a, 2.5D AS b, 'y' AS c, DATE '2022-11-03' AS d"), layout, "saida", "20221104")
    write_curated(spark.sql("SELECT 5 AS a, 6 AS b, 'z' AS c"), layout, "saida", "20221105")
    rows = read_curated(spark, layout, "saida")
    assert dict(rows.dtypes) == {"a": "string", "b": "double", "c": "string", "d": "date", "process_date": "string"}
    found = {(r["a"], r["b"], r["c"], r["d"], r["process_date"]) for r in rows.collect()}
    assert found == {
        ("1", 2.0, "x", None, "20221103"),
        ("k", 2.5, "y", RUN_DATE, "20221104"),
        ("5", 6.0, "z", None, "20221105"),
    }


def test_values_that_do_not_fit_are_counted_and_kept(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    batch = Batch(CASES.name, DATE, "run-1")
    day = [("Zeta", "1", "0.0"), ("Zeta", "2", "muitos"), ("Alfa", "x", "1.234"), ("Beta", None, None)]
    write_batch(spark.createDataFrame(day, DAY_SCHEMA), layout, batch)
    write_pointer(spark, layout, batch)
    first, *others = run_daily(spark, layout, [CASES])
    assert first.unfit == {"codigo_ibge": 1, "casos_novos": 2}
    assert not any(entry.unfit for entry in others)
    kept = read_curated(spark, layout, f"rejeitados_{CASES.name}", DATE)
    assert sorted(map(tuple, kept.collect())) == [("Alfa", "x", "1.234"), ("Zeta", "2", "muitos")]
    assert [tuple(r) for r in read_curated(spark, layout, "sem_casos_novos", DATE).collect()] == [("Zeta", 1)]


def test_malformed_records_are_landed_whole_and_counted(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    write(tmp_path / f"site/2022/11/{DATE}_a.csv", "k;v\n1;2;LOST\n3;4\n5\n")
    entry = (f"{tmp_path}/site/", "a", "d", "csv", "diaria")
    catalog = spark.createDataFrame([entry, entry], CATALOG_SCHEMA)
    [batch] = land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    assert batch.malformed == 2
    rows = {tuple(row) for row in read_landed(spark, layout, batch).collect()}
    assert rows == {("1", "2", "1;2;LOST"), ("3", "4", None), ("5", None, "5")}
    assert read_batch(spark, layout, DatasetSpec("d", {"k": "bigint"}), batch).columns == ["k", "v"]


def test_a_reused_run_id_does_not_touch_the_visible_batch(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    path = tmp_path / f"site/2022/11/{DATE}_a.csv"
    write(path, "k\n1\n")
    catalog = spark.createDataFrame([(f"{tmp_path}/site/", "a", "d", "csv", "diaria")], CATALOG_SCHEMA)
    land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    write(path, "k\n2\n")
    with pytest.raises(LandingError, match="is the current one already"):
        land(spark, layout, catalog, "diaria", RUN_DATE, "run-1")
    [batch] = latest_batches(spark, layout, ["d"]).values()
    assert [row["k"] for row in read_landed(spark, layout, batch).collect()] == ["1"]


def test_a_dataset_without_control_file_is_named_and_the_rest_runs(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated", "csv", raw_dialect=CsvDialect())
    for dataset, _, _, text in SOURCES[:3]:
        if dataset == "ranking_vacinação":
            lines, extra = text.splitlines(), SOURCES[3][3].splitlines()
            text = "\n".join(f"{a};{b}" for a, b in zip(lines, [extra[0], extra[1], extra[1]], strict=True)) + "\n"
        write(tmp_path / f"raw/{dataset}/Control_file_{dataset}.txt", f'"{DATE}"|"u"\n')
        write(tmp_path / f"raw/{dataset}/{DATE}/u/{dataset}.csv", text)
    with pytest.raises(JobError, match="failed 1: estatisticas_gerais") as raised:
        run_daily(spark, layout)
    assert {entry.output for entry in raised.value.written} == {
        "clean_casos_obitos", "cidades_codigo", "sem_casos_novos", "last_date_leitos", "aplicacao_doses",
    }
    written = run_daily(spark, layout, [VACCINES], sources={VACCINES.name: "ranking_vacinação"})
    assert [entry.output for entry in written] == ["estaticas_gerais_clean"]
    assert "VACINA" in read_curated(spark, layout, "estaticas_gerais_clean", DATE).columns


def test_columns_outside_the_registry_can_be_inferred(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    batch = Batch(CASES.name, DATE, "run-1")
    schema = DAY_SCHEMA + ", pop string, taxa string, dia string, hora string, grave string, nota string, vazia string"
    day = [
        ("Zeta", "1", "0", "7", "1.5", "2022-11-03", "2022-11-03T10:00:00", "true", "x1", None),
        ("Alfa", "2", "3", "3000000000", "2", None, "2022-11-03 11:00:00", "FALSE", "5", None),
    ]
    write_batch(spark.createDataFrame(day, schema), layout, batch)
    write_pointer(spark, layout, batch)
    run_daily(spark, layout, [CASES], infer=True)
    types = dict(read_curated(spark, layout, "clean_casos_obitos", DATE).dtypes)
    assert [types[n] for n in ("pop", "taxa", "dia", "hora", "grave", "nota", "vazia")] == [
        "bigint", "double", "date", "timestamp", "boolean", "string", "string",
    ]


def test_export_names_the_tables_it_could_not_fill(spark, tmp_path):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated")
    batch = Batch(CASES.name, DATE, "run-1")
    write_batch(spark.createDataFrame([("Zeta", "1", "0")], DAY_SCHEMA), layout, batch)
    write_pointer(spark, layout, batch)
    run_daily(spark, layout, [CASES])
    target = memory_database()
    with pytest.raises(JobError, match="failed 9") as raised:
        export(spark, layout, target)
    assert raised.value.written == ["tb_cidades_codigo", "tb_clean_casos_obitos", "tb_sem_casos_novos"]
    assert count_table(spark, target, "tb_sem_casos_novos") == 1
