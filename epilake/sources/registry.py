"""What each dataset must contain, and how its files are written.

A file may hold more columns than its entry lists. Those pass through every
job unchanged, as text; only listed columns are checked and typed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epilake.functions.columns import named, parse_date, parse_flag, parse_int
from epilake.layout import Batch, LakeLayout
from epilake.operators.rename import require_columns
from epilake.sources.delimited import MALFORMED, read_delimited
from epilake.sources.dialect import CsvDialect


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: Mapping[str, str]
    dialect: CsvDialect = field(default=CsvDialect())


# Dataset and column names are those of the published files.
CASES = DatasetSpec(
    "casos_e_obtos_por_municipio_e_data",
    {"nome_munic": "string", "codigo_ibge": "bigint", "casos_novos": "bigint"},
)
BEDS = DatasetSpec(
    "leitos_internações_por_diretoria_regionaldesaude",
    {"nome_drs": "string", "datahora": "string"},
)
RANKING = DatasetSpec(
    "ranking_vacinação",
    {
        "Municipio ": "string",
        "Rank of % em relação a população geral": "bigint",
        "PRIMEIRA DOSE": "bigint",
        "POPULAÇÃO MUNICÍPIO 2020": "bigint",
        "% em relação a população geral": "string",
    },
)
VACCINES = DatasetSpec(
    "estatisticas_gerais",
    {
        "Imunobiologico ": "string",
        "1º DOSE": "bigint",
        "2° DOSE": "bigint",
        "UNICA": "bigint",
        "1º DOSE ADICIONAL": "bigint",
        "2 REFORCO": "bigint",
        "3 REFORCO": "bigint",
        "4 REFORCO": "bigint",
        "REFORCO FORA DO ESQUEMA VACINAL": "bigint",
    },
)
CONDITIONS = (
    "asma",
    "cardiopatia",
    "doenca_hepatica",
    "doenca_neurologica",
    "doenca_renal",
    "imunodepressao",
    "obesidade",
    "outros_fatores_de_risco",
    "pneumopatia",
    "puerpera",
    "sindrome_de_Down",
    "diabetes",
    "doenca_hematologica",
)
MICRODATA = DatasetSpec("microdados_dos_casos", dict.fromkeys(CONDITIONS, "string"))
PROFESSIONALS = DatasetSpec(
    "casos_confirmados_covid19_ocupacao_profissional_de_saude",
    {"Número de casos confirmados COVID-19": "bigint"},
)
INDIGENOUS = DatasetSpec(
    "etnias_indigenas",
    {"Municipio": "string", "Número de casos confirmados": "bigint"},
)
INPATIENTS = DatasetSpec(
    "pacientes_internados_por_SRAG",
    {
        "nome_munic": "string",
        "nome_drs": "string",
        "idade": "bigint",
        "raca_cor": "string",
        "cs_sexo": "string",
        "diagnostico_covid19": "string",
        "obito": "boolean",
    },
)
TESTS = DatasetSpec(
    "placar_testes",
    {"Mês de Data coleta": "string", "Tipo teste": "string", "Qtde": "bigint"},
)

DAILY = (CASES, BEDS, RANKING, VACCINES)
MONTHLY = (MICRODATA, PROFESSIONALS, INDIGENOUS, INPATIENTS, TESTS)
REGISTRY = {spec.name: spec for spec in (*DAILY, *MONTHLY)}


def typed(name: str, source: str, target: str) -> Column:
    """A column cast without failing: text that does not fit gives NULL."""
    if target == "boolean":
        return parse_flag(named(name))
    if source == "string" and target in ("int", "bigint"):
        return parse_int(named(name), target)
    return named(name).try_cast(target)


def _changes(df: DataFrame, columns: Mapping[str, str]) -> dict[str, Column]:
    """The listed columns that do not have their type yet, with the cast of each."""
    require_columns(df, columns)
    types = {field.name.lower(): field.dataType.simpleString() for field in df.schema}
    return {
        name: typed(name, types[name.lower()], target)
        for name, target in columns.items()
        if types[name.lower()] != target
    }


def has_casts(df: DataFrame, columns: Mapping[str, str]) -> bool:
    """Whether ``apply_types`` has anything to cast."""
    return bool(_changes(df, columns))


def apply_types(
    df: DataFrame, columns: Mapping[str, str], unfit: Observation | None = None
) -> DataFrame:
    """Check that the listed columns are there and give them their types.

    ``unfit`` receives, by column, the number of values that did not fit and
    became NULL, as a by-product of whatever action runs the result.
    """
    changes = _changes(df, columns)
    if not changes:
        return df
    if unfit is None:
        return df.withColumns(changes)
    # Cast below the observation, so that both use the one result.
    names = {name: f"__typed_{position}" for position, name in enumerate(changes)}
    cast = df.withColumns({names[name]: value for name, value in changes.items()})
    lost = [F.count_if(named(n).isNotNull() & F.col(names[n]).isNull()).alias(n) for n in changes]
    observed = cast.observe(unfit, *lost)
    return observed.withColumns({name: F.col(names[name]) for name in changes}).drop(*names.values())


def unfit_rows(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The rows, as they were, in which a listed column holds what its type cannot."""
    lost = [named(name).isNotNull() & value.isNull() for name, value in _changes(df, columns).items()]
    return df.filter(reduce(lambda a, b: a | b, lost, F.lit(False)))


def _fits(text: Column) -> dict[str, Column]:
    """Whether a text can be a value of each type, in the order in which types are tried."""
    number = text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    time = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:")
    return {
        "bigint": text.rlike("^[+-]?[0-9]+$") & parse_int(text).isNotNull(),
        "double": number,
        "boolean": F.lower(text).isin("true", "false"),
        "date": parse_date(text, "yyyy-MM-dd").isNotNull(),
        "timestamp": time & text.try_cast("timestamp").isNotNull(),
    }


def inferred(df: DataFrame, spec: DatasetSpec) -> DatasetSpec:
    """The entry, with types for the text columns it does not list, if all their values suggest one.

    One pass over the rows, without gathering any. A column without values stays text.
    """
    listed = {name.lower() for name in spec.columns}
    open_ = [n for n, t in df.dtypes if t == "string" and n.lower() not in listed and n != MALFORMED]
    checks = []
    for position, name in enumerate(open_):
        checks.append(F.count(named(name)).alias(f"n{position}"))
        for kind, fits in _fits(named(name)).items():
            ok = named(name).isNull() | F.coalesce(fits, F.lit(False))
            checks.append(F.bool_and(ok).alias(f"{kind}{position}"))
    if not checks:
        return spec
    row = df.agg(*checks).head()
    found = {}
    for position, name in enumerate(open_):
        kinds = [kind for kind in _fits(named(name)) if row[f"{kind}{position}"]]
        if row[f"n{position}"] and kinds:
            found[name] = kinds[0]
    return replace(spec, columns={**spec.columns, **found})


def read_landed(spark: SparkSession, layout: LakeLayout, batch: Batch) -> DataFrame:
    """One landed batch as text, malformed records in ``MALFORMED`` if any were landed."""
    path = layout.batch_path(batch)
    if layout.raw_format == "parquet":
        return spark.read.parquet(path)
    return read_delimited(spark, path, layout.raw_dialect)


def read_batch(
    spark: SparkSession,
    layout: LakeLayout,
    spec: DatasetSpec,
    batch: Batch,
    unfit: Observation | None = None,
) -> DataFrame:
    """One landed batch with the types of its registry entry.

    Of a malformed record the fields that were there are kept; its whole text
    stays in the batch (``read_landed``).
    """
    return apply_types(read_landed(spark, layout, batch).drop(MALFORMED), spec.columns, unfit)
