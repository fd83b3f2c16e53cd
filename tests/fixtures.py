"""Tiny hand-made files with the published headers."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from epilake.sources.registry import CONDITIONS

DATE = "20221103"


def write(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(*lines: str) -> str:
    return "\n".join(lines) + "\n"


CASES = rows(
    "nome_munic;codigo_ibge;datahora;casos_novos",
    "Ignorado;9999999;2022-11-01;0",
    ";1;2022-11-01;0",
    "Águas;3500105;2022-11-01;0",
    "Águas;3500105;2022-11-02;0",
    "Águas;3500105;2022-11-03;4",
    "Zeta;3500204;2022-11-01;0",
    "Zeta;3500204;2022-11-02;",
    "abc;3500303;2022-11-01;7",
)
BEDS = rows(
    "datahora;nome_drs;leitos",
    "2022-11-01;DRS 1;10",
    "2022-11-03;DRS 1;30",
    "2022-11-03;DRS 1;20",
    "2022-11-02 10:00:00;DRS 2;5",
    "2022-11-01;DRS 2;4",
    "ontem;DRS 3;1",
    ";DRS 3;2",
)
RANKING = rows(
    "Municipio ;Rank of % em relação a população geral;PRIMEIRA DOSE;"
    "POPULAÇÃO MUNICÍPIO 2020;% em relação a população geral;Grand Total",
    "Águas;1;100;200;3,5;7",
    "Zeta;2;90;300;1.234,56;8",
)
VACCINES = rows(
    "Imunobiologico ;1º DOSE;2° DOSE;UNICA;1º DOSE ADICIONAL;2 REFORCO;3 REFORCO;4 REFORCO;"
    "REFORCO FORA DO ESQUEMA VACINAL",
    "CORONAVAC;1;2;3;4;5;6;7;8",
)
MICRODATA = rows(
    "id;" + ";".join(CONDITIONS),
    "1;" + ";".join(["IGNORADO"] * 13),
    "2;" + ";".join(["IGNORADO"] * 12 + [""]),
    "3;" + ";".join([""] * 13),
    "4;" + ";".join(["SIM"] + ["IGNORADO"] * 12),
)
PROFESSIONALS = rows(
    "Código CBO;Ocupação;Número de casos confirmados COVID-19",
    "1;Enfermeiro;5",
    "2;Médico;",
    "3;Técnico;50",
    "4;Auxiliar;5",
)
INDIGENOUS = rows(
    "Municipio;Número de casos confirmados",
    "Águas;3",
    "Águas;3",
    "Zeta;",
)
INPATIENTS = rows(
    "nome_munic;nome_drs;idade;raca_cor;cs_sexo;diagnostico_covid19;obito",
    "Águas;DRS 1;70;BRANCA;F;CONFIRMADO;true",
    "Águas;DRS 1;70;BRANCA;F;CONFIRMADO;1",
    "Águas;DRS 1;70;BRANCA;F;CONFIRMADO;FALSE",
    "Zeta;DRS 2;80;;M;CONFIRMADO;True",
    "Zeta;DRS 2;80;;M;CONFIRMADO;",
    "Zeta;DRS 2;9;PARDA;M;CONFIRMADO;0",
)
TESTS = rows(
    "Mês de Data coleta;Tipo teste;Qtde",
    "03/11/2022;RT-PCR;10",
    "3/11/2022;RT-PCR;11",
    "sem data;RT-PCR;12",
    ";RT-PCR;13",
)

# dataset, source, type, text
SOURCES = [
    ("casos_e_obtos_por_municipio_e_data", "casos", "csv", CASES),
    ("leitos_internações_por_diretoria_regionaldesaude", "leitos", "csv", BEDS),
    ("ranking_vacinação", "ranking", "csv", RANKING),
    ("estatisticas_gerais", "estatisticas", "csv", VACCINES),
    ("microdados_dos_casos", "microdados", "zip", MICRODATA),
    ("casos_confirmados_covid19_ocupacao_profissional_de_saude", "prof", "csv", PROFESSIONALS),
    ("etnias_indigenas", "etnias", "csv", INDIGENOUS),
    ("pacientes_internados_por_SRAG", "srag", "zip", INPATIENTS),
    ("placar_testes", "testes", "csv", TESTS),
]


def zip_file(path: Path, members: dict[str, str | bytes]) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return str(path)


def publish(root: Path) -> str:
    """Lay out the files as published on 2022-11-03; returns the catalogue's path."""
    base = f"{root}/site/"
    items = []
    for dataset, source, kind, text in SOURCES:
        if kind == "csv":
            write(root / f"site/2022/11/{DATE}_{source}.csv", text)
        else:
            zip_file(root / f"site/{source}.zip", {"pasta/": "", f"pasta/{source}.csv": text})
        items.append([base, source, dataset, kind, "diaria"])
    items.append([base, "outro", "planilha", "xlsx", "diaria"])
    items.append([base, "anual", "anuario", "csv", "mensal"])
    keys = ["base", "source", "dataset", "type", "Atualizacao"]
    catalog = json.dumps([dict(zip(keys, item)) for item in items], ensure_ascii=False, indent=1)
    return write(root / "metadata/covidsource.json", catalog)
