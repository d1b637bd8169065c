import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fiscalake.session import create_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        app_name="tests",
        master="local[4]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def land_file(tmp_path):
    """Write one snapshot file the way the API client lands it."""

    def write(dataset, year, month, stamp, records, municipality="salto"):
        folder = (
            tmp_path / dataset / f"municipio={municipality}" / f"exercicio={year}" / f"mes={month:02d}"
        )
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{dataset}_{municipality}_{year}_{month:02d}_{stamp}.json"
        text = records if isinstance(records, str) else json.dumps(records, ensure_ascii=False)
        path.write_text(text, encoding="utf-8")
        return path

    write.root = str(tmp_path)
    return write


def expense(**changes):
    row = {
        "orgao": "CAMARA",
        "mes": "Janeiro",
        "evento": "Empenhado",
        "nr_empenho": "7-2021",
        "id_fornecedor": "CNPJ - 900",
        "nm_fornecedor": "ALFA LTDA",
        "dt_emissao_despesa": "09/01/2021",
        "vl_despesa": "2.500,75",
    }
    return {**row, **changes}


def revenue(**changes):
    row = {
        "orgao": "CAMARA",
        "mes": "Fevereiro",
        "ds_fonte_recurso": "02 - ESTADO",
        "ds_cd_aplicacao_fixo": "110 - GERAL",
        "ds_alinea": "1.1 - TAXA - LOCAL",
        "ds_subalinea": "11 - TAXA",
        "vl_arrecadacao": "9.876,54",
    }
    return {**row, **changes}
