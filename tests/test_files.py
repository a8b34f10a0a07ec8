"""File sources, loads, queries over the warehouse, and the stream."""

import gzip
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from trunkline.operators import enrich_calls
from trunkline.plans import files, inputs, registry
from trunkline.plans.loads import Warehouse, load_numbering, load_portability
from trunkline.sources import discovery, numbering, portability, preview
from trunkline.sources.tables import write_result
from trunkline.streaming import (
    enrich_calls_stream,
    load_portability_stream,
    quarantined_files,
    retry_quarantined,
)

HEADER = (
    "TIPO REG;NUMERO BP;TN INICIAL;RECEPTORA;RECEPTORA;DOADORA;DOADORA;"
    "DATA AGENDAMENTO;STATUS ATUAL;STATUS ATUAL;IND. PORTAR PARA ORIGEM"
)


def line(bp=5001007, tn=4733120954, rec="0377", rname="Araucária Tel", don="0388",
         dname="Litoral Fixa", day="11/06/2010 00:00:00", status="1", flag="Nao"):
    return f"1;{bp};{tn};{rec};{rname};{don};{dname};{day};{status};Ativo;{flag}"


def write_report(path, lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def write_zip(path, text, member="dados.csv"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(member, text.encode("latin-1"))
    return path


# --- portability reports ------------------------------------------------------------


def test_scan_and_type(spark, tmp_path):
    write_report(
        tmp_path / "2024" / "r1.csv.gz",
        [
            line(),
            line(bp=2, rec="x", rname="NA", don="", dname='"A;B"', flag="Sim"),
            line(bp="", tn=1),
            line(bp=4, tn="n/a"),
            line(bp=5, day="31/02/2010 00:00:00"),
            line(bp=6, day=""),
            line(bp=7, flag="Talvez"),
            line(bp=8, status=""),
            line(bp=9) + ";extra",
            "1;10;4733120954",
            "x" + line(bp=11)[1:],
            ";" + line(bp=12)[2:],
        ],
    )
    write_report(tmp_path / "r2.csv.gz", [line(bp=13, rname="Operação")])
    (tmp_path / "ignored.txt").write_text("x")
    typed = portability.type_portability(portability.scan_portability(spark, str(tmp_path)))
    reasons = {r.numero_bp: r.motivo for r in typed.collect()}
    assert reasons == {
        5001007: None, 2: None, None: "numero_bp", 4: "tn_inicial", 5: "data_agendamento",
        6: "data_agendamento", 7: "ind_portar_origem", 8: "cod_status",
        9: "numero de campos", 10: "numero de campos", 11: "tipo_registro", 12: None,
        13: None,
    }
    good = {r.numero_bp: r for r in portability.accepted(typed).collect()}
    assert set(good) == {5001007, 2, 12, 13}
    assert portability.rejected(typed).count() == 9
    first = good[5001007]
    assert (first.cod_receptora, first.cod_doadora, first.ind_portar_origem) == (377, 388, 0)
    assert first.data_agendamento == datetime(2010, 6, 11)
    assert first.nome_arquivo == "r1.csv.gz" and good[13].nome_arquivo == "r2.csv.gz"
    second = good[2]
    assert (second.cod_receptora, second.nome_receptora, second.cod_doadora) == (None,) * 3
    assert second.nome_doadora == "A;B" and second.ind_portar_origem == 1
    assert good[12].tipo_registro is None and good[13].nome_receptora == "Operação"


def test_one_file_with_any_extension(spark, tmp_path):
    path = tmp_path / "report.txt"
    path.write_text("\n".join([HEADER, line(), line(bp=2)]))
    assert portability.scan_portability(spark, str(path)).count() == 2


def test_other_encoding(spark, tmp_path):
    path = tmp_path / "r.csv.gz"
    path.write_bytes(gzip.compress(f"{HEADER}\n{line(rname='São')}\n".encode("latin-1")))
    scanned = portability.scan_portability(spark, str(path), "ISO-8859-1")
    assert scanned.first().nome_receptora == "São"


def test_missing_and_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        portability.scan_portability(spark, str(tmp_path / "none"))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    (tmp_path / "empty").mkdir()
    assert load_portability(warehouse, str(tmp_path / "empty")).report.count() == 0
    assert load_numbering(warehouse, str(tmp_path / "empty")).report.count() == 0
    assert not warehouse.has("prestadoras")


# --- numbering plan -----------------------------------------------------------------

STFC = (
    "# a;b;c;d;e;f;g;h;i;j;k;l;m\n"
    "Serra Fixa;10000000000101;SC;11;5201;0000;0999;47001;São Bento;São Bento;SBS;4701;1\n"
    "\n"
    "Sem CNL;10000000000202;SC;11;4922;1000;1999;;Itá;Itá;ITA;4702;1;;\n"
    "Sobra;10000000000203;SC;11;4923;1000;1999;;Itá;Itá;ITA;4702;1;sobra\n"
    "CNL ruim;10000000000204;SC;11;4924;1000;1999;x;Itá;Itá;ITA;4702;1\n"
)
SMP = (
    "# a;b;c;d;e;f;g\n"
    "Móvel Um;10000000000303;11;91932;0000;9999;1\n"
    "Curta;10000000000304;11;91933\n"
)
SME = "# h\nRádio Sul;10000000000405;11;7801;0000;0999;1\n"
CNG = "# h\nGratuita;10000000000506;8005917204;1\n"
SUP = "# h\nPolícia;10000000000607;190;;SC;Todos;1;Itá;PM;1;1\nSem código;x;191;;SC;Todos;1;Itá;PM;1;1\n"


@pytest.fixture
def plan_folder(tmp_path):
    folder = tmp_path / "plano"
    write_zip(folder / "STFC_2024.zip", STFC)
    write_zip(folder / "a" / "smp.zip", SMP)
    write_zip(folder / "a" / "Sme.zip", SME)
    write_zip(folder / "cng_1.zip", CNG)
    write_zip(folder / "SUP.zip", SUP)
    write_zip(folder / "outro.zip", SMP)
    return folder


def test_stage_numbering(spark, plan_folder):
    archives = numbering.scan_archives(spark, str(plan_folder))
    staged = numbering.fixed_and_mobile(
        numbering.stage_numbering(archives, "STFC"), numbering.stage_numbering(archives, "SMP_SME")
    )
    rows = {r.nome_prestadora: r for r in staged.collect()}
    assert {n: r.motivo for n, r in rows.items()} == {
        "Serra Fixa": None, "Sem CNL": None, "Sobra": "numero de campos",
        "CNL ruim": "codigo_cnl", "Móvel Um": None, "Curta": "numero de campos", "Rádio Sul": None,
    }
    assert rows["Serra Fixa"].nome_localidade == "São Bento"
    assert rows["Sem CNL"].codigo_cnl is None and rows["Sem CNL"].status == "1"
    assert rows["Curta"].faixa_inicial is None
    assert {r.servico for r in rows.values()} == {"STFC", "SMP_SME"}
    assert rows["Rádio Sul"].nome_arquivo == "Sme.zip"
    utility = {r.nome_prestadora: r.motivo for r in numbering.stage_numbering(archives, "SUP").collect()}
    assert utility == {"Polícia": None, "Sem código": "cnpj_prestadora"}
    cng_only = numbering.scan_archives(spark, str(plan_folder), "CNG")
    assert cng_only.count() == 1


def test_damaged_archive_is_reported(spark, plan_folder, tmp_path):
    (plan_folder / "SMP_ruim.zip").write_bytes(b"PK no archive")
    body = "h\n" + "".join(f"P;{i};11;90000;0000;9999;1\n" for i in range(30_000))
    write_zip(plan_folder / "STFC_crc.zip", body)
    raw = bytearray((plan_folder / "STFC_crc.zip").read_bytes())
    raw[len(raw) // 2] ^= 0xFF  # the check sum no longer fits
    (plan_folder / "STFC_crc.zip").write_bytes(bytes(raw))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = load_numbering(warehouse, str(plan_folder)).report.collect()
    report = {r.nome_arquivo: r for r in rows}
    assert report["SMP_ruim.zip"].status == "error"
    assert report["SMP_ruim.zip"].erro.startswith("BadZipFile")
    assert report["STFC_crc.zip"].erro.startswith("BadZipFile")
    assert report["outro.zip"].erro == "tipo desconhecido"
    assert tuple(report["smp.zip"])[1:] == (2, 1, 1, "numero de campos", "error")
    assert tuple(report["SUP.zip"])[1:] == (2, 1, 1, "cnpj_prestadora", "error")
    assert tuple(report["Sme.zip"])[1:] == (1, 1, 0, None, "success")


def test_all_files_of_an_archive_are_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "SMP.zip", "w") as z:
        z.writestr("dados/", "")
        z.writestr("dados/a.csv", "h\nA;1;11;91932;0000;9999;1\n")
        z.writestr("dados/b.csv", "h\nB;2;11;91933;0000;9999;1\nC;3;11;91934;0000;9999;1\n")
    staged = numbering.stage_numbering(numbering.scan_archives(spark, str(tmp_path)), "SMP_SME")
    assert {r.nome_prestadora for r in staged.collect()} == {"A", "B", "C"}


def test_damaged_report_does_not_stop_the_others(spark, tmp_path):
    reports = tmp_path / "pip"
    write_report(reports / "bom.csv.gz", [line(bp=i) for i in range(50)])
    whole = gzip.compress("\n".join([HEADER] + [line(bp=i, tn=11900000000 + i) for i in range(999)]).encode())
    (reports / "cortado.csv.gz").write_bytes(whole[: len(whole) // 2])
    (reports / "vazio.csv.gz").write_bytes(b"")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = load_portability(warehouse, str(reports)).report.collect()
    report = {r.nome_arquivo: tuple(r)[1:] for r in rows}
    assert report["bom.csv.gz"] == (50, 50, 0, None, "success")
    assert report["vazio.csv.gz"] == (0, 0, 0, None, "success")
    read, loaded, rejected, why, status = report["cortado.csv.gz"]
    assert (read, loaded, rejected, status) == (0, 0, 0, "error") and "Exception" in why
    assert warehouse.history.count() == 1


def test_other_file_types_are_not_read(spark, plan_folder):
    cng = numbering.scan_archives(spark, str(plan_folder), "CNG")
    cng.collect()
    scan = cng._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_many_records_in_one_archive(spark, tmp_path):
    n = 50_000
    body = "".join(f"P;{i};11;9{i % 10000:04d};0000;9999;1\n" for i in range(n))
    write_zip(tmp_path / "SMP.zip", "h\n" + body)
    staged = numbering.stage_numbering(numbering.scan_archives(spark, str(tmp_path)), "SMP_SME")
    assert staged.agg(F.countDistinct("cnpj_prestadora")).first()[0] == n


# --- the warehouse ------------------------------------------------------------------


def test_load_and_query(spark, tmp_path, plan_folder):
    reports = tmp_path / "pip"
    write_report(
        reports / "r1.csv.gz",
        [
            line(bp=1, tn=11919320001, day="10/01/2010 08:00:00"),
            line(bp=2, tn=11919320001, rec="", rname="Sem", day="10/01/2020 08:00:00"),
            line(bp=3, tn=1152010001, rec="0777", rname="Nova"),
            line(bp=4, tn=11919320009, flag="?"),
        ],
    )
    write_report(reports / "r2.csv.gz", [line(bp=5, tn=1152010001, rec="0778", rname="Novíssima")])
    write_report(reports / "r0.csv.gz", [])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    plan = load_numbering(warehouse, str(plan_folder))
    status = {r.nome_arquivo: (r.status, r.linhas) for r in plan.report.collect()}
    assert status["outro.zip"] == ("error", 0) and status["STFC_2024.zip"] == ("error", 2)
    assert warehouse.read("numeracao").count() == 5
    rejected = warehouse.read("numeracao_rejeitada").collect()
    assert {(r.nome_arquivo, r.motivo) for r in rejected} == {
        ("STFC_2024.zip", "numero de campos"), ("STFC_2024.zip", "codigo_cnl"),
        ("smp.zip", "numero de campos"),
    }

    load = load_portability(warehouse, str(reports))
    report = {r.nome_arquivo: tuple(r)[1:] for r in load.report.collect()}
    assert report == {
        "r0.csv.gz": (0, 0, 0, None, "success"),
        "r1.csv.gz": (4, 3, 1, "ind_portar_origem", "error"),
        "r2.csv.gz": (1, 1, 0, None, "success"),
    }
    totals = load.totals().first()
    assert (totals.arquivos, totals.sucessos, totals.erros, totals.linhas) == (3, 2, 1, 4)
    assert totals.segundos > 0 and totals.linhas_por_segundo > 0

    def ask(numbers, day):
        rows = warehouse.query_numbers_carriers(numbers, day).collect()
        return {r[0]: tuple(r[1:]) for r in rows}

    numbers = [11919320001, "1152010001", 8005917204, 190, 11919320001, 11919350000]
    assert ask(numbers, "2015-06-30") == {
        11919320001: ("Araucária Tel", 1, 1),
        1152010001: ("Novíssima", 1, 1),
        8005917204: ("Gratuita", 0, 1),
        190: (None, 0, 0),
        11919350000: (None, 0, 0),
    }
    assert ask([11919320001], "01/01/2010") == {11919320001: ("Móvel Um", 0, 1)}
    assert ask([11919320001], date(2020, 1, 10)) == {
        11919320001: ("NÃO IDENTIFICADO", 1, 1)
    }
    with pytest.raises(TypeError):
        warehouse.query_numbers_carriers(11919320001)
    for wrong in ([], [11919320001, "abc"], [None]):
        with pytest.raises(ValueError):
            warehouse.query_numbers_carriers(wrong)
    mixed = spark.createDataFrame([("11919320001",), ("abc",), (None,), ("abc",)], "n string")
    rows = warehouse.query_numbers_carriers(mixed, "01/01/2010").collect()
    assert sorted(map(tuple, rows), key=str) == [
        (11919320001, "Móvel Um", 0, 1), (None, None, 0, 0), (None, None, 0, 0)
    ]
    few = warehouse.query_numbers_carriers([11919320001], "2015-06-30")
    few.collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "LeftSemi" in plan

    names = dict(warehouse.read("prestadoras").collect())
    assert names[10000000000607] == "Polícia" and names[777] == "Nova"
    before = warehouse.history.count()
    load_portability(warehouse, str(reports))
    assert warehouse.history.count() == before == 3
    later = tmp_path / "later"
    write_report(later / "a.csv.gz", [line(bp=9, tn=1152010001, rec="0377")])
    load_portability(warehouse, str(later), drop_staging=True)
    assert not warehouse.has("stg_portabilidade")
    assert warehouse.history.where("tn_inicial = 1152010001").first().numero_bp == 9
    load_portability(warehouse, str(later), rebuild=True)
    assert warehouse.history.count() == 1
    assert dict(warehouse.read("prestadoras").collect())[777] == "Nova"


def test_load_without_good_lines(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    write_report(tmp_path / "bad" / "r.csv.gz", [line(flag="?")])
    write_report(tmp_path / "good" / "r.csv.gz", [line()])
    for folder, rows in (("bad", 0), ("bad", 0), ("good", 1), ("bad", 1)):
        load_portability(warehouse, str(tmp_path / folder))
        assert warehouse.history.count() == rows


def test_stream_equals_batch_loads(spark, tmp_path):
    inbox = tmp_path / "in"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    arrivals = [
        {"b.csv.gz": [line(bp=1), line(bp=2, tn=11900000001)], "a.csv.gz": [line(bp=3)]},
        {"0.csv.gz": [line(bp=4), line(bp=5, tn=85900000001, flag="?")]},
    ]
    expected = [{4733120954: 1, 11900000001: 2}, {4733120954: 4, 11900000001: 2}]
    for files, want in zip(arrivals, expected):
        for name, lines in files.items():
            write_report(inbox / name, lines)
        for _ in range(2):  # a second run finds nothing new
            load_portability_stream(warehouse, str(inbox), str(tmp_path / "ckpt")).awaitTermination()
        got = {r.tn_inicial: r.numero_bp for r in warehouse.history.collect()}
        assert got == want
    names = dict(warehouse.read("prestadoras").collect())
    assert names[377] == "Araucária Tel" and names[388] == "Litoral Fixa"
    bad = warehouse.read("portabilidade_rejeitada").collect()
    assert [(r.numero_bp, r.motivo, r.lote) for r in bad] == [(5, "ind_portar_origem", 1)]
    report = {r.nome_arquivo: (r.linhas, r.rejeitadas) for r in warehouse.read("relatorio_portabilidade").collect()}
    assert report == {"a.csv.gz": (1, 0), "b.csv.gz": (2, 0), "0.csv.gz": (1, 1)}


def test_a_damaged_file_of_a_stream_waits_in_quarantine(spark, tmp_path):
    inbox = tmp_path / "in"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert retry_quarantined(warehouse) == 0
    write_report(inbox / "bom.csv.gz", [line(bp=1), line(bp=2, tn=11900000001)])
    whole = gzip.compress("\n".join([HEADER] + [line(bp=i, tn=21900000000 + i) for i in range(999)]).encode())
    (inbox / "cortado.csv.gz").write_bytes(whole[: len(whole) // 2])
    (inbox / "ruim.csv.gz").write_bytes(b"no gzip file")

    def run():
        load_portability_stream(warehouse, str(inbox), str(tmp_path / "ckpt")).awaitTermination()

    def waiting():
        return {r.caminho.rsplit("/", 1)[1]: r for r in quarantined_files(warehouse).collect()}

    run()
    assert warehouse.history.count() == 2
    assert set(waiting()) == {"cortado.csv.gz", "ruim.csv.gz"}
    assert all("Exception" in r.motivo and r.lote == 0 for r in waiting().values())
    report = {r.nome_arquivo: r.status for r in warehouse.read("relatorio_portabilidade").collect()}
    assert report == {"bom.csv.gz": "success", "cortado.csv.gz": "error", "ruim.csv.gz": "error"}
    write_report(inbox / "outro.csv.gz", [line(bp=3, tn=11900000002)])
    run()  # later arrivals go on
    assert warehouse.history.count() == 3 and len(waiting()) == 2
    assert retry_quarantined(warehouse) == 0 and waiting()["ruim.csv.gz"].lote == -1
    (inbox / "cortado.csv.gz").write_bytes(whole)  # sent anew
    assert retry_quarantined(warehouse) == 1
    assert warehouse.history.count() == 3 + 999
    assert set(waiting()) == {"ruim.csv.gz"}
    write_report(inbox / "ruim.csv.gz", [line(bp=9, tn=11900000001)])
    assert retry_quarantined(warehouse) == 1 and not waiting()
    assert retry_quarantined(warehouse) == 0
    row = warehouse.history.where("tn_inicial = 11900000001").first()
    assert row.numero_bp == 9  # a retry is a load of its own, the latest
    states = warehouse.read("arquivos_portabilidade").groupBy("estado").count().collect()
    assert dict(map(tuple, states)) == {"carregado": 4, "quarentena": 5}


def test_calls_are_enriched_as_they_arrive(spark, tmp_path, plan_folder, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    load_numbering(warehouse, str(plan_folder))
    write_report(tmp_path / "pip" / "r.csv.gz", [line(bp=1, tn=11919320001, day="10/01/2010 08:00:00")])
    load_portability(warehouse, str(tmp_path / "pip"))
    schema = "id int, origem string, destino string"
    arrivals = [
        [(1, "11919320001", "1152010001"), (2, None, "x")],
        [(3, "11919320002", "11919320001")],
    ]
    out, inbox = str(tmp_path / "out"), str(tmp_path / "in")

    def run(checkpoint="ckpt"):
        calls = spark.readStream.schema(schema).parquet(inbox)
        enrich_calls_stream(
            warehouse, calls, "origem", "destino", out, str(tmp_path / checkpoint), "2015-06-30"
        ).awaitTermination()

    def rows():
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    for i, some in enumerate(arrivals):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(inbox)
        run()
        run()  # nothing new
        batch = spark.createDataFrame(sum(arrivals[: i + 1], []), schema)
        whole = enrich_calls(
            batch, warehouse.history, warehouse.read("numeracao_segmentos"),
            warehouse.read("prestadoras"), "origem", "destino", "2015-06-30",
        )
        assert [r[:-1] for r in rows()] == sorted(map(tuple, whole.collect()))
    before = rows()
    # The history moves on; a replay of both batches as one still sees the first state.
    write_report(tmp_path / "pip2" / "r.csv.gz", [line(bp=2, tn=11919320002, day="10/01/2011 08:00:00")])
    load_portability(warehouse, str(tmp_path / "pip2"))
    run("ckpt2")
    assert [r[:-1] for r in rows() if r[-1] == 0] == [r[:-1] for r in before]


# --- looking at files ---------------------------------------------------------------


@pytest.fixture
def mixed_folder(tmp_path):
    folder = tmp_path / "cdr"
    folder.mkdir()
    (folder / "a.csv").write_text("timestamp,origem,destino,duracao\n 1,2,3,4 \n5,6,7,8\n")
    with gzip.open(folder / "b.csv.gz", "wt") as f:
        f.write("timestamp,origem\n" + "x\n" * 100_000)
    write_zip(folder / "c.zip", "data,total\n1,2\n", "janeiro.csv")
    (folder / "sub").mkdir()
    (folder / "sub" / "d.log").write_bytes("linha ção\n".encode("latin-1"))
    (folder / "e.csv").write_text("")
    return folder


def test_preview(spark, mixed_folder):
    files = discovery.list_files(spark, str(mixed_folder))
    rows = preview.preview_files(files, 2).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.nome_arquivo, []).append((r.membro, r.linha_no, r.linha))
    assert by_file["a.csv"] == [
        (None, 1, "timestamp,origem,destino,duracao"), (None, 2, "1,2,3,4"),
    ]
    assert by_file["b.csv.gz"] == [(None, 1, "timestamp,origem"), (None, 2, "x")]
    assert by_file["c.zip"] == [("janeiro.csv", 1, "data,total"), ("janeiro.csv", 2, "1,2")]
    assert "e.csv" not in by_file
    assert [r.erro for r in rows if r.nome_arquivo == "d.log"][0].startswith("UnicodeDecodeError")
    latin = preview.preview_files(files.where("path like '%.log'"), 2, "latin1").collect()
    assert [r.linha for r in latin] == ["linha ção"]


def test_header_check(spark, mixed_folder):
    files = discovery.list_files(spark, str(mixed_folder), "*.csv*")
    wanted = ["timestamp", "origem", "destino", "duracao"]
    got = {r[0]: (r[1], r[2]) for r in preview.header_check(files, wanted).collect()}
    every = ",".join(wanted)
    assert got == {"a.csv": ("", True), "b.csv.gz": ("destino,duracao", False), "e.csv": (every, False)}


def test_header_check_of_a_file_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "x.csv.gz").write_bytes(b"no gzip")
    files = discovery.list_files(spark, str(tmp_path))
    row = preview.header_check(files, ["a"]).first()
    assert not row.valido and row.erro.startswith("BadGzipFile")


def test_preview_of_a_long_line(spark, tmp_path):
    (tmp_path / "x.csv").write_text("é" * 200_000 + "\nsegunda\n")
    rows = preview.preview_files(discovery.list_files(spark, str(tmp_path)), 3).collect()
    assert [(r.linha_no, len(r.linha) <= preview.LINE_BYTES) for r in rows] == [(1, True), (2, True)]
    assert rows[1].linha == "segunda" and set(rows[0].linha) == {"é"}


def test_inventory(spark, mixed_folder):
    files = discovery.list_files(spark, str(mixed_folder))
    rows = discovery.file_inventory(files, str(mixed_folder)).collect()
    got = {r.nome: (r.caminho, r.extensao, r.formato) for r in rows}
    assert got == {
        "a.csv": ("a.csv", ".csv", "texto"),
        "b.csv.gz": ("b.csv.gz", ".gz", "gzip"),
        "c.zip": ("c.zip", ".zip", None),
        "d.log": ("sub/d.log", ".log", "texto"),
        "e.csv": ("e.csv", ".csv", "texto"),
    }
    assert {r.nome for r in rows if not r.tamanho} == {"e.csv"}


def test_encoding_probe(spark, mixed_folder):
    got = dict(preview.encoding_probe(spark, str(mixed_folder), "*.{csv,log,gz}").collect())
    assert got == {"a.csv": "utf8", "b.csv.gz": "utf8", "d.log": "latin1"}


def test_result_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "A"), (2, None)], "n int, nome string")
    for fmt in ("csv", "parquet", "json"):
        path = str(tmp_path / fmt)
        write_result(df, path, fmt)
        back = spark.read.schema(df.schema).format(fmt).option("header", True).load(path)
        assert {tuple(r) for r in back.collect()} == {(1, "A"), (2, None)}


def test_missing_marks_match_the_default_of_pandas():
    from pandas._libs.parsers import STR_NA_VALUES

    from trunkline.functions.keys import MISSING_MARKS

    assert set(MISSING_MARKS) == set(STR_NA_VALUES)


def test_large_files_are_written_in_parts(spark, tmp_path, conf):
    """No task takes a whole file, and the parts make up one file in order."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    n = 4000
    calls = spark.range(n).selectExpr(
        "id as call_id", "cast(id % 7 as string) as numero_a", "if(id % 3 = 0, null, 'b') as numero_b"
    )
    plans = []
    write = DataFrameWriter.csv

    def noted(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        plans.append(len({p.name.split("-")[1] for p in (tmp_path / "calls").glob("_novos/*=chamadas_1*/part-*")}))

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "csv", noted)
        files.write_calls(calls, str(tmp_path / "calls"), 2)
    assert plans[0] > 1
    assert sorted(p.name for p in (tmp_path / "calls").glob("*.gz")) == ["chamadas_0.csv.gz", "chamadas_1.csv.gz"]
    for i in (0, 1):
        found = gzip.open(tmp_path / "calls" / f"chamadas_{i}.csv.gz", "rt").read().splitlines()
        expected = [f"{k},{k % 7},{'' if k % 3 == 0 else 'b'}" for k in range(i, n, 2)]
        assert [x.rstrip('"').rstrip(",") for x in found] == [
            "timestamp,origem,destino", *[x.rstrip(",") for x in expected]
        ]
        assert spark.read.csv(str(tmp_path / "calls" / f"chamadas_{i}.csv.gz"), header=True).count() == n / 2


def test_copies_of_a_text_are_written_by_several_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    texts = spark.range(4000).selectExpr("id as doc_id", "'avião' as text", "'pt' as lang")
    sizes = []
    write = DataFrameWriter.csv

    def noted(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        sizes.extend(p.stat().st_size for p in (tmp_path / "texts").glob("_novos/*/part-*"))

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "csv", noted)
        files.write_texts(texts, str(tmp_path / "texts"), "ISO-8859-1", "latin1")
    whole = (tmp_path / "texts" / "latin1_pt.csv").read_bytes()
    assert whole == "avião,pt\n".encode("latin-1") * 4000
    assert max(sizes) < 0.6 * len(whole)


def test_report_files_are_written_without_a_table_before_them(spark, tmp_path, monkeypatch):
    """The lines go from their source into files at gzip's fastest level, and read back whole."""
    n = 4000
    items = spark.range(n).selectExpr(
        "id + 1 as l_orderkey", "cast(1 + id % 5 as int) as l_linenumber", "id % 97 as l_partkey",
        "id % 41 as l_suppkey", "if(id % 2 = 0, 'R', 'N') as l_returnflag", "'O' as l_linestatus",
        "timestamp'2001-05-01' + make_dt_interval(cast(id % 900 as int)) as l_shipdate",
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")

    def no_table(*_):
        raise AssertionError("a table is written")

    monkeypatch.setattr(inputs, "land", no_table)
    assert registry.scan_portability(spark, str(tmp_path)).count() == n
    files.write_reports(registry.report_lines(spark, str(tmp_path)), f"{tmp_path}/in")
    written = sorted((tmp_path / "in").glob("*.csv.gz"))
    assert [f.name for f in written] == ["relatorio_NO_000000.csv.gz", "relatorio_RO_000000.csv.gz"]
    for file in written:
        content = gzip.decompress(file.read_bytes())
        assert content.count(b"\n") == n // 2 + 1
        assert file.stat().st_size > 1.05 * len(gzip.compress(content, 6))
