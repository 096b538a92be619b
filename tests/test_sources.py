import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from labtrail.operators.outputs import export_bundle, export_views, flag_views, union_sources, write_batch, write_table
from labtrail.plans.checks import quality_checks
from labtrail.plans.clean import clean
from labtrail.plans.intake import intake_flat, intake_nested, intake_pair
from labtrail.plans.validate import build_scope, check_scope, deliver, summarise
from labtrail.rules import ProjectRules, rule_table, unit_factors
from labtrail.schemas import LOG, SHEET_CANONICAL
from labtrail.sources import batches, lookups, sheets, windows
from labtrail.sources.nested import flatten_samples, read_documents, read_nested_results

RULES = ProjectRules(campaigns=("Proj_A",), proposal_numbers=("PC0001/2026",))


def document(*samples):
    return {"amostras": list(samples)}


def sample(ident, parameters, notes=(), campaign="Proj_A", **more):
    return {
        "codigoEstacao": "C1", "idAmostra": ident, "descricaoAmostra": f"PT-{ident}", "campanha": campaign,
        "DataHoraAmostragem": "10/08/2026 09:00", "comentario": "of the sample", "composta": True, "profInicial": 1.5,
        "parametros": parameters,
        "cadeiaDeCustodia": {"informacoes": {"tipoAmostra": "simples"}, "avaliacoesDoLocal": list(notes)}, **more,
    }


@pytest.fixture
def landing(tmp_path):
    notes = [{"label": "Odor / cor:", "value": ["a", None, " ", "b"]}, {"label": None, "value": None}]
    later = [{"label": "Vento-sul", "value": ["x"]}, {"label": "Vento-sul:", "value": ["y"]}]
    fe = {"parametroOriginal": "Fe", "resultadoNumerico": 12.5, "comentario": "of the result", "reportavel": False}
    first = document(sample("1", [fe, {"parametroOriginal": "Pb"}], notes), sample("2", []))
    second = document(sample("3", [fe], later, campaign="Proj_B"), {**sample("4", [fe]), "cadeiaDeCustodia": None})
    for name, doc in (("one", first), ("two", second)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1), encoding="utf-8")
    return str(tmp_path)


def test_nested_documents(spark, landing):
    got = read_nested_results(spark, landing, "api", labels=["CC_Vento_sul"]).orderBy("idAmostra", "parametroOriginal")
    rows = got.collect()
    assert [(r.idAmostra, r.parametroOriginal) for r in rows] == [("1", "Fe"), ("1", "Pb"), ("3", "Fe"), ("4", "Fe")]
    first, later, bare = rows[0], rows[2], rows[3]
    assert (first.dataHoraAmostragem, first.comentario_amostra, first.comentario_parametro) == (
        "10/08/2026 09:00", "of the sample", "of the result")
    assert (first.composta, first.reportavel, first.resultadoNumerico, first.profInicial) == ("true", "false", "12.5", "1.5")
    assert first.custodia == {"CC_Odor___cor": "a | b", "CC_": ""} and first.CC_Vento_sul is None
    assert later.CC_Vento_sul == "y" and first.CC_tipoAmostra == "simples"
    assert bare.custodia is None and bare.CC_tipoAmostra is None and bare.OrigemArquivo == "api"
    assert all(t == "string" for c, t in got.dtypes if c != "custodia")
    assert flatten_samples(read_documents(spark, landing)).count() == 4


def test_nested_field_names_and_campaign(spark, tmp_path):
    doc = {"lotes": [{**sample("1", [{"parametroOriginal": "Fe"}]), "codigoX": "77"}]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    documents = read_documents(spark, str(tmp_path), "lotes", "codigoX", multiline=False)
    layout = {"samples_field": "lotes", "station_field": "codigoX"}
    assert intake_nested(documents, RULES, "api", **layout).first().codigoEstacao == "77"
    assert intake_nested(documents, RULES, "api", selection=("Other",), **layout).count() == 0


FLAT = """ Proposta Comercial ,Identificação,Tipo de Amostra,Codigo da Amostra,Data de Coleta,Data de Recebimento,Data de Publicação,Situação da Amostra,Identificação da Análise,Resultado da Análise,Unidade de Medida da Análise
Proj_A - X,"PT-01-SO-100826-0,5",Solo,1,10/08/2026 09:00,11/08/2026 09:00,20/08/2026 09:00,Publicada,Ferro,"109,39",mg/dm³
Proj_A - X,"PT-01-SO-100826-0,5",Solo,1,10/08/2026 09:00,11/08/2026 09:00,20/08/2026 09:00,Publicada,Benzeno,"< 0,0030",mg/kg
PC0001/2026,PT-02-ASUB-110826,Água subterrânea,2,11/08/2026 10:30,12/08/2026 10:30,,Recebida,Ferro,,µg/L
PC0001/2026,PT-02-ASUB-110826,Água subterrânea,2,11/08/2026 10:30,12/08/2026 10:30,,,Ferro,250,µg/L
PC0001/2026,PT-02-ASUB-110826,Água subterrânea,2,11/08/2026 10:30,12/08/2026 10:30,,,Zinco,1,µg/L
PC0001/2026,PT-02-ASUB-110826,Água subterrânea,9,11/08/2026 10:30,12/08/2026 10:30,,,Zinco,2,µg/L
Proj_B,"PT-03-SO-120826-1,0",Solo,3,12/08/2026 08:00,12/08/2026 08:00,,,Coliformes,Ausente,P/A
"""


@pytest.fixture
def flat_path(tmp_path):
    (tmp_path / "flat.csv").write_text(FLAT, encoding="utf-8")
    return str(tmp_path / "flat.csv")


def test_flat_sheet(spark, flat_path):
    got = intake_flat(sheets.read_sheet(spark, flat_path), RULES, "LAB", "LAB_SITE")
    assert tuple(got.columns) == SHEET_CANONICAL
    rows = {(r.idAmostra, r.parametroOriginal): r for r in got.collect()}
    assert set(rows) == {("1", "Ferro"), ("1", "Benzeno"), ("2", "Ferro")}
    benzene = rows["1", "Benzeno"]
    assert (benzene.qualifier, benzene.resultadoNumerico, benzene.resultadoTexto) == ("<", "0,0030", None)
    assert benzene.dataLiberacao == "20/08/2026 09:00" and benzene.metodoAnalise is None
    assert rows["2", "Ferro"].unidadeOriginal == "µg/L"


def test_missing_columns_are_named_at_once(rows):
    with pytest.raises(ValueError, match="Tipo de Amostra.*Data de Coleta"):
        sheets.resolve_flat(rows("`Proposta Comercial` string, Identificacao string", ("a", "b")))
    with pytest.raises(ValueError, match="Nome Amostra.*LQ"):
        sheets.resolve_pair(rows("x int", (1,)), rows("`Cod Amostra Lab` string", ("a",)))


def test_pair(rows):
    samples = rows(
        "`Codigo Ponto` string, `Nome Amostra` string, `Cod Amostra Lab` string, `Data Coleta` string, `Matriz Monit` string,"
        " `Data Recebimento Lab` string, `Proposta Comercial` string, Comentario string",
        ("p", "PT-1", "L1", "d", "ASUB", "e", "x Proj_A y", "c1"), ("p", "PT-1", "L2", "d", "ASUB", "e", "Proj_A", None),
        ("p", "PT-9", "L9", "d", "LNAPL", "e", "Proj_B", None),
    )
    analyses = rows(
        "`Cod Amostra Lab` string, `Cod Parametro` string, `Resultado Original` string, `Unidade Original` string,"
        " `Data e Hora Analise` string, `Metodo Analise` string, `Tipo Analise` string, LQ string",
        ("L1", "Fe", "< 250.00", "µg/L", "t", "m", "Inicial", "250,00"), ("L2", "Fe", "< 250.00", "µg/L", "t", "m", "Inicial", "-"),
        ("L1", "Pb", "1", "µg/L", "t", "m", "Inicial", "-"), ("L2", "Pb", "2", "µg/L", "t", "m", "Reanalise", "-"),
        ("L9", "Fe", "5", "µg/L", "t", "m", "Inicial", "-"),
    )
    got = intake_pair(samples, analyses, RULES, "LAB", "LAB_MAIL").orderBy("idAmostra").collect()
    assert [(r.idAmostra, r.parametroOriginal, r.matriz) for r in got] == [
        ("L1", "Fe", "Água Subterrânea"), ("L2", "Fe", "Água Subterrânea")]
    assert (got[0].comentario_amostra, got[0].comentario_parametro, got[0].limiteQuantificacao) == ("c1", None, "250,00")
    codes = sheets.unmapped_codes(samples, "Matriz Monit")
    assert [r[0] for r in codes.collect()] == ["LNAPL"]


def test_null_status_is_not_pending(rows):
    df = rows("s string", ("Recebida",), (None,), ("Publicada",))
    assert sorted(r[0] or "" for r in sheets.drop_pending(df, "s").collect()) == ["", "Publicada"]
    odd = rows("c string", ("a.b",), ("axb",), (None,))
    assert [r[0] for r in sheets.filter_campaign(odd, "c", contains=["a.b"]).collect()] == ["a.b"]


def test_lookups(spark, rows, tmp_path):
    (tmp_path / "l.csv").write_text("de ,para,source_project\na,x,P\nb,,P\nc,z, \nd,w,Q\n", encoding="utf-8")
    got = lookups.read_lookup(spark, str(tmp_path / "l.csv"), {"k": ["DE", "de"], "v": ["para"]}, target="v", project="P")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "x"), ("c", "z")]
    assert lookups.empty(spark, LOG).schema == LOG
    stations = rows("ID int, Name string, alternate_name string, source_project string", (1, "n", "alt", "P"), (2, "m", "b", "Q"))
    smp = rows("Name string, Station int, quality_code string", ("S1", 1, "N"), ("S2", 2, "N"))
    assert [tuple(r) for r in lookups.station_dim(stations, smp, "P").collect()] == [("S1", "n", "alt", "N")]


def test_blocks_cover_the_range_once(spark):
    start, end = date(2026, 1, 1), date(2026, 7, 15)
    blocks = windows.plan_blocks(spark, start, end).orderBy("block").collect()
    days = [b.block_end.toordinal() - b.block_start.toordinal() + 1 for b in blocks]
    assert sum(days) == (end - start).days + 1 and max(days) == 60
    assert all(a.block_end.toordinal() + 1 == b.block_start.toordinal() for a, b in zip(blocks, blocks[1:]))
    assert windows.plan_blocks(spark, start, start).count() == 1
    none = spark.createDataFrame([], "t timestamp")
    failed = windows.block_coverage(none, "t", start, end, failed=[0])
    assert windows.extraction_status(failed).first().status == "Erro"
    assert windows.extraction_status(windows.block_coverage(none, "t", start, end)).first().status == "Sucesso"


def test_batches(spark, rows, tmp_path):
    path = str(tmp_path / "bronze")
    for name, n in (("siteA_20260901_20260908_20260910_0700", 1), ("siteA_20260801_20260808_20260911_0700", 2),
                    ("mailB_20260905_0900", 3), ("mailB_20260906_0900", 4)):
        write_batch(rows("x int, `a b` string", (n, "v")), path, name)
    write_batch(rows("x int, `a b` string", (44, "v")), path, "mailB_20260906_0900")
    df = batches.read_batches(spark, path)
    assert df.count() == 4 and batches.list_batches(df).count() == 4
    prefix = batches.source_prefix(F.col("batch_id"))
    newest = batches.latest_batch(df, by=[prefix])
    assert sorted(r.x for r in newest.collect()) == [2, 44]
    kept = batches.read_batches(spark, path, schema="x int, a_b string, later string")
    assert kept.count() == 4 and kept.first().later is None
    assert [r.x for r in batches.latest_batch(df, before="mailB_20260906").collect()] == [3]
    assert batches.latest_batch(df, before="a").count() == 0


def test_batches_that_differ_in_columns(spark, rows, tmp_path):
    path = str(tmp_path / "bronze")
    write_batch(rows("x int, old string", (1, "o")), path, "siteA_20260801")
    write_batch(rows("x int, new string", (2, "n")), path, "siteA_20260901")
    got = {r.x: (r.old, r.new) for r in batches.read_batches(spark, path).collect()}
    assert got == {1: ("o", None), 2: (None, "n")}


def test_tables_and_bundles(spark, rows, tmp_path):
    df = rows("flag_a string, `x y` int", ("m", 1), (" ", 2))
    names = export_bundle({"a" * 40: df, "empty": df.limit(0), **flag_views(df, ["flag_a"])}, str(tmp_path))
    assert names == ["a" * 40, "flag_a"]
    assert spark.read.parquet(f"{tmp_path}/flag_a").collect()[0]["x_y"] == 1
    counts = export_views(df.withColumn("flag_b", F.lit("n")), ["flag_a", "flag_b", "x y"], str(tmp_path / "views"))
    assert counts == {"flag_a": 1, "flag_b": 2, "x y": 2}
    assert spark.read.parquet(str(tmp_path / "views")).groupBy("check").count().count() == 3
    write_table(df.select(F.lit("µ³ç").alias("t")), str(tmp_path / "t"), "csv")
    assert spark.read.csv(str(tmp_path / "t")).first()[0] == "µ³ç"
    both = union_sources({"one": df, "two": df.drop("x y")})
    assert sorted((r.fonte_qaqc, r["x y"] or 0) for r in both.collect()) == [("one", 1), ("one", 2), ("two", 0), ("two", 0)]


def test_from_sheet_to_routed_outputs(spark, rows, flat_path, tmp_path):
    """A flat sheet through intake, cleaning, validation, routed write and quality checks."""
    rules = ProjectRules(
        campaigns=("Proj_A",), proposal_numbers=("PC0001/2026",), soil_groups=("Metais", "VOC"),
        groundwater_groups={"Metais Totais": "Metais"},
    )
    bronze = intake_flat(sheets.read_sheet(spark, flat_path), rules, "LAB", "LAB_SITE")
    station = rule_table(spark, ("SampleName", "codigoEstacao", "alternate_name", "codigoQualidade"),
                         [("PT-01-SO-100826-0,5", "C1", "SB-1", "N")])
    none = spark.createDataFrame([], "descricaoAmostra_de string, descricaoAmostra_para string, codigoEstacao string, alternate_name string")
    parameter = rule_table(spark, ("parametro_de", "matriz_de", "parametro_para", "unidade_para"),
                           [("Ferro", "Solo", "Ferro Total (mg/kg)", "mg/kg"),
                            ("Ferro", "Agua Subterranea", "Ferro Total (mg/L)", "mg/L")])
    silver = clean(bronze, station, none, parameter, unit_factors(spark))
    assert silver.count() == bronze.count() == 3
    contract = rule_table(spark, ("parametro", "matriz", "planejamento", "metodo", "prazo"),
                          [("Ferro Total (mg/kg)", "Solo", "Metais", "M", "0 dias"), ("Zinco (mg/kg)", "Solo", "Metais", "M", "7 dias")])
    soil = rows("Sondagem string, `Total de Amostras` string, Metais string, VOC string", ("SB-1", "2", "x", None))
    water = rows("`Poço` string, `Total de Amostras` string, `Metais Totais` string", ("W", "1", "x"))
    scope = build_scope(rules, contract, soil, water)
    checked = check_scope(silver, scope)
    report = [tuple(r) for r in summarise(checked, scope).collect()]
    assert report == [("SB-1", "Solo", "PT-01-SO-100826-0,5", None, "Zinco (mg/kg)", None, 1, 0, 1, 0)]
    assert build_scope(RULES, contract) is None and summarise(checked, None).count() == 0
    assert check_scope(silver, None).where("flag_metodo is not null").count() == 0

    path = str(tmp_path / "silver")
    write_batch(deliver(checked), path, "siteA_20260910_0700", ["output"])
    written = spark.read.parquet(path)
    routed = {r.output: r["count"] for r in written.groupBy("output").count().collect()}
    assert routed == {"api_validado": 1, "holding": 1, "erro_sampleName": 1, "erro_mapeamento": 1}
    valid = written.where("output = 'api_validado'").first()
    assert (valid.chemical_name, valid.value, valid.unit, valid.Station, valid.quality_code) == (
        "Ferro Total (mg/kg)", 109.39, "mg/kg", "C1", "N")
    assert valid.holding_time_executado == 1 and valid.frequency is None
    assert len(written.columns) == 34 + 3
    checks = quality_checks(written.where("output = 'api_validado'"), rules)
    assert checks.count() == 1 and checks.first().flag_rpd is None
