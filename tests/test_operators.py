import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from labtrail.operators import flags, joins, outputs, parameters, quality, runlog, samples, scope
from labtrail.operators.conflicts import conflict_report, exclude_conflicts
from labtrail.plans.checks import FLAGS, quality_checks, quality_summary
from labtrail.rules import ProjectRules, unit_factors


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- joins ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("weighted", [True, False])
def test_attach_equals_a_left_join_with_hot_and_null_keys(spark, weighted):
    rng = random.Random(5)
    keys = ["hot"] * 400 + ["unknown"] * 300 + [None] * 300 + [f"k{rng.randrange(60)}" for _ in range(500)]
    left = spark.createDataFrame(
        [(i, k, 1) for i, k in enumerate(keys)], "i int, k string, j int"
    ).repartition(5)
    told = {k: f"v-{k}" for k in ["hot", *[f"k{n}" for n in range(40)]]}
    counts = defaultdict(int)
    for k in keys:
        counts[k] += 1
    every = sorted({k for k in keys if k} | set(told))
    info = spark.createDataFrame(
        [(k, 1, told.get(k), counts[k]) for k in every if weighted or k in told], "k string, j int, v string, n long"
    )
    got = joins.attach(left, info if weighted else info.drop("n"), ["k", "j"], weight="n" if weighted else None)
    assert got.columns == ["i", "k", "j", "v"]
    assert collected(got, "i", "v") == sorted(((i, told.get(k)) for i, k in enumerate(keys)), key=repr)
    only = joins.attach(left, info.drop("n"), ["k", "j"], only=F.col("i") % 2 == 0)
    assert collected(only, "i", "v") == sorted(
        ((i, told.get(k) if i % 2 == 0 else None) for i, k in enumerate(keys)), key=repr
    )


@pytest.mark.parametrize("together", [False, True])
def test_attach_spreads_the_hot_key(spark, together):
    """No task of the join has over twice its share of rows although one key has a third of them.

    The joined column is kept, so the join cannot be dropped; `together`: the rows come out of a shuffle by key.
    """
    rows = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k")
    )
    rows = rows.repartition(8, "k") if together else rows.repartition(64)
    info = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("k").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.attach(rows, info, ["k"], weight="n")
        sizes = joined.groupBy(F.spark_partition_id()).agg(F.count("v").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["n"] for r in sizes) == 60_000 and len(sizes) == 8
    assert max(r["n"] for r in sizes) < 2 * 60_000 / 8


def test_unique_lookup(rows):
    df = rows("k string, v string", ("a", None), ("a", "x"), ("b", "y"), (None, "z"))
    assert collected(joins.unique_lookup(df, ["k"])) == [("a", "x"), ("b", "y")]
    assert collected(joins.duplicate_keys(df, ["k"])) == [("a", 2)]
    with pytest.raises(ValueError, match="several rows"):
        joins.unique_lookup(df, ["k"], on_duplicate="error")


def test_lookup_join_keeps_the_rows(rows):
    left = rows("k string, i int", ("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5))
    lookup = rows("k string, v string", ("a", "x"), ("a", None), ("b", "y"))
    got = collected(joins.lookup_join(left, lookup, ["k"]), "i", "v")
    assert got == [(1, "x"), (2, "y"), (3, None), (4, None), (5, "x")]


# --- flags ---------------------------------------------------------------------------------------------


def test_parse_dates_flags(rows):
    df = rows("d string", ("10/08/2026 09:00",), ("junk",), (None,))
    flagged = [r.flag_d for r in flags.parse_dates(df, ["d"]).collect()]
    assert flagged == [None, "falha na conversao de d", "falha na conversao de d"]
    lenient = [r.flag_d for r in flags.parse_dates(df, ["d"], flag_missing=False).collect()]
    assert lenient == [None, "falha na conversao de d", None]


def test_dates_in_place_flag_the_text(rows):
    df = rows("a string, b string, n int", ("junk", " 10/08/26 ", 1), (None, "also junk", 2), ("junk", "junk", 3))
    got = flags.parse_dates_in_place(df, ["a", "b", "absent"]).orderBy("n").collect()
    assert [r.flag_fail_datehour_conversion for r in got] == ["a", "b", "a;b"]
    assert str(got[0].b) == "2026-08-10 00:00:00" and got[0].a is None


def test_missing_fields_extend_a_flag(rows):
    df = rows("a string, b string, f string", ("x", " ", "old"), (None, "y", None), ("x", "y", None))
    got = [r.f for r in flags.flag_missing(df, ["a", "b", "absent"], "f").collect()]
    assert got == ["old;b", "a", None]
    summary = flags.fail_summary(df.limit(1), df, "run", "t", {"f": "mandatory_col"})
    assert collected(summary) == [("run", "t", "mandatory_col", 3, 1)]


def test_flag_counts(rows):
    df = rows("flag_a string, flag_b string, x int", ("m", "", 1), ("m", " ", 2), (None, None, 3))
    assert collected(flags.flag_counts(df)) == [("flag_a", 2), ("flag_b", 0)]
    assert flags.flag_text(df).first().flags == "flag_a(2)"
    assert flags.flag_text(df.where("x = 3")).first().flags == "—"


def test_conflicts(rows):
    df = rows(
        "nomeAmostra string, parametroOriginal string, resultadoOriginal string",
        ("s", "p", "1,0"), ("s", "p", "1,00"), ("s", "q", "2"), ("s", "q", "2"), ("s", "r", None), ("s", "r", "3"),
        (None, "p", "1"), (None, "p", "2"),
    )
    kept = collected(exclude_conflicts(df))
    assert len(kept) == 6 and ("s", "p", "1,0") not in kept
    assert collected(conflict_report(df)) == [("s", "p", 2, 2)]


# --- samples and parameters ------------------------------------------------------------------------------


def test_station_priority(rows, spark):
    df = rows("descricaoAmostra string", ("A",), ("B",), ("C",), ("D",), ("E",), (None,))
    station = rows(
        "SampleName string, codigoEstacao string, alternate_name string, codigoQualidade string",
        ("A", "a1", "alt-a", "N"), ("T", "t1", "alt-t", "R"),
    )
    fix = rows(
        "descricaoAmostra_de string, descricaoAmostra_para string, codigoEstacao string, alternate_name string",
        ("A", "T", "manual", "manual"), ("B", "T", "manual", "manual"), ("C", "nowhere", "mc", "mn"), ("D", "nowhere", None, None),
    )
    got = {r.descricaoAmostra: tuple(r)[1:] for r in samples.map_samples(df, station, fix).select(
        "descricaoAmostra", "descricaoAmostra_final", "codigoEstacao", "alternate_name", "codigoQualidade",
        "flag_station_sem_mapeamento").collect()}
    none = samples.NO_STATION
    assert got == {
        "A": ("T", "a1", "alt-a", "N", None),
        "B": ("T", "t1", "alt-t", "R", None),
        "C": ("nowhere", "mc", "mn", None, None),
        "D": ("nowhere", None, None, None, none),
        "E": ("E", None, None, None, none),
        None: (None, None, None, None, none),
    }


def test_feedback_lists_new_names_once(rows):
    missing = rows("descricaoAmostra string, matriz string", ("A", "Solo"), ("A", "Solo"), ("B", "Solo"))
    listed = rows("descricaoAmostra_de string", ("B",))
    assert collected(samples.unmapped_to_append(missing, listed, "P")) == [("A", None, "Solo", "P")]


def test_units(rows, spark):
    df = rows(
        "resultadoNumerico double, limiteQuantificacao double, unidadeOriginal string, unidade_para string",
        (5.0, 1.0, "µg/L", "mg/L"), (1.23456, None, "a", "b"), (1.23456, 2.0, "mg/L", "mg/L"), (1.0, 1.0, "x", None),
        (2.0, 0.5, "%", "mg/kg"),
    )
    got = parameters.convert_units(df, unit_factors(spark)).collect()
    assert [r.resultadoCorrigido for r in got] == [0.005, 1.2346, 1.23456, 1.0, 20000.0]
    assert [r.limiteQuantificacaoCorrigido for r in got] == [0.001, None, 2.0, 1.0, 5000.0]
    assert [r.flag_conversao for r in got] == ["Valor convertido de µg/L para mg/L"] + [None] * 3 + [
        "Valor convertido de % para mg/kg"]
    assert [r.flag_fator_nao_encontrado for r in got] == [
        None, "Fator de conversao nao encontrado: a -> b", None, None, None]


def test_parameter_mapping_keeps_rows(rows):
    df = rows("parametroOriginal string, matriz string", ("Fe", "Solo"), ("Pb", "Solo"), ("Zn", "Solo"), (None, "Solo"))
    lookup = rows(
        "parametro_de string, matriz_de string, parametro_para string, unidade_para string",
        ("Fe", "Solo", "Ferro", "mg/kg"), ("Fe", "Solo", None, None), ("Pb", "Solo", "", "mg/kg"),
    )
    mapped, other = parameters.split_unmapped(parameters.map_parameters(df, lookup))
    assert collected(mapped, "parametroCorrigido", "unidade_para") == [("Ferro", "mg/kg")]
    assert other.count() == 3


# --- scope -------------------------------------------------------------------------------------------------


def test_plan_and_coverage(rows, spark):
    sheet = rows("Sondagem string, `Total de Amostras` string, G1 string, G2 string, G3 string",
                 ("st", "3", "x", None, "x"), ("other", "x", None, "x", None))
    plan = scope.unpivot_plan(sheet, "Solo", {"G1": "Metais", "G2": "VOC", "G3": None})
    assert collected(plan) == [("other", None, "VOC", "Solo"), ("st", 3, "Metais", "Solo"), ("st", 3, None, "Solo")]
    contract = rows("parametro string, matriz string, planejamento string, metodo string, prazo string",
                    ("Fe", "Solo", "Metais", "M1", "7 dias"), ("Pb", "Solo", "Metais", "M2", "-"),
                    ("Fe", "Solo", "VOC", "M1", "7 dias"), ("Bz", "Solo", "VOC", "M3", None))
    planned = scope.planned_parameters(plan, contract)
    assert collected(scope.groups_without_scope(planned)) == [("Solo", None)]
    df = rows(
        "alternate_name string, matriz string, descricaoAmostra_final string, parametroCorrigido string,"
        " metodoAnalise string, dataRecebLab_valida timestamp, dataHoraAmostragem_valida timestamp,"
        " flag_station_sem_mapeamento string",
        *[("st", "Solo", "a", p, m, None, None, None) for p, m in (("Fe", "M1"), ("Bz", "M9"), ("Zz", "M1"))],
        (None, "Solo", "b", "Fe", "M1", None, None, "no station"),
    )
    checked = scope.flag_holding(scope.flag_method(scope.flag_scope(df, contract)))
    assert checked.count() == 4
    covered = scope.coverage(checked, planned)
    assert collected(scope.missing_parameters(covered)) == [("st", "Solo", "a", "Pb")]
    assert collected(scope.extra_parameters(covered)) == [("st", "Solo", "a", "Bz")]
    assert collected(scope.sample_summary(covered)) == [("st", "Solo", "a", "Bz", "Pb", "Zz", 3, 1, 1, 1)]
    flagged = {r.parametroCorrigido: (r.flag_parametro_fora_escopo, r.flag_metodo) for r in checked.where("alternate_name = 'st'").collect()}
    assert flagged == {"Fe": (None, None), "Bz": (None, scope.OTHER_METHOD), "Zz": (scope.OUT_OF_SCOPE, None)}
    totals = scope.validation_totals(checked).first().asDict()
    assert totals == {"stations": 1, "samples": 2, "results": 4, "late": 0, "outside": 1, "method": 1}


# --- quality -------------------------------------------------------------------------------------------------

SCHEMA = "sample_name string, chemical_name string, samp_matrix string, value double, quality_code string, quantification_limit double"
WATER = "Agua Subterranea"


def _qc_rows(rows):
    rng = random.Random(11)
    names = ["Ferro Total (mg/L)", "Ferro Dissolvido (mg/L)", "Zinco Total", "Zinco Dissolvido", "DBO (mg/L)", "DQO (mg/L)",
             "Cromo Dissolvido (mg/L)", "Cromo Hexav Dissolvido (mg/L)", " Cromo Hexavalente (mg/L) ", "Cromo Total (mg/L)",
             "2.6-Dibromofenol (%)", "Ferro Total Dissolvido"]
    data = []
    for i in range(1200):
        sample = "hot" if i % 3 == 0 else f"s{rng.randrange(40)}"
        value = None if rng.random() < 0.05 else float(rng.randrange(0, 130))
        data.append((sample if rng.random() > 0.02 else None, rng.choice(names),
                     rng.choice([WATER, "Fase livre", "Solo"]), value, rng.choice(["BC", "N", None]), 60.0))
    return rows(SCHEMA, *data)


@pytest.mark.parametrize("mode", ["pair", "rows"])
def test_combined_checks_equal_the_single_ones(rows, mode):
    df = _qc_rows(rows).withColumn("id", F.monotonically_increasing_id())
    df = rows(df.schema, *[tuple(r) for r in df.collect()])
    rules = ProjectRules(campaigns=("c",), excluded_samples=("s1", "s2"))
    pairs = rows("original string, replica string", ("s3", "s4"), ("s3", "hot"), ("s5", "none"))
    single = quality.blank(quality.surrogate(df))
    single = quality.total_dissolved(single, rules.excluded_samples, mode)
    single = quality.oxygen_demand(single, mode=mode)
    single = quality.replica_rpd(quality.species_check(single, excluded_samples=rules.excluded_samples), pairs)
    both = quality_checks(df, rules, pairs, mode)
    assert collected(both, "id", *FLAGS) == collected(single, "id", *FLAGS)
    assert both.count() == df.count()
    tally = {r.check: (r.examined, r.flagged) for r in quality_summary(both, rules).collect()}
    assert all(hit > 0 for _, hit in tally.values())
    view = quality.flagged(both, FLAGS)
    assert view.count() == sum(hit for _, hit in tally.values())


def test_pairs_against_brute_force(rows):
    df = _qc_rows(rows)
    data = [r for r in df.collect() if r.sample_name and r.value is not None and r.samp_matrix != "Solo"]
    fails = {
        d.sample_name for d in data for t in data
        if d.sample_name == t.sample_name and d.chemical_name.startswith("DBO") and t.chemical_name.startswith("DQO")
        and d.value > t.value
    }
    got = quality.oxygen_demand(df).where("flag_dbo_dqo is not null").select("sample_name").distinct()
    assert {r[0] for r in got.collect()} == fails


def test_species_lists_every_broken_rule(rows):
    def sample(name, d, hd, h, t):
        names = ["Cromo Dissolvido (mg/L)", "Cromo Hexav Dissolvido (mg/L)", "Cromo Hexavalente (mg/L) ", "Cromo Total (mg/L)"]
        return [(name, n, WATER, v, None, None) for n, v in zip(names, (d, hd, h, t))]

    df = rows(SCHEMA, *sample("ok", 1.0, 1.0, 1.0, 1.0), *sample("one", 2.0, 1.0, 1.0, 1.0), *sample("all", 3.0, 4.0, 2.0, 1.0))
    got = {r.sample_name: r.flag_cromo for r in quality.species_check(df).collect()}
    assert got["ok"] is None and got["one"] == "Dissolvido > Total"
    assert got["all"].count(";") == 3


def test_replicas_and_parents(rows):
    df = rows("sample_name string, chemical_name string, value double, parent string",
              ("o", "Fe", 10.0, None), ("r", "Fe", 12.3, "o"), ("o", "Pb", 10.0, None), ("r", "Pb", 12.2, "o"),
              ("x", "Fe", 99.0, None), ("o", "Zn", 0.0, "o"), ("r", "Zn", 0.0, "o"))
    pairs = quality.replica_pairs(df)
    assert collected(pairs) == [("o", "r")]
    flagged = quality.replica_rpd(df, pairs).where("flag_rpd is not null")
    assert collected(flagged, "sample_name", "chemical_name", "flag_rpd") == [("o", "Fe", "RPD > 20%"), ("r", "Fe", "RPD > 20%")]


# --- outputs -------------------------------------------------------------------------------------------------


def test_every_row_is_routed(rows):
    df = rows(
        "flag_padronizacao string, flag_station_sem_mapeamento string, flag_parametro_fora_escopo string, flag_metodo string,"
        " flag_holding_time string, i int",
        (None, None, None, None, None, 1), (None, None, "x", "m", "h", 2), (None, "s", None, None, " ", 3),
        (parameters.UNMAPPED, "s", "x", "m", "h", 4),
    )
    got = defaultdict(set)
    for r in outputs.route(df).collect():
        got[r.i].add(r.output)
    assert got == {1: {"api_validado"}, 2: {"api_validado", "parametro_extra", "metodo", "holding"},
                   3: {"erro_sampleName"}, 4: {"erro_mapeamento"}}


def test_projection_and_names(rows):
    df = rows("`a b` string, c string", ("x", "y"))
    assert outputs.sanitize(df, "§").columns == ["a§b", "c"]
    assert collected(outputs.project_output(df, [("o", "c"), ("p", "absent"), ("q", None)])) == [("y", "", "")]


def test_log(spark, tmp_path, rows):
    first = [runlog.step("Mapeamento de parametros", 10, flags={"flag_a": 2, "flag_b": 0}, note="detail"),
             runlog.filter_step("Filtro", 10, 0)]
    assert first[0]["flags"] == "flag_a(2)" and first[0]["status"] == "Aviso" and first[1]["status"] == "Aviso"
    path = str(tmp_path / "log")
    runlog.append_log(runlog.step_rows(spark, first, "P", "clean", "2026-01-01"), path)
    second = [runlog.step("Mapeamento de parametros", 7), *runlog.total_steps(
        {"samples": 3, "results": 7, "stations": 2, "late": 1, "outside": 0, "method": 4})]
    runlog.append_log(runlog.step_rows(spark, second, "P", "clean", "2026-01-08"), path)
    runlog.append_log(runlog.step_rows(spark, second, "Q", "clean", "2026-01-08"), path)
    log = runlog.read_log(spark, path, "P")
    assert log.count() == 9
    with pytest.warns(UserWarning, match="not written"):
        assert not runlog.append_log(log, path, fmt="no-such-format")
    card = runlog.delivery_summary(log, "src_20260823_20260830_20260831_0700").first().asDict()
    assert card == {
        "projeto": "P", "mapeamento_status": "Sucesso", "mapeamento_detalhe": "", "qtd_amostras": 3, "qtd_resultados": 7,
        "qtd_stations": 2, "qtd_holding_fora_prazo": 1, "qtd_parametro_extra": 0, "qtd_metodo_divergente": 4,
        "periodo_execucao": "23/08/2026 a 30/08/2026",
    }
    empty = runlog.delivery_summary(runlog.step_rows(spark, first[1:], "R", "x", "t")).first()
    assert empty.mapeamento_status == "Nao encontrado" and empty.qtd_amostras == 0
    df = rows("flag_a string", ("x",), (None,))
    observed, watched = runlog.observe_counts(df, "write")
    assert outputs.write_if_any(observed, str(tmp_path / "t"))
    assert runlog.observed_step("write", watched)["flags"] == "flag_a(1)"
