"""Hot keys in filter joins, newest batches, the run ledger, appends, quarantine and chains."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from labtrail.operators import outputs, quality, samples
from labtrail.operators.conflicts import exclude_conflicts
from labtrail.operators.ledger import Ledger
from labtrail.operators.runlog import latest_step, read_log
from labtrail.rules import unit_factors
from labtrail.schemas import CORRECTIONS
from labtrail.sources import batches, quarantine
from labtrail.sources.lookups import read_rules
from labtrail.sources.paths import exists, scratch_folder


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- hot keys ------------------------------------------------------------------------------------------

HOT_CHECKS = {
    "conflicts": lambda df, pairs: exclude_conflicts(df, ["sample_name", "chemical_name"], "text"),
    "fractions": lambda df, pairs: quality.total_dissolved(df),
    "demand": lambda df, pairs: quality.oxygen_demand(df, "A", "B"),
    "species": lambda df, pairs: quality.species_check(df),
    "replicas": lambda df, pairs: quality.replica_rpd(df, pairs),
}


@pytest.mark.parametrize("name", HOT_CHECKS)
@pytest.mark.parametrize("together", [False, True])
def test_checks_spread_a_hot_key(spark, name, together):
    """Half the rows lie on one key, with or without something to tell; no task has over twice its share."""
    rows = spark.range(64_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 4001)).alias("sample_name"),
        F.when(F.col("id") % 4 < 2, F.lit("A Total")).otherwise(F.lit("A Total ")).alias("chemical_name"),
        F.lit("Fase livre").alias("samp_matrix"), F.col("id").cast("double").alias("value"), F.lit("x").alias("text"),
    )
    rows = rows.repartition(16, "sample_name") if together else rows.repartition(48)
    pairs = spark.createDataFrame([("s1", "s2")], "original string, replica string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        checked = HOT_CHECKS[name](rows, pairs)
        # all columns are looked at, so the join cannot be dropped
        seen = checked.select(F.spark_partition_id().alias("p"), F.xxhash64(*checked.columns).alias("h"))
        sizes = [r["n"] for r in seen.groupBy("p").agg(F.count("h").alias("n"), F.bit_xor("h")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 64_000 and max(sizes) <= 2 * 64_000 / 16


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_plans(spark):
    """Plans as they are before adaptive execution, all joins by hash."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _results(spark, tmp_path):
    rows = [(f"s{i % 7}", f"A {'Total' if i % 2 else 'Dissolvido'}", "Fase livre", float(i), str(i % 3)) for i in range(40)]
    schema = "sample_name string, chemical_name string, samp_matrix string, value double, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "rows"))
    spark.createDataFrame([(f"s{i}", f"s{i + 1}") for i in range(7)], "original string, replica string").write.parquet(str(tmp_path / "pairs"))
    return spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "pairs"))


@pytest.mark.parametrize("name", ["conflicts", "demand", "fractions", "species", "all"])
def test_verdicts_are_made_once(spark, tmp_path, plain_plans, name):
    """The results are read once for the verdicts and once to be told, not again for the hot keys."""
    df, pairs = _results(spark, tmp_path)
    checked = quality.cross_checks(df, pairs=pairs) if name == "all" else HOT_CHECKS[name](df, pairs)
    scans = [line for line in _plan(checked).splitlines() if "FileScan" in line and "original" not in line]
    assert len(scans) == 2


def test_station_names_do_not_read_the_results_again(spark, tmp_path, plain_plans):
    """The results meet the resolved names once; both sides of that join are shuffles, which Spark can split when a name is hot."""
    names = ["S_1 -Terc", "S_2 -Terc", "S_3 -Terc", "S_9 -Terc", None]
    columns = "descricaoAmostra string, matriz string, codigoEstacao string, codigoQualidade string"
    spark.createDataFrame([(n, "Solo", "x", "x") for n in names * 3], columns).write.parquet(str(tmp_path / "rows"))
    station = spark.createDataFrame(
        [("S-1", "ST-1", "Q1", "one"), ("S-2", "ST-2", None, "two"), ("S-2", None, None, "two"), (None, "ST-0", "Q0", "none")],
        "SampleName string, codigoEstacao string, codigoQualidade string, alternate_name string",
    )
    corrections = spark.createDataFrame(
        [("S-1", "S-2", "M", "by hand"), ("S-3", "S-1", None, None), (None, "S-1", "M", "by hand")],
        "descricaoAmostra_de string, descricaoAmostra_para string, codigoEstacao string, alternate_name string",
    )
    mapped = samples.map_samples(samples.clean_names(spark.read.parquet(str(tmp_path / "rows"))), station, corrections)
    plan = _plan(mapped)
    assert plan.count("FileScan") == 1
    last = plan[plan.index("SortMergeJoin") :]
    assert last.split("\n")[0].rstrip().endswith("LeftOuter") and "Exchange" in last.split("\n")[2]
    got = collected(mapped, "descricaoAmostra", "codigoEstacao", "codigoQualidade", "alternate_name", "descricaoAmostra_final")
    want = [("S-1", "ST-1", "Q1", "one", "S-2"), ("S-2", "ST-2", None, "two", "S-2"), ("S-3", "ST-1", "Q1", "one", "S-1"),
            ("S-9", None, None, None, "S-9"), (None, None, None, None, None)]
    assert got == sorted(want * 3, key=repr)


# --- newest batch --------------------------------------------------------------------------------------


def test_newest_batch_reads_its_own_folder_only(spark, tmp_path):
    """The files of all other batches are spoilt, so reading one of them would fail."""
    path = str(tmp_path / "table")
    names = [f"{s}_2026010{d}_0{h}30" for s in ("siteA", "siteB") for d in (1, 2, 3) for h in (1, 2)] + ["odd+name c_20260109"]
    for i, name in enumerate(names):
        outputs.write_batch(spark.range(i + 1), path, name)
    newest = {"siteA_20260103_0230", "siteB_20260103_0230", "odd+name c_20260109"}
    for file in glob.glob(f"{path}/*/*.parquet"):
        if not any(os.path.dirname(file).endswith(n.replace("+", "%2B").replace(" ", "%20")) for n in newest):
            with open(file, "wb") as out:
                out.write(b"junk")
    assert {r["batch_id"] for r in batches.batch_names(spark, path).collect()} == set(names)
    by = [batches.source_prefix(F.col("batch_id"))]
    schema = "id long, batch_id string"
    got = batches.read_latest(spark, path, by, schema=schema)
    assert {r["batch_id"]: r["n"] for r in got.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {
        n: names.index(n) + 1 for n in newest
    }
    assert {r["batch_id"] for r in batches.read_latest(spark, path, schema=schema).collect()} == {"odd+name c_20260109"}
    early = batches.read_latest(spark, path, by, before="a", schema=schema)
    assert early.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Subquery" in plan


# --- ledger --------------------------------------------------------------------------------------------


def test_ledger_counts_in_one_run(spark, tmp_path):
    ledger = Ledger("P", "stage", "2026")
    rows = ledger.watch(spark.range(100).withColumn("flag_x", F.when(F.col("id") % 10 == 0, "x")), "read", ["flag_x"])
    kept = ledger.filtered(rows, "even", lambda df: df.where("id % 2 = 0"), "read")
    none = ledger.filtered(kept, "none", lambda df: df.where("id < 0"), "even")
    tagged = ledger.watch(kept.withColumn("o", F.when(F.col("id") < 20, "a").otherwise("b")), "out", by=("o", ["a", "b", "c"]))
    tagged.unionByName(none.withColumn("o", F.lit("z"))).write.format("noop").mode("overwrite").save()
    assert ledger.counts()["out"] == {"rows": 50, "a": 10, "b": 40, "c": 0}
    log = str(tmp_path / "log")
    assert ledger.append(spark, log, strict=True)
    steps = {r.etapa: r for r in read_log(spark, log, "P").collect()}
    assert (steps["read"].registros_lidos, steps["read"].flags, steps["read"].status) == (100, "flag_x(10)", "Aviso")
    assert (steps["even"].registros_lidos, steps["even"].registros_escritos) == (100, 50)
    assert (steps["even"].observacoes, steps["even"].status) == ("50 registros descartados", "Sucesso")
    assert (steps["none"].registros_escritos, steps["none"].status) == (0, "Aviso")
    assert latest_step(read_log(spark, log, "P")).count() == 4


# --- writes --------------------------------------------------------------------------------------------


def test_write_counted_runs_the_plan_once(spark, tmp_path):
    path, runs = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 30, 1, 3).mapInArrow(counted, "id long").withColumn("flag_a", F.when(F.col("id") < 7, "a"))
    assert outputs.write_counted(rows, path, flags=["flag_a"]) == {"rows": 30, "flag_a": 7}
    assert runs.value == 30 and spark.read.parquet(path).count() == 30
    assert outputs.write_counted(rows.where("id < 0"), path) == {"rows": 0}
    assert spark.read.parquet(path).count() == 30
    assert outputs.write_counted(rows.limit(0), str(tmp_path / "u")) == {"rows": 0}
    assert sorted(os.listdir(tmp_path)) == ["t"]
    members = {"some": rows, "none": rows.where("id < 0")}
    assert outputs.export_bundle(members, str(tmp_path / "b")) == ["some"]
    assert os.listdir(tmp_path / "b") == ["some"]


def test_append_new_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *k: spark.createDataFrame([(x, 1) for x in k], "k string, v int")
    for some, batch in ((("a", "b"), "one"), (("a", "b"), "one"), (("b", "c", None), "two"), (("a", "c"), "three")):
        outputs.append_new(rows(*some), path, ["k"], batch)
    got = spark.read.schema("k string, v int, batch_id string").parquet(path)
    assert collected(got, "k", "batch_id") == sorted([("a", "one"), ("b", "one"), ("c", "two"), (None, "two")], key=repr)


# --- rule tables ---------------------------------------------------------------------------------------


def test_rules_that_are_not_there(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "heads.csv").write_text("unit_from,unit_to,factor\n")
    (tmp_path / "some.csv").write_text(" unit_from ,unit_to,factor,more\nmg,g,0.001,x\nkg,g,many,\n", encoding="utf-8")
    (tmp_path / "other.csv").write_text("unit_from,x\na,b\n")
    (tmp_path / "folder").mkdir()
    wanted = {c: [c] for c in ("unit_from", "unit_to", "factor")}
    read = lambda name: read_rules(spark, f"{tmp_path}/{name}", wanted, {"note": ["note"]}, types={"factor": "double"})
    for name in ("absent.csv", "empty.csv", "heads.csv", "folder"):
        assert read(name).collect() == [] and read(name).schema == read("some.csv").schema
    assert collected(read("some.csv")) == [("kg", "g", None, None), ("mg", "g", 0.001, None)]
    assert [f.dataType for f in read("heads.csv").schema][2] == unit_factors(spark).schema["factor"].dataType
    with pytest.raises(ValueError, match="unit_to.*factor"):
        read("other.csv")


# --- quarantine ----------------------------------------------------------------------------------------


def test_documents_that_cannot_be_read(spark, tmp_path):
    for name, text in {
        "a": '{"amostras": [{"idAmostra": "1", "parametros": [{"parametroOriginal": "Fe"}]}]}', "b": '{"amostras": [{"idAmos',
        "c": '{"amostras": []}', "d": "{}", "e": "", "f": '{"amostras": null}',
    }.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = quarantine.read_documents(spark, str(tmp_path))
    assert [r.amostras[0].idAmostra for r in good.collect()] == ["1"] and good.columns == ["amostras"]
    lane = {os.path.basename(r.file): (r.reason, r.record) for r in bad.collect()}
    assert lane.pop("b.json") == (quarantine.NOT_A_DOCUMENT, '{"amostras": [{"idAmos')
    assert {r for r, _ in lane.values()} <= {quarantine.NO_SAMPLES, quarantine.NOT_A_DOCUMENT} and set(lane) >= {"c.json", "d.json", "f.json"}
    quarantine.require_some(good, "documents")
    with pytest.raises(ValueError, match="nothing could be read"):
        quarantine.require_some(good.where("false"), "documents")


def test_rows_with_other_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a, b ,c\n1,2,3\n1,2\n"x\ny",5,\n1,2,3,4\n,,\n', encoding="utf-8")
    good, bad = quarantine.read_sheet(spark, str(tmp_path / "s.csv"))
    assert collected(good) == sorted([("1", "2", "3"), ("x\ny", "5", None), (None, None, None)], key=repr)
    assert collected(good, "a") == sorted([("1",), ("x\ny",), (None,)], key=repr)
    assert good.columns == ["a", "b", "c"]
    assert sorted(r.record for r in bad.collect()) == ["1,2", "1,2,3,4"] and bad.count() == 2
    assert {r.reason for r in bad.collect()} == {quarantine.OTHER_CELLS}


def test_batches_that_cannot_be_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in ("a_1", "b_1", "c_1"):
        outputs.write_batch(spark.range(5000).select("id", F.uuid().alias("text")).coalesce(1), path, name)
    schema = "id long, text string, batch_id string"
    good, bad = quarantine.read_batches(spark, path, schema)
    assert good.count() == 15_000 and bad.count() == 0
    (junk,) = glob.glob(f"{path}/batch_id=b_1/*.parquet")
    with open(junk, "r+b") as out:
        out.truncate(1000)
    (torn,) = glob.glob(f"{path}/batch_id=c_1/*.parquet")
    with open(torn, "r+b") as out:
        out.seek(4)
        out.write(b"\xff" * 60_000)
    for file in (junk, torn):
        os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    good, bad = quarantine.read_batches(spark, path, schema)
    assert {r["batch_id"]: r["n"] for r in good.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {"a_1": 5000}
    assert {os.path.basename(r.file): r.reason for r in bad.collect()} == {
        os.path.basename(junk): quarantine.UNREADABLE, os.path.basename(torn): quarantine.PARTLY
    }
    assert quarantine.lane_summary(quarantine.lanes(bad, bad)).count() == 2


# --- chains --------------------------------------------------------------------------------------------


def test_chains_lead_to_their_first_sample(spark):
    chance = random.Random(3)
    links = [(f"c{i}", f"c{i - 1}") for i in range(1, 400)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x")]
    links += [("self", "self"), ("none", None), ("blank", " "), ("two", "b"), ("two", "a"), ("orphan", "gone")]
    links += [(f"t{i}", f"t{chance.randrange(i)}") for i in range(1, 200)]
    up = {}
    for name, to in links:
        if to and to.strip() and to != name:
            up[name] = min(to, up.get(name, to))

    def ends(name):
        steps, met = 0, set()
        while name in up and name not in met:
            met.add(name)
            name, steps = up[name], steps + 1
        return (None, None, True) if name in met else (name, steps, False)

    df = spark.createDataFrame(links * 2, "sample_name string, parent string")
    got = {r["sample_name"]: (r["first"], r["steps"], r["cycle"]) for r in samples.first_samples(df).collect()}
    assert got == {name: ends(name) for name in up}
    assert samples.first_samples(df.limit(0)).count() == 0


def test_scratch_folders(spark):
    a, b = (scratch_folder(spark, "x") for _ in range(2))
    assert a != b and not exists(spark, a)
    assert [f.name for f in CORRECTIONS][0] == "descricaoAmostra_de"


def test_delivery_formats_dates_once_per_order(spark, tmp_path):
    """The cells of an order are written before it is repeated for its matrices (F2)."""
    from labtrail.catalog.runs import delivery

    for name, rows, schema in (
        ("orders", [(6, 1, "F", "2024-03-09 17:20:00", "1-HIGH")],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string"),
        ("lineitem", [], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double,"
         " l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        ("part", [], "p_partkey long, p_type string, p_size long"),
    ):
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    samples = delivery(spark, str(tmp_path))[0]
    cells = samples.select("Nome Amostra", "Data Coleta", "Data Recebimento Lab", "Matriz Monit").collect()
    expected = ("S_6 -Terc", "2024-03-09 10:30:00", "15/03/2024 08:15")
    assert sorted(tuple(r) for r in cells) == [(*expected, m) for m in ("ASUB", "LNAPL", "SO")]
    plan = samples._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan[: plan.index("Generate")]


def test_chains_stop_where_only_circles_are_left(spark, monkeypatch):
    """Rounds follow the longest chain, not the number of links, though a circle never ends (F6)."""
    folders, real = [], samples.scratch_folder
    monkeypatch.setattr(samples, "scratch_folder", lambda *a: folders.append(a) or real(*a))
    links = [(f"a{i}", f"a{i - 1}") for i in range(1, 6)] + [("x", "y"), ("y", "x"), ("z", "x")]
    links += [(f"b{i}", "root") for i in range(300)]
    found = samples.first_samples(spark.createDataFrame(links, "sample_name string, parent string")).collect()
    told = {r["sample_name"]: (r["first"], r["steps"], r["cycle"]) for r in found}
    expected = {f"a{i}": ("a0", i, False) for i in range(1, 6)} | dict.fromkeys("xyz", (None, None, True))
    assert told == expected | {f"b{i}": ("root", 1, False) for i in range(300)}
    assert len(folders) == 6  # the links, four rounds until a5 has arrived, one that brings nobody


def test_originals_with_many_replicas_lie_with_the_others(spark):
    """Pairs of frequent and rare originals, repeated, absent and null ones, against brute force; entries travel slim (F8)."""
    rng = random.Random(8)
    rows = [(f"s{i}", f"p{p}", rng.choice([None, 0.0, 1.0, 1.5, 9.0])) for i in range(60) for p in rng.sample(range(6), 3)]
    pairs = [("s0", f"s{i}") for i in range(1, 40)] + [("s1", "s2")] * 3 + [(f"s{i}", f"s{i + 1}") for i in range(2, 62)]
    pairs += [("none", "s3"), ("s3", "none"), (None, "s4")]
    df = spark.createDataFrame(rows, "sample_name string, chemical_name string, value double")
    paired = spark.createDataFrame(pairs, "original string, replica string")
    held = {}
    for s, p, v in rows:
        held.setdefault(s, {})[p] = v

    def differs(a, b):
        return a is not None and b is not None and (a or b) and round(abs(a - b) / ((a + b) / 2) * 100, 2) > 20

    both = {(a, b, p) for a, b in pairs for p in {*held.get(a, {}), *held.get(b, {})}}
    got = quality.replica_differences(df, paired).collect()
    assert len(got) == len(both)
    assert {(r[0], r[1], r[2]): (r[3], r[4]) for r in got} == {
        (a, b, p): (held.get(a, {}).get(p), held.get(b, {}).get(p)) for a, b, p in both
    }
    off = {(s, p) for a, b, p in both if differs(held.get(a, {}).get(p), held.get(b, {}).get(p)) for s in (a, b)}
    told = quality.replica_rpd(df, paired)
    assert {(r[0], r[1]) for r in told.where("flag_rpd IS NOT NULL").collect()} == off and told.count() == len(rows)
    plan = quality._differences(quality.sample_profiles(df.withColumn("samp_matrix", F.lit("Solo"))), paired, "inner")
    assert "arrays_zip(" in plan._jdf.queryExecution().optimizedPlan().toString()
