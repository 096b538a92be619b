"""Every text query against its SQL, or for its rows, on the smallest tables."""

import os

import oracle
import pytest

from labtrail.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op1_url_filters", "op3_quality_rules", "op9_license_scans"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline_keeps_what_its_stages_keep(spark):
    """Stage by stage against plain versions: accepted, first of equal texts, spread over sequences."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = p.keep_good(spark, docs, SF_DIR)
    assert good.columns == docs.columns
    good_ids = {r.doc_id for r in good.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in good_ids for d in clean) >= 0.98 * len(clean)

    single = p.drop_copies(spark, good, SF_DIR)
    first = {}
    for d in sorted(good_ids):
        first.setdefault(" ".join(_words(texts[d])), d)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    near = p.drop_near_copies(spark, single, SF_DIR)
    classes = brute_classes({d: texts[d] for d in first.values()})
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for c, _ in classes.values()})

    mixed = p.mix_sources(spark, near, SF_DIR)
    assert mixed.columns == docs.columns
    packed = p.pack_sequences(spark, mixed, SF_DIR).collect()
    assert sum(r.piece == 0 for r in packed) == mixed.count()


def _words(text):
    import re

    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def brute_classes(texts):
    """doc_id -> (class_id, n_links), all pairs compared."""
    sets = {}
    for d, text in texts.items():
        w = _words(text)
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    root, links = {d: d for d in ids}, dict.fromkeys(ids, 0)

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (find(d), links[d]) for d in ids}


CLASHING = ("size", "copies", "Source_Size", "target", "kept", "class_id", "N_LINKS", "keep_id", "predicted", "score", "__row", "__at", "a.b")


def test_pipeline_hands_on_any_column(spark, tmp_path):
    """Extra columns named like what operators add, nulls in all columns, empty, repeated and long texts."""
    import corpus_pipeline as p
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(40)
    odd = [(None, None, None, None, None), (900, "", "xx", "s", 0), (900, "", "xx", "s", 0), (901, "word " * 30_000, None, None, 9)]
    odd += [(None, "some words without an id, but good ones all the same", "en", None, None)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    more = {c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING}
    docs = docs.select("*", *[v.alias(c) for c, v in more.items()])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    given = {tuple(r) for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = [tuple(r) for r in out.collect()]
        assert rows and set(rows) <= given, name
        if "mix" not in name:
            docs = spark.createDataFrame(rows, docs.schema)
    packed = p.run(spark, str(tmp_path)).collect()
    assert packed and all(r.length > 0 for r in packed)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as p

    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in p.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).collect() == []
    assert p.run(spark, str(tmp_path)).collect() == []
