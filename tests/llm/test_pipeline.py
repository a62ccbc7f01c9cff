import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from areaday.llm import queries
from areaday.llm.registered import QUERIES
from areaday.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage was given and gave, on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs, out = queries.table(spark, sf, "documents"), []
    for name, stage in cp.STAGES:
        given, docs = docs, materialise(stage(spark, docs, sf))
        out.append((name, given, docs))
    return out


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, *_ in stages] == [name for name, _ in cp.STAGES]
    for _, given, kept in stages[:-1]:
        assert kept.columns == COLUMNS and kept.dtypes == given.dtypes
        assert ids(kept) <= ids(given) and kept.count() > 0.5 * given.count()


def test_toxic_documents_go(stages, spark, sf):
    _, given, kept = stages[0]
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 1").collect()}
    gone = ids(given) - ids(kept)
    assert len(gone & toxic) >= 0.7 * len(toxic & ids(given)) and len(gone - toxic) < 0.1 * given.count()


def test_each_line_stays_once(stages):
    _, given, kept = stages[1]
    before = [l.strip() for r in given.collect() for l in (r.text or "").split("\n")]
    after = [l.strip() for r in kept.collect() for l in (r.text or "").split("\n")]
    long = lambda lines: [l for l in lines if len(l) >= 40]
    assert len(set(long(after))) == len(long(after)) < len(long(before))
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_one_of_each_group_stays(stages):
    from areaday.llm.jaccard_join import jaccard_join

    _, given, kept = stages[2]
    assert ids(kept) == {r.component_id for r in jaccard_join(given).collect()}
    assert all(r.doc_id == r.component_id for r in jaccard_join(kept).collect())


def test_rows_without_an_id_or_with_a_repeated_one_leave_one_of_each_group(spark, documents, sf):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abc"}
    pairs = [(5, texts["a"]), (5, texts["a"]), (None, texts["a"]), (7, texts["a"] + " more"), (None, texts["b"]), (None, texts["b"]), (5, texts["c"]), (None, ""), (None, None)]
    docs = documents(pairs).withColumn("number", F.lit("x"))
    kept = cp.keep_one_of_each_group(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(5, texts["a"]), (None, texts["b"]), (5, texts["c"]), (None, ""), (None, None)], key=repr
    )


def test_contaminated_documents_go(stages, spark, sf):
    from areaday.llm.decontamination import contaminated, contamination, hit_words

    _, given, kept = stages[3]
    found = contamination(given, spark.read.parquet(f"{sf}/benchmark.parquet"))
    bad = {r.row.doc_id for r in found.filter(contaminated(hit_words(), F.col("n_words"))).collect()}
    assert ids(kept) == ids(given) - bad


def test_all_kept_documents_are_packed(stages, spark, sf):
    _, given, packed = stages[4]
    assert ids(packed) == ids(given)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.sum("n"), F.count("*")).first()
    assert full[0] <= 2048 and full[2] <= -(-full[1] // 2048) + 1
    assert sorted(map(str, cp.run(spark, sf).drop("sequence_id", "offset").collect())) == sorted(map(str, packed.drop("sequence_id", "offset").collect()))


def test_odd_documents_pass_through_all_stages(spark, documents, tmp_path, sf):
    docs = documents([(1, None), (2, ""), (3, "a" * 50_000), (None, "some text"), (4, "x"), (4, "x")]).withColumn("score", F.lit(1)).withColumn("row", F.lit("r"))
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{sf}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    for frame in (docs, docs.limit(0)):
        now = frame
        for _, stage in cp.STAGES:
            now = materialise(stage(spark, now, str(tmp_path)))
        assert now.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()


def test_registered_queries():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", [name for name, (_, sql) in QUERIES.items() if sql])
def test_query_equals_its_sql(spark, sf, name):
    import check

    query, sql = QUERIES[name]
    assert check.compare(query(spark, sf), check.duck(sf), sql) == []
