"""The pipeline: every stage against its operator on the same input, whole results, odd rows."""

import corpus_pipeline as P
from cohort_engine.llm.decontaminate import contamination
from cohort_engine.llm.near_duplicates import near_duplicates
from cohort_engine.llm.quality import score_quality
from cohort_engine.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_take_effect_in_order(spark, tmp_path):
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    keeps = [lambda d: score_toxicity(d, labels).where("predicted = 0"), lambda d: score_quality(d, labels).where("predicted = 1"),
             lambda d: near_duplicates(d).where("kept"), lambda d: contamination(d, bench).where("NOT contaminated")]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "quality classifier", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    for k, ((name, stage), keep) in enumerate(zip(P.STAGES, keeps)):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns == docs.columns and ids(after) == ids(keep(docs)), name
        docs = after
    packed = P.STAGES[4][1](spark, docs, SF)
    whole = P.run(spark, SF)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, whole.collect()))
    assert set(ids(packed)) == set(ids(docs))


def test_odd_documents(spark):
    docs = spark.createDataFrame([(None, "a b c d e", "x", None, 1), (1, None, None, "s", 2), (2, "", "en", "s", 3), (3, "a b c d e", "en", "s", 3),
                                  (4, "a b c d e", "en", "s", 3), (4, "a b c d e", "en", "s", 3)], "doc_id long, text string, lang string, source string, _rejected long")
    assert ids(P.drop_near_duplicates(spark, docs, SF)) == [1, 2, 3]
    twice = docs.where("doc_id <= 2").unionByName(docs.where("doc_id <= 2"))
    assert ids(P.drop_near_duplicates(spark, twice, SF)) == [1, 2]
    for _, stage in P.STAGES[:4]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        got.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_rows_are_decided_by_id_and_text(spark):
    """A rejected text takes no other text of its id along; rows without id are rejected like others."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").first().text
    docs = spark.createDataFrame([(None, bench, "en", "s", 1), (None, "short and clean", "en", "s", 1), (5, bench, "en", "s", 1), (5, "clean as well", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = P.drop_contaminated(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == [("5", "clean as well"), ("None", "short and clean")]
    gone = P.without(docs, P.keyed(docs).where("text = 'clean as well'"))
    assert gone.count() == 3 and gone.columns == docs.columns
