"""Wide tables, missing markers, batch centring on one path, frozen statistics."""

import numpy as np
import pytest

from cohort_engine.operators import columns as C
from cohort_engine.operators import prep as P
from cohort_engine.operators import select as S
from cohort_engine.operators import stats as A
from cohort_engine.plans.pipeline_prep import Preparer
from cohort_engine.sources.tables import read_csvs
from cohort_engine.sources.validate import coerce, violations


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(0)
    p, n = 1000, 12
    cols = [f"m{i}" for i in range(p)]
    x = rng.normal(size=(n, p))
    x[6:, 7] += 50
    rows = [(i, int(i >= 6), float(i % 2), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "patient_id long, response int, batch double, " + ", ".join(f"{c} double" for c in cols)).coalesce(2).persist()
    assert violations(df).count() == 0 and A.has_negative(df, cols)
    preparer = Preparer(cols)
    model, out = preparer.fit(coerce(df))
    assert model.normalizer.use_zscore and len(out.columns) == p + 3
    assert S.anova_ranking(out, cols)[0] == "m7"
    preparer.release()
    df.unpersist()


def test_markers_are_missing(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Patient_ID,response,age,sex,b1,b2\n1,1,NA,M,0.5,nan\n2,0,nan,null,n/a,1\n3,1,-4,F,x,2\n")
    df = read_csvs(spark, str(path))
    assert {(r.row_id, r.column_name) for r in violations(df).collect()} == {("3", "age"), ("3", "b1")}
    got = {r.patient_id: r for r in coerce(df).collect()}
    assert got["1"].age is None and got["1"].b2 is None and got["2"].sex is None and got["2"].b1 is None and got["2"].age is None


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1, 1, float("nan"), 5.0), (2, 0, 40.0, float("nan")), (3, 0, 30.0, 5.0)], "patient_id long, response int, age double, c double")
    assert violations(df).count() == 0
    assert coerce(df).where("age IS NULL").count() == 1
    assert {r.feature: r.is_constant for r in C.constant_columns(df, ["age", "c"]).collect()} == {"age": False, "c": True}


def test_response_beyond_int_is_a_failure(spark):
    df = spark.createDataFrame([("1e12",), ("1",)], "response string")
    assert [r.failure_case for r in violations(df).collect()] == ["1e12"]
    assert sorted(str(r.response) for r in coerce(df).collect()) == ["1", "None"]


@pytest.mark.parametrize("batches", [2, 400])
def test_batch_centring(spark, batches):
    rng = np.random.default_rng(1)
    rows = [(i, None if i % 11 == 0 else float(i % batches), float(rng.normal()), None if i % 5 == 0 else float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "patient_id long, batch double, a double, b double")
    out, mom = P.batch_center(df, ["a", "b"], "batch", with_moments=True)
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=["patient_id", "batch", "a", "b"]).astype({"b": float})
    got = out.toPandas().set_index("patient_id").sort_index()
    for c in ("a", "b"):
        want = pdf[c] - pdf.groupby("batch", dropna=False)[c].transform("mean")
        assert np.allclose(got[c].astype(float), want, equal_nan=True)
        assert abs(mom[c][1] - np.nanstd(want)) < 1e-9
    apart = P.correct_batches(df.drop("batch"), ["a", "b"], df.select("patient_id", "batch")).toPandas().set_index("patient_id").sort_index()
    assert np.allclose(apart["a"], got["a"]) and "batch" not in apart.columns


def test_wrong_checkpoint_setting_is_an_error(spark):
    from cohort_engine.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere"
        class _jsc:
            @staticmethod
            def sc():
                class D:
                    @staticmethod
                    def getCheckpointDir():
                        class O:
                            isDefined = staticmethod(lambda: False)
                        return O
                return D

    class Session:
        sparkContext = Context
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)
