"""Training, storage, scoring and their switches."""

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from checks import catalog
from checks import tables as T
from cohortloom.operators import learning as L
from cohortloom.plans import scoring as PS
from cohortloom.plans import training as PT
from cohortloom.sources import load_model, save_model, write_predictions

FEW = L.BoostParams(max_iter=8, max_depth=4, max_bins=32)
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def frame(spark):
    built = PT.training_frame(
        T.tables(spark, SF), T.COHORTS, T.STRATA, settings=catalog.settings(spark)
    )
    return built.cache()


@pytest.fixture(scope="module")
def trained(frame, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return PT.train_pipeline(frame, FEW, path), path


def test_training_frame_columns(frame):
    first, last = PT.numeric_features()
    names = frame.columns
    assert names[:2] == list(PT.KEYS) and names[-1] == L.TARGET
    features = names[2:-1]
    hot = [c for c in features if c.startswith("comp_type_")]
    assert hot and features == [f for f in [*first, *hot, *last] if f in features]
    assert frame.count() == frame.na.drop().count()


def test_beats_the_mean(frame, trained):
    result, _ = trained
    metrics = result.metrics.first()
    assert metrics.rmse < frame.agg(F.stddev_pop(L.TARGET)).first()[0]
    assert metrics.r2 > 0
    assert metrics.adjusted_r2 < metrics.r2


def test_metrics_agree_with_spark_ml(frame, trained):
    result, _ = trained
    predicted = L.predict(frame, result.model)
    row = L.evaluate(predicted, len(result.features)).first()
    for name, value in (("r2", row.r2), ("rmse", row.rmse)):
        evaluator = RegressionEvaluator(labelCol=L.TARGET, metricName=name)
        assert value == pytest.approx(evaluator.evaluate(predicted), abs=1e-9)


def test_importance_names_every_feature(trained):
    result, _ = trained
    rows = result.importance.collect()
    assert {r.feature for r in rows} == set(result.features)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)


def test_saved_model_predicts_the_same(frame, trained):
    result, path = trained
    model, features = load_model(path)
    assert features == result.features
    gap = (
        L.predict(frame, result.model)
        .select(*PT.KEYS, F.col(L.PREDICTION).alias("p"))
        .join(L.predict(frame, model).select(*PT.KEYS, L.PREDICTION), list(PT.KEYS))
        .agg(F.max(F.abs(F.col("p") - F.col(L.PREDICTION))))
    )
    assert gap.first()[0] == 0.0


def test_score_pipeline_writes_every_levy_account(spark, trained, tmp_path):
    _, path = trained
    out = str(tmp_path / "scored")
    scored = PS.score_pipeline(
        T.tables(spark, SF), T.AS_OF, path, out, settings=catalog.settings(spark)
    )
    assert scored.filled == []
    written = spark.read.option("header", True).csv(out)
    assert written.columns == ["account_id", "levy_model_prediction"]
    levy = T.accounts(spark, SF).where("a1 = 1")
    assert written.count() == levy.count() == written.select("account_id").distinct().count()


def test_score_sample(spark, trained):
    _, path = trained
    scored = PS.score_pipeline(
        T.tables(spark, SF), T.AS_OF, path, n=7, settings=catalog.settings(spark)
    )
    assert scored.predictions.count() == 7


def test_compat_scoring_fills_and_inverts_with_two(spark, trained):
    result, _ = trained
    frame = PS.score_frame(
        T.tables(spark, SF), T.AS_OF, settings=catalog.settings(spark), compat=True
    )
    scored = PS.score(frame, result.model, result.features, compat=True)
    assert set(scored.filled) == set(PS.UNNAMED_IN_COMPAT) & set(result.features)
    aligned = PS.align_to_model(frame, result.features, compat=True).frame
    raw = {r.account_id: r.prediction for r in L.predict(aligned, result.model).collect()}
    got = scored.predictions.limit(50).collect()
    for row in got:
        assert row.levy_model_prediction == pytest.approx(math.pow(2, raw[row.account_id]) - 1)


def test_industry_code_goes_in_as_one_feature(spark, tmp_path):
    settings = catalog.settings(spark, industry=True)
    tables = T.tables(spark, SF)
    frame = PT.training_frame(tables, T.COHORTS, T.STRATA, settings=settings).cache()
    assert PT.CODE_COLUMN in frame.columns
    assert any(c.startswith("sic_section_") for c in frame.columns)
    path = str(tmp_path / "model")
    result = PT.train_pipeline(frame, L.BoostParams(max_iter=2, max_depth=3, max_bins=32), path)
    names = [r.feature for r in result.importance.collect()]
    assert set(names) - set(result.features) == {PT.CODE_COLUMN}
    metrics = result.metrics.first()
    width = result.model.width
    codes = frame.where(f"{PT.CODE_COLUMN} IS NOT NULL").select(PT.CODE_COLUMN).distinct().count()
    assert 1 < width - len(result.features) <= codes
    n = metrics["rows"]
    assert metrics.adjusted_r2 == pytest.approx(1 - (1 - metrics.r2) * (n - 1) / (n - width - 1))
    scored = PS.score_pipeline(tables, T.AS_OF, path, settings=settings)
    assert scored.predictions.where("levy_model_prediction IS NULL").count() == 0
    # A source without industry data still scores: the code is then of the category for others.
    plain = PS.score_pipeline(tables, T.AS_OF, path, settings=catalog.settings(spark))
    assert plain.predictions.count() == scored.predictions.count()


def test_unseen_and_missing_categories_are_none_of_those_known(spark):
    rows = [(float(i), "ab"[i % 2], 9.0 * (i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, f"x double, code string, {L.TARGET} double")
    model = L.train(df, ["x"], L.BoostParams(max_iter=1, max_depth=1), categorical=["code"])
    new = spark.createDataFrame(
        [(1.0, "c"), (1.0, None), (1.0, "a"), (1.0, "b")], "x double, code string"
    )
    unknown, missing, a, b = [r.prediction for r in L.predict(new, model).collect()]
    assert unknown == missing and a != b and unknown in (a, b)


def test_more_categories_than_bins(spark):
    rows = [(float(i % 7), f"c{i % 60}", float(i % 60)) for i in range(600)]
    df = spark.createDataFrame(rows, f"x double, code string, {L.TARGET} double")
    few = L.BoostParams(
        max_iter=3, max_depth=4, max_bins=16, step_size=0.8, categories="ordered"
    )
    model = L.train(df, ["x"], few, categorical=["code"])
    assert L.evaluate(L.predict(df, model), 2).first().r2 > 0.9


def test_missing_values_are_not_filled_for_scoring(spark, trained):
    result, _ = trained
    frame = PS.score_frame(T.tables(spark, SF), T.AS_OF, settings=catalog.settings(spark))
    aligned = PS.align_to_model(frame, result.features).frame
    without = frame.where("log_employees IS NULL").count()
    assert without and aligned.where("log_employees IS NULL").count() == without
    scored = PS.score(frame, result.model, result.features).predictions
    assert scored.where(f"{PS.PREDICTED} IS NULL OR isnan({PS.PREDICTED})").count() == 0


def test_scoring_a_list_of_accounts(spark, trained, tmp_path):
    _, path = trained
    tables, out = T.tables(spark, SF), str(tmp_path / "listed")
    ids = tables.accounts.where("a3 <= 40").select("a3")
    for _ in range(2):
        PS.score_pipeline(
            tables, T.AS_OF, path, out, settings=catalog.settings(spark), ids=ids, fmt="parquet",
            mode="overwrite",
        )
    expected = {r.a3 for r in tables.accounts.where("a3 <= 40 AND a1 = 1").collect()}
    assert {r.account_id for r in spark.read.parquet(out).collect()} == expected
    with pytest.raises(FileExistsError):
        PS.score_pipeline(tables, T.AS_OF, path, out, settings=catalog.settings(spark))


def test_training_on_a_list_of_accounts(spark):
    tables = T.tables(spark, SF)
    ids = tables.accounts.where("a3 <= 60").select("a3")
    scope = {"settings": catalog.settings(spark), "ids": ids}
    raw = PT.raw_training_frame(tables, T.COHORTS, T.STRATA, **scope)
    whole = PT.raw_training_frame(tables, T.COHORTS, T.STRATA, settings=catalog.settings(spark))
    columns = ["a3", "cohort", "total_commitments", L.TARGET]
    got = sorted(map(tuple, raw.select(columns).collect()))
    assert got and got == sorted(map(tuple, whole.where("a3 <= 60").select(columns).collect()))
    few = PT.raw_training_frame(tables, T.COHORTS, T.STRATA, n=1, **scope)
    assert {r.a3 for r in few.collect()} <= set(range(61))


def test_compat_null_share_is_dropped_as_constant(spark):
    settings = catalog.settings(spark, null_share="equals_null")
    frame = PT.training_frame(T.tables(spark, SF), T.COHORTS, T.STRATA, settings=settings)
    assert "occupation_null" not in frame.columns


def test_levy_accounts_only(spark):
    raw = PT.raw_training_frame(
        T.tables(spark, SF), T.COHORTS, T.STRATA, settings=catalog.settings(spark),
        levy_accounts_only=True,
    )
    assert raw.where("a1 <> 1").isEmpty() and not raw.isEmpty()


def test_split_by_account(frame):
    result = PT.train_pipeline(frame, L.BoostParams(max_iter=1, max_depth=2), split_key="account")
    assert result.metrics.first()["rows"] > 0


def test_empty_frame_is_an_error(frame):
    with pytest.raises(ValueError, match="no complete"):
        PT.train_pipeline(frame.limit(0))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, -0.5)], "account_id bigint, levy_model_prediction double")
    for fmt in ("csv", "parquet"):
        write_predictions(df, str(tmp_path / fmt), fmt)
    schema = "account_id bigint, levy_model_prediction double"
    csv = spark.read.option("header", True).schema(schema).csv(str(tmp_path / "csv"))
    assert sorted(csv.collect()) == sorted(df.collect())
    assert sorted(spark.read.parquet(str(tmp_path / "parquet")).collect()) == sorted(df.collect())
    with pytest.raises(ValueError, match="unknown format"):
        write_predictions(df, str(tmp_path / "x"), "xml")


def test_feature_order_survives_storage(trained, tmp_path):
    result, _ = trained
    names = [f"f{i}" for i in range(30, 0, -1)]
    save_model(result.model, names, str(tmp_path))
    assert load_model(str(tmp_path))[1] == names
