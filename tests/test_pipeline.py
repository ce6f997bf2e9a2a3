"""The reference's six checks, re-expressed on the KOI-shaped fixture."""

from pyspark.sql import functions as F

from conftest import SF
from kestrel.functions import features as fe
from kestrel.functions.expr import label_decode, label_encode
from kestrel.operators import prep
from kestrel.operators.schema import KOI_POLICY, policy_columns, surviving_forbidden
from kestrel.plans.fixtures import K_CLASSES, k_table


def _k_with_policy(spark):
    k = k_table(spark, SF)
    extra = [F.lit(1.0).alias(c) for c in policy_columns(KOI_POLICY)]
    return k.select("*", *extra)


def test_labels_in_allowed_set(spark):
    k = k_table(spark, SF)
    assert {r.label for r in k.select("label").distinct().collect()} <= set(K_CLASSES)
    assert k.filter(F.col("label").isNull()).count() == 0


def test_no_forbidden_column_survives(spark):
    df = _k_with_policy(spark)
    pre = prep.build_preprocessor(target="label").fit(df)
    out = pre.transform(df)
    assert surviving_forbidden(out, KOI_POLICY, "label") == []


def test_derivation_adds_named_columns(spark):
    out = fe.engineer(k_table(spark, SF))
    for name in ["koi_period_log", "duty_cycle", "depth_snr", "teq_class", "in_habitable_zone"]:
        assert name in out.columns


def test_preprocessor_finite_and_names_match_width(spark):
    df = k_table(spark, SF)
    pre = prep.build_preprocessor(target="label").fit(df)
    out = pre.transform(df)
    names = prep.feature_names(pre)
    assert out.columns == names
    bad = out.select(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in names]).first()
    assert all(v == 0 for v in bad)


def test_label_round_trip(spark):
    df = spark.createDataFrame([(c,) for c in K_CLASSES], "l string")
    back = df.select(label_decode(label_encode("l", K_CLASSES), K_CLASSES).alias("b")).collect()
    assert [r.b for r in back] == K_CLASSES


def test_three_column_row_transforms(spark):
    df = k_table(spark, SF)
    pre = prep.build_preprocessor(target="label").fit(df)
    one = spark.createDataFrame([(10.0, 500.0, 2.0)], "koi_period double, koi_depth double, koi_prad double")
    row = pre.transform(one).first()
    assert all(v is not None for v in row)
