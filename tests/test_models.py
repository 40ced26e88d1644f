"""Models are fitted as the method says, on every row."""

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from chronofold.operators.select import hash_split
from chronofold.plans.features import assembled
from chronofold.suite import REGISTRY, models


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """600 lines whose price follows their quantity and number."""
    at, c = str(tmp_path_factory.mktemp("lines")), F.col
    spark.range(0, 600, 1, 1).select(
        (c("id") / 4).cast("long").alias("l_orderkey"), (c("id") % 4 + 1).cast("int").alias("l_linenumber"),
        (c("id") * 7 % 50 + 1).cast("double").alias("l_quantity"), (c("id") * 3 % 11 / 100).alias("l_discount"), (c("id") * 5 % 9 / 100).alias("l_tax"),
    ).withColumn("l_extendedprice", c("l_quantity") * 1000 + c("l_linenumber") * 300).write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.fixture
def fits(monkeypatch):
    """Trees and rows of every fit of a query."""
    seen = []

    def counted(train, *args, real=models.boosted_trees, **named):
        model, importances = real(train, *args, **named)
        seen.append((model.getNumTrees, train.count()))
        return model, importances

    monkeypatch.setattr(models, "boosted_trees", counted)
    return seen


def thirty_trees(rows):
    return GBTRegressor(maxIter=30, maxDepth=7, stepSize=0.05, featureSubsetStrategy="log2", seed=42).fit(assembled(rows, models.FEATURES, "l_extendedprice"))


def test_price_by_trees_fits_all_rounds(spark, folder, fits):
    """Scores are those of the method's 30 trees of every line of the train side, on every line of the test side."""
    got = REGISTRY["price_by_trees"].run(spark, folder).first()
    sides = hash_split(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_orderkey", "l_linenumber")
    train, test = (sides.where(F.col("split") == side) for side in ("train", "test"))
    assert fits == [(30, train.count())] and train.count() + test.count() == 600
    shown = thirty_trees(train).transform(assembled(test, models.FEATURES, "l_extendedprice")).select("label", "prediction").collect()
    mean = sum(r.label for r in shown) / len(shown)
    missed, spread = (sum((r.label - x) ** 2 for r, x in zip(shown, given)) for given in ([r.prediction for r in shown], [mean] * len(shown)))
    assert got.rmse == pytest.approx((missed / len(shown)) ** 0.5) and got.r2 == pytest.approx(1 - missed / spread)


def test_price_importances_come_from_all_rounds(spark, folder, fits):
    """Importances are those of the method's 30 trees of every line, sorted by name."""
    got = [tuple(r) for r in REGISTRY["price_importances"].run(spark, folder).collect()]
    assert fits == [(30, 600)]
    wanted = thirty_trees(spark.read.parquet(f"{folder}/lineitem.parquet")).featureImportances.toArray()
    assert got == [(name, pytest.approx(float(x))) for name, x in sorted(zip(models.FEATURES, wanted))]
