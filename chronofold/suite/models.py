"""Queries that fit vectors and models."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators.select import hash_split
from chronofold.plans.enrich import with_type_vectors
from chronofold.plans.features import boosted_trees, event_type_vectors, fit_variance_pca, least_squares, project, scores
from chronofold.suite.base import Tables, query
from chronofold.suite.timelines import built_events

FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


@query("N4 M9", None)
def embeddings_reduced(t: Tables) -> DataFrame:
    """Embeddings projected on the components that explain 90 % of the variance."""
    vectors = t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("_v"))
    model, count = fit_variance_pca(vectors, "_v")
    return project(vectors, model, count).select("vec_id", F.size("vector").alias("components"), "vector")


@query("N4 J18", None)
def events_with_vectors(t: Tables) -> DataFrame:
    """Rows and vector size per event type of all built timelines."""
    vectors = event_type_vectors(t.spark)
    events = with_type_vectors(built_events(t).select("matchId", "eventId", "type"), vectors)
    return events.groupBy("type", F.size("type_embeddings").alias("components")).count()


@query("M6 M7 M5", None)
def price_by_trees(t: Tables) -> DataFrame:
    """R2 and RMSE of boosted trees that predict the price of a line."""
    lines = hash_split(t.lineitem, "l_orderkey", "l_linenumber")
    model, _ = boosted_trees(lines.where("split = 'train'"), FEATURES, "l_extendedprice")
    return scores(model, lines.where("split = 'test'"), FEATURES, "l_extendedprice")


@query("M6", None)
def price_importances(t: Tables) -> DataFrame:
    """Feature importances sorted by name."""
    return boosted_trees(t.lineitem, FEATURES, "l_extendedprice")[1]


@query("M8", """
SELECT 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity), 3) AS coefficient FROM lineitem
UNION ALL SELECT 'const', round(regr_intercept(l_extendedprice, l_quantity), 3) FROM lineitem
""")
def price_by_quantity(t: Tables) -> DataFrame:
    """Least squares of price on quantity with a constant."""
    fit = least_squares(t.lineitem, ["l_quantity"], "l_extendedprice")
    return fit.select("term", F.round("coefficient", 3).alias("coefficient"))


@query("M8", None)
def price_by_all(t: Tables) -> DataFrame:
    """Least squares on all features with errors, t and p values."""
    return least_squares(t.lineitem, FEATURES, "l_extendedprice")
