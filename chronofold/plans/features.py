"""Feature tables and models on enriched events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, HashingTF, StandardScaler, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.lanes import DEFAULT_MAX_ROWS, Lane, following, known_after, running_sum
from chronofold.operators.select import dealt
from chronofold.plans.schemas import PLAYERS

FRAME_EVENT = "PARTICIPANT_FRAME"

# Events that give experience, and the ward that does.
XP_EVENTS = (
    "PARTICIPANT_FRAME", "WARD_KILL", "CHAMPION_KILL", "CHAMPION_KILLED", "CHAMPION_ASSIST",
    "ELITE_MONSTER_KILL", "ELITE_MONSTER_ASSIST",
)
XP_WARD = "CONTROL_WARD"
WARM_UP_MS = 180_000

# Keyword phrase of every event type.
EVENT_PHRASES = {
    "PARTICIPANT_FRAME": "CHAMPION STATUS",
    "ITEM_DESTROYED": "CHAMPION ITEM DESTROYED",
    "ITEM_PURCHASED": "CHAMPION ITEM PURCHASED",
    "ITEM_SOLD": "CHAMPION ITEM SOLD",
    "ITEM_UNDO": "CHAMPION ITEM UNDO",
    "LEVEL_UP": "CHAMPION LEVEL UP",
    "CHAMPION_TRANSFORM": "CHAMPION LEVEL TRANSFORM",
    "SKILL_LEVEL_UP": "CHAMPION LEVEL SKILL",
    "BUILDING_ASSIST": "TAKEDOWN BUILDING ASSIST",
    "BUILDING_KILL": "TAKEDOWN BUILDING KILL",
    "TURRET_PLATE_DESTROYED": "TAKEDOWN BUILDING PLATE KILL",
    "CHAMPION_ASSIST": "TAKEDOWN CHAMPION ASSIST",
    "CHAMPION_KILL": "TAKEDOWN CHAMPION KILL",
    "RESPAWN": "TAKEDOWN CHAMPION RESPAWN",
    "ELITE_MONSTER_ASSIST": "TAKEDOWN MONSTER ASSIST",
    "ELITE_MONSTER_KILL": "TAKEDOWN MONSTER KILL",
    "WARD_KILL": "TAKEDOWN WARD KILL",
    "WARD_PLACED": "TAKEDOWN WARD SPAWN",
    "DRAGON_SOUL_GIVEN": "SYSTEM MONSTER DRAGON SOUL",
    "FEAT_UPDATE": "SYSTEM TAKEDOWN FEAT",
    "OBJECTIVE_BOUNTY_PRESTART": "SYSTEM BOUNTY PRESTART",
    "OBJECTIVE_BOUNTY_START": "SYSTEM BOUNTY START",
    "OBJECTIVE_BOUNTY_FINISH": "SYSTEM BOUNTY END",
    "GAME_END": "SYSTEM GAME END",
    "PAUSE_END": "SYSTEM GAME START",
}


# -- encodings ----------------------------------------------------------------------------------


def one_hot(df: DataFrame, column: str, values: Sequence, *, prefix: str | None = None, width: int = 0) -> DataFrame:
    """0/1 column per value of one column; ``width`` zero-pads the value in the name."""
    prefix = column if prefix is None else prefix
    return df.withColumns({
        f"{prefix}_{str(v).zfill(width)}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("tinyint")
        for v in values
    })


def one_hot_either(df: DataFrame, first: str, second: str, values: Sequence, *, prefix: str, width: int = 2) -> DataFrame:
    """0/1 column per value that either of two columns holds."""
    holds = lambda c, v: F.coalesce(F.col(c) == F.lit(v), F.lit(False))
    return df.withColumns({
        f"{prefix}_{str(v).zfill(width)}": (holds(first, v) | holds(second, v)).cast("tinyint") for v in values
    })


def frame_pairs(
    frames: DataFrame, *, keys: Sequence[str], time: str = "timestamp", value: str = "xp",
    max_rows: int = DEFAULT_MAX_ROWS, bounded: bool = False,
) -> DataFrame:
    """Each frame with the next one of its player: previous and current time and value.

    The last frame of a player has no successor and is dropped.
    """
    lane = Lane(keys, [time], max_rows=max_rows, bounded=bounded)
    paired = lane.run(frames, _next=following(F.col(time).alias("t"), F.col(value).alias("v")))
    return paired.where(F.col("_next.v").isNotNull()).select(
        *[c for c in frames.columns if c not in (time, value)],
        F.col(time).alias(f"previous_{time}"),
        F.col("_next.t").alias(f"current_{time}"),
        F.col(value).alias(f"previous_{value}"),
        F.col("_next.v").alias(f"current_{value}"),
    )


def xp_events(events: DataFrame) -> DataFrame:
    """Events that change experience; of ward kills only the control ward's."""
    ward = F.col("wardType")
    return events.where(F.col("type").isin(*XP_EVENTS) & ((ward == XP_WARD) | ward.isNull()))


def with_interval(
    events: DataFrame, *, keys: Sequence[str], order: Sequence[str], starts: Column,
    max_rows: int = DEFAULT_MAX_ROWS, bounded: bool = False, name: str = "interval_id",
) -> DataFrame:
    """Number of interval starts up to and including the row."""
    lane = Lane(keys, order, max_rows=max_rows, bounded=bounded)
    return lane.run(events, **{name: running_sum(F.when(starts, 1).otherwise(0).cast("long"))})


def interval_counts(events: DataFrame, *, keys: Sequence[str], kinds: Sequence[str], kind: str = "type") -> DataFrame:
    """Events of each kind per interval, zero if none."""
    return events.groupBy(*keys, "interval_id").agg(
        *[F.count_if(F.col(kind) == k).alias(k) for k in kinds]
    )


def interval_samples(
    events: DataFrame, *, keys: Sequence[str] = ("matchId", "participantId"), bounded: bool = True,
    max_rows: int = DEFAULT_MAX_ROWS, monsters: Sequence[str] = (),
) -> DataFrame:
    """Frame pairs with the events counted between the two frames, and a 0/1 column for each of ``monsters`` that fell.

    Counts belong to the interval that the earlier frame opens.  Interval numbers and next frames
    come from one scan, and grouping by (keys, interval) keeps its partitioning: one exchange.
    """
    at_frame = F.col("type") == FRAME_EVENT
    frame = F.when(at_frame, F.struct("timestamp", "xp"))
    lane = Lane(keys, ["timestamp", "eventId"], max_rows=max_rows, bounded=bounded)
    scanned = lane.run(
        xp_events(events),
        interval_id=running_sum(F.when(at_frame, 1).otherwise(0).cast("long")),
        _next=known_after(frame),
    )
    kinds = [k for k in XP_EVENTS if k != FRAME_EVENT]
    intervals = scanned.groupBy(*keys, "interval_id").agg(
        F.max(F.when(at_frame, F.struct("timestamp", "xp", "_next"))).alias("_frame"),
        F.max("numberOfAssists").alias("numberOfAssists"),
        *[F.count_if(F.col("type") == k).alias(k) for k in kinds],
        *[F.coalesce(F.max((F.col("monsterType") == m).cast("tinyint")), F.lit(0).cast("tinyint")).alias(f"monsterType_{m}") for m in monsters],
    )
    opened = F.col("_frame._next.xp").isNotNull()
    return intervals.where(opened).select(
        *keys, "interval_id",
        F.col("_frame.timestamp").alias("previous_timestamp"), F.col("_frame._next.timestamp").alias("current_timestamp"),
        F.col("_frame.xp").alias("previous_xp"), F.col("_frame._next.xp").alias("current_xp"),
        "numberOfAssists", *kinds, *[f"monsterType_{m}" for m in monsters],
    )


def with_player_terms(samples: DataFrame, *, regions: Sequence[str] = ()) -> DataFrame:
    """0/1 columns for the player's number and side, and for the region if its values are given."""
    numbered = one_hot(samples, "participantId", PLAYERS, width=2)
    sided = numbered.withColumn("team", F.coalesce(F.col("participantId") > 5, F.lit(False)).cast("tinyint"))
    return one_hot(sided, "region", regions) if regions else sided


def with_deltas(samples: DataFrame) -> DataFrame:
    """Differences, squares, interactions (those of monster types with time for the ``monsterType_`` columns there are) and the square-rooted target."""
    c = F.col
    deltas = samples.withColumns({
        "time_delta": c("current_timestamp") - c("previous_timestamp"),
        "xp_delta": c("current_xp") - c("previous_xp"),
    })
    return deltas.withColumns({
        "time_delta_squared": F.pow(c("time_delta"), F.lit(2)),
        "previous_xp_squared": F.pow(c("previous_xp"), F.lit(2)),
        "previous_xp_time_interaction": c("previous_xp").cast("long") * c("previous_timestamp"),
        "current_timestamp_squared": F.pow(c("current_timestamp"), F.lit(2)),
        "champion_kill_X_xp": c("previous_xp") * c("CHAMPION_KILL"),
        "champion_assist_X_xp": F.try_divide(c("previous_xp") * c("CHAMPION_ASSIST"), c("numberOfAssists")),
        "monster_kill_X_xp": c("previous_xp") * c("ELITE_MONSTER_KILL"),
        "xp_delta_sqrt": F.sqrt("xp_delta"),
        **{
            f"monster_kill_{m}_X_previous_timestamp": c("previous_timestamp").cast("long") * c("ELITE_MONSTER_KILL") * c(m)
            for m in samples.columns if m.startswith("monsterType_")
        },
    })


def after_warm_up(df: DataFrame, required: Sequence[str] = (), time: str = "timestamp", at: int = WARM_UP_MS) -> DataFrame:
    """Rows after the first minutes of a game with all required columns present."""
    kept = df.where(F.col(time) > at)
    return kept.na.drop(subset=[*required]) if required else kept


def xp_gain(amounts: Mapping[str, float], champion_kill: Column) -> Column:
    """Experience an event gives, from a table of amounts.

    ``amounts`` names ``ELDER_DRAGON``, ``DRAGON``, ``HORDE``, ``RIFTHERALD``, ``BARON_NASHOR`` and
    ``CONTROL_WARD``; monsters are shared between the killer and the assisting players, the baron and
    wards are not.  ``champion_kill`` is the amount for kills and assists as an expression over
    the levels, see :func:`level_of`.
    """
    kind, monster, sub = F.col("type"), F.col("monsterType"), F.col("monsterSubType")
    shared = lambda name: F.lit(float(amounts[name])) / (1 + F.coalesce(F.col("numberOfAssists"), F.lit(0)))
    slain = kind == "ELITE_MONSTER_KILL"
    nobody = (kind == "CHAMPION_KILL") & (F.col("participantId") == 0)
    return (
        F.when(nobody, 0.0)
        .when(kind.isin("CHAMPION_KILL", "CHAMPION_ASSIST"), champion_kill.cast("double"))
        .when(slain & (monster == "DRAGON") & (sub == "ELDER_DRAGON"), shared("ELDER_DRAGON"))
        .when(slain & (monster == "DRAGON"), shared("DRAGON"))
        .when(slain & (monster == "HORDE"), shared("HORDE"))
        .when(slain & (monster == "RIFTHERALD"), shared("RIFTHERALD"))
        .when(slain & (monster == "BARON_NASHOR"), F.lit(float(amounts["BARON_NASHOR"])))
        .when((kind == "WARD_KILL") & (F.col("wardType") == XP_WARD), F.lit(float(amounts["CONTROL_WARD"])))
        .otherwise(0.0)
    )


def level_of(player: Column) -> Column:
    """Level of a player whose id is in a column, out of ``level_1`` to ``level_10``."""
    return F.get(F.array(*[F.col(f"level_{p}") for p in PLAYERS]), player - 1)


# -- vectors and models -------------------------------------------------------------------------


def fit_variance_pca(vectors: DataFrame, column: str, *, share: float = 0.9) -> tuple[PipelineModel, int]:
    """Centred PCA and the smallest number of components that explain more than ``share``."""
    size = len(vectors.select(column).first()[0])
    scaler = StandardScaler(inputCol=column, outputCol="_centred", withMean=True, withStd=False).fit(vectors)
    model = PCA(k=size, inputCol="_centred", outputCol="_projected").fit(scaler.transform(vectors))
    total, count = 0.0, size
    for i, part in enumerate(model.explainedVariance.toArray()):
        total += part
        if total > share:
            count = i + 1
            break
    return PipelineModel([scaler, model]), count


def project(vectors: DataFrame, model: PipelineModel, count: int, *, output: str = "vector") -> DataFrame:
    """First ``count`` components of each row as an array."""
    shown = model.transform(vectors).withColumn(output, F.slice(vector_to_array("_projected"), 1, count))
    return shown.drop("_centred", "_projected")


def event_type_vectors(
    spark: SparkSession, text_vectors: DataFrame | None = None, *, share: float = 0.9, features: int = 64
) -> DataFrame:
    """``type, vector`` of every known event type, reduced to ``share`` of the variance.

    ``text_vectors`` (``type``, ``vector array<double>``) supplies embeddings of the phrases; without
    it the phrases' words are hashed.
    """
    if text_vectors is None:
        pairs = F.create_map(*[F.lit(x) for pair in EVENT_PHRASES.items() for x in pair])
        phrases = spark.range(1).select(F.explode(pairs).alias("type", "phrase"))
        words = Tokenizer(inputCol="phrase", outputCol="_words").transform(phrases)
        hashed = HashingTF(inputCol="_words", outputCol="_v", numFeatures=features).transform(words)
        vectors = hashed.select("type", array_to_vector(vector_to_array("_v")).alias("_v"))
    else:
        vectors = text_vectors.select("type", array_to_vector(F.col("vector").cast("array<double>")).alias("_v"))
    model, count = fit_variance_pca(vectors, "_v", share=share)
    return project(vectors, model, count).select("type", "vector")


def assembled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return VectorAssembler(inputCols=[*features], outputCol="features", handleInvalid="skip").transform(
        df.withColumn("label", F.col(label).cast("double")).where(F.col("label").isNotNull())
    )


def boosted_trees(train: DataFrame, features: Sequence[str], label: str, *, rounds: int = 30) -> tuple[GBTRegressor, DataFrame]:
    """Gradient-boosted regression and its importances sorted by feature name."""
    # The trees keep a task's rows in memory.
    data = assembled(dealt(train, train.count(), *train.columns), features, label)
    model = GBTRegressor(maxIter=rounds, maxDepth=7, stepSize=0.05, featureSubsetStrategy="log2", seed=42).fit(data)
    rows = sorted(zip(features, [float(x) for x in model.featureImportances.toArray()]))
    return model, train.sparkSession.createDataFrame(rows, "feature string, importance double")


def scores(model, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: R2 and RMSE on the test rows."""
    predicted = model.transform(assembled(test, features, label))
    rate = lambda name: float(RegressionEvaluator(metricName=name).evaluate(predicted))
    return test.sparkSession.createDataFrame([(rate("r2"), rate("rmse"))], "r2 double, rmse double")


def least_squares(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Ordinary least squares with a constant: coefficient, error, t and p per term."""
    model = LinearRegression(solver="normal").fit(assembled(df, features, label))
    s = model.summary
    terms = [*features, "const"]
    values = [*model.coefficients.toArray(), model.intercept]
    rows = [
        (name, float(v), float(e), float(t), float(p))
        for name, v, e, t, p in zip(terms, values, s.coefficientStandardErrors, s.tValues, s.pValues)
    ]
    return df.sparkSession.createDataFrame(
        rows, "term string, coefficient double, std_error double, t_value double, p_value double"
    )
