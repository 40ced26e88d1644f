"""Queries on the event stream: as-of and nearest joins, fills, counters, snapshots, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators import counts as C
from chronofold.operators.asof import asof_join, nearest_join
from chronofold.operators.lanes import Lane, following, last_known, next_known, running_sum
from chronofold.operators.replay import final_items, item_changes
from chronofold.operators.select import (
    first_per_key, first_valid, hash_split, last_per_key, shuffled, smallest_stratum, stratified_split, top_per_key,
)
from chronofold.plans.features import after_warm_up, frame_pairs, interval_counts, one_hot, one_hot_either, with_interval
from chronofold.plans.timeline import DESTROYED, PURCHASED, SOLD, UNDO
from chronofold.suite.base import Tables, query

KINDS = ("signup", "purchase", "error", "view", "click")


def of_kind(t: Tables, kind: str) -> DataFrame:
    return t.timed_events.where(F.col("event_type") == kind)


@query("J3 J4 J5", """
SELECT p.user_id, p.event_id, c.event_id AS click_id, c.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
  ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def asof_purchase_click(t: Tables) -> DataFrame:
    """Latest click of the user at or before each purchase."""
    clicks = of_kind(t, "click").select("user_id", "t", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    left = of_kind(t, "purchase").select("user_id", "event_id", "t")
    return asof_join(left, clicks, by=["user_id"], on="t", payload=["click_id", "click_value"], tie=["click_id"]).drop("t")


@query("J3", """
SELECT p.user_id, p.event_id,
  CASE WHEN epoch_us(p.ts) - epoch_us(c.ts) <= 86400000000 THEN c.event_id END AS view_id
FROM (SELECT * FROM events WHERE event_type = 'error') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c
  ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def asof_within_a_day(t: Tables) -> DataFrame:
    """Latest view at most a day before each error."""
    views = of_kind(t, "view").select("user_id", "t", F.col("event_id").alias("view_id"))
    left = of_kind(t, "error").select("user_id", "event_id", "t")
    found = asof_join(left, views, by=["user_id"], on="t", payload=["view_id"], tolerance=F.lit(86_400_000_000))
    return found.drop("t")


@query("J6", """
WITH pairs AS (
  SELECT e.user_id, e.event_id, c.event_id AS click_id, abs(epoch_us(e.ts) - epoch_us(c.ts)) AS gap,
    row_number() OVER (PARTITION BY e.event_id ORDER BY abs(epoch_us(e.ts) - epoch_us(c.ts)), c.ts, c.event_id) AS rn
  FROM events e LEFT JOIN events c ON c.user_id = e.user_id AND c.event_type = 'click'
  WHERE e.event_type = 'error')
SELECT user_id, event_id, click_id, gap FROM pairs WHERE rn = 1
""")
def nearest_click_to_error(t: Tables) -> DataFrame:
    """Click of the user nearest in time to each error."""
    clicks = of_kind(t, "click").select("user_id", "t", F.col("event_id").alias("click_id"))
    errors = of_kind(t, "error").select("user_id", "event_id", "t")
    found = nearest_join(errors, clicks, by=["user_id"], on="t", payload=["click_id"], tie=["click_id"], matched_at="at")
    return found.select("user_id", "event_id", "click_id", F.abs(F.col("t") - F.col("at")).alias("gap"))


@query("W5", """
SELECT event_id, user_id,
  last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_paid,
  last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_view
FROM events
""")
def filled_forward(t: Tables) -> DataFrame:
    """Latest purchase value and view of the user at every event."""
    lane = Lane(["user_id"], ["t", "event_id"])
    is_kind = lambda k: F.col("event_type") == k
    filled = lane.run(
        t.timed_events,
        last_paid=last_known(F.when(is_kind("purchase"), F.col("value"))),
        last_view=last_known(F.when(is_kind("view"), F.col("event_id"))),
    )
    return filled.select("event_id", "user_id", "last_paid", "last_view")


@query("W6", """
SELECT event_id, user_id,
  first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_paid
FROM events
""")
def filled_backward(t: Tables) -> DataFrame:
    """Next purchase value of the user from every event on."""
    lane = Lane(["user_id"], ["t", "event_id"])
    paid = F.when(F.col("event_type") == "purchase", F.col("value"))
    return lane.run(t.timed_events, next_paid=next_known(paid)).select("event_id", "user_id", "next_paid")


@query("W8", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position
FROM events
""")
def numbered_events(t: Tables) -> DataFrame:
    """Zero-based number of every event within its user."""
    lane = Lane(["user_id"], ["t", "event_id"])
    numbered = lane.number(t.timed_events, "n")
    return numbered.select("event_id", "user_id", (F.col("n") - 1).alias("position"))


@query("W4 A11 P27", """
SELECT user_id, event_id, next_event, next_value - value AS change FROM (
  SELECT user_id, event_id, value,
    lead(event_id) OVER w AS next_event, lead(value) OVER w AS next_value
  FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE next_event IS NOT NULL
""")
def next_view(t: Tables) -> DataFrame:
    """Each view with the user's next one."""
    lane = Lane(["user_id"], ["t", "event_id"])
    paired = lane.run(of_kind(t, "view"), n=following(F.col("event_id"), F.col("value")))
    return paired.where(F.col("n").isNotNull()).select(
        "user_id", "event_id", F.col("n.event_id").alias("next_event"), (F.col("n.value") - F.col("value")).alias("change")
    )


@query("P27", """
SELECT user_id, event_id, value FROM (SELECT *, epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id)) AS age FROM events)
WHERE age > 86400000000 AND json_extract_string(props, '$.k') IS NOT NULL
""")
def events_after_first_day(t: Tables) -> DataFrame:
    """Events of every user after their first day that have a number in their properties."""
    first = t.timed_events.groupBy("user_id").agg(F.min("t").alias("since"))
    aged = t.timed_events.join(first, "user_id").withColumns(
        {"age": F.col("t") - F.col("since"), "k": F.get_json_object("props", "$.k")})
    return after_warm_up(aged, ["k"], time="age", at=86_400_000_000).select("user_id", "event_id", "value")


@query("M3 W4", """
SELECT user_id, t AS previous_t, next_t AS current_t, value AS previous_value, next_value AS current_value FROM (
  SELECT user_id, epoch_us(ts) AS t, value, lead(epoch_us(ts)) OVER w AS next_t, lead(value) OVER w AS next_value
  FROM events WHERE event_type = 'signup' WINDOW w AS (PARTITION BY user_id ORDER BY ts))
WHERE next_value IS NOT NULL
""")
def signup_pairs(t: Tables) -> DataFrame:
    """Consecutive signups of a user as previous and current state."""
    return frame_pairs(of_kind(t, "signup").select("user_id", "t", "value"), keys=["user_id"], time="t", value="value")


_INTERVALS = """
WITH numbered AS (
  SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS interval_id
  FROM events),
counted AS (
  SELECT user_id, interval_id,
    count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'error') AS error,
    count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'click') AS click
  FROM numbered GROUP BY ALL)
"""


@query("W7 A7", _INTERVALS + "SELECT * FROM counted")
def interval_event_counts(t: Tables) -> DataFrame:
    """Events of each kind between two signups of a user."""
    numbered = with_interval(
        t.timed_events, keys=["user_id"], order=["t", "event_id"], starts=F.col("event_type") == "signup"
    )
    return interval_counts(numbered, keys=["user_id"], kinds=[k for k in KINDS if k != "signup"], kind="event_type")


@query("J19 M3 M4", _INTERVALS + """
SELECT n.user_id, n.event_id, n.interval_id, c.purchase, c.error, c.view, c.click,
  CAST(round(n.value * 100) AS BIGINT) * c.purchase AS value_x_purchase,
  (c.click * c.click) AS click_squared
FROM numbered n LEFT JOIN counted c USING (user_id, interval_id) WHERE n.event_type = 'signup'
""")
def interval_samples_joined(t: Tables) -> DataFrame:
    """Counts joined back to the signup that opens the interval, with interaction terms."""
    numbered = with_interval(
        t.timed_events, keys=["user_id"], order=["t", "event_id"], starts=F.col("event_type") == "signup"
    )
    counted = interval_counts(numbered, keys=["user_id"], kinds=["purchase", "error", "view", "click"], kind="event_type")
    opened = numbered.where(F.col("event_type") == "signup").select("user_id", "event_id", "interval_id", "value")
    return opened.join(counted, ["user_id", "interval_id"], "left").select(
        "user_id", "event_id", "interval_id", "purchase", "error", "view", "click",
        (F.round(F.col("value") * 100).cast("long") * F.col("purchase")).alias("value_x_purchase"),
        (F.col("click") * F.col("click")).alias("click_squared"),
    )


SNAPSHOT_CUT = "2024-01-20 00:00:00"


@query("N6 J8 A1 A2 A3 W6 P12", f"""
WITH long AS (SELECT user_id FROM events GROUP BY user_id HAVING max(ts) >= TIMESTAMP '{SNAPSHOT_CUT}'),
labelled AS (
  SELECT *, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS label
  FROM events WHERE user_id IN (SELECT user_id FROM long)),
cut AS (SELECT * FROM labelled WHERE ts <= TIMESTAMP '{SNAPSHOT_CUT}'),
last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM cut),
counts AS (
  SELECT user_id, count(*) FILTER (event_type = 'signup') AS n_signup,
    count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'error') AS n_error,
    count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'click') AS n_click
  FROM cut GROUP BY user_id)
SELECT user_id, event_id AS last_event, event_type AS last_type, value AS last_value, label,
  n_signup, n_purchase, n_error, n_view, n_click
FROM last JOIN counts USING (user_id) WHERE rn = 1
""")
def user_snapshot(t: Tables) -> DataFrame:
    """State of every user still active at a date: last event, counts so far and next purchase.

    One aggregation: the length check, last row, counts and label share a single exchange.
    """
    before = F.col("ts") <= F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")
    order = F.struct("ts", "event_id")
    paid = F.when(F.col("event_type") == "purchase", F.col("value"))
    state = F.struct("event_id", "event_type", "value", paid.alias("label"))
    grouped = t.events.groupBy("user_id").agg(
        F.max("ts").alias("_until"),
        F.max_by(state, F.when(before, order)).alias("_last"),
        F.min_by("value", F.when(~before & paid.isNotNull(), order)).alias("_next"),
        *[F.count_if(before & (F.col("event_type") == k)).alias(f"n_{k}") for k in KINDS],
    )
    lasting = (F.col("_until") >= F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")) & F.col("_last").isNotNull()
    return grouped.where(lasting).select(
        "user_id", F.col("_last.event_id").alias("last_event"), F.col("_last.event_type").alias("last_type"),
        F.col("_last.value").alias("last_value"), F.coalesce("_last.label", "_next").alias("label"),
        *[f"n_{k}" for k in KINDS],
    )


@query("A1 J8", """
SELECT user_id, max(value) AS max_value FROM events GROUP BY user_id HAVING max(value) >= 40
""")
def users_reaching(t: Tables) -> DataFrame:
    """Users whose highest value reaches a threshold."""
    return C.reaching(t.events, ["user_id"], "value", 40)


@query("A2 J7", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day,
  count(*) FILTER (event_type = 'purchase' AND value > 5) AS big_purchase,
  count(*) FILTER (event_type = 'click' AND value > 5) AS big_click,
  count(*) FILTER (event_type = 'purchase' AND value <= 5) AS small_purchase,
  count(*) FILTER (event_type = 'click' AND value <= 5) AS small_click
FROM events GROUP BY 1
""")
def daily_counts_by_kind(t: Tables) -> DataFrame:
    """Filtered counts per day, one column per rule and kind, in one aggregation."""
    daily = t.events.withColumn("day", F.to_date("ts"))
    rules = {"big": F.col("value") > 5, "small": F.col("value") <= 5}
    return C.pivoted_counts(daily, ["day"], rules, ["purchase", "click"], F.col("event_type"))


@query("J7", """
SELECT u.user_id, coalesce(p.n, 0) AS purchases, coalesce(c.n, 0) AS clicks
FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) p USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' AND value > 20 GROUP BY 1) c USING (user_id)
""")
def joined_counts(t: Tables) -> DataFrame:
    """Separately built count frames joined on the user with zeros for gaps."""
    users = t.events.select("user_id").distinct()
    counted = lambda rows, name: rows.groupBy("user_id").agg(F.count(F.lit(1)).alias(name))
    purchases = counted(t.events.where("event_type = 'purchase'"), "purchases")
    clicks = counted(t.events.where("event_type = 'click' AND value > 20"), "clicks")
    return C.left_join_chain([users, purchases, clicks], ["user_id"])


@query("A3", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def last_event_per_user(t: Tables) -> DataFrame:
    """Last row of every user."""
    rows = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    return C.last_row(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("A4 N2 N3", """
SELECT user_id, """ + ", ".join(
    f"arg_max(value, ts) FILTER (event_type = '{k}') AS value_{k}, max(event_id) FILTER (event_type = '{k}') AS event_id_{k}"
    for k in KINDS) + """
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
GROUP BY user_id
""")
def latest_by_kind_wide(t: Tables) -> DataFrame:
    """Latest value and id of each kind as columns per user."""
    return C.pivoted_latest(t.events, ["user_id"], F.col("event_type"), KINDS, ["value", "event_id"], ["ts", "event_id"])


@query("W1", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
""")
def first_of_kind(t: Tables) -> DataFrame:
    """First event of each user and kind."""
    return first_per_key(t.events, ["user_id", "event_type"], "event_id").select("user_id", "event_id", "event_type")


@query("W3", """
SELECT user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_user(t: Tables) -> DataFrame:
    """Latest record of each user with a total tie-break."""
    return last_per_key(t.events, ["user_id"], "ts", "event_id").select("user_id", "event_id", "value")


@query("W9", """
SELECT user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3
""")
def top_values_per_user(t: Tables) -> DataFrame:
    """Three highest values of each user (a top-k report)."""
    return top_per_key(t.events, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3).select("user_id", "event_id", "value")


@query("T3 T5", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 10 ORDER BY ts, event_id LIMIT 100
""")
def first_valid_purchases(t: Tables) -> DataFrame:
    """The first hundred valid purchases; invalid rows do not use up the count."""
    valid = (F.col("event_type") == "purchase") & (F.col("value") > 10)
    return first_valid(t.events, valid, [F.col("ts"), F.col("event_id")], 100).select("event_id", "user_id", "value")


@query("T4", None)
def shuffled_work(t: Tables) -> DataFrame:
    """Users in a reproducible random order (engine-specific hash, so checked by rows only)."""
    return shuffled(t.events.select("user_id").distinct(), "user_id")


@query("A6", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def kinds_counted(t: Tables) -> DataFrame:
    return C.value_counts(t.events, "event_type")


@query("A6", "SELECT count(doc_id) AS doc_id, count(quality) AS quality, count(toxic) AS toxic, count(lang) AS lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def filled_columns(t: Tables) -> DataFrame:
    """Non-null count of every column of a joined table."""
    joined = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic", "lang")
    return C.column_counts(joined)


@query("A8", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_kinds(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type").distinct()


@query("A10", """
SELECT min(n) AS smallest FROM (SELECT count(*) AS n FROM labels GROUP BY quality, toxic)
""")
def rarest_label(t: Tables) -> DataFrame:
    labels = t.labels.withColumn("label", F.concat_ws("_", "quality", "toxic"))
    return smallest_stratum(labels, "label")


@query("N7", """
WITH l AS (SELECT doc_id, quality::VARCHAR || '_' || toxic::VARCHAR AS label FROM labels),
k AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM l GROUP BY label))
SELECT doc_id, label, CASE WHEN (row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1) % k = 0
  THEN 'test' ELSE 'train' END AS split
FROM l, k
""")
def stratified_labels(t: Tables) -> DataFrame:
    """Train/test marks with every label on both sides, numbered by id so SQL can follow."""
    labels = t.labels.select("doc_id", F.concat_ws("_", "quality", "toxic").alias("label"))
    return stratified_split(labels, label="label", group="doc_id", order="doc_id")


@query("N7 M5", None)
def stratified_orders(t: Tables) -> DataFrame:
    """Stratified split in hash order on all orders: rows per label and side."""
    orders = t.orders.select("o_orderkey", F.concat_ws("_", "o_orderstatus", "o_orderpriority").alias("label"))
    return stratified_split(orders, label="label", group="o_orderkey").groupBy("label", "split").count()


@query("M5", None)
def hashed_split(t: Tables) -> DataFrame:
    """Rows per side of the hash split."""
    return hash_split(t.orders, "o_orderkey").groupBy("split").count()


@query("A12", """
SELECT least((cents - low) * 20 // (high - low) + 1, 20) AS bin, count(*) AS rows
FROM (SELECT CAST(round(value * 100) AS BIGINT) AS cents FROM events),
  (SELECT CAST(round(min(value) * 100) AS BIGINT) AS low, CAST(round(max(value) * 100) AS BIGINT) AS high FROM events) GROUP BY 1
""")
def value_histogram(t: Tables) -> DataFrame:
    """Twenty equal-width bins over all values in cents."""
    cents = t.events.select(F.round(F.col("value") * 100).cast("long").alias("cents"))
    return C.histogram(cents, "cents", 20)


@query("A12", """
SELECT event_type, round(
  (avg(value*value*value) - 3*avg(value)*avg(value*value) + 2*avg(value)*avg(value)*avg(value))
  / pow(avg(value*value) - avg(value)*avg(value), 1.5), 6) AS skew
FROM events GROUP BY event_type
""")
def value_skewness(t: Tables) -> DataFrame:
    """Population skewness of the value per kind."""
    return t.events.groupBy("event_type").agg(F.round(F.skewness("value"), 6).alias("skew"))


@query("M1", "SELECT event_id, user_id, " + ", ".join(
    f"(event_type = '{k}')::TINYINT AS event_type_{k}" for k in KINDS) + " FROM events")
def kinds_one_hot(t: Tables) -> DataFrame:
    return one_hot(t.events, "event_type", KINDS).select("event_id", "user_id", *[f"event_type_{k}" for k in KINDS])


@query("M2", """
SELECT e.event_id, """ + ", ".join(
    f"(e.event_type = '{k}' OR coalesce(p.event_type, '') = '{k}')::TINYINT AS either_{k}" for k in KINDS) + """
FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1
""")
def either_one_hot(t: Tables) -> DataFrame:
    """Kinds that this event or the one before it has."""
    before = t.events.select((F.col("event_id") + 1).alias("event_id"), F.col("event_type").alias("before"))
    both = t.events.join(before, "event_id", "left")
    return one_hot_either(both, "event_type", "before", KINDS, prefix="either", width=0).select(
        "event_id", *[f"either_{k}" for k in KINDS]
    )


ITEM_KINDS = {"purchase": PURCHASED, "view": PURCHASED, "signup": SOLD, "error": DESTROYED, "click": UNDO}
_MINUTES = 30


def item_events(t: Tables) -> DataFrame:
    """Events as item events: kind by type, item by the number in the properties.

    Times are cut to half hours so that several events of a user share a tick.
    """
    kinds = F.create_map(*[F.lit(x) for pair in ITEM_KINDS.items() for x in pair])
    return t.timed_events.select(
        "user_id", "event_id", F.floor(F.col("t") / (_MINUTES * 60_000_000)).alias("tick"),
        F.element_at(kinds, F.col("event_type")).alias("kind"),
        (F.get_json_object("props", "$.k").cast("int") % 5).alias("item"),
    )


@query("E9 X4", f"""
WITH RECURSIVE base AS (
  SELECT user_id, event_id, floor(epoch_us(ts) / {_MINUTES * 60_000_000})::BIGINT AS tick,
    CASE event_type WHEN 'purchase' THEN 'ITEM_PURCHASED' WHEN 'view' THEN 'ITEM_PURCHASED' WHEN 'signup' THEN 'ITEM_SOLD'
      WHEN 'error' THEN 'ITEM_DESTROYED' ELSE 'ITEM_UNDO' END AS kind,
    (json_extract_string(props, '$.k')::INTEGER % 5)::BIGINT AS item
  FROM events),
e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tick, kind, event_id) AS n FROM base),
replay AS (
  SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS event_id,
    [0, 0, 0, 0, 0]::BIGINT[] AS held, []::STRUCT(kind VARCHAR, tick BIGINT, item BIGINT)[] AS past
  FROM (SELECT DISTINCT user_id FROM base)
  UNION ALL
  SELECT s.user_id, s.n, s.event_id,
    CASE
      WHEN s.kind = 'ITEM_PURCHASED' THEN [s.held[i + 1] + (i = s.item)::BIGINT for i in range(5)]
      WHEN s.kind IN ('ITEM_SOLD', 'ITEM_DESTROYED') THEN [greatest(0, s.held[i + 1] - (i = s.item)::BIGINT) for i in range(5)]
      WHEN s.top.kind = 'ITEM_PURCHASED' THEN
        [greatest(0, s.held[i + 1] - (i = s.top.item)::BIGINT)
          + len([x for x in s.past[len(s.past) - s.run : len(s.past) - 1] if x.item = i]) for i in range(5)]
      WHEN s.top.kind = 'ITEM_SOLD' THEN [s.held[i + 1] + (i = s.top.item)::BIGINT for i in range(5)]
      ELSE s.held END,
    CASE
      WHEN s.kind <> 'ITEM_UNDO' THEN list_append(s.past, {{'kind': s.kind, 'tick': s.tick, 'item': s.item}})
      WHEN len(s.past) = 0 THEN s.past
      WHEN s.top.kind = 'ITEM_PURCHASED' THEN s.past[1 : len(s.past) - 1 - s.run]
      ELSE s.past[1 : len(s.past) - 1] END
  FROM (
    SELECT e.user_id, e.n, e.event_id, e.kind, e.tick, e.item, r.held, r.past, r.past[len(r.past)] AS top,
      coalesce(list_position([NOT (x.kind = 'ITEM_DESTROYED' AND x.tick = r.past[len(r.past)].tick)
        for x in list_reverse(r.past[1 : len(r.past) - 1])], true) - 1, len(r.past) - 1) AS run
    FROM replay r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1) s)
SELECT user_id, i AS item, held[i + 1] AS held
FROM (SELECT user_id, held FROM replay QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1), range(5) r(i)
WHERE held[i + 1] > 0
""")
def items_held(t: Tables) -> DataFrame:
    """Items every user still holds after replaying purchases, sales, destructions and undos."""
    args = dict(by=["user_id"], tick="tick", item="item", ordinal="event_id")
    return final_items(item_changes(item_events(t), kind="kind", **args), **args)


@query("E9", None)
def item_change_log(t: Tables) -> DataFrame:
    """Every counter change of the replay."""
    return item_changes(item_events(t), by=["user_id"], tick="tick", kind="kind", item="item", ordinal="event_id")


@query("T1", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch_us(ts) / 3600000000), event_type, event_id) AS place
FROM events
""")
def tick_order(t: Tables) -> DataFrame:
    """Place of each event by hour, then kind, then source order."""
    hourly = t.timed_events.withColumn("hour", F.floor(F.col("t") / 3_600_000_000))
    lane = Lane(["user_id"], ["hour", "event_type", "event_id"])
    return lane.run(hourly, place=running_sum(F.lit(1).cast("long"))).select("user_id", "event_id", "place")
