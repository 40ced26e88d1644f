"""Queries on scans, landed files, catalog tables, exports and work grids."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.values import partition_parts
from chronofold.operators.grids import SERVERS, expand, in_all, missing, rank_grid, servers
from chronofold.sources.export import ExportSpec, export_tables, split_manifest, store_splits
from chronofold.sources.landing import (
    LandingZone, by_keys, flatten_entries, head, landed_query, object_name, path_parts, read_object, union_relaxed,
)
from chronofold.sources.tables import TableSpec, TableStore, conform, struct
from chronofold.streaming.flows import run_partition
from chronofold.suite.base import Tables, query

ORDERS = TableSpec(
    struct(
        {"o_orderkey": "long"},
        {"o_custkey": "long", "o_totalprice": "double", "o_orderpriority": "string", "o_orderstatus": "string"},
    ),
    keys=("o_orderkey",),
    partition_by=("o_orderstatus",),
    sort_by=(("o_custkey", False), ("o_totalprice", True)),
)


def store_for(t: Tables, specs: dict[str, TableSpec]) -> TableStore:
    """Table store with a database of its own, so that repeated runs do not meet."""
    return TableStore(t.spark, t.scratch("tables"), "checks", uuid.uuid4().hex[:12], specs)


@query("S6 S7 P15", """
SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS day FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'
""")
def orders_in_window(t: Tables) -> DataFrame:
    """Projection, half-open time window and equality, all pushed into the scan."""
    window = (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return t.orders.where(window & (F.col("o_orderstatus") == "F")).select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )


@query("S8", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def orders_of_segment(t: Tables) -> DataFrame:
    """Orders of a list of customers."""
    keys = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return by_keys(t.orders, keys, "o_custkey").select("o_orderkey", "o_custkey")


@query("S9 T3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def orders_head(t: Tables) -> DataFrame:
    """First rows of two columns in key order."""
    return head(t.orders, ["o_orderkey", "o_totalprice"], ["o_orderkey"], 500)


@query("S5 U2 P10", """
SELECT c_custkey AS key, c_name AS name, c_nationkey::BIGINT AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey::BIGINT, NULL FROM supplier
""")
def relaxed_union(t: Tables) -> DataFrame:
    """Union of frames whose column types and sets differ."""
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("nation"))
    return union_relaxed([customers, suppliers])


@query("U3 A8", """
SELECT c_nationkey::BIGINT AS nation FROM customer EXCEPT SELECT s_nationkey::BIGINT FROM supplier WHERE s_acctbal > 5000
""")
def nations_without_rich_suppliers(t: Tables) -> DataFrame:
    """Set difference of distinct values."""
    one = t.customer.select(F.col("c_nationkey").cast("long").alias("nation"))
    return one.subtract(t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").cast("long").alias("nation")))


@query("S4 S10 S11 T2", """
SELECT o_orderstatus, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total FROM orders GROUP BY 1
""")
def stored_and_reread(t: Tables) -> DataFrame:
    """Orders appended to a landing partition per format and read back by extension."""
    zone = LandingZone(t.spark, t.scratch("landing"), ["orders"])
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    zone.store("orders", rows.where("o_totalprice >= 250000"), part="high")
    zone.store("orders", rows.where("o_totalprice < 250000"), part="low")
    back = zone.scan("orders", rows.schema).where(F.col("part").isin("high", "low"))
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("S1 S2 S23", """
SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate)::INTEGER AS year FROM orders
WHERE o_orderstatus = 'O' AND year(o_orderdate) = 1997
""")
def landed_partition(t: Tables) -> DataFrame:
    """One partition of a hive-style layout, read by path filter."""
    zone = LandingZone(t.spark, t.scratch("landing"), ["orders"])
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("year"))
    rows.write.partitionBy("o_orderstatus", "year").parquet(zone.table_path("orders"))
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string, year int"
    return zone.scan("orders", schema, o_orderstatus="O", year=1997)


@query("S20 S24 N13 J10", """
WITH grid AS (SELECT DISTINCT o_orderstatus, p AS o_orderpriority FROM orders, (VALUES ('1-URGENT'), ('2-HIGH'), ('9-NEVER')) v(p))
SELECT o_orderstatus, o_orderpriority FROM grid
EXCEPT SELECT o_orderstatus, o_orderpriority FROM orders
""")
def missing_partitions(t: Tables) -> DataFrame:
    """Required status x priority folders without a landed file, known from the paths alone."""
    zone = LandingZone(t.spark, t.scratch("landing"), ["orders"])
    t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").write.partitionBy(
        "o_orderstatus", "o_orderpriority").parquet(zone.table_path("orders"))
    required = expand(t.orders.select("o_orderstatus").distinct(), o_orderpriority=["1-URGENT", "2-HIGH", "9-NEVER"])
    present = zone.landed("orders", "o_orderstatus", "o_orderpriority")
    return missing(required, present, ["o_orderstatus", "o_orderpriority"])


@query("J12 J10 N13", """
WITH cells AS (
  SELECT t AS tier, d AS division FROM (VALUES ('IRON'),('BRONZE'),('SILVER'),('GOLD'),('PLATINUM'),('EMERALD'),('DIAMOND')) a(t),
    (VALUES ('I'),('II'),('III'),('IV')) b(d)
  UNION ALL SELECT t, 'I' FROM (VALUES ('MASTER'),('GRANDMASTER'),('CHALLENGER')) a(t)),
s AS (SELECT unnest(['br1','la1','la2','na1','jp1','kr','oc1','sg2','tw2','vn2','eun1','euw1','me1','ru','tr1']) AS server),
done AS (SELECT DISTINCT ['br1','kr','ru'][c_custkey % 3 + 1] AS server, ['IRON','GOLD','MASTER'][c_nationkey % 3 + 1] AS tier,
  ['I','II'][(c_custkey // 3) % 2 + 1] AS division, c_mktsegment AS day FROM customer)
SELECT g.day, g.server, g.tier, g.division
FROM (SELECT * FROM cells, s, (VALUES ('BUILDING'), ('MACHINERY')) d(day)) g
ANTI JOIN done USING (day, server, tier, division)
""")
def ladder_cells_to_fetch(t: Tables) -> DataFrame:
    """Day x server x rank cells that no customer record covers yet."""
    pick = lambda values, index: F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)
    done = t.customer.select(
        F.col("c_mktsegment").alias("day"), pick(("br1", "kr", "ru"), F.col("c_custkey") % 3).alias("server"),
        pick(("IRON", "GOLD", "MASTER"), F.col("c_nationkey") % 3).alias("tier"),
        pick(("I", "II"), F.floor(F.col("c_custkey") / 3) % 2).alias("division"))
    required = rank_grid(t.spark, ["BUILDING", "MACHINERY"])
    return missing(required, done, ["day", "server", "tier", "division"])


@query("J11", """
SELECT c_nationkey AS nation FROM customer WHERE c_mktsegment = 'BUILDING'
INTERSECT SELECT c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY'
INTERSECT SELECT s_nationkey FROM supplier
""")
def nations_in_all(t: Tables) -> DataFrame:
    """Nations present in three tables."""
    segment = lambda name: t.customer.where(F.col("c_mktsegment") == name).select(F.col("c_nationkey").alias("nation"))
    return in_all([segment("BUILDING"), segment("MACHINERY"), t.supplier.select(F.col("s_nationkey").alias("nation"))], ["nation"])


@query("S19", """
SELECT o_orderkey AS page, CASE WHEN i % 2 = 0 THEN 'entry' || i ELSE o_orderpriority END AS tier, i * 10 + o_custkey AS points, o_orderstatus AS league
FROM orders, range(1, 4) r(i) WHERE i <= o_orderkey % 3 + 1
""")
def flattened_pages(t: Tables) -> DataFrame:
    """Pages with nested entries; an entry's own field wins over the page's."""
    count = (F.col("o_orderkey") % 3 + 1).cast("int")
    entries = F.transform(F.sequence(F.lit(1), count), lambda i: F.struct(
        F.when(i % 2 == 0, F.concat(F.lit("entry"), i.cast("string"))).alias("tier"),
        (i * 10 + F.col("o_custkey")).alias("points")))
    pages = t.orders.select(
        F.col("o_orderkey").alias("page"), F.col("o_orderpriority").alias("tier"), F.col("o_orderstatus").alias("league"),
        entries.alias("entries"))
    return flatten_entries(pages)


@query("S27 T2", """
SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 1000 GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 10 OFFSET 2
""")
def landed_clauses(t: Tables) -> DataFrame:
    """Where, join, group, order, limit and offset on landed tables."""
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return landed_query(
        t.orders, join=customers, join_on=["o_custkey"], where=F.col("o_totalprice") > 1000,
        group_by=["c_mktsegment", "o_orderstatus"], aggregates=[F.count(F.lit(1)).alias("n")],
        order_by=[F.col("n").desc(), "c_mktsegment", "o_orderstatus"], limit=10, offset=2)


_CHANGED = """
SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderpriority, 'F' AS o_orderstatus
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O'
"""


@query("S13 S14 S16 S25 K7", f"""
WITH changed AS ({_CHANGED})
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed)
UNION ALL SELECT * FROM changed
""")
def upserted_twice(t: Tables) -> DataFrame:
    """Urgent orders closed by an upsert that moves keys between partitions; repeating it is harmless."""
    store = store_for(t, {"orders": ORDERS})
    store.write("orders", t.orders, "overwrite")
    changed = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("F")})
    store.write("orders", changed, "upsert")
    store.write("orders", changed, "upsert")
    return store.scan("orders").select(*ORDERS.schema.names)


@query("K7 S13", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def partitions_built(t: Tables) -> DataFrame:
    """A table filled by one batch per partition, the last batch repeated."""
    store = store_for(t, {"orders": ORDERS})
    for status in ("F", "O", "P", "P"):
        run_partition(t.orders, store, "orders", lambda df: df.withColumn("o_totalprice", F.col("o_totalprice") * 2), o_orderstatus=status)
    return store.scan("orders").select(*ORDERS.schema.names)


_SERVER_LIST = ", ".join(f"'{s}'" for names in SERVERS.values() for s in names)


@query("J18 J12", f"""
WITH placed AS (SELECT c_custkey, [{_SERVER_LIST}][c_custkey % {sum(map(len, SERVERS.values()))} + 1] AS server FROM customer)
SELECT CASE {' '.join(f"WHEN server IN ({', '.join(repr(s) for s in names)}) THEN '{r}'" for r, names in SERVERS.items())} END AS region,
  server, count(*) AS customers FROM placed GROUP BY ALL
""")
def customers_by_region(t: Tables) -> DataFrame:
    """Customers on servers, each server looked up in the list of regions."""
    names = F.array(*[F.lit(s) for values in SERVERS.values() for s in values])
    placed = t.customer.select(F.element_at(names, (F.col("c_custkey") % F.size(names) + 1).cast("int")).alias("server"))
    return placed.join(servers(t.spark), "server").groupBy("region", "server").agg(F.count(F.lit(1)).alias("customers"))


BY_DAY = TableSpec(
    struct({"o_orderkey": "long"}, {"o_totalprice": "double", "day": "date"}), keys=("o_orderkey",), partition_by=("day",))


@query("S13 S16", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate::DATE + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS day FROM orders
""")
def upserted_by_day(t: Tables) -> DataFrame:
    """Half of the orders changed in a table of a partition per day, a tenth of them moved to the next day."""
    store, o = store_for(t, {"orders": BY_DAY}), F.col("o_orderkey")
    orders = t.orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    store.write("orders", orders, "overwrite")
    moved = F.when(o % 10 == 0, F.date_add("day", 1)).otherwise(F.col("day"))
    store.write("orders", orders.where(o % 2 == 0).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "day": moved}), "upsert")
    return store.scan("orders", ["o_orderkey", "o_totalprice", "day"])


@query("S12 S14 S15", """
SELECT c_custkey, c_name, c_acctbal::FLOAT AS c_acctbal FROM customer WHERE c_acctbal > 0
""")
def overwritten_snapshot(t: Tables) -> DataFrame:
    """A table replaced by a newer snapshot that was computed from the table itself."""
    spec = TableSpec(struct({"c_custkey": "long", "c_name": "string"}, {"c_acctbal": "float"}), keys=("c_custkey",))
    store = store_for(t, {"customer": spec})
    store.write("customer", t.customer, "overwrite")
    store.write("customer", store.scan("customer", where=F.col("c_acctbal") > 0), "overwrite")
    return store.scan("customer")


@query("S14", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def conformed(t: Tables) -> DataFrame:
    """Columns reordered, cast and checked against a declared schema."""
    return conform(t.nation.select("n_name", "n_regionkey", "n_nationkey"), struct({"n_nationkey": "long", "n_name": "string"}))


@query("S17", """
SELECT n_name, count(*) AS customers, sum(CAST(c_acctbal AS DECIMAL(18,2)))::DOUBLE AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name HAVING count(*) > 2
""")
def ad_hoc_sql(t: Tables) -> DataFrame:
    """SQL over registered tables and directly over files."""
    spec = TableSpec(struct({"c_custkey": "long"}, {"c_nationkey": "integer", "c_acctbal": "double"}))
    store = store_for(t, {"customer": spec, "never_written": spec})
    store.write("customer", t.customer)
    views = store.register_views()
    found = t.spark.sql(f"""
        SELECT n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM customer JOIN parquet.`{t.folder}/nation.parquet` ON c_nationkey = n_nationkey
        GROUP BY n_name HAVING count(*) > 2""")
    for view in views:  # the statement holds the tables by now; the session's other users must not meet the views
        t.spark.catalog.dropTempView(view)
    return found


@query("S18 S22", """
SELECT split || '_' || o_orderstatus AS config, split, o_orderstatus AS region, count(*) AS row_count
FROM (SELECT *, CASE WHEN o_totalprice > 400000 THEN 'test' ELSE 'train' END AS split FROM orders) GROUP BY ALL
""")
def published_splits(t: Tables) -> DataFrame:
    """Orders stored by split and region, and the manifest of what was stored."""
    path = t.scratch("splits")
    split = F.when(F.col("o_totalprice") > 400_000, "test").otherwise("train")
    store_splits(t.orders.withColumns({"split": split, "region": F.col("o_orderstatus")}), path)
    return split_manifest(t.spark.read.parquet(path))


@query("S21 N18 A9", """
SELECT 'geography' AS dataset, 'nation' AS config, 'train' AS split, 'nation/*.parquet' AS path, count(*) AS row_count FROM nation
UNION ALL SELECT 'geography', 'customer', 'train', 'customer/*.parquet', count(*) FROM customer
""")
def exported_tables(t: Tables) -> DataFrame:
    """Tables written for publishing with row counts observed on the way."""
    spec = ExportSpec("geography", "Nations and customers", "cc-by-4.0", {"nation": "Nations.", "customer": "Customers."})
    return export_tables(t.spark, spec, {"nation": t.nation, "customer": t.customer}, t.scratch("export"))


@query("S20", """
SELECT page_id, regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1) AS name, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page FROM pages
""")
def names_in_paths(t: Tables) -> DataFrame:
    """Last component and a parameter of an address."""
    page = F.nullif(F.regexp_extract("url", r"[?&]page=([0-9]+)", 1), F.lit(""))
    return t.pages.select("page_id", object_name(F.col("url")).alias("name"), page.alias("page"))


@query("S20", """
SELECT doc_id, lang, source FROM documents
""")
def values_in_paths(t: Tables) -> DataFrame:
    """``name=value`` parts of a path as columns."""
    path = F.concat(F.lit("/root/lang="), "lang", F.lit("/source="), "source", F.lit("/x.parquet"))
    return path_parts(t.documents.select("doc_id", path.alias("path")), "lang", "source").drop("path")


@query("S4", "SELECT count(*) AS pages FROM pages")
def object_by_extension(t: Tables) -> DataFrame:
    """A file read by its extension."""
    return read_object(t.spark, f"{t.folder}/pages.parquet").agg(F.count(F.lit(1)).alias("pages"))


@query("H14 Q9", """
SELECT o_orderkey, year(d)::INTEGER AS year, month(d)::INTEGER AS month, strftime(d, '%Y%m%d') AS week_of,
  (d - (dayofweek(d))::INTEGER)::DATE AS sunday, date_trunc('week', d)::DATE AS monday
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
""")
def week_parts(t: Tables) -> DataFrame:
    """Path parts of a weekly snapshot and the first day of the week."""
    from chronofold.functions.values import monday_of, sunday_of

    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", *[v.alias(k) for k, v in partition_parts(day).items()],
                           sunday_of(day).alias("sunday"), monday_of(day).alias("monday"))
