"""Join kinds."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.operators import analysis as AN
from beaconry.operators import quality as QC
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.registry import query
from beaconry.sources.tables import table


@query("j01_inner_fact_dimension", "hour_label:s total_incidents:i",
       f"WITH {O.EV} SELECT lpad(CAST(incident_hour AS VARCHAR), 2, '0') || ':00' AS hour_label, COUNT(*) AS total_incidents FROM ev GROUP BY 1")
def inner_fact_dimension(spark, folder):
    fact, dims = A.star(spark, folder)
    return fact.groupBy("time_key").agg(F.count("*").alias("total_incidents")).join(dims["time"], "time_key")


@query("j02_left_broadcast", "r_name:s n:i", "SELECT r_name, COUNT(*) AS n FROM events LEFT JOIN region ON user_id % 7 = r_regionkey GROUP BY 1")
def left_broadcast(spark, folder):
    e, r = table(spark, folder, "events"), table(spark, folder, "region")
    return e.join(r, e.user_id % 7 == r.r_regionkey, "left").groupBy("r_name").agg(F.count("*").alias("n"))


@query("j03_left_on_expression", "n_name:s customers:i balance:f2",
       "SELECT n_name, COUNT(*) AS customers, SUM(c_acctbal) AS balance FROM customer LEFT JOIN nation ON c_nationkey + 1 = n_nationkey GROUP BY 1")
def left_on_expression(spark, folder):
    c, n = table(spark, folder, "customer").alias("c"), table(spark, folder, "nation").alias("n")
    joined = c.join(n, F.col("c.c_nationkey") + 1 == F.col("n.n_nationkey"), "left")
    return joined.groupBy("n.n_name").agg(F.count("*").alias("customers"), F.sum("c.c_acctbal").alias("balance"))


@query("j04_left_anti_orphans", "k:i", "SELECT DISTINCT user_id AS k FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")
def left_anti_orphans(spark, folder):
    return QC.orphan_keys(table(spark, folder, "events"), "user_id", table(spark, folder, "supplier"), "s_suppkey")


@query("j05_full_outer", "key:i orders:i lines:i",
       """WITH o AS (SELECT o_custkey AS k, COUNT(*) AS n FROM orders GROUP BY 1), l AS (SELECT l_suppkey AS k, COUNT(*) AS n FROM lineitem GROUP BY 1)
       SELECT COALESCE(o.k, l.k) AS key, COALESCE(o.n, 0) AS orders, COALESCE(l.n, 0) AS lines FROM o FULL JOIN l ON o.k = l.k""")
def full_outer(spark, folder):
    """Orders by customer key beside lines by supplier key: keys of either side alone count zero on the other."""
    o = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("orders"))
    li = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("key")).agg(F.count("*").alias("lines"))
    return o.join(li, "key", "full").fillna(0, ["orders", "lines"])


@query("j06_one_row_total", "event_type:s total_incidents:i incident_percentage:f6",
       "SELECT event_type, COUNT(*) AS total_incidents, COUNT(*) * 100.0 / (SELECT COUNT(*) FROM events) AS incident_percentage FROM events GROUP BY 1")
def one_row_total(spark, folder):
    return AN.share_of(AN.counts(table(spark, folder, "events"), ["event_type"]))


@query("j07_multi_left_null_test", "check_name:s issues:i",
       """WITH l AS (SELECT l_suppkey, l_partkey FROM lineitem UNION ALL SELECT -s_suppkey, NULL FROM supplier UNION ALL SELECT NULL, -p_partkey FROM part)
       SELECT 'l_suppkey' AS check_name, COUNT(*) FILTER (WHERE s_suppkey IS NULL AND l_suppkey IS NOT NULL) AS issues FROM l LEFT JOIN supplier ON l_suppkey = s_suppkey
       UNION ALL SELECT 'l_partkey', COUNT(*) FILTER (WHERE p_partkey IS NULL AND l_partkey IS NOT NULL) FROM l LEFT JOIN part ON l_partkey = p_partkey""")
def multi_left_null_test(spark, folder):
    """Orphans are planted as further lines: one for each supplier and one for each part."""
    s, p = table(spark, folder, "supplier"), table(spark, folder, "part")
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey")
    none = F.lit(None).cast("long")
    lines = lines.unionByName(s.select((-F.col("s_suppkey")).alias("l_suppkey"), none.alias("l_partkey"))).unionByName(
        p.select(none.alias("l_suppkey"), (-F.col("p_partkey")).alias("l_partkey")))
    return QC.orphans_in_one_pass(lines, [("l_suppkey", s, "s_suppkey"), ("l_partkey", p, "p_partkey")])


@query("j08_group_to_parent", "borough:s incident_disposition_code:s total_incidents:i parent_incidents:i parent_percentage:f6",
       f"""WITH {O.EV}, g AS (SELECT borough, incident_disposition_code, COUNT(*) AS total_incidents FROM ev GROUP BY ALL),
       p AS (SELECT borough, SUM(total_incidents) AS parent_incidents FROM g GROUP BY 1)
       SELECT *, total_incidents * 100.0 / parent_incidents AS parent_percentage FROM g JOIN p USING (borough)""")
def group_to_parent(spark, folder):
    g = AN.counts(A.event_view(spark, folder), ["borough", "incident_disposition_code"])
    return AN.share_of(g, within=["borough"], name="parent_percentage", total="parent_incidents")


@query("j09_star_join", "c_region:s s_nation:s lines:i revenue:f4",
       """SELECT r_name AS c_region, sn.n_name AS s_nation, COUNT(*) AS lines, SUM(l_extendedprice * (1 - l_discount)) AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
       JOIN region ON cn.n_regionkey = r_regionkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL""")
def star_join(spark, folder):
    t = lambda n: table(spark, folder, n)
    buyers = (t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "c_nationkey"))
    # Keys travel and are summed; the names meet at most nations x nations rows.
    by_key = (t("lineitem").join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
              .groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v")))
    n, r = t("nation"), t("region")
    c_place = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("c_region"))
    s_place = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"))
    return (by_key.join(c_place, "c_nationkey").join(s_place, "s_nationkey").groupBy("c_region", "s_nation")
            .agg(F.sum("n").alias("lines"), F.sum("v").alias("revenue")))
