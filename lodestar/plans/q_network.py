"""Network, plan-audit and scenario queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import network, spatial
from lodestar.plans import derived
from lodestar.plans.derived import EDGES_SQL, PLANS_SQL, SCENARIOS_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import cut_lineage, table

ROUNDS = 25  # the oracle's relaxations; paths over the parts that follow each other are far shorter


def _bf_sql(combine: str) -> str:
    parts = [f"e AS ({EDGES_SQL})", "d0 AS (SELECT CAST(min(src) AS BIGINT) AS node, 0.0::DOUBLE AS dist FROM e)"]
    for i in range(1, ROUNDS):
        parts.append(
            f"d{i} AS (SELECT node, min(dist) AS dist FROM (SELECT node, dist FROM d{i-1} UNION ALL "
            f"SELECT CAST(e.dst AS BIGINT), {combine.format(d=f'd{i-1}.dist', c='e.cost')} FROM d{i-1} JOIN e ON d{i-1}.node = e.src) GROUP BY node)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT node, {R(f'd{ROUNDS-1}.dist')} AS dist FROM d{ROUNDS-1}"


def _source(edges: DataFrame) -> int:
    return int(edges.agg(F.min("src")).first()[0])  # one scalar


@register("shortest_paths", sql=_bf_sql("{d} + {c}"))
def shortest_paths_q(spark: SparkSession, sf: str) -> DataFrame:
    """Cheapest cost from the smallest source part to every reachable part."""
    e = derived.edges(spark, sf)
    d = network.shortest_paths(e, _source(e))
    return d.select("node", V.rnd("dist").alias("dist"))


@register("bottleneck_paths", sql=_bf_sql("greatest({d}, {c})"))
def bottleneck_paths_q(spark: SparkSession, sf: str) -> DataFrame:
    """Smallest achievable largest edge cost on a path from the source."""
    e = derived.edges(spark, sf)
    d = network.bottleneck_paths(e, _source(e))
    return d.select("node", V.rnd("dist").alias("dist"))


@register("flow_in_out", sql=f"""
WITH e AS ({EDGES_SQL}),
o AS (SELECT src AS node, sum(cap) AS outflow FROM e GROUP BY src), i AS (SELECT dst AS node, sum(cap) AS inflow FROM e GROUP BY dst)
SELECT coalesce(o.node, i.node) AS node, {R('coalesce(inflow, 0.0)', 2)} AS inflow, {R('coalesce(outflow, 0.0)', 2)} AS outflow
FROM o FULL OUTER JOIN i ON o.node = i.node
""")
def flow_in_out_q(spark: SparkSession, sf: str) -> DataFrame:
    """Inflow vs outflow per node (capacities as flows)."""
    f = network.flow_in_out(derived.edges(spark, sf), "cap")
    return f.select("node", V.rnd("inflow", 2).alias("inflow"), V.rnd("outflow", 2).alias("outflow"))


@register("audit_flow", sql=f"""
WITH e AS ({EDGES_SQL}), f AS (SELECT src, dst, least(cap, 30.0) AS flow FROM e),
o AS (SELECT src AS node, sum(flow) AS outflow FROM f GROUP BY src), i AS (SELECT dst AS node, sum(flow) AS inflow FROM f GROUP BY dst),
b AS (SELECT coalesce(o.node, i.node) AS node, coalesce(inflow, 0.0) AS inflow, coalesce(outflow, 0.0) AS outflow FROM o FULL OUTER JOIN i ON o.node = i.node)
SELECT node, {R('inflow', 2)} AS inflow, {R('outflow', 2)} AS outflow, {R('inflow - outflow', 2)} AS imbalance,
  (abs(inflow - outflow) > 1e-9 * greatest(inflow, outflow) AND node NOT IN ((SELECT min(src) FROM e), (SELECT max(dst) FROM e))) AS violates FROM b
""")
def audit_flow_q(spark: SparkSession, sf: str) -> DataFrame:
    """Conservation audit of a capped flow (min(cap, 30)) between the smallest source and largest sink."""
    e = derived.edges(spark, sf)
    s, t = e.agg(F.min("src"), F.max("dst")).first()  # two scalars
    bal, _ = network.audit_flow(e.withColumn("flow", F.least("cap", F.lit(30.0))), s, t)
    return bal.select("node", V.rnd("inflow", 2).alias("inflow"), V.rnd("outflow", 2).alias("outflow"),
                      V.rnd("imbalance", 2).alias("imbalance"), "violates")


@register("edge_bound_violations", sql=f"""
WITH e AS ({EDGES_SQL}), f AS (SELECT *, least(cap, 30.0) * 1.1 AS flow FROM e)
SELECT CAST(sum(CAST(flow > cap AS INTEGER)) AS BIGINT) AS above, CAST(sum(CAST(flow < 0 AS INTEGER)) AS BIGINT) AS below,
  {R('sum(flow * cost)', 2)} AS flow_cost FROM f
""")
def edge_bound_violations(spark: SparkSession, sf: str) -> DataFrame:
    """N3 (edges): bound violations and total cost of a flow 10 % above the capped one."""
    e = derived.edges(spark, sf).withColumn("flow", F.least("cap", F.lit(30.0)) * 1.1)
    _, v = network.audit_flow(e, 0, 0)
    return v.agg(F.sum(F.col("above").cast("int")).cast("long").alias("above"),
                 F.sum(F.col("below").cast("int")).cast("long").alias("below"),
                 V.rnd(F.sum("flow_cost"), 2).alias("flow_cost"))


@register("weighted_cost_rollup", sql=f"""
WITH e AS ({EDGES_SQL})
SELECT src, dst, {R('sum(cost * cap)', 2)} AS total_cost FROM e GROUP BY ROLLUP (src, dst)
""")
def weighted_cost_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Σ cost × quantity with rollup subtotals per source and a grand total."""
    r = network.weighted_cost(derived.edges(spark, sf), ["src", "dst"], "cap", "cost")
    return r.select("src", "dst", V.rnd("total_cost", 2).alias("total_cost"))


@register("audit_transport", sql=f"""
WITH e AS ({EDGES_SQL}),
sp AS (SELECT p_partkey AS node, sum(p_retailprice) / 10 AS supply FROM part GROUP BY 1),
dm AS (SELECT l_partkey AS node, sum(l_tax) * 100 AS demand FROM lineitem GROUP BY 1),
o AS (SELECT src AS node, sum(cap) AS shipped_out, sum(cap * cost) AS cost_out FROM e GROUP BY 1),
i AS (SELECT dst AS node, sum(cap) AS shipped_in FROM e GROUP BY 1),
j AS (SELECT coalesce(sp.node, dm.node, o.node, i.node) AS node, coalesce(supply, 0.0) AS supply, coalesce(shipped_out, 0.0) AS shipped_out,
        coalesce(demand, 0.0) AS demand, coalesce(shipped_in, 0.0) AS shipped_in, coalesce(cost_out, 0.0) AS cost_out
      FROM sp FULL OUTER JOIN dm ON sp.node = dm.node FULL OUTER JOIN o ON coalesce(sp.node, dm.node) = o.node
      FULL OUTER JOIN i ON coalesce(sp.node, dm.node, o.node) = i.node)
SELECT node, {R('supply', 4)} AS supply, {R('shipped_out', 4)} AS shipped_out, {R('demand', 4)} AS demand, {R('shipped_in', 4)} AS shipped_in,
  {R('cost_out', 4)} AS cost_out, {R('supply - shipped_out', 4)} AS unused_supply, {R('demand - shipped_in', 4)} AS unmet_demand FROM j
""")
def audit_transport_q(spark: SparkSession, sf: str) -> DataFrame:
    """Transport plan (edge capacities) against each part's supply and demand."""
    e = derived.edges(spark, sf).select("src", "dst", F.col("cap").alias("qty"), "cost")
    sp = table(spark, sf, "part").groupBy(F.col("p_partkey").alias("node")).agg((F.sum("p_retailprice") / 10).alias("supply"))
    dm = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("node")).agg((F.sum("l_tax") * 100).alias("demand"))
    a = network.audit_transport(e, sp, dm)
    return a.select("node", *[V.rnd(c, 4).alias(c) for c in
                              ["supply", "shipped_out", "demand", "shipped_in", "cost_out", "unused_supply", "unmet_demand"]])


def _points(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 1000.0).alias("x"),
                    (F.col("c_nationkey") / 5.0).alias("y"))


def _sites(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select(F.col("s_suppkey").alias("site_id"), (F.col("s_acctbal") / 1000.0).alias("x"),
                    (F.col("s_nationkey") / 5.0).alias("y"), "s_acctbal")


_PTS_SQL = """p AS (SELECT c_custkey AS point_id, c_acctbal / 1000.0 AS x, c_nationkey / 5.0 AS y FROM customer),
s AS (SELECT s_suppkey AS site_id, s_acctbal / 1000.0 AS x, s_nationkey / 5.0 AS y, s_acctbal FROM supplier)"""


@register("radius_join", sql=f"""
WITH {_PTS_SQL},
j AS (SELECT p.point_id, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d FROM p JOIN s ON
      sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) <= 0.5)
SELECT point_id, count(*) AS sites_in_range, {R('min(d)')} AS nearest FROM j GROUP BY point_id
""")
def radius_join_q(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers within 0.5 of each customer (cells of that side, cut where they are dense)."""
    j = spatial.radius_join(_points(spark, sf), _sites(spark, sf), 0.5, reduced=True)
    return j.groupBy("point_id").agg(F.sum("n").alias("sites_in_range"), V.rnd(F.min("nearest")).alias("nearest"))


@register("coverage", sql=f"""
WITH {_PTS_SQL}, ch AS (SELECT * FROM s WHERE s_acctbal > 5000)
SELECT point_id FROM p WHERE NOT EXISTS (SELECT 1 FROM ch WHERE sqrt((p.x - ch.x) * (p.x - ch.x) + (p.y - ch.y) * (p.y - ch.y)) <= 0.5)
""")
def coverage_q(spark: SparkSession, sf: str) -> DataFrame:
    """Customers left uncovered by the suppliers with balance above 5,000 (radius 0.5)."""
    s = _sites(spark, sf).where(F.col("s_acctbal") > 5000)
    return spatial.coverage(_points(spark, sf), s, 0.5).select("point_id")


@register("greedy_cover", sql=f"""
WITH {_PTS_SQL},
j AS (SELECT p.point_id, s.site_id FROM p JOIN s ON sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) <= 0.5)
SELECT count(DISTINCT point_id) AS coverable, count(DISTINCT point_id) AS covered, CAST(0 AS BIGINT) AS misordered,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM j GROUP BY site_id)) AS first_pick FROM j
""")
def greedy_cover_q(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy set cover of customers by suppliers within 0.5: every coverable customer is covered, the first
    pick covers most, and no later pick covers more than an earlier one."""
    pts, sites = _points(spark, sf), _sites(spark, sf)
    picks = cut_lineage(spatial.greedy_cover(pts, sites, 0.5))
    order = picks.select(F.col("site_id").alias("_id"), "pick")
    picked = sites.join(order, F.col("site_id").eqNullSafe(F.col("_id")), "left")
    reach = spatial.radius_join(pts, picked, 0.5, reduced=True, least="pick").groupBy("point_id").agg(F.min("least").alias("pick"))
    total = reach.agg(F.count(F.lit(1)).alias("coverable"), F.count("pick").alias("covered"))
    later = picks.select((F.col("pick") + 1).alias("pick"), F.col("n").alias("before")).join(picks, "pick")
    misordered = later.where("n > before").count()  # one number
    first = picks.where("pick = 1").agg(F.max("n")).first()[0]  # one number
    return total.select("*", F.lit(misordered).cast("long").alias("misordered"), F.lit(first).cast("long").alias("first_pick"))


_DENSE_SQL = """p AS (SELECT o_orderkey AS point_id, o_custkey % 83 / 9.0::DOUBLE AS x, o_orderkey % 97 / 11.0::DOUBLE AS y FROM orders),
c AS (SELECT c_custkey AS site_id, c_custkey % 71 / 5.0::DOUBLE - 2 AS x, c_custkey % 61 / 5.0::DOUBLE - 2 AS y FROM customer)"""


@register("range_counts", sql=f"""
WITH {_DENSE_SQL}
SELECT site_id, count(*) AS n FROM c JOIN p ON sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y)) <= 10 GROUP BY site_id
""")
def range_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    """J8 + N5: orders within 10 of every customer, where nearly all orders lie in one cell: nodes inside a circle are counted whole."""
    p = table(spark, sf, "orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_custkey") % 83 / 9.0).alias("x"), (F.col("o_orderkey") % 97 / 11.0).alias("y"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("site_id"), (F.col("c_custkey") % 71 / 5.0 - 2).alias("x"), (F.col("c_custkey") % 61 / 5.0 - 2).alias("y"))
    return spatial.range_counts(p, c, 10.0, leaf=256, block=512)


_ARCS_SQL = """a AS (SELECT CAST(n_nationkey AS BIGINT) AS src, CAST((n_nationkey * 7 + 3) % 25 AS BIGINT) AS dst,
        CAST(abs((n_nationkey * 7 + 3) % 25 - n_nationkey) AS BIGINT) AS cost FROM nation)"""


@register("tour_audit", sql=f"""
WITH RECURSIVE {_ARCS_SQL},
w(start, node, step) AS (SELECT src, src, 0 FROM a UNION ALL SELECT w.start, a.dst, w.step + 1 FROM w JOIN a ON w.node = a.src WHERE w.step < 25),
c AS (SELECT start AS node, min(node) AS comp FROM w GROUP BY start),
l AS (SELECT c.comp, sum(a.cost) AS tour_length, count(*) AS arcs FROM a JOIN c ON a.src = c.node GROUP BY c.comp)
SELECT c.node, c.comp, CAST(1 AS BIGINT) AS out_degree, CAST(1 AS BIGINT) AS in_degree, CAST(l.tour_length AS BIGINT) AS tour_length, l.arcs
FROM c JOIN l ON c.comp = l.comp
""")
def tour_audit_q(spark: SparkSession, sf: str) -> DataFrame:
    """Degrees and subtours of the assignment n → 7n + 3 (mod 25) over the nations."""
    n = table(spark, sf, "nation")
    a = n.select(F.col("n_nationkey").cast("long").alias("src"), ((F.col("n_nationkey") * 7 + 3) % 25).cast("long").alias("dst"))
    a = a.withColumn("cost", F.abs(F.col("dst") - F.col("src")))
    t = network.tour_audit(a)
    return t.select("node", "comp", "out_degree", "in_degree", F.col("tour_length").cast("long"), "arcs")


_SCEN = [(0, 0.8, 1.0 / 3), (1, 1.0, 1.0 / 3), (2, 1.2, 1.0 / 3)]


@register("expected_value", sql=f"""
WITH p AS ({PLANS_SQL}), sc AS ({SCENARIOS_SQL}),
r AS (SELECT plan, scenario, prob, sum(value * factor - 20.0 * usage) AS ret FROM p, sc GROUP BY plan, scenario, prob),
ev AS (SELECT plan, sum(prob * ret) AS expected_return FROM r GROUP BY plan),
m AS (SELECT plan, sum(value * 1.0 - 20.0 * usage) AS at_mean FROM p GROUP BY plan)
SELECT plan, {R('expected_return', 4)} AS expected_return, {R('at_mean', 4)} AS return_at_mean,
  row_number() OVER (ORDER BY expected_return DESC, plan) = 1 AS is_best FROM ev JOIN m USING (plan)
""")
def expected_value_q(spark: SparkSession, sf: str) -> DataFrame:
    """N8 + J10: each plan under three yield scenarios; expected return, return at the mean scenario, best plan."""
    p = derived.plans(spark, sf)
    x = network.cross_scenarios(p, _SCEN).withColumn("ret", F.col("value") * F.col("factor") - 20.0 * F.col("usage"))
    per = x.groupBy("plan", "scenario", "prob").agg(F.sum("ret").alias("ret"))
    ev = network.expected_value(per, "plan", "ret")
    mean_factor = sum(f * q for _, f, q in _SCEN)
    at_mean = p.groupBy("plan").agg(F.sum(F.col("value") * mean_factor - 20.0 * F.col("usage")).alias("at_mean"))
    j = ev.join(at_mean, "plan")
    return j.select("plan", V.rnd("expected_return", 4).alias("expected_return"), V.rnd("at_mean", 4).alias("return_at_mean"), "is_best")


@register("audit_resources", sql=f"""
WITH p AS ({PLANS_SQL})
SELECT plan, CAST(sum(usage) AS BIGINT) AS used, {R('sum(value)', 2)} AS objective, count(*) AS items, 15000.0 AS "limit",
  {R('15000.0 - sum(usage)', 2)} AS slack, sum(usage) <= 15000.0 AS feasible FROM p GROUP BY plan
""")
def audit_resources_q(spark: SparkSession, sf: str) -> DataFrame:
    """Each plan's resource use (Σ size) against a limit of 15,000, objective and slack."""
    a = network.audit_resources(derived.plans(spark, sf), "plan", "usage", "value", 15000.0)
    return a.select("plan", F.col("used").cast("long"), V.rnd("objective", 2).alias("objective"), "items", "limit",
                    V.rnd("slack", 2).alias("slack"), "feasible")


@register("strategy_payoff", sql=f"""
WITH m AS (SELECT p_brand, p_type, avg(p_retailprice) AS payoff FROM part GROUP BY 1, 2),
x AS (SELECT p_brand, count(*) * 1.0 / sum(count(*)) OVER () AS weight FROM part GROUP BY 1),
c AS (SELECT p_type, sum(weight * payoff) AS payoff FROM m JOIN x USING (p_brand) GROUP BY p_type)
SELECT p_type, {R('payoff', 4)} AS payoff, row_number() OVER (ORDER BY payoff, p_type) = 1 AS is_guaranteed FROM c
""")
def strategy_payoff_q(spark: SparkSession, sf: str) -> DataFrame:
    """Brand-mix strategy against each part type: expected payoff, and the guaranteed (minimum) move."""
    part = table(spark, sf, "part")
    m = part.groupBy("p_brand", "p_type").agg(F.avg("p_retailprice").alias("payoff"))
    from pyspark.sql import Window

    x = part.groupBy("p_brand").agg(F.count("*").alias("n")).withColumn(
        "weight", F.col("n") / F.sum("n").over(Window.partitionBy()))  # one row per brand
    s = network.strategy_payoff(m, x, "p_brand", "p_type", "payoff", "weight")
    return s.select("p_type", V.rnd("payoff", 4).alias("payoff"), "is_guaranteed")


_INV_SQL = """d AS (SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS period, sum(l_quantity) AS demand FROM lineitem GROUP BY 1),
pr AS (SELECT round(avg(demand)) AS production FROM d),
b AS (SELECT period, demand, production, sum(production - demand) OVER (ORDER BY period) AS stock FROM d, pr)"""


def _inventory(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    d = li.groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("long").alias("period")).agg(
        F.sum("l_quantity").alias("demand"))
    prod = d.agg(F.round(F.avg("demand"))).first()[0]  # one scalar: the level production plan
    d = d.withColumn("production", F.lit(float(prod)))
    return network.inventory_balance(d, "period", "production", "demand")


@register("inventory_balance", sql=f"""
WITH {_INV_SQL}
SELECT period, {R('demand', 2)} AS demand, {R('production', 2)} AS production, {R('stock', 2)} AS stock FROM b
""")
def inventory_balance_q(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly stock under a level production plan, s_t = s_{t−1} + x_t − d_t."""
    b = _inventory(spark, sf)
    return b.select("period", V.rnd("demand", 2).alias("demand"), V.rnd("production", 2).alias("production"),
                    V.rnd("stock", 2).alias("stock"))


@register("audit_production", sql=f"""
WITH {_INV_SQL}
SELECT {R('sum(CASE WHEN production > 0 THEN 100.0 ELSE 0.0 END + production * 2.0 + greatest(stock, 0.0) * 0.5)', 2)} AS total_cost,
  CAST(sum(CAST(production > 1.2 * (SELECT avg(demand) FROM d) AS INTEGER)) AS BIGINT) AS over_capacity,
  CAST(sum(CAST(stock < 0 AS INTEGER)) AS BIGINT) AS short_periods, count(*) AS periods FROM b
""")
def audit_production_q(spark: SparkSession, sf: str) -> DataFrame:
    """The level plan's set-up, unit and holding cost, capacity (1.2 × mean demand) and shortage checks."""
    b = _inventory(spark, sf)
    cap = 1.2 * b.agg(F.avg("demand")).first()[0]  # one scalar
    a = network.audit_production(b, cap, 100.0, 2.0, 0.5)
    return a.select(V.rnd("total_cost", 2).alias("total_cost"), F.col("over_capacity").cast("long"),
                    F.col("short_periods").cast("long"), "periods")
