"""Edge-table, plan-audit and scenario operators.

Path problems iterate joins until no distance improves; chains are contracted
first, and each round is cut with a reliable checkpoint into the shared
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import cut_lineage


def _contract(edges: DataFrame, source, combine) -> tuple[DataFrame, DataFrame]:
    """(edges, inner): the graph without its chain nodes.

    A node that is not the source and has one edge in and one out can only be passed through.  Each
    such ``inner`` node is given the first node of its chain (``start``) and the cost from there, by
    pointer doubling, so a chain of n nodes takes log2(n) rounds.  Edges that leave a chain are moved
    to its start.  Inner nodes that never find a start lie on a closed ring and cannot be reached.
    """
    outs = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    ins = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("start"),
                                                       F.min("cost").alias("cost"))
    once = ins.join(outs, "node").where((F.col("n_in") == 1) & (F.col("n_out") == 1)
                                        & (F.col("node") != F.lit(source)) & (F.col("start") != F.col("node")))
    inner = cut_lineage(once.select("node", "start", "cost"))
    left, rounds = inner.count(), 0
    size = left
    while left and rounds <= max(1, size).bit_length():
        up = inner.select(F.col("node").alias("_n"), F.col("start").alias("_s"), F.col("cost").alias("_c"))
        inner = cut_lineage(inner.join(up, F.col("start") == F.col("_n"), "left").select(
            "node", F.coalesce("_s", "start").alias("start"),
            F.when(F.col("_n").isNull(), F.col("cost")).otherwise(combine(F.col("_c"), F.col("cost"))).alias("cost"),
            F.col("_n").isNotNull().alias("moved")))
        left, rounds = inner.where("moved").count(), rounds + 1
        inner = inner.drop("moved")
    inner = inner.join(inner.select(F.col("node").alias("start")), "start", "left_anti")  # rings
    inner = cut_lineage(inner.select("node", "start", "cost"))
    ends = edges.join(once.select(F.col("node").alias("dst")), "dst", "left_anti")
    start = inner.select(F.col("node").alias("_n"), F.col("start").alias("_s"), F.col("cost").alias("_c"))
    ends = ends.join(start, F.col("src") == F.col("_n"), "left").select(
        F.coalesce("_s", "src").alias("src"), "dst",
        F.when(F.col("_n").isNull(), F.col("cost")).otherwise(combine(F.col("_c"), F.col("cost"))).alias("cost"))
    return cut_lineage(ends.groupBy("src", "dst").agg(F.min("cost").alias("cost"))), inner


def _relax(edges: DataFrame, source, combine) -> DataFrame:
    """Distances from ``source``, relaxed until no node improves.

    Only nodes that improved in the last round send on their distance.  Chains are contracted first,
    so the number of rounds follows the branching of a path, not its length; there is no limit on it.
    Costs that fall without end (a negative cycle) raise an error once there have been more rounds
    than nodes.
    """
    e = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"),
                     F.col("cost").cast("double").alias("cost"))
    e = cut_lineage(e.groupBy("src", "dst").agg(F.min("cost").alias("cost")))
    short, inner = _contract(e, int(source), combine)
    nodes = short.select("src").union(short.select("dst")).distinct().count() + 1
    dist = cut_lineage(e.sparkSession.range(1).select(F.lit(int(source)).cast("long").alias("node"), F.lit(0.0).alias("dist"),
                                                      F.lit(True).alias("fresh")))
    for _ in range(nodes + 1):
        sent = dist.where("fresh").join(short, F.col("node") == F.col("src")).select(
            F.col("dst").alias("node"), combine(F.col("dist"), F.col("cost")).alias("new"))
        best = sent.groupBy("node").agg(F.min("new").alias("new"))
        better = F.col("new").isNotNull() & (F.col("dist").isNull() | (F.col("new") < F.col("dist")))
        dist = cut_lineage(dist.join(best, "node", "full_outer").select(
            "node", F.when(better, F.col("new")).otherwise(F.col("dist")).alias("dist"), better.alias("fresh")))
        if not dist.where("fresh").limit(1).count():
            break
    else:
        raise ValueError("a negative cycle can be reached from the source")
    dist = dist.select("node", "dist")
    along = inner.join(dist.withColumnRenamed("node", "start"), "start").select("node", combine(F.col("dist"), F.col("cost")).alias("dist"))
    return dist.union(along)


def shortest_paths(edges: DataFrame, source: int) -> DataFrame:
    """Minimum total cost from ``source`` to every reachable node."""
    return _relax(edges, source, lambda d, c: d + c)


def bottleneck_paths(edges: DataFrame, source: int) -> DataFrame:
    """Minimise the largest edge cost along the path."""
    return _relax(edges, source, lambda d, c: F.greatest(d, c))


def flow_in_out(flows: DataFrame, value: str = "flow") -> DataFrame:
    """Inflow and outflow per node (full outer join of the two sums)."""
    out = flows.groupBy(F.col("src").alias("node")).agg(F.sum(value).alias("outflow"))
    inn = flows.groupBy(F.col("dst").alias("node")).agg(F.sum(value).alias("inflow"))
    j = out.join(inn, "node", "full_outer")
    return j.select("node", F.coalesce("inflow", F.lit(0.0)).alias("inflow"), F.coalesce("outflow", F.lit(0.0)).alias("outflow"))


def audit_flow(flows: DataFrame, source: int, sink: int, flow: str = "flow", lower: str | None = None,
               upper: str = "cap", cost: str = "cost") -> tuple[DataFrame, DataFrame]:
    """Conservation per node (source/sink exempt) and bound violations per edge.

    Sums of doubles differ in their last digits with the order of the rows, so an imbalance counts
    from a billionth of the flow on.  Returns (node balance table, edge violations table)."""
    bal = flow_in_out(flows, flow).withColumn("imbalance", F.col("inflow") - F.col("outflow"))
    bal = bal.withColumn("violates", (F.abs("imbalance") > 1e-9 * F.greatest("inflow", "outflow")) & ~F.col("node").isin(source, sink))
    lo = F.col(lower) if lower else F.lit(0.0)
    viol = flows.withColumn("below", F.col(flow) < lo).withColumn("above", F.col(flow) > F.col(upper)).withColumn(
        "flow_cost", F.col(flow) * F.col(cost))
    return bal, viol


def weighted_cost(plan: DataFrame, keys: Sequence[str], qty: str, cost: str) -> DataFrame:
    """Σ cost · quantity with rollup subtotals over ``keys``."""
    return plan.rollup(*keys).agg(F.sum(F.col(cost) * F.col(qty)).alias("total_cost"))


def audit_transport(plan: DataFrame, supply: DataFrame, demand: DataFrame) -> DataFrame:
    """Per node shipped out vs supply and shipped in vs demand (full outer joins), plus cost out."""
    out = plan.groupBy(F.col("src").alias("node")).agg(F.sum("qty").alias("shipped_out"),
                                                       F.sum(F.col("qty") * F.col("cost")).alias("cost_out"))
    inn = plan.groupBy(F.col("dst").alias("node")).agg(F.sum("qty").alias("shipped_in"))
    j = supply.join(demand, "node", "full_outer").join(out, "node", "full_outer").join(inn, "node", "full_outer")
    z = F.lit(0.0)
    return j.select(
        "node", F.coalesce("supply", z).alias("supply"), F.coalesce("shipped_out", z).alias("shipped_out"),
        F.coalesce("demand", z).alias("demand"), F.coalesce("shipped_in", z).alias("shipped_in"),
        F.coalesce("cost_out", z).alias("cost_out"),
    ).withColumn("unused_supply", F.col("supply") - F.col("shipped_out")).withColumn(
        "unmet_demand", F.col("demand") - F.col("shipped_in"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps, whose number grows with the logarithm of the size.
    Each step only needs the smallest neighbour of a node, which is aggregated before the shuffle, and
    a join by node, so a hub never gathers its neighbours in one task.  Every round is cut by a
    reliable checkpoint; the loop ends when a round changes nothing.
    """
    e = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    alone = e.where("hi = lo").select(F.col("hi").alias("node"), F.col("hi").alias("root"))
    e = cut_lineage(e.where("hi <> lo").distinct())
    seen = None
    while True:
        # large star: larger neighbours of u move to the smallest of u and its neighbours
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = cut_lineage(small.union(least.select("hi", F.col("m").alias("lo"))).distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    found = e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(e.select("lo", "lo").distinct())
    return found.union(alone.distinct().join(found.select("node"), "node", "left_anti"))


def components(arcs: DataFrame) -> DataFrame:
    """Connected components (undirected) of arcs (src, dst) as (node, comp)."""
    return connected(arcs.select(F.col("src").alias("a"), F.col("dst").alias("b"))).withColumnRenamed("root", "comp")


def tour_audit(arcs: DataFrame) -> DataFrame:
    """Degree checks per node and subtours (components) with their length."""
    outd = arcs.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("out_degree"))
    ind = arcs.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("in_degree"))
    comp = components(arcs)
    deg = outd.join(ind, "node", "full_outer").join(comp, "node", "left")
    length = arcs.join(comp, arcs.src == comp.node).groupBy("comp").agg(F.sum("cost").alias("tour_length"),
                                                                        F.count("*").alias("arcs"))
    return deg.join(length, "comp", "left")


def cross_scenarios(plan: DataFrame, scenarios: Sequence[tuple[int, float, float]]) -> DataFrame:
    """Every plan row under every scenario; the scenario list is a literal generated per row."""
    arr = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(float(f)).alias("factor"), F.lit(float(p)).alias("prob"))
                    for s, f, p in scenarios])
    return plan.withColumn("_s", F.explode(arr)).select("*", "_s.*").drop("_s")


def expected_value(per_scenario: DataFrame, plan: str, ret: str) -> DataFrame:
    """Probability-weighted return per plan and the best plan."""
    ev = per_scenario.groupBy(plan).agg(F.sum(F.col("prob") * F.col(ret)).alias("expected_return"))
    w = Window.partitionBy().orderBy(F.desc("expected_return"), F.col(plan))  # one row per plan
    return ev.withColumn("is_best", F.row_number().over(w) == 1)


def audit_resources(selection: DataFrame, plan: str, usage: str, value: str, limit: float) -> DataFrame:
    """Per plan, resource use vs limit, objective, slack."""
    g = selection.groupBy(plan).agg(F.sum(usage).alias("used"), F.sum(value).alias("objective"), F.count("*").alias("items"))
    return g.withColumn("limit", F.lit(float(limit))).withColumn("slack", F.col("limit") - F.col("used")).withColumn(
        "feasible", F.col("used") <= F.col("limit"))


def strategy_payoff(matrix: DataFrame, mixture: DataFrame, row: str, col: str, payoff: str, weight: str) -> DataFrame:
    """Expected payoff of a mixed row strategy against each column move; the guaranteed value is the minimum."""
    j = matrix.join(mixture, row)
    per = j.groupBy(col).agg(F.sum(F.col(weight) * F.col(payoff)).alias("payoff"))
    w = Window.partitionBy().orderBy("payoff", col)  # one row per column move
    return per.withColumn("is_guaranteed", F.row_number().over(w) == 1)


def inventory_balance(plan: DataFrame, period: str, production: str, demand: str) -> DataFrame:
    """Stock s_t = s_{t−1} + x_t − d_t with s_0 = 0 (a running sum, range by range)."""
    from lodestar.operators.prefix import running_totals

    return running_totals(plan, [(period, True)], {"stock": F.col(production) - F.col(demand)})


def audit_production(balance: DataFrame, capacity: float, setup: float, unit: float, holding: float,
                     production: str = "production") -> DataFrame:
    """Capacity and stock checks with total set-up, production and holding cost."""
    x = F.col(production)
    return balance.agg(
        F.sum(F.when(x > 0, F.lit(setup)).otherwise(F.lit(0.0)) + x * unit + F.greatest(F.col("stock"), F.lit(0.0)) * holding).alias("total_cost"),
        F.sum((x > capacity).cast("int")).alias("over_capacity"),
        F.sum((F.col("stock") < 0).cast("int")).alias("short_periods"),
        F.count("*").alias("periods"),
    )
