"""Property graphs built from the driver's tables.

G_a (events, multi-edges): ``user`` vertices (``user-%06d``), ``device``
vertices (one per ``k`` of ``props``, ``gmt_occur = 1704067200 + 3600 * k``),
one edge per event labelled with its ``event_type``.

G_b (order tables, two hops): ``customer, order, part, supplier, nation,
region`` vertices; edges ``placed`` customer->order, ``contains`` order->part
(``quantity``), ``supplied_by`` order->supplier, ``in_nation``
customer/supplier->nation, ``in_region`` nation->region. ``gmt_occur`` is the
order date in epoch seconds, ``amount`` is the part's retail price or the
supplier's account balance.

Vertex ids and edge ends are the tables' own keys; ``IDS`` turns them into the
public ids. The event graph reads ``k`` with the guarded JSON rule, as the
oracle does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayside.functions import epoch_seconds, with_json_scalar
from quayside.operators.graph import EdgePart, IdText, PropertyGraph
from quayside.sources.tables import table

# fixed values of the stand-in mapping
DEVICE_EPOCH = 1704067200
DEVICE_STEP = 3600
EVENT_LABELS = ("signup", "view", "click", "purchase", "error")
EVENT_IDS = {"user": IdText("user-", 6), "device": IdText("device-")}
ORDER_IDS = {l: IdText(f"{l}-") for l in ("customer", "order", "part", "supplier", "nation", "region")}


def event_graph(spark: SparkSession, base: str) -> PropertyGraph:
    ev = table(spark, base, "events", ["event_id", "user_id", "event_type", "value", "props"])
    keyed = with_json_scalar(ev, "props", "$.k", "_k", "k").where(F.col("k").isNotNull())
    users = ev.select(F.col("user_id").alias("id"), "user_id").distinct()
    devices = (keyed.select("k").distinct()
               .select(F.col("k").alias("id"), "k",
                       (F.lit(DEVICE_EPOCH) + F.lit(DEVICE_STEP) * F.col("k")).cast("bigint").alias("gmt_occur")))
    # one label-partitioned edge table: a hop over several labels is one scan
    edges = keyed.select(F.col("user_id").alias("src"), F.col("k").alias("dst"), F.col("event_type").alias("label"),
                         "event_id", F.col("value").alias("amount"))
    # an edge's own k says when its device occurred: filters on it need no look at the devices
    occurred = (F.lit(DEVICE_EPOCH) + F.lit(DEVICE_STEP) * F.col("dst")).cast("bigint")
    return PropertyGraph({"user": users, "device": devices}, ids=EVENT_IDS,
                         parts=[EdgePart(edges, EVENT_LABELS, True, "user", "device", {"gmt_occur": occurred})])


def order_graph(spark: SparkSession, base: str) -> PropertyGraph:
    cust = table(spark, base, "customer")
    orders = table(spark, base, "orders")
    part = table(spark, base, "part")
    supp = table(spark, base, "supplier")
    nation = table(spark, base, "nation")
    region = table(spark, base, "region")
    li = table(spark, base, "lineitem")

    def vertex(df, key, **props):
        return df.select(F.col(key).alias("id"), *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in props.items()])

    def edge(label, df, src, dst, src_label, dst_label, **props):
        ends = df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *[F.col(c).alias(n) for n, c in props.items()])
        return EdgePart(ends, (label,), False, src_label, dst_label)

    vertices = {
        "customer": vertex(cust, "c_custkey", name="c_name", mktsegment="c_mktsegment", acctbal="c_acctbal"),
        "order": vertex(orders, "o_orderkey", gmt_occur=epoch_seconds("o_orderdate"), status="o_orderstatus",
                        totalprice="o_totalprice"),
        "part": vertex(part, "p_partkey", name="p_name", brand="p_brand", amount="p_retailprice"),
        "supplier": vertex(supp, "s_suppkey", name="s_name", amount="s_acctbal"),
        "nation": vertex(nation, "n_nationkey", name="n_name"),
        "region": vertex(region, "r_regionkey", name="r_name"),
    }
    parts = [
        edge("placed", orders, "o_custkey", "o_orderkey", "customer", "order"),
        edge("contains", li, "l_orderkey", "l_partkey", "order", "part", quantity="l_quantity"),
        edge("supplied_by", li, "l_orderkey", "l_suppkey", "order", "supplier"),
        edge("in_nation", cust, "c_custkey", "c_nationkey", "customer", "nation"),
        edge("in_nation", supp, "s_suppkey", "s_nationkey", "supplier", "nation"),
        edge("in_region", nation, "n_nationkey", "n_regionkey", "nation", "region"),
    ]
    return PropertyGraph(vertices, parts=parts, ids=ORDER_IDS)
