"""Graph scenario of the smoke app and the load-test query shapes (FIXTURES.md section 5)."""

import pytest
from pyspark.sql import functions as F

from quayside.operators.graph import EdgePart, IdText, PropertyGraph


def _airports(spark):
    # fixed values: codes and names of the scenario
    empty_route = spark.createDataFrame([], "src string, dst string, distance long, airline string")
    empty_serves = spark.createDataFrame([], "src string, dst string, service_type string")
    g = PropertyGraph({"airport": spark.createDataFrame([], "id string, code string, name string, city string, country string"),
                       "airline": spark.createDataFrame([], "id string, code string, name string, country string")},
                      {"route": empty_route, "serves": empty_serves})
    g = g.add_vertices("airport", spark.createDataFrame(
        [("a1", "TEST1", "Test Airport 1", "Test City 1", "Test Country"),
         ("a2", "TEST2", "Test Airport 2", "Test City 2", "Test Country")],
        "id string, code string, name string, city string, country string"))
    g = g.add_vertices("airline", spark.createDataFrame([("l1", "TESTAIR", "Test Airline", "Test Country")],
                                                        "id string, code string, name string, country string"))
    g = g.add_edges("route", g.has("code", "TEST1"), g.has("code", "TEST2"), {"distance": 1000, "airline": "TESTAIR"})
    g = g.add_edges("serves", g.has("code", "TESTAIR", label="airline"), g.has("code", "TEST1", label="airport"),
                    {"service_type": "domestic"})
    g = g.add_edges("route", g.has("code", "TEST2"), g.has("code", "TEST1"), {"distance": 1000, "airline": "TESTAIR"})
    return g


def test_airport_scenario(spark):
    g = _airports(spark)
    assert g.vertex_count().first().n_vertices == 3
    assert g.edge_count().first().n_edges == 3
    vals = g.out_values(g.has("code", "TEST1"), "route", ["code", "name"]).collect()
    assert sorted(r.prop_value for r in vals) == ["TEST2", "Test Airport 2"]
    routes = g.edges_where_source("route", "code", ["TEST1", "TEST2"]).collect()
    assert len(routes) == 2
    after = g.drop_edges_where_source("code", ["TEST1", "TEST2"])
    assert {r.label: r.n for r in after.counts_by_label().where("kind = 'edge'").collect()} == {"route": 0, "serves": 1}
    gone = g.drop_vertices("code", ["TEST1", "TEST2", "TESTAIR"])
    assert gone.edge_count().first().n_edges == 0 and gone.vertex_count().first().n_vertices == 0


def test_rerun_adds_again(spark):
    g = _airports(spark)
    rows = spark.createDataFrame([("a9", "TEST1", "again", None, None)], "id string, code string, name string, city string, country string")
    assert g.add_vertices("airport", rows).has("code", "TEST1").count() == 2


def _load_graph(spark):
    users = spark.createDataFrame([("user-000001",), ("user-000002",), ("user-000003",)], "id string")
    devices = spark.createDataFrame([("d1", 100), ("d2", 50), ("d3", None), ("d4", 100)], "id string, gmt_occur long")
    accounts = spark.createDataFrame([("acc1", 999.0), ("acc2", 1000.0), ("acc3", 499.0), ("acc4", 500.0)], "id string, amount double")
    e = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    edges = {
        "uses_device": e([("user-000001", "d1"), ("user-000001", "d1"), ("user-000001", "d2"), ("user-000001", "d3"),
                          ("user-000002", "d4")]),
        "uses_ip": e([]), "uses_email": e([]), "uses_oneid": e([]), "recommends": e([]),
        "deposits_from": e([("d1", "acc2"), ("d1", "acc2"), ("d4", "acc1")]),
        "withdraws_to": e([("d1", "acc3"), ("d4", "acc4")]), "transfers_to": e([]),
    }
    return PropertyGraph({"user": users, "device": devices, "account": accounts}, edges)


FAST = ["uses_device", "uses_ip", "uses_email", "uses_oneid", "recommends"]


def test_fast_bag_semantics_and_bound(spark):
    g = _load_graph(spark)
    centres = spark.createDataFrame([("user-000001",)], "id string")
    got = sorted(r.neighbour_id for r in g.neighbours(centres, FAST, "gmt_occur", 100).collect())
    assert got == ["d1", "d1"]              # parallel edges give two rows; gmt_occur == bound kept; d3 (missing) dropped
    union = sorted(r.neighbour_id for r in g.neighbours_union(centres, FAST, "gmt_occur", 100).collect())
    assert union == got


def test_medium_and_slow_semi_join(spark):
    g = _load_graph(spark)
    centres = spark.createDataFrame([("user-000001",), ("user-000002",)], "id string")
    med = g.neighbours(centres, FAST, "gmt_occur", 100, where_label="deposits_from", where_key="amount", where_bound=1000)
    assert sorted((r.center_id, r.neighbour_id) for r in med.collect()) == [("user-000001", "d1"), ("user-000001", "d1")]
    slow = g.neighbours(centres, FAST, "gmt_occur", 100, where_label="withdraws_to", where_key="amount", where_bound=500)
    assert sorted((r.center_id, r.neighbour_id) for r in slow.collect()) == [("user-000002", "d4")]


def test_counts_keep_zero(spark):
    g = _load_graph(spark)
    counts = {r.center_id: r.result_count for r in g.neighbour_counts(g.vertices["user"], FAST, "gmt_occur", 50).collect()}
    assert counts == {"user-000001": 3, "user-000002": 1, "user-000003": 0}


def test_value_map_leaves_out_absent(spark):
    v = spark.createDataFrame([("x", "a", None)], "id string, p string, q string")
    rows = PropertyGraph.value_map_long(v).collect()
    assert [(r.key, r.value) for r in rows] == [("p", "a")]
    m = PropertyGraph.value_map(v).first().properties
    assert m == {"p": ["a"]}


def test_edge_value_map_has_single_values(spark):
    e = PropertyGraph({}, {"l": spark.createDataFrame([("a", "b", 1, None), ("a", "c", None, "z")], "src string, dst string, p int, q string")})
    rows = {r.dst: r.properties for r in e.edge_value_map(["l"]).collect()}
    assert rows == {"b": {"p": "1"}, "c": {"q": "z"}}
    assert sorted((r.dst, r.key, r.value) for r in e.edge_value_map_long(["l"]).collect()) == [("b", "p", "1"), ("c", "q", "z")]


def _labelled(spark):
    """Four edges of three labels in one labelled part, native whole-number keys."""
    people = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id long, kind string")
    edges = spark.createDataFrame([(1, 2, "L1"), (2, 1, "L1"), (1, 3, "L2"), (2, 3, "L3")], "src long, dst long, label string")
    return PropertyGraph({"p": people}, parts=[EdgePart(edges, ("L1", "L2", "L3"), True, "p", "p")], ids={"p": IdText("p-")})


def _edges(g):
    return sorted((r.label, r.src, r.dst) for r in g.E().collect())


def test_drop_edges_of_some_labels(spark):
    g = _labelled(spark)
    assert _edges(g.drop_edges_where_source("kind", ["x"], ["L1"])) == [("L1", "p-2", "p-1"), ("L2", "p-1", "p-3"), ("L3", "p-2", "p-3")]
    assert _edges(g.drop_edges_where_source("kind", ["x"])) == [("L1", "p-2", "p-1"), ("L3", "p-2", "p-3")]
    assert _edges(g.drop_edges_where_source("kind", ["x"], ["L3"])) == _edges(g)


def test_add_to_a_label_of_a_labelled_part(spark):
    g = _labelled(spark)
    more = g.add_edges("L1", g.has("kind", "y"), g.has("kind", "x"))
    assert more.edge_count().first().n_edges == 5
    assert {r.label: r.n for r in more.counts_by_label().where("kind = 'edge'").collect()} == {"L1": 3, "L2": 1, "L3": 1}
    assert ("L1", "p-2", "p-1") in _edges(more) and len(_edges(more)) == 5
    assert sorted(r.label for r in more.out(["p-2"], ["L1"]).collect()) == ["p", "p"]


def test_drop_vertices_with_native_keys(spark):
    g = _labelled(spark).drop_vertices("kind", ["y"])
    assert sorted(r.id for r in g.V().collect()) == ["p-1", "p-3"] and _edges(g) == [("L2", "p-1", "p-3")]
    none = PropertyGraph({"p": spark.createDataFrame([("a", None), ("b", "x")], "id string, kind string")}).drop_vertices("kind", ["x"])
    assert [r.id for r in none.V().collect()] == ["a"]


def test_public_ids(spark):
    padded, plain = IdText("user-", 6), IdText("device-")
    assert [padded.key(t) for t in ("user-000001", "user-1", "user-1234567", "device-1", "user-", "user-00000x")] == [1, None, 1234567, None, None, None]
    assert [plain.key(t) for t in ("device-0", "device-17", "device-017", "device--3")] == [0, 17, None, -3]
    texts = spark.createDataFrame([("user-000001",), ("user-1",), ("device-17",), ("user-x",), (None,)], "t string")
    assert [r[0] for r in texts.select(padded.key_column(F.col("t"))).collect()] == [1, None, None, None, None]
    g = _labelled(spark)
    assert [r.id for r in g.vertex_by_id(["p-1", "q-2", "p-x"]).collect()] == ["p-1"]
    assert [r.id for r in g.vertex_by_id(spark.createDataFrame([("p-2",), ("p-2",), ("zz",)], "t string")).collect()] == ["p-2"]
    assert g.vertex_by_id(["zz"]).count() == 0


def test_hub_and_skewed_centres(spark):
    """A third of all edges leave one centre and meet in one hub."""
    n = 3000
    edges = spark.range(n).selectExpr("if(id % 3 = 0, 1, id % 50) as src", "if(id % 3 = 1, 1, id % 70) as dst", "'L' as label")
    people = spark.range(100).selectExpr("id", "id as gmt_occur", "cast(id as double) as amount")
    g = PropertyGraph({"p": people}, parts=[EdgePart(edges, ("L",), True, "p", "p")], ids={"p": IdText("p-")})
    got = g.neighbour_counts(g.V(["p"]), ["L"], "gmt_occur", 1)
    rows = [(1 if i % 3 == 0 else i % 50, 1 if i % 3 == 1 else i % 70) for i in range(n)]
    want = {f"p-{c}": sum(s == c and d >= 1 for s, d in rows) for c in range(100)}
    assert {r.center_id: r.result_count for r in got.collect()} == want


def test_added_ids_outside_the_rule_are_kept(spark):
    from quayside.operators.graph import EdgePart, IdText, PropertyGraph
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    g = PropertyGraph({"customer": base}, parts=[EdgePart(edges, ("knows",), False, "customer", "customer")], ids={"customer": IdText("customer-")})
    odd = ["9d7c-uuid", "customer-007", "customer-", "customer-99999999999999999999", "2"]
    new = spark.createDataFrame([(i, f"n{i}") for i in ["customer-3", *odd]], "id string, name string")
    h = g.add_vertices("customer", new)
    assert {r.id: r.name for r in h.V(["customer"]).collect()} == {"customer-1": "a", "customer-2": "b", **{i: f"n{i}" for i in ["customer-3", *odd]}}
    assert {r.id for r in h.vertex_by_id(["9d7c-uuid", "customer-3", "customer-007"]).collect()} == {"9d7c-uuid", "customer-3", "customer-007"}
    assert {r.id for r in h.vertex_by_id(spark.createDataFrame([("9d7c-uuid",), ("customer-1",)], "x string")).collect()} == {"9d7c-uuid", "customer-1"}
    assert h.vertex_count().first().n_vertices == 8 and {r.label: r.n for r in h.counts_by_label().where("kind = 'vertex'").collect()} == {"customer": 8}
    # an edge to and from such a vertex, and dropping it
    e = h.add_edges("likes", h.has("name", "n9d7c-uuid"), h.has("name", "a"))
    assert [tuple(r) for r in e.edge_table("likes").select("src", "dst").collect()] == [("9d7c-uuid", "customer-1")]
    assert [r.id for r in e.out(["9d7c-uuid"], ["likes"]).collect()] == ["customer-1"]
    assert e.drop_vertices("name", ["n9d7c-uuid"]).edge_table("likes").count() == 0 and e.drop_vertices("name", ["n9d7c-uuid"]).vertex_count().first().n_vertices == 7
    again = h.add_vertices("customer", spark.createDataFrame([("other", "x")], "id string, name string"))
    assert again.vertex_count().first().n_vertices == 9
    with pytest.raises(Exception, match="no id"):
        g.add_vertices("customer", spark.createDataFrame([(None, "x")], "id string, name string")).V().collect()


def test_stored_graph_with_a_heavy_source(spark, scratch):
    from quayside.operators.graph import EdgePart, IdText, PropertyGraph
    from quayside.sinks.graph import drop_graph, stored_graph
    users = spark.range(200).selectExpr("id", "id % 5 AS kind")
    edges = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id % 200) AS src", "(id * 7) % 200 AS dst", "if(id % 2 = 0, 'x', 'y') AS label")
    g = PropertyGraph({"u": users}, parts=[EdgePart(edges, ("x", "y"), True, "u", "u")], ids={"u": IdText("u-")})
    s = stored_graph(g, "quayside_heavy_test", scratch + "/g", buckets=16)
    try:
        assert len(s.parts) == 2 and [r.src for r in s.parts[1].frame.select("src").distinct().collect()] == [7]
        for q in (lambda a: a.E(), lambda a: a.neighbours(["u-7", "u-8"], ["x"], "kind", 2), lambda a: a.edges_where_source("y", "kind", [2, 3]), lambda a: a.V()):
            a, b = q(g), q(s).select(*q(g).columns)
            assert a.count() == b.count() and a.exceptAll(b).count() == 0
    finally:
        drop_graph(spark, "quayside_heavy_test")
