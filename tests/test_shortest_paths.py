import heapq
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph, routes


def brute_force(edges, src, dst):
    """Dijkstra on lexicographic (distance, path) labels."""
    adj = {}
    for a, b, w in edges:
        adj.setdefault(a, []).append((b, w))
    best = {src: (0.0, [src])}
    heap = [(0.0, [src])]
    while heap:
        d, p = heapq.heappop(heap)
        u = p[-1]
        if best.get(u) != (d, p):
            continue
        for v, w in adj.get(u, []):
            if v in p:
                continue
            cand = (d + w, p + [v])
            if v not in best or cand < best[v]:
                best[v] = cand
                heapq.heappush(heap, cand)
    return best.get(dst)


def random_graph(seed, n=40, m=160):
    rng = random.Random(seed)
    e = {}
    for _ in range(m):
        a, b = rng.randrange(n), rng.randrange(n)
        e[(a, b)] = float(rng.randint(1, 9))   # small integer weights: many ties
    return [(a, b, w) for (a, b), w in e.items()]


@pytest.mark.parametrize("seed,fanout,prune", [(1, None, True), (2, 2, True), (3, 3, False)])
def test_matches_brute_force(spark, seed, fanout, prune):
    edges = random_graph(seed)
    rng = random.Random(seed + 100)
    queries = [(i, rng.randrange(40), rng.randrange(40)) for i in range(12)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    q = spark.createDataFrame(queries, "query_id long, src long, dst long")
    res = {r.query_id: r for r in graph.shortest_paths(e, q, fanout=fanout, prune=prune,
                                                       num_partitions=4).collect()}
    for qid, s, t in queries:
        want = brute_force(edges, s, t)
        r = res[qid]
        if want is None:
            assert not r.reachable and r.path is None
        else:
            assert r.reachable and (r.distance, list(r.path)) == want


def test_negative_weight_rejected(spark):
    e = spark.createDataFrame([(1, 2, -1.0)], "src long, dst long, distance double")
    q = spark.createDataFrame([(0, 1, 2)], "query_id long, src long, dst long")
    with pytest.raises(ValueError):
        graph.shortest_paths(e, q)


def test_zero_weight_and_self_loop_terminate(spark):
    e = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.0), (2, 1, 0.0), (2, 3, 1.0)],
                              "src long, dst long, distance double")
    q = spark.createDataFrame([(0, 1, 3), (1, 3, 1)], "query_id long, src long, dst long")
    res = {r.query_id: r for r in graph.shortest_paths(e, q).collect()}
    assert list(res[0].path) == [1, 2, 3] and res[0].distance == 1.0
    assert not res[1].reachable


def test_goal_directed_pruning_is_exact(spark):
    import math
    rng = random.Random(5)
    pts = {i: (1.29 + rng.random() * 0.02, 103.76 + rng.random() * 0.02) for i in range(60)}

    def metres(a, b):
        (la1, lo1), (la2, lo2) = pts[a], pts[b]
        dlat, dlon = math.radians(la2 - la1), math.radians(lo2 - lo1)
        h = (math.sin(dlat / 2) ** 2
             + math.cos(math.radians(la1)) * math.cos(math.radians(la2)) * math.sin(dlon / 2) ** 2)
        return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h)) * 1000

    pairs = {(rng.randrange(60), rng.randrange(60)) for _ in range(300)}
    edges = [(a, b, float(math.ceil(metres(a, b)))) for a, b in pairs]
    queries = [(i, rng.randrange(60), rng.randrange(60)) for i in range(15)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    q = spark.createDataFrame(queries, "query_id long, src long, dst long")
    coords = spark.createDataFrame([(k, v[0], v[1]) for k, v in pts.items()],
                                   "_id long, _lat double, _lon double")
    with_h = {r.query_id: (r.reachable, r.distance, None if r.path is None else list(r.path))
              for r in graph.shortest_paths(e, q, coords=coords, num_partitions=4).collect()}
    for qid, s, t in queries:
        want = brute_force(edges, s, t)
        got = with_h[qid]
        assert got == ((False, None, None) if want is None else (True, want[0], want[1]))


@pytest.mark.parametrize("seed,fanout", [(21, None), (22, 2)])
def test_predecessor_tracking(spark, seed, fanout):
    edges = random_graph(seed)
    weights = {(a, b): w for a, b, w in edges}
    rng = random.Random(seed + 7)
    queries = [(i, rng.randrange(40), rng.randrange(40)) for i in range(10)] + [(99, 3, 3)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    q = spark.createDataFrame(queries, "query_id long, src long, dst long")
    res = {r.query_id: r for r in graph.shortest_paths(e, q, fanout=fanout, track="pred",
                                                       num_partitions=4).collect()}
    for qid, s, t in queries:
        want = brute_force(edges, s, t)
        r = res[qid]
        if want is None:
            assert not r.reachable and r.path is None
            continue
        path = list(r.path)
        assert r.reachable and r.distance == want[0]
        assert path[0] == s and path[-1] == t and len(set(path)) == len(path)
        assert sum(weights[(a, b)] for a, b in zip(path, path[1:])) == r.distance


@pytest.mark.parametrize("track", ["path", "pred"])
def test_compaction_every_round_pair(spark, track):
    # a long chain plus shortcuts: many rounds, so versions get compacted
    edges = [(i, i + 1, 1.0) for i in range(30)] + [(0, 10, 12.0), (5, 20, 14.0), (12, 29, 20.0)]
    queries = [(0, 0, 30), (1, 3, 25), (2, 30, 0)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    q = spark.createDataFrame(queries, "query_id long, src long, dst long")
    res = {r.query_id: r for r in graph.shortest_paths(e, q, compact_every=2, track=track,
                                                       num_partitions=3).collect()}
    for qid, s, t in queries:
        want = brute_force(edges, s, t)
        r = res[qid]
        if want is None:
            assert not r.reachable
        else:
            assert (r.distance, list(r.path)) == want


def test_antipodal_nodes_keep_their_route_with_pruning(spark):
    """Rounding takes the haversine term over 1 there; the distance must stay a number."""
    from tessera.functions.geo import haversine_m
    from tessera.operators.graph import shortest_paths
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, -89.985, -100.0), (3, 89.985, 80.0)],
                                  "_id long, _lat double, _lon double")
    d = spark.range(1).select(haversine_m(F.lit(-89.985), F.lit(-100.0), F.lit(89.985), F.lit(80.0))).first()[0]
    assert abs(d - 6371000 * 3.141592653589793) < 50_000
    edges = spark.createDataFrame([(1, 2, 1e7), (2, 3, d)], "src long, dst long, distance double")
    query = spark.createDataFrame([(1, 1, 3)], "query_id long, src long, dst long")
    for coords in (None, nodes):
        assert [list(r.path) for r in shortest_paths(edges, query, coords=coords).collect()] == [[1, 2, 3]]


def test_weights_that_are_no_numbers_are_refused(spark):
    edges = spark.createDataFrame([(1, 2, float("nan"))], "src long, dst long, distance double")
    query = spark.createDataFrame([(1, 1, 2)], "query_id long, src long, dst long")
    with pytest.raises(ValueError, match="numbers"):
        graph.shortest_paths(edges, query)


def test_hub_is_split_before_it_is_dealt_out(spark):
    """One node with two thirds of the edges: no partition over twice the mean."""
    edges = [(0, i, 1.0) for i in range(1, 4001)] + [(i, i + 1, 1.0) for i in range(1, 2001)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    prepared, hubs = graph.prepare_edges(e, fanout=50, num_partitions=8)
    sizes = [r["n"] for r in prepared.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == len(edges) and max(sizes) <= 2 * len(edges) / 8
    assert [tuple(r) for r in hubs.collect()] == [(0, 80)]
    q = spark.createDataFrame([(0, 0, 2001), (1, 1, 4)], "query_id long, src long, dst long")
    got = {r.query_id: list(r.path) for r in graph.shortest_paths(e, q, fanout=50, num_partitions=8).collect()}
    assert got == {0: [0, 2001], 1: [1, 2, 3, 4]}


def test_bounds_of_the_routes_are_landed(spark, monkeypatch, capsys):
    """The edges of all labels are pruned by a table of a row a source, not dealt out by the source first."""
    goals, tight = [], routes.tight_edges
    monkeypatch.setattr(routes, "tight_edges", lambda s, e, goal: goals.append(goal) or tight(s, e, goal))
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 5.0)], "src long, dst long, distance double")
    queries = spark.createDataFrame([(0, 1, 3)], "query_id long, src long, dst long")
    for landmarks in (0, 1):
        row = routes.shortest_paths(edges, queries, contract=False, landmarks=landmarks).first()
        assert (row.distance, row.path) == (2.0, [1, 2, 3])
    assert len(goals) == 2
    for goal in goals:
        capsys.readouterr()
        goal.explain()
        plan = capsys.readouterr().out
        assert "Join" not in plan and "Aggregate" not in plan
