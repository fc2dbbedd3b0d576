"""Chains, landmarks, distance buckets, shared sources, settlement and plans of the route search."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph, routes
from test_shortest_paths import brute_force, random_graph

EDGES, QUERIES = "src long, dst long, distance double", "query_id long, src long, dst long"


def solve(spark, edges, queries, **options):
    found = routes.shortest_paths(spark.createDataFrame(edges, EDGES), spark.createDataFrame(queries, QUERIES),
                                  num_partitions=4, **options).collect()
    return {r.query_id: (r.distance, r.path and list(r.path)) for r in found}


def wanted(edges, queries):
    return {i: brute_force(edges, s, t) or (None, None) for i, s, t in queries}


def strings_of_chains(seed):
    """A small random graph whose edges are long runs of nodes, some one-way, some two-way; rings and dead ends."""
    rng, edges, new = random.Random(seed), [], iter(range(100, 10_000))
    for _ in range(14):
        a, b, both = rng.randrange(6), rng.randrange(6), rng.random() < 0.5
        way = [a, *[next(new) for _ in range(rng.choice([0, 1, 2, 5, 9]))], b]
        for x, y in zip(way, way[1:]):
            edges += [(x, y, float(rng.randint(0, 3)))] + ([(y, x, float(rng.randint(0, 3)))] if both else [])
    ring = [next(new) for _ in range(7)]
    edges += [(x, y, 1.0) for x, y in zip(ring, ring[1:] + ring[:1])]
    return edges


def test_chains_do_not_change_routes(spark):
    seed = 1
    edges = strings_of_chains(seed)
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    rng = random.Random(seed)
    queries = [(i, rng.choice(nodes), rng.choice(nodes)) for i in range(20)]
    want = wanted(edges, queries)
    got = solve(spark, edges, queries)
    assert {q: d for q, (d, _) in got.items()} == {q: d for q, (d, _) in want.items()}
    weights = {}
    for a, b, w in edges:
        weights[a, b] = min(w, weights.get((a, b), w))
    for i, s, t in queries:
        d, path = got[i]
        if path is not None:
            assert path[0] == s and path[-1] == t and len(set(path)) == len(path)
            assert sum(weights[x, y] for x, y in zip(path, path[1:])) == d


def test_positive_chains_keep_the_tie_rule(spark):
    edges = [(a, b, w + 1) for a, b, w in strings_of_chains(3)]
    queries = [(10 * s + t, s, t) for s in range(4) for t in range(4)]
    assert solve(spark, edges, queries) == wanted(edges, queries)


def test_long_chain_takes_few_joins(spark, monkeypatch):
    """5,000 hops: a handful of search rounds, no array in a label, at most 13 jumps."""
    n = 5000
    edges = [(i, i + 1, 1.0) for i in range(n)] + [(i + 1, i, 1.0) for i in range(n)]
    jumps, write = [], routes.write_read

    def counted(df, path, *more):
        jumps.append(path.rsplit("/", 1)[-1])
        return write(df, path, *more)

    monkeypatch.setattr(routes, "write_read", counted)
    stats = {}
    got = solve(spark, edges, [(0, 0, n), (1, n, 3)], stats=stats)
    assert got[0] == (float(n), list(range(n + 1))) and got[1] == (n - 3.0, list(range(n, 2, -1)))
    assert stats["rounds"] <= 5 and sum(j.startswith("darts-") for j in jumps) - 1 <= 13


@pytest.mark.parametrize("options", [{"landmarks": 2}, {"delta": 2.0, "track": "pred"}])
def test_options_do_not_change_distances(spark, options):
    edges = random_graph(8, n=60, m=240)
    queries = [(i, i % 5, 7 * i % 60) for i in range(25)]       # many queries of five sources
    want = wanted(edges, queries)
    got = solve(spark, edges, queries, **options)
    if options.get("track") == "pred":
        assert {q: d for q, (d, _) in got.items()} == {q: d for q, (d, _) in want.items()}
    else:
        assert got == want


def test_landmarks_write_fewer_labels(spark):
    """Hop counts on a grid: no coordinates can bound them."""
    k = 18
    edges = [(k * y + x, k * (y + dy) + x + dx, 1.0) for y in range(k) for x in range(k)
             for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)) if 0 <= x + dx < k and 0 <= y + dy < k]
    queries = [(0, k * 9 + 2, k * 9 + 6), (1, k * 4 + 4, k * 6 + 5)]
    plain, marked = {}, {}
    a = solve(spark, edges, queries, stats=plain, track="pred")
    b = solve(spark, edges, queries, stats=marked, landmarks=6, track="pred")
    assert {q: d for q, (d, _) in a.items()} == {q: d for q, (d, _) in b.items()} == {0: 4.0, 1: 3.0}
    assert marked["labels_written"] < plain["labels_written"]


def test_distance_buckets_write_fewer_labels(spark):
    """Short edges that undercut a long one: without buckets the long one's labels are spread first."""
    edges = [(i, i + 1, 1.0) for i in range(6)] + [(0, 6, 50.0)] + [(6 + i, 7 + i, 1.0) for i in range(6)]
    plain, dealt = {}, {}
    options = {"contract": False, "seed_hops": 0}
    a = solve(spark, edges, [(0, 0, 12)], stats=plain, **options)
    assert a == solve(spark, edges, [(0, 0, 12)], stats=dealt, delta=1.0, **options)
    assert dealt["labels_written"] < plain["labels_written"]


def test_one_search_for_all_queries_of_a_source(spark):
    edges = random_graph(5)
    stats = {}
    got = solve(spark, edges, [(t, 1, t) for t in range(40)], stats=stats, prune=False)
    assert got == wanted(edges, [(t, 1, t) for t in range(40)])
    assert stats["labels_written"] < 3 * 40         # one set of labels, not one a query


def test_settled_routes_are_handed_over_before_the_end(spark):
    """A near query is out while a far one is still searched; a stop after that loses nothing."""
    edges = [(i, i + 1, 1.0) for i in range(12)] + [(i, 100 + i, 9.0) for i in range(12)] + [(100, 3, 0.5)]
    queries = [(0, 0, 1), (1, 0, 112), (2, 1, 12), (3, 12, 0)]
    out = []

    class Stop(Exception):
        pass

    def publish(found):
        out.extend((r.query_id, r.src, r.dst, r.distance, list(r.path)) for r in found.collect())
        raise Stop

    with pytest.raises(Stop):
        solve(spark, edges, queries, on_settled=publish)
    assert out and out[0] == (0, 0, 1, 1.0, [0, 1]) and len(out) < 3
    out.clear()
    got = solve(spark, edges, queries, on_settled=lambda found: out.extend(
        (r.query_id, r.distance, list(r.path)) for r in found.collect()))
    assert got == wanted(edges, queries)
    assert sorted(out) == sorted((q, d, p) for q, (d, p) in got.items() if d is not None)


def test_round_has_no_exchange_on_the_state_and_no_sort(spark):
    e = spark.createDataFrame(random_graph(2), EDGES)
    prepared, _ = routes.prepare_edges(e, num_partitions=4)
    one = spark.createDataFrame([(1, 1, 0.0, 0, 1, True)],
                                "sid long, node long, distance double, hops long, nb int, fresh boolean")
    state = routes.bucketed(one, 4, ["sid", "node"], "test")
    merged = routes.merge_labels(state, routes.relax(state.where("fresh"), prepared, 4), F.lit(True))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("ShuffledHashJoin"):]
    left = join[:join.index("HashAggregate")]
    assert "Exchange" not in left and "tessera_test" in left
    assert "SortAggregate" not in plan and "Sort " not in plan.split("InMemoryTableScan")[0]


def test_entry_points_are_named_in_graph():
    assert graph.shortest_paths is routes.shortest_paths


def test_lines_beside_heavier_ways_are_contracted_in_turn(spark):
    """a line with express ways over every fifth node: rounds do not grow with the express nodes."""
    from test_shortest_paths import brute_force
    two_way = [(i, i + 1, float(1 + i % 3)) for i in range(150)]
    # lighter and heavier ones, and at 50 one of equal length
    two_way += [(i, i + 5, 10.0 if i == 50 else (8.0, 7.0, 12.0)[i // 5 % 3]) for i in range(0, 150, 5)]
    two_way += [(200, 3, 0.0), (200, 201, 2.0), (201, 149, 240.0)]
    edges = two_way + [(b, a, w) for a, b, w in two_way]
    queries = [(0, 2, 148), (1, 148, 2), (2, 7, 200), (3, 201, 40)]
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    q = spark.createDataFrame(queries, "query_id long, src long, dst long")
    stats = {}
    got = {r.query_id: (r.distance, list(r.path)) for r in graph.shortest_paths(e, q, num_partitions=4, stats=stats).collect()}
    assert got == {i: brute_force(edges, a, b) for i, a, b in queries}
    assert stats["rounds"] <= 12
    weight = {(a, b): w for a, b, w in edges}
    for r in graph.shortest_paths(e, q, num_partitions=4, track="pred").collect():
        assert r.distance == got[r.query_id][0] == sum(weight[h] for h in zip(r.path, r.path[1:]))


def test_ends_that_are_not_connected_start_no_search(spark):
    """components apart: no round for a query across them, and the other queries search their own alone."""
    rng = random.Random(4)
    part = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(150)})
    edges = [(a + 100 * k, b + 100 * k, float(1 + (a * b) % 7)) for k in range(4) for a, b in part]
    e = spark.createDataFrame(edges, "src long, dst long, w double")
    nodes = spark.createDataFrame([(a + 100 * k,) for k in range(4) for a in range(30)], "id long")
    across, stats = [(0, 1, 102), (1, 105, 307), (2, 4, 4)], {}
    q = spark.createDataFrame(across, "query_id long, src long, dst long")
    got = {r.query_id: (r.reachable, r.distance) for r in graph.shortest_paths(
        e, q, weight_col="w", vertices=nodes, num_partitions=4, stats=stats).collect()}
    assert got == {0: (False, None), 1: (False, None), 2: (True, 0.0)} and stats["rounds"] == 0
    q = spark.createDataFrame(across + [(3, 101, 117)], "query_id long, src long, dst long")
    got = {r.query_id: r.distance for r in graph.shortest_paths(
        e, q, weight_col="w", vertices=nodes, num_partitions=4, stats=stats).collect()}
    from test_shortest_paths import brute_force
    assert got == {0: None, 1: None, 2: 0.0, 3: brute_force(edges, 101, 117)[0]}
    assert stats["labels_written"] <= 30


def test_a_round_neither_deals_out_nor_sorts_the_cached_edges(spark):
    """F8: labels too many to broadcast are sorted and merged with the edges as these lie in the cache."""
    edges = random_graph(2) + [(1, 10**6 + i, 1.0) for i in range(120)]
    prepared, hubs = routes.prepare_edges(spark.createDataFrame(edges, EDGES), fanout=50, num_partitions=4)
    prepared = routes.held(prepared)
    labels = spark.createDataFrame([(1, 1, 0.0, 0, 3), (2, 2, 0.5, 1, 1)], "sid long, node long, distance double, hops long, nb int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prepared.count()
        step = routes.extend(labels, prepared)
        plan = step._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        got = sorted((r.sid, r["_from"], r.node, r.distance, r.hops) for r in step.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        prepared.unpersist()
    assert "SortMergeJoin" in plan and plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert [r["_nb"] for r in hubs.collect()] and got == sorted(
        (sid, a, b, d + w, h + 1) for sid, node, d, h in ((1, 1, 0.0, 0), (2, 2, 0.5, 1)) for a, b, w in edges if a == node != b)


def test_edges_of_one_part_are_not_joined_to_find_others(spark, monkeypatch):
    """a few neighbours of each node show that all are connected: the edges need no second look."""
    landed, write = [], routes.write_read
    monkeypatch.setattr(routes, "write_read", lambda df, path, *a: landed.append(path) or write(df, path, *a))
    ring = [(i, (i + 1) % 40, 1.0) for i in range(40)]
    edges = ring + [(i, (i + 7) % 40, 3.0) for i in range(40)]
    assert solve(spark, edges, [(0, 3, 30)]) == wanted(edges, [(0, 3, 30)])
    assert any("/parts/few" in p for p in landed) and not any(p.endswith("/parts/left") for p in landed)
    apart = edges + [(a + 100, b + 100, w) for a, b, w in ring]
    queries = [(0, 3, 30), (1, 3, 105), (2, 101, 130)]
    assert solve(spark, apart, queries) == wanted(apart, queries)
    assert any(p.endswith("/parts/left") for p in landed)


def test_route_validation_sequences_the_ways_once(spark, monkeypatch):
    """the edges that routes are searched on are those that they are checked against."""
    from tessera.plans import catalog
    calls, edges = [], catalog._edges
    monkeypatch.setattr(catalog, "_edges", lambda *a: calls.append(a) or edges(*a))
    assert catalog.q_route_validation(spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1


def test_chains_taken_out_by_rounds_give_the_same_routes(spark, monkeypatch):
    """long tables of chains lose their nodes by rounds; routes, also those within chains, stay the same."""
    edges = strings_of_chains(2)
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    rng = random.Random(2)
    queries = [(i, rng.choice(nodes), rng.choice(nodes)) for i in range(20)]
    jumped = solve(spark, edges, queries)
    monkeypatch.setattr(routes, "ELIMINATE", 0)
    assert solve(spark, edges, queries) == jumped
    assert {q: d for q, (d, _) in jumped.items()} == {q: d for q, (d, _) in wanted(edges, queries).items()}


def test_rounds_over_a_long_chain_keep_few_rows(spark, monkeypatch):
    """edges, jumps and members of a long chain do not pile up under the checkpoint folder."""
    rng = random.Random(8)
    ids = rng.sample(range(10 ** 6), 60)
    edges = [(a, b, 1.0) for x, y in zip(ids, ids[1:]) for a, b in ((x, y), (y, x))]
    ring = rng.sample(range(10 ** 6, 2 * 10 ** 6), 5)
    edges += [(a, b, 1.0) for x, y in zip(ring, ring[1:] + ring[:1]) for a, b in ((x, y), (y, x))]
    queries = [(0, ids[0], ids[-1]), (1, ids[50], ids[20]), (2, ids[1], ring[0])]
    want = {0: (59.0, ids), 1: (30.0, ids[50:19:-1]), 2: (None, None)}
    written, write = [], routes.write_read
    monkeypatch.setattr(routes, "write_read", lambda df, path, *a: written.append(path) or write(df, path, *a))
    for most in (0, 10 ** 6):
        monkeypatch.setattr(routes, "ELIMINATE", most)
        del written[:]
        assert solve(spark, edges, queries) == want
        passing = [p for p in written if "/round-" in p or "/darts-" in p]
        left = [p for p in passing if os.path.exists(p.removeprefix("file:"))]
        assert len(passing) > 3 and len(left) <= (0 if most == 0 else 1)
        if most == 0:       # members: one row for each edge that was taken up, not one for each jump
            inside = sum(spark.read.parquet(p).count() for p in written if "/inside-" in p)
            assert inside <= 2 * 60


def test_shuffle_files_go_with_their_job_and_the_setting_comes_back(spark):
    from tessera import session
    before = spark.conf.get(session._CLEANUP)
    with session.shuffles_removed(spark), session.shuffles_removed(spark):
        assert spark.conf.get(session._CLEANUP) == "true"
    assert spark.conf.get(session._CLEANUP) == before


def test_chain_routes_sequences_the_lines_once(spark, monkeypatch):
    """stations are landed, and edges, vertices, ends and the check scan them."""
    from tessera.plans import catalog
    calls, lines = [], catalog.osm.way_nodes_rows
    monkeypatch.setattr(catalog.osm, "way_nodes_rows", lambda *a: calls.append(a) or lines(*a))
    rows = catalog.q_chain_routes(spark, "/root/testdata/sf0.001")
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString() and len(calls) == 1
