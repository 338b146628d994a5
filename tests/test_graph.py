import random

from kindred.operators.graph import connected_components, drop_largest


def bfs_components(edges):
    comp = {}
    by_kind = {}
    for k, a, b in edges:
        if not a or not b or a == b or k is None:
            continue
        by_kind.setdefault(k, {}).setdefault(a, set()).add(b)
        by_kind[k].setdefault(b, set()).add(a)
    for k, adj in by_kind.items():
        seen = set()
        for s in adj:
            if s in seen:
                continue
            stack, group = [s], set()
            while stack:
                x = stack.pop()
                if x in seen:
                    continue
                seen.add(x)
                group.add(x)
                stack.extend(adj[x] - seen)
            for x in group:
                comp[(k, x)] = min(group)
    return comp


def test_components_match_bfs(spark):
    rnd = random.Random(5)
    edges = [("k1", i, i + 1) for i in range(1, 60)]                       # long chain
    edges += [("k2", rnd.randint(1, 80), rnd.randint(1, 80)) for _ in range(70)]
    edges += [("k1", 500, 500), ("k1", 0, 7), ("k3", 9, 9), (None, 1, 2)]   # self loop, falsy, no kind
    edges += [("k2", 3, 4), ("k2", 4, 3)]                                    # duplicates
    df = spark.createDataFrame(edges, "kind string, src long, dst long")
    got = {(r.kind, r.id): r.component for r in connected_components(df).collect()}
    assert got == bfs_components(edges)


def test_drop_largest_removes_one_id_per_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 5, 5), ("b", 9, 5)],
                               "kind string, id long, component long")
    got = sorted((r.kind, r.id) for r in drop_largest(df).collect())
    assert got == [("a", 1), ("a", 2), ("b", 5)]
