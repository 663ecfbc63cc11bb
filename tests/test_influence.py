"""PageRank (G1) and result handling (T5, T6, P14)."""

import math

import pytest
from pyspark.sql import types as T

from vidgraph.operators import influence
from vidgraph.session import scratch_path


def _pr(spark, ids, edges, **kw):
    v = spark.createDataFrame([(i,) for i in ids], "videoId string")
    e = spark.createDataFrame(edges, "srcVideoId string, dstVideoId string")
    return {r.id: r.pagerank for r in influence.pagerank(v, e, **kw).collect()}


def test_two_cycle(spark):
    pr = _pr(spark, ["a", "b"], [("a", "b"), ("b", "a")])
    assert pr["a"] == pytest.approx(1.0) and pr["b"] == pytest.approx(1.0)


def test_star_sink_unknown(spark):
    ids = ["h", "l1", "l2", "l3", "s"]
    pr = _pr(spark, ids, [("l1", "h"), ("l2", "h"), ("l3", "h"), ("h", "s"), ("l1", "zz")])
    assert max(pr, key=pr.get) in ("h", "s")
    assert pr["h"] > pr["l1"]
    assert sum(pr.values()) == pytest.approx(len(ids))
    assert set(pr) == set(ids)


def test_parallel_edges_weight(spark):
    pr = _pr(spark, ["a", "b", "c"], [("a", "b"), ("a", "b"), ("a", "c")], tol=1e-9)
    # only a sends: b gets twice c's share of a's mass
    assert (pr["b"] - pr["a"]) == pytest.approx(2 * (pr["c"] - pr["a"]))


def _reference_pagerank(ids, edges, reset=0.15, tol=0.01):
    """Plain-Python restatement of the delta rule (test oracle)."""
    ids = set(ids)
    edges = [(s, d) for s, d in edges if s in ids and d in ids]
    out = {}
    for s, _ in edges:
        out[s] = out.get(s, 0) + 1
    rank = {i: reset for i in ids}
    frontier = dict(rank)
    while True:
        msg = {}
        for s, d in edges:
            if frontier.get(s, 0) > tol:
                msg[d] = msg.get(d, 0) + frontier[s] / out[s]
        if not msg:
            break
        frontier = {d: (1 - reset) * m for d, m in msg.items()}
        for d, m in frontier.items():
            rank[d] += m
    tot = sum(rank.values())
    return {i: r * len(ids) / tot for i, r in rank.items()}


def test_salting_matches_plain_rule(spark):
    ids = [f"n{i}" for i in range(40)]
    edges = [("n0", f"n{i}") for i in range(1, 40)]          # hub source
    edges += [(f"n{i}", f"n{(i * 7) % 40}") for i in range(1, 40)]
    edges += [(f"n{i}", "n0") for i in range(1, 40, 3)]      # hub target
    expected = _reference_pagerank(ids, edges)
    for salt_size, per_bucket, fold in ((1, 7, 1), (3, 4_000_000, 10), (1000, 10, 2)):
        got = _pr(spark, ids, edges, salt_size=salt_size, edges_per_bucket=per_bucket, fold=fold)
        assert set(got) == set(expected)
        for k in ids:
            assert got[k] == pytest.approx(expected[k], rel=1e-9)


def test_argument_checks(spark):
    with pytest.raises(ValueError):
        _pr(spark, ["a"], [], reset_probability=1.0)
    with pytest.raises(ValueError):
        _pr(spark, ["a"], [], tol=0)
    assert _pr(spark, ["a", "b"], []) == {"a": pytest.approx(1.0), "b": pytest.approx(1.0)}


def test_top_nan_null_last(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", None), ("c", 0.5), ("d", 2.0)],
                               "id string, pagerank double")
    got = [r.id for r in influence.influence_top(df, 4).collect()]
    assert got[:2] == ["d", "c"] and set(got[2:]) == {"a", "b"}


def test_property_map_round_trip(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("age", T.LongType()),
                           T.StructField("pagerank", T.DoubleType())])
    df = spark.createDataFrame([("a", 3, 0.25), ("b", None, 1.5)], schema)
    maps = influence.to_property_map(df)
    by_id = {r.video["id"]: r.video for r in maps.collect()}
    assert "age" in by_id["a"] and "age" not in by_id["b"]
    back = sorted(map(tuple, influence.flatten_properties(maps, schema).collect()))
    assert back == [("a", 3, 0.25), ("b", None, 1.5)]
    assert not any(math.isnan(x[2]) for x in back)


def test_repeated_vertex_rows(spark):
    pr = _pr(spark, ["a", "b", "a"], [("a", "b"), ("b", "a")])
    assert pr == {"a": pytest.approx(1.0), "b": pytest.approx(1.0)}


def _graph(n=30):
    return [f"n{i}" for i in range(n)], [(f"n{i}", f"n{(i * 7 + 3) % n}") for i in range(n)] + [("n0", f"n{i}") for i in range(1, n)]


def _tables(spark):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("vidgraph_edges")}


def test_keeps_nothing_on_executors(spark, monkeypatch):
    """Between jobs there is no cached block to lose, what is no longer read is deleted, and
    at the end only the table of ranks stays."""
    import os

    import vidgraph.operators.influence as inf

    paths, frontiers, real, store = [], [], inf.scratch_path, inf._State.store

    def noted(s, name):
        paths.append(real(s, name))
        return paths[-1]

    def counted(state, df, name, *counts):
        assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
        frontiers.append(sum(n.startswith("frontier") for n in state.names()))
        return store(state, df, name, *counts)

    monkeypatch.setattr(inf, "scratch_path", noted)
    monkeypatch.setattr(inf._State, "store", counted)
    spark.catalog.clearCache()
    _pr(spark, *_graph(), salt_size=4, fold=3)
    left = [p for p in paths if os.path.exists(p.removeprefix("file:"))]
    assert len(frontiers) > 8 and max(frontiers) <= 4 and left == [paths[-1]] and not _tables(spark)


@pytest.mark.parametrize("stop_at,fold", [("pairs", 10), ("vertices", 10), ("frontier-5", 10), ("frontier-5", 2), ("ranks-3", 3)])
def test_resume_after_a_lost_driver(spark, tmp_dir, monkeypatch, stop_at, fold):
    """A run that stops while it makes an output goes on from the outputs before it."""
    import os

    import vidgraph.operators.influence as inf

    ids, edges = _graph()
    expected = _reference_pagerank(ids, edges)
    made, store = [], inf._State.store

    def stops(state, df, name, *counts):
        if name == stop_at:
            df.write.mode("overwrite").parquet(f"{state.path}/{name}")
            os.remove(f"{state.path}/{name}/_SUCCESS")   # half of it
            raise KeyboardInterrupt
        return store(state, df, name, *counts)

    def notes(state, df, name, *counts):
        if not state.done(name):
            made.append(name)
        return store(state, df, name, *counts)

    path = f"{tmp_dir}/state"
    monkeypatch.setattr(inf._State, "store", stops)
    with pytest.raises(KeyboardInterrupt):
        _pr(spark, ids, edges, salt_size=4, edges_per_bucket=9, fold=fold, state_path=path)
    assert os.path.isdir(path) and not _tables(spark)
    monkeypatch.setattr(inf._State, "store", notes)
    got = _pr(spark, ids, edges, salt_size=4, edges_per_bucket=9, fold=fold, state_path=path)
    assert got == pytest.approx(expected, rel=1e-9)
    assert made[0] == stop_at and not os.path.exists(path) and not _tables(spark)


def test_an_error_leaves_nothing(spark, monkeypatch):
    import os

    import vidgraph.operators.influence as inf

    paths, real = [], inf.scratch_path
    monkeypatch.setattr(inf, "scratch_path", lambda s, n: paths.append(real(s, n)) or paths[-1])
    monkeypatch.setattr(inf, "superstep", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _pr(spark, *_graph())
    assert paths and not any(os.path.exists(p) for p in paths) and not _tables(spark)


def test_not_converged_is_an_error(spark):
    with pytest.raises(RuntimeError, match="not converged"):
        _pr(spark, ["a", "b"], [("a", "b"), ("b", "a")], tol=1e-6, max_iter=3)
    assert _pr(spark, ["a", "b"], [("a", "b"), ("b", "a")], max_iter=500)["a"] == pytest.approx(1.0)


def test_trusted_edges_same_result(spark):
    ids = [f"n{i}" for i in range(12)]
    edges = sorted({(f"n{i}", f"n{(i * 5 + 1) % 12}") for i in range(12)} | {("n0", f"n{i}") for i in range(1, 12)})
    assert _pr(spark, ids, edges, trusted_edges=True) == pytest.approx(_pr(spark, ids, edges))


def test_superstep_shuffles_only_the_frontier(spark):
    """The stored edge table keeps its (src, salt) buckets and order, with AQE on."""
    from pyspark.sql import functions as F

    import vidgraph.operators.influence as inf

    v = spark.createDataFrame([(f"n{i}",) for i in range(50)], "id string")
    e = spark.createDataFrame([(f"n{i}", f"n{(i * 3) % 50}") for i in range(50)], "src string, dst string")
    dedup = inf.distinct_edges(v, e)
    vx = inf.vertex_salts(v, dedup, 2)
    state = inf._State(spark, scratch_path(spark, "test-superstep"))
    vx, _ = state.store(vx, "vertices")
    w, n = inf._edge_table(state, lambda: inf.weighted_edges(dedup, vx), "edges_of_a_superstep", lambda: 50, 13)
    frontier, _ = state.store(vx.select("num", F.lit(0.15).alias("delta"), "salts"), "frontier-0")
    plan = _explained(inf.superstep(frontier, w.hint("merge"), 0.15, 0.01, n, False))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning(src") == 1
    spark.sql("drop table edges_of_a_superstep")


def _explained(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_few_senders_read_few_blocks(spark):
    """Late supersteps: the senders' blocks prune the edge table's folders at run time."""
    from pyspark.sql import functions as F

    import vidgraph.operators.influence as inf

    v = spark.createDataFrame([(f"n{i}",) for i in range(400)], "id string")
    e = spark.createDataFrame([(f"n{i}", f"n{(i * 3 + k) % 400}") for i in range(400) for k in range(3)], "src string, dst string")
    dedup = inf.distinct_edges(v, e)
    state = inf._State(spark, scratch_path(spark, "test-blocks"))
    vx, _ = state.store(inf.vertex_salts(v, dedup), "vertices")
    w, n = inf._edge_table(state, lambda: inf.weighted_edges(dedup, vx), "edges_in_blocks", lambda: 1200, 30)
    assert n == 40
    rows, files = {}, {}
    for few in (1, 5, 400):
        frontier, _ = state.store(vx.orderBy("id").limit(few).select("num", F.lit(0.15).alias("delta"), "salts"), f"f-{few}")
        for prune in (False, True):
            step = inf.superstep(frontier, w, 0.15, 0.01, n, prune)
            assert ("dynamicpruning" in _explained(step)) == prune
            rows[few, prune] = sorted(map(tuple, step.collect()))
            files[few, prune] = _files_read(step, "edges")
    for few in (1, 5, 400):
        assert [r[:1] + r[2:] for r in rows[few, True]] == [r[:1] + r[2:] for r in rows[few, False]]
        assert [r[1] for r in rows[few, True]] == pytest.approx([r[1] for r in rows[few, False]])
        assert files[few, False] >= 35 and files[few, True] <= few
    assert files[1, True] == 1
    spark.sql("drop table edges_in_blocks")


def _files_read(df, name):
    """Files that the executed scans of paths holding ``name`` have read."""
    found = [0]

    def walk(node):
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if kind.endswith("QueryStage"):
            return walk(node.plan())
        if kind.startswith("Scan parquet") and name in node.toString():
            found[0] += node.metrics().apply("numFiles").value()
        for i in range(node.children().length()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found[0]


def test_integer_vertex_ids(spark):
    edges = [(i, (i * 3 + 1) % 20) for i in range(20)] + [(0, i) for i in range(1, 20)]
    v = spark.createDataFrame([(i,) for i in range(20)], "videoId long")
    e = spark.createDataFrame(edges, "srcVideoId long, dstVideoId long")
    got = {r.id: r.pagerank for r in influence.pagerank(v, e, salt_size=3,
                                                         edges_per_bucket=7).collect()}
    want = _reference_pagerank(list(range(20)), edges)
    assert got == pytest.approx(want, rel=1e-12)
