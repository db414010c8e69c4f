import math

import numpy as np
import pytest
from conftest import TESTDATA

from vigia.llm import rp_forest as r


def brute(rows, every=20, k=20):
    """The k nearest of each query by exact scores; ties to the smaller id."""
    good = [(i, v) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in good:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, b in good:
                if i != q:
                    score = 0.0
                    for x, y in zip(a, b, strict=True):
                        score += x * y
                    best[i] = max(score, best.get(i, -math.inf))
    return {q: sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k] for q, best in out.items() if best}


def answers(df):
    got = {}
    for row in sorted(df.collect(), key=lambda x: (x.query_id, x.rank)):
        own = got.setdefault(row.query_id, [])
        own.append((row.score, row.vec_id))
        assert row["rank"] == len(own)
    return got


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, id string")


def recall(got, want):
    return np.mean([len({i for _, i in got.get(q, ())} & {i for _, i in best}) / len(best) for q, best in want.items()])


def small_rows():
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8) * rng.choice((0.1, 1, 30)))]) for i in range(-100, 1200)]
    same = [0.5, 0.25, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0]
    rows += [(int(i), same) for i in range(2000, 2600)]
    rows += [(int(i), [2 * x for x in same]) for i in range(2600, 2650)]
    bad = [None, [], [0.0] * 8, [1.0] * 7, [1.0] * 9, [None, *[1.0] * 7], [float("nan"), *[1.0] * 7], [float("inf"), *[1.0] * 7]]
    rows += [(3000 + 20 * i, v) for i, v in enumerate(bad)] + [(None, same)]
    return rows + [(40, same), (40, same), (41, [9.0] * 8), (41, [-9.0] * 8)]


def test_answers_match_brute_force(spark):
    """Visiting all leaves is exact; the fitted number of leaves finds nearly all, and what it finds has the exact score."""
    rows = small_rows()
    want = brute(rows)
    got = answers(r.op13_nearest_vectors(frame(spark, rows).repartition(7)))
    assert set(got) == set(want) and recall(got, want) >= 0.9
    scores = {(q, i): s for q, best in brute(rows, k=10_000).items() for s, i in best}
    assert all(scores[q, i] == s for q, own in got.items() for s, i in own)
    assert all(len(own) == 20 for own in got.values())


def test_few_rows_are_exact(spark):
    rows = [(i, [float(x) for x in np.float32(np.random.default_rng(i).normal(size=8))]) for i in range(60)] + [(i, [1.0] * 8) for i in range(60, 90)]
    assert answers(r.op13_nearest_vectors(frame(spark, rows, "double"))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0] * 8)], [(20, [0.0] * 8), (40, [1.0, 2.0])]])
def test_nothing_to_find(spark, rows):
    out = r.op13_nearest_vectors(frame(spark, rows))
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0] + [0.0] * 7), (1, [1.0] * 8), (2, [-1.0] * 8)]
    assert answers(r.op13_nearest_vectors(frame(spark, rows))) == {0: [(1.0, 1), (-1.0, 2)]}


def test_queue_reaches_leaves_by_squared_margins():
    rng = np.random.default_rng(4)
    forest = r.fit(rng.normal(size=(3000, 8)))
    x = rng.normal(size=(1, 8))
    margins = forest.margins(x)[0]
    off = {}
    for tree in range(len(margins)):
        for leaf in range(1 << forest.depth):
            node, total = leaf + forest.nodes, 0.0
            while node:
                parent, right = (node - 1) // 2, node % 2 == 0
                total += margins[tree][parent] ** 2 * ((margins[tree][parent] > 0) != right)
                node = parent
            off[tree, leaf] = total
    order = forest.reached(margins, len(off))
    assert sorted(order) == sorted(off) and np.all(np.diff([off[x] for x in order]) >= -1e-12)
    own = {(t, int(leaf[0])) for t, leaf in enumerate(forest.leaves(x))}
    assert {x for x in order if off[x] == 0} == own


def test_slots_and_salts_cover_all_rows(spark, monkeypatch):
    """Small blocks: several slots a tree, then several parts a leaf; the answer stays."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(2000)]
    want = brute(rows)
    for block in (300, 20):
        monkeypatch.setattr(r, "BLOCK_ROWS", block)
        layout = r.Layout.of(r.fit(np.array([v for _, v in rows])), len(rows), "<f4")
        assert layout.levels > 1 and (layout.salts > 1) == (block == 20)
        assert recall(answers(r.op13_nearest_vectors(frame(spark, rows))), want) >= 0.9


def test_a_hot_vector_sends_few_rows():
    ids, matrix = np.arange(5000)[::-1], np.ones((5000, 4))
    kept = r.least_ids(ids, matrix, 21)
    assert sorted(ids[kept]) == list(range(21))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_test_tables(spark, sf):
    df = spark.read.parquet(f"{TESTDATA}/{sf}/embeddings.parquet")
    rows = [(x.vec_id, np.array(x.embedding)) for x in df.collect()]
    matrix = np.stack([v for _, v in rows])
    got = answers(r.op13_nearest_vectors(df))
    want = {}
    for q, v in rows:
        if q % 20 == 0:
            score = matrix @ v
            order = sorted(((s, i) for s, (i, _) in zip(score, rows, strict=True) if i != q), key=lambda x: (-x[0], x[1]))
            want[q] = order[:20]
    assert recall(got, want) >= 0.9
