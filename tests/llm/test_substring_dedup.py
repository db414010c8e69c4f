import hashlib
import random
import re

import pytest

from vigia.llm import substring_dedup as z


def brute(rows):
    starts = {}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                starts[key] = min(i, starts.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        lost = set()
        if i is not None:
            for k in range(len(w) - 12):
                if starts[tuple(w[k : k + 13])] < i:
                    lost.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in lost)
        out.append((i, len(w), len(lost), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(60)}é" for _ in range(n)]
    passage, long = fresh(55), fresh(400)
    rows = []
    for i in range(60):
        w = fresh(rng.choice([0, 5, 12, 13, 14, 40, 120]))
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(20) : rng.randrange(30, 56)]
        if i % 7 == 0:
            w += long[: rng.choice([13, 12, 200, 400])]
        if i % 11 == 0:
            w += ["x"] * 40
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(200 + i, rows[i][1]) for i in range(25)]
    rows += [(100, None), (101, ""), (None, " ".join(long)), (None, None), (102, " ".join(passage)), (102, " ".join(passage)), (103, " ".join(long[:30])), (103, " ".join(passage[:30]) + " tail")]
    rows += [(-5, " ".join(long[100:160])), (104, " ".join(fresh(3000) + long))]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, places string").repartition(4)
    got = z.op5_substring_dedup(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    """Many packs for each window, as in a large table."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(23)
    got = z.op5_substring_dedup(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)


def test_levels_double_until_nothing_is_left(spark):
    long = " ".join(f"a{i}" for i in range(60))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, " ".join(f"a{i}" for i in range(20))), (4, "other")], "doc_id long, text string")
    assert {r.doc_id: r.longest for r in z.op5_substring_dedup(docs).collect()} == {1: 52, 2: 52, 3: 13, 4: 0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a b")], [(None, "a b")]])
def test_hardly_any_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert z.op5_substring_dedup(docs).count() == len(rows)
