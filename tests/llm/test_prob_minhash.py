import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigia.llm import common
from vigia.llm import prob_minhash as z


def shingle_counts(text):
    w = text.split()
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_similarity(a, b):
    total = 0.0
    for d in set(a) & set(b):
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
    return total


def texts():
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 30, 120, 400]))) for _ in range(25)]
    out = list(base)
    for t in base:
        for changes in (1, 1, 2, 4, 9):
            w = t.split()
            for _ in range(changes):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out + ["spam " * 40, "spam " * 50, "a b", "a b c", "b a"]


def test_similarity_is_the_probability_jaccard():
    some = texts()[::7]
    row, hashes, weights = z.shingles(pa.array(some))
    sets = [(hashes[row == k], weights[row == k]) for k in range(len(some))]
    for i in range(len(some)):
        for j in range(i):
            assert z.similarity(sets[i], sets[j]) == pytest.approx(brute_similarity(shingle_counts(some[i]), shingle_counts(some[j])), abs=1e-9)


def test_signatures_estimate_it():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        n = int(rng.integers(5, 60))
        names = rng.integers(1, 2**62, n).astype(np.uint64)
        a, b = rng.integers(1, 5, n).astype(float), rng.integers(0, 5, n).astype(float)
        row, h, w = np.repeat([0, 1], n), np.concatenate([names, names]), np.concatenate([a, b])
        keep = w > 0
        order = np.lexsort((h[keep], row[keep]))
        s = z.signatures(row[keep][order], h[keep][order], w[keep][order], 2)
        assert (s != 0).all()
        exact = brute_similarity(dict(zip(names.tolist(), a)), {k: v for k, v in zip(names.tolist(), b) if v})
        errors.append((s[0] == s[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.25


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    counts = [shingle_counts(t) if t is not None else Counter() for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if same or (counts[i] and counts[j] and brute_similarity(counts[i], counts[j]) >= z.SIMILAR):
                parent[root(i)] = root(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], least[root(k)]) for k in range(len(rows))), key=repr)


def test_classes_match_all_pairs(spark):
    rows = list(enumerate(texts()))
    rows += [(500 + i, rows[i][1]) for i in range(0, 60, 3)] + [(900, None), (901, None), (902, ""), (903, ""), (904, " \n"), (None, rows[0][1]), (None, "lonely text without an id"), (5, rows[5][1]), (5, "one more text under a number that is taken")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string").repartition(4)
    got = sorted(((r.doc_id, r.class_id) for r in z.op3_near_duplicates(docs).collect()), key=repr)
    assert got == brute_classes(rows)
    kept = z.one_of_each(docs)
    assert kept.columns == ["doc_id", "text", "id"]
    ids = [r.doc_id for r in kept.collect()]
    assert len(set(ids)) >= len({c for _, c in got if c is not None and c not in (900, 901)}) and {900, 901} <= set(ids)


def test_sketches_drop_no_link():
    some = [t for t in texts() if len(t) > 20]
    row, hashes, weights = z.shingles(pa.array(some))
    sketch, facts = z.sketches(row, hashes, weights, len(some))
    sets = [(hashes[row == k], weights[row == k]) for k in range(len(some))]
    i, j = np.triu_indices(len(some), 1)
    may = z.may_be_similar(sketch[i], sketch[j], facts[i], facts[j])
    like = np.array([z.similarity(sets[x], sets[y]) >= z.SIMILAR for x, y in zip(i, j)])
    assert like.any() and may[like].all() and not may.all()
    assert (facts[:, 1] > facts[:, 0]).any()


def test_bounds_hold_for_repeated_shingles():
    """Texts with lines repeated up to 300 times: no link is ruled out, and most others are."""
    rng = random.Random(4)
    some = []
    for _ in range(14):
        light = [f"l{rng.randrange(400)}" for _ in range(rng.choice((30, 150)))]
        heavy = [f"h{k} h{k + 1} h{k + 2}" for k in range(rng.choice((1, 3, 30)))]
        many = rng.choice((2, 9, 300))
        for _ in range(6):
            w = light[:]
            for _ in range(rng.choice((0, 1, 3, 20))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            some.append(" ".join(w + [line for line in heavy for _ in range(max(1, many + rng.choice((-1, 0, 0, 5))))]))
    row, hashes, weights = z.shingles(pa.array(some))
    sketch, facts = z.sketches(row, hashes, weights, len(some))
    sets = [(hashes[row == k], weights[row == k]) for k in range(len(some))]
    i, j = np.triu_indices(len(some), 1)
    may = z.may_be_similar(sketch[i], sketch[j], facts[i], facts[j])
    like = np.array([z.similarity(sets[x], sets[y]) for x, y in zip(i, j)])
    assert may[like >= z.SIMILAR].all() and (like >= z.SIMILAR).sum() > 20
    assert may[like < 0.5].mean() < 0.3


def test_null_texts_repeated_rows_and_clashing_names(spark):
    """All rows of null text stay; of a repeated document one row stays, always the same; no name is taken."""
    schema = "doc_id long, text string, id string, __id string, __kept int, __first int, row string, hash long, number int, root binary"
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, None, "a"), (5, None, "b"), (None, None, "c"), (None, None, "d"), (1, text, "x"), (1, text, "y"), (2, text, "z"), (2, "other text of one line", "v")]
    rows = [(*r, "i", 1, 2, "r", 3, 4, b"q") for r in rows]
    docs = spark.createDataFrame(rows, schema)
    out = [z.one_of_each(x) for x in (docs, docs.repartition(5))]
    assert out[0].columns == docs.columns
    got = [sorted(map(repr, x.collect())) for x in out]
    assert got[0] == got[1] and len(got[0]) == 6
    kept = [(r.doc_id, r.text is None, r.id) for r in out[0].collect()]
    assert {k for k in kept if k[1]} == {(5, True, "a"), (5, True, "b"), (None, True, "c"), (None, True, "d")}
    assert sum(k[0] == 1 for k in kept) == 1 and not any(k[2] == "z" for k in kept)


@pytest.mark.parametrize("block", [3])
def test_blocks_of_an_open_bucket_miss_nothing(spark, monkeypatch, block):
    """A family just around the threshold, in which no leader reaches all."""
    monkeypatch.setattr(z, "BLOCK", block)
    rng = random.Random(block)
    family = [[f"f{k}" for k in range(60)]]
    for _ in range(60):
        w = list(rng.choice(family[-12:]))
        for _ in range(rng.choice([1, 1, 2])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        family.append(w)
    rows = [(k, " ".join(w)) for k, w in enumerate(family)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id) for r in z.op3_near_duplicates(docs).collect()), key=repr)
    assert got == brute_classes(rows)


def test_texts_too_long_to_send_are_verified_afterwards():
    """Blocks give links between texts that were sent, one less than a component has members, and open pairs for the rest."""
    rng = random.Random(9)
    base = [f"f{k}" for k in range(300)]
    some = []
    for k in range(12):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        some.append(" ".join(w))
    row, hashes, weights = z.shingles(pa.array(some))
    sign = z.signatures(row, hashes, weights, len(some)).reshape(-1, z.BANDS, z.ROWS)[:, :, 0]
    sketch, facts = z.sketches(row, hashes, weights, len(some))
    sets = [(hashes[row == k], weights[row == k]) for k in range(len(some))]
    sign[:] = 1  # all meet in the first bucket
    ids = [bytes([k]) * 16 for k in range(len(some))]

    def table(sent):
        names = [h.tobytes() if k in sent else None for k, (h, _) in enumerate(sets)]
        n = len(some)
        number = lambda x: pa.chunked_array([pa.array([x] * n, pa.int64())])
        columns = {"id": pa.chunked_array([pa.array(ids, pa.binary())]), "root": pa.chunked_array([pa.array(ids, pa.binary())])}
        for name, rows in (("bands", sign), ("sketch", sketch), ("facts", facts)):
            columns[name] = pa.chunked_array([z._lists(rows)])
        columns |= {c: number(0) for c in ("slot", "k", "i", "j", "band")}
        columns |= {"shingles": pa.chunked_array([pa.array(names, pa.binary())]), "weights": pa.chunked_array([pa.array([None] * n, pa.binary())])}
        return pa.table(columns)

    links = {(i, j) for i in range(12) for j in range(i) if z.similarity(sets[i], sets[j]) >= z.SIMILAR}
    got = z._pairs(table(range(12)), np.array([0, 12])).to_pylist()
    assert all(r["sure"] and (r["a"][0], r["b"][0]) in links for r in got)

    def groups(pairs):
        parent = list(range(12))
        for i, j in pairs:
            a, b = parent[i], parent[j]
            parent = [b if p == a else p for p in parent]
        return [[x for x in range(12) if parent[x] == parent[y]] for y in range(12)]

    whole = groups(links)
    assert groups([(r["a"][0], r["b"][0]) for r in got]) == whole
    assert len(got) == 12 - len({min(g) for g in whole})
    part = z._pairs(table(range(6)), np.array([0, 12])).to_pylist()
    assert {r["sure"] for r in part} == {True, False}
    kept = [(r["a"][0], r["b"][0]) for r in part if r["sure"] or (r["a"][0], r["b"][0]) in links]
    assert groups(kept) == whole


def test_a_chain_is_one_class(spark):
    """Each text is like its neighbours only; no leader is like all."""
    w = [f"v{k}" for k in range(600)]
    rows = [(k, " ".join(w[10 * k : 10 * k + 200])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in z.op3_near_duplicates(docs).collect()} == {0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d e f")]])
def test_hardly_any_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert z.op3_near_duplicates(docs).count() == len(rows) == z.one_of_each(docs).count()


def random_links(seed):
    rng = random.Random(seed)
    out = [(i, i + 1) for i in range(100, 130)]  # a path
    out += [(250, i) for i in range(200, 251)] + [(300, i) for i in range(300, 340)]  # a hub of largest and one of least id
    nodes = rng.sample(range(400, 1000), 150)
    out += [tuple(rng.sample(nodes, 2)) for _ in range(110)]
    out += rng.choices(out, k=60) + [(b, a) for a, b in rng.choices(out, k=60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, monkeypatch, seed):
    """Least id of every component, each id once; few tables are written on the way."""
    written = []
    write = common.stored
    monkeypatch.setattr(common, "stored", lambda df, label: written.append(label) or write(df, label))
    pairs = random_links(seed)
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    links = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = sorted(tuple(r) for r in common.components(links, "links").collect())
    assert got == sorted((k, root(k)) for k in parent)
    # Before: one and two for each round.
    assert len(written) <= 5


def test_components_of_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long"), "links").collect() == []


def test_sifted_rows_are_those_asked_for(spark, monkeypatch):
    rows = spark.range(5000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("id"), F.col("id").alias("number"))
    ids = rows.where("number % 50 = 3").select("id")
    for bits in (1 << 24, 1 << 8):
        monkeypatch.setattr(common, "SIFT", bits)
        got = {r.number for r in common.sifted(rows, ids).collect()}
        assert got == {k for k in range(5000) if k % 50 == 3}
    sifted = common.sifted(rows, ids)
    assert sifted.columns == rows.columns
    # The bitmap comes first: the exact join stands above it.
    joins = [line for line in sifted._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert len(joins) == 2 and "__word" not in joins[0] and "__word" in joins[1]


def test_what_a_member_brings_is_not_stored_for_each_bucket(spark, monkeypatch):
    tables = {}
    write = z.stored
    monkeypatch.setattr(z, "stored", lambda df, label: tables.setdefault(label, write(df, label)))
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    z.links(docs)
    assert not {"bands", "sketch", "facts"} & set(tables["open-members"].columns)


def test_whole_rows_are_shuffled_once(spark):
    """Rows of one text meet in one shuffle by its digest, and the least of all its doc_ids stays."""
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(3, text, "x"), (2, text, "y"), (None, text, "z"), (2, text, "v"), (7, "another text", "u")], "doc_id long, text string, s string").repartition(3)
    one = z.one_of_each(docs)
    assert sorted(r.doc_id for r in one.collect()) == [2, 7]
    plan = one._jdf.queryExecution().sparkPlan().toString() + one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("coalesce(number" in line for line in moved)
