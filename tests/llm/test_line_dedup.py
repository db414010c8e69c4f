import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigia.llm import line_dedup as z


def long(k):
    return f"line number {k} with enough letters"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_is_an_alignment(left, right):
    pairs = z.patience(left, right)
    assert all(left[a] == right[b] for a, b in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    if sorted(left) == left and sorted(right) == right:
        assert len(pairs) == sum(min(left.count(x), right.count(x)) for x in set(left))


def test_patience_of_a_moved_block():
    assert z.patience([1, 2, 3, 4, 5, 9], [4, 5, 1, 2, 3, 8]) == [(0, 2), (1, 3), (2, 4)]


def brute(rows):
    """Every pair of documents, in order, with the same line keys and the same patience diff."""
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    import hashlib

    docs.sort(key=lambda d: (d[0], d[1], hashlib.md5(d[2].encode()).digest()))

    def keys(text):
        lines = text.split("\n")
        seed = [len(x) >= z.SEED_CHARS for x in lines]
        out = []
        for k, x in enumerate(lines):
            above = [j for j in range(k) if seed[j]]
            below = [j for j in range(k, len(lines)) if seed[j]]
            out.append(x if seed[k] else ("after", x, lines[above[-1]]) if above else ("before", x, lines[below[0]]) if below else None)
        return out

    held = {}
    for d, (_, _, t) in enumerate(docs):
        for k in set(keys(t)) - {None}:
            held.setdefault(k, []).append(d)
    rare = z.RARE_LEAST + z.RARE_SHARE * len(rows)
    out = {}
    for d, (absent, i, t) in enumerate(docs):
        mine, lost = keys(t), set()
        for partner in range(d):
            common = {k for k in mine if k and held[k][0] == partner and len(held[k]) <= rare}
            a = [(p, k) for p, k in enumerate(mine) if k in common]
            b = [k for k in keys(docs[partner][2]) if k in common]
            lost |= {a[x][0] for x, _ in z.patience([k for _, k in a], b)}
        if any(docs[e][2] == t for e in range(d)):
            lost = set(range(len(mine)))
        out[None if absent else i, t] = ("\n".join(x for p, x in enumerate(t.split("\n")) if p not in lost), len(mine), len(lost))
    return sorted(((i, *(out[i, t] if t is not None else (None, 0, 0))) for i, t in rows), key=repr)


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(80):
        lines = [rng.choice([long(rng.randrange(40)), long(rng.randrange(10_000)), "ok.", "", "The."]) for _ in range(rng.randrange(12))]
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(None, rows[3][1]), (None, None), (7, None), (5, rows[5][1]), (5, "\n".join(map(long, range(5))))]
    rows += [(300, "short"), (301, "short"), (302, "\n".join([long(1)] * 30)), (303, "\n".join([long(1)] * 40)), (304, "The.\nok."), (305, "é" * 100_000)]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, lost int").repartition(5)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in z.op1_line_dedup(docs).collect()), key=repr)
    assert got == brute(rows)
    assert z.line_dedup(docs).columns == ["doc_id", "text", "key", "lost", "__lines", "__lost"]


def test_a_family_keeps_its_lines_once_and_strangers_keep_theirs(spark):
    body = [long(k) for k in range(20)]
    rows = [(k, "\n".join([*body[: 5 + k % 10], f"own words of document number {k}", *body[10:]])) for k in range(200)]
    rows += [(1000 + k, "\n".join(f"stranger {k} says something else {j}" for j in range(5)) + "\nThe end.") for k in range(50)]
    got = {r.doc_id: r for r in z.op1_line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k].n_removed == 0 for k in range(1000, 1050))
    assert got[0].n_removed == 0 and all(f"own words of document number {k}" in got[k].text for k in range(200))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "")]])
def test_hardly_any_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.n_removed for r in z.op1_line_dedup(docs).collect())) == [0] * len(rows)


def test_runs_of_short_lines_are_aligned(spark):
    verse = [f"verse {k * k} of it" for k in range(201)]
    chinese = [f"第{k}行，山高水长{k * 7}。" for k in range(40)]
    rows = [(1, "\n".join(verse)), (2, "\n".join([*verse[:100], "changed", *verse[101:]])), (3, "\n".join(chinese)), (4, "\n".join([*chinese[1:], "末"]))]
    rows += [(5, "\n".join([long(1), "- apples", "- pears", "", "- plums and figs", long(2)])), (6, "\n".join([long(3), "- apples", "- pears", "", "- plums and figs", long(4)]))]
    rows += [(10 + k, f"own {k}\nThe end.\nok.") for k in range(20)]
    got = {r.doc_id: r for r in z.op1_line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert [got[k].n_removed for k in (1, 3, 5)] == [0, 0, 0] and all(got[10 + k].n_removed == 0 for k in range(20))
    assert (got[2].n_removed, got[2].text) == (200, "changed")
    assert (got[4].n_removed, got[4].text) == (39, "末")
    assert (got[6].n_removed, got[6].text) == (4, f"{long(3)}\n{long(4)}")


def test_runs_match_plain_python():
    rng = random.Random(6)
    for _ in range(200):
        size = [rng.choice([0, 3, 9, 14, 24, 25, 40]) for _ in range(rng.randrange(12))]
        stop = [next((j for j in range(i, len(size)) if size[j] >= z.SEED_CHARS), len(size)) for i in range(len(size))]
        want = []
        for i in range(len(size)):
            ends = [j for j in range(i + 1, stop[i] + 1) if sum(size[i:j]) >= z.SEED_CHARS]
            want += [(i, ends[0])] if ends else []
        begin, end = z._runs(z.np.array(size, dtype=int), z.np.array(stop, dtype=int))
        assert list(zip(begin.tolist(), end.tolist())) == want
