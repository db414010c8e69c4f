import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from vigia.llm import periodic_runs as p


def words_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        a, g = (h // 10) % n, h // 10
        q = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % q] for i, w in enumerate(words)]
    return words


def brute_runs(words):
    """Every maximal stretch by comparing all words q apart; the least period of a stretch is its own."""
    least, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in least.items())


def brute(doc_id, text):
    words = words_of(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    s, q, n = best or (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), s, n, q, 1000 * n // q if best else None, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(kept)


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


def sequences():
    rng = random.Random(3)
    yield ["x"] * 700
    yield list("ab") * 300
    yield list("aab") * 40 + ["c"] + list("aab") * 40
    yield thue_morse(3000)
    yield ["a"] * 6 + ["b"] + ["a"] * 5 + ["c"] + ["a"] * 7
    yield (["a"] * 8 + ["b"]) * 30
    yield ["a"] * 3 + ["b"] * 4
    for _ in range(250):
        out = []
        while len(out) < rng.choice((5, 30, 200, 900)):
            unit = [rng.choice("abc" if rng.random() < 0.7 else "abcdefghijklmnop") for _ in range(rng.choice((1, 2, 3, 5, 7, 8, 16, 31, 33, 64)))]
            many = rng.choice((1, 1, 3, 4, 5, 9))
            out += (unit * many)[: len(unit) * many - rng.randrange(len(unit))]
        yield out


@pytest.mark.parametrize("core", [4096, 16])
def test_runs_of_one_text_match_brute_force(core, monkeypatch):
    """With small tiles every run is cut and stitched again."""
    monkeypatch.setattr(p, "CORE", core)
    for words in sequences():
        hashes = np.array([hash(w) & 0xFFFFFFFFFFFFFFFF for w in words], dtype=np.uint64)
        pieces = {}
        for octave, first, of, solve, codes in p.tiles(hashes):
            for q, s, e in p.intervals(octave, first, of, solve, np.frombuffer(codes, np.int32).tolist()):
                pieces.setdefault(q, []).append((s, e))
        least = {}
        for q in sorted(pieces):
            whole = []
            for s, e in sorted(pieces[q]):
                if whole and s <= whole[-1][1] - q:
                    whole[-1] = (whole[-1][0], max(e, whole[-1][1]))
                else:
                    whole.append((s, e))
            for s, e in whole:
                if e - s >= max(6, 4 * q):
                    least.setdefault((s, e), q)
        assert sorted((s, q, e - s) for (s, e), q in least.items()) == brute_runs(words)


def rows():
    rng = random.Random(8)
    out = [(i, " ".join(x)) for i, x in enumerate(sequences())]
    out += [(1000 + i, rng.choice((" ", "\n", "\x0b\t")).join(rng.choice("uvwxyz") + str(rng.randrange(9)) for _ in range(rng.choice((1, 7, 60, 400))))) for i in range(200)]
    out += [(None, None), (5, None), (None, ""), (6, " \n"), (None, "a b " * 20), (7, "é\x85 é\x85 " * 9), (8, "z " * 30_000)]
    return out + [(1007, out[-2][1])] * 2 + [(1003, "long " + "w" * 90_000)]


def test_query_matches_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, start int, words string").repartition(6)
    got = p.op12_periodic_runs(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [r for r in data if len(r[1] or "") < 50_000]
    want = [brute(*r) for r in small]
    have = [tuple(r) for r in got.collect() if r.doc_id != 8 or r.length != 30_000]
    big = [r for r in got.collect() if r.length == 30_000 and r.period == 1]
    assert len(big) == 1 and big[0].exponent_milli == 30_000_000
    assert sorted(map(repr, have)) == sorted(map(repr, [*want, brute(1003, data[-1][1])]))


def test_a_tile_hands_on_one_interval_a_run():
    """A long run of one word is a few intervals, not one a word or one a period."""
    hashes = np.zeros(100_000, dtype=np.uint64)
    found = [x for t in p.tiles(hashes) for x in p.intervals(*t[:4], np.frombuffer(t[4], np.int32).tolist())]
    assert {q for q, _, _ in found} == {1} and len(found) < 40


def test_empty_table(spark):
    assert p.op12_periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
