import math

import numpy as np
import pyarrow as pa
import pytest

from vigia.llm import language_id, pieces


@pytest.fixture(scope="module")
def vocabulary():
    return [p for p, _, _ in pieces.load()]


def brute_log(text, vocabulary, logs):
    """Log of the sum over all segmentations, character by character in plain Python."""
    number = {p: i for i, p in enumerate(vocabulary)}
    chars = [c.encode() for c in text]
    alpha = [1.0] + [0.0] * len(chars)
    for end in range(1, len(chars) + 1):
        for start in range(max(0, end - 16), end):
            piece = b"".join(chars[start:end])
            k = number.get(piece, len(vocabulary) if end == start + 1 else None)
            if k is not None:
                alpha[end] += alpha[start] * math.exp(logs[k])
    return math.log(alpha[-1])


def test_forward_sums_all_segmentations(vocabulary):
    rng = np.random.default_rng(1)
    logs = np.log(rng.dirichlet(np.ones(len(vocabulary) + 1), size=2).T)
    automaton = pieces.Automaton(vocabulary)
    for text in ["the", " reading", " über漢🙂", "\t", " xyzzyxyzzy"]:
        data = np.frombuffer(text.encode(), np.uint8)
        got = language_id.likelihoods(automaton, logs, data, np.array([0]), np.array([len(data)]))
        for k in range(2):
            assert got[0, k] == pytest.approx(brute_log(text, vocabulary, logs[:, k]), rel=1e-9)


def brute_log_of_long(text, vocabulary, logs):
    """As brute_log, in logarithms."""
    number = {p: i for i, p in enumerate(vocabulary)}
    chars = [c.encode() for c in text]
    alpha = [0.0]
    for end in range(1, len(chars) + 1):
        parts = []
        for start in range(max(0, end - 16), end):
            k = number.get(b"".join(chars[start:end]), len(vocabulary) if end == start + 1 else None)
            if k is not None:
                parts.append(alpha[start] + logs[k])
        most = max(parts)
        alpha.append(most + math.log(sum(math.exp(x - most) for x in parts)))
    return alpha[-1]


def test_long_words_are_summed_whole(vocabulary):
    """A word of 61 letters and one of 400: no segmentation is lost at a cut, alone or among short ones."""
    rng = np.random.default_rng(7)
    logs = np.log(rng.dirichlet(np.ones(len(vocabulary) + 1), size=2).T)
    automaton = pieces.Automaton(vocabulary)
    words = ["internationalisation" * 3 + "s", " the", "counterrevolutionary" * 20, "é漢" * 30]
    seg = pieces.Segments(pa.array(words), automaton.inside)
    got = language_id.likelihoods(automaton, logs, seg.data, seg.starts, seg.sizes)
    assert (seg.sizes > language_id.STRETCH).sum() >= 2
    for i, word in enumerate(words):
        for k in range(2):
            own = got[seg.first[i] : seg.first[i + 1], k].sum()
            assert own == pytest.approx(brute_log_of_long(word, vocabulary, logs[:, k]), rel=1e-9)


def test_expected_counts_of_a_long_word(vocabulary):
    """The counts in logarithms are those of the plain pass, and spell the word."""
    automaton = pieces.Automaton(vocabulary)
    data = np.frombuffer(b"abcdefgh" * 4, np.uint8)
    one = np.array([[1.0]])
    plain = language_id.expected(automaton, data, np.array([0]), np.array([32]), one)
    count = len(vocabulary) + 1
    flat = np.full(count, 1.0 / count)
    flat[-1] *= language_id.UNKNOWN
    logs = language_id._long_expected(automaton, np.log(flat), data, np.array([0]), np.array([32]))
    assert logs == pytest.approx(plain[:, 0], rel=1e-9, abs=1e-15)
    data = np.frombuffer(b"abcdefgh" * 40, np.uint8)
    long = language_id.expected(automaton, data, np.array([0]), np.array([320]), one)
    assert (long[:, 0] * np.append(automaton.length, 1)).sum() == pytest.approx(320)


def test_expected_counts_spell_the_text(vocabulary):
    """Expected pieces times their lengths is the text's length, times the copies."""
    automaton = pieces.Automaton(vocabulary)
    data = np.frombuffer(b" reading", np.uint8)
    got = language_id.expected(automaton, data, np.array([0]), np.array([8]), np.array([[3.0, 1.0]]))
    lengths = np.append(automaton.length, 1)
    assert (got * lengths[:, None]).sum(axis=0) == pytest.approx([24, 8])


def test_long_runs_do_not_underflow(vocabulary):
    automaton = pieces.Automaton(vocabulary)
    logs = np.log(np.full((len(vocabulary) + 1, 1), 1e-7))
    seg = pieces.Segments(pa.array(["漢" * 3000 + "x" * 5000]), automaton.inside)
    got = language_id.likelihoods(automaton, logs, seg.data, seg.starts, seg.sizes)
    assert np.isfinite(got).all() and seg.sizes.sum() == 14000


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op7_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_nulls_empty_and_repeats(spark):
    rows = [(i, "the cat and the dog of the house" if i % 2 else "der hund und die katze im haus", "en" if i % 2 else "de", 0.5) for i in range(60)]
    rows += [(None, None, "en", 0.1), (100, "", None, 0.1), (101, "12 34 !?", "de", 0.1), (102, None, None, 0.1), (103, "den hund", None, None), (103, "den hund", None, None), (104, "漢字", None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3)
    got = language_id.op7_language_id(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (None, 100, 101, 102)] == ["und"] * 4 and by[100].score == 0
    assert by[103].lang_pred == "de" and by[104].lang_pred in ("de", "en")
    assert by[None].held_out is False
    bare = language_id.op7_language_id(docs.withColumn("lang", docs.lang.cast("string") * 0 if False else docs.text.substr(0, 0)).where("1=0"))
    assert bare.count() == 0
    from pyspark.sql import functions as F

    nothing = language_id.op7_language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
