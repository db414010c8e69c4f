import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from vigia.llm import pieces
from vigia.llm.sentencepiece_codec import Codec, decode, encode


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(), pieces.byte_ids()


@pytest.fixture(scope="module")
def codec(vocabulary):
    return Codec(*vocabulary)


def brute(text, vocabulary):
    """Best sum of scores by plain dynamic programming; longest last piece of equals."""
    entries, byte_ids = vocabulary
    if not text:
        return []
    scores = {p: (s, i) for p, i, s in entries}
    unknown = min(s for s, _ in scores.values()) - pieces.UNKNOWN_PENALTY
    chars = [c.encode() for c in " " + text]
    best, back = [0] + [None] * len(chars), [None] * (len(chars) + 1)
    for end in range(1, len(chars) + 1):
        for start in range(max(0, end - 16), end):
            piece = b"".join(chars[start:end])
            if piece in scores:
                score, ids = best[start] + scores[piece][0], [scores[piece][1]]
            elif end == start + 1:
                score, ids = best[start] + unknown, [byte_ids[b] for b in piece]
            else:
                continue
            if best[end] is None or score > best[end]:
                best[end], back[end] = score, (start, ids)
    out, end = [], len(chars)
    while end:
        end, ids = back[end]
        out[:0] = ids
    return out


TEXTS = ["", " ", "  a  b\nc\td", "the quick brown fox", "é ü 漢字🙂 x", "▁literal▁mark", "aaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01 z", "don’t “quote”", "x" * 70, "      \n\n   indented = 12345"]


def texts():
    rng = random.Random(5)
    letters = "abcdeinorst   \n.,'éüß漢🙂0123"
    return TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(150)]


def rows(codec, values):
    ids, counts = codec.encode(pa.array(values, pa.string()))
    ends = np.cumsum(counts)
    return [ids[e - c : e].tolist() for e, c in zip(ends, counts)]


def test_encoding_is_the_best_sum(codec, vocabulary):
    for text, ids in zip(texts(), rows(codec, texts())):
        assert ids == brute(text, vocabulary), repr(text)


def test_equals_the_library_on_the_same_scores(codec, tmp_path):
    """The vocabulary file with its model type set to unigram: the library's lattice search has as good a best path."""
    raw = open(pieces.MODEL_FILE, "rb").read()
    at = raw.rindex(b"\x18\x02 \x80\xfa\x01")
    path = tmp_path / "unigram.model"
    path.write_bytes(raw[:at] + b"\x18\x01" + raw[at + 2 :])
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    plain = ["the", "reading", "nation of things", "Eauouon enpaeux", "over the top", "Schaft und Keit", "token12"]
    for text, ids in zip(plain, rows(codec, plain)):
        theirs = library.nbest_encode_as_ids(text, 3)[0]
        assert sum(library.get_score(i) for i in ids) == sum(library.get_score(i) for i in theirs)


def test_rows_nulls_repeats_and_clashing_columns(spark):
    data = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "same", "y"), (7, None, None), (3, TEXTS[3], "z")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string").repartition(3)
    out = encode(docs)
    assert out.columns == ["doc_id", "ids", "n_tokens", "round_trip"]
    got = out.collect()
    assert len(got) == len(data)
    assert all(r.round_trip is (None if r.ids is None else True) for r in got)
    assert [r.n_tokens for r in got if r.doc_id == 0] == [0]
    back = decode(out).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in back))) == sorted(map(repr, ((a, b) for a, b, _ in data)))


def test_decode_of_foreign_ids(spark):
    frame = spark.createDataFrame([(1, [0, 1, 99999999, None, 3 + 0xE6]), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in decode(frame).collect()} == {1: "�", 2: ""}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode(docs).count() == 0


def test_small_cache_gives_the_same(vocabulary, codec, monkeypatch):
    from vigia.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "CACHE_SEGMENTS", 5)
    small = Codec(*vocabulary)
    for _ in range(2):
        assert rows(small, texts()) == rows(codec, texts())
