"""SentencePiece encoding and decoding: Aho-Corasick driven Viterbi.

Every text gets the segmentation into vocabulary pieces whose scores add up to
most; of equal sums the one with the longest last piece, then so on towards the
front.  The automaton over all pieces reads each byte once; at every position it
follows output links through all pieces that end there, each relaxing the best
score.  A character that is no piece falls back to its byte pieces.  Ids follow
the model file (a blank before the text, blanks kept, nothing normalised), so
decoding gives back the text byte for byte, U+2581 included (it takes byte pieces).

One pass, no shuffle.  Equal segments are encoded once per block and kept in a
bounded cache.  Null text: null ids and text.  Empty text: no ids.  Repeated
rows, null ids and extra columns need no care: rows are handled one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm import pieces
from vigia.llm.common import chunks, text_bytes

#: Bytes of text encoded in one go, and distinct segments and their ids kept between
#: blocks.  A worker holds the automaton, some arrays of a block's length and this.
BLOCK_BYTES = 1 << 20
CACHE_SEGMENTS, CACHE_IDS = 250_000, 2_000_000


class Codec:
    """Vocabulary tables of one worker."""

    def __init__(self, vocabulary: list[tuple[bytes, int, int]], bytes_of: list[int]):
        self.automaton = pieces.Automaton([p for p, _, _ in vocabulary])
        self.ids = np.array([i for _, i, _ in vocabulary], dtype=np.int32)
        self.scores = np.array([s for _, _, s in vocabulary], dtype=np.int64)
        self.byte_ids = np.array(bytes_of, dtype=np.int32)
        self.unknown = int(self.scores.min()) - pieces.UNKNOWN_PENALTY
        spelled = {i: p for p, i, _ in vocabulary} | {i: bytes([b]) for b, i in enumerate(bytes_of)}
        size = max(spelled) + 1
        self.size = np.array([len(spelled.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.spelling = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.reset()

    def reset(self) -> None:
        self.cache = pieces.Cache(CACHE_SEGMENTS)
        self.tokens, self.counts, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def viterbi(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a line, and how many each has."""
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        # Segment k owns places base[k] to base[k] + sizes[k]: one for each position between bytes.
        base = np.cumsum(sizes + 1) - (sizes + 1)
        total = int((sizes + 1).sum())
        lowest = np.int64(-(1 << 62))
        best = np.full(total, lowest)
        best[base] = 0
        token, back = np.zeros(total, np.int32), np.ones(total, np.int32)
        char = np.zeros(len(starts), dtype=np.int64)  # where the current character began
        for end, active, matches in self.automaton.walk(data, starts, sizes):
            own, place = starts[:active] + end, base[:active] + end
            last = data[own - 1]
            whole = (end == sizes[:active]) | ((data[np.minimum(own, len(data) - 1)] & 0xC0) != 0x80)
            token[place] = self.byte_ids[last]  # inside a character: byte by byte
            single = np.zeros(active, dtype=bool)
            for at, piece in matches:
                length = self.automaton.length[piece]
                score = best[base[at] + end - length] + self.scores[piece]
                single[at] |= length == end - char[at]
                better = score > best[base[at] + end]
                at, piece, length, score = at[better], piece[better], length[better], score[better]
                best[base[at] + end], token[base[at] + end], back[base[at] + end] = score, self.ids[piece], length
            at = np.flatnonzero(whole & ~single)
            score = best[base[at] + char[at]] + self.unknown
            better = score > best[base[at] + end]
            at, score = at[better], score[better]
            best[base[at] + end], token[base[at] + end], back[base[at] + end] = score, self.byte_ids[last[at]], 1
            char[:active][whole] = end
        # Walk back from the ends, once to count and once to write.
        counts, position, live = np.zeros(len(starts), np.int64), sizes.copy(), np.arange(len(starts))
        while len(live):
            counts[live] += 1
            position[live] -= back[base[live] + position[live]]
            live = live[position[live] > 0]
        ends = np.cumsum(counts)
        out, left, position, live = np.zeros(int(counts.sum()), np.int32), counts.copy(), sizes.copy(), np.arange(len(starts))
        while len(live):
            place = base[live] + position[live]
            left[live] -= 1
            out[(ends - counts)[live] + left[live]] = token[place]
            position[live] -= back[place]
            live = live[position[live] > 0]
        unsorted = np.empty_like(order)
        unsorted[order] = np.arange(len(order))
        return out[pieces.spread((ends - counts)[unsorted], counts[unsorted])], counts[unsorted]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a line, and how many each row has; null and empty rows have none."""
        text = pc.fill_null(column.cast(pa.large_string()), "")
        marked = pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
        found = pieces.Segments(marked, self.automaton.inside)
        keys, where, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        if self.cache.count > self.cache.most or len(self.tokens) > CACHE_IDS:
            self.reset()
        rows = self.cache.find(keys)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            tokens, counts = self.viterbi(found.data, found.starts[where[fresh]], found.sizes[where[fresh]])
            self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(counts) - counts])
            self.tokens, self.counts = np.concatenate([self.tokens, tokens]), np.concatenate([self.counts, counts])
            rows[fresh] = self.cache.add(keys[fresh])
        row = rows[which]
        ids = self.tokens[pieces.spread(self.starts[row], self.counts[row])]
        sums = np.concatenate([[0], np.cumsum(self.counts[row])])
        return ids, np.diff(sums[found.first])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows in a line, and where each row starts; the blank before a text is taken off."""
        size = self.size[ids]
        data = self.spelling[pieces.spread(self.start[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        begins = ends[:-1][counts > 0]
        keep = np.ones(len(data), dtype=bool)
        keep[begins[data[begins] == 32]] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        return data[keep], kept[ends]


_held: dict[int, Codec] = {}


def _codec(vocabulary, bytes_of) -> Codec:
    """One codec for each worker and vocabulary."""
    key = hash((tuple(vocabulary), tuple(bytes_of)))
    if key not in _held:
        _held.clear()
        _held[key] = Codec(vocabulary, bytes_of)
    return _held[key]


def encode(docs: DataFrame, model_file: str = pieces.MODEL_FILE) -> DataFrame:
    """doc_id, ids (array of int), n_tokens and ``round_trip``: whether decoding gives the text back."""
    broadcast = docs.sparkSession.sparkContext.broadcast((pieces.load(model_file), pieces.byte_ids(model_file)))
    fields = docs.select("doc_id").schema["doc_id"].dataType

    def run(batches):
        codec = _codec(*broadcast.value)
        for batch in chunks(batches, most=BLOCK_BYTES):
            column = batch.column("text")
            ids, counts = codec.encode(column)
            raw, begins = codec.decode(ids, counts)
            data, offsets = text_bytes(column)
            valid = np.asarray(column.is_valid())
            if len(raw) == len(data) and np.array_equal(begins, offsets) and np.array_equal(raw, data):
                same = np.ones(len(counts), dtype=bool)
            else:
                same = np.array([raw[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(begins[:-1], begins[1:], offsets[:-1], offsets[1:])], dtype=bool)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))
            null = pa.array(~valid)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.if_else(null, pa.scalar(None, lists.type), lists), pc.if_else(null, None, pa.array(counts)), pc.if_else(null, None, pa.array(same))],
                names=["doc_id", "ids", "n_tokens", "round_trip"],
            )

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {fields.simpleString()}, ids array<int>, n_tokens long, round_trip boolean")


def decode(encoded: DataFrame, model_file: str = pieces.MODEL_FILE) -> DataFrame:
    """doc_id and the text that ``ids`` spell; null for null.

    Ids that spell no UTF-8 give U+FFFD for what cannot be read; ids outside the
    vocabulary, and null ones, spell nothing.
    """
    broadcast = encoded.sparkSession.sparkContext.broadcast((pieces.load(model_file), pieces.byte_ids(model_file)))
    fields = encoded.select("doc_id").schema["doc_id"].dataType

    def run(batches):
        codec = _codec(*broadcast.value)
        for batch in batches:
            texts = []
            for row in batch.column("ids"):
                if not row.is_valid:
                    texts.append(None)
                    continue
                ids = np.asarray(pc.fill_null(row.values, -1), dtype=np.int64)
                ids = ids[(ids >= 0) & (ids < len(codec.size))]
                texts.append(codec.decode(ids, np.array([len(ids)]))[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {fields.simpleString()}, text string")
