"""A piece vocabulary as an Aho-Corasick automaton that many segments walk at once.

Pieces and texts are bytes in which a blank stands for the vocabulary's word
mark.  Texts are cut into segments only between two bytes that stand side by
side in no piece, so no piece can cross a cut and every segment can be worked
out alone, once for all its copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vigia.llm.common import _powers, _BYTE, mix, text_bytes

#: Where the public vocabulary lies when the caller names no other place.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Scores of vocabulary pieces are whole numbers; a character in no piece costs this below the least.
UNKNOWN_PENALTY = 10


def load(model_file: str = MODEL_FILE) -> list[tuple[bytes, int, int]]:
    """Ordinary pieces of a SentencePiece model file as (bytes, id, score)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [
        (model.id_to_piece(i).replace(MARK, " ").encode(), i, int(model.get_score(i)))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def byte_ids(model_file: str = MODEL_FILE) -> list[int]:
    """Ids of the 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Automaton:
    """States are prefixes of pieces; ``goto`` is complete, failure links folded in.

    ``piece[s]`` is the number of the piece that ends in state s (or -1) and
    ``link[s]`` the next state on its suffix chain where a piece ends (0: none).
    """

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], dtype=np.int64)
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for number, piece in enumerate(pieces):
            state = 0
            for byte in piece:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                state = children[state][byte]
            ends[state] = number
        count = len(children)
        self.goto = np.zeros((count, 256), dtype=np.int32)
        self.piece = np.array(ends, dtype=np.int64)
        self.link = np.zeros(count, dtype=np.int32)
        fail = [0] * count
        queue = [0]
        for state in queue:
            row = self.goto[fail[state]].copy() if state else self.goto[0]
            for byte, child in children[state].items():
                fail[child] = int(row[byte]) if state else 0
                suffix = fail[child]
                self.link[child] = suffix if self.piece[suffix] >= 0 else self.link[suffix]
                queue.append(child)
            for byte, child in children[state].items():
                row[byte] = child
            self.goto[state] = row
        self.inside = np.zeros((256, 256), dtype=bool)
        for piece in pieces:
            for a, b in zip(piece, piece[1:]):
                self.inside[a, b] = True

    def walk(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Step all segments through the automaton together, longest first.

        Yields (end, active, matches): after ``end`` bytes, the first ``active``
        segments still run, and ``matches`` is a list of (segments, pieces), the
        output links followed from the longest piece to the shortest.
        """
        state = np.zeros(len(starts), dtype=np.int32)
        active = len(starts)
        for end in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            state = self.goto[state[:active], data[starts[:active] + end - 1]]
            matches = []
            at = np.flatnonzero((self.piece[state] >= 0) | (self.link[state] > 0))
            chain = state[at]
            own = self.piece[chain] < 0
            chain[own] = self.link[chain[own]]
            while len(at):
                matches.append((at, self.piece[chain]))
                chain = self.link[chain]
                more = np.flatnonzero(chain > 0)
                at, chain = at[more], chain[more]
            yield end, active, matches


class Segments:
    """The segments of some texts, and which of them are equal."""

    def __init__(self, column: pa.Array, inside: np.ndarray, most: int = 0):
        """``most`` over 0 also cuts segments at that many bytes, at a character's start."""
        data, self.offsets = text_bytes(column)
        n = len(data)
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        if n:
            cut[1:n] |= ~inside[data[:-1], data[1:]]
            cut[:n] &= (data & 0xC0) != 0x80
            cut[self.offsets] = True
        bounds = np.flatnonzero(cut)
        if most and n:
            long = np.flatnonzero(np.diff(bounds) > most)
            for k in long.tolist():
                at = np.arange(bounds[k] + most, bounds[k + 1], most)
                for p in at.tolist():
                    while (data[p] & 0xC0) == 0x80:
                        p -= 1
                    cut[p] = True
            bounds = np.flatnonzero(cut)
        self.data, self.starts = data, bounds[:-1] if n else np.zeros(0, np.int64)
        self.sizes = np.diff(bounds) if n else np.zeros(0, np.int64)
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
        own = (sums[self.starts + self.sizes] - sums[self.starts]) * down[self.starts]
        self.hashes = mix(own + self.sizes.astype(np.uint64))
        #: First segment of each row, and the number of segments at the end.
        self.first = np.searchsorted(self.starts, self.offsets)


class Cache:
    """Sorted 64-bit keys with a row number each; rows are added, and all dropped at ``most``."""

    def __init__(self, most: int):
        self.most, self.keys, self.rows, self.count = most, np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 for those not held."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rows[at], -1)

    def add(self, keys: np.ndarray) -> np.ndarray:
        """New rows for keys not held yet."""
        rows = np.arange(self.count, self.count + len(keys))
        self.count += len(keys)
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys, self.rows = merged[order], np.concatenate([self.rows, rows])[order]
        return rows


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of starts[1], and so on."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)
