"""Secret scans: fixed patterns, and a log-likelihood ratio of character Markov models.

The patterns find assigned values, access keys and long hex strings.  What they
find in the corpus are the labelled random strings, all other tokens of 4
characters or more the labelled ordinary ones: those under 16 as they are, digits
included, since they are never judged; longer ones only without a digit, and by
triples that are common in the corpus, so that none vouches for itself.  The models
read any digit as 0: which digit it is tells nothing.  Second-order character models
of both are counted over every text (class, two characters before, character: a
bounded table).  A token
of 16 characters or more that no pattern covers is a ``markov`` span when the
log-likelihood ratio times the share of random tokens says it is random with a
probability over ``CERTAINTY``.

Null text is empty.  Without a random or an ordinary token to learn from, only
the patterns find spans.  Repeated rows and texts of any length are handled one
by one; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import chunks, text_bytes

#: The patterns, the least length of what they must find, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "markov")

#: Characters of a token, 0 for all digits; symbol 0 stands before its first one.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0+/_=-"
SIZE = len(ALPHABET) + 1
TRAIN_LENGTH = 4
SCAN_LENGTH = 16
CERTAINTY = 0.999
#: Triples of long ordinary tokens count from so many of them, and from so many for each ordinary token.
ORDINARY_TIMES, ORDINARY_SHARE = 3, 1e-6
SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SIZE)
SYMBOL[ord("1") : ord("9") + 1] = SYMBOL[ord("0")]
_HINTS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """Pattern spans (start, end, kind, start of the value) in code points, by start and then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Tokens:
    """Runs of token characters of some texts, and which of them a pattern span touches."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        symbol = SYMBOL[self.data]
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = symbol > 0
        begins = np.zeros(n + 2, dtype=bool)
        begins[self.offsets + 1] = True
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | begins[1:-1]))
        self.ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | begins[2:])) + 1
        self.spans = [base_spans(x or "") for x in column.to_pylist()]
        self.covered = np.zeros(len(self.starts), dtype=bool)
        self.values = []  # byte spans of what the patterns found
        for row, spans in enumerate(self.spans):
            if spans:
                a, b = self.offsets[row], self.offsets[row + 1]
                place = a + np.flatnonzero((self.data[a:b] & 0xC0) != 0x80)
                place = np.append(place, b)  # byte of each code point
                for start, end, _, value in spans:
                    i, j = np.searchsorted(self.ends, place[start], "right"), np.searchsorted(self.starts, place[end])
                    self.covered[i:j] = True
                    self.values.append((place[value], place[end]))

    def cells(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model cell of every character of some byte spans, and where each span's cells begin."""
        size = ends - starts
        first = np.cumsum(size) - size
        at = np.repeat(starts - first, size) + np.arange(int(size.sum()))
        place = at - np.repeat(starts, size)
        symbol = SYMBOL[self.data]
        one = np.where(place >= 1, symbol[np.maximum(at - 1, 0)], 0)
        two = np.where(place >= 2, symbol[np.maximum(at - 2, 0)], 0)
        return (two * SIZE + one) * SIZE + symbol[at], first


def train(docs: DataFrame) -> np.ndarray | None:
    """Log-likelihood ratio (random to ordinary) of every cell, the last one the log odds of a random token."""

    def count(batches):
        totals = np.zeros((3, SIZE**3 + 1), dtype=np.int64)
        for batch in chunks(batches):
            tokens = Tokens(batch.column("text"))
            size = tokens.ends - tokens.starts
            digits = np.append(0, np.cumsum((tokens.data >= 48) & (tokens.data <= 57)))
            plain = ~tokens.covered & (size >= TRAIN_LENGTH)
            short, long = plain & (size < SCAN_LENGTH), plain & (size >= SCAN_LENGTH) & (digits[tokens.ends] == digits[tokens.starts])
            values = np.array(sorted(set(tokens.values)), dtype=np.int64).reshape(-1, 2)
            for label, some in ((0, short), (2, long)):
                cells, _ = tokens.cells(tokens.starts[some], tokens.ends[some])
                totals[label, :-1] += np.bincount(cells, minlength=SIZE**3)
            # A found value counts each of its cells once, or one endless run would drown all others.
            cells, _ = tokens.cells(values[:, 0], values[:, 1])
            owner = np.repeat(np.arange(len(values)), values[:, 1] - values[:, 0])
            totals[1, :-1] += np.bincount(np.unique(owner * SIZE**3 + cells) % SIZE**3, minlength=SIZE**3)
            totals[:, -1] += int(short.sum()), len(values), int(long.sum())
        label, cell = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(cell), pa.array(totals[label, cell])], names=["label", "cell", "n"])

    rows = docs.mapInArrow(count, "label long, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros((3, SIZE**3 + 1))
    totals[rows.column("label").to_numpy(), rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    # A long random token of letters that no pattern found counts as ordinary too; it must not vouch for itself.
    long = totals[2].copy()
    totals = totals[:2]
    totals[0, -1] += long[-1]
    long[:-1][(totals[0] + long)[:-1] < max(ORDINARY_TIMES, ORDINARY_SHARE * totals[0, -1])] = 0
    totals[0, :-1] += long[:-1]
    if not totals[:, -1].all():
        return None
    counts = totals[:, :-1].reshape(2, SIZE, SIZE, SIZE)
    # Each order is smoothed towards the one below: none, one and two characters before.
    p = np.full((2, 1, 1, SIZE), 1.0 / SIZE)
    for seen in (counts.sum(axis=(1, 2), keepdims=True), counts.sum(axis=1, keepdims=True), counts):
        total, kinds = seen.sum(axis=3, keepdims=True), (seen > 0).sum(axis=3, keepdims=True)
        p = (seen + (kinds + 1) * p) / (total + kinds + 1)
    ratio = np.log(p[1]) - np.log(p[0])
    return np.append(ratio.reshape(-1), math.log(totals[1, -1] / totals[0, -1]))


def scan(docs: DataFrame, ratio: np.ndarray | None) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        table = shipped.value
        least = math.log(CERTAINTY / (1 - CERTAINTY))
        for batch in chunks(batches):
            tokens = Tokens(batch.column("text"))
            added: dict[int, list] = {}
            if table is not None:
                at = np.flatnonzero(~tokens.covered & (tokens.ends - tokens.starts >= SCAN_LENGTH))
                if len(at):
                    cells, first = tokens.cells(tokens.starts[at], tokens.ends[at])
                    score = np.add.reduceat(table[cells], first) + table[-1]
                    for k in at[score > least].tolist():
                        row = int(np.searchsorted(tokens.offsets, tokens.starts[k], "right")) - 1
                        before = tokens.data[tokens.offsets[row] : tokens.starts[k]]
                        start = int(((before & 0xC0) != 0x80).sum())
                        added.setdefault(row, []).append((start, start + int(tokens.ends[k] - tokens.starts[k]), "markov"))
            out = []
            for row, spans in enumerate(tokens.spans):
                base = [f"{k}:{a}:{b}" for a, b, k, _ in spans]
                every = sorted([s[:3] for s in spans] + added.get(row, []), key=lambda s: (s[0], KINDS.index(s[2])))
                counts = [sum(s[2] == k for s in every) for k in KINDS]
                out.append((*counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k in every)))
            n_assign, n_access, n_hex, n_markov, sha, spans = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_assign, n_access, n_hex)), pa.array(sha), pa.array(spans), pa.array(n_markov, pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")


def op8_secret_scan(docs: DataFrame) -> DataFrame:
    """Train on the corpus, then scan all of it."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return scan(narrow, train(narrow))
