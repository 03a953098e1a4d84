"""Byte-level BPE encoding and decoding (operator 3).

Encoding works on the pieces that the tokenizer's pattern cuts from a text. The bytes of a piece are
mapped to Latin-1 characters, so that one character is one byte, and a pyahocorasick automaton over
the vocabulary finds the longest token that starts at each place. From left to right the encoder
takes the longest token that is compatible with the one before it, goes on to the next shorter
prefix if it is not, and steps back if none is left; a place from which it stepped back is never
entered again, so the work is linear in the piece. Two tokens are compatible if merging their joined
bytes gives just these two: undoing their last merges, the later one first, no two parts that meet at
the border may have been able to merge before; the answer is remembered. A sequence whose neighbours
are all compatible is the result of the merges themselves.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import with_python_columns

#: Entries of pieces in each of a worker's two generations, and of token pairs before it starts anew: some 50 MB in all.
MEMO, PAIRS = 1 << 17, 1 << 18


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read once on the driver; it is broadcast, and its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def merged(text: str, ranks: dict[str, int], until: int = 1) -> list[str]:
    """The merges as defined: join the adjacent pair of lowest rank, leftmost first, while there is one and more than ``until`` parts."""
    parts = list(text)
    while len(parts) > until:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks) * 2))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class Coder:
    """One vocabulary, ready to encode and decode."""

    def __init__(self, raw: bytes, pattern: str) -> None:
        pairs = [line.split() for line in raw.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token.encode("latin-1") for token, rank in self.ranks.items()}
        # the tokenizer's \s is Unicode white space, which Python's \s is not quite
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.automaton: ahocorasick.Automaton | None = None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str | None] = {}
        self.halves: dict[str, list[str]] = {}

    def build(self) -> None:
        """The automaton holds the tokens that merging can end in; others only match a whole piece."""
        self.automaton = ahocorasick.Automaton()
        for token in self.ranks:
            parts = merged(token, self.ranks, until=2)
            if len(parts) <= 2:
                self.automaton.add_word(token, (len(token) - 1, token))
                self.halves[token] = parts
        self.automaton.make_automaton()

    def compatible(self, left: str, right: str) -> bool:
        answer = self.fits.get((left, right))
        if answer is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            answer = self.fits[left, right] = self.stays_apart(left, right)
        return answer

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether merging the joined bytes of two tokens gives just these two."""
        ranks, bound = self.ranks, len(self.ranks) << 32
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < bound:
                return False
            a, b = ranks[left], ranks[right]
            if len(left) > 1 and (a > b or len(right) == 1):
                # what joins leftmost first may be as late as the left token's merge, but not the right one's
                left, bound = self.halves[left][-1], a
            elif len(right) > 1:
                right, bound = self.halves[right][0], b + 1
            else:
                return True

    def next_shorter(self, token: str) -> str | None:
        if token not in self.shorter:
            self.shorter[token] = next((token[:k] for k in range(len(token) - 1, 0, -1) if token[:k] in self.automaton), None)
        return self.shorter[token]

    def tokens(self, piece: str) -> list[str]:
        """``piece``: bytes as Latin-1."""
        if piece in self.ranks:
            return [piece]
        if self.automaton is None:
            self.build()
        longest: list[str | None] = [None] * len(piece)
        for end, (back, token) in self.automaton.iter(piece):  # by their ends, so that longer ones come later
            longest[end - back] = token
        left_behind = bytearray(len(piece) + 1)
        taken: list[str] = []
        at, token = 0, longest[0]
        while at < len(piece):
            while token is not None and (left_behind[at + len(token)] or (taken and not self.compatible(taken[-1], token))):
                token = self.next_shorter(token)
            if token is not None:
                taken.append(token)
                at += len(token)
                token = longest[at] if at < len(piece) else None
            elif taken:
                left_behind[at] = 1
                token = taken.pop()
                at -= len(token)
            else:
                raise ValueError("the vocabulary lacks single bytes")
        return taken

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        known, older, out = self.known, self.older, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    tokens = self.tokens(piece.encode("utf-8").decode("latin-1"))
                    ids = np.array([self.ranks[t] for t in tokens], dtype="<u4").tobytes()
                if len(piece) <= 64:
                    if len(known) >= MEMO:  # pieces in use move to the new generation, the rest are forgotten
                        older, known = known, {}
                        self.older, self.known = older, known
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def coder(raw: bytes, pattern: str) -> Coder:
    return Coder(raw, pattern)


def encode(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "token_ids", n_tokens: str = "n_tokens", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit token ids) and ``n_tokens`` for whole texts.

    A null text counts as empty: no tokens, empty ids. Rows are kept one for one, repeated ones too.
    A column that is already called ``ids`` or ``n_tokens`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make() -> Callable:
        one = coder(shared.value, pattern)

        def step(columns):
            made = [one.encode(t.as_py() or "") for t in columns[0]]
            return pa.array(made, pa.binary()), pa.array([len(x) // 4 for x in made], pa.int64())

        return step

    return with_python_columns(df, [text], [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType())], make)


def decode(df: DataFrame, ranks_path: str, ids: str = "token_ids", decoded: str = "decoded", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``decoded`` (binary: the bytes of the tokens, which need not be valid UTF-8 for any ids).

    Null ids decode to no bytes; an id outside the vocabulary is an error.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make() -> Callable:
        one = coder(shared.value, pattern)
        return lambda columns: [pa.array([one.decode(x or b"") for x in columns[0].to_pylist()], pa.binary())]

    return with_python_columns(df, [ids], [T.StructField(decoded, T.BinaryType())], make)


def round_trip(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "token_ids", n_tokens: str = "n_tokens", same: str = "round_trip", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encode``, and ``same``: whether decoding the ids gives the text's bytes again; both in one pass over the rows."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make() -> Callable:
        one = coder(shared.value, pattern)

        def step(columns):
            made, again = [], []
            for t in columns[0]:
                text = t.as_py() or ""
                made.append(one.encode(text))
                again.append(one.decode(made[-1]) == text.encode())
            return pa.array(made, pa.binary()), pa.array([len(x) // 4 for x in made], pa.int64()), pa.array(again, pa.bool_())

        return step

    return with_python_columns(df, [text], [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType()), T.StructField(same, T.BooleanType())], make)


def id_array(ids: str) -> Column:
    """The packed ids as array<bigint>."""
    raw = F.col(ids)
    byte = lambda i, k: F.conv(F.hex(F.substring(raw, i * 4 + 1 + k, 1)), 16, 10).cast("bigint")
    n = (F.octet_length(raw) / 4).cast("int")
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: byte(i, 0) + byte(i, 1) * 256 + byte(i, 2) * 65536 + byte(i, 3) * 16777216)
    )
