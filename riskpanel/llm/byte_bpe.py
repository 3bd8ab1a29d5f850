"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

The bytes of a pre-token are read as Latin-1 characters, so that a string automaton finds
every vocabulary entry in them. A token sequence is what the merges would give exactly if
each two neighbours are what the merges give for their joined bytes. So the encoder takes
the longest entry at each position, checks it against the token before, falls back to the
next shorter entry, and steps back a token when none is left; a position found to be a
dead end is never entered again, which makes the work linear in the length. Whether two
tokens may stand together is remembered, as are the ids of common pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskpanel.llm.common import ship

_MEMO_ENTRIES = 400_000
_MEMO_CHARS = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.reachable: dict[bytes, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.packed: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """The merges carried out one by one, lowest rank first; only for short strings."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(
                ((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)), default=None
            )
            if best is None or best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def produced(self, token: int) -> bool:
        """Whether the merges can end in this token at all."""
        data = self.tokens[token]
        found = self.reachable.get(data)
        if found is None:
            found = self.reachable[data] = self.merged(data) == [token]
        return found

    def compatible(self, left: int, right: int) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            found = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            if len(self.fits) >= 4 * _MEMO_ENTRIES:
                self.fits.clear()
            self.fits[left, right] = found
        return found

    def next_shorter(self, token: int) -> int:
        """The longest produced entry that is a proper prefix of ``token``; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            data, found = self.tokens[token], -1
            for n in range(len(data) - 1, 0, -1):
                rank = self.ranks.get(data[:n])
                if rank is not None and self.produced(rank):
                    found = rank
                    break
            self.shorter[token] = found
        return found

    def backtrack(self, data: bytes) -> list[int]:
        """The token ids of one pre-token."""
        longest = [-1] * len(data)
        for end, (width, token) in self.automaton.iter(data.decode("latin-1")):
            if self.produced(token):
                longest[end - width + 1] = token  # later matches from one start are longer
        alive = bytearray(b"\x01") * (len(data) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(data):
            width = len(self.tokens[token])
            while not (alive[at + width] and (not out or self.compatible(out[-1], token))):
                token = self.next_shorter(token)
                if token < 0:
                    break
                width = len(self.tokens[token])
            if token >= 0:
                out.append(token)
                at += width
                if at < len(data):
                    token = longest[at]
            else:  # nothing fits here behind the tokens so far
                alive[at] = 0
                token = out.pop()
                at -= len(self.tokens[token])
        return out

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.backtrack(data)

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        memo, out = self.packed, []
        for piece in self.split(text):
            ids = memo.get(piece)
            if ids is None:
                found = self.encode_piece(piece)
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(piece) <= _MEMO_CHARS:
                    if len(memo) >= _MEMO_ENTRIES:
                        memo.clear()
                    memo[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode_packed(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[tuple[str, str], ByteBpe] = {}  # one per worker process and vocabulary


def _coder(name: tuple[str, str], vocabulary) -> ByteBpe:
    if name not in _CODERS:
        _CODERS[name] = ByteBpe(*vocabulary.value)
    return _CODERS[name]


def encode(docs: DataFrame, ranks_path: str, pattern: str, digests_only: bool = False) -> DataFrame:
    """Ids of every text and what they decode to; row by row, no shuffle.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, unless ``digests_only``, the
    packed ids and the decoded text. A null text is empty: no ids and the digests of
    nothing. Repeated rows give repeated results, an empty table an empty one; other
    columns are not read. The vocabulary, a fixed file, is sent to the executors once.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast((load_ranks(ranks_path), pattern))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if not digests_only:
        schema += ", ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder((ranks_path, pattern), vocabulary)
        for batch in batches:
            ids = [coder.encode_packed(t or "") for t in batch.column("text").to_pylist()]
            raw = [coder.decode_packed(x) for x in ids]
            columns = [
                batch.column("doc_id"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if not digests_only:
                columns += [pa.array(ids, pa.binary()), pa.array([x.decode("utf-8") for x in raw], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, schema)
