"""Byte-level BPE encoding and decoding as a monoid over a tree of text halves (operator 7).

A text is halved until a leaf is short. Leaves are encoded alone; two neighbours are joined by encoding a window around
their border again. The window grows on both sides until it ends at a *settled* place: a place that the splitting
pattern cuts whatever stands further left or right. Tokens outside the window are then those of the joined text, so a
join returns exactly the encoding of the joined text. Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_small_batches

#: Fixed value: the ranks of the contract.
RANKS = "byte_bpe_multi_50k.tiktoken"
LEAF_POINTS, LEAF_IDS, WINDOW = 4096, 4096, 32

#: Class of the character before and after a place where every text is cut: letter, number, other sign, space.
SETTLED = frozenset({"ls", "ns", "os", "xs", "ln", "nl", "lo", "no", "on"})


def kind(c: str) -> str:
    """l, n, o, s where no version of the character tables differs; x: a letter of some script; else ``?``."""
    if c in " \t\n\r":
        return "s"
    if c.isalpha():
        return "l" if ord(c) < 0x0530 else "x"
    if "0" <= c <= "9":
        return "n"
    return "o" if "!" <= c <= "~" else "?"


def settled(text: str, at: int) -> bool:
    return kind(text[at - 1]) + kind(text[at]) in SETTLED


class Codec:
    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.token = {rank: token for token, rank in merges.items()}
        self.length = np.zeros(max(merges.values()) + 1, np.int64)
        for token, rank in merges.items():
            self.length[rank] = len(token)

    def plain(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text), np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, first: int, end: int) -> np.ndarray:
        if end - first <= LEAF_POINTS:
            return self.plain(text[first:end])
        middle = (first + end) // 2
        return self._join(text, first, middle, end, self._encode(text, first, middle), self._encode(text, middle, end))

    def _join(self, text: str, first: int, middle: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if settled(text, middle):
            return np.concatenate([left, right])
        a = self._border(text, middle, first, -1)
        b = self._border(text, middle, end, 1)
        kept = len(left) - self._covering(left[::-1], len(text[a:middle].encode()))
        skipped = self._covering(right, len(text[middle:b].encode()))
        return np.concatenate([left[:kept], self.plain(text[a:b]), right[skipped:]])

    @staticmethod
    def _border(text: str, middle: int, limit: int, step: int) -> int:
        """The nearest settled place from ``middle`` towards ``limit``, or ``limit``."""
        at = middle + step
        while at != limit and not settled(text, at):
            at += step
        return at

    def _covering(self, ids: np.ndarray, size: int) -> int:
        """How many leading ids make up ``size`` bytes; looks at growing windows of them."""
        if not size:
            return 0
        look = WINDOW
        while True:
            upto = np.cumsum(self.length[ids[:look]])
            if upto[-1] >= size:
                n = int(np.searchsorted(upto, size)) + 1
                assert upto[n - 1] == size, "a settled place lies within a token"
                return n
            look *= 2

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.token.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


class Tokenizer:
    """Columns that encode and decode; the rank file is read once by the driver and sent along, under 1 MB."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        import public_tokenizers

        with open(path or public_tokenizers.path(RANKS), "rb") as file:
            self.ranks = file.read()
        self.pattern = pattern or public_tokenizers.PATTERN

    def codec(self) -> Codec:
        return _codec(self.ranks, self.pattern)

    def encoded(self, text: Column) -> Column:
        """``array<int>`` of token ids; null counts as empty text, which has no ids."""
        ranks, pattern = self.ranks, self.pattern

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(ranks, pattern)
            for texts in batches:
                ids = [codec.encode(t.as_py() or "").view(np.int32) for t in texts]
                bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids or [np.zeros(0, np.int32)])))

        return encode(text)

    def decoded(self, ids: Column) -> Column:
        """The bytes of an ``array<int>`` of token ids; null counts as no ids."""
        ranks, pattern = self.ranks, self.pattern

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(ranks, pattern)
            for rows in batches:
                yield pa.array([codec.decode(np.asarray(x.as_py() or (), np.int64)) for x in rows], pa.binary())

        return decode(ids)

    def digests(self, text: Column) -> Column:
        """Count and digest of a text's ids, and the digest of the bytes these decode to; only digests leave the task."""
        ranks, pattern = self.ranks, self.pattern

        @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(ranks, pattern)
            for texts in batches:
                counts, encoded, decoded = [], [], []
                for t in texts:
                    ids = codec.encode(t.as_py() or "").astype("<u4")
                    counts.append(len(ids))
                    encoded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                columns = [pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
                yield pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

        return digest(text)


def encode_documents(docs: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text; needs ``doc_id`` and ``text``, other columns are not read.

    Null and empty texts have no ids. Rows are encoded one by one, so repeated rows give repeated results.
    """
    ids = (tokenizer or Tokenizer()).encoded(F.col("text"))
    return in_small_batches(docs).select("doc_id", ids.alias("ids")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


def encode_digests(docs: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, then decoded again, in one pass without a shuffle."""
    t = tokenizer or Tokenizer()
    return in_small_batches(docs).select("doc_id", t.digests(F.col("text")).alias("d")).select("doc_id", "d.*")
