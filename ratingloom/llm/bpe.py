"""Byte-level BPE: encoding by a hierarchical-bitmap rank queue, and decoding.

Every match of the split pattern is encoded by itself. Its bytes form a linked list;
each adjacent pair that is in the vocabulary waits in the bucket of its merge rank.
A bitmap over the buckets, with bitmaps over its words above it, finds the lowest rank
in a few steps, so a pre-token of a million bytes takes time in proportion to its
length. An entry whose pair has changed meanwhile is skipped when it comes up.

Results: a null text has no bytes and no ids. A text of any length is handled in slices
of matches, so memory follows the text, not the number of its tokens. Rows that repeat
give the same ids. Other columns are not touched; columns of the output names are
replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT_TOKENS = 400_000  # pre-tokens remembered by a worker
KEPT_LENGTH = 64  # longest pre-token that is remembered
SLICE = 50_000  # matches, or ids, handled at once


class Vocabulary(dict):
    """Pre-token to its ids as little-endian bytes; fills itself as pre-tokens come up."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        # Two levels of bitmaps whose words have as many bits as there are words.
        self.shift = -(-max(ranks.values(), default=1).bit_length() // 2)
        self.bits = [1 << i for i in range(1 << self.shift)]
        self.words = [0] * (1 << self.shift)

    def __missing__(self, token: str) -> bytes:
        merged = self.merge(token.encode())
        ids = pack(f"<{len(merged)}I", *merged)
        if len(token) <= KEPT_LENGTH:
            if len(self) >= KEPT_TOKENS:
                self.clear()
            self[token] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        longest, shift, bits, words = self.longest, self.shift, self.bits, self.words
        mask = len(bits) - 1
        top = 0  # which words have a bit set
        buckets: dict[int, list[int]] = {}  # heaps of positions by rank
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))  # start of the part to the left
        waiting = [rank_of(piece[i : i + 2]) for i in range(n - 1)]  # this part with the next
        waiting.append(None)
        for start, rank in enumerate(waiting):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(start)
                else:
                    buckets[rank] = [start]
                    words[rank >> shift] |= bits[rank & mask]
                    top |= bits[rank >> shift]
        while top:
            at = (top & -top).bit_length() - 1
            word = words[at]
            rank = (at << shift) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                start = heappop(bucket)
            else:
                start = bucket[0]
                del buckets[rank]
                words[at] = word = word & word - 1
                if not word:
                    top &= top - 1
            if waiting[start] != rank:
                continue  # stale: one of the two parts has grown or gone since
            right = end[start]
            end[start] = after = end[right]
            waiting[right] = None
            left = before[start]
            joined = None
            if after < n:
                before[after] = start
                if end[after] - start <= longest:
                    joined = rank_of(piece[start : end[after]])
            waiting[start] = joined
            if joined is not None:
                if joined in buckets:
                    heappush(buckets[joined], start)
                else:
                    buckets[joined] = [start]
                    words[joined >> shift] |= bits[joined & mask]
                    top |= bits[joined >> shift]
            if left >= 0:
                joined = rank_of(piece[left:after]) if after - left <= longest else None
                waiting[left] = joined
                if joined is not None:
                    if joined in buckets:
                        heappush(buckets[joined], left)
                    else:
                        buckets[joined] = [left]
                        words[joined >> shift] |= bits[joined & mask]
                        top |= bits[joined >> shift]
        ids = []
        start = 0
        while start < n:
            ids.append(self.ranks[piece[start : end[start]]])
            start = end[start]
        return ids


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(parse_ranks(content))


@lru_cache(maxsize=2)
def _tokens(content: bytes) -> list[bytes]:
    ranks = parse_ranks(content)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def encode_text(text: str, vocabulary: Vocabulary, pattern: regex.Pattern) -> bytes:
    if len(text) <= SLICE:
        return b"".join(map(vocabulary.__getitem__, pattern.findall(text)))
    matches = (m.group() for m in pattern.finditer(text))
    slices = []
    while part := list(islice(matches, SLICE)):
        slices.append(b"".join(map(vocabulary.__getitem__, part)))
    return b"".join(slices)


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    found = np.frombuffer(ids, dtype="<u4")
    return b"".join(
        b"".join(map(tokens.__getitem__, found[at : at + SLICE].tolist()))
        for at in range(0, len(found), SLICE)
    )


class ByteBpe:
    """Column functions for one rank file and split pattern.

    The driver reads the file once; its content (some bytes a token) goes out as a
    broadcast, bounded by the size of the vocabulary. Each worker parses it once.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            content = spark.sparkContext.broadcast(file.read())

        @F.arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary, compiled = _vocabulary(content.value), regex.compile(pattern)
            for texts in batches:
                ids = (encode_text(t.as_py() or "", vocabulary, compiled) for t in texts)
                yield pa.array(ids, pa.binary(), size=len(texts))

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokens = _tokens(content.value)
            for found in batches:
                bodies = (decode_ids(ids.as_py() or b"", tokens) for ids in found)
                yield pa.array(bodies, pa.binary(), size=len(found))

        self._encode, self._decode = encode, decode

    def encode(self, text: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that such ids stand for."""
        return self._decode(ids)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text"
) -> DataFrame:
    """The documents with token_ids, n_tokens and decoded (bytes; equal to the text's)."""
    bpe = ByteBpe(docs.sparkSession, ranks_path, pattern)
    encoded = docs.withColumn("token_ids", bpe.encode(F.col(text)))
    return encoded.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long")).withColumn(
        "decoded", bpe.decode(F.col("token_ids"))
    )
