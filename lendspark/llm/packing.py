"""Packing token sequences by best-fit decreasing."""

from __future__ import annotations

import base64
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spread, stored

LENGTH = 2048
END_ID = 0                # follows each document
SHARD_PIECES = 50_000     # pieces that one task packs together; each leaves a few part-filled sequences
LONG_SPACE = re.compile(r"\s{65536}")  # the pattern of rank files backtracks over white space, with a stack of a million
COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class TokenBytes:
    """Token ids of texts as little-endian 32-bit words.

    A .json vocabulary is read by tokenizers, a .tiktoken file of the same
    vocabulary's ranks by tiktoken, which gives the same ids several times
    faster; a text with a very long run of white space, which its pattern
    cannot take, is read by the .json beside it.  As is the default of
    tokenizers, a text is split at the vocabulary's added tokens, which the
    .json lists, and each is its one id.
    """

    def __init__(self, path: str):
        self.ranks, self.path = not path.endswith(".json"), path
        if not self.ranks:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(path)
        else:
            import public_tokenizers
            import tiktoken
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.added = {}
            if os.path.exists(self._json()):
                with open(self._json(), encoding="utf-8") as words:
                    self.added = {t["content"]: t["id"] for t in json.load(words)["added_tokens"]}
            ranks = {token: rank for token, rank in ranks.items() if rank not in self.added.values()}
            self.tokenizer = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)

    def _json(self) -> str:
        return self.path.removesuffix(".tiktoken") + ".json"

    def _ids(self, text: str) -> list[int]:
        if any(t in text for t in self.added):
            return self.tokenizer.encode(text, allowed_special="all")
        return self.tokenizer.encode_ordinary(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranks:
            return [encoder(self._json()).encode([t])[0] if len(t) >= 65536 and LONG_SPACE.search(t)
                    else np.array(self._ids(t), "<u4").tobytes() for t in texts]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


_encoders: dict[str, TokenBytes] = {}


def encoder(path: str) -> TokenBytes:
    """One for each worker process: reading a vocabulary takes a while."""
    if path not in _encoders:
        _encoders[path] = TokenBytes(path)
    return _encoders[path]


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, after a shorter first one if need be."""
    first = total % length or min(total, length)
    return [(0, first)] + [(s, length) for s in range(first, total, length)]


def _pieces(path: str, length: int):
    end = struct.pack("<I", END_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo in range(0, len(ids), 512):
                out = []
                for doc_id, raw in zip(ids[lo:lo + 512], code.encode([t or "" for t in texts[lo:lo + 512]])):
                    raw += end
                    for k, (s, n) in enumerate(cut(len(raw) // 4, length)):
                        out.append((doc_id, k, s, n, zlib.crc32(memoryview(raw)[4 * s:4 * (s + n)])))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class OpenBins:
    """Bins by remaining capacity under a segment tree that counts the bins in
    each range of capacities; the tightest that fits is found in one climb and
    one descent, so in the logarithm of the sequence length."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, bin_: int) -> None:
        if room:
            self.bins[room].append(bin_)
            self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(bin, its room) with the least room of ``need`` or more."""
        node, count = self.leaves + need, self.count
        while not count[node]:
            while node & 1:  # no right sibling under this parent: go up
                node >>= 1
            if not node:
                return None
            node += 1
            if not node & (node - 1):  # past the last leaf of a level
                return None
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: list[int], length: int) -> tuple[list[int], list[int]]:
    """(bin, offset) for each of ``lengths``, which must be in falling order."""
    open_, n_bins, where, offset = OpenBins(length), 0, [], []
    for x in lengths:
        found = open_.take(x)
        if found is None:
            found, n_bins = (n_bins, length), n_bins + 1
        bin_, room = found
        where.append(bin_)
        offset.append(length - room)
        open_.put(room - x, bin_)
    return where, offset


def _pack(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offset = best_fit_decreasing(pdf["length"].tolist(), length)
        pdf["sequence_id"] = pdf["shard"].astype("int64") * (1 << 32) + np.array(bins, "int64")
        pdf["offset"] = np.array(offset, "int64")
        return pdf.drop(columns="shard")
    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): tokenized documents, each followed by END_ID, cut to at most ``length``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer or vocabulary(), length), COLUMNS)


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Each piece of docs(doc_id, text, ...) with its sequence_id and its offset there.

    Only documents longer than ``length`` are cut.  Pieces are dealt by a hash
    over shards of about ``shard_pieces``; a shard opens sequences by best-fit
    decreasing, so a full piece has one of its own.  Only piece lengths are
    shuffled, never tokens.  Shards are dealt by document and piece, so neither
    a source nor a long document gathers in one.

    Null or empty text is the END_ID alone.  Repeated rows are packed each;
    null doc_ids are rows like others.  Other columns are ignored; an empty
    table gives no rows.
    """
    cut_ = stored(pieces(docs, tokenizer, length), "pieces")
    shards = cut_.count() // shard_pieces + 1
    # the crc deals repeated rows alike, so they are spread by their place among the equal ones
    place = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()) if shards > 1 else F.lit(0).cast("long")
    dealt = cut_.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(
        _pack(length), COLUMNS + ", sequence_id long, offset long")
