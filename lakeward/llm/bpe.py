"""Operator 9: byte-level BPE encoding and decoding with batched numpy merge rounds.

Spark deals the rows; each Arrow batch is split into pre-tokenizer words, the
distinct words not met before in this task become one flat symbol array, and
merge rounds run over all of them at once: the rank of every adjacent pair comes
from one binary search over the sorted pair keys, each word merges its lowest
ranked pair, finished words leave the array. Memory is bounded by one Arrow batch
of texts and by ``CACHE_WORDS``.

Defined results: null text is the empty text (no ids); empty text gives no ids;
any text length is encoded whole; repeated rows give repeated results; extra
columns are ignored by the query and kept by ``encode_frame``. A bad id raises.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.llm.common import read_table

VOCAB_FILE = "byte_bpe_50k.json"
# Pre-tokenizer pattern of the vocabulary (fixed value of the file's ByteLevel step).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 400_000
NO_RANK = np.iinfo(np.int64).max
SHIFT = 32


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 upwards in byte order.
    """
    plain = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, spare = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class ByteBpe:
    """Merge table and token bytes of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = (left << SHIFT) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = made  # by rank
        symbols = byte_symbols()
        to_byte = {c: i for i, c in enumerate(symbols)}
        self.byte_id = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            token_bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            token_bytes[i] = token.encode()
        self.token_len = np.array([len(b) for b in token_bytes], dtype=np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)])[:-1]
        self.flat_bytes = np.frombuffer(b"".join(token_bytes), dtype=np.uint8)
        self.pattern = regex.compile(PATTERN)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_pattern = regex.compile(f"({marks})") if marks else None
        self.reset()

    def reset(self) -> None:
        self.seen: dict[str, int] = {}
        self.cached_ids: list[np.ndarray] = []
        for token, i in self.special.items():
            self.seen[token] = len(self.cached_ids)
            self.cached_ids.append(np.array([i], dtype=np.uint32))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokenizer words; strings of special tokens are words of their own."""
        if self.special_pattern is None:
            return self.pattern.findall(text)
        out: list[str] = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self.pattern.findall(part))
        return out

    def pair_ranks(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each position (none: NO_RANK)."""
        rank = np.full(len(sym), NO_RANK, dtype=np.int64)
        if len(sym) > 1:
            key = (sym[:-1] << SHIFT) | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
        return rank

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, all words merged together round by round."""
        raw = [w.encode() for w in words]
        size = np.array([len(b) for b in raw], dtype=np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(raw), dtype=np.int64), size)
        done: list[np.ndarray] = [np.empty(0, np.uint32)] * len(raw)
        while len(sym):
            rank = self.pair_ranks(sym, word)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.r_[first, len(sym)])
            if (lowest == NO_RANK).any():
                for k in np.flatnonzero(lowest == NO_RANK):
                    done[word[first[k]]] = sym[first[k]:first[k] + count[k]].astype(np.uint32)
                live = np.repeat(lowest != NO_RANK, count)
                rank, sym, word = rank[live], sym[live], word[live]
                count, lowest = count[lowest != NO_RANK], lowest[lowest != NO_RANK]
                if not len(sym):
                    break
            take = rank == np.repeat(lowest, count)
            at = np.flatnonzero(take)
            # In a run of overlapping pairs (aaa...) every second one merges, from the left.
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[offset % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        return done

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.seen) > CACHE_WORDS:
            self.reset()
        split = [self.pieces(t) for t in texts]
        new = list({w: None for ws in split for w in ws if w not in self.seen})
        for w, ids in zip(new, self.merge_words(new)):
            self.seen[w] = len(self.cached_ids)
            self.cached_ids.append(ids)
        out = []
        for ws in split:
            got = [self.cached_ids[i] for i in map(self.seen.__getitem__, ws)]
            out.append(np.concatenate(got) if got else np.empty(0, np.uint32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        size = self.token_len[ids]
        start = np.cumsum(size) - size
        where = np.repeat(self.token_at[ids] - start, size) + np.arange(int(size.sum()))
        return self.flat_bytes[where].tobytes().decode("utf-8", errors="replace")


_LOADED: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def default_vocab() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCAB_FILE)


def _slices(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``chars`` characters (or one row)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_frame(df: DataFrame, text_col: str = "text", vocab: str | None = None,
                 ids_col: str = "token_ids") -> DataFrame:
    """``df`` with an ``array<int>`` column of token ids."""
    path = vocab or default_vocab()
    schema = T.StructType([f for f in df.schema.fields if f.name != ids_col]
                          + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for pdf in batches:
            texts = pdf[text_col].fillna("").tolist()
            for a, b in _slices(texts):
                part = pdf.iloc[a:b].copy()
                part[ids_col] = [x.astype(np.int32) for x in bpe.encode_batch(texts[a:b])]
                yield part

    return df.drop(ids_col).mapInPandas(run, schema)


def encode_digests(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """Per document: token count, digest of the ids, digest of the decoded text.

    Encoding and decoding are the calls behind ``encode_frame``; the ids
    themselves stay in the task, only their digests are returned.
    """
    path = vocab or default_vocab()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            doc_ids = pdf["doc_id"]
            for a, b in _slices(texts):
                ids = bpe.encode_batch(texts[a:b])
                yield pd.DataFrame({
                    "doc_id": doc_ids.iloc[a:b],
                    "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest()
                                   for x in ids],
                    "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest()
                                       for x in ids]})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id"), F.col("text")).mapInPandas(
        run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))
