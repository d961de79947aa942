"""Byte-level BPE by speculation: greedy longest matches, checked pair by pair, merged exactly only where a check fails."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, map_in_arrow, relieve_executors, whole_text

#: The pattern that splits text before merging, as published with the vocabulary. Fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of a word from which on merging uses a heap.
LONG_WORD = 96

#: Stands for a pair that doesn't merge.
NONE = 1 << 62

#: Words whose tokens a task remembers before it lays them aside; of those laid aside before, it keeps what it met since.
#: Bounds the memory, not the result.
REMEMBERED = 200_000
#: The same for pairs of tokens, beyond which it starts afresh.
PAIRS_REMEMBERED = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabulary files: printable Latin-1 as itself, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and added tokens of a byte-level BPE file in the JSON form."""

    def __init__(self, spec: str) -> None:
        file = json.loads(spec)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(s): i for s, i in file["model"]["vocab"].items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in file["model"]["merges"]]
        self.merges = {(self.ids[as_bytes(a)], self.ids[as_bytes(b)]): (rank, self.ids[as_bytes(a) + as_bytes(b)]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        #: Rank and token as one number, which sorts like the rank.
        self.coded = {pair: rank << 32 | new for pair, (rank, new) in self.merges.items()}
        self.added = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        del file, pairs
        size = 1 + max(chain(self.ids.values(), self.added.values()))
        self.bytes: list[bytes] = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for s, i in self.added.items():
            self.bytes[i] = s.encode()
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        #: Only tokens that their own bytes merge into may be proposed.
        self.proposals = {b: i for b, i in self.ids.items() if self.merged(b) == (i,)}
        self.longest = max(map(len, self.proposals))
        self.split = regex.compile(SPLIT)
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def merged(self, word: bytes) -> tuple[int, ...]:
        """Exact merging: again and again the leftmost pair of the lowest rank."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > LONG_WORD:
            return self.merged_by_heap(ids)
        get = self.coded.get
        pairs = [get(pair, NONE) for pair in zip(ids, ids[1:])]
        while pairs and (least := min(pairs)) != NONE:
            k = pairs.index(least)
            new = least & 0xFFFFFFFF
            ids[k : k + 2] = [new]
            del pairs[k]
            if k:
                pairs[k - 1] = get((ids[k - 1], new), NONE)
            if k < len(pairs):
                pairs[k] = get((new, ids[k + 1]), NONE)
        return tuple(ids)

    def merged_by_heap(self, ids: list[int]) -> tuple[int, ...]:
        """The same for long words, in n log n: open pairs in a heap by rank and place, tokens in a linked list."""
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(*merges[pair], k, *pair) for k, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
        heap = [(rank, k, a, b, new) for rank, new, k, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k]
            if j < 0 or ids[k] != a or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[k], ids[j] = new, -1
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (found := merges.get((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (found[0], left, ids[left], ids[right], found[1]))
        return tuple(i for i in ids if i >= 0)

    def proposed(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        out, at, n, tokens = [], 0, len(word), self.proposals
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                if (i := tokens.get(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
        return out


class Encoder:
    """Encodes words in batches. Two tokens are compatible when merging their joined bytes gives the two again; a word
    whose adjacent pairs are all compatible is encoded by its proposal."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.known: dict[str, tuple[int, ...]] = {}
        self.aside: dict[str, tuple[int, ...]] = {}  # words known before, until they are met again
        self.pairs = np.zeros(0, np.uint64)  # sorted
        self.fits = np.zeros(0, bool)
        self.failed = self.speculated = 0

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """For each pair (left << 32 | right), looked up among the sorted known pairs; unknown ones are tried once."""
        unique, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.pairs, unique)
        seen = np.zeros(len(unique), bool) if not len(self.pairs) else self.pairs[np.minimum(at, len(self.pairs) - 1)] == unique
        if not seen.all():
            new = unique[~seen]
            text = self.v.bytes
            fits = np.fromiter((self.v.merged(text[p >> 32] + text[p & 0xFFFFFFFF]) == (p >> 32, p & 0xFFFFFFFF) for p in new.tolist()), bool, len(new))
            pairs_all = np.concatenate([self.pairs, new])
            order = np.argsort(pairs_all, kind="stable")
            self.pairs, self.fits = pairs_all[order], np.concatenate([self.fits, fits])[order]
        return self.fits[np.searchsorted(self.pairs, unique)][back]

    def learn(self, words: Iterable[str]) -> None:
        known, aside = self.known, self.aside
        words = [w for w in dict.fromkeys(words) if w not in known]
        if aside:
            known.update((w, aside[w]) for w in words if w in aside)
            words = [w for w in words if w not in known]
        if not words:
            return
        if len(self.pairs) > PAIRS_REMEMBERED:
            self.pairs, self.fits = self.pairs[:0], self.fits[:0]
        raw = [w.encode() for w in words]
        tokens = [self.v.proposed(b) for b in raw]
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter(chain.from_iterable(tokens), np.uint64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(tokens)), lengths)
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] << np.uint64(32) | flat[1:])[inside]
        bad = np.zeros(len(tokens), bool)
        if len(pairs):
            bad[owner[:-1][inside][~self.compatible(pairs)]] = True
        self.speculated += len(tokens)
        self.failed += int(bad.sum())
        for w, b, ids, wrong in zip(words, raw, tokens, bad.tolist()):
            known[w] = self.v.merged(b) if wrong else tuple(ids)

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, added tokens in the text as their own ids."""
        pieces = [self.pieces(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.aside = {}, self.known
        self.learn(chain.from_iterable(w for p in pieces for w, _ in p))
        known, out = self.known, []
        for p in pieces:
            ids: list[int] = []
            for words, then in p:
                ids.extend(chain.from_iterable(map(known.__getitem__, words)))
                if then is not None:
                    ids.append(then)
            out.append(ids)
        return out

    def forget(self) -> None:
        """Frees what a task has learned; the worker stays for other tasks."""
        self.known, self.aside = {}, {}
        self.pairs, self.fits = self.pairs[:0].copy(), self.fits[:0].copy()

    def pieces(self, text: str) -> list[tuple[list[str], int | None]]:
        """The words between added tokens, each with the added token behind it."""
        v = self.v
        if v.split_added is None or not any(s in text for s in v.added):
            return [(v.split.findall(text), None)]
        out, at = [], 0
        for m in v.split_added.finditer(text):
            out.append((v.split.findall(text[at : m.start()]), v.added[m[0]]))
            at = m.end()
        return [*out, (v.split.findall(text[at:]), None)]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the decoded text: those of the tokens, with U+FFFD where they aren't UTF-8."""
        raw = b"".join(map(self.v.bytes.__getitem__, ids))
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def encoder(spec_file: str) -> Encoder:
    with open(SparkFiles.get(spec_file), encoding="utf-8") as f:
        e = Encoder(Vocabulary(f.read()))
    give_back()
    return e


def ship(spark: SparkSession, path: str) -> str:
    """Sends the vocabulary file to the executors once and returns its name there."""
    relieve_executors(spark)
    spark.sparkContext.addFile(path)
    return path.replace("\\", "/").rsplit("/", 1)[-1]


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    values = batch.column(column)
    try:
        return values.to_pylist()
    except UnicodeDecodeError:  # bytes that aren't UTF-8 count as U+FFFD
        return [x.as_buffer().to_pybytes().decode("utf-8", "replace") for x in values]


def _parts(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of text (in column 1), which bound the memory."""
    ends = np.cumsum(np.asarray(pa.compute.binary_length(batch.column(1)).fill_null(0)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_column(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str | None = None) -> DataFrame:
    """docs with an array column of token ids, and if decoded_col is given the SHA-256 of what they decode to. Null text
    gives no tokens; columns of these names are replaced; null ids and repeated rows stay; an empty table stays empty."""
    name = ship(docs.sparkSession, path)
    added = [ids_col] + ([decoded_col] if decoded_col else [])
    docs = docs.drop(*added)
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest[:1]), whole_text(text_col).alias(text_col), *(F.col(f"`{c}`") for c in rest[1:])) if rest else docs.select(F.lit(0).alias("_"), whole_text(text_col).alias(text_col))
    schema = T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())), *([T.StructField(decoded_col, T.StringType())] if decoded_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for batch in batches:
            for part in _parts(batch):
                ids = e.encode_batch(_texts(part, 1))
                digests = [pa.array([hashlib.sha256(e.decode(x)).hexdigest() for x in ids], pa.string())] if decoded_col else []
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32())), *digests], names=schema.names)
        e.forget()

    return map_in_arrow(rows, run, schema).select(*docs.columns, *added)


def decode_column(df: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """df with the decoded text of an array column of token ids; null ids give null."""
    name = ship(df.sparkSession, path)
    df = df.drop(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(text_col, T.StringType())])
    at = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for batch in batches:
            texts = [None if x is None else e.decode(x).decode() for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return map_in_arrow(df, run, schema)


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes each whole text, decodes its ids and returns the digests of both.

    One row per row of docs; null text counts as empty (no ids, the digest of nothing), null ids stay null, extra
    columns are ignored. An empty table gives an empty result."""
    name = ship(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        digits = [str(i) for i in range(len(e.v.bytes))]
        for batch in batches:
            for part in _parts(batch):
                n, coded, decoded = [], [], []
                for ids in e.encode_batch(_texts(part, 1)):
                    n.append(len(ids))
                    coded.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(e.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        e.forget()

    return map_in_arrow(rows, run, DIGEST)
