"""Alignment of two tokenizers' tokens by their bytes.

A byte-level vocabulary (A) reads a space and the text, a piece vocabulary (B) the text, before which it puts a space
itself; so both cover the same bytes. The documents of a batch lie one behind the other, and `pandas.merge_asof`, keyed
by document, finds for each token's start the other side's token that covers it. Two tokens overlap where one starts
inside the other, so both directions together give every link, and offsets where tokens of both sides end cut groups.

How often a pair of ids is linked in the whole corpus is counted per chunk, summed by Spark, and joined back per chunk:
a chunk's documents hold their links as numbers of the chunk's pairs, so no link travels by itself.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from waymeter.llm.bpe import FragmentEncoder, byte_of
from waymeter.llm.fragments import Remembered, numbers, ranges
from waymeter.llm.shared import packed, text_slices, unpacked, worker_state, written

#: Characters of a chunk's texts and pairs that it may know before it ends; entries of one row of its dictionary.
CHUNK, PAIRS, ENTRIES = 32 << 20, 1 << 20, 1 << 16
_SPACE = "▁"


class PieceEncoder:
    """Ids of a sentencepiece BPE model by forced boundaries: no piece has a space behind another character, so a
    space after one is a certain cut. Every fragment begins with a space, which the model adds itself."""

    def __init__(self, model: str):
        self.model = SentencePieceProcessor(model_file=model)
        size = self.model.vocab_size()
        self.pieces = [self.model.id_to_piece(k) for k in range(size)]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in self.pieces)
        self.known = Remembered(self._ids)
        self.space = np.array([self.model.piece_to_id(_SPACE)], "<u4").tobytes()

    def _ids(self, fragments: list[bytes]) -> list[bytes]:
        made = self.model.encode([f[1:].decode() for f in fragments], num_threads=1)
        # The model adds no space to nothing.
        return [self.space if f == b" " else struct.pack(f"<{len(ids)}I", *ids) for f, ids in zip(fragments, made)]

    def token_bytes(self) -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(_SPACE, " ").encode()
            for k, p in enumerate(self.pieces)
        ]

    def encode_many(self, buffer: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts buffer[bounds[k]:bounds[k + 1]], each behind its space, and how many each text has."""
        whole = np.frombuffer(buffer, np.uint8)
        cut = np.zeros(whole.size, bool)
        if self.cuts:
            cut[1:] = (whole[1:] == 0x20) & (whole[:-1] != 0x20)
        cut[bounds[:-1]] = True
        starts = np.flatnonzero(cut)
        ids, counts = numbers(buffer, starts, np.r_[starts[1:], whole.size], self.known)
        upto = np.r_[0, np.cumsum(counts)]
        return ids, np.diff(upto[np.searchsorted(starts, bounds)])


class _Table:
    """The bytes and decimal digits of every id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        digits = [str(k).encode() for k in range(self.size)]
        self.width = max(map(len, digits))
        self.n_digits = np.array([len(d) for d in digits], np.int64)
        self.digits = np.frombuffer(b"".join(d.ljust(self.width + 1) for d in digits), np.uint8).reshape(self.size, -1)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.offsets[ids], self.lengths[ids])]


class Pair:
    """Both vocabularies: A a byte-level file of the tokenizers library, B a sentencepiece model."""

    def __init__(self, byte_level: str, pieces: str):
        self.encoder, self.other = FragmentEncoder(byte_level, plain=True), PieceEncoder(pieces)
        tokenizer = self.encoder.tokenizer
        units = byte_of()
        names = (tokenizer.id_to_token(k) or "" for k in range(tokenizer.get_vocab_size(with_added_tokens=True)))
        self.a = _Table([bytes(units[c] for c in t) if all(c in units for c in t) else t.encode() for t in names])
        self.b = _Table(self.other.token_bytes())

    def aligned(self, texts: list[str | None]) -> Aligned:
        """The texts' tokens; those that either side spells otherwise have none."""
        used = np.array([k for k, t in enumerate(texts) if t], np.int64)
        while True:
            spelled = [" " + texts[k] for k in used]
            parts = [t.encode() for t in spelled]
            buffer, bounds = b"".join(parts), np.cumsum([0, *map(len, parts)])
            if not parts:
                nothing = np.empty(0, np.int64)
                return Aligned(self, len(texts), used, bounds, nothing, nothing, nothing, nothing)
            a, n_a = self.encoder.encode_many(spelled)
            b, n_b = self.other.encode_many(buffer, bounds)
            good = self._spells(self.a, a, n_a, buffer, bounds) & self._spells(self.b, b, n_b, buffer, bounds)
            if good.all():
                return Aligned(self, len(texts), used, bounds, a.astype(np.int64), n_a, b.astype(np.int64), n_b)
            used = used[good]

    def _spells(self, table: _Table, ids: np.ndarray, counts: np.ndarray, buffer: bytes, bounds: np.ndarray) -> np.ndarray:
        """Of each text whether its tokens' bytes are its own."""
        upto = np.r_[0, np.cumsum(table.lengths[ids])][np.r_[0, np.cumsum(counts)]]
        sizes, good = np.diff(bounds), np.diff(upto) == np.diff(bounds)
        made, whole = table.spelled(ids), np.frombuffer(buffer, np.uint8)
        if good.all():
            return np.logical_and.reduceat(made == whole, bounds[:-1])
        return np.array([ok and bool((made[u:u + n] == whole[s:s + n]).all())
                         for ok, u, n, s in zip(good, upto[:-1], sizes, bounds[:-1])])


@dataclass
class Aligned:
    """Tokens of both sides of the texts `used`, which lie one behind the other in `bounds`; `count` texts in all."""

    pair: Pair
    count: int
    used: np.ndarray
    bounds: np.ndarray
    a: np.ndarray
    n_a: np.ndarray
    b: np.ndarray
    n_b: np.ndarray

    @cached_property
    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.pair.a.lengths[self.a]), np.cumsum(self.pair.b.lengths[self.b])

    @cached_property
    def docs(self) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(self.used.size), self.n_a), np.repeat(np.arange(self.used.size), self.n_b)

    @cached_property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the A and B tokens of every overlapping pair, in order of their documents and offsets."""
        frames = [
            pd.DataFrame({"doc": doc, "start": end - table.lengths[ids], "token": np.arange(ids.size)})
            for doc, end, table, ids in zip(self.docs, self.ends, (self.pair.a, self.pair.b), (self.a, self.b))
        ]
        if not self.used.size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        covers_a, covers_b = (pd.merge_asof(x, y, on="start", by="doc", suffixes=("", "_over")) for x, y in (frames, frames[::-1]))
        # A pair that starts together is found from both sides.
        begun = np.zeros(int(self.bounds[-1]), bool)
        begun[frames[0]["start"].to_numpy()] = True
        only_b = ~begun[frames[1]["start"].to_numpy()]
        i = np.r_[covers_a["token"].to_numpy(), covers_b["token_over"].to_numpy()[only_b]]
        j = np.r_[covers_a["token_over"].to_numpy(), covers_b["token"].to_numpy()[only_b]]
        order = np.argsort(i, kind="stable")  # both halves ascend, and of one A token the first starts first
        return i[order], j[order]

    @cached_property
    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every token whether a group ends with it."""
        mark = np.zeros(int(self.bounds[-1]) + 1, np.uint8)
        mark[self.ends[0]] |= 1
        mark[self.ends[1]] |= 2
        return mark[self.ends[0]] == 3, mark[self.ends[1]] == 3

    def group_counts(self) -> np.ndarray:
        return np.bincount(self.docs[0][self.last[0]], minlength=self.used.size)

    def group_texts(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each used text: ids of both sides, group by group."""
        last_a, last_b = self.last
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        place_a = np.arange(self.a.size) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(self.b.size) + np.cumsum(in_a)[group_b]
        width = max(self.pair.a.width, self.pair.b.width) + 1
        rows, sizes = np.zeros((self.a.size + self.b.size, width), np.uint8), np.zeros(self.a.size + self.b.size, np.int64)
        for table, ids, place, last, mark in ((self.pair.a, self.a, place_a, last_a, b"|"), (self.pair.b, self.b, place_b, last_b, b";")):
            spelled, digits = table.digits[ids], table.n_digits[ids]
            spelled[np.arange(ids.size), digits] = np.where(last, mark[0], ord(","))
            rows[place, : spelled.shape[1]] = spelled
            sizes[place] = digits + 1
        flat = rows[np.arange(width) < sizes[:, None]].tobytes()
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(self.n_a + self.n_b)].tolist()
        return [flat[i:j - 1] for i, j in zip([0, *ends], ends)]


def _pair(byte_level: str, pieces: str) -> Pair:
    return worker_state(("alignment", byte_level, pieces), lambda: Pair(byte_level, pieces))


class _Chunk:
    """Pairs of ids by the order in which a chunk meets them, and how often."""

    def __init__(self, number: int):
        self.number, self.characters = number, 0
        self.codes, self.sorted, self.place = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def add(self, codes: np.ndarray) -> np.ndarray:
        """The numbers of these pairs."""
        found, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.sorted, found)
        known = np.zeros(found.size, bool)
        inside = at < self.sorted.size
        known[inside] = self.sorted[at[inside]] == found[inside]
        number = np.empty(found.size, np.int64)
        number[known] = self.place[at[known]]
        number[~known] = self.codes.size + np.arange((~known).sum())
        self.codes = np.r_[self.codes, found[~known]]
        self.counts = np.r_[self.counts, np.zeros((~known).sum(), np.int64)]
        self.counts[number] += counts
        self.place = np.argsort(self.codes)
        self.sorted = self.codes[self.place]
        return number[inverse]


_CHUNKED = "chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, begin long, codes array<long>, counts array<long>"


def _chunked(docs: DataFrame, byte_level: str, pieces: str, with_groups: bool) -> DataFrame:
    """A row per text, its links as numbers of its chunk's pairs, and rows of each chunk's pairs and their counts."""
    key = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("doc_id", key.dataType)])
    schema = T.StructType(schema.fields + T.StructType.fromDDL(_CHUNKED).fields)
    if with_groups:
        schema = schema.add("groups", "string")
    arrow = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                       ("groups_sha256", pa.string()), ("links", pa.binary())])

    def texts(ids: pa.Array, aligned: Aligned, chunk: _Chunk) -> pa.RecordBatch:
        n = aligned.count
        i, j = aligned.links
        links = chunk.add(aligned.a[i] * aligned.pair.b.size + aligned.b[j])
        per_doc = np.bincount(aligned.docs[0][i], minlength=aligned.used.size)
        ends = np.cumsum(per_doc).tolist()
        written_, spelled = [None] * n, [""] * n
        groups = aligned.group_texts()
        for k, at, end, group in zip(aligned.used.tolist(), [0, *ends], ends, groups):
            written_[k], spelled[k] = packed(links[at:end]), group
        numbers_ = np.zeros((4, n), np.int64)
        numbers_[:, aligned.used] = aligned.n_a, aligned.n_b, aligned.group_counts(), per_doc
        digests = [hashlib.sha256(g).hexdigest() if g else "" for g in spelled]
        columns = [ids, pa.array([chunk.number] * n, pa.int64()), *(pa.array(c) for c in numbers_), pa.array(digests, pa.string()),
                   pa.array(written_, pa.binary()), *(pa.nulls(n, t) for t in (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
        if with_groups:
            columns.append(pa.array([g.decode() if g else "" for g in spelled], pa.string()))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def pairs(chunk: _Chunk, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        for at in range(0, chunk.codes.size, ENTRIES):
            row = {"chunk": chunk.number, "begin": at, "codes": chunk.codes[at:at + ENTRIES], "counts": chunk.counts[at:at + ENTRIES]}
            types = [kind, pa.int64(), *arrow.types, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.string()] * with_groups]
            yield pa.RecordBatch.from_arrays([pa.array([row.get(name)], t) for name, t in zip(schema.names, types)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(byte_level, pieces)
        base, number, kind = TaskContext.get().partitionId() << 32, 0, pa.null()
        chunk = _Chunk(base)
        for batch in text_slices(batches):
            kind, bodies = batch.column(0).type, batch.column(1).to_pylist()
            yield texts(batch.column(0), pair.aligned(bodies), chunk)
            chunk.characters += sum(len(t or "") for t in bodies)
            if chunk.characters >= CHUNK or chunk.codes.size >= PAIRS:
                yield from pairs(chunk, kind)
                number += 1
                chunk = _Chunk(base + number)
        yield from pairs(chunk, kind)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def pair_counts(dictionary: DataFrame, size_b: int) -> DataFrame:
    """code, count, best: of every pair of ids its links in the corpus, and whether its B id has no pair with more."""
    totals = dictionary.groupBy("code").agg(F.sum("n").alias("count"))
    totals = written(totals.withColumn("b", F.col("code") % size_b), "pair-counts")
    # One row per id of B at most.
    highest = F.broadcast(totals.groupBy("b").agg(F.max("count").alias("highest")))
    return totals.join(highest, "b").select("code", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, byte_level: str, pieces: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups, if `with_groups`) per row.

    groups spells the ids of both sides, `a1,a2|b1;a3|b2,b3`, its digest is of that text. n_best counts links whose
    pair of ids is linked as often as any pair of its B id in the corpus, count_sum adds every link's count. Strings of
    special tokens are plain text. Null and empty texts, and texts that either side's tokens do not spell byte by byte,
    have no tokens: zeros, and an empty text in place of the digest. Repeated rows count as often as they stand there;
    null doc_ids stay; other columns are not read; an empty table gives no rows.
    """
    rows = written(_chunked(docs, byte_level, pieces, with_groups), "aligned")
    entries = F.posexplode(F.arrays_zip(F.col("codes").alias("code"), F.col("counts").alias("n"))).alias("at", "entry")
    dictionary = rows.where("codes IS NOT NULL").select("chunk", "begin", entries).select(
        "chunk", (F.col("begin") + F.col("at")).alias("at"), "entry.code", "entry.n")
    size_b = SentencePieceProcessor(model_file=pieces).vocab_size()
    known = dictionary.select("chunk", "at", "code").join(pair_counts(dictionary, size_b), "code").select("chunk", "at", "count", "best")
    texts = rows.where("codes IS NULL").drop("begin", "codes", "counts")
    schema = T.StructType([f for f in texts.schema.fields if f.name not in ("chunk", "links")]).add("n_best", "long").add("count_sum", "long")

    def score(key, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        at = theirs["at"].to_numpy()
        count, best = np.zeros(at.size, np.int64), np.zeros(at.size, bool)
        count[at], best[at] = theirs["count"].to_numpy(), theirs["best"].to_numpy(zero_copy_only=False)
        sums = [(0, 0) if n is None else (int(best[n].sum()), int(count[n].sum())) for n in (None if x is None else unpacked(x).astype(np.int64) for x in (v.as_py() for v in mine["links"]))]
        for name, k in (("n_best", 0), ("count_sum", 1)):
            mine = mine.append_column(name, pa.array([s[k] for s in sums], pa.int64()))
        return mine.select(schema.names)

    known = known.withColumnRenamed("chunk", "of")
    found = texts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(score, schema)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return found.select(*columns, *["groups"] * with_groups)


def overlaps(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, a_at, b_at, a_id, b_id, begin, end: every link of every text, its tokens' numbers in the text and the
    bytes they share (of a space and the text). A map over the rows; texts as for `alignment`."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    schema = T.StructType(schema.fields + T.StructType.fromDDL("a_at long, b_at long, a_id long, b_id long, begin long, end long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(byte_level, pieces)
        for batch in text_slices(batches):
            found = pair.aligned(batch.column(1).to_pylist())
            i, j = found.links
            doc = found.docs[0][i]
            a, b = ((np.cumsum(n) - n)[doc] for n in (found.n_a, found.n_b))
            base = found.bounds[:-1][doc]
            begin = np.maximum(found.ends[0][i] - pair.a.lengths[found.a[i]], found.ends[1][j] - pair.b.lengths[found.b[j]])
            numbers_ = (i - a, j - b, found.a[i], found.b[j], begin - base, np.minimum(found.ends[0][i], found.ends[1][j]) - base)
            rows = batch.column(0).take(pa.array(found.used[doc]))
            yield pa.RecordBatch.from_arrays([rows, *map(pa.array, numbers_)], schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
