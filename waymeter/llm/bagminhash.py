"""Near-duplicate documents by BagMinHash signatures, bands and exact multiset overlap.

A document is the multiset of its shingles of five words; two are linked if the overlap of their multisets, the
sum of the lesser over the sum of the greater multiplicities, is at least 0.8. BagMinHash gives every shingle a
Poisson process of points in time over its weight, kept in dyadic blocks of weight levels: a shingle of weight w
owns the points below w, whatever block they lie in, so two documents share exactly the points of the weight
that they share. Each register keeps its earliest point; equal registers are an unbiased estimate of the overlap.

Documents with equal registers in a band meet in a bucket. In a bucket every member is compared with one centre,
and components that remain apart with another: a large group of copies costs a comparison or two for each. What
is still apart is compared exactly, block by block, so no link between members of a bucket is lost, and no row
is made for a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm.components import components
from waymeter.llm.shared import slices, worker_state, written
from waymeter.llm.words import mixed, portions, word_hashes

SHINGLE = 5
REGISTERS, ROWS = 80, 4
#: An overlap of NEAR_PARTS / NEAR_WHOLE or more is a link.
NEAR_PARTS, NEAR_WHOLE = 4, 5
CENTRES = 2
#: Classes and shingles of a block, of which two meet in a task.
BLOCK, ELEMENTS = 512, 400_000

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct shingles' hashes, ascending, and how often each occurs.

    A text of fewer than SHINGLE words, but one at least, is one shingle; one without words has none.
    """
    words, counts = word_hashes(texts, lower=True)
    rolled = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        rolled = mixed(rolled * _U(3) + np.r_[words[k:], np.zeros(min(k, len(words)), np.uint64)])
    out, at = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(rolled[at:at + n - SHINGLE + 1], return_counts=True))
        elif n:
            whole = np.uint64(n)
            for w in words[at:at + n]:
                whole = mixed(np.array([whole], np.uint64) + w)[0]
            out.append((np.array([whole]), np.array([1])))
        else:
            out.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
        at += n
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """[document, register]: the time of the earliest point, infinite for a document without shingles.

    All processes of all documents advance one point at a time together; one ends when its next point comes
    after the latest register of its document.
    """
    sizes = [len(s[0]) for s in sets]
    best = np.full((len(sets), registers), np.inf)
    if not sum(sizes):
        return best
    element = np.concatenate([s[0] for s in sets])
    weight = np.concatenate([s[1] for s in sets]).astype(np.float64)
    doc = np.repeat(np.arange(len(sets)), sizes)
    # Block 0 is [0, 1), block k is [2^(k-1), 2^k): a shingle has those that begin below its weight.
    streams, low, width = [np.arange(len(element))], [np.zeros(len(element))], [np.ones(len(element))]
    block, begin = 1, 1.0
    while True:
        has = np.flatnonzero(weight > begin)
        if not len(has):
            break
        streams.append(has)
        low.append(np.full(len(has), begin))
        width.append(np.full(len(has), begin))
        block, begin = block + 1, begin * 2
    of = np.concatenate(streams)
    low, width = np.concatenate(low), np.concatenate(width)
    state = mixed(element[of] ^ mixed(low.astype(np.uint64) + _STEP))
    weight, doc = weight[of], doc[of]
    time = np.zeros(len(of))
    flat, latest = best.reshape(-1), np.full(len(sets), np.inf)
    while len(state):
        state = mixed(state + _STEP)
        time = time - np.log(((state >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
        going = np.flatnonzero(time <= latest[doc])
        state, time, low, width, weight, doc = (a[going] for a in (state, time, low, width, weight, doc))
        if not len(state):
            break
        other = mixed(state ^ _U(0x2545F4914F6CDD1D))
        register = ((other >> _U(32)) * _U(registers)) >> _U(32)
        level = low + width * ((other & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32)
        own = np.flatnonzero(level < weight)
        np.minimum.at(flat, doc[own] * registers + register[own].astype(np.int64), time[own])
        touched = np.unique(doc)
        latest[touched] = best[touched].max(1)
    return best


def band_hashes(best: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """[document, band]: a hash of the band's number and registers."""
    bits = np.ascontiguousarray(best).view(np.uint64).reshape(len(best), -1, rows)
    h = np.tile(np.arange(1, bits.shape[1] + 1, dtype=np.uint64), (len(best), 1))
    for k in range(rows):
        h = mixed(h * _U(3) + bits[:, :, k])
    return h.view(np.int64)


def digest(shingles: np.ndarray, counts: np.ndarray) -> bytes:
    return hashlib.sha256(shingles.tobytes() + counts.astype("<u8").tobytes()).digest()[:16]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, class (digest of the multiset; null without words or id), bands, key of rows (doc_id, text, key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("bagminhash", object)
        for batch in slices(batches):
            texts, ids = batch.column(1).to_pylist(), batch.column(0)
            for a, b in portions(texts, 1 << 20):
                sets = shingle_sets(texts[a:b])
                bands = band_hashes(signatures(sets))
                valid = ids[a:b].is_valid().to_pylist()
                yield pa.RecordBatch.from_arrays([
                    ids[a:b],
                    pa.array([digest(*s) if v and len(s[0]) else None for s, v in zip(sets, valid)], pa.binary()),
                    pa.array(list(bands), pa.list_(pa.int64())), batch.column(2)[a:b],
                ], ["doc_id", "class", "bands", "key"])

    return docs.mapInArrow(run, "doc_id long, class binary, bands array<long>, key string")


def elements(docs: DataFrame) -> DataFrame:
    """class, shingles, times (arrays as bytes) of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(0).to_pylist()
            for a, b in portions(texts):
                sets = shingle_sets(texts[a:b])
                yield pa.RecordBatch.from_arrays([
                    pa.array([digest(*s) for s in sets], pa.binary()),
                    pa.array([s[0].tobytes() for s in sets], pa.binary()),
                    pa.array([s[1].astype("<u4").tobytes() for s in sets], pa.binary()),
                ], ["class", "shingles", "times"])

    return docs.mapInArrow(run, "class binary, shingles binary, times binary")


def overlap(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[int, int]:
    """Sums of the lesser and of the greater multiplicities."""
    (x, m), (y, n) = ((np.frombuffer(s, np.uint64), np.frombuffer(t, "<u4").astype(np.int64)) for s, t in (a, b))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(m[i], n[j]).sum())
    return least, int(m.sum() + n.sum()) - least


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose multisets overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            keep = []
            for k, (sa, ta, sb, tb) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)))):
                least, most = overlap((sa, ta), (sb, tb))
                if NEAR_WHOLE * least >= NEAR_PARTS * most:
                    keep.append(k)
            rows = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    side = lambda end: sets.select(
        F.col("class").alias(end), F.col("shingles").alias(f"s{end}"), F.col("times").alias(f"t{end}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "ta", "sb", "tb").mapInArrow(
        run, "a binary, b binary")


def _centred(members: DataFrame, labels: DataFrame, attempt: int) -> DataFrame:
    """Pairs (a, b), a < b, of a bucket's centre and each member in another component; centres differ by attempt."""
    of = members.join(labels, "class", "left").withColumn("part", F.coalesce("part", "class"))
    apart = of.groupBy("bucket").agg(
        F.min("part").alias("low"), F.max("part").alias("high"),
        F.min_by(F.struct(F.col("class").alias("centre"), F.col("part").alias("centre_part")), F.struct(F.xxhash64("class", F.lit(attempt)), "class")).alias("c"),
    ).where("low <> high").select("bucket", "c.*")
    pairs = of.join(apart, "bucket").where("part <> centre_part")
    return pairs.select(F.least("centre", "class").alias("a"), F.greatest("centre", "class").alias("b")).distinct()


def links_between(classes: list[bytes], parts: list[bytes], sets: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Links that join the classes of different parts into components, one per class at most, from the exact
    overlaps of all pairs. Each occurrence of a shingle is an element of its own, so overlaps are those of sets;
    they are summed as products of indicator columns, some thousand at a time."""
    keys, rows, sizes = [], [], np.zeros(len(sets), np.int64)
    for k, (shingles, times) in enumerate(sets):
        found, often = np.frombuffer(shingles, np.uint64), np.frombuffer(times, "<u4").astype(np.int64)
        number = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often)
        keys.append(mixed(np.repeat(found, often) + number.astype(np.uint64) * _STEP))
        rows.append(np.full(len(number), k))
        sizes[k] = len(number)
    _, column, often = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    row = np.concatenate(rows)
    shared = often[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.searchsorted(np.unique(column), column[order])
    both = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        first, last = np.searchsorted(column, [at, at + 4096])
        block = np.zeros((len(sets), 4096), np.float32)
        block[row[first:last], column[first:last] - at] = 1
        used = np.flatnonzero(block.any(1))
        both[np.ix_(used, used)] += block[used] @ block[used].T
    near = NEAR_WHOLE * both >= NEAR_PARTS * (sizes[:, None] + sizes[None] - both)
    top = {p: p for p in parts}

    def root(p: bytes) -> bytes:
        while top[p] != p:
            top[p] = top[top[p]]
            p = top[p]
        return p

    out = []
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        p, q = root(parts[i]), root(parts[j])
        if p != q:
            top[max(p, q)] = min(p, q)
            out.append((classes[i], classes[j]))
    return out


def _rest(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that centres left apart: exact, and without a row per pair.

    Of each bucket whose classes lie in several components, those of BLOCK classes or more are cut into blocks of
    their own, the others are pooled; blocks hold at most about BLOCK classes and ELEMENTS shingles. Each pair of
    blocks of a bucket is one task, but for two of one component; it gets both blocks' multisets and returns links
    that join components, fewer than it has classes. Only classes that share a bucket meet: buckets that chains of
    weak candidates join are never compared with each other. Two classes may meet in several buckets of unlike members.
    """
    of = members.join(labels, "class", "left").withColumn("part", F.coalesce("part", "class"))
    # Classes that agree in several bands meet in as many buckets: of those with the same members one is enough, told
    # by their number and two sums of hashes of 64 bits.
    total = lambda seed: F.sum(F.xxhash64("class", F.lit(seed)).cast("decimal(38,0)"))
    apart = of.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"), total(1).alias("s"), total(2).alias("t"))
    apart = apart.where("low <> high").groupBy("n", "s", "t").agg(F.min("bucket").alias("bucket")).select("bucket")
    of = written(of.join(apart, "bucket").join(
        sets.select("class", (F.octet_length("shingles") / 8).cast("long").alias("size")), "class"), "apart")
    parts = of.groupBy("bucket", "part").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    pool = F.when(F.col("n") >= BLOCK, F.col("part"))
    pools = parts.groupBy("bucket", pool.alias("pool")).agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    cuts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / ELEMENTS)).cast("int")
    pools = written(pools.select("bucket", "pool", cuts.alias("cuts")), "pools")
    placed = of.join(parts.select("bucket", "part", pool.alias("pool")), ["bucket", "part"])
    same = (placed["bucket"] == pools["bucket"]) & placed["pool"].eqNullSafe(pools["pool"])
    placed = placed.join(pools, same).select(
        placed["bucket"], "class", "part", F.struct(placed["pool"], F.pmod(F.xxhash64("class"), "cuts").alias("cut")).alias("block"))
    placed = written(placed, "blocks")
    blocks = pools.select("bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.struct("pool", k.cast("long").alias("cut")))).alias("block"))
    meets = blocks.join(blocks.select("bucket", F.col("block").alias("other")), "bucket").where(
        "block <= other AND NOT (block.pool <=> other.pool AND block.pool IS NOT NULL)")
    meets = written(meets, "meetings")
    ends = meets.select("bucket", "block", "other", F.explode(F.array_distinct(F.array("block", "other"))).alias("mine"))
    mine = placed.withColumnRenamed("block", "mine").withColumn("pool", F.coalesce(F.col("mine.pool"), F.lit(b""))).withColumn("cut", F.col("mine.cut")).drop("mine")
    ends = ends.withColumn("pool", F.coalesce(F.col("mine.pool"), F.lit(b""))).withColumn("cut", F.col("mine.cut")).drop("mine")
    rows = ends.join(mine, ["bucket", "pool", "cut"]).select(
        "class", "part", F.sha2(F.to_json(F.struct("bucket", "block", "other")), 256).alias("task"))
    rows = rows.join(sets, "class")

    def compare(group: pa.Table) -> pa.Table:
        found = links_between(group["class"].to_pylist(), group["part"].to_pylist(), list(zip(group["shingles"].to_pylist(), group["times"].to_pylist())))
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    return rows.groupBy("task").applyInArrow(compare, "a binary, b binary")


def links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(class, part): every class that a link joins to another, and the least class of its component."""
    spark = classes.sparkSession
    banded = classes.select("class", F.explode("bands").alias("bucket"))
    # A bucket that holds one class only goes before anything else is done with it.
    shared = banded.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("bucket")
    members = written(banded.join(shared, "bucket").select("bucket", "class").distinct(), "bucket-members")
    wanted = members.select("class").distinct()
    involved = written(wanted.join(classes.select("class", "doc_id"), "class").select("doc_id").distinct(), "involved")
    texts = docs.join(involved, "doc_id", "left_semi").select("text")
    sets = written(elements(texts).dropDuplicates(["class"]).join(wanted, "class", "left_semi"), "multisets")
    nothing = spark.createDataFrame([], "a binary, b binary")
    tried, found = nothing, nothing
    labels = spark.createDataFrame([], "class binary, part binary")
    for attempt in range(CENTRES):
        pairs = _centred(members, labels, attempt)
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti") if attempt else pairs, "candidates")
        found = found.unionByName(written(verified(pairs, sets), "verified"))
        tried = tried.unionByName(pairs)
        labels = _labelled(found)
    return _labelled(found.unionByName(written(_rest(members, labels, sets), "verified")))


def _labelled(found: DataFrame) -> DataFrame:
    return written(components(found).select(F.col("node").alias("class"), F.col("component").alias("part")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept, one row per row: class_id is the least doc_id of the near-duplicate component.

    Words are runs of other than white space, in lower case for A-Z. Texts without words (null, empty) and rows
    without doc_id link with nothing; texts of fewer than five words link with equal ones only. Equal multisets
    are one class from the start, so copies are compared once. Repeated rows get the same answer each; several
    texts under one doc_id make that document a part of each text's class. Other columns are not read, an
    empty table gives no rows. kept is class_id = doc_id, true without an id.
    """
    return classified(docs).drop("key", "group")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and `key`, a digest by which rows of one text under one id are known."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text).alias("key"))


def classified(docs: DataFrame) -> DataFrame:
    """The rows of `near_duplicates`, with the `key` of each row's text and the `group` of its class, a class of it."""
    rows = _keyed(docs)
    sketches = written(sketched(rows), "bagminhash")
    classes = written(sketches.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands")), "bagminhash-classes")
    labels = links(classes, rows)
    joined = classes.select("class", "doc_id").join(labels, "class", "left").withColumn("part", F.coalesce("part", "class"))
    least = joined.groupBy("part").agg(F.min("doc_id").alias("class_id"))
    answer = joined.join(least, "part").select("class", "class_id", F.col("part").alias("group"))
    answer = sketches.select("doc_id", "class", "key").join(answer, "class", "left").select(
        "doc_id", "key", "group", F.coalesce("class_id", "doc_id").alias("class_id"))
    return answer.withColumn("kept", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)))


def kept(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id, with all columns of `docs`.

    Of several rows of that id in the group one stays: the first by digests of its text and of all its columns, so the
    answer does not hang on the order of rows. Rows of one id whose texts are in different groups may each stay; those
    of one id without words are one group. Rows without an id all stay.
    """
    stay = classified(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("stay"), F.col("key").alias("text_key"), "group")
    stay = written(stay.distinct(), "stay")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.md5(text).alias("key"),
                       F.xxhash64(*docs.columns).alias("place"))
    # Digests decide, so that a text moves once at most; only rows that repeat whole are told apart by themselves.
    names = rows.select("id", "key", "place").join(stay, (F.col("id") == F.col("stay")) & (F.col("key") == F.col("text_key")))
    first = names.groupBy("id", "group").agg(F.min(F.struct("key", "place")).alias("first"))
    chosen = first.select("id", "first.*").distinct()
    times = names.groupBy("id", "key", "place").agg(F.count("*").alias("times"))
    chosen = written(chosen.join(times, ["id", "key", "place"]), "chosen")
    found = rows.join(chosen, ["id", "key", "place"])
    repeated = found.where("times > 1").dropDuplicates(["id", "key", "place"])
    return found.where("times = 1").select("row.*").unionByName(repeated.select("row.*")).unionByName(rows.where("id IS NULL").select("row.*"))
