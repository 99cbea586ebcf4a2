"""Near-duplicate vectors by a forest of random-projection trees with spill.

Every tree splits the unit vectors at the median of their projections on a random direction, again and again;
vectors near a cut go to both sides. A node that is narrow for the distance of linked vectors is not split: a large
group of near vectors stays one leaf, compared in pairs of blocks. Vectors are compared within leaves of all
trees, and links that the exact cosine confirms are united. Trees are fitted on a bounded sample; all vectors are
indexed and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm.components import components
from waymeter.llm.shared import slices, written
from waymeter.llm.words import mixed

BLOCK = 1024
#: Rows of a leaf that meet in one task, with themselves or with as many others, and rows of a batch sent there.
MEET, ROWS = 8192, 20_000
#: Vectors at the least cosine lie on any random direction at a mean square distance of their distance over the root
#: of the dimensions. Those within half of REACH times that of a cut go to both sides, however narrow a node is.
REACH = 1.25
#: A cut is taken at once if its larger child has GOOD of the node or less, the best of TRIES up to WORST.
TRIES, GOOD, WORST = 16, 0.65, 0.72


@dataclass(frozen=True)
class Forest:
    """`sample` bounds the vectors that the trees are fitted on and the driver holds; `leaf` is the number of
    vectors aimed at in a leaf, of the whole table; `spill` is the share of a node's vectors on each side of
    the cut that go to both sides, at least (see REACH). Where the sample is too small for such leaves, leaves grow in proportion
    to the table, and so does the time of a comparison: raise the sample then."""

    trees: int = 4
    leaf: int = 1024
    spill: float = 0.1
    sample: int = 50_000
    seed: int = 7


def unit_rows(data: list) -> tuple[list[np.ndarray], list[int]]:
    """Unit vectors in double precision, and the places of the rows that have one. Null, empty and zero vectors
    and those with null or non-finite components have none."""
    kept, vectors = [], []
    for k, values in enumerate(data):
        if values is None or len(values) == 0 or any(v is None for v in values):
            continue
        vector = np.asarray(values, np.float64)
        top = np.abs(vector).max()
        if not np.isfinite(top) or top == 0:
            continue
        vector = vector / top  # so that squares neither overflow nor vanish
        kept.append(k)
        vectors.append(vector / np.sqrt(vector @ vector))
    return vectors, kept


@dataclass
class Tree:
    """Nodes in arrays: direction, low and high cut, and both children; a negative child is leaf -1 - child."""

    directions: np.ndarray
    cuts: np.ndarray
    children: np.ndarray

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, leaf) of all leaves that each row belongs to."""
        if not len(self.cuts):
            return np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        done_rows, done_leaves = [], []
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            at = vectors[rows] @ self.directions[node]
            low, high = self.cuts[node]
            for child, part in zip(self.children[node], (rows[at <= high], rows[at >= low])):
                if not len(part):
                    continue
                if child < 0:
                    done_rows.append(part)
                    done_leaves.append(np.full(len(part), -1 - child))
                else:
                    todo.append((child, part))
        return np.concatenate(done_rows), np.concatenate(done_leaves)


def _cut(sample: np.ndarray, rows: np.ndarray, draw: np.random.Generator, forest: Forest, reach: float) -> tuple | None:
    """A direction with the low and high cut of a node, or None where every one tried leaves a child too large."""
    best = None
    for _ in range(TRIES):
        direction = draw.standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        at = np.sort(sample[rows] @ direction)
        for share in (0.5, 0.4, 0.6):
            low, middle, high = np.quantile(at, [share - forest.spill, share, share + forest.spill])
            low, high = min(low, middle - reach), max(high, middle + reach)
            largest = max(np.searchsorted(at, high, side="right"), len(at) - np.searchsorted(at, low))
            if best is None or largest < best[0]:
                best = largest, direction, low, high
            if best[0] <= GOOD * len(rows):
                return best[1:]
    return best[1:] if best[0] <= WORST * len(rows) else None


def fitted(sample: np.ndarray, forest: Forest, total: int, least: float = 0.9) -> list[Tree]:
    """The forest's trees: nodes are split until their share of the sample stands for `leaf` rows of `total`, or
    until they are so narrow that the vectors near a cut are most of them. Where one tree is a single leaf,
    all pairs are compared in it, and it is the only tree."""
    smallest = max(8, int(forest.leaf * len(sample) / max(1, total)))
    reach = np.sqrt(2 - 2 * least) * min(1.0, REACH / np.sqrt(sample.shape[1])) / 2
    trees = []
    for number in range(forest.trees):
        draw = np.random.default_rng([forest.seed, number])
        directions, cuts, children, leaf = [], [], [], 0
        todo = [(np.arange(len(sample)), None)]
        while todo:
            rows, parent = todo.pop()
            child = None
            if len(rows) > smallest and (cut := _cut(sample, rows, draw, forest, reach)):
                direction, low, high = cut
                at = sample[rows] @ direction
                child = len(cuts)
                directions.append(direction)
                cuts.append((low, high))
                children.append([0, 0])
                todo += [(rows[at <= high], (child, 0)), (rows[at >= low], (child, 1))]
            if child is None:
                child, leaf = -1 - leaf, leaf + 1
            if parent:
                children[parent[0]][parent[1]] = child
        tree = Tree(np.array(directions), np.array(cuts).reshape(-1, 2), np.array(children, np.int64).reshape(-1, 2))
        if not cuts:
            return [tree]
        trees.append(tree)
    return trees


def _seen_before(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """[i, j]: whether two rows have an earlier leaf in common, where they were counted."""
    shared = np.zeros((len(left), len(right)), bool)
    sides = [(np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes])) for codes in (left, right)]
    known = np.intersect1d(sides[0][0], sides[1][0])
    for at in range(0, len(known), 2048):
        some = known[at:at + 2048]
        members = []
        for (leaves, row), codes in zip(sides, (left, right)):
            place = np.minimum(np.searchsorted(some, leaves), len(some) - 1)
            hit = some[place] == leaves
            member = np.zeros((len(codes), len(some)), np.float32)
            member[row[hit], place[hit]] = 1
            members.append(member)
        shared |= (members[0] @ members[1].T) > 0
    return shared


def links_in_leaf(ids: np.ndarray, vectors: np.ndarray, codes: list[np.ndarray], leaf: int, least: float, sizes: np.ndarray, second: np.ndarray | None = None) -> pd.DataFrame:
    """Per row with a link in this leaf that no earlier leaf has: the number of such links (a row of size s counts
    s), and the least row of its component of them. As many rows come out as the leaf has, whatever the number of
    links. `codes` are the rows' leaves in ascending order. Where `second` is given, the rows that it
    marks are another block of the leaf, and only links between the two blocks count.

    Rows are compared in blocks, the similarity is summed in double precision.
    """
    n = len(ids)
    earlier = [c[:np.searchsorted(c, leaf)] for c in codes]
    counts = np.zeros(n, np.int64)
    top = np.arange(n)

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    def cut(rows: np.ndarray) -> list[np.ndarray]:
        return [rows[at:at + BLOCK] for at in range(0, len(rows), BLOCK)]

    if second is not None:
        meets = [(a, b) for a in cut(np.flatnonzero(second)) for b in cut(np.flatnonzero(~second))]
    else:
        blocks = cut(np.arange(n))
        meets = [(blocks[i], blocks[j]) for i in range(len(blocks)) for j in range(i + 1)]
    for a, b in meets:
        close = vectors[a] @ vectors[b].T >= least
        if a is b:
            np.fill_diagonal(close, False)
        rows, others = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
        if not len(rows):
            continue
        left, right = a[rows], b[others]
        close = close[np.ix_(rows, others)] & ~_seen_before([earlier[k] for k in left], [earlier[k] for k in right])
        counts[left] += close @ sizes[right]
        if a is not b:
            counts[right] += sizes[left] @ close
        while (top[top] != top).any():
            top[:] = top[top]
        for k in np.flatnonzero((close & (top[left][:, None] != top[right])).any(1)):
            whole = root(left[k])
            for end in np.unique(top[right[close[k]]]):
                other = root(end)
                if other != whole:
                    whole, other = min(whole, other), max(whole, other)
                    top[other] = whole
    linked = np.flatnonzero(counts)
    roots = np.array([root(k) for k in linked], np.int64)
    return pd.DataFrame({"key": ids[linked], "n": counts[linked], "least": ids[roots]})


def near_duplicates(rows: DataFrame, forest: Forest = Forest(), least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per row of `rows` (vec_id, embedding).

    A vector that is null, zero or not finite links with nothing and is its own component. Vectors that are
    equal are compared once, and their number counts in n_links. Rows that repeat a vec_id are vectors of their own
    with one id: each has the links of its vector, and its component's least id. A null vec_id stays null and links with nothing.
    Vectors of unlike lengths are compared within their length only. Other columns are not read.
    """
    spark = rows.sparkSession
    base = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, places = unit_rows(batch.column(1).to_pylist())
            vec = [None] * batch.num_rows
            for k, vector in zip(places, vectors):
                vec[k] = vector.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vec, pa.binary())], ["vec_id", "vec"])

    # A class is a set of equal unit vectors; a third of all rows in one class is one row from here on.
    units = written(base.mapInArrow(normalise, "vec_id long, vec binary").withColumn(
        "class", F.when(F.col("vec_id").isNotNull(), F.sha2("vec", 256))), "vectors")
    # `key` numbers the classes: an id may have several, so the least id does not name one.
    classes = written(units.where("class IS NOT NULL").groupBy("class").agg(
        F.min("vec_id").alias("vec"), F.count("*").alias("size"), F.any_value("vec").alias("vector"),
    ).withColumn("key", F.monotonically_increasing_id()), "vector-classes")
    lengths = [r[0] for r in classes.select(F.octet_length("vector").alias("d")).distinct().orderBy("d").collect()]
    parts = [_links(classes.where(F.octet_length("vector") == d), forest, least) for d in lengths]
    none = spark.createDataFrame([], "key long, n long, least long")
    found = none
    for part in parts:
        found = found.unionByName(part)
    found = written(found, "vector-links")
    united = components(found.select(F.col("key").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "key")
    per_class = found.groupBy("key").agg(F.sum("n").alias("n"))
    joined = classes.select("class", "key", "vec", "size").join(per_class, "key", "left").join(united, "key", "left")
    least_ids = joined.where("component IS NOT NULL").groupBy("component").agg(F.min("vec").alias("component_id"))
    answer = joined.join(least_ids, "component", "left").select(
        "class",
        (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component_id", "vec").alias("component_id"),
    )
    return units.select("vec_id", "class").join(answer, "class", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, forest: Forest, least: float) -> DataFrame:
    """(key, n, least): the links of each class found in each leaf; n counts rows, not classes.

    A leaf of more than MEET rows is cut into blocks; each pair of them is one task.
    """
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("class")).limit(forest.sample).select("vector").collect()
    vectors = np.array([np.frombuffer(r[0], np.float64) for r in sample])
    trees = fitted(vectors, forest, total, least)
    offsets = np.cumsum([0, *(max(1, int((t.children < 0).sum())) for t in trees)])
    shared = classes.sparkSession.sparkContext.broadcast(trees)  # its size is bounded by the sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.array([np.frombuffer(v, np.float64) for v in batch.column(2).to_pylist()])
            every = [(r, l + off) for t, off in zip(shared.value, offsets) for r, l in [t.leaves(data)]]
            row, leaf = np.concatenate([e[0] for e in every]), np.concatenate([e[1] for e in every])
            order = np.lexsort((leaf, row))
            row, leaf = row[order], leaf[order]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            codes = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], ["key", "size", "vector", "codes"])

    coded = written(classes.select("key", "size", "vector").mapInArrow(
        assign, "key long, size long, vector binary, codes array<int>"), "vector-leaves")
    cuts = np.ones(offsets[-1], np.int64)
    large = coded.select(F.explode("codes").alias("leaf")).groupBy("leaf").count().where(F.col("count") > MEET)
    for r in large.collect():  # no more rows than the trees have leaves
        cuts[r.leaf] = -(-r["count"] // MEET)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes = batch.column(3)
            row, leaf = np.repeat(np.arange(batch.num_rows), codes.value_lengths().to_numpy()), codes.flatten().to_numpy()
            own = (mixed(batch.column(0).to_numpy().astype(np.uint64))[row] % cuts[leaf].astype(np.uint64)).astype(np.int64)
            times = cuts[leaf]
            other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, leaf, own = (np.repeat(x, times) for x in (row, leaf, own))
            for at in range(0, len(row), ROWS):
                some = np.s_[at:at + ROWS]
                take = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[some].astype(np.int64)), pa.array(np.minimum(own, other)[some]), pa.array(np.maximum(own, other)[some]),
                     pa.array((own > other)[some]), *(c.take(take) for c in batch.columns)],
                    ["leaf", "low", "high", "second", "key", "size", "vector", "codes"],
                )

    placed = coded.mapInArrow(
        meet, "leaf long, low long, high long, second boolean, key long, size long, vector binary, codes array<int>")

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        data = np.array([np.frombuffer(v, np.float64) for v in group["vector"].to_pylist()])
        codes = group["codes"].combine_chunks()
        ends = np.cumsum(codes.value_lengths().to_numpy())[:-1]
        two = key[1].as_py() != key[2].as_py()
        found = links_in_leaf(
            group["key"].to_numpy(), data, np.split(codes.flatten().to_numpy(), ends),
            key[0].as_py(), least, group["size"].to_numpy(), group["second"].to_numpy() if two else None,
        )
        return pa.Table.from_pandas(found, preserve_index=False)

    return placed.groupBy("leaf", "low", "high").applyInArrow(compare, "key long, n long, least long")
