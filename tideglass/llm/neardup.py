"""Near-duplicate classes by ProbMinHash (operator 5).

Texts are weighted sets of five-word shingles, the weight is how often a shingle occurs. The
similarity is the probability Jaccard, which for weights of 1 is the ordinary Jaccard; texts of
0.8 or more are linked, and a class is a connected component of links.

1. Equal texts share one node, the md5 of the text, before anything is compared.
2. Each shingle starts a Poisson process whose rate is its weight; each arrival falls into one of
   BANDS * ROWS registers, and a register keeps the shingle of its first arrival. Two texts agree
   in a register with a probability of their similarity. A shingle's process ends as soon as its
   next arrival is later than the latest register of its text.
3. Nodes that agree in all ROWS registers of a band share a bucket. Each member is compared with
   HUBS members of its bucket: linear in the bucket. A pair whose registers agree well enough
   (SLACK standard errors below the threshold) is verified on the exact shingles of both texts.
4. Where that leaves a bucket in several components, all members outside its largest component
   are compared with all its members on their exact shingles, in bounded cells that return links
   and not pairs, so that no link between components that share a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideglass.llm import texts
from tideglass.llm.components import components
from tideglass.sources.workspace import stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
HUBS = 3
SLACK = 4.5
LEFT_ROWS, RIGHT_ROWS = 128, 512  # of a cell of step 3

_REGISTERS = BANDS * ROWS
_PASS = THRESHOLD - SLACK * (THRESHOLD * (1 - THRESHOLD) / _REGISTERS) ** 0.5


def shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, weight, text), distinct in each text. A text of one to four words has one shingle,
    all its words; a text without words has none."""
    runs = texts.window_hashes(hashes, SHINGLE)
    at = np.flatnonzero(texts.windows_inside(bounds, SHINGLE)) if len(runs) else np.zeros(0, int)
    value, owner = runs[at], np.searchsorted(bounds, at, "right") - 1
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        whole = [texts.window_hashes(hashes[bounds[k]:bounds[k + 1]], size[k])[0] for k in short]
        value, owner = np.concatenate([value, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    key = texts.mix(value + texts.mix(owner.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    weight = np.ones(len(value))
    if len(again):  # few: only those are grouped
        place = np.minimum(np.searchsorted(again, key), len(again) - 1)
        many = np.flatnonzero(again[place] == key)
        _, first, count = np.unique(key[many], return_index=True, return_counts=True)
        weight[many] = 0
        weight[many[first]] = count
        keep = weight > 0
        value, weight, owner = value[keep], weight[keep], owner[keep]
    return value, weight, owner


def prob_min_hash(value: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The registers (n, _REGISTERS) of n texts: the shingle that arrives first in each."""
    first = np.full(n * _REGISTERS, np.inf)
    kept = np.zeros(n * _REGISTERS, dtype=np.uint64)
    time = np.zeros(len(value))
    alive = np.arange(len(value))
    turn = 0
    while len(alive):
        turn += 1
        draw = texts.mix(value[alive] + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        now = time[alive] - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) \
            / weight[alive]
        time[alive] = now
        slot = (texts.mix(draw ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(_REGISTERS)).astype(int) \
            + owner[alive] * _REGISTERS
        early = now < first[slot]
        np.minimum.at(first, slot[early], now[early])
        won = np.flatnonzero(early & (now == first[slot]))
        kept[slot[won]] = value[alive[won]]
        latest = first.reshape(n, _REGISTERS).max(axis=1)
        alive = alive[now < latest[owner[alive]]]
    return kept.reshape(n, _REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys as signed 64-bit numbers; the band's number is part of its key."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None].repeat(len(registers), axis=0)
    bands = registers.reshape(len(registers), BANDS, ROWS)
    for k in range(ROWS):
        out = texts.mix(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return out.view(np.int64)


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact probability Jaccard of two weighted sets, each (values in order, weights)."""
    common, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    a, b = x[1][i], y[1][j]
    only_a, only_b = x[1].sum() - a.sum(), y[1].sum() - b.sum()
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    a_from, b_before = np.cumsum(a[::-1])[::-1], np.cumsum(b) - b
    return float((1 / ((only_a + a_from) / a + (only_b + b_before) / b)).sum())


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in texts.slices(batches, 2):
        hashes, bounds = texts.words(*texts.utf8(part.column(2)))
        registers = prob_min_hash(*shingles(hashes, bounds), part.num_rows)
        some = np.flatnonzero(np.diff(bounds) > 0)
        rows = pa.array(some)
        keys, short = band_keys(registers[some]), registers[some].astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(rows), part.column(1).take(rows),
             pa.array([s.tobytes() for s in short], pa.binary()),
             pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * BANDS, keys.ravel())],
            ["node", "doc_id", "sketch", "bands"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree in enough registers."""
    for batch in batches:
        if batch.num_rows:
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16)
                        .reshape(-1, _REGISTERS) for k in (2, 3))
            ok = (one == two).mean(axis=1) >= _PASS
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))],
                ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text of a, text of b) whose exact similarity reaches the threshold."""
    for part in texts.slices(texts.slices(batches, 2), 3):
        sides = []
        for column in (2, 3):
            hashes, bounds = texts.words(*texts.utf8(part.column(column)))
            value, weight, owner = shingles(hashes, bounds)
            order = np.lexsort((value, owner))
            cut = np.searchsorted(owner[order], np.arange(part.num_rows + 1))
            sides.append((value[order], weight[order], cut))
        ok = []
        for k in range(part.num_rows):
            x, y = ((v[c[k]:c[k + 1]], w[c[k]:c[k + 1]]) for v, w, c in sides)
            ok.append(similarity(x, y) >= THRESHOLD - 1e-9)  # sums of shares round
        yield pa.RecordBatch.from_arrays(
            [part.column(0).filter(pa.array(ok)), part.column(1).filter(pa.array(ok))], ["a", "b"])


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes: one row for each, that of the least id with the text."""
    return docs.join(nodes.join(wanted, "node").select("node", "doc_id"), ["node", "doc_id"]) \
        .dropDuplicates(["node"]).select("node", "text")


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that hold, after the sketches and then the texts have been compared."""
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    near = stage(
        pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b")
        .mapInArrow(_agreement, "a binary, b binary"), "near-pairs")
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    text = stage(_texts(wanted, nodes, docs), "near-texts")
    with_text = near.join(text.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(text.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return with_text.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to the node's shingles, as 64-bit numbers, and their weights."""
    for part in texts.slices(batches, 1):
        value, weight, owner = shingles(*texts.words(*texts.utf8(part.column(1))))
        order = np.lexsort((value, owner))
        cut = np.searchsorted(owner[order], np.arange(part.num_rows + 1)).tolist()
        value, weight = value[order], weight[order]
        spans = list(zip(cut[:-1], cut[1:]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([weight[a:b].tobytes() for a, b in spans], pa.binary())],
            ["node", "shingles", "weights"])


class _Cell:
    """The exact sets of a cell's rows, with their shingles renamed to small numbers."""

    def __init__(self, cell: pa.Table) -> None:
        sets = [np.frombuffer(x, np.uint64) for x in cell["shingles"].to_pylist()]
        self.size = np.array([len(x) for x in sets])
        self.known, where = np.unique(np.concatenate(sets), return_inverse=True)
        self.start = np.cumsum(self.size) - self.size
        self.value = where
        self.weight = np.concatenate([np.frombuffer(x) for x in cell["weights"].to_pylist()])
        self.total = np.add.reduceat(self.weight, self.start)
        self.plain = np.maximum.reduceat(self.weight, self.start) == 1
        self.mark = np.zeros(len(self.known))

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = slice(self.start[k], self.start[k] + self.size[k])
        return self.value[rows], self.weight[rows]

    def near(self, k: int) -> Iterator[int]:
        """The rows whose similarity to row ``k`` reaches the threshold. Sets without repeated
        shingles are compared all at once; of the others those that the bound
        ``sum(min(x / sum(x), y / sum(y)))`` lets through are computed."""
        value, weight = self.of(k)
        self.mark[value] = weight
        found = self.mark[self.value]
        common = np.add.reduceat(found > 0, self.start, dtype=np.int64)
        plain = self.plain & self.plain[k]
        exact = common >= THRESHOLD * (self.size + self.size[k] - common) - 1e-9
        yield from np.flatnonzero(plain & exact)
        if not plain.all():
            share = np.minimum(found / self.total[k],
                               self.weight / np.repeat(self.total, self.size))
            bound = np.add.reduceat(share, self.start)
            for other in np.flatnonzero(~plain & (bound >= THRESHOLD - 1e-9)):
                if similarity((value, weight), self.of(other)) >= THRESHOLD - 1e-9:
                    yield other
        self.mark[value] = 0


def _cross_links(cell: pa.Table) -> pa.Table:
    """Links between left members and members of other components, no more than it takes to join
    the components."""
    a, b = [], []
    if cell.num_rows:
        left = np.asarray(cell["is_left"])
        node = cell["node"].to_pylist()
        # A member on both sides is there twice; roots keep it from meeting itself.
        root = np.unique(np.array([r.hex() for r in cell["root"].to_pylist()]),
                         return_inverse=True)[1]
        sets = _Cell(cell)
        for k in np.flatnonzero(left):
            for other in list(sets.near(k)):
                if root[other] != root[k]:
                    a.append(node[k])
                    b.append(node[other])
                    root[root == root[other]] = root[k]
    return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _leftovers(members: DataFrame, roots: DataFrame, nodes: DataFrame,
               docs: DataFrame) -> DataFrame:
    """Links in buckets that are still in several components: members outside the largest
    component of a bucket are compared with all members of it, on their exact shingles. A cell of
    LEFT_ROWS and RIGHT_ROWS members gives links only, never its pairs."""
    placed = members.join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    split = parts.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("n").alias("all"), F.max("n").alias("most"),
        F.max_by("root", F.struct("n", "root")).alias("largest")).where("parts > 1")
    rows = stage(placed.join(split, "bucket"), "split-buckets")
    sets = stage(_texts(rows.select("node").distinct(), nodes, docs).mapInArrow(
        _shingle_batches, "node binary, shingles binary, weights binary"), "shingles")
    lefts = F.ceil((F.col("all") - F.col("most")) / LEFT_ROWS).cast("int")
    rights = F.ceil(F.col("all") / RIGHT_ROWS).cast("int")

    def blocks(own: str, n: Column, other: str, m: Column, is_left: bool) -> DataFrame:
        return rows.where(F.col("root") != F.col("largest") if is_left else F.lit(True)).select(
            "bucket", F.lit(is_left).alias("is_left"), "node", "root",
            F.pmod(F.xxhash64("node"), n).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), m - 1)).alias(other))

    cells = blocks("l", lefts, "r", rights, True).unionByName(blocks("r", rights, "l", lefts, False))
    return cells.join(sets, "node").groupBy("bucket", "l", "r").applyInArrow(
        _cross_links, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, node (md5 of its text), class_id and ``kept``. Rows of the same
    id and text are one document.

    ``class_id`` is the least id of the class; one row of each class is kept: of the least id, and
    among rows of that id of the least text. Equal texts are one class even when they are too
    short for a shingle. Texts that are NULL or have no words belong together with nothing: each
    such row is kept, with its own id as class. A NULL id is larger than any other. An empty
    table gives no rows. Other columns of ``docs`` play no part.
    """
    slim = docs.select(
        F.unhex(F.md5(F.col(text_col))).alias("node"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"))
    sketched = slim.where("text is not null").mapInArrow(
        _sketch_batches, "node binary, doc_id long, sketch binary, bands array<long>")
    nodes = stage(sketched.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("sketch").alias("sketch"),
        F.any_value("bands").alias("bands")), "nodes")

    hub_names = [f"hub{k}" for k in range(HUBS)]
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    in_shared = stage(buckets.join(shared, "key"), "buckets")
    # Buckets with the same members, as those of close copies are, count once.
    hubs = in_shared.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("all"),
        *[F.min_by("node", F.xxhash64("node", F.lit(k))).alias(name)
          for k, name in enumerate(hub_names)]
    ).groupBy("n", "all", *hub_names).agg(F.min("key").alias("key"))
    members = stage(in_shared.join(hubs, "key").select(
        F.col("key").alias("bucket"), "node", *hub_names), "members")
    by_hub = members.select(
        F.col("node").alias("a"),
        F.explode(F.array_distinct(F.array(*hub_names))).alias("b"))
    linked = stage(_links(_ordered_pairs(by_hub), nodes, slim), "links")

    roots = stage(components(linked), "roots")
    more = stage(_leftovers(members.select("bucket", "node"), roots, nodes, slim), "links")
    # What is linked already is a star around its root, so few rounds remain.
    stars = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = stage(components(stars.unionByName(more)), "roots")

    classes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first")) \
        .select(F.col("root").alias("of"), "first.doc_id", F.col("first.node").alias("first_node"))
    by_node = stage(classes.join(least.withColumnRenamed("doc_id", "class_id"),
                                 F.col("root") == F.col("of"))
                    .select(F.col("node").alias("known"), "class_id", "first_node"), "classes")
    rows = slim.select("node", "doc_id").distinct()
    found = rows.join(by_node, F.col("node") == F.col("known"), "left")
    alone = F.col("known").isNull()
    return found.select(
        "doc_id", "node",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_id"))
                  & (F.col("node") == F.col("first_node")))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class; a row that is there several times stays once."""
    kept = near_duplicates(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("node").alias("_kept_node"))
    marked = docs.withColumn("_node", F.unhex(F.md5(F.col(text_col))))
    return marked.join(
        kept, F.col(id_col).eqNullSafe(F.col("_kept_id"))
        & F.col("_node").eqNullSafe(F.col("_kept_node")), "left_semi"
    ).dropDuplicates([id_col, "_node"]).select(*docs.columns)
