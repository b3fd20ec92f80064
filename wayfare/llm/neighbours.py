"""Near-duplicate embeddings by NN-descent.

Every distinct vector has a list of its nearest neighbours so far, begun in
leaves of random projections. In a round, new entries of the lists around a
vector meet the others there (neighbours of neighbours) and each vector keeps
the best. Lists that hold nothing but links are saturated: these alone are
enlarged and refined again, and what is saturated still is compared in blocks.
A sample compared with all vectors, or planted copies where few are linked,
audits the recall. Pairs at or above the threshold, in double precision, are
links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import materialise
from wayfare.llm.components import connected_components

THRESHOLD = 0.95
# Places of a list, and of one that was saturated; a list is named by so many
# others at most that its members meet them, too.
NEIGHBOURS, WIDE, REVERSED = 12, 48, 8
# Projections that start the lists, rows of a leaf, and how many it shares
# with the one before.
TREES, LEAF, LEAF_STEP = 6, 64, 40
# A projection's rank is made of so many directions, each the nearest of
# 2 * DIRECTIONS, then of signs.
RANKS, DIRECTIONS, SIGNS = 4, 64, 32
# Rounds end when the new links are no more than this share of all.
STILL = 0.01
# Vectors compared with all others for the audit, how many linked ones make
# it count, copies planted for it, and the recall asked for.
AUDIT_ROWS, AUDIT_LINKED, PLANTED, RECALL = 1024, 50, 256, 0.97
BLOCK_ROWS = 1024
# Rows of a table that is broadcast (each of a few bytes): more go by shuffle.
BROADCAST_ROWS = 1 << 18


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def few(table: DataFrame) -> DataFrame:
    """``table`` for a join: broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def decode(codes: list[bytes]) -> np.ndarray:
    """Unit vectors of 8-bit codes; shorter ones are filled up with zeros."""
    width = max(map(len, codes), default=0)
    rows = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), np.int8)
    return unit(rows.reshape(len(codes), width).astype(np.float32))


def coded(vectors: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """8-bit codes, and how far each decoded unit vector is from the true one:
    the cosine of two codes is off by at most the sum of theirs."""
    codes = [np.round(v * (127 / np.abs(v).max())).astype(np.int8) for v in vectors]
    off = [float(np.linalg.norm(c / np.linalg.norm(c.astype(float)) - v / np.linalg.norm(v))) for c, v in zip(codes, vectors)]
    return [c.tobytes() for c in codes], np.array(off, np.float32) + np.float32(2e-6)


def classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(key1, key2, least, copies, vector, code, off): one row for each
    distinct usable vector under two hashes. Usable: not null, not zero, no
    component null or not finite."""
    value = F.col(embedding).cast("array<double>")
    norm = F.sqrt(F.aggregate(value, F.lit(0.0), lambda total, x: total + x * x))
    rows = vectors.select(F.col(vec_id).alias("_id"), value.alias("vector"), norm.alias("_norm"))
    fine = rows.where((F.col("_norm") > 0) & (F.col("_norm") < float("inf")))  # null and NaN fail too
    one = fine.groupBy(*vector_key("vector")).agg(
        F.min("_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, off = coded([np.asarray(v) for v in batch.column(4).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(off)],
                                             names=[*batch.schema.names, "code", "off"])

    return one.mapInArrow(run, T.StructType([*one.schema.fields, T.StructField("code", T.BinaryType()),
                                             T.StructField("off", T.FloatType())]))


def vector_key(column: str) -> list:
    return [F.xxhash64(column).alias("key1"), F.xxhash64(F.lit("second"), column).alias("key2")]


def planted_copies(nodes: DataFrame, n_nodes: int, threshold: float) -> DataFrame:
    """(origin, code, off) of copies of about ``PLANTED`` nodes, at cosines
    between the threshold and 1; vectors of one component have none. A table
    that the audit's sample holds whole needs none."""
    chance = F.pmod(F.xxhash64(F.lit("plant"), "node"), F.lit(max(8, n_nodes // PLANTED)))
    chance = chance if n_nodes > AUDIT_ROWS else F.lit(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origins, made = [], []
            for node, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = unit(np.array([v]))[0]
                rng = np.random.default_rng(node % (1 << 32))
                side = rng.normal(size=len(v))
                side -= (side @ v) * v
                if len(v) > 1 and np.linalg.norm(side) > 1e-9:
                    cosine = threshold + (1 - threshold) * rng.uniform(0.1, 0.9)
                    origins.append(node)
                    made.append(cosine * v + (1 - cosine**2) ** 0.5 * side / np.linalg.norm(side))
            codes, off = coded(made)
            yield pa.RecordBatch.from_arrays([pa.array(origins, pa.int64()), pa.array(codes, pa.binary()), pa.array(off, pa.float32())],
                                             names=["origin", "code", "off"])

    return nodes.where(chance == 0).select("node", "vector").mapInArrow(run, "origin bigint, code binary, off float")


PAIRS = "src bigint, dst bigint, sim float, low float"


class _Pairs:
    """Collects (src, dst, sim, low): bounds of the cosine from above and below."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.held = 0
        self.draw = np.random.default_rng(42)

    def add(self, node: np.ndarray, off: np.ndarray, near: np.ndarray, best: int, bar: np.ndarray | None = None) -> None:
        """The ``best`` of each row of the cosines ``near`` that beat its bar."""
        k = min(best, len(node) - 1)
        if k < 1:
            return
        # among rows as near as others chance decides, or all would name the same ones
        top = np.argpartition(self.draw.random(near.shape, np.float32) * np.float32(1e-6) - near, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(near, top, 1)
        good = value > (-2 if bar is None else bar[:, None])
        row, at = np.nonzero(good)[0], top[good]
        slack = off[row] + off[at]
        self.parts.append((node[row], node[at], value[good], value[good] - 2 * slack))
        self.held += len(row)

    def batch(self) -> pa.RecordBatch:
        out = [np.concatenate(x) for x in zip(*self.parts)]
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.float32)),
                                           pa.array(out[3].astype(np.float32))], names=["src", "dst", "sim", "low"])

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.held > 50_000:
            yield self.batch()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield self.batch()


def cosines(code: list[bytes], off: np.ndarray) -> np.ndarray:
    """Upper bounds of the cosines of all rows with one another; -3 with itself."""
    v = decode(code)
    near = v @ v.T + off[:, None] + off
    np.fill_diagonal(near, -3)
    return near


def placed(nodes: DataFrame, turn: int) -> DataFrame:
    """(tree, place, node, code, off): every node once for each projection of
    this ``turn``, with its rank there: the nearest of some random directions
    and their opposites, then those of further draws, then signs. Near vectors
    have near ranks. Vectors of different lengths are in different trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[tuple, np.ndarray] = {}
        for batch in batches:
            code = batch.column(1).to_pylist()
            sizes = np.array([len(c) for c in code])
            for width in np.unique(sizes).tolist():
                rows = np.nonzero(sizes == width)[0]
                v = decode([code[i] for i in rows])
                for tree in range(turn * TREES, (turn + 1) * TREES):
                    if (width, tree) not in drawn:
                        rng = np.random.default_rng((42, width, tree))
                        drawn[width, tree] = rng.normal(size=(width, RANKS * DIRECTIONS + SIGNS)).astype(np.float32)
                    cast = v @ drawn[width, tree]
                    place = np.zeros(len(rows), np.int64)
                    for r in range(RANKS):
                        some = cast[:, r * DIRECTIONS:(r + 1) * DIRECTIONS]
                        nearest = np.abs(some).argmax(1)
                        sign = np.take_along_axis(some, nearest[:, None], 1)[:, 0] > 0
                        place = place * (2 * DIRECTIONS) + 2 * nearest + sign
                    for c in range(RANKS * DIRECTIONS, RANKS * DIRECTIONS + SIGNS):
                        place = place * 2 + (cast[:, c] > 0)
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), width * 10_000 + tree)), pa.array(place), *part.columns],
                        names=["tree", "place", "node", "code", "off"])

    return nodes.select("node", "code", "off").mapInArrow(
        run, "tree bigint, place bigint, node bigint, code binary, off float")


def leaf_pairs(nodes: DataFrame, turn: int, best: int) -> DataFrame:
    """The best pairs in leaves: runs of ``LEAF`` nodes next to one another in
    the order of a projection's ranks, however many have the same rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs()
        rest: pa.Table | None = None

        def leaves(rows: pa.Table, last: bool) -> int:
            """Compare whole leaves from the start; returns the rows done with."""
            tree, node, off = (rows[c].to_numpy() for c in ("tree", "node", "off"))
            code = rows["code"].to_pylist()
            at = 0
            while at < len(tree):
                end = min(at + LEAF, int(np.searchsorted(tree, tree[at], side="right")))
                if end == len(tree) and not last and end < at + LEAF:
                    return at
                pairs.add(node[at:end], off[at:end], cosines(code[at:end], off[at:end]), best)
                # the last leaf of a tree ends with it
                at = end if end < at + LEAF else at + LEAF_STEP
            return at

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            rest = rows.slice(leaves(rows, False)) if rows.num_rows else None
            yield from pairs.full()
        if rest is not None and rest.num_rows:
            leaves(rest, True)
        yield from pairs.rest()

    # nodes of one rank are in another order in each tree
    order = ["tree", "place", F.xxhash64("tree", "node")]
    return placed(nodes, turn).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PAIRS)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(columns of one group) for batches sorted by their first column."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        key = table.column(0).to_numpy()
        cuts = np.nonzero(key[1:] != key[:-1])[0] + 1
        columns = [c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy() for c in table.columns[1:]]
        for s, e in zip([0, *cuts[:-1]], cuts):
            yield tuple(c[s:e] for c in columns)
        rest = table.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield tuple(c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy() for c in rest.columns[1:])


def meet(members: DataFrame, nodes: DataFrame, bars: DataFrame, best: int) -> DataFrame:
    """Pairs inside groups (group, node, new) of which one node at least is
    new there: for each node its ``best`` that beat its bar, the similarity of
    the last entry of its list."""
    rows = members.join(nodes.select("node", "code", "off"), "node").join(bars, "node", "left")
    rows = rows.select("group", "node", "code", "off", F.coalesce("bar", F.lit(-2.0)).cast("float").alias("bar"), "new")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs()
        for node, code, off, bar, new in _groups(batches):
            if len(node) < 2:
                continue
            near = cosines(code, off)
            near[np.ix_(new == 0, new == 0)] = -3  # these have met
            width = np.array([len(c) for c in code])
            near[width[:, None] != width] = -3
            pairs.add(node, off, near, best, bar)
            yield from pairs.full()
        yield from pairs.rest()

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(run, PAIRS)


def best_of(pairs: DataFrame, by: str, size: int) -> DataFrame:
    """The ``size`` nearest rows of each node; Spark limits the groups before
    the shuffle, so a node that very many lists name is no hot key."""
    order = Window.partitionBy(by).orderBy(F.desc("sim"), F.xxhash64("src", "dst"), "src", "dst")
    return pairs.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size).drop("_rank")


def new_lists(pairs: DataFrame, size: int, threshold: float) -> DataFrame:
    """Lists (src, dst, sim, low, new) of the best of ``pairs`` (with ``new``);
    entries of a list that is saturated count as old: it needs no better ones."""
    each = pairs.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.max("low").alias("low"), F.min("new").alias("new"))
    near = F.sum((F.col("sim") >= threshold).cast("int")).over(Window.partitionBy("src"))
    lists = best_of(each, "src", size).withColumn("new", F.when(near >= size, F.lit(0)).otherwise(F.col("new")))
    return materialise(lists, "neighbours")


def refine(lists: DataFrame, nodes: DataFrame, size: int, threshold: float) -> DataFrame:
    """The lists after rounds of NN-descent: members of a list, and the vectors
    whose lists name its owner, meet where one of them is a new entry. Rounds
    end when they bring hardly a new entry at the threshold."""
    while True:
        back = best_of(lists, "dst", REVERSED)
        members = (lists.select(F.col("src").alias("group"), F.col("dst").alias("node"), "new")
                   .unionByName(back.select(F.col("dst").alias("group"), F.col("src").alias("node"), "new"))
                   .groupBy("group", "node").agg(F.max("new").alias("new")))
        alive = members.groupBy("group").agg(F.max("new").alias("any")).where("any = 1").select("group")
        bars = (lists.groupBy(F.col("src").alias("node"))
                .agg(F.min("sim").alias("bar"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= size).drop("n"))
        found = meet(members.join(alive, "group", "left_semi"), nodes, bars, max(NEIGHBOURS, size // 2))
        # only owners of lists here get entries
        found = found.join(lists.select("src").distinct(), "src", "left_semi")
        lists = new_lists(lists.withColumn("new", F.lit(0)).unionByName(found.withColumn("new", F.lit(1))), size, threshold)
        near = lists.where(F.col("sim") >= threshold).agg(
            F.count(F.lit(1)).alias("all"), F.coalesce(F.sum("new"), F.lit(0)).alias("new")).first()
        if near["new"] <= STILL * near["all"]:
            return lists


def saturated(lists: DataFrame, size: int, threshold: float) -> DataFrame:
    """The nodes whose lists are full of entries at the threshold."""
    near = lists.where(F.col("sim") >= threshold)
    return near.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= size).select("node")


def descend(nodes: DataFrame, size: int, turn: int, known: DataFrame | None, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The neighbour lists after NN-descent from the leaves of this ``turn``
    and the lists ``known``, and the nodes that are saturated still after
    their lists, and no others, were enlarged to ``WIDE`` places or more."""
    start = leaf_pairs(nodes, turn, -(-size // 2)).withColumn("new", F.lit(1))
    if known is not None:
        start = start.unionByName(known.withColumn("new", F.lit(0)))
    lists = refine(new_lists(start, size, threshold), nodes, size, threshold)
    full = materialise(saturated(lists, size, threshold), "saturated")
    if full.isEmpty():
        return lists, full
    wide = max(WIDE, 4 * size)
    dense = lists.join(full.withColumnRenamed("node", "src"), "src", "left_semi").withColumn("new", F.lit(1))
    # lists full of one another lead nowhere else, so all pairs of the dense nodes' own leaves come in
    start = leaf_pairs(nodes.join(full, "node", "left_semi"), turn, LEAF).withColumn("new", F.lit(1))
    dense = refine(new_lists(dense.unionByName(start), wide, threshold), nodes, wide, threshold)
    rest = lists.join(full.withColumnRenamed("node", "src"), "src", "left_anti")
    return materialise(rest.unionByName(dense), "neighbours"), materialise(saturated(dense, wide, threshold), "saturated")


def exact_links(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose cosine in double precision reaches the threshold."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("vector").alias(f"{name}_vector"))
    rows = pairs.join(side("u"), "u").join(side("v"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [len(x) == len(y) and cosine(np.asarray(x), np.asarray(y)) >= threshold for x, y in zip(a, b)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("u", "v", "u_vector", "v_vector").mapInArrow(run, "u bigint, v bigint")


def links_of(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The links (u, v) among the lists: entries that the bounds leave open
    are decided by their vectors."""
    near = lists.where(F.col("sim") >= threshold)
    pairs = near.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(F.max("low").alias("low"))
    pairs = materialise(pairs, "near_pairs")
    sure = F.col("low") >= threshold + 1e-5
    open_ = exact_links(pairs.where(~sure).select("u", "v"), nodes, threshold)
    return pairs.where(sure).select("u", "v").unionByName(open_)


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    return float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))


def block_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, n): for every member (component, node, vector, copies) of the
    saturated groups, how many vectors of other members it is linked to.
    Members are dealt to blocks and every two blocks meet once; only counts
    leave a pair of blocks."""
    sizes = members.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = (members.join(few(sizes), "component")
              .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = placed.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                          "block", "node", "copies", "vector")

    def count(group: pa.Table) -> pa.Table:
        block = group["block"].to_numpy()
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        vectors = group["vector"].to_pylist()
        width = np.array([len(v) for v in vectors])
        full = unit(np.array([np.pad(np.asarray(v), (0, width.max() - len(v))) for v in vectors]))
        low, high = (np.nonzero(block == b)[0] for b in (block.min(), block.max()))
        same = group["low"][0].as_py() == group["high"][0].as_py()
        if not same and block.min() == block.max():
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        linked = (full[low] @ full[high].T >= threshold) & (width[low][:, None] == width[high])
        if same:
            np.fill_diagonal(linked, False)
            return pa.table({"node": node[low], "n": linked @ copies[low]})
        return pa.table({"node": np.concatenate([node[low], node[high]]),
                         "n": np.concatenate([linked @ copies[high], linked.T @ copies[low]])})

    parts = dealt.groupBy("component", "low", "high").applyInArrow(count, "node bigint, n bigint")
    return parts.groupBy("node").agg(F.sum("n").alias("n"))


#: Saturated groups that are compared with one another by their vectors at once.
UNITS_AT_ONCE = 4096


def unit_pairs(units: DataFrame, n_units: int, threshold: float) -> DataFrame:
    """(a, b) of the saturated groups (component, first, width) that may have
    links to one another: the angle between their first vectors is at most
    that of the threshold and their two widths. Up to ``UNITS_AT_ONCE`` groups
    are compared in one task; more go through neighbour lists of the first
    vectors, enlarged while one holds nothing but such groups."""
    reach = float(np.arccos(threshold)) + 1e-4

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, off = coded([np.asarray(v) for v in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary()), pa.array(off), batch.column(2)],
                                             names=["node", "code", "off", "width"])

    nodes = units.select("component", "first", "width").mapInArrow(code, "node bigint, code binary, off float, width double")
    if n_units <= UNITS_AT_ONCE:
        def all_of(rows: pa.Table) -> pa.Table:
            name, width = rows["node"].to_numpy(), rows["width"].to_numpy()
            codes = rows["code"].to_pylist()
            angle = np.arccos(np.clip(cosines(codes, rows["off"].to_numpy()), -1, 1))
            size = np.array([len(c) for c in codes])
            a, b = np.nonzero((angle <= reach + width[:, None] + width) & (size[:, None] == size) & (name[:, None] < name))
            return pa.table({"a": name[a], "b": name[b]})

        return nodes.groupBy(F.lit(0).alias("one")).applyInArrow(all_of, "a bigint, b bigint")
    nodes = materialise(nodes, "saturated_firsts")
    widest = float(nodes.agg(F.max("width")).first()[0])
    bar = float(np.cos(min(np.pi, reach + 2 * widest)))
    wide = lambda name: nodes.select(F.col("node").alias(name), F.col("width").alias(f"{name}_width"))
    size, turn, lists = WIDE, 0, None
    while True:
        start = leaf_pairs(nodes, turn, -(-size // 2)).withColumn("new", F.lit(1))
        start = start if lists is None else start.unionByName(lists.withColumn("new", F.lit(0)))
        lists = refine(new_lists(start, size, bar), nodes, size, bar)
        angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sim").cast("double"))))
        near = (lists.join(wide("src"), "src").join(wide("dst"), "dst")
                .where(angle <= reach + F.col("src_width") + F.col("dst_width")).select("src", "dst"))
        near = materialise(near, "saturated_near")
        if size >= n_units or near.groupBy("src").count().where(F.col("count") >= size).isEmpty():
            return near.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
        size, turn = 2 * size, turn + 1


def across(members: DataFrame, threshold: float) -> DataFrame:
    """(node, n, partner): for every member (component, node, vector, copies)
    of the saturated groups, how many vectors of other groups it is linked to,
    and one of these; a node comes up once for each pair of blocks."""
    units = members.groupBy("component").agg(
        F.min_by("vector", "node").alias("first"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    units = materialise(units, "saturated_units")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    near = dot("vector", "first") / (F.sqrt(dot("vector", "vector")) * F.sqrt(dot("first", "first")))
    # a group may be most of the members: its first vector goes to them by broadcast if there are few groups
    widths = (members.join(few(units), "component").groupBy("component")
              .agg(F.max(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), near)))).alias("width")))
    units = materialise(units.join(widths, "component"), "saturated_widths")
    blocks = lambda name: units.select(F.col("component").alias(name), F.col("blocks").alias(f"{name}_blocks"))
    pairs = unit_pairs(units, units.count(), threshold).join(blocks("a"), "a").join(blocks("b"), "b")
    pairs = materialise(pairs, "saturated_pairs")
    own = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (members.withColumnRenamed("component", "a").join(few(pairs), "a")
            .select("a", "b", own("a_blocks").alias("x"), each("b_blocks").alias("y"), F.lit(True).alias("left"),
                    "node", "copies", "vector"))
    right = (members.withColumnRenamed("component", "b").join(few(pairs), "b")
             .select("a", "b", each("a_blocks").alias("x"), own("b_blocks").alias("y"), F.lit(False).alias("left"),
                     "node", "copies", "vector"))

    def between(group: pa.Table) -> pa.Table:
        side = group["left"].to_numpy()
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        full = unit(np.array(group["vector"].to_pylist()))
        a, b = np.nonzero(side)[0], np.nonzero(~side)[0]
        if not len(a) or not len(b):
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "n", "partner")})
        linked = full[a] @ full[b].T >= threshold
        out = pa.table({"node": np.concatenate([node[a], node[b]]),
                        "n": np.concatenate([linked @ copies[b], linked.T @ copies[a]]),
                        "partner": np.concatenate([node[b][linked.argmax(1)], node[a][linked.argmax(0)]])})
        return out.filter(pa.array(out["n"].to_numpy() > 0))

    return left.unionByName(right).groupBy("a", "b", "x", "y").applyInArrow(between, "node bigint, n bigint, partner bigint")


def audit(nodes: DataFrame, n_nodes: int, degrees: DataFrame, plants: DataFrame, lists: DataFrame, size: int,
          threshold: float) -> tuple[float, int]:
    """(recall, audited). A sample of about ``AUDIT_ROWS`` vectors is compared
    with all, and the recall is the share of its links that was found for a
    vector, on average over the linked ones. With fewer than ``AUDIT_LINKED``
    of these, it is the share of the planted copies whose link to their
    original is in a list; copies whose own list is saturated don't count, as
    such lists may end before the original. The standard error is at most
    0.5 / sqrt(audited). The cost grows with the table and not with its square."""
    whole = 1 << 30
    chance = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(whole))
    upto = min(whole, -(-AUDIT_ROWS * whole // max(1, n_nodes)))
    found, linked = _audit_part(nodes, nodes.where(chance < upto), degrees, threshold)
    if linked >= AUDIT_LINKED or upto == whole:
        return (found / linked if linked else 1.0), linked
    near = lists.where(F.col("sim") >= threshold)
    ends = near.select(F.col("src").alias("node"), F.col("dst").alias("origin"))
    ends = ends.unionByName(near.select(F.col("dst").alias("node"), F.col("src").alias("origin")))
    met = ends.where("node < 0").distinct().withColumn("met", F.lit(1))
    full = saturated(lists, size, threshold).withColumn("full", F.lit(1))
    row = (plants.join(met, ["node", "origin"], "left").join(full, "node", "left").where("met = 1 or full is null")
           .agg(F.count("met").alias("met"), F.count(F.lit(1)).alias("all")).first())
    return (row["met"] / row["all"] if row["all"] else 1.0), row["all"]


def _audit_part(nodes: DataFrame, some: DataFrame, degrees: DataFrame, threshold: float) -> tuple[float, int]:
    """Sum of the found shares of the linked vectors in ``some``, and their number."""
    sample = some.select("node", "vector").toArrow()
    queries = sample["node"].to_numpy()
    lists = sample["vector"].to_pylist()
    if not lists:
        return 0.0, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = []
        for n in {len(v) for v in lists}:
            block = unit(np.array([v for v in lists if len(v) == n]))
            names = np.array([q for q, v in zip(queries, lists) if len(v) == n])
            wanted += [(n, block[s:s + AUDIT_ROWS], names[s:s + AUDIT_ROWS]) for s in range(0, len(names), AUDIT_ROWS)]
        for batch in batches:
            own, many = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = batch.column(2).to_pylist()
            width = np.array([len(v) for v in rows])
            full = {n: unit(np.array([v for v in rows if len(v) == n])) for n in set(width.tolist())}
            for n, block, names in wanted:
                if n not in full:
                    continue
                at = np.nonzero(width == n)[0]
                near = full[n] @ block.T >= threshold
                near &= own[at][:, None] != names
                total = many[at] @ near
                hit = total > 0
                yield pa.RecordBatch.from_arrays([pa.array(names[hit]), pa.array(total[hit])], names=["node", "n"])

    true = nodes.select("node", "copies", "vector").mapInArrow(run, "node bigint, n bigint")
    totals = true.groupBy("node").agg(F.sum("n").alias("true")).join(degrees, "node", "left")
    share = F.least("true", F.coalesce("n", F.lit(0))) / F.col("true")
    row = totals.agg(F.coalesce(F.sum(share), F.lit(0.0)).alias("found"), F.count(F.lit(1)).alias("linked")).first()
    return row["found"], row["linked"]


def inside_and_across(links: DataFrame, nodes: DataFrame, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """((node, n), (u, v)): the links of every node by count, counted in blocks
    for the ``members`` of saturated groups, and links that join such groups."""
    ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    single = (ends.join(nodes.select(F.col("node").alias("v"), "copies"), "v")
              .groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("n")))
    if members.isEmpty():
        return single, links.limit(0)
    outer = materialise(across(members, threshold), "outer_links")
    counted = materialise(block_counts(members, threshold), "block_counts")
    inner = single.join(members.select("node"), "node", "left_anti").unionByName(counted)
    joints = outer.select(F.col("node").alias("u"), F.col("partner").alias("v"))
    return inner.unionByName(outer.select("node", "n")), joints


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

    n_links: other vectors linked directly, equal ones included; component_id:
    the smallest vec_id reachable; kept: it is the vector's own. Vectors that
    are null, zero or hold a null or non-finite component, and vectors of
    different lengths, link with nothing. Equal vectors are compared once. An
    empty table gives an empty table; other columns are not kept.

    The lists are doubled, from other projections and what was found, while
    the audited recall is below ``RECALL``; it is an error if it still is with
    lists of all vectors. A list that is full of links says that there may be
    more: it is enlarged, and if it is full again the whole component around
    it is compared in blocks, also with other such components near it.
    """
    nodes = classes(vectors, vec_id, embedding).withColumn("node", F.monotonically_increasing_id())
    nodes = materialise(nodes, "vector_classes")
    n_nodes = nodes.count()
    plants = planted_copies(nodes, n_nodes, threshold).withColumn("node", -1 - F.monotonically_increasing_id())
    plants = materialise(plants, "planted")
    points = materialise(nodes.select("node", "code", "off").unionByName(plants.select("node", "code", "off")), "points")
    size, turn, lists = neighbours, 0, None
    while True:
        lists, full = descend(points, size, turn, lists, threshold)
        own = lists.where("src >= 0 and dst >= 0")
        links = materialise(links_of(own, nodes, threshold), "vector_links")
        components = materialise(connected_components(links), "vector_components")
        group = F.coalesce("component", "node").alias("component")
        crowded = full.where("node >= 0").join(components, "node", "left").select(group).distinct()
        members = (nodes.join(components, "node", "left").select(group, "node", "copies", "vector")
                   .join(crowded, "component", "left_semi"))
        members = materialise(members, "members")
        inner, joints = inside_and_across(links, nodes, members, threshold)
        degrees = materialise(inner.groupBy("node").agg(F.sum("n").alias("n")), "degrees")
        if not joints.isEmpty():
            components = materialise(connected_components(links.unionByName(joints)), "vector_components")
        recall, audited = audit(nodes, n_nodes, degrees, plants, lists, size, threshold)
        if recall >= RECALL:
            break
        if size >= n_nodes:
            raise RuntimeError(f"recall {recall:.4f} over {audited} vectors is below {RECALL}")
        size, turn = 2 * size, turn + 1
    home = nodes.select("node", "key1", "key2", "least", "copies").join(components, "node", "left").join(degrees, "node", "left")
    home = materialise(home.select("key1", "key2", "least", F.coalesce("component", "node").alias("component"),
                                   (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "homes")
    least = home.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = home.join(few(least), "component").select("key1", "key2", "n_links", "component_id")
    value = F.col(embedding).cast("array<double>")
    # an unusable vector has no class
    norm = F.aggregate(value, F.lit(0.0), lambda total, x: total + x * x)
    usable = F.coalesce((norm > 0) & (norm < float("inf")), F.lit(False))
    keys = [F.when(usable, k).alias(n) for n, k in zip(("key1", "key2"), (F.xxhash64(value), F.xxhash64(F.lit("second"), value)))]
    rows = vectors.select(F.col(vec_id).alias("vec_id"), *keys)
    out = rows.join(placed, ["key1", "key2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
