"""Exact Jaccard join of documents' word n-grams with a token-group matrix.

Documents with equal sets are one node. Then:

1. Groups: nodes that share a min-hash gather around the one of them with the most common shingles; those with an
   exact link to it form its group, every other node is a group of its own. Groups part all nodes.
2. Matrix: shingles are ordered by rarity over all documents. For each group the matrix has the union
   of its members' prefixes in this order, with the members' sizes and the most that can follow.
3. Bound: a node meets a group if a shingle of its own prefix is in the group's row, sizes fit, and what follows the
   shingle on both sides is enough for a link. Before any set is shuffled, parity bitmaps bound the difference of two sets from
   below, and a node that links to a member cannot differ from the group's centre by more than two links allow.
   Links to centres and to nodes that are a group of their own make components; a node that is in one with the group
   asks it no more. For the others the union of the group's whole sets, a bitmap, must hold enough of the node's set.
4. Only these groups are opened: blocks of their members are compared with blocks of nodes by parity bitmaps, and the
   pairs that may be linked on whole sets.

Prefix lengths follow from the threshold, so no link is lost; links within a group need no comparison to
know that the group hangs together. Components follow from the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import hash_words, lean, mixed, ngrams, slices, with_text
from casegrid.llm.components import components
from casegrid.llm.groups import SplitJoin
from casegrid.operators.storage import fits_broadcast, stored

#: Places of the rarity counts (any order of shingles is right, a good one is fast), and min-hashes of a node.
RARITY_BITS, SKETCH, KEYS, PARITY_BITS = 18, 16, 3, 1024
#: Bits of a group's union of shingles, and nodes of a block that are compared at once.
UNION_BITS, BLOCK = 16, 256
#: Of the SKETCH min-hashes, so many must agree before a node is compared with a group's centre.
ALIKE = 11
_SEEDS = (np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[:, None]


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words; fewer words are one shingle, none are none."""
    hashes = hash_words((text or b"").lower().split())
    return np.unique(ngrams(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Of each bit, whether an odd number of shingles falls on it: sets differ at least as often as these bits do."""
    odd = np.bincount((shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _described(rows: DataFrame, size: int) -> DataFrame:
    """kind 0: (id, n, node) of each row; kind 1: (place, count) of shingles in a task."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "id", "n", "node"]
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in slices(batches):
            sets = [shingle_set(text.as_py(), size) for text in batch.column(1)]
            counts += np.bincount(_places(np.concatenate(sets)), minlength=len(counts))
            n = len(sets)
            arrays = [np.zeros(n, np.int32), batch.column(0), [len(s) for s in sets], [node_of(s) for s in sets]]
            yield pa.RecordBatch.from_arrays([pa.array(a) if not isinstance(a, pa.Array) else a for a in arrays], names=names)
        seen = np.flatnonzero(counts)
        arrays = [np.ones(len(seen), np.int32), seen, counts[seen], np.zeros(len(seen), np.int64)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=names)

    return rows.mapInArrow(lean(found), "kind int, id long, n long, node long")


_NODES = "node long, size int, keys array<long>, sketch binary, parity array<long>, common long, prefix array<long>"


def _nodes(rows: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in slices(batches):
            out: list[tuple] = []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), size)
                n = len(shingles)
                if not n:
                    continue
                rarity = counts[_places(shingles)]
                order = np.lexsort((shingles, rarity))
                minimal = mixed(shingles[None, :] ^ _SEEDS).min(axis=1)
                probe = n - -(-n * percent // 100) + 1
                out.append(
                    (
                        node_of(shingles),
                        n,
                        minimal[:KEYS].view(np.int64),
                        (minimal >> np.uint64(56)).astype(np.uint8).tobytes(),
                        _parity(shingles),
                        int(rarity[order[0]]),
                        shingles[order[:probe]].view(np.int64),
                    )
                )
            if out:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()))
                arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "size", "keys", "sketch", "parity", "common", "prefix"])

    return rows.mapInArrow(lean(found), _NODES).dropDuplicates(["node"])


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of linked sets of these sizes: o / (a + b - o) >= percent / 100."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def _counts(pairs: DataFrame, key: str) -> DataFrame:
    return stored(pairs.groupBy(key).agg(F.count("*").alias("n")))


class JaccardJoin:
    """The steps over one table of (id, text) rows; ``percent`` is the least Jaccard similarity of a link."""

    def __init__(self, rows: DataFrame, size: int, percent: int):
        self.rows, self.size, self.percent = rows, size, percent
        described = stored(_described(rows, size))
        self.documents = described.filter("kind = 0").select("id", "n", "node")
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        summed = described.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
        counts[summed.column("id").to_numpy()] = summed.column("n").to_numpy()
        self.nodes = stored(_nodes(rows, counts, size, percent))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes in ``wanted``, from the text of one of their documents."""
        wanted = wanted.select("node").distinct()
        named = self.documents.filter("id is not null").join(wanted, "node").groupBy("node").agg(F.min("id").alias("id"))
        ids = stored(named)
        unique = ids.select("id").distinct()
        rows = self.rows.join(F.broadcast(unique) if fits_broadcast(unique) else unique, "id", "left_semi")

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                sets = [shingle_set(text.as_py(), self_size) for text in batch.column(1)]
                arrays = [pa.array([node_of(s) for s in sets]), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "shingles"])

        self_size = self.size
        made = rows.mapInArrow(lean(found), "node long, shingles array<long>")
        return stored(made.join(ids.select("node"), "node", "left_semi").dropDuplicates(["node"]))

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The (a, b) of ``pairs``, a stored table, whose whole sets are linked. Many may have the same b."""
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
        percent = self.percent

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                    x, y = x.values.to_numpy(), y.values.to_numpy()
                    both = len(x) + len(y)
                    overlap = both - len(np.union1d(x, y))
                    if 100 * overlap >= percent * (both - overlap):
                        keep.append(k)
                yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

        split = SplitJoin(_counts(pairs, "b"), "b")
        joined = split.join(split.dealt(pairs).join(left, "a"), right)
        return joined.select("a", "b", "left", "right").mapInArrow(lean(compared), "a long, b long")

    def possible(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Those (a, b) of ``pairs``, a stored table, that may have a Jaccard similarity of ``percent`` by their parity bitmaps;
        none that has it goes. Many may have the same b."""
        ends = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        bits = stored(self.nodes.select("node", "size", "parity").join(ends, "node", "left_semi"))
        left = bits.toDF("a", "a_size", "a_parity")
        right = bits.toDF("b", "b_size", "b_parity")
        differ = " + ".join(f"bit_count(a_parity[{k}] ^ b_parity[{k}])" for k in range(PARITY_BITS // 64))
        allowed = f"({differ}) * {100 + percent} <= (a_size + b_size) * {100 - percent}"
        split = SplitJoin(_counts(pairs, "b"), "b")
        return split.join(split.dealt(pairs).join(left, "a"), right).filter(F.expr(allowed)).select(*pairs.columns)

    def centre_links(self) -> DataFrame:
        """Links (a, b) of nodes a with the centres b of nodes that share one of their min-hashes."""
        keyed = self.nodes.select("node", "size", "sketch", "common", F.posexplode("keys").alias("nth", "key"))
        centres = keyed.groupBy("nth", "key").agg(
            F.max_by(F.struct("node", "size", "sketch"), F.struct("common", "node")).alias("centre"), F.count("*").alias("n")
        )
        centres = centres.filter("n > 1").select("nth", "key", "centre")
        agree = " + ".join(f"int(substring(sketch, {k}, 1) = substring(centre.sketch, {k}, 1))" for k in range(1, SKETCH + 1))
        pairs = keyed.join(centres, ["nth", "key"]).filter(
            (F.col("node") != F.col("centre.node"))
            & _sizes_fit(F.col("size"), F.col("centre.size"), self.percent)
            & (F.expr(agree) >= ALIKE)
        )
        pairs = stored(pairs.select(F.col("node").alias("a"), F.col("centre.node").alias("b")).distinct())
        pairs = stored(self.possible(pairs, self.percent))
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        return stored(self.linked(pairs, self.sets(ends)))

    def groups(self, links: DataFrame) -> DataFrame:
        """(node, in_group) of members but the centre. A centre stays in its own group."""
        centres = links.select(F.col("b").alias("a")).distinct()
        members = links.join(centres, "a", "left_anti")
        return members.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("in_group"))

    def candidates(self, grouped: DataFrame) -> DataFrame:
        """(a, in_group) by the matrix of prefixes."""
        nodes = self.nodes.select("node", "size", "prefix").join(grouped, "node", "left")
        nodes = nodes.select("node", "size", F.coalesce("in_group", "node").alias("in_group"), F.posexplode("prefix").alias("place", "token"))
        probes = nodes.withColumn("rest", F.col("size") - F.col("place"))
        # as the smaller of two sets, a node needs a shorter prefix
        size = F.col("size")
        shorter = F.col("place") <= size - _needed(size, size, self.percent)
        matrix = probes.filter(shorter).groupBy("token", F.col("in_group").alias("g")).agg(
            F.min("size").alias("low"), F.max("size").alias("high"), F.max("rest").alias("most")
        )
        meets = (
            (F.col("g") != F.col("in_group"))
            & (F.col("low") <= size)
            & (F.col("high") * 100 >= size * self.percent)
            & (F.least("rest", "most") >= _needed(size, F.greatest(F.col("low").cast("double"), size * self.percent / 100), self.percent))
        )
        met = probes.join(matrix, "token").filter(meets)
        return met.select(F.col("node").alias("a"), F.col("g").alias("in_group")).distinct()

    def links(self) -> DataFrame:
        """(a, b): enough links between nodes that every link of two nodes lies within a component."""
        centred = self.centre_links()
        grouped = stored(self.groups(centred))
        met = stored(self.candidates(grouped).withColumnRenamed("in_group", "b"))  # b is the centre, or the only member
        single = stored(self.possible(met, self.percent))
        ends = single.select(F.col("a").alias("node")).union(single.select("b"))
        near = stored(centred.union(self.linked(single, self.sets(ends))))
        several = grouped.select("in_group").distinct()
        # one link to a member and the member's to the centre: distances add up at most
        asked = stored(met.join(several, met["b"] == several["in_group"], "left_semi"))
        asked = stored(self.possible(asked, max(0, 2 * self.percent - 100)).withColumnRenamed("b", "in_group"))
        return near.union(self.opened(self.apart(asked, near), grouped))

    def apart(self, asked: DataFrame, near: DataFrame) -> DataFrame:
        """Those (a, in_group) of ``asked`` that the links ``near`` do not yet join; stored."""
        found = components(near)
        counts = _counts(asked, "in_group")
        groups = counts.select("in_group").join(found.toDF("in_group", "of_group"), "in_group", "left")
        split = SplitJoin(counts, "in_group")
        rows = split.join(split.dealt(asked).join(found.toDF("a", "of_a"), "a", "left"), groups)
        return stored(rows.filter(~F.coalesce(F.col("of_a") == F.col("of_group"), F.lit(False))).select("a", "in_group"))

    def opened(self, asked: DataFrame, grouped: DataFrame) -> DataFrame:
        """(a, b): links of the asking nodes with members b of groups whose union holds enough of a."""
        members = grouped.select("in_group", F.col("node").alias("b")).join(asked.select("in_group").distinct(), "in_group", "left_semi")
        members = stored(members)
        ends = asked.select(F.col("a").alias("node")).union(members.select("b")).union(members.select("in_group"))
        sets = self.sets(ends)
        pairs = stored(self.pairs_of_blocks(self.held(asked, members, sets), members))
        return self.linked(pairs, sets)

    def held(self, asked: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
        """Those (a, in_group) whose group's union has enough of a's shingles, by a bitmap of the union; stored."""
        everyone = members.union(members.select("in_group", F.col("in_group").alias("b")).distinct())
        bit = F.col("token").bitwiseAND((1 << UNION_BITS) - 1)
        tokens = everyone.join(sets.withColumnRenamed("node", "b"), "b").select("in_group", F.explode("shingles").alias("token"))
        words = tokens.groupBy("in_group", F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(token & 63))")).alias("bits"))
        unions = words.groupBy("in_group").agg(F.collect_list(F.struct("word", "bits")).alias("held"))  # at most 2**UNION_BITS bits
        split = SplitJoin(_counts(asked, "in_group"), "in_group")
        rows = split.join(split.dealt(asked).join(sets.withColumnRenamed("node", "a"), "a"), unions)
        percent = self.percent

        def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for k, (shingles, union) in enumerate(zip(batch.column(2), batch.column(3))):
                    bitmap = np.zeros(1 << (UNION_BITS - 6), np.int64)
                    bitmap[union.values.field("word").to_numpy()] = union.values.field("bits").to_numpy()
                    token = shingles.values.to_numpy() & ((1 << UNION_BITS) - 1)
                    found = int((bitmap[token >> 6] >> (token & 63) & 1).sum())
                    if 100 * found >= percent * len(token):
                        keep.append(k)
                yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

        return stored(rows.select("a", "in_group", "shingles", "held").mapInArrow(lean(enough), "a long, in_group long"))

    def pairs_of_blocks(self, asked: DataFrame, members: DataFrame) -> DataFrame:
        """(a, b) that may be linked by their parity bitmaps, of all askers and all members of a group, block by block."""
        described = self.nodes.select("node", "size", "parity")

        def blocks(rows: DataFrame, node: str, prefix: str) -> tuple[DataFrame, DataFrame]:
            number = rows.groupBy("in_group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"{prefix}blocks"))
            block = F.pmod(F.xxhash64(node), F.col(f"{prefix}blocks")).cast("int").alias(f"{prefix}block")
            one = rows.join(described.withColumnRenamed("node", node), node).join(number, "in_group")
            held = F.collect_list(F.struct(F.col(node).alias("node"), "size", "parity")).alias(f"{prefix}held")  # some BLOCK nodes
            return one.groupBy("in_group", block).agg(held), number

        (asking, _), (asked_of, number) = blocks(asked, "a", "a_"), blocks(members, "b", "b_")
        each = F.explode(F.sequence(F.lit(0), F.col("b_blocks") - 1)).alias("b_block")
        met = asking.join(number, "in_group").select("in_group", each, "a_held").join(asked_of, ["in_group", "b_block"])
        percent = self.percent

        def decoded(held: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows = held.values
            node, size = rows.field("node").to_numpy(), rows.field("size").to_numpy().astype(np.int64)
            return node, size, rows.field("parity").flatten().to_numpy().reshape(len(node), -1)

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for of_a, of_b in zip(batch.column(0), batch.column(1)):
                    a, a_size, a_parity = decoded(of_a)
                    b, b_size, b_parity = decoded(of_b)
                    differ = np.bitwise_count(a_parity[:, None, :] ^ b_parity[None, :, :]).sum(axis=2, dtype=np.int64)
                    i, k = np.nonzero(differ * (100 + percent) <= (a_size[:, None] + b_size[None, :]) * (100 - percent))
                    yield pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(b[k])], names=["a", "b"])

        return met.select("a_held", "b_held").mapInArrow(lean(compared), "a long, b long")


def jaccard_components(
    docs: DataFrame,
    size: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A row's set are the distinct shingles of ``size`` words (ASCII case folded, split at ASCII white space); two rows are
    linked if 100 * intersection >= percent * union, and ``component_id`` is the least id that links reach. NULL and
    empty texts have no set and no links. Rows with one id count as one document; rows with a NULL id take no part and
    have no component. An empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie in 50..100")
    join = JaccardJoin(with_text(docs, id_col, text_col), size, percent)
    # a node is named by the least id of its documents; nodes of one id are linked
    named = join.documents.filter("n > 0 and id is not null").groupBy("node").agg(F.min("id").alias("name"))
    names = stored(named)
    edges = join.links()
    edges = edges.join(names.select(F.col("node").alias("a"), F.col("name").alias("x")), "a")
    edges = edges.join(names.select(F.col("node").alias("b"), F.col("name").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = components(edges)
    labels = names.join(found.withColumnRenamed("node", "name"), "name", "left").select(
        "node", F.coalesce("component", "name").alias("component")
    )
    return join.documents.join(labels, "node", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )
