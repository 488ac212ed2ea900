"""Similarity join of documents on word n-grams by Jaccard.

Two documents link where their sets of distinct n-grams have a Jaccard
similarity of at least ``percent`` / 100. The method is prefix filtering:

* A first pass counts all n-grams of all documents in a hashed table of fixed
  size. It gives an order, rare first; any order is right, this one keeps the
  prefixes' groups small.
* Only the first |x| - ceil(t|x|) + 1 n-grams of a document x in that order
  are posted, by bucket of the n-gram. A pair is a candidate at an n-gram
  only if its sizes allow a link and if the pair could link were this its
  first common n-gram (positional filter): a linked pair passes at its first.
* Posting lists are gathered by their leader, the smallest node in them, since
  near copies share most of their lists. The texts of a leader's nodes travel
  there once, packed, whatever the number of lists, and its pairs are verified once, on
  the whole sets, after the size filter and a suffix filter that bounds the
  overlap by the parity of parts of the sets. A pair that shares several leaders
  is verified at the smallest.

Documents of equal word sequence are one node (their sets are equal). Links
are wanted for components: a leader's task skips pairs that are connected there
already and emits only links that join, so neither rows nor verified pairs of a
group of near copies grow with its square, and no link between different
components is lost. Texts that share leaders but do not link need all their
pairs tested; a large leader is cut by size into tiles of bounded size, and each
two tiles that can link are tested by themselves.

Postings travel as arrays by bucket, so a shuffle moves a few large rows.
A bucket holds whole posting lists; its memory is that of the n-grams rare
enough to be in a prefix.

Defined cases: a null text, or one without words, has no n-grams, and is
linked with nothing; with fewer words than n the whole sequence is one
n-gram; a null id is counted as a row of its own and linked with nothing; rows of one
id are one document for links; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import slices, staged, text_buffer
from quayside.llm.components import components
from quayside.llm.shingles import sequence_hashes, shingles, words

SLICE_BYTES = 2 << 20  # of text at a time: the hashes take some fifty times that
CHUNK = 1 << 16  # entries of the count table in a row
LEAST_BUCKETS = 64
POSTINGS_PER_BUCKET = 1_000_000
TILE_NODES = 4096
TILE_NGRAMS = 2_000_000  # 16 MB
FEW_NODES = 8  # a block's pairs are tested one by one
PARTITION_BYTES = 32 << 20  # of sets in a task
SEEN_NODES = 1_000_000
MAP_BITS = 1 << 27  # 16 MB


def least_overlap(nx, ny, percent: int):
    """Smallest overlap with 100 * overlap >= percent * union."""
    return -(-percent * (nx + ny) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def batch_texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the word hashes of their texts and their bounds."""
    for batch in batches:
        for part in slices(iter([batch]), batch.schema.names[column], SLICE_BYTES):
            yield part, *words(*text_buffer(part.column(column)))


# first pass ----------------------------------------------------------------
def scan(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """Per document its number of n-grams and node; and rows of n-gram counts by chunk."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch, hashes, bounds in batch_texts(batches, 1):
            node, check = sequence_hashes(hashes, bounds)
            sets = [shingles(hashes[a:b], size) for a, b in zip(bounds, bounds[1:])]
            for s in sets:
                counts[(s >> np.uint64(64 - bits)).astype(np.int64)] += 1
            n = len(sets)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(node), pa.array(check),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        if counts.any():
            chunks = counts.reshape(-1, min(CHUNK, len(counts))).astype(np.min_scalar_type(int(counts.max())))
            n = len(chunks)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                pa.array(range(n), pa.int32()), pa.array([c.tobytes() for c in chunks], pa.binary())], names=names)

    names = ["doc_id", "n", "node", "check", "chunk", "counts"]
    return docs.mapInArrow(rows, "doc_id long, n long, node long, check long, chunk int, counts binary")


def commonness(scanned: DataFrame, bits: int) -> np.ndarray:
    """A class 0 to 255 for each entry of the count table, growing with its count."""
    entries = min(CHUNK, 1 << bits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(data, f"<u{len(data) // entries}")
                total[chunk] = total.get(chunk, 0) + counts.astype(np.int64)
        classes = [np.minimum(255, np.round(8 * np.log2(t + 1))).astype(np.uint8).tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(classes, pa.binary())], names=["chunk", "classes"])

    rows = scanned.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk") \
        .mapInArrow(add, "chunk int, classes binary").collect()  # 2^bits bytes in all
    out = np.zeros(1 << bits, np.uint8)
    for r in rows:
        out[r.chunk * entries:(r.chunk + 1) * entries] = np.frombuffer(r.classes, np.uint8)
    return out


# postings ------------------------------------------------------------------
POSTINGS = [("ngram", "<u8"), ("node", "<i8"), ("n", "<i4"), ("place", "<i4")]


def pack(columns: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c, k).tobytes() for c, (_, k) in zip(columns, POSTINGS))


def unpack(blobs) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for blob in blobs:
        n, at = len(blob) // 24, 0
        for held, (_, kind) in zip(parts, POSTINGS):
            held.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


def post(docs: DataFrame, size: int, percent: int, classes, bits: int, buckets: int) -> DataFrame:
    """(bucket, postings) of the prefixes of all nodes. A task posts a node once."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = classes.value, set()
        for batch, hashes, bounds in batch_texts(batches, 1):
            nodes = sequence_hashes(hashes, bounds)[0]
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            held: list[list[np.ndarray]] = [[], [], [], []]
            for node, a, b, known in zip(nodes.tolist(), bounds, bounds[1:], valid):
                if not known or node in seen:
                    continue
                seen.add(node)
                s = shingles(hashes[a:b], size)
                first = s[np.argsort(common[(s >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")][:prefix_length(len(s), percent)]
                for column, value in zip(held, (first, np.full(len(first), node), np.full(len(first), len(s)), np.arange(len(first)))):
                    column.append(value)
            if len(seen) > SEEN_NODES:
                seen.clear()
            if not held[0]:
                continue
            columns = [np.concatenate(c) for c in held]
            bucket = (columns[0] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns, cuts = [c[order] for c in columns], np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()),
                pa.array([pack([c[cuts[k]:cuts[k + 1]] for c in columns]) for k in full], pa.binary())], names=["bucket", "postings"])

    return docs.mapInArrow(rows, "bucket int, postings binary")


class Lists:
    """Posting lists of a bucket in order of n-gram, size and node."""

    def __init__(self, ngram, node, n, place, percent: int):
        self.node, self.n, self.place, self.percent = node, n, place, percent
        self.starts = np.flatnonzero(np.concatenate([[True], ngram[1:] != ngram[:-1]])) if len(ngram) else np.zeros(0, np.int64)
        self.sizes = np.diff(np.append(self.starts, len(ngram)))
        self.rest = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(ngram)) - 1  # postings after each

    def at_gap(self, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs at this distance that pass the size and positional filters."""
        i = np.flatnonzero(self.rest >= gap)
        j = i + gap
        small, large = self.n[i].astype(np.int64), self.n[j].astype(np.int64)
        most = np.minimum(small - self.place[i], large - self.place[j])  # overlap if this is the first common n-gram
        keep = (100 * small >= self.percent * large) & (most >= least_overlap(small, large, self.percent))
        return i[keep], j[keep]

    def with_partner(self, looked: int = 64) -> np.ndarray:
        """The postings with a partner that passes; those of a list longer than ``looked`` are taken to have one."""
        has = np.repeat(self.sizes > looked, self.sizes)
        for gap in range(1, min(looked, int(self.sizes.max(initial=0)))):
            i, j = self.at_gap(gap)
            has[i] = has[j] = True
        return has

    def leaders(self) -> np.ndarray:
        """The smallest node of each posting's list."""
        return np.repeat(np.minimum.reduceat(self.node, self.starts), self.sizes) if len(self.starts) else self.node


def list_members(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of a bucket: the nodes of its posting lists, by the lists' leaders."""
    ngram, node, n, place = unpack(group["postings"])
    order = np.argsort(ngram, kind="stable")
    ngram, node, n, place = ngram[order], node[order], n[order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], ngram[1:] != ngram[:-1]]))
    count = np.diff(np.append(starts, len(ngram)))
    keep = np.flatnonzero(np.repeat(count > 1, count))
    ngram, node, n, place = ngram[keep], node[keep], n[keep], place[keep]
    order = np.lexsort((node, n, ngram))
    ngram, node, n, place = ngram[order], node[order], n[order], place[order]
    if len(ngram):  # a node posted by two tasks
        own = np.concatenate([[True], (ngram[1:] != ngram[:-1]) | (node[1:] != node[:-1])])
        ngram, node, n, place = ngram[own], node[own], n[own], place[own]
    lists = Lists(ngram, node, n, place, percent)
    keep = lists.with_partner()
    return pd.DataFrame({"leader": lists.leaders()[keep], "node": node[keep], "n": n[keep]}).drop_duplicates()


def blocks(members: DataFrame, percent: int) -> DataFrame:
    """(node, n, leader, leaders, block, side) for the members (leader, node, n).

    A leader's nodes are one block up to the tile bounds. Beyond them they are
    cut by size, so that only equal and neighbouring size classes can link, a
    class by a hash of the node into tiles, and each two tiles that can link
    are a block: side 0 is compared with side 1, or with itself where there is none.
    """
    width = max(1e-6, math.log(100 / percent)) * 1.001
    rows = staged(members.groupBy("node").agg(F.sort_array(F.collect_set("leader")).alias("leaders"), F.max("n").alias("n"))
                  .select("node", "n", "leaders", F.explode("leaders").alias("leader"),
                          F.floor(F.log(F.col("n").cast("double")) / width).alias("class")), "members")
    per_class = rows.groupBy("leader", "class").agg(F.count("*").alias("nodes"), F.sum("n").alias("ngrams"))
    tiles = F.ceil(F.greatest(F.col("nodes") / TILE_NODES, F.col("ngrams") / TILE_NGRAMS)).cast("int")
    large = staged(per_class.withColumn("tiles", tiles).groupBy("leader").agg(
        F.sum("nodes").alias("nodes"), F.sum("ngrams").alias("ngrams"), F.map_from_entries(F.collect_list(F.struct("class", "tiles"))).alias("tiles"))
        .filter((F.col("nodes") > TILE_NODES) | (F.col("ngrams") > TILE_NGRAMS)).select("leader", "tiles"), "large-leaders")
    small = rows.join(large, "leader", "left_anti").select(
        "node", "n", "leader", "leaders", F.array(F.lit(0).cast("long")).alias("block"), F.lit(0).alias("side"))
    if large.isEmpty():
        return small
    of = lambda c: F.coalesce(F.try_element_at("tiles", c), F.lit(0))
    own, c = F.pmod(F.xxhash64("node"), of(F.col("class"))).cast("long"), F.col("class")

    def against(other, entry):
        """An entry for each tile of the other class, none where there is no such class."""
        return F.transform(F.when(other > 0, F.sequence(F.lit(0), other - 1)).otherwise(F.array().cast("array<int>")), lambda k: entry(k.cast("long")))

    def entry(low, high, i, j, side):
        return F.struct(F.array(low, high, i, j).alias("block"), F.lit(side).alias("side") if isinstance(side, int) else side.alias("side"))

    same = against(of(c), lambda k: entry(c, c, F.least(own, k), F.greatest(own, k), F.when(k < own, 1).otherwise(0)))
    above = against(of(c + 1), lambda k: entry(c, c + 1, own, k, 0))
    below = against(of(c - 1), lambda k: entry(c - 1, c, k, own, 1))
    cut = rows.join(large, "leader").select(
        "node", "n", "leader", "leaders", F.inline(F.concat(same, above, below)))
    return small.unionByName(cut)


# verification --------------------------------------------------------------
def linked(x: np.ndarray, y: np.ndarray, percent: int, parts: int = 8) -> bool:
    """Whether two sorted sets link. The suffix filter first bounds the overlap
    by the sizes of the parts between common cuts."""
    need = least_overlap(len(x), len(y), percent)
    cut = np.arange(1, parts) * len(y) // parts
    at = np.searchsorted(x, y[cut])
    bound = np.minimum(np.diff(at, prepend=0, append=len(x)), np.diff(cut, prepend=0, append=len(y))).sum()
    return bool(bound >= need) and len(np.intersect1d(x, y, assume_unique=True)) >= need


class Sets:
    """Sets of a block end to end, with the parity of their parts."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        self.ids = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
        self.mark = np.zeros(len(self.ids) + 1, bool)
        bits = 1 << min(12, max(9, int(2 * self.n.max()).bit_length()))
        parts = [np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)) for s in sets]
        self.parity = np.stack(parts).view(np.uint64)

    def linked(self, i: int, others: np.ndarray, percent: int, owned) -> np.ndarray:
        """Those of the others that link with set i. The sets differ in at least
        as many n-grams as there are parts of other parity (suffix filter)."""
        small, large = np.minimum(self.n[i], self.n[others]), np.maximum(self.n[i], self.n[others])
        others = others[100 * small >= percent * large]
        need = least_overlap(self.n[i], self.n[others], percent)
        differ = np.bitwise_count(self.parity[others] ^ self.parity[i]).sum(axis=1, dtype=np.int64)
        keep = np.flatnonzero(differ <= self.n[i] + self.n[others] - 2 * need)
        keep = keep[[owned(i, j) for j in others[keep]]] if len(keep) else keep
        others, need = others[keep], need[keep]
        if not len(others):
            return others
        mine = self.ids[self.starts[i]:self.starts[i + 1]]
        self.mark[mine] = True
        same = np.array([np.count_nonzero(self.mark[self.ids[self.starts[j]:self.starts[j + 1]]]) for j in others])
        self.mark[mine] = False
        return others[same >= need]


def block_links(nodes: list[int], sides: list[int], sets: list[np.ndarray], earlier: list[frozenset], percent: int) -> list[tuple[int, int]]:
    """Links of a block that join its nodes into their components, at most one
    less than its nodes. A pair that shares an earlier leader is left to that."""
    top = np.arange(len(nodes))
    side, found = np.array(sides), []
    if len(nodes) <= FEW_NODES:
        for i, j in itertools.combinations(range(len(nodes)), 2):
            if (side[i] != side[j] or not side.any()) and top[i] != top[j] and earlier[i].isdisjoint(earlier[j]) and linked(sets[i], sets[j], percent):
                found.append((nodes[i], nodes[j]))
                top[top == top[j]] = top[i]
        return found
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1)
    held = Sets(sets)
    for at, i in enumerate(first):
        others = second if len(second) else first[at + 1:]
        others = others[top[others] != top[i]]
        if not len(others):
            continue
        for j in held.linked(i, others, percent, lambda x, y: earlier[x].isdisjoint(earlier[y])):
            if top[j] != top[i]:
                found.append((nodes[i], nodes[j]))
                top[top == top[j]] = top[i]
    return found


def links_of(placed: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The links (a, b) of all blocks. A task reads its blocks one after another
    from sorted rows and holds one of them, within the bounds of two tiles."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def result():
            nodes = list(held)
            pairs = block_links(nodes, *map(list, zip(*held.values())), percent) if len(nodes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            leader, block, node, side, leaders = (batch.column(k).to_pylist() for k in range(5))
            for r in range(batch.num_rows):
                if key != (leader[r], block[r]):
                    yield result()
                    key, held = (leader[r], block[r]), {}
                if node[r] not in held:  # rows of one id with one text
                    held[node[r]] = (side[r], unpacked_set(batch.column(5)[r].as_py(), size),
                                     frozenset(x for x in leaders[r] if x < leader[r]))
        yield result()

    total = 8 * (placed.agg(F.sum("n")).first()[0] or 0)
    parts = max(placed.sparkSession.sparkContext.defaultParallelism, -(-total // PARTITION_BYTES))
    rows = placed.join(texts, "node").select("leader", "block", "node", "side", "leaders", "packed")
    return rows.repartition(parts, "leader", "block").sortWithinPartitions("leader", "block") \
        .mapInArrow(find, "a long, b long")


def id_filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap by a hash of the ids, 64 bits an id and at most MAP_BITS in
    all, and its number of bits. It can only let more ids pass."""
    bits = min(MAP_BITS, max(1 << 15, 1 << (64 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.part - 1) * 4096:r.part * 4096] = np.frombuffer(r.bits, np.uint8)
    return out, bits


def node_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, packed text) of at least the wanted documents (doc_id). The other
    texts stay where they are: a bitmap of bounded size picks the documents. A
    packed text is about a third of the bytes of its set of n-grams."""
    bitmap, bits = id_filter(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor()
        for batch in batches:
            place = batch.column(2).to_numpy()
            picked = batch.filter(pa.array((shared.value[place >> 3] >> (place & 7) & 1).astype(bool)))
            for part, hashes, bounds in batch_texts(iter([picked]), 1):
                data, ends = text_buffer(part.column(1))
                packed = [packer.compress(data[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(sequence_hashes(hashes, bounds)[0]), pa.array(packed, pa.binary())],
                                                 names=["node", "packed"])

    placed = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("place"))
    return placed.mapInArrow(rows, "node long, packed binary")


def unpacked_set(packed: bytes, size: int) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return shingles(words(data, np.array([0, len(data)]))[0], size)


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per document row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a count table of up to 16 MB of classes, and at most a sixteenth of a task's text
    bits = min(24, max(16, int(math.log2(min(total / 400, total / docs.rdd.getNumPartitions() / 16) + 1))))
    scanned = staged(scan(docs, size, bits), "ngram-scan")
    rows = scanned.filter("chunk IS NULL").select("doc_id", "n", "node", "check")
    # one document for each node; two word sequences under one 64-bit hash would show in the second hash
    nodes = staged(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.min("check").alias("c1"), F.max("check").alias("c2")), "nodes")
    count = nodes.agg(F.sum("n"), F.max(F.col("c1") != F.col("c2"))).first()
    if count[1]:
        raise ArithmeticError("two word sequences share a 64-bit hash")
    buckets = max(LEAST_BUCKETS, -(-(count[0] or 0) * (100 - percent) // (100 * POSTINGS_PER_BUCKET)))
    classes = spark.sparkContext.broadcast(commonness(scanned, bits))
    postings = post(docs, size, percent, classes, bits, buckets)
    members = postings.groupBy("bucket").applyInPandas(_members_at(percent), "leader long, node long, n int")
    placed = staged(blocks(members, percent), "blocks")
    wanted = staged(nodes.join(placed.select("node").distinct(), "node").select("doc_id"), "wanted")
    if wanted.isEmpty():
        return _members(rows, None)
    texts = staged(node_texts(docs, wanted.select("doc_id")), "texts")
    links = staged(links_of(placed, texts, size, percent), "links")
    return _members(rows, None if links.isEmpty() else components(links))


def _members_at(percent: int):
    def find(group: pd.DataFrame) -> pd.DataFrame:
        return list_members(group, percent)

    return find


def _members(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Component of every row: the smallest id of its nodes' documents. An id
    whose rows have several texts joins their components."""
    if roots is None:
        placed = rows.select("doc_id", "n", F.col("node").alias("root"))
    else:
        placed = staged(rows.join(roots, "node", "left").select("doc_id", "n", F.coalesce("root", "node").alias("root")), "placed")
    counted = placed.filter("n > 0 AND doc_id IS NOT NULL")
    several = counted.groupBy("doc_id").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    if not several.isEmpty():
        pairs = counted.join(several.select("doc_id", "a"), "doc_id").filter("root <> a").select("a", F.col("root").alias("b")).distinct()
        joined = components(pairs).withColumnRenamed("root", "top").withColumnRenamed("node", "root")
        placed = staged(placed.join(joined, "root", "left").select("doc_id", "n", F.coalesce("top", "root").alias("root")), "placed")
    least = staged(placed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    named = placed.join(least, "root", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNull(), None).when(
        F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
