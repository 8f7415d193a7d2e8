"""N-gram Jaccard join by signature trees: documents link when 100 * intersection >= percent * union.

A document's set holds the 64-bit hashes of its distinct word shingles. Equal sets are one member.

Blocks. Any order of the tokens works for a prefix filter; here tokens of crowded hash cells (counted
over all documents in a table of ``CELLS`` numbers) come last, so passages that many documents share
decide nothing. In that order two linked sets of sizes s and s' share at least min(l(s), l(s')) tokens
among their first s - ceil(percent * s) + l(s), with l a quarter of the tokens that may differ. Tokens
met in the prefixes of two members set a bit in a table of ``FILTER_BITS`` bits; a document with fewer
set bits than the least l of any possible partner links with nothing. The others are grouped into
blocks that share such tokens (connected, so links never leave a block). A crowded table only lets
more documents through.

Trees. A block is a tree: leaves are members with a bitmap of their tokens, inner nodes hold the
OR of their children's bitmaps and the range of their sizes. Two nodes are traversed together while the
largest overlap that any two members below could have, min over both sides of (tokens that share a
bit + bits common to both bitmaps), reaches what their sizes require; at the leaves the sets are
intersected. Nodes whose members are already connected are skipped, so a group of copies costs about
its size, and only a spanning forest of the links leaves a task.

Large blocks (more than ``TILE_TOKENS`` tokens) are cut into tiles by size band and hash. A first
round traverses each tile with itself and its neighbours, a second one all other tile pairs of the
same or the next band that are not yet one component. No task holds more than two tiles or, of small
blocks, about as many tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shuffle_width, spans, stash
from .components import components

#: A-Z become a-z, the white space becomes a space.
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))
#: Cells of the token counts that order the tokens (4 MB a task, 1 MB broadcast).
CELLS, CELL_SHIFT, CELL_BLOCK = 1 << 20, 44, 4096
#: Bits of the table of shared prefix tokens (16 MB broadcast).
FILTER_BITS, FILTER_SHIFT = 1 << 27, 37
#: Tokens that a tile or a group of small blocks holds about (8 bytes each).
TILE_TOKENS = 1 << 21
FAN = 8
#: Members of a token up to which its pairs are counted.
FEW = 16
#: Slices of a token's nodes when they are chained, and rows of the node table up to which it is broadcast (24 bytes each).
SLICES, BROADCAST_ROWS = 16, 1 << 19
#: Node pairs looked at once.
PAIRS = 1 << 13
#: Words whose hashes a worker remembers, and digests by which a task drops copies.
REMEMBERED = 1 << 19
#: Bytes of tokens handed over at once.
AT_ONCE = 1 << 25


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def token_set(data: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text (UTF-8); of all words where there are fewer than ``width``."""
    parts = []
    for part in spans((data or b"").translate(WORD_BYTES)):
        words = part.split()
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
    h = np.concatenate(parts)
    if not len(h):
        return h
    size = min(width, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):  # a chain of splitmix steps: order counts
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + h[j : len(h) - size + 1 + j]
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    out.sort()
    new = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


def least_overlap(size: int, percent: int) -> int:
    """Tokens that any partner shares with a set of ``size``, which is also the least size of a partner."""
    return -(-percent * size // 100)


def margin(size: int, percent: int) -> int:
    return max(1, (size - least_overlap(size, percent) + 1) // 4)


def places(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The common order of tokens: those of crowded cells last, by hash within a level."""
    return levels[(tokens >> np.uint64(CELL_SHIFT)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | tokens >> np.uint64(8)


def prefix(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens in the common order: linked sets share ``margin`` of these at least."""
    size = len(tokens)
    first = size - least_overlap(size, percent) + margin(size, percent)
    if first >= size:
        return tokens
    return tokens[np.argpartition(places(tokens, levels), first)[:first]]


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def route(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


class Seen(set):
    """Digests that a task has met (forgotten when too many: a copy then goes twice)."""

    def new(self, key: bytes) -> bool:
        if key in self:
            return False
        if len(self) > REMEMBERED:
            self.clear()
        self.add(key)
        return True


def _texts(batch: pa.RecordBatch, column: str = "t") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def survey(docs: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """A row (doc_id, n, digest) for each document, and rows (block, counts) with the tokens of a task by cell."""
    names = ["doc_id", "n", "digest", "block", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, counts = WordHashes(), Seen(), np.zeros(CELLS, np.uint32)
        for batch in batches:
            n, keys = [], []
            for data in _texts(batch):
                tokens = token_set(data, width, hashes)
                n.append(len(tokens))
                keys.append(digest(tokens))
                if seen.new(keys[-1]):
                    np.add.at(counts, (tokens >> np.uint64(CELL_SHIFT)).astype(np.int64), np.uint32(1))
            rows = len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        parts = counts.reshape(-1, CELL_BLOCK)
        at = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()),
                                          pa.array(at.astype(np.int32)), pa.array([parts[i].tobytes() for i in at], pa.binary())], names)

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    return stash(src.mapInArrow(run, "doc_id long, n long, digest binary, block int, counts binary"), "jaccard-survey")


def token_levels(surveyed: DataFrame) -> np.ndarray:
    """How crowded each cell is, on a logarithmic scale (one byte a cell)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # a task meets at most CELLS / CELL_BLOCK blocks
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[block] = total.get(block, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        for block, counts in total.items():
            level = np.round(4 * np.log2(1.0 + counts)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "levels"])

    rows = surveyed.filter("block is not null").select("block", "counts").repartition(CELLS // CELL_BLOCK, "block")
    out = np.zeros(CELLS, np.uint8)
    for r in rows.mapInArrow(run, "block int, levels binary").collect():
        out[r["block"] * CELL_BLOCK : (r["block"] + 1) * CELL_BLOCK] = np.frombuffer(r["levels"], np.uint8)
    return out


def shared_tokens(docs: DataFrame, text: str, width: int, percent: int, levels) -> np.ndarray:
    """Bit table of the tokens that stand in the prefixes of two members or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), Seen()
        for batch in batches:
            found, routes = [], []
            for data in _texts(batch):
                tokens = token_set(data, width, hashes)
                key = digest(tokens)
                if len(tokens) and seen.new(key):
                    found.append(prefix(tokens, levels.value, percent))
                    routes.append(np.full(len(found[-1]), route(key), np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(routes))], ["token", "route"])

    met = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "token long, route long")
    twice = met.groupBy("token").agg(F.min("route").alias("a"), F.max("route").alias("b")).filter("a <> b")
    cell = F.shiftrightunsigned("token", FILTER_SHIFT) + 1
    rows = twice.groupBy(F.bitmap_bucket_number(cell).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        out[(r["block"] - 1) * 4096 : r["block"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def candidates(docs: DataFrame, text: str, width: int, percent: int, levels, shared) -> DataFrame:
    """(cell, digest, n, tokens, hits): members that share enough prefix tokens to have a partner; hits are these tokens,
    cell is the first of them in the common order.

    A set that many documents have comes once from each task that meets it."""
    names = ["cell", "digest", "n", "tokens", "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, out, size = WordHashes(), Seen(), [], 0
        for batch in batches:
            for data in _texts(batch):
                tokens = token_set(data, width, hashes)
                if not len(tokens):
                    continue
                first = prefix(tokens, levels.value, percent)
                cell = (first >> np.uint64(FILTER_SHIFT)).astype(np.int64)
                hits = first[shared.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 1]
                key = digest(tokens)
                if len(hits) >= margin(least_overlap(len(tokens), percent), percent) and seen.new(key):
                    least = hits[np.argmin(places(hits, levels.value))]
                    out.append((int(least.view(np.int64)), key, len(tokens), tokens.tobytes(), hits.view(np.int64)))
                    size += tokens.nbytes
                if size > AT_ONCE:
                    yield _batch(out, names)
                    out, size = [], 0
        if out:
            yield _batch(out, names)

    found = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "cell long, digest binary, n long, tokens binary, hits array<long>")
    return stash(found, "jaccard-members")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cells, keys, n, tokens, hits = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(keys, pa.binary()), pa.array(n, pa.int64()),
                                       pa.array(tokens, pa.binary()), pa.array(hits, pa.list_(pa.int64()))], names)


def blocks(members: DataFrame, percent: int) -> DataFrame:
    """(node, block, weight): members that may be linked, directly or through others, with the tokens of the block;
    blocks of one member are left out. A node is the start of a digest (equal ones merge, which loses no link).

    Linked members share at least as many hits as either needs, some of them tokens that FEW members or fewer have, or
    all of them frequent ones. The pairs of each token of FEW members are counted, and those stay that reach this number
    with the frequent hits that both could share. Members whose frequent hits alone reach it are also joined by these: they
    are chained in their order within slices of the token, and the slices' smallest nodes with each other."""
    # margin(least_overlap(n), percent), in integers
    least = F.expr(f"(n * {percent} + 99) div 100")
    needs = F.expr(f"greatest(1, (least - (least * {percent} + 99) div 100 + 1) div 4)")
    once = members.select("digest", "n", "hits").dropDuplicates(["digest"])
    known = once.select(node_of(F.col("digest")).alias("node"), "n", "hits")
    known = cut(known.withColumn("least", least).withColumn("needs", needs).drop("least"))
    hits = known.select("node", F.explode("hits").alias("token"))
    many = cut(hits.groupBy("token").count().filter(F.col("count") > FEW).select(F.col("token").alias("frequent")))
    many = F.broadcast(many) if many.count() <= BROADCAST_ROWS else many
    hits = cut(hits.join(many, F.col("token") == F.col("frequent"), "left"))
    rich = hits.filter("frequent is not null").groupBy("node").count().withColumnRenamed("count", "held")
    sides = cut(known.select("node", "n", "needs").join(rich, "node", "left").fillna(0, ["held"]))
    few = hits.filter("frequent is null").select("node", "token")
    pairs = few.join(few.select(F.col("node").alias("to"), "token"), "token").filter("node < to").groupBy("node", "to").count()
    other = sides.select(F.col("node").alias("to"), F.col("n").alias("n2"), F.col("needs").alias("needs2"), F.col("held").alias("held2"))
    near = pairs.join(sides, "node").join(other, "to").filter("count + least(held, held2) >= greatest(needs, needs2)").filter(
        f"100 * least(n, n2) >= {percent} * greatest(n, n2)").select("node", "to")
    glued = hits.filter("frequent is not null").join(sides.filter("held >= needs").select("node"), "node", "left_semi")
    glued = glued.withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(SLICES)))
    chain = F.lag("node").over(Window.partitionBy("token", "slice").orderBy("node"))
    first = glued.groupBy("token", "slice").agg(F.min("node").alias("node"))
    heads = F.lag("node").over(Window.partitionBy("token").orderBy("node"))  # SLICES rows at most
    edges = near.unionAll(glued.select("node", chain.alias("to"))).unionAll(first.select("node", heads.alias("to"))).filter("node <> to")
    roots = components(cut(edges.select(F.col("node").alias("u"), F.col("to").alias("v")).distinct()))
    named = cut(sides.select("node", "n").join(roots.withColumnRenamed("root", "block"), "node"))  # others are alone
    sizes = named.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight")).filter("members > 1")
    return named.select("node", "block").distinct().join(sizes.select("block", "weight"), "block")


def node_of(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


class Tree:
    """Signature tree over sets in the given order. levels[0] are the leaves, levels[-1] the root."""

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        self.sets = sets
        size = np.array([len(s) for s in sets], np.int64)
        maps = np.zeros((len(sets), bits), bool)
        for i, s in enumerate(sets):
            maps[i, (s & np.uint64(bits - 1)).astype(np.int64)] = True
        maps = np.packbits(maps, axis=1).view(np.uint64)
        clash = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)  # tokens that share a bit with another one
        self.levels = [(maps, size, size, clash)]
        self.first = [np.arange(len(sets) + 1)]  # leaves below each node
        while len(maps) > 1:
            at = np.arange(0, len(maps), FAN)
            low, high, clash = (f.reduceat(x, at) for f, x in zip((np.minimum, np.maximum, np.maximum), self.levels[-1][1:], strict=True))
            maps = np.bitwise_or.reduceat(maps, at, axis=0)
            self.levels.append((maps, low, high, clash))
            self.first.append(np.append(self.first[-1][:-1][at], len(sets)))


def _possible(a: Tree, b: Tree, la: int, lb: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sizes and the largest possible overlap of node pairs allow a link."""
    (map_a, low_a, high_a, clash_a), (map_b, low_b, high_b, clash_b) = a.levels[la], b.levels[lb]
    ok = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    i, j = i[ok], j[ok]
    common = np.bitwise_count(map_a[i] & map_b[j]).sum(axis=1, dtype=np.int64)
    overlap = np.minimum(np.minimum(common + clash_a[i], common + clash_b[j]), np.minimum(high_a[i], high_b[j]))
    ok[ok] = (100 + percent) * overlap >= percent * (low_a[i] + low_b[j])
    return ok


class Forest:
    """Union-find over the members of one task."""

    def __init__(self, start: np.ndarray) -> None:
        self.up = start

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = int(up[x])
        return x

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up


def traverse(a: Tree, b: Tree, at_a: int, at_b: int, forest: Forest, percent: int) -> list[tuple[int, int]]:
    """Links (member numbers) that connect what all links between the trees connect; a is b: within one tree.

    ``at_a``, ``at_b``: number of the first member of each tree in the forest."""
    same, out = a is b, []
    top = np.zeros(1, np.int64)
    stack = [(len(a.levels) - 1, len(b.levels) - 1, top, top)]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > PAIRS:
            stack.append((la, lb, i[PAIRS:], j[PAIRS:]))
            i, j = i[:PAIRS], j[:PAIRS]
        roots = forest.roots()
        if la or lb:
            ra, rb = roots[at_a : at_a + len(a.sets)], roots[at_b : at_b + len(b.sets)]
            min_a, max_a = (f.reduceat(ra, a.first[la][:-1])[i] for f in (np.minimum, np.maximum))
            min_b, max_b = (f.reduceat(rb, b.first[lb][:-1])[j] for f in (np.minimum, np.maximum))
            apart = ~((min_a == max_a) & (min_b == max_b) & (min_a == min_b))
        else:
            apart = roots[at_a + i] != roots[at_b + j]
        i, j = i[apart], j[apart]
        ok = _possible(a, b, la, lb, i, j, percent)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == lb == 0:
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                u, v = forest.find(at_a + x), forest.find(at_b + y)
                if u != v:
                    s, t = a.sets[x], b.sets[y]
                    if (100 + percent) * len(np.intersect1d(s, t, assume_unique=True)) >= percent * (len(s) + len(t)):
                        forest.up[max(u, v)] = min(u, v)
                        out.append((at_a + x, at_b + y))
            continue
        down_a, down_b = la >= lb and la > 0, lb >= la and lb > 0
        kids_a, kids_b = FAN if down_a else 1, FAN if down_b else 1
        x = np.repeat(i * kids_a, kids_a * kids_b) + np.tile(np.repeat(np.arange(kids_a), kids_b), len(i))
        y = np.repeat(j * kids_b, kids_a * kids_b) + np.tile(np.tile(np.arange(kids_b), kids_a), len(j))
        la, lb = la - down_a, lb - down_b
        inside = (x < len(a.levels[la][1])) & (y < len(b.levels[lb][1]))
        if same:
            inside &= (x < y) if la == 0 else (x <= y)
        stack.append((la, lb, x[inside], y[inside]))
    return out


def _bits_for(sets: list[np.ndarray]) -> int:
    mean = sum(map(len, sets)) / max(1, len(sets))
    return int(min(1 << 14, max(1 << 8, 1 << int(np.ceil(np.log2(2 * mean + 1))))))


def tree_links(sets: list[np.ndarray], percent: int, second: int | None = None, start: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions in ``sets``) within the sets, or between the first ``second`` of them and the others."""
    bits = _bits_for(sets)
    forest = Forest(np.arange(len(sets)) if start is None else start)
    if second is None:
        tree = Tree(sets, bits)
        return traverse(tree, tree, 0, 0, forest, percent)
    a, b = Tree(sets[:second], bits), Tree(sets[second:], bits)
    return traverse(a, b, 0, second, forest, percent)


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in table["tokens"].combine_chunks()]


def _link_table(keys: list[bytes], links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([keys[x] for x, _ in links], pa.binary()), "v": pa.array([keys[y] for _, y in links], pa.binary())})


def small_block_links(placed: DataFrame, percent: int, bins: int) -> DataFrame:
    """Links inside small blocks; several blocks share a group of about TILE_TOKENS tokens."""
    def run(table: pa.Table) -> pa.Table:
        order = {x: i for i, x in enumerate(table["digest"].to_pylist())}  # each set once
        table = table.take(pa.array(list(order.values())))
        sets, block = _sets(table), table["block"].to_numpy()
        order = np.lexsort((table["n"].to_numpy(), np.array([s[0] for s in sets], np.uint64), block))  # like sets side by side
        sets, block, digests = [sets[i] for i in order.tolist()], block[order], table["digest"].to_pylist()
        keys = [digests[i] for i in order.tolist()]
        edges = np.append(np.flatnonzero(np.diff(block, prepend=block[0] ^ 1)), len(block))
        links = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if hi - lo > 1:
                links += [(lo + x, lo + y) for x, y in tree_links(sets[lo:hi], percent)]
        return _link_table(keys, links)

    dealt = placed.withColumn("bin", F.pmod(F.xxhash64("block"), F.lit(bins)))
    return dealt.select("bin", "block", "digest", "n", "tokens").groupBy("bin").applyInArrow(run, "u binary, v binary")


def tile_pair_links(tiles: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Links of tile pairs (block, band, part, band2, part2). tiles: block, band, part, digest, tokens, label."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("second", "ascending"), ("tokens", "ascending")])
        keys, label = table["digest"].to_pylist(), table["label"].to_pylist()
        second = int(np.sum(~table["second"].to_numpy()))
        if second in (0, len(keys)):
            second = None
        least: dict[bytes, int] = {}
        start = np.array([least.setdefault(x, i) for i, x in enumerate(label)], np.int64)
        return _link_table(keys, tree_links(_sets(table), percent, second, start))

    ends = pairs.withColumn("pair", F.struct("block", "band", "part", "band2", "part2"))
    one = ends.select("pair", "block", "band", "part", F.lit(False).alias("second"))
    other = ends.filter("band <> band2 or part <> part2").select(
        "pair", "block", F.col("band2").alias("band"), F.col("part2").alias("part"), F.lit(True).alias("second"))
    rows = one.unionAll(other).join(tiles, ["block", "band", "part"]).select("pair", "second", "digest", "label", "tokens")
    return rows.groupBy("pair").applyInArrow(run, "u binary, v binary")


def large_block_links(placed: DataFrame, percent: int, tile_tokens: int) -> DataFrame:
    """Links inside blocks of many tiles. A linked pair's sizes lie in the same or in neighbouring bands."""
    band = F.floor(F.log("n") / float(np.log(100 / percent)) - 1e-9)
    placed = placed.withColumn("band", band).dropDuplicates(["block", "digest"])
    parts = placed.groupBy("block", "band").agg(F.ceil(F.sum("n") / tile_tokens).alias("parts"))
    tiles = stash(placed.join(parts, ["block", "band"]).withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts"))).select(
        "block", "band", "part", "parts", "digest", "tokens"), "jaccard-tiles")
    known = cut(tiles.select("block", "band", "part", "parts").distinct())
    other = known.select("block", F.col("band").alias("band2"), F.col("part").alias("part2"))
    near = known.withColumn("band2", F.explode(F.array("band", F.col("band") + 1, F.col("band") + 2))).join(other, ["block", "band2"])
    near = near.filter("band2 > band or part2 >= part").withColumn(
        "soon", F.expr("(band = band2 and (part2 - part <= 1 or part = 0 and part2 = parts - 1)) or (band2 = band + 1 and part = 0 and part2 = 0)"))
    named = ["block", "band", "part", "band2", "part2"]
    first = cut(tile_pair_links(tiles.withColumn("label", F.col("digest")), near.filter("soon").select(*named), percent))
    roots = components(first).select(F.col("node").alias("digest"), F.col("root").alias("label"))
    marked = tiles.join(roots, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    marked = stash(marked, "jaccard-tiles")
    whole = cut(marked.groupBy("block", "band", "part").agg(F.min("label").alias("low"), F.max("label").alias("high")))
    end = whole.select("block", F.col("band").alias("band2"), F.col("part").alias("part2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    rest = near.filter("not soon").select(*named).join(whole, ["block", "band", "part"]).join(end, ["block", "band2", "part2"])
    rest = rest.filter("low <> high or low2 <> high2 or low <> low2").select(*named)
    return first.unionAll(tile_pair_links(marked, rest, percent))


def links(members: DataFrame, percent: int, tile_tokens: int = TILE_TOKENS) -> DataFrame:
    """(u, v) of digests: connects just what all links between the members connect."""
    place = cut(blocks(members, percent))
    n_nodes = place.count()
    sizes = place.select("block", "weight").distinct()
    small, large = sizes.agg(F.sum(F.when(F.col("weight") <= tile_tokens, F.col("weight"))), F.count_if(F.col("weight") > tile_tokens)).first()
    placed = members.select(node_of(F.col("digest")).alias("node"), "digest", "n", "tokens").join(
        F.broadcast(place) if n_nodes <= BROADCAST_ROWS else place, "node")
    bins = max(shuffle_width(members.sparkSession), -(-(small or 0) // tile_tokens))
    within = small_block_links(placed.filter(F.col("weight") <= tile_tokens), percent, bins)
    if not large:
        return within
    return within.unionAll(large_block_links(placed.filter(F.col("weight") > tile_tokens), percent, tile_tokens))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, tile_tokens: int = TILE_TOKENS,
) -> DataFrame:
    """One row per input row: (doc_id, n_shingles, component_id), the smallest non-null id that links reach.

    A null or empty text, or one of white space only, has the empty set and links with nothing: its
    component is its own id. Repeated rows and ids each keep their row; rows with a null id take part
    (a component of such rows only has a null component_id). Other columns are ignored; an empty table
    gives an empty result. Shingles are told apart by 64-bit hashes of their words.
    """
    spark = docs.sparkSession
    surveyed = survey(docs, id_col, text, width)
    levels = spark.sparkContext.broadcast(token_levels(surveyed))
    shared = spark.sparkContext.broadcast(shared_tokens(docs, text, width, percent, levels))
    members = candidates(docs, text, width, percent, levels, shared)
    roots = components(cut(links(members, percent, tile_tokens)))
    rows = surveyed.filter("block is null").select("doc_id", "n", "digest")
    classes = rows.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select(F.col("digest").alias("key"), "component_id")
    out = rows.join(named, F.col("digest") == F.col("key"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
