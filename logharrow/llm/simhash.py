"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits. Two that differ in at most `distance` bits agree in some block of bits up to
distance // blocks bits, if the bits are cut into `blocks` blocks. Each block gets a covering code as its anchors: the
perfect Hamming code of length 15 (7 in a shorter block) on its first bits, of covering radius 1, and every pattern of the rest. A fingerprint is
at home at the anchor that its block decodes to, and is replicated to every anchor that a block within
distance // blocks flips would be at home at; so of two near fingerprints, one's home is among the other's anchors.
Only fingerprints that meet at an anchor are compared.

similar_rows() compares fingerprints of texts whose shingle sets share some least hashes, as its texts are too far apart in bits
for anchors that stay small while the corpus grows. It takes the pairs so found as candidates only and links those whose
shingle sets are similar enough.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.components import components
from logharrow.llm.scratch import lean, materialise, release
from logharrow.llm.words import mix

HAMMING = (15, 7)
#: Rows at one anchor beyond which its comparisons are split over several tasks.
HOT_ANCHOR = 20_000
#: Rows at anchors that a task compares, about 50 bytes each.
TASK_ROWS = 1_000_000
#: Pairs compared at once.
PAIRS = 1 << 19
#: Partners of one row at an anchor beyond which it and they are compared by their sketches.
CROWD = 8
#: 64-bit words of a sketch, and bits in which two may differ: at similarity 0.8 it is 310 on average (deviation 16).
SKETCH_WORDS, SKETCH_DISTANCE = 32, 375
#: Bytes of a sketch by which crowds meet. Texts of similarity 0.8 agree in a byte in 27 %, so all of these differ in 0.05 %.
BANDS = 24
#: Groups of least hashes by which classes meet, and hashes in a group. Texts of similarity 0.8 agree in none in 0.02 %, texts of
#: similarity 0.1 in some in 0.16 %, so the rows that meet grow with the corpus and its similar texts, not with its square.
MEETINGS, LEAST = 16, 4
#: Odd factors, each of which puts the hashes into another order.
ORDERS = np.random.default_rng(64).integers(0, 2**63, MEETINGS * LEAST, np.uint64) * np.uint64(2) + np.uint64(1)
#: Words of 64 bits of the filter that texts pass before they are joined: a broadcast of some MB for any input.
FILTER_WORDS = 1 << 18


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of `width` words, repeats included; of the whole if there are fewer words."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z only, and blanks are exactly 0x20 and 0x09 to 0x0D
    if not words:
        return np.empty(0, np.uint64)
    line, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts))


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; no hash: 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """MEETINGS numbers of a set of hashes: each is of the least hashes in LEAST orders. Two sets share the least hash of an order
    with the probability of their similarity."""
    least = np.full(MEETINGS * LEAST, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 12):
        np.minimum(least, (hashes[at : at + (1 << 12), None] * ORDERS).min(0), out=least)
    out = np.zeros(MEETINGS, np.uint64)
    for column in least.reshape(MEETINGS, LEAST).T:
        out = mix(out ^ column)
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, second: bool = False, sets: bool = False, least: bool = False) -> DataFrame:
    """doc_id, h (hash of the text), fp and more (64 bits each, as signed longs) of each row, written to the scratch folder. Null text is as empty.

    more: a second fingerprint over the shingles' hashes mixed anew, or 0 without `second`. sets: repeats of a shingle
    within a text count once. least: a column of that name holds least_hashes().
    """

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            fps, more, leasts = [], [], []
            for t in batch.column("text").cast("binary").to_pylist():
                hashes = shingle_hashes(t or b"", width)
                hashes = np.unique(hashes) if sets else hashes
                fps.append(simhash(hashes))
                more.append(simhash(mix(hashes)) if second else 0)
                leasts.append(least_hashes(hashes).tobytes() if least else None)
            found = [batch.column("doc_id"), batch.column("h"), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fps, more)), *([pa.array(leasts, pa.binary())] if least else [])]
            yield pa.RecordBatch.from_arrays(found, ["doc_id", "h", "fp", "more", *(["least"] if least else [])])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return materialise(rows.mapInArrow(lean(scan), "doc_id long, h long, fp long, more long" + ", least binary" * least), "fingerprints")


def block_edges(blocks: int) -> list[tuple[int, int]]:
    """First bit and length of each block of the 64."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:]))))


def decode(bits: np.ndarray, size: int) -> np.ndarray:
    """Nearest codeword: the syndrome of the code's bits is the place of the bit to flip."""
    syndrome = np.zeros(len(bits), np.uint64)
    for i in range(next(n for n in HAMMING if n <= size)):
        syndrome ^= ((bits >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1)), np.uint64(0))
    return bits ^ flip


def anchors(fps: np.ndarray, distance: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each fingerprint all (row, anchor, is home). An anchor's number holds the block's number above bit 58."""
    rows, keys, homes = [], [], []
    for k, (first, size) in enumerate(block_edges(blocks)):
        part = (fps >> np.uint64(first)) & np.uint64((1 << size) - 1)
        masks = [sum(1 << i for i in c) for n in range(distance // blocks + 1) for c in combinations(range(size), n)]
        home = decode(part, size)
        near = np.sort(np.stack([decode(part ^ np.uint64(m), size) for m in masks]), axis=0)
        first_seen = np.vstack([np.ones((1, len(fps)), bool), near[1:] != near[:-1]])
        which, row = np.nonzero(first_seen)
        code = near[which, row]
        rows.append(row)
        keys.append(code | np.uint64(k << 58))
        homes.append(code == home[row])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def bands_of(sketches: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each of the first bytes of the sketches as an anchor, as anchors() gives them; every row is at home at all of its own."""
    first = sketches.view(np.uint8)[:, :bands].astype(np.uint64) | (np.arange(bands, dtype=np.uint64) << np.uint64(58))
    return np.repeat(np.arange(len(first)), bands), first.ravel(), np.ones(first.size, bool)


def groups_of(least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's numbers by least_hashes() as anchors, as anchors() gives them; every row is at home at all of its own."""
    keys = least & np.uint64((1 << 58) - 1) | (np.arange(least.shape[1], dtype=np.uint64) << np.uint64(58))
    return np.repeat(np.arange(len(keys)), keys.shape[1]), keys.ravel(), np.ones(keys.size, bool)


def label(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reduce links to stars: (root, node) pairs with root < node that connect the same nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        after = root.copy()
        np.minimum.at(after, root[x], low)
        np.minimum.at(after, root[y], low)
        after = after[after]
        if (after == root).all():
            keep = root != np.arange(len(nodes))
            return nodes[root[keep]], nodes[keep]
        root = after


def met_before(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], lesser: np.ndarray, block: np.ndarray, reach: int, blocks: int) -> np.ndarray:
    """Whether pairs that meet in a block, where the left one is at home, also meet earlier: in a lower block, or in this one at
    the home of the right one if that has the lesser id. left, right: fp and more; their blocks count from 0 on. So each pair
    has one meeting of all that is the first, and every task knows it from the two fingerprints."""
    found = np.zeros(len(block), bool)
    for k, (first, size) in enumerate(block_edges(blocks) * 2):
        x, y = ((side[k // blocks] >> np.uint64(first)) & np.uint64((1 << size) - 1) for side in (left, right))
        home = decode(np.arange(1 << size, dtype=np.uint64), size)
        open_ = np.flatnonzero(~found & (block >= k))
        for a, b, at in ((x, y, open_[block[open_] > k]), (y, x, open_[(block[open_] > k) | ~lesser[open_]])):
            for n in range(reach // blocks + 1):
                for flips in combinations(range(size), n):
                    found[at] |= home[b[at] ^ np.uint64(sum(1 << i for i in flips))] == home[a[at]]
    return found


def _near(keys: np.ndarray, ids: np.ndarray, fps: np.ndarray, more: np.ndarray, homes: np.ndarray, distance: int, in_all: int, parts: np.ndarray, nearest: int | None = None, crowd: int | None = None, dense: np.ndarray | None = None, sketches: np.ndarray | None = None, once=None):
    """Pairs (lesser, greater) of near rows of different parts that meet at an anchor; at most PAIRS pairs are held at once.

    With nearest, each home row gives only its so many nearest partners. With crowd, a home row that has more partners is
    given as a pair with itself; without nearest it gives no other pair then, and partners that are not dense are given like
    it. once(order) makes a function that tells which pairs go, by left and right. With sketches, pairs whose sketches are too far go.
    """
    order = np.lexsort((~homes, keys))  # homes first within an anchor
    keys, ids, fps, more, homes, parts = keys[order], ids[order], fps[order], more[order], homes[order], parts[order]
    sketches = sketches if sketches is None else sketches[order]
    dense = dense if dense is None else dense[order]
    again = once(order) if once is not None else None
    marked: list[np.ndarray] = []
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    n_homes = np.add.reduceat(homes.astype(np.int64), starts)
    # one line of work for each home: it meets all rows of its anchor
    group = np.repeat(np.arange(len(starts)), n_homes)
    lines = starts[group] + np.arange(len(group)) - np.repeat(np.cumsum(n_homes) - n_homes, n_homes)
    work = np.cumsum(sizes[group])
    at = 0
    while at < len(lines):
        until = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIRS, "right")))
        n = sizes[group[at:until]]
        left = np.repeat(lines[at:until], n)
        right = np.repeat(starts[group[at:until]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        near = np.flatnonzero(np.bitwise_count(fps[left] ^ fps[right]) <= distance)
        left, right = left[near], right[near]
        far = np.bitwise_count(fps[left] ^ fps[right]).astype(np.int64) + np.bitwise_count(more[left] ^ more[right])
        near = np.flatnonzero((far <= in_all) & (parts[left] != parts[right]))
        if nearest is not None and len(near):
            near = near[np.lexsort((ids[right[near]], far[near], left[near]))]
            mine = left[near]
            first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
            n = np.diff(np.append(first, len(mine)))
            turn = np.arange(len(mine)) - np.repeat(first, n)
            near = near[turn < nearest]
            if crowd is not None:
                marked.append(ids[mine[first[n > crowd]]])
        if again is not None and len(near):
            near = near[~again(left[near], right[near])]
        if sketches is not None and len(near):
            cuts = np.array_split(near, -(-len(near) // (PAIRS // len(sketches[0]))))
            near = np.concatenate([c[np.bitwise_count(sketches[left[c]] ^ sketches[right[c]]).sum(1, dtype=np.int64) <= SKETCH_DISTANCE] for c in cuts])
        if crowd is not None and nearest is None and len(near):
            _, line, n = np.unique(left[near], return_inverse=True, return_counts=True)
            many = n[line] > crowd
            partners = right[near[many]]
            marked.append(np.unique(ids[np.concatenate((left[near[many]], partners if dense is None else partners[~dense[partners]]))]))
            near = near[~many]
        x, y = ids[left[near]], ids[right[near]]
        if len(x):
            yield np.minimum(x, y), np.maximum(x, y)
        at = until
    if any(map(len, marked)):
        marks = np.unique(np.concatenate(marked))
        yield marks, marks


def _compare(pairs) -> tuple[np.ndarray, np.ndarray]:
    """The links of _near(), reduced to stars."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for x, y in pairs:
        found.append(label(x, y))
        held += len(found[-1][0])
        if held > PAIRS:
            found = [label(*(np.concatenate(z) for z in zip(*found)))]
            held = len(found[0][0])
    return label(*(np.concatenate(z) for z in zip(*found))) if found else (np.empty(0, np.int64),) * 2


def near_links(nodes: DataFrame, distance: int, in_all: int, blocks: int, reach: int | None = None, nearest: int | None = None, crowd: int | None = None, bands: int = 0) -> DataFrame:
    """Links a < b of node ids that connect the same nodes as all links would.

    nodes: node, fp, more; one row for each distinct (fp, more). Two are linked if their fp differ in at most `distance`
    bits and fp and more together in at most `in_all`. With reach, all links are given, some repeatedly, of the pairs
    that meet: fp and more both have anchors, built for `reach` bits of each. Two surely meet if fp and more together
    differ in at most 2 * blocks * (reach // blocks + 1) - 1 bits, and beyond that if any block still is near enough. Then
    nodes may have a column `part`: nodes of one part make no pair. With nearest, a node gives only so many partners at
    each of its own anchors, the nearest ones. With crowd, a node with more partners at one of its own anchors is given as
    a = b; without nearest it makes no pair there, and these partners are given as a = b as well, but for those that a column
    `dense` (long, not 0) says are known: such a node would be given again at each of its some hundred anchors. Where nodes
    have a column `sketch`, pairs need near sketches as well, and each is given once, where it meets first. With bands, they
    meet where one of so many first bytes of their sketches is equal instead: as many rows a node, and no others. Without them,
    nodes that have a column `least` meet where one of its numbers is equal, not at anchors.
    """
    carried = ["node", "fp", "more", *(c for c in ("part", "dense", "sketch") if c in nodes.columns)]
    spark = nodes.sparkSession

    by_least = "least" in nodes.columns and not bands

    def words_in(table, column):
        return np.frombuffer(b"".join(table.column(column).to_pylist()), np.uint64).reshape(len(table), -1)

    def keys_of(batch):
        if bands:
            return bands_of(words_in(batch, "sketch"), bands)
        if by_least:
            return groups_of(words_in(batch, "least"))
        one, two = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "more"))
        if reach is None:
            return anchors(one, distance, blocks)
        (r1, k1, h1), (r2, k2, h2) = anchors(one, reach, blocks), anchors(two, reach, blocks)
        return np.concatenate((r1, r2)), np.concatenate((k1, k2 + np.uint64(blocks << 58))), np.concatenate((h1, h2))

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, len(batch), 1 << 14):
                _, keys, homes = keys_of(batch.slice(at, 1 << 14))
                keys, which = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(which)), pa.array(np.bincount(which, homes).astype(np.int64))], ["key", "n", "homes"])

    # an anchor is listed if it has over HOT_ANCHOR rows: at most (rows / HOT_ANCHOR) of them
    per_key = nodes.mapInArrow(count, "key long, n long, homes long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("homes").alias("homes"))
    listed = F.array_sort(F.collect_list(F.when(F.col("n") > HOT_ANCHOR, F.struct("key", "homes", "n"))))
    sizes = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), listed.alias("hot")).first()
    tiles = [np.array([max(-(-r[c] // HOT_ANCHOR), 1) for r in sizes["hot"]], np.int64) for c in ("homes", "n")]
    hot = spark.sparkContext.broadcast((np.array([r["key"] for r in sizes["hot"]], np.int64), *tiles))

    def spread(batches):
        """Nodes at their anchors; at a hot one, homes are dealt into s tile rows and all into t columns, and a tile (from 1 on) pairs them."""
        import pyarrow as pa

        for batch in batches:
            for at in range(0, len(batch), 1 << 14):
                part = batch.slice(at, 1 << 14)
                row, keys, homes = keys_of(part)
                tile = np.zeros(len(row), np.int64)
                hot_keys, tile_rows, tile_columns = hot.value
                if len(hot_keys):
                    which = np.minimum(np.searchsorted(hot_keys, keys.view(np.int64)), len(hot_keys) - 1)
                    full = hot_keys[which] == keys.view(np.int64)
                    salt = part.column("node").to_numpy().view(np.uint64)[row] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                    s, t = tile_rows[which], tile_columns[which]
                    in_row, in_column = (salt % s.astype(np.uint64)).astype(np.int64), (salt % t.astype(np.uint64)).astype(np.int64)
                    # as partner of the homes in each tile row, and as home in its own tile row
                    as_partner, as_home = np.flatnonzero(full), np.flatnonzero(full & homes)
                    i, mine = _counted(s[as_partner]), np.repeat(as_partner, s[as_partner])
                    j, own = _counted(t[as_home]), np.repeat(as_home, t[as_home])
                    rest = np.flatnonzero(~full)
                    tile = np.concatenate((tile[rest], i * t[mine] + in_column[mine] + 1, in_row[own] * t[own] + j + 1))
                    homes = np.concatenate((homes[rest], np.zeros(len(mine), bool), np.ones(len(own), bool)))
                    row, keys = (np.concatenate((x[rest], x[mine], x[own])) for x in (row, keys))
                own = [part.column(c).take(pa.array(row)) for c in carried]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tile), *own, pa.array(homes)], ["key", "tile", *carried, "home"])

    def compare(batches):
        import pyarrow as pa

        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        key, tile, fp, more = (table.column(c).to_numpy().view(np.uint64) for c in ("key", "tile", "fp", "more"))
        node = table.column("node").to_numpy()
        home = table.column("home").to_numpy()
        sketches = words_in(table, "sketch") if "sketch" in carried else None
        dense = table.column("dense").to_numpy() != 0 if "dense" in carried else None

        def once(order):
            one, two, ids, block = fp[order], more[order], node[order], (key[order] >> np.uint64(58)).astype(np.int64)
            if bands:  # both are at home here: the lesser one's line gives the pair, and of a tile its homes with its partners
                first, own = np.ascontiguousarray(sketches.view(np.uint8)[:, :bands])[order], (home & (tile > 0))[order]
                return lambda x, y: (ids[x] > ids[y]) | own[y] | ((first[x] == first[y]).argmax(1) < block[x])
            return lambda x, y: met_before((one[x], two[x]), (one[y], two[y]), ids[x] < ids[y], block[x], reach, blocks)

        pairs = _near(key + tile * np.uint64(0x632BE59BD9B4E019), node, fp, more, home, distance, in_all, table.column("part").to_numpy() if "part" in carried else node, nearest, crowd, dense, sketches, once if "sketch" in carried else None)
        for a, b in [_compare(pairs)] if reach is None else pairs:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    in_task = TASK_ROWS // (8 if "sketch" in carried else 1)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sizes["rows"] // in_task))
    met = nodes.mapInArrow(lean(spread), "key long, tile long, " + "".join(f"{c} {'binary' if c == 'sketch' else 'long'}, " for c in carried) + "home boolean").repartition(n, "key", "tile")
    return met.mapInArrow(lean(compare), "a long, b long")


def _counted(n: np.ndarray) -> np.ndarray:
    """0 .. n[k] - 1 for each k, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4, blocks: int = 3, in_all: int | None = None) -> DataFrame:
    """Fingerprint and near-duplicate component of each row: doc_id, fp long, component_id (least id reachable).

    Two rows are linked if their 64-bit fingerprints differ in at most `distance` bits; with in_all, a second fingerprint
    is taken and the two together may differ in at most that many of 128. Equal fingerprints are one node, so copies
    never meet each other. Null, empty and blank texts have fingerprint 0, linked as any other. Rows that repeat an id
    keep a row each. A null id names no component: a row with a null id takes part if a row with an id has its
    fingerprint, else its component is null. Extra columns are ignored, whatever their names. An empty table gives an
    empty result. A higher `blocks` makes fewer and fuller anchors (its comparisons grow faster with the corpus), a
    lower one more replicas and emptier anchors, for larger corpora.
    """
    docs = fingerprints(df, id_col, text_col, width, in_all is not None)
    nodes = docs.where("doc_id is not null").groupBy("fp", "more").agg(F.min("doc_id").alias("node"))
    nodes = materialise(nodes.repartition(docs.sparkSession.sparkContext.defaultParallelism), "nodes")
    roots = components(near_links(nodes, distance, distance if in_all is None else in_all, blocks)).withColumnRenamed("root", "component_id")
    known = nodes.join(roots, "node", "left").select("fp", "more", F.coalesce("component_id", "node").alias("component_id"))
    return docs.join(known, ["fp", "more"], "left").select("doc_id", "fp", "component_id")


#: Bits in which candidates may differ, in the first fingerprint and in both, and the reach of the anchors. Sets of
#: similarity 0.8 differ in 9.7 of 64 bits on average (deviation 2.9) and in 19.4 of 128 (4.1): the bounds are four
#: deviations away. Of two sets that differ in 15 % of the bits some block of the ten is within one bit in 99 %.
CANDIDATE, CANDIDATE_IN_ALL, REACH, CANDIDATE_BLOCKS = 22, 36, 9, 5
#: Partners of a class at each of its own anchors that are looked at first, of classes at home there. Most groups are one class
#: after that, and then only pairs of different classes are looked at, all of them and at all anchors: a group of n near
#: copies makes about n pairs, not n squared.
NEAREST = 2


def shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """From node and text: node, shingles (distinct hashes)."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [np.unique(shingle_hashes(t or b"", width)).view(np.int64) for t in batch.column("text").cast("binary").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return rows.mapInArrow(lean(scan), "node long, shingles array<long>")


def sketches(sets: DataFrame) -> DataFrame:
    """node and sketch: SKETCH_WORDS further fingerprints of the shingle sets."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for shingles in batch.column("shingles"):
                h = shingles.values.to_numpy().view(np.uint64)
                found.append(np.array([simhash(mix(h ^ mix(np.full(1, k + 1, np.uint64)))) for k in range(SKETCH_WORDS)], np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "sketch"])

    return sets.mapInArrow(lean(scan), "node long, sketch binary")


def may_be_among(rows: DataFrame, keys: list[str], wanted: DataFrame, named: list[str]) -> DataFrame:
    """The rows whose keys may be among those of wanted, and few others: what a join with it needs not shuffle stays behind.

    A hash of the keys takes one of 64 * FILTER_WORDS bits. The more bits are set, the more other rows pass; none is lost.
    """

    def place(columns: list[str]) -> tuple:
        bit = F.pmod(F.xxhash64(*columns), F.lit(64 * FILTER_WORDS))
        return F.shiftright(bit, 6), F.pmod(bit, F.lit(64)).cast("int")

    word, bit = place(named)
    bits = wanted.select(word.alias("filter_word"), F.expr("1L").alias("one"), bit.alias("bit")).groupBy("filter_word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("filter_bits"))
    word, bit = place(keys)
    found = rows.withColumn("filter_word", word).join(F.broadcast(bits), "filter_word")
    return found.where(F.getbit("filter_bits", bit) == 1).select(rows.columns)


def similar_rows(df: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that repeat another: doc_id and h (hash of the text) of all but the first row of each component.

    Rows of equal fingerprints (128 bits over the distinct shingles of `width` words) are one class. Classes are linked
    if the exact Jaccard similarity of the shingle sets of their first rows is at least `similarity`; the fingerprints
    only find the pairs that are looked at, among texts that share some least hashes, and where many meet helped by sketches. The bounds above are for 0.8 or more. Rows are ordered by id and h, a null id
    comes last. Rows that are equal in both are one. All texts without words are copies of each other.
    """
    docs = fingerprints(df, id_col, text_col, width, second=True, sets=True, least=True)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    nodes = docs.groupBy("fp", "more").agg(F.min(row).alias("first"), F.min("least").alias("least")).withColumn("node", F.xxhash64("fp", "more"))
    nodes = materialise(nodes.repartition(docs.sparkSession.sparkContext.defaultParallelism), "nodes")
    texts = df.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("j"), F.col(text_col).alias("text"))
    sets, links, roots = None, None, None

    def sets_of(wanted: DataFrame, known: DataFrame | None) -> DataFrame:
        """known, and the shingles of these nodes' first rows."""
        wanted = wanted if known is None else wanted.join(known, "node", "left_anti")
        wanted = materialise(wanted.join(nodes, "node").select("node", "first.doc_id", "first.h"), "wanted")
        those = may_be_among(texts, ["i", "j"], wanted, ["doc_id", "h"]).join(wanted, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("j") == F.col("h")))
        new = materialise(shingle_sets(those.select("node", "text").dropDuplicates(["node"]), width), "shingle-sets")
        return new if known is None else known.unionByName(new)

    dense = None
    for nearest in (NEAREST, None):
        here = nodes.select("node", "fp", "more", "least")
        if roots is not None:
            here = here.join(roots.withColumnRenamed("root", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
            here = here.join(dense.withColumn("dense", F.lit(1).cast("long")), "node", "left").withColumn("dense", F.coalesce("dense", F.lit(0).cast("long")))
        pairs = materialise(near_links(here, CANDIDATE, CANDIDATE_IN_ALL, CANDIDATE_BLOCKS, 0 if nearest else REACH, nearest, CROWD).distinct(), "candidates")
        marks, pairs = pairs.where("a = b").select(F.col("a").alias("node")), pairs.where("a < b")
        if nearest:
            dense = marks  # partners are fewer once parts are known: who is in a crowd then is among these, or a partner of one
        else:
            if not marks.isEmpty():
                crowded = materialise(marks.unionByName(dense).distinct(), "crowded")
                here = here.drop("dense", "least")
                # crowds of texts that 128 bits can't tell from similar ones: only what passes their sketches is a candidate
                sets = sets_of(crowded, sets)
                there = materialise(here.join(crowded, "node").join(sketches(sets.join(crowded, "node", "left_semi")), "node"), "sketched")
                among = near_links(there, CANDIDATE, CANDIDATE_IN_ALL, CANDIDATE_BLOCKS, REACH, bands=BANDS)
                pairs = materialise(pairs.unionByName(among).distinct(), "candidates")
        # the shingles of the classes' first rows, only for classes that have a candidate
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), sets)
        found = materialise(similar_pairs(pairs, sets, similarity), "similar-pairs")
        links = found if links is None else links.unionByName(found)
        roots = components(links)
        release(df.sparkSession)

    known = materialise(nodes.join(roots, "node", "left").select("fp", "more", "first", F.coalesce("root", "node").alias("root")), "classes")
    firsts = materialise(known.groupBy("root").agg(F.min("first").alias("least")), "class-firsts")
    known = known.join(firsts, "root").select("fp", "more", "least")
    return docs.drop("least").join(known, ["fp", "more"]).where(row != F.col("least")).select("doc_id", "h").distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have at least this Jaccard similarity."""
    sizes = sets.select("node", F.size("shingles").alias("n"))
    left, right = (sizes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    may = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb")).select("a", "b")
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    judged = may.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return judged.where(F.col("both") >= similarity * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b")
