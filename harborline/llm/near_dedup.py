"""Near-duplicate documents by HyperMinHash.

A text's 5-word shingles are hashed to 64 bits. The top 7 bits choose one of 128 buckets; of the smallest hash in a
bucket a 16-bit register keeps the number of leading zeros and the next 10 bits. Four registers make a band; documents
that agree in any of the 32 bands are candidates. At a similarity of 0.75 all bands differ once in 200,000 pairs.
Register by register, a collision-corrected Jaccard estimate drops hopeless candidates (4 standard errors below the
threshold); the rest are confirmed on their full shingle sets, and links make components.

Equal shingle sets are one class from the start. Each bucket has a hub, the class that shares most buckets with others (in
a group of edited copies this is the one nearest to the original), and each class is compared with the greatest of its
buckets' hubs: one link a class, which leads to a class that shares more, so links are trees. Hopeful ones make loose
clusters. Buckets whose classes are in several clusters are closed: the classes outside the bucket's largest cluster are
compared by registers with all its classes, and hopeful pairs join their clusters; so whatever is hopeful and shares a
bucket is in one cluster. Clusters are confirmed on full sets in the same two steps: first the links to hubs, then in
clusters that these leave in parts, the classes outside the largest part are compared with all. Comparisons are made in
tiles of bounded size, and a tile returns a spanning forest of the parts that it found linked, not its pairs. No bucket
is cut and no partner dropped. A bucket or cluster of m classes, s of them outside its largest part, takes s * m
comparisons; only classes that resemble each other and yet aren't near-duplicates make s large.

Tables of one row a key are written before they are joined with the members of the key, so that Spark's skew join can
split the members of a hot one.

Null and empty texts have an empty set: they are linked with nothing and kept. Rows with the same doc_id are separate
rows; exact copies among them are one class. Classes are known by 64-bit sums of their hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm import words as W
from harborline.llm.store import written

SHINGLE, THRESHOLD_PCT = 5, 75
REGISTERS, BAND = 128, 4
BUCKET_BITS, MANTISSA_BITS = 7, 10
ERRORS = 4.0
#: Classes, and shingles, on a side of a tile; columns multiplied at a time.
TILE = 512
TILE_SHINGLES, COLUMNS = 750_000, 2048
#: Classes of a group that is compared together with others, and about how many of these at a time.
SMALL, SMALL_TILES = 16, 64
#: Pairs of registers that are compared at a time.
PAIRS = 50_000


def shingle_sets(data: np.ndarray, ends: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct k-word shingles, sorted; a text of fewer words has one, of all its words."""
    data = W.LOWER[data]
    starts, stops, firsts = W.find(data, ends)
    hashed = W.hashes(data, starts, stops)
    at = np.flatnonzero(W.inside(firsts, k))
    runs, owner = W.rolling(hashed, k)[at], np.searchsorted(firsts, at, "right") - 1
    count = np.diff(firsts)
    for n in range(1, k):
        if len(short := np.flatnonzero(count == n)):
            runs = np.concatenate((runs, W.rolling(hashed, n)[firsts[short]]))
            owner = np.concatenate((owner, short))
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    if len(runs):
        new = np.concatenate(([True], (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])))
        runs, owner = runs[new], owner[new]
    return owner, runs


def registers(owner: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers of n sorted sets: 0 for an empty bucket, else 1 + leading zeros and mantissa of its minimum."""
    out = np.zeros((n, REGISTERS), np.uint16)
    if len(runs):
        bucket = (runs >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])))
        low = runs[first] << np.uint64(BUCKET_BITS)
        zeros = (53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
        mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
        out[owner[first], bucket[first]] = (zeros << np.uint64(MANTISSA_BITS)) + mantissa + np.uint64(1)
    return out


def class_ids(owner: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if len(runs):
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        out[owner[first]] = W.mix(np.add.reduceat(W.mix(runs ^ np.uint64(0xA0761D6478BD642F)), first))
    return out.view(np.int64)


def _expected(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Share of registers in which disjoint sets agree: both minima have as many leading zeros and the same mantissa."""
    level = np.arange(40)
    high, low = 0.5 ** level, 0.5 ** (level + 1)

    def at_level(sizes):
        load = (sizes / REGISTERS)[:, None]
        return np.exp(-load * low) - np.exp(-load * high)

    return (at_level(sizes_a) * at_level(sizes_b)).sum(1) / 2**MANTISSA_BITS


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of rows of registers, and the number of buckets each rests on."""
    used = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    chance = _expected(sizes_a.astype(float), sizes_b.astype(float)) * REGISTERS
    used = np.maximum(used, 1)
    return np.clip((equal - chance) / np.maximum(used - chance, 1e-9), 0, 1), used


def hopeful(est: np.ndarray, used: np.ndarray, threshold: float) -> np.ndarray:
    return est >= threshold - ERRORS * np.sqrt(threshold * (1 - threshold) / used)


def _sketch(carried: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                data, ends = W.utf8(part.column(text))
                owner, runs = shingle_sets(data, ends)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in carried],
                    pa.array(np.bincount(owner, minlength=n), pa.int64()),
                    pa.array(class_ids(owner, runs, n), pa.int64()),
                    pa.array([x.tobytes() for x in registers(owner, runs, n)], pa.binary()),
                ], names=[*carried, "n_shingles", "node", "registers"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _band_keys(_matrix(batch.column("registers")))
        node = np.repeat(np.asarray(batch.column("node")), (keys != 0).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(keys[keys != 0]), pa.array(node)], names=["band", "node"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _estimates(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            est, used = estimate(_matrix(batch.column("ra")), _matrix(batch.column("rb")), np.asarray(batch.column("na")), np.asarray(batch.column("nb")))
            keep = np.flatnonzero(hopeful(est, used, threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)), pa.array(est[keep])], names=["a", "b", "estimate"])

    return run


def _band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each row; 0 where all its registers are empty."""
    salt = W.mix(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rows = np.ascontiguousarray(registers).view(np.uint64)
    return np.where(rows != 0, W.mix(rows ^ salt), np.uint64(0)).view(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node) that connect what the links (a, b) connect: one for each node but the least."""
    names, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    label = np.arange(len(names))
    while True:
        low, new = np.minimum(label[i], label[j]), label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


_NO_LINKS = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def _links(a: np.ndarray, b: np.ndarray) -> pa.Table:
    a, b = forest(a, b)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _tiles(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows sorted by tile and side, and where tiles begin (and the last ends)."""
    table = table.sort_by([(c, "ascending") for c in ("in", "p", "q", "side")]).combine_chunks()
    keys = [np.asarray(table.column(c)) for c in ("in", "p", "q")]
    return table, np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in keys]), [True])))


def _hopeful_parts(threshold: float):
    """Of tiles: a forest of the parts between which there are hopeful pairs of classes."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _NO_LINKS
        table, cuts = _tiles(table)
        side, comp, size = (np.asarray(table.column(c)) for c in ("side", "comp", "n_shingles"))
        regs = _matrix(table.column("registers"))
        left = np.flatnonzero(side == 0)
        tile = np.searchsorted(cuts, left, "right") - 1
        stop = cuts[tile + 1]
        low = stop - np.bincount(np.searchsorted(cuts, np.flatnonzero(side == 1), "right") - 1, minlength=len(cuts))[tile]
        total, at, found = np.cumsum(stop - low), 0, [(comp[:0], comp[:0])]
        while at < len(left):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
            count = (stop - low)[at:to]
            i = np.repeat(left[at:to], count)
            j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[at:to], count)
            fit = np.flatnonzero((comp[i] != comp[j]) & (np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])))
            i, j, at = i[fit], j[fit], to
            equal = ((regs[i] == regs[j]) & (regs[i] > 0)).sum(1)
            used = np.maximum(((regs[i] | regs[j]) > 0).sum(1), 1)
            fit = np.flatnonzero(hopeful(equal / used, used, threshold))  # the correction below only lowers an estimate
            i, j = i[fit], j[fit]
            good = hopeful(*estimate(regs[i], regs[j], size[i], size[j]), threshold)
            found.append(forest(comp[i[good]], comp[j[good]]))
        return _links(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _sets(text: str):
    """Packed shingle sets of whole texts; `node` tells which of several rows with one key is meant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                owner, runs = shingle_sets(*W.utf8(part.column(text)))
                n = part.num_rows
                good = np.flatnonzero(class_ids(owner, runs, n) == np.asarray(part.column("node")))
                cuts = np.searchsorted(owner, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([
                    part.column("node").take(pa.array(good)),
                    pa.array([W.pack(runs[cuts[i] : cuts[i + 1]]) for i in good], pa.binary()),
                ], names=["node", "shingles"])

    return run


def _confirmed_parts(percent: int):
    """Of tiles: a forest of the parts between which there are links, confirmed on full sets."""

    def one(side: np.ndarray, comp: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        del sets
        keep = often[column] > 1  # a shingle of one set is in no intersection
        number = np.cumsum(often > 1) - 1
        owner, column = owner[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        both = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, (at, at + COLUMNS))
            dense = np.zeros((len(comp), COLUMNS), np.float32)
            dense[owner[a:b], column[a:b] - at] = 1
            both += dense[left] @ dense[right].T
        i, j = np.nonzero((100 * both >= percent * (size[left][:, None] + size[right][None] - both)) & (comp[left][:, None] != comp[right][None]))
        return forest(comp[left[i]], comp[right[j]])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _NO_LINKS
        table, cuts = _tiles(table)
        side, comp, blobs = np.asarray(table.column("side")), np.asarray(table.column("comp")), table.column("shingles")
        found = [one(side[a:b], comp[a:b], [W.unpack(x) for x in blobs[a:b].to_pylist()]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return _links(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of the nodes in links (a, b): comp is a node of the component.

    In each round every node takes the least of itself and its neighbours, and links are rewritten between what their ends
    took, once each and without loops, so that their number falls fast. Ids are hashes: long chains in order don't occur.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-links")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), name)
        taken = least.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        labels = least if labels is None else written(labels.join(taken, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")), name)
        low, high = least.select(F.col("node").alias("a"), F.col("comp").alias("p")), least.select(F.col("node").alias("b"), F.col("comp").alias("q"))
        moved = edges.join(low, "a").join(high, "b").filter("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        edges = written(moved.distinct(), f"{name}-links")
        if edges.isEmpty():
            return labels


def _candidates(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate) of those pairs whose sizes and registers leave hope."""
    left = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    right = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    fit = pairs.join(left, "a").join(right, "b").filter(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb"))
    return fit.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimates(threshold), "a bigint, b bigint, estimate double")


def _tiled(rows: DataFrame, groups: int) -> DataFrame:
    """rows, with `first` and `second` (numbers of tiles) and the sides that they are on, once for each tile p, q and side:
    side 0 of all tiles in a row, side 1 of all in a column. `bin` has one tile, or about SMALL_TILES of the small ones."""
    of = lambda n, seed: f"cast(pmod(xxhash64(node, {seed}), {n}) as int)"
    left = f"if(is_first, transform(sequence(0, second - 1), q -> struct({of('first', 1)} as p, q as q, 0 as side)), array())"
    right = f"if(is_second, transform(sequence(0, first - 1), p -> struct(p as p, {of('second', 2)} as q, 1 as side)), array())"
    placed = rows.withColumn("__to", F.expr(f"explode(concat({left}, {right}))")).select("*", "__to.*")
    bin_ = F.when(F.col("small"), F.pmod(F.xxhash64("in"), F.lit(groups // SMALL_TILES + 1))).otherwise(F.xxhash64("in", "p", "q"))
    return placed.withColumn("bin", bin_).select("bin", "in", "p", "q", "side", "node", "comp")


def _apart(members: DataFrame, name: str, rows: int) -> DataFrame:
    """members (in, node, comp, weight), of those groups `in` whose classes are in several parts, in tiles: on
    the first side the classes outside the largest part, on the second all. A tile has at most `rows` in weight a side."""
    parts = members.groupBy("in", "comp").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    main = F.max(F.struct("n", "comp"))["comp"]
    several = parts.groupBy("in").agg(main.alias("main"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum("weight").alias("total"),
                                      F.max(F.struct("n", "comp", "weight"))["weight"].alias("inside")).filter("low < high")
    outside, small = F.ceil((F.col("total") - F.col("inside")) / rows), F.col("total") <= SMALL
    several = written(several.select("in", "main", outside.cast("int").alias("first"), F.ceil(F.col("total") / rows).cast("int").alias("second"), small.alias("small")), name)
    sides = members.join(several, "in").withColumns({"is_first": F.col("comp") != F.col("main"), "is_second": F.lit(True)})
    return _tiled(sides, several.count())


def _relabelled(labels: DataFrame, parts: DataFrame) -> DataFrame:
    """labels (node, comp) after the parts (a, b) have been joined."""
    joined = components(parts)
    return labels.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("into")), "comp", "left").select("node", F.coalesce("into", "comp").alias("comp"))


def _clusters(bands: DataFrame, classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, comp) of the classes in loose clusters, and the hopeful links (a, b) to hubs."""
    shared = bands.groupBy("node").agg(F.sum("members").alias("shared"))
    hubs = written(bands.join(shared, "node").groupBy("band").agg(F.max(F.struct("shared", "node")).alias("hub")), "hubs")
    star = bands.select("band", "node").join(hubs, "band").groupBy("node").agg(F.max("hub")["node"].alias("hub")).filter("node <> hub")
    hoped = written(_candidates(star.select(F.col("node").alias("a"), F.col("hub").alias("b")), classes, threshold), "candidates").select("a", "b")
    members = bands.select(F.col("band").alias("in"), "node")
    loose = written(members.select("node").distinct().join(components(hoped), "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "loose")
    labelled = members.join(loose, "node").withColumn("weight", F.lit(1))
    sent = _apart(labelled, "open-buckets", TILE).join(classes.select("node", "n_shingles", "registers"), "node")
    more = written(sent.groupBy("bin").applyInArrow(_hopeful_parts(threshold), "a bigint, b bigint").distinct(), "open-parts")
    return written(_relabelled(loose, more), "clusters"), hoped


def _confirmed(clusters: DataFrame, hoped: DataFrame, classes: DataFrame, docs: DataFrame, key: str, hashed: str, text: str, percent: int) -> DataFrame:
    """(node, comp) of the classes that confirmed links within clusters connect."""
    several = clusters.groupBy("comp").agg(F.count("*").alias("members")).filter("members > 1").select(F.col("comp").alias("in"))
    clusters = written(clusters.withColumnRenamed("comp", "in").join(written(several, "several"), "in"), "several-members")
    named = clusters.join(classes.select("node", "n_shingles", "first_key", "first_hash"), "node")
    wanted = named.select("node", F.col("first_key").alias(key), F.col("first_hash").alias(hashed))
    # the key alone may be that of many classes, or null
    texts = docs.join(wanted, docs[key].eqNullSafe(wanted[key]) & (docs[hashed] == wanted[hashed])).select(wanted["node"], docs[text])
    sets = written(texts.mapInArrow(_sets(text), "node bigint, shingles binary"), "sets", compression="none")
    # the links to hubs: a hub is the first side of its tiles, its classes are the second
    weight = F.greatest(F.lit(1.0), F.col("n_shingles") * (TILE / TILE_SHINGLES))
    size = classes.select(F.col("node").alias("a"), weight.alias("weight"))
    tiles = hoped.join(size, "a").groupBy(F.col("b").alias("in")).agg(F.sum("weight").alias("total"))
    tiles = written(tiles.select("in", F.lit(1).alias("first"), F.ceil(F.col("total") / TILE).cast("int").alias("second"), (F.col("total") <= SMALL).alias("small")), "hub-tiles")
    ends = hoped.select(F.col("b").alias("in"), F.col("a").alias("node"), F.lit(False).alias("is_first"), F.lit(True).alias("is_second"))
    ends = ends.join(tiles, "in").unionByName(tiles.withColumns({"node": F.col("in"), "is_first": F.lit(True), "is_second": F.lit(False)}))
    sent = _tiled(ends.withColumn("comp", F.col("node")), tiles.count()).join(sets, "node")
    sure = written(sent.groupBy("bin").applyInArrow(_confirmed_parts(percent), "a bigint, b bigint"), "sure-links")
    # what these leave in parts
    labels = written(clusters.join(components(sure), "node", "left").select("in", "node", F.coalesce("comp", "node").alias("comp")), "sure-parts")
    weighed = labels.join(classes.select("node", "n_shingles"), "node").select("in", "node", "comp", weight.alias("weight"))
    sent = _apart(weighed, "open-clusters", TILE).join(sets, "node")
    more = written(sent.groupBy("bin").applyInArrow(_confirmed_parts(percent), "a bigint, b bigint").distinct(), "more-links")
    return written(_relabelled(labels.select("node", "comp"), more), "confirmed")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold_pct: int = THRESHOLD_PCT, extra: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs: key, extra columns, n_shingles, component_id (least key reachable), node (class of
    equal sets)."""
    carried = [key, *extra]
    docs = docs.select(*carried, text)
    hashed = native.name(docs, "__text_hash")
    docs = docs.withColumn(hashed, F.xxhash64(text))
    sketched = [*carried, hashed]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in sketched)
    threshold = threshold_pct / 100
    sketches = written(docs.mapInArrow(_sketch(sketched, text), f"{kinds}, n_shingles bigint, node bigint, registers binary"), "sketches", compression="none")
    full = sketches.filter("n_shingles > 0")
    one = F.struct(F.col(key).alias("key"), F.col(hashed).alias("hash"))
    least = F.coalesce(F.min(F.when(F.col(key).isNotNull(), one)), F.min(one))
    classes = full.groupBy("node").agg(least.alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    classes = written(classes.select("node", F.col("first.key").alias("first_key"), F.col("first.hash").alias("first_hash"), "n_shingles", "registers"), "classes", compression="none")
    every = classes.select("node", "registers").mapInArrow(_bands, "band bigint, node bigint")
    counts = written(every.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    bands = written(every.join(counts, "band"), "bands")
    clusters, hoped = _clusters(bands, classes, threshold)
    comps = _confirmed(clusters, hoped, classes, docs, key, hashed, text, threshold_pct)
    first = classes.select("node", "first_key")
    of_linked = comps.join(first, "node").groupBy("comp").agg(F.min("first_key").alias("least"))
    ids = first.join(comps, "node", "left").join(of_linked, "comp", "left").select("node", F.coalesce("least", "first_key").alias("component_id"))
    return sketches.select(*carried, "n_shingles", "node").join(ids.withColumnRenamed("node", "class"), (F.col("node") == F.col("class")) & (F.col("n_shingles") > 0), "left").select(
        *carried, "n_shingles", F.coalesce("component_id", key).alias("component_id"), "node")


def without_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """The rows of docs that stay: of each component the document with the least key, of repeated rows one; all rows
    without words."""
    at, hashed, n, row = (native.name(docs, x) for x in ("__key", "__hash", "__n", "__row"))
    named = docs.withColumns({at: F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null")), hashed: F.xxhash64(text)})
    found = near_duplicates(named, key=key, text=text, threshold_pct=threshold_pct, extra=(at, hashed))
    stay = found.filter(F.col(key).eqNullSafe(F.col("component_id"))).groupBy(at, hashed).agg(F.max("n_shingles").alias(n))
    same = Window.partitionBy(at, hashed).orderBy(n)
    numbered = named.join(stay, [at, hashed]).withColumn(row, F.row_number().over(same))
    return numbered.filter((F.col(row) == 1) | (F.col(n) == 0)).select(docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
