"""Substring dedup by fixed-block anchors.

Every ANCHOR-th run of ANCHOR words of a document is a reference block; the blocks don't overlap. A window of WINDOW >=
2 * ANCHOR - 1 words contains a whole block, wherever it starts, so of two equal windows each is hit by a block of the
other: all rolling runs of ANCHOR words are probed against the blocks, and only windows around a hit are extended.
The extension compares 128-bit hashes of whole windows (two hashes of other words' hashes; at 10**13 windows two differing
ones share both with a probability of 1e-13); runs of windows that recur are the maximal exact repeats.

Neither blocks nor pairs of places are joined row by row. Documents are dealt into small groups by a hash of id and text;
a group sends its sorted distinct hashes, packed, to each range of hashes, and gets those back that count. A passage
that a third of all documents hold is one hash for each group, so no key is hot. Groups and ranges are bounded by memory, so
messages grow as groups * ranges until each holds a few hashes only, and in proportion to the input from there on.

Nulls and empty texts have no words. Rows with the same doc_id are separate documents. Texts of any length are whole.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W
from harborline.llm.store import written

WINDOW, ANCHOR = 35, 18
#: Seed of the words' second hash.
SECOND = 0x5851F42D4C957F2D
#: Text bytes in a group of documents, and hashes in a range; up to LARGER times as many where the input is large.
GROUP_BYTES, RANGE_HASHES, LARGER = 4 << 20, 2_000_000, 8
_SENT = "g int, part int, blob binary"


def _texts(table: pa.Table, text: str):
    data, ends = W.utf8(table.column(text))
    starts, stops, firsts = W.find(data, ends)
    return data, starts, stops, firsts, W.hashes(data, starts, stops)


def _cut(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted 64-bit hashes pass from one of `parts` equal ranges to the next."""
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, bounds), [len(hashes)])).astype(np.int64)


def _send(g: int, cuts: np.ndarray, *values: np.ndarray) -> pa.Table:
    """A blob for each range that cuts leave anything for, of one hash or two."""
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "g": pa.array([g] * len(full), pa.int32()),
        "part": pa.array(full, pa.int32()),
        "blob": pa.array([_blob(*(x[cuts[i] : cuts[i + 1]] for x in values)) for i in full], pa.binary()),
    })


def _blob(high: np.ndarray, low: np.ndarray | None = None) -> bytes:
    return W.pack(high) if low is None else low.tobytes() + W.pack(high) + len(high).to_bytes(8, "little")


def _pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted pairs of a blob of two hashes. The second lies in front, 8 bytes each; the first's number stands behind."""
    n = int.from_bytes(blob[-8:], "little")
    return W.unpack(blob[8 * n : -8]), np.frombuffer(blob, np.uint64, n)


def _all_pairs(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of many blobs, sorted."""
    each = [_pairs(x) for x in blobs]
    if not each:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    high, low = (np.concatenate(x) for x in zip(*each, strict=True))
    order = np.lexsort((low, high))
    return high[order], low[order]


def _returned(blobs: pa.ChunkedArray) -> np.ndarray:
    got = [W.unpack(x) for x in blobs.to_pylist()]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)


def _among(high: np.ndarray, low: np.ndarray, found_high: np.ndarray, found_low: np.ndarray) -> np.ndarray:
    """Which pairs are among sorted ones."""
    out, at, left = np.zeros(len(high), bool), np.searchsorted(found_high, high), np.arange(len(high))
    while len(left):
        left = left[at[left] < len(found_high)]
        left = left[found_high[at[left]] == high[left]]
        hit = found_low[at[left]] == low[left]
        out[left[hit]] = True
        left = left[~hit]
        at[left] += 1
    return out


def _is_in(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(found, values), len(found) - 1)
    return found[at] == values


def _short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of an anchor's hash that are compared; a chance hit only costs an extension."""
    return hashes >> np.uint64(64 - bits)


def _probes(parts: int, bits: int, anchor: int, text: str):
    """A group's distinct anchor hashes; two low bits: it is a block's, it starts twice or more in the group."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, starts, _, firsts, hashed = _texts(table, text)
        valid = np.flatnonzero(W.inside(firsts, anchor))
        runs = _short(W.rolling(hashed, anchor)[valid], bits)
        owner = np.searchsorted(firsts, valid, "right") - 1
        block = (valid - firsts[owner]) % anchor == 0
        order = np.argsort(runs)
        runs, block = runs[order], block[order]
        at = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1]))) if len(runs) else np.zeros(0, np.int64)
        twice = np.diff(np.append(at, len(runs))) > 1
        is_block = np.logical_or.reduceat(block, at) if len(at) else np.zeros(0, bool)
        runs = runs[at]
        flagged = (runs << np.uint64(2)) | (is_block.astype(np.uint64) << np.uint64(1)) | twice.astype(np.uint64)
        return _send(key[0].as_py(), _cut(runs << np.uint64(64 - bits), parts), flagged)

    return send


def _hits(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of each group's anchors in this range: those that are some block's and start in two places or more."""
    sent = [W.unpack(x) for x in table.column("blob").to_pylist()]
    every = np.concatenate(sent)
    runs = every >> np.uint64(2)
    order = np.argsort(runs)
    runs, every = runs[order], every[order]
    at = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    flags = np.bitwise_or.reduceat(every & np.uint64(3), at)
    twice = (np.diff(np.append(at, len(runs))) > 1) | (flags & np.uint64(1) > 0)
    found = runs[at][twice & (flags & np.uint64(2) > 0)]
    del every, runs, order
    each = [x >> np.uint64(2) for x in sent]
    return _answer(key, table, [(x[_is_in(x, found)],) for x in each])


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table, back: list[tuple[np.ndarray, ...]]) -> pa.Table:
    full = [i for i, x in enumerate(back) if len(x[0])]
    return pa.table({
        "g": pa.array([table.column("g")[i].as_py() for i in full], pa.int32()),
        "part": pa.array([key[0].as_py()] * len(full), pa.int32()),
        "blob": pa.array([_blob(*back[i]) for i in full], pa.binary()),
    })


def _around(hit: np.ndarray, window: int, anchor: int, n: int) -> np.ndarray:
    """Windows that contain a run that was hit. hit: mask over runs of `anchor` words; n: number of windows."""
    total = np.concatenate(([0], np.cumsum(hit)))
    at = np.arange(n)
    return total[at + window - anchor + 1] > total[at]


def _candidates(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, firsts: np.ndarray, hashed: np.ndarray, hits: np.ndarray, bits: int, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the windows around hits."""
    ok = W.inside(firsts, window)
    if not len(ok) or not len(hits):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hit = _is_in(_short(W.rolling(hashed, anchor), bits), hits)
    at = np.flatnonzero(ok & _around(hit, window, anchor, len(ok)))
    return at, W.rolling(hashed, window)[at], W.rolling(W.hashes(data, starts, stops, SECOND), window)[at]


def _runs(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted pairs: which differ from the one before, and which are equal to a neighbour."""
    after = np.zeros(len(high), bool)
    after[1:] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    before = np.zeros(len(high), bool)
    before[:-1] = after[1:]
    return ~after, after | before


def _extend(parts: int, bits: int, window: int, anchor: int, text: str):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table, hits: pa.Table) -> pa.Table:
        _, high, low = _candidates(*_texts(table, text), _returned(hits.column("blob")), bits, window, anchor)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new, _ = _runs(high, low)
        return _send(key[0].as_py(), _cut(high[new], parts), high[new], low[new])

    return send


def _shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Windows that two groups or more have sent."""
    sent = table.column("blob").to_pylist()
    high, low = _all_pairs(sent)
    new, twice = _runs(high, low)
    high, low = high[new & twice], low[new & twice]
    back = []
    for blob in sent:
        a, b = _pairs(blob)
        found = _among(a, b, high, low)
        back.append((a[found], b[found]))
    return _answer(key, table, back)


def _removed(bits: int, window: int, anchor: int, key_col: str, text: str):
    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, hits: pa.Table, shared: pa.Table) -> pa.Table:
        data, starts, stops, firsts, hashed = _texts(table, text)
        at, high, low = _candidates(data, starts, stops, firsts, hashed, _returned(hits.column("blob")), bits, window, anchor)
        order = np.lexsort((low, high))
        again = np.zeros(len(at), bool)
        again[order] = _runs(high[order], low[order])[1]
        again |= _among(high, low, *_all_pairs(shared.column("blob").to_pylist()))
        edges = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edges, at[again], 1)
        np.add.at(edges, at[again] + window, -1)
        gone = np.cumsum(edges)[:-1] > 0
        steps = np.diff(gone.astype(np.int8), prepend=0, append=0)
        bound = firsts[1:-1]
        split = bound[(bound > 0) & (bound < len(gone))]
        split = np.unique(split[gone[split] & gone[split - 1]])
        begins = np.sort(np.concatenate((np.flatnonzero(steps == 1), split)))
        closes = np.sort(np.concatenate((np.flatnonzero(steps == -1), split)))
        owner = np.searchsorted(firsts, begins, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(begins - firsts[owner], pa.int64()), pa.array(closes - firsts[owner], pa.int64())], ["first_word", "end_word"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, firsts), pa.int32()), spans)
        count = np.concatenate(([0], np.cumsum(gone)))
        return pa.table({
            key_col: table.column(key_col).combine_chunks(),
            "n_words": pa.array(np.diff(firsts), pa.int64()),
            "n_removed": pa.array(count[firsts[1:]] - count[firsts[:-1]], pa.int64()),
            "repeats": lists,
            "kept_text": W.join(data, starts, stops, firsts, ~gone),
        })

    return remove


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """A row for each row of docs: key, n_words, n_removed, repeats (removed spans of words, end exclusive), kept_text.

    A word goes if a window of `window` words that covers it starts at another place too, in any document.
    """
    if window < 2 * anchor - 1:
        raise ValueError("a window must contain a whole block, wherever it starts: window >= 2 * anchor - 1")
    docs = docs.select(F.col(key), F.col(text))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0  # one number: how finely to deal
    larger = min(LARGER, max(1, math.isqrt(size >> 30) // 2))
    groups = max(24, size // (GROUP_BYTES * larger) + 1)
    parts = max(24, size // 6 // (RANGE_HASHES * larger) + 1)
    bits = min(62, 16 + size.bit_length())  # two others are flags
    dealt = docs.withColumn("g", F.pmod(F.xxhash64(key, text), F.lit(groups)).cast("int"))
    # the exchange by g is made once a job; a retry deals every row to the same group again
    sent = dealt.groupBy("g").applyInArrow(_probes(parts, bits, anchor, text), _SENT)
    hits = written(sent.groupBy("part").applyInArrow(_hits, _SENT), "anchor-hits", compression="none")
    full = dealt.groupBy("g").cogroup(hits.groupBy("g")).applyInArrow(_extend(parts, bits, window, anchor, text), _SENT)
    shared = written(full.groupBy("part").applyInArrow(_shared, _SENT), "shared-windows", compression="none")
    tagged = hits.withColumn("kind", F.lit(0)).unionByName(shared.withColumn("kind", F.lit(1)))
    remove = _removed(bits, window, anchor, key, text)

    def last(k: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        kind = np.asarray(found.column("kind"))
        return remove(k, table, found.filter(pa.array(kind == 0)), found.filter(pa.array(kind == 1)))

    kind = docs.schema[key].dataType.simpleString()
    return dealt.groupBy("g").cogroup(tagged.groupBy("g")).applyInArrow(
        last, f"`{key}` {kind}, n_words bigint, n_removed bigint, repeats array<struct<first_word:bigint,end_word:bigint>>, kept_text string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
