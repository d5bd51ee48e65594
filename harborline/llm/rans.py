"""Token ids in blocks by a static range asymmetric numeral system (rANS).

One frequency table (2**20 slots), counted over all documents, is shared by all blocks. Documents are range-sorted by
doc_id and tokenized once, into a table of plain ids (16 bits each, where a block's ids fit) with each part's counts, then
encoded; a block holds whole documents and about BLOCK ids, and can be decoded by itself. Its ids are dealt to LANES
interleaved states of 64 bits, which share one stream of 32-bit words. Every STRIDE steps a checkpoint keeps the states,
the place in the stream and the CRC-32 of the ids that follow, so the parts of a block can be decoded in parallel too.

Files, in one folder, from which all can be decoded in any session: the Parquet tables frequencies (id, freq), settings
(one row: scale, stride, end_id, doc_id_type) and, written last, blocks (part, block, first: ids before it in its part,
doc_ids, lengths, payload); part numbers rise with doc_id. Payload, little-endian: b"RANS", lanes u32, ids u64, words u64, checkpoints u32;
for each checkpoint its place u64, CRC u32, states u64 * lanes; then the words u32.

A null or empty text has the end id alone. Rows with equal doc_id are separate documents, ordered by a hash of the text.
No rows give no blocks. A document of any length is one block at least; blocks never cut a document.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm import words as W
from harborline.llm.store import shared_dir, written
from harborline.llm.tokens import WordIds, default_path

SCALE, LANES, BLOCK, STRIDE = 20, 512, 1 << 18, 256
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
PART_BYTES = 24 << 20


class Table:
    """Which id owns which of the 2**scale slots."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, scale: int = SCALE) -> None:
        self.scale = scale
        self.ids, self.freq = ids.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.freq)[:-1])) if len(ids) else self.freq

    @classmethod
    def counted(cls, ids: np.ndarray, counts: np.ndarray) -> "Table":
        """Every id that occurs owns a slot at least."""
        room = (1 << SCALE) - len(ids)
        if room < 0:
            raise ValueError(f"more than {1 << SCALE} distinct ids")
        total = max(1, int(counts.sum()))
        freq = 1 + (counts.astype(np.float64) / total * room).astype(np.int64)
        if len(freq):
            freq[np.argmax(freq)] += (1 << SCALE) - freq.sum()
        return cls(ids, freq)

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        if not hasattr(self, "place"):
            self.place = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 1, np.int32)
            self.place[self.ids] = np.arange(len(self.ids))
        return self.place[ids]

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, stride: int = STRIDE) -> bytes:
    n = len(ids)
    steps = -(-n // lanes)
    symbols = table.symbols(ids)
    freq, start = table.freq[symbols], table.start[symbols]
    limit = freq << np.uint64(63 - SCALE)
    x = np.full(lanes, LOW, np.uint64)
    out, marks, words = [], [], 0
    for t in range(steps - 1, -1, -1):
        a, b = t * lanes, min(n, (t + 1) * lanes)
        f, y = freq[a:b], x[: b - a]
        full = y >= limit[a:b]
        spilled = y[full].astype(np.uint32)
        y = np.where(full, y >> _WORD, y)
        q = y // f
        x[: b - a] = (q << np.uint64(SCALE)) + (y - q * f) + start[a:b]
        out.append(spilled)
        words += len(spilled)
        if t % stride == 0:
            crc = zlib.crc32(ids[a : (t + stride) * lanes].astype("<u4").tobytes())
            marks.append((words, crc, x.astype("<u8").tobytes()))
    stream = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    head = struct.pack("<4sIQQI", b"RANS", lanes, n, words, len(marks))
    return head + b"".join(struct.pack("<QI", words - w, crc) + states for w, crc, states in marks[::-1]) + stream.astype("<u4").tobytes()


def decode(payload: bytes, table: Table, owners: np.ndarray, stride: int = STRIDE, parts: range | None = None) -> np.ndarray:
    """The ids of a payload, or of some of the stretches between its checkpoints; raises if a checksum differs."""
    magic, lanes, n, words, count = struct.unpack_from("<4sIQQI", payload)
    if magic != b"RANS":
        raise ValueError("not a block")
    size = 12 + 8 * lanes
    scale, last = np.uint64(table.scale), np.uint64((1 << table.scale) - 1)
    stream = np.frombuffer(payload, "<u4", words, 28 + count * size).astype(np.uint64)
    out = []
    for k in parts if parts is not None else range(count):
        at, crc = struct.unpack_from("<QI", payload, 28 + k * size)
        x = np.frombuffer(payload, "<u8", lanes, 40 + k * size).astype(np.uint64)
        a, stop = k * stride * lanes, min(n, (k + 1) * stride * lanes)
        found = np.empty(stop - a, np.int32)
        for i in range(a, stop, lanes):
            y = x[: min(lanes, stop - i)]
            slot = y & last
            symbol = owners[slot]
            y = table.freq[symbol] * (y >> scale) + slot - table.start[symbol]
            need = np.flatnonzero(y < LOW)
            y[need] = (y[need] << _WORD) | stream[at : at + len(need)]
            at += len(need)
            x[: len(y)] = y
            found[i - a : i - a + len(symbol)] = symbol
        ids = table.ids[found]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"stretch {k} of a block is damaged")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _tokenize(path: str, key: str, text: str, end: int, schema: pa.Schema):
    """Sorted documents to blocks of plain ids; a part's last block tells how often each id occurs in the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordIds.of(path), TaskContext.get().partitionId()
        block, first, last, total = 0, 0, None, np.zeros(0, np.int64)
        keys, lengths, ids, held = [], [], [], 0

        def closed() -> dict:
            nonlocal total
            whole = np.concatenate(ids)
            seen = np.bincount(whole)
            if len(seen) > len(total):
                seen, total = total, seen
            total[: len(seen)] += seen
            return {"part": part, "block": block, "first": first, "doc_ids": keys, "lengths": np.concatenate(lengths).tolist(), "payload": _plain(whole)}

        for batch in batches:
            for some in W.slices(batch, text):
                found, each = words.ids(some.column(text), end)
                ends = np.cumsum(each)
                names, at, low = some.column(key).to_pylist(), 0, 0
                while at < len(each):  # as many documents as fill the block
                    to = min(len(each), int(np.searchsorted(ends, low + BLOCK - held)) + 1)
                    keys += names[at:to]
                    lengths.append(each[at:to])
                    ids.append(found[low : ends[to - 1]])
                    held += int(ends[to - 1]) - low
                    at, low = to, int(ends[to - 1])
                    if held >= BLOCK:
                        if last:
                            yield pa.RecordBatch.from_pylist([last], schema=schema)
                        last = closed()
                        block, first = block + 1, first + held
                        keys, lengths, ids, held = [], [], [], 0
        if keys:
            if last:
                yield pa.RecordBatch.from_pylist([last], schema=schema)
            last = closed()
        if last:
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_pylist([last | {"seen": seen.tolist(), "times": total[seen].tolist()}], schema=schema)

    return run


def _plain(ids: np.ndarray) -> bytes:
    return ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _ids(raw, n: int) -> np.ndarray:
    """What _plain was given, n ids."""
    return np.frombuffer(raw, "<u2" if raw.size == 2 * n else "<u4").astype(np.uint32)


def _encode(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Table(*table.value)
        for batch in batches:
            sizes = [int(np.asarray(each.values).sum()) for each in batch.column("lengths")]
            packed = [encode(_ids(raw.as_buffer(), n), shared) for raw, n in zip(batch.column("payload"), sizes, strict=True)]
            at = batch.schema.get_field_index("payload")
            yield batch.set_column(at, "payload", pa.array(packed, pa.binary()))

    return run


def _decode(key: str, table, stride: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Table(*table.value)
        owners = shared.owners()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = decode(row.column("payload")[0].as_py(), shared, owners, stride)
                lengths = np.asarray(row.column("lengths")[0].values, np.int64)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([row.column("part")[0].as_py()] * len(lengths), pa.int32()),
                    row.column("doc_ids")[0].values,
                    pa.array(row.column("first")[0].as_py() + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.int64()),
                ], schema=schema)

    return run


def write_ids(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = 2, to: str | None = None) -> tuple[SparkSession, str]:
    """The session and the new folder `to` (by default in the shared folder) that holds all that read_ids needs."""
    path, spark = path or default_path(), docs.sparkSession
    to = to or f"{shared_dir(spark).rstrip('/')}/harborline/rans-{uuid.uuid4().hex}"
    docs = docs.select(F.col(key), native.whole(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number: how many ranges
    parts = max(12, size // PART_BYTES + 1)
    order = docs.repartitionByRange(int(parts), F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first(), F.xxhash64("text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(_arrow(kind))), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
    columns = _columns(kind)
    counts = [("seen", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
    plain = written(order.mapInArrow(_tokenize(path, key, "text", end, pa.schema([*schema, *counts])), f"{columns}, seen array<bigint>, times array<bigint>"), "plain-ids", compression="zstd")
    each = plain.select(F.inline(F.arrays_zip(F.col("seen").alias("id"), F.col("times").alias("n"))))
    counted = each.groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()
    table = Table.counted(counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64))
    rows = spark.createDataFrame(pa.table({"id": pa.array(table.ids, pa.int64()), "freq": pa.array(table.freq, pa.int64())}), "id bigint, freq bigint")
    rows.write.parquet(f"{to}/frequencies")  # its size is bounded by the vocabulary
    spark.createDataFrame([(SCALE, STRIDE, end, kind)], _SETTINGS).write.parquet(f"{to}/settings")
    shared = spark.sparkContext.broadcast((table.ids, table.freq))
    plain.drop("seen", "times").mapInArrow(_encode(shared), columns).write.options(compression="none").parquet(f"{to}/blocks")
    return spark, to


_SETTINGS = "scale int, stride int, end_id int, doc_id_type string"


def _columns(kind: str) -> str:
    return f"part int, block int, first bigint, doc_ids array<{kind}>, lengths array<bigint>, payload binary"


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def read_ids(spark: SparkSession, path: str, *, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, from the blocks in a folder of write_ids."""
    scale, stride, _, kind = spark.read.schema(_SETTINGS).parquet(f"{path}/settings").first()
    rows = spark.read.schema("id bigint, freq bigint").parquet(f"{path}/frequencies").orderBy("id").toPandas()
    shared = spark.sparkContext.broadcast((rows["id"].to_numpy(np.int64), rows["freq"].to_numpy(np.int64), scale))
    blocks = spark.read.schema(_columns(kind)).parquet(f"{path}/blocks")
    schema = pa.schema([("part", pa.int32()), (key, _arrow(kind)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    ends = F.col("first") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = blocks.select("part", ends.alias("end")).groupBy("part").agg(F.max("end").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each part
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    found = blocks.select("part", "first", "doc_ids", "lengths", "payload").mapInArrow(_decode(key, shared, stride, schema), f"part int, `{key}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, "part").select(key, (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
