"""Words and rolling hashes of whole texts, vectorised over the UTF-8 bytes of Arrow columns."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The white space that ends a word.
WHITE_BYTES = (9, 10, 11, 12, 13, 32)
WHITE = np.isin(np.arange(256), WHITE_BYTES)
LOWER = np.arange(256, dtype=np.uint8) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint8)

#: Odd multipliers: of places in a word, and of the polynomial hash over words' hashes.
BYTE_BASE = 0x9DDFEA08EB382D69
WORD_BASE = 0xC6A4A7935BD1E995
SLICE_BYTES = 2 << 20
CHUNK_BYTES = 1 << 20
#: Masks of the first 0 to 8 bytes of 8.
_UPTO = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with whole rows and about `limit` bytes of text, so that work arrays stay small."""
    _, ends = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Table:
    """Powers of an odd number and of its inverse modulo 2**64, extended on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            self.up, self.down = _powers(self.base, self.n), _powers(self.inverse, self.n)
        return self.up, self.down


_WORDS = _Table(WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def find(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and each text's first word's number (one more entry than texts)."""
    solid = ~WHITE[data]
    begins, closes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    edges = ends[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = solid[edges]
    closes[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, ends, "left")


def hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; different seeds give independent hashes.

    A word is read in pieces of 8 bytes. Each is mixed with a number that its place in the word alone gives, and the
    results are added up; as mixing isn't linear, sums of words that repeat each other's pieces have nothing in common.
    """
    length = (stops - starts).astype(np.int64)
    pieces = (length + 7) >> 3
    eights = _eights(data)
    out = np.zeros(len(starts), np.uint64)
    at, last = 0, np.cumsum(pieces)
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + CHUNK_BYTES // 8, "right")))
        if (n := int(pieces[at])) > CHUNK_BYTES // 8:  # one very long word
            for k in range(0, n, CHUNK_BYTES // 8):
                place = np.arange(k, min(n, k + CHUNK_BYTES // 8))
                out[at : at + 1] += _mixed(eights, starts[at] + 8 * place, length[at] - 8 * place, place, seed).sum(dtype=np.uint64)
            to = at + 1
        else:
            some, ends = pieces[at:to], np.cumsum(pieces[at:to])
            place = np.arange(ends[-1]) - np.repeat(ends - some, some)
            mixed = _mixed(eights, np.repeat(starts[at:to], some) + 8 * place, np.repeat(length[at:to], some) - 8 * place, place, seed)
            out[at:to] = mixed if len(mixed) == to - at else np.add.reduceat(mixed, ends - some)
        at = to
    return mix(out + length.astype(np.uint64) * np.uint64(BYTE_BASE))


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on."""
    return np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))


def eights(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words, 8 in a number and zeros behind a word's end, and how many numbers each word has."""
    length = (stops - starts).astype(np.int64)
    pieces = (length + 7) >> 3
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return _eights(data)[np.repeat(starts, pieces) + 8 * place] & _UPTO[np.minimum(np.repeat(length, pieces) - 8 * place, 8)], pieces


def first_eight(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words of at most 8 bytes as numbers."""
    return _eights(data)[starts] & _UPTO[length]


def _mixed(eights: np.ndarray, at: np.ndarray, left: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """Pieces of 8 bytes (what lies behind a word's end is cut off), mixed with their place in the word."""
    found = eights[at] & _UPTO[np.minimum(left, 8)]
    return mix(mix(found ^ mix((place + 1).astype(np.uint64) * np.uint64(BYTE_BASE) + np.uint64(seed))) + np.uint64(WORD_BASE))


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; entry i is the run that starts at word i (over text ends too: callers drop those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[:n] + np.uint64(k))


def inside(firsts: np.ndarray, k: int) -> np.ndarray:
    """Mask over rolling(): the run lies in one text. firsts: from find()."""
    n = int(firsts[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    out = np.ones(n, bool)
    bad = firsts[1:-1]
    for back in range(1, k):
        at = bad - back
        out[at[(at >= 0) & (at < n)]] = False
    return out


def pack(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit numbers as byte planes of their differences, compressed."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def join(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, firsts: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    lengths = np.where(keep, stops - starts + 1, 0)
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = total[firsts]
    owner = np.repeat(np.flatnonzero(keep), lengths[keep])
    source = starts[owner] + np.arange(total[-1]) - total[owner]
    out = np.where(source < stops[owner], data[np.minimum(source, max(len(data) - 1, 0))], 32).astype(np.uint8)
    buffer = out.tobytes()
    texts = [buffer[a : max(a, b - 1)].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return pa.array(texts, pa.string())
