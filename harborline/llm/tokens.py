"""Token ids of whole texts, piece by piece.

The tokenizers used here drop white space before they merge, so a text's ids are those of its words, split at ASCII white
space, one after another. Where the tokenizer also lowers case and splits letters, single digits and other marks (PRE_SPLIT),
words are cut further, at places where it always splits: around ASCII digits, and between letters (of ASCII and Latin-1) and
other ASCII marks (but not behind an apostrophe, which may start a contraction). A slice that holds a special token is cut into words
only. Known pieces are found by 64-bit hashes and compared byte by byte; new ones are tokenized many in a call and kept up
to a fixed number.
"""

import json
import os
import re

import numpy as np
import pyarrow as pa

from harborline.llm import words as W

#: Fixed value: the splitting pattern that the cuts into pieces rest on.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SEPARATOR = "\x01"
JOINED, KNOWN = 256, 500_000
SLOTS, PROBES = 1 << 22, 6

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 97) & (_BYTES <= 122)).astype(np.uint8)
_DIGIT = ((_BYTES >= 48) & (_BYTES <= 57)).astype(np.uint8)
#: Classes of lower-cased bytes: 0 white, 1 letter, 2 digit, 3 other ASCII, 4 beyond ASCII, 5 apostrophe; and 6, both bytes
#: of a Latin-1 letter: LEAD, then anything but the signs of multiplication and division.
_CLASS = np.select([W.WHITE, _LETTER == 1, _DIGIT == 1, _BYTES >= 128, _BYTES == 39], [0, 1, 2, 4, 5], 3).astype(np.uint8)
LEAD, SIGNS = 0xC3, (0x97, 0xB7)
#: Whether a piece starts between two classes.
_STARTS = np.zeros((8, 8), bool)
_STARTS[0, 1:] = True
_STARTS[2, 1:] = _STARTS[1:, 2] = True
_STARTS[1, [3, 5]] = _STARTS[6, [3, 5]] = _STARTS[3, [1, 6]] = True
#: For bytes.translate: lower case, class, and start by 8 * class before + class.
_LOWER, _CLASSES = W.LOWER.tobytes(), _CLASS.tobytes()
_STARTED = np.resize(_STARTS.ravel(), 256).astype(np.uint8).tobytes()
#: Pieces that are one token run each.
_ONE_RUN = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+|[\x00-/:-@\[-`{-\x7f]+|[\x00-\x7f]").fullmatch


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of words under a tokenizer file of the tokenizers library."""

    _open: dict[str, "WordIds"] = {}

    @classmethod
    def of(cls, path: str) -> "WordIds":
        """One for each Python worker, so that later tasks know the pieces of earlier ones."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        mark = self.encode([SEPARATOR], add_special_tokens=False)[0].ids
        self.mark = mark[0] if len(mark) == 1 else None
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        suffix = given["model"].get("end_of_word_suffix")
        self.special = [x["content"].encode() for x in given["added_tokens"]]
        self.cut = bool(suffix) and PRE_SPLIT in json.dumps(given["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\") and "Lowercase" in json.dumps(given["normalizer"])
        self.last = np.array([(tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(tokenizer.get_vocab_size())]) if self.cut else None
        self._forget()

    def _forget(self) -> None:
        self.n, self.used = 0, 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin, self.length, self.hash = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.uint64)
        self.bytes, self.bytes_used = np.zeros(1 << 14, np.uint64), 0
        self.bytes_at, self.bytes_length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.slot = np.full(SLOTS, -1, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of known pieces; -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for probe in range(PROBES):
            at = self.slot[(hashes[open_] + np.uint64(probe)) & np.uint64(SLOTS - 1)]
            hit = (at >= 0) & (self.hash[at] == hashes[open_])
            out[open_[hit]] = at[hit]
            open_ = open_[(at >= 0) & ~hit]
            if not len(open_):
                break
        return out

    def _same(self, at: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Whether words are, byte by byte, the known pieces whose numbers are given."""
        length = stops - starts
        out = self.bytes_length[at] == length
        short = np.flatnonzero(out & (length <= 8))
        out[short] = self.bytes[self.bytes_at[at[short]]] == W.first_eight(data, starts[short], length[short])
        some = np.flatnonzero(out & (length > 8))
        found, count = W.eights(data, starts[some], stops[some])
        ends = np.cumsum(count)
        equal = found == self.bytes[np.repeat(self.bytes_at[at[some]] - ends + count, count) + np.arange(len(found))]
        if len(some):
            out[some] = np.logical_and.reduceat(equal, ends - count)
        return out

    def _append(self, hashes: np.ndarray, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers that the pieces get."""
        n, more = self.n, len(hashes)
        stops = np.cumsum([len(x) for x in words])
        raw, count = W.eights(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], stops[:-1])), stops)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.bytes_used + len(raw) > len(self.bytes):
            self.bytes = np.concatenate((self.bytes, np.zeros_like(self.bytes)))
        while n + more > len(self.begin):
            for name in ("begin", "length", "hash", "bytes_at", "bytes_length"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        self.flat[self.used : self.used + len(ids)] = ids
        self.bytes[self.bytes_used : self.bytes_used + len(raw)] = raw
        here = slice(n, n + more)
        self.begin[here] = self.used + np.cumsum(lengths) - lengths
        self.length[here], self.hash[here] = lengths, hashes
        self.bytes_at[here] = self.bytes_used + np.cumsum(count) - count
        self.bytes_length[here] = [len(x) for x in words]
        left = numbers = np.arange(n, n + more)
        for probe in range(PROBES):  # a piece that finds no free slot stays unknown
            at = ((self.hash[left] + np.uint64(probe)) & np.uint64(SLOTS - 1)).astype(np.int64)
            free = np.flatnonzero(self.slot[at] < 0)
            self.slot[at[free]] = left[free]
            left = left[self.slot[at] != left]
        self.n, self.used, self.bytes_used = n + more, self.used + len(ids), self.bytes_used + len(raw)
        return numbers

    def _add(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Tokenizes new pieces and gives them numbers. Those that are one token run each need no separator, their last
        tokens are marked."""
        pieces, numbers = [x.decode() for x in words], np.zeros(len(words), np.int64)
        plain, parted, own = [], [], []
        for i, x in enumerate(pieces):
            if self.cut and _ONE_RUN(x):
                plain.append(i)
            else:
                (own if self.mark is None or SEPARATOR in x else parted).append(i)
        for group, between in ((plain, " "), (parted, f" {SEPARATOR} ")):
            if group:
                texts = [between.join([pieces[i] for i in group[a : a + JOINED]]) + between.rstrip(" ") for a in range(0, len(group), JOINED)]
                ids = np.concatenate([np.asarray(x.ids, np.uint32) for x in self.encode(texts, add_special_tokens=False)])
                ends = np.flatnonzero(self.last[ids] if group is plain else ids == self.mark)
                lengths = np.diff(ends, prepend=-1) - (group is parted)
                if len(lengths) != len(group):
                    raise ValueError("the tokenizer doesn't split as its file says")
                numbers[group] = self._append(hashes[group], [words[i] for i in group], ids if group is plain else ids[ids != self.mark], lengths)
        if own:
            each = [np.asarray(x.ids, np.uint32) for x in self.encode([pieces[i] for i in own], add_special_tokens=False)]
            numbers[own] = self._append(hashes[own], [words[i] for i in own], np.concatenate(each), np.array([len(x) for x in each]))
        return numbers

    def _pieces(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes (lower-cased where pieces are cut), and starts, stops and each text's first piece."""
        raw = data.tobytes()
        if not self.cut or not raw or any(x in raw for x in self.special):
            return data, *W.find(data, ends)
        as_given, raw = data, bytearray(raw.translate(_LOWER))
        data, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_CLASSES), np.uint8)
        marked = np.flatnonzero((as_given[:-1] != data[:-1]) & (data[1:] >= 128))
        data[marked] = as_given[marked]  # the tokenizer composes letters and marks before it lowers their case
        lead = np.flatnonzero(data == LEAD)
        lead = lead[~np.isin(data[lead + 1], SIGNS)]
        kind[lead] = kind[lead + 1] = 6
        edges = ends[(ends > 0) & (ends < len(data))]
        starts = np.ones(len(data), bool)
        starts[1:] = np.frombuffer((kind[:-1] << 3 | kind[1:]).tobytes().translate(_STARTED), bool)
        starts[edges] = True
        white = kind == 0
        starts &= ~white
        stop = starts | white
        stop[edges] = True
        stops = np.append(np.flatnonzero(stop), len(data))
        at = np.flatnonzero(starts[stops[:-1]])
        begins = stops[at]
        return data, begins, stops[at + 1], np.searchsorted(begins, ends, "left")

    def _distinct(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A word of each kind, and the kind of each word. Words of equal hash are compared byte by byte."""
        _, one, each = np.unique(hashes, return_index=True, return_inverse=True)
        like = one[each]
        if np.array_equal(stops - starts, (stops - starts)[like]):
            found, count = W.eights(data, starts, stops)
            first = np.cumsum(count) - count
            if np.array_equal(found, found[np.repeat(first[like] - first, count) + np.arange(len(found))]):
                return one, each
        raw, number = data.tobytes(), {}
        each = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)), np.int64, len(starts))
        return np.unique(each, return_index=True)[1], each

    def _places(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each piece's number among the known ones, and each text's first piece."""
        data, ends = W.utf8(column)
        data, starts, stops, firsts = self._pieces(data, ends)
        hashes = W.hashes(data, starts, stops)
        if self.n > KNOWN:
            self._forget()
        found = self._find(hashes)
        known = np.flatnonzero(found >= 0)
        found[known[~self._same(found[known], data, starts[known], stops[known])]] = -1
        new = np.flatnonzero(found < 0)
        if len(new):
            one, each = self._distinct(data, hashes[new], starts[new], stops[new])
            raw, one = data.tobytes(), new[one]
            found[new] = self._add(hashes[one], [raw[a:b] for a, b in zip(starts[one].tolist(), stops[one].tolist(), strict=True)])[each]
        return found, firsts

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        at, firsts = self._places(column)
        total = np.concatenate(([0], np.cumsum(self.length[at])))
        return total[firsts[1:]] - total[firsts[:-1]]

    def ids(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each with the end id behind it, and the number of ids of each."""
        at, firsts = self._places(column)
        lengths = self.length[at]
        stops = np.cumsum(lengths)
        source = np.repeat(self.begin[at] - stops + lengths, lengths) + np.arange(stops[-1] if len(stops) else 0)
        total = np.concatenate(([0], stops))[firsts]
        return np.insert(self.flat[source], total[1:], end), np.diff(total) + 1
