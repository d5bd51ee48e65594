r"""Secrets in whole texts: fixed patterns, and a token-efficiency test.

The patterns are base spans (assign, access, hex). The test adds spans of kind `random`: runs of letters, digits and
+ / _ = - that a tokenizer's merges hardly shorten: fewer than LEAST_RATIO characters a token. Words of any language,
numbers and names get more. Every run is measured, of whatever letters and digits. Known digests (hexadecimal parts of a
digest's length) and UUIDs are cut out of it first. A run that isn't random as a whole is measured by its parts between
/ _ = - too: neighbouring parts that aren't readable are one stretch, so a key is found behind a path or name. Identifiers
made of words (camel case, snake case, dates, versions) are left out if their letters alone are readable, as are runs
that a base span touches.

A null or empty text has no spans. Rows stand for themselves: repeated rows get equal results. Texts are whole; places
are in code points, ends exclusive.
"""

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W

#: Base kinds in order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("passw", "secret", "token", "api_key", "apikey")
LEAST_VALUE, LEAST_ACCESS, LEAST_RUN = 6, 20, 20
#: Characters a token below which a run counts as random, and the longest run that is measured in one piece.
LEAST_RATIO, PIECE = 2.0, 4096

_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{{{LEAST_RUN}}})[A-Za-z0-9+/_=-]+")
_KNOWN = re.compile(r"(?<![A-Za-z0-9+])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})(?![A-Za-z0-9+])")
#: Possessive, so that a run can be read in one way only.
_IDENTIFIER = re.compile(r"(?:[A-Z]*+[a-z]{3,}+|[A-Z]{2,}+|[0-9]++|[_/=+-]++)++\Z")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PART = re.compile(r"[^/_=-]+")
_SMALL = re.compile(r"[a-z]+")


class _Efficiency:
    _open: dict[str, "_Efficiency"] = {}

    @classmethod
    def of(cls, path: str) -> "_Efficiency":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def readable(self, run: str) -> bool:
        return self._long([run]) or bool(_IDENTIFIER.match(run)) and self._long(_WORD.findall(run))

    def _long(self, pieces: list[str]) -> bool:
        n = sum(len(self.tokens(x[i : i + PIECE])) for x in pieces for i in range(0, len(x), PIECE))
        return sum(map(len, pieces)) >= LEAST_RATIO * n

    def stretches(self, run: str) -> Iterator[tuple[int, int]]:
        """Places of what is random in a run."""
        at = 0
        for known in [*_KNOWN.finditer(run), None]:
            stop = known.start() if known else len(run)
            if stop - at >= LEAST_RUN:
                yield from self._random(run, at, stop)
            at = known.end() if known else stop

    def _random(self, run: str, at: int, stop: int) -> Iterator[tuple[int, int]]:
        """An unreadable run, without words in small letters at its ends; of a readable one, what is not in it."""
        if not self.readable(run[at:stop]):
            parts = [p for p in _PART.finditer(run, at, stop) if not _SMALL.fullmatch(p[0])]
            start, end = (parts[0].start(), parts[-1].end()) if parts else (at, stop)
            end += len(run[end:stop]) - len(run[end:stop].lstrip("="))
            yield (start, end) if end - start >= LEAST_RUN and not self.readable(run[start:end]) else (at, stop)
            return
        start = end = None
        for part in [*_PART.finditer(run, at, stop), None]:
            if part and not self.readable(part[0]):
                start, end = part.start() if start is None else start, part.end()
            elif start is not None:
                if end - start >= LEAST_RUN and not self.readable(run[start:end]):
                    yield start, end
                start = None


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of the base kinds, sorted."""
    out = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, "access", m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), 2, "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _gaps(start: int, stop: int, base: list[tuple[int, int, str, int]], at: int) -> tuple[list[tuple[int, int]], int]:
    """What base spans (from number `at` on, by start) leave of a run, and the number from which the next run has to look."""
    left = []
    while at < len(base) and base[at][3] <= start:
        at += 1
    i = at
    while i < len(base) and base[i][0] < stop:
        if base[i][0] > start:
            left.append((start, base[i][0]))
        start = max(start, base[i][3])
        i += 1
    return ([*left, (start, stop)] if start < stop else left), at


def random_spans(text: str, base: list[tuple[int, int, str, int]], efficiency: _Efficiency) -> list[tuple[int, int, str, int]]:
    """What is random in runs, base spans cut out of them."""
    out, at = [], 0
    known: list[tuple[int, int, str, int]] = []
    for span in base:  # in one another or side by side: as one
        if known and span[0] <= known[-1][3]:
            known[-1] = (*known[-1][:3], max(known[-1][3], span[3]))
        else:
            known.append(span)
    for m in _RUN.finditer(text):
        left, at = _gaps(m.start(), m.end(), known, at)
        for start, stop in left:
            out += [(start + a, len(KINDS), "random", start + b) for a, b in efficiency.stretches(text[start:stop])]
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])


def _scan(path: str, key: str, text: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        efficiency = _Efficiency.of(path)
        for batch in batches:
            for part in W.slices(batch, text, 8 << 20):
                base, every = [], []
                for x in part.column(text).to_pylist():
                    found = base_spans(x or "")
                    all_found = sorted(found + random_spans(x or "", found, efficiency))
                    base.append([{"start": s, "end": e, "kind": k} for s, _, k, e in found])
                    every.append([{"start": s, "end": e, "kind": k} for s, _, k, e in all_found])
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(base, pa.list_(_SPAN)), pa.array(every, pa.list_(_SPAN))], schema=schema)

    return run


def find_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """A row for each row of docs: key, base and spans (array of struct<start, end, kind>, by start, then kind)."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = docs.select(key, text)
    kind = docs.schema[key].dataType
    schema = pa.schema([(key, to_arrow_type(kind)), ("base", pa.list_(_SPAN)), ("spans", pa.list_(_SPAN))])
    span = "array<struct<start:bigint,end:bigint,kind:string>>"
    return docs.mapInArrow(_scan(path or default_path(), key, text, schema), f"`{key}` {kind.simpleString()}, base {span}, spans {span}")


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.`end`)), ',')")


def digest(found: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
