"""Ranked lexical search with a hierarchical max tree over ranges of documents.

`build` makes an index: documents, in order of their keys, are cut into ranges of at most RANGE_DOCS, and each range gets a tree
whose leaves are documents with the impacts of their terms; every node above holds, for each term, the greatest impact
below it. Impacts hold all of the score but a query's weights, so the sum of weights times maxima bounds the score of each
document below a node, and at a leaf is the score.

`search` takes queries in blocks of at most BLOCK_TERMS terms, the only rows that travel to all tasks. First the roots alone
are read, to find each query's most promising range; that is opened and gives the score that a tenth document has at
least. Then the other ranges are read, and each task opens, best bound first, the nodes of all its ranges whose bound is no
less than the query's tenth score so far, its own or the given one. Nodes of an equal bound are opened too, as a document
below may win a tie by its key. So a task returns at most k documents a query, and their ranking is one small window.

With `queries`, an index only holds their terms (found by a map of 2**MAP_BITS bits, whatever their number; a few other terms
slip through and do no harm); lengths and document counts are those of all documents. Words of a text are told apart by
64-bit hashes when they are counted; terms travel and meet queries as strings.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A to Z lower-cased. A null or
empty text has none, and isn't counted. Rows with equal or null keys are separate documents; a null key comes last among equal
scores. Queries with equal keys are ranked apart. Queries without terms, and documents that share none, give no row. Other
columns are left aside, so their names can't clash.
"""

import heapq
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborline.llm import words as W
from harborline.llm.store import written

K, FANOUT, RANGE_DOCS, RANGE_ENTRIES = 10, 8, 2048, 1 << 19
BLOCK_TERMS, MAP_BITS, PARTITION_DOCS = 1 << 16, 20, 8192

_BYTES = np.arange(256)
#: Bytes of terms, lower-cased; all others are white.
_TERM = np.where((_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((W.LOWER >= 97) & (W.LOWER <= 122)), W.LOWER, 32).astype(np.uint8)


@dataclass(frozen=True)
class Index:
    ranges: DataFrame  # a row for each range: its documents' keys, its terms with their maxima, its tree
    frequency: DataFrame  # term, df
    documents: int  # those with a term
    terms: int  # of all documents, with repeats


# Counting terms


def _strings(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    lengths = stops - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    source = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[source]))


def _counted(key: str, text: str, bitmap: np.ndarray | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                data, ends = W.utf8(part.column(text))
                data = _TERM[data]
                starts, stops, firsts = W.find(data, ends)
                n = np.diff(firsts)
                doc, hashes = np.repeat(np.arange(part.num_rows), n), W.hashes(data, starts, stops)
                if bitmap is not None:
                    kept = np.flatnonzero(bitmap[hashes >> np.uint64(64 - MAP_BITS)])
                    doc, hashes, starts, stops = doc[kept], hashes[kept], starts[kept], stops[kept]
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
                at = np.flatnonzero(new)
                one = order[at]
                offsets = pa.array(np.searchsorted(doc[at], np.arange(part.num_rows + 1)), pa.int32())
                terms = pa.ListArray.from_arrays(offsets, _strings(data, starts[one], stops[one]))
                times = pa.ListArray.from_arrays(offsets, pa.array(np.diff(at, append=len(doc)), pa.int32()))
                rows = pa.RecordBatch.from_arrays([part.column(key), pa.array(n, pa.int64()), terms, times], schema=schema)
                yield rows.filter(pc.greater(rows.column("n"), 0))

    return run


def term_counts(docs: DataFrame, key: str, text: str, bitmap: np.ndarray | None = None) -> DataFrame:
    """key, n (terms with repeats), terms (once each, or those in the map), times; for rows with a term."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

    schema = StructType().add("key", docs.schema[key].dataType).add("n", LongType()).add("terms", ArrayType(StringType())).add("times", ArrayType(IntegerType()))
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_counted("key", "text", bitmap, to_arrow_schema(schema)), schema)


def _bit_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, ends = W.utf8(batch.column("term"))
        hashes = W.hashes(data, ends[:-1], ends[1:])
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64))], ["place"])


def _bitmap(terms: DataFrame) -> np.ndarray:
    places = terms.mapInArrow(_bit_places, "place long").distinct().toArrow()  # at most 2**MAP_BITS rows
    found = np.zeros(1 << MAP_BITS, bool)
    found[places.column("place").to_numpy()] = True
    return found


# Trees


def _tree(doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int, terms: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Nodes by level from the leaves, each node's first entry (one more than nodes), and entries' terms and values.
    doc, term, value: the leaves' entries, sorted by doc."""
    node, levels = doc.astype(np.int64), [docs]
    counts, term_parts, value_parts = [np.bincount(node, minlength=docs)], [term], [value]
    while levels[-1] > 1 or len(levels) < 2:
        cell = (node // FANOUT) * terms + term
        order = np.argsort(cell, kind="stable")
        cell, value = cell[order], value[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        cell, value = cell[first], np.maximum.reduceat(value, first)
        node, term = cell // terms, cell % terms
        levels.append(-(-levels[-1] // FANOUT))
        counts.append(np.bincount(node, minlength=levels[-1]))
        term_parts.append(term)
        value_parts.append(value)
    return levels, np.concatenate(([0], np.cumsum(np.concatenate(counts)))), np.concatenate(term_parts), np.concatenate(value_parts)


def _trees(documents: int, total: int, schema: pa.Schema):
    """From rows of key, n, terms, times in order of keys: a row for each range."""

    def row(number: int, keys: pa.Array, n: np.ndarray, terms: pa.ListArray, times: pa.ListArray) -> pa.RecordBatch:
        encoded = terms.flatten().dictionary_encode()
        doc = np.repeat(np.arange(len(keys)), terms.value_lengths().to_numpy())
        tf = times.flatten().to_numpy().astype(np.int64)
        m = 10 + (90 * n * documents) // total
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        levels, first, node_terms, values = _tree(doc, encoded.indices.to_numpy().astype(np.int64), impact, len(keys), len(encoded.dictionary))
        top = np.zeros(len(encoded.dictionary), np.int64)
        top[node_terms[first[-2] :]] = values[first[-2] :]
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), one(keys), one(encoded.dictionary), blob(top, "<i4"), one(pa.array(levels, pa.int32())), blob(first, "<i4"), blob(node_terms, "<i4"), blob(values, "<i4")], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, docs, entries = TaskContext.get().partitionId() << 32, [], 0, 0

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(waiting).combine_chunks()
            column = lambda c: whole.column(c).chunk(0)
            return row(number, column("key"), column("n").to_numpy(), column("terms"), column("times"))

        for batch in batches:
            sizes = batch.column("terms").value_lengths().to_numpy()
            at = 0
            while at < batch.num_rows:
                room = int(np.searchsorted(np.cumsum(sizes[at:]), RANGE_ENTRIES - entries, "right"))
                take = min(max(room, 0 if docs else 1), RANGE_DOCS - docs, batch.num_rows - at)
                if take:
                    waiting.append(batch.slice(at, take))
                    docs, entries, at = docs + take, entries + int(sizes[at : at + take].sum()), at + take
                if docs == RANGE_DOCS or at < batch.num_rows:
                    yield flush()
                    number, waiting, docs, entries = number + 1, [], 0, 0
        if docs:
            yield flush()

    return run


def build(docs: DataFrame, *, key: str = "doc_id", text: str = "text", queries: DataFrame | None = None) -> Index:
    """An index of all documents; with queries (from `term_counts`), of their terms only."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType

    spark = docs.sparkSession
    bitmap = None if queries is None else _bitmap(queries.select(F.explode("terms").alias("term")).distinct())
    counts = written(term_counts(docs, key, text, bitmap), "term-counts")
    asked = F.size("terms") > 0
    whole = counts.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"), F.count_if(asked).alias("asked")).first()
    frequency = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    schema = StructType().add("range", LongType()).add("keys", ArrayType(docs.schema[key].dataType)).add("terms", ArrayType(StringType())).add("tops", BinaryType())
    schema = schema.add("levels", ArrayType(IntegerType())).add("first", BinaryType()).add("node_terms", BinaryType()).add("node_values", BinaryType())
    parts = max(1, min(-(-whole["asked"] // PARTITION_DOCS), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spread = F.xxhash64("n", "terms")  # so that many rows of one key don't meet in one task
    ordered = counts.filter(asked).repartitionByRange(parts, "key", spread).sortWithinPartitions(F.asc_nulls_last("key"), spread)
    ranges = ordered.mapInArrow(_trees(whole["documents"], whole["terms"], to_arrow_schema(schema)), schema)
    return Index(written(ranges, "ranges"), frequency, whole["documents"], whole["terms"])


# Searching


class _Block:
    """Queries of a block: their numbers, terms (numbers among the block's) and weights."""

    def __init__(self, rows: list) -> None:
        self.numbers = [r["query"] for r in rows]
        sizes = [len(r["terms"]) for r in rows]
        terms = pa.array([t for r in rows for t in r["terms"]], pa.string()).dictionary_encode()
        self.terms, self.term = terms.dictionary, terms.indices.to_numpy()
        self.weight = np.array([w for r in rows for w in r["weights"]], np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)

    def places(self, terms: pa.Array) -> np.ndarray:
        """Where the block's terms are among a range's; -1 for those that aren't."""
        return pc.fill_null(pc.index_in(self.terms, value_set=terms), -1).to_numpy()

    def bounds(self, places: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """Each query's bound at a root."""
        top = np.where(places >= 0, tops[places], 0)
        return np.add.reduceat(self.weight * top[self.term], self.first[:-1])


def _numbers(blob) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), "<i4").astype(np.int64)


def _roots(block: _Block):
    """The best root of each query in a task: query (its place in the block), range, bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, at = np.zeros(len(block.numbers), np.int64), np.full(len(block.numbers), -1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                bound = block.bounds(block.places(batch.column("terms")[i].values), _numbers(batch.column("tops")[i]))
                more = bound > best
                best[more], at[more] = bound[more], batch.column("range")[i].as_py()
        some = np.flatnonzero(at >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(at[some]), pa.array(best[some])], ["query", "range", "bound"])

    return run


class _Range:
    def __init__(self, batch: pa.RecordBatch, i: int, block: _Block) -> None:
        self.number, self.keys, self.terms = batch.column("range")[i].as_py(), batch.column("keys")[i].values, batch.column("terms")[i].values
        levels = np.array(batch.column("levels")[i].values)
        self.top, self.level_start = len(levels) - 1, np.concatenate(([0], np.cumsum(levels)))
        self.first, self.node_terms, self.node_values = (_numbers(batch.column(c)[i]) for c in ("first", "node_terms", "node_values"))
        self.places = block.places(self.terms)
        self.bounds = block.bounds(self.places, _numbers(batch.column("tops")[i]))

    def weights(self, block: _Block, q: int) -> np.ndarray:
        here = slice(block.first[q], block.first[q + 1])
        at, weight = self.places[block.term[here]], block.weight[here]
        out = np.zeros(len(self.terms), np.int64)
        out[at[at >= 0]] = weight[at >= 0]
        return out

    def children(self, level: int, node: int, weights: np.ndarray) -> tuple[int, np.ndarray]:
        """The first child of a node (its place in its level), and the children's bounds; at leaves their scores."""
        start, low = self.level_start[level - 1], node * FANOUT
        high = min(low + FANOUT, self.level_start[level] - start)
        first = self.first[start + low : start + high + 1]
        here = slice(first[0], first[-1])
        return low, np.add.reduceat(weights[self.node_terms[here]] * self.node_values[here], first[:-1] - first[0])


class _Best:
    """The best documents of a query so far, as (-score, key is null, key)."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least, self.rows = k, max(1, least), []

    def offer(self, score: int, key) -> None:
        insort(self.rows, (-score, key is None, 0 if key is None else key))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


def _descend(ranges: list[_Range], block: _Block, q: int, best: _Best) -> None:
    """Opens nodes, greatest bound first, as long as one isn't below the k-th score."""
    open_ = [(-int(r.bounds[q]), i, r.top, 0) for i, r in enumerate(ranges) if r.bounds[q] >= best.least]
    heapq.heapify(open_)
    weights: dict[int, np.ndarray] = {}
    while open_ and -open_[0][0] >= best.least:
        _, i, level, node = heapq.heappop(open_)
        if i not in weights:
            weights[i] = ranges[i].weights(block, q)
        low, bounds = ranges[i].children(level, node, weights[i])
        for j in np.flatnonzero(bounds >= best.least).tolist():
            if level == 1:
                best.offer(int(bounds[j]), ranges[i].keys[low + j].as_py())
            else:
                heapq.heappush(open_, (-int(bounds[j]), i, level - 1, low + j))


def _opened(block: _Block, k: int, first: dict[int, int], least: dict[int, int] | None, schema: pa.Schema):
    """The best documents of each query in a task. first: each query's first range. Without `least` only these are opened,
    with it (the k-th score in them) all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k, (least or {}).get(q, 0)) for q in range(len(block.numbers))]
        for batch in batches:
            ranges = [_Range(batch, i, block) for i in range(batch.num_rows)]
            for q in range(len(block.numbers)):
                some = [r for r in ranges if (r.number == first.get(q)) == (least is None)]
                _descend(some, block, q, best[q])
        rows = [(block.numbers[q], None if null else key, -score) for q, b in enumerate(best) for score, null, key in b.rows]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _blocks(weighted: DataFrame) -> Iterator[_Block]:
    """Queries, a partition of them at a time, in blocks of at most BLOCK_TERMS terms (or of one query)."""
    rows, terms = [], 0
    for row in weighted.toLocalIterator():
        if rows and terms + len(row["terms"]) > BLOCK_TERMS:
            yield _Block(rows)
            rows, terms = [], 0
        rows.append(row)
        terms += len(row["terms"])
    if rows:
        yield _Block(rows)


def best_first(score: Column | str, key: Column | str) -> list[Column]:
    return [F.desc(score), F.asc_nulls_last(key)]


def search(index: Index, queries: DataFrame, k: int = K) -> DataFrame:
    """queries: from `term_counts`. key (the query's), rank (from 1), doc, score: the k best documents of each query with a
    score over 0."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType

    numbered = written(queries.select(F.monotonically_increasing_id().alias("query"), F.col("key"), F.col("terms")), "queries")
    weight = F.floor(F.lit(1000) * F.log((2 * F.lit(index.documents) + 2) / (2 * F.col("df") + 1))).cast("long")
    each = numbered.select("query", F.explode("terms").alias("term")).join(index.frequency, "term")
    weighted = written(each.groupBy("query").agg(F.collect_list("term").alias("terms"), F.collect_list(weight).alias("weights")), "query-weights")
    kind = index.ranges.schema["keys"].dataType.elementType
    schema = StructType().add("query", LongType()).add("doc", kind).add("score", LongType())
    arrow, found = to_arrow_schema(schema), None
    for block in _blocks(weighted):
        roots = index.ranges.select("range", "terms", "tops").mapInArrow(_roots(block), "query int, range long, bound long")
        tops = roots.groupBy("query").agg(F.max(F.struct("bound", "range")).alias("top")).select("query", "top.range").collect()  # a row for each query of the block
        first = {r["query"]: r["range"] for r in tops}
        if not first:
            continue
        opened = written(index.ranges.filter(F.col("range").isin(sorted(set(first.values())))).mapInArrow(_opened(block, k, first, None, arrow), schema), "first-ranges")
        full = opened.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") == k).collect()
        place = {n: q for q, n in enumerate(block.numbers)}
        least = {place[r["query"]]: r["least"] for r in full}
        others = index.ranges.mapInArrow(_opened(block, k, first, least, arrow), schema)
        part = written(opened.unionByName(others), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.ranges.sparkSession.createDataFrame([], schema)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best_first("score", "doc")))).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("query", "key"), "query").select("key", F.col("rank").cast("int").alias("rank"), "doc", "score")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    queries = written(term_counts(items, "item_id", "text"), "query-terms")
    found = search(build(docs, queries=queries), queries)
    return found.select(F.col("key").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


ORACLE_SQL = r"""with raw as materialized (select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
sizes as materialized (select row, doc_id, len(terms) as n from raw where len(terms) > 0),
whole as (select count(*)::bigint as documents, sum(n)::bigint as terms from sizes),
asked as materialized (select distinct item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from (select item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark)),
postings as materialized (select row, term, count(*)::bigint as tf from (select row, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from (select row, unnest(terms) as t from raw)) where term in (select term from asked) group by 1, 2),
weights as (select term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::bigint as w from postings, whole group by term, documents),
scored as (select item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * whole.documents) // whole.terms))))::bigint as score
  from asked join postings using (term) join weights using (term) join sizes using (row), whole group by 1, 2, 3),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from scored where score > 0)
select * from ranked where rank <= 10"""
