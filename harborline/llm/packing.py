"""Packing by optimal length buckets.

Documents are cut into pieces of at most MAX_LENGTH tokens. The global histogram of piece lengths (at most MAX_LENGTH
rows, whatever the corpus) goes to the driver, where dynamic programming chooses the bucket bounds that minimise padding:
every piece is padded to its bucket's bound. Inside a bucket pieces are numbered in a shuffled order, and each batch
takes as many as fit the token budget.

Numbers have two levels: a bucket's order is cut into about sqrt(rows) cells by a hash, counts of cells give offsets, and
only the pieces of one cell are numbered in one window, so a bucket with a third of all rows is no hot window.

A null or empty text has no tokens and gives one piece of length 0, which costs a place in the shortest bucket. Rows
with equal doc_id are separate documents. Without rows there are no buckets. Columns of the documents are carried along as
they are, whatever their names: an output whose name is taken gets an underscore in front (`names` tells).
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm import words as W
from harborline.llm.tokens import WordIds, default_path

MAX_LENGTH, BUCKETS, TOKEN_BUDGET, SEED = 2048, 12, 16_384, "pack-1"


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds (the last is the greatest length) of at most `buckets` buckets with least padding in all.

    cost of lengths i..j in one bucket = length j * pieces - tokens; best[k][j] = min over i of best[k - 1][i - 1] + cost.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    m = len(lengths)
    if not m:
        return []
    pieces = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    first = np.arange(m)
    cost = np.full((m, m), np.iinfo(np.int64).max // 4)
    for j in range(m):
        cost[: j + 1, j] = lengths[j] * (pieces[j + 1] - pieces[: j + 1]) - (tokens[j + 1] - tokens[: j + 1])
    best, cut = cost[0].copy(), []
    for _ in range(1, min(buckets, m)):
        total = np.concatenate(([0], best[:-1]))[:, None] + cost
        total[0] = np.iinfo(np.int64).max // 2
        choice = total.argmin(0)
        better = total[choice, first] < best
        cut.append(np.where(better, choice, -1))
        best = np.where(better, total[choice, first], best)
    bounds, j = [int(lengths[-1])], m - 1
    for choice in reversed(cut):
        if choice[j] > 0:
            j = int(choice[j]) - 1
            bounds.append(int(lengths[j]))
    return bounds[::-1]


OUTPUTS = ("n_tokens", "piece", "piece_start", "piece_length", "bucket", "bound", "batch", "slot", "padding")


def names(docs: DataFrame, text: str = "text") -> dict[str, str]:
    """The outputs' names beside docs' columns (the text goes)."""
    return {out: native.name(docs.drop(text), out) for out in OUTPUTS}


def _lengths(path: str, text: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        for batch in batches:
            for part in W.slices(batch, text):
                others = [part.column(n) for n in part.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*others, pa.array(words.lengths(part.column(text)), pa.int64())], schema=schema)

    return run


def token_lengths(docs: DataFrame, *, text: str = "text", path: str | None = None, out: str | None = None) -> DataFrame:
    """docs without the text, with the number of tokens as `out` (n_tokens, or the next free name)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructType

    others = docs.drop(text)
    schema = StructType([*others.schema.fields]).add(out or names(docs, text)["n_tokens"], LongType())
    return docs.select(*others.columns, text).mapInArrow(_lengths(path or default_path(), text, to_arrow_schema(schema)), schema)


def pack(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, seed: str = SEED) -> DataFrame:
    """A row for each piece: docs' columns without the text, n_tokens, piece, piece_start, piece_length, bucket, bound
    (length after padding), batch (within the bucket), slot (within the batch), padding."""
    from harborline.llm.store import written

    out, others = names(docs, text), [c for c in docs.columns if c != text]
    held = docs.select(F.struct(*[F.col(c) for c in others]).alias("row"), F.col(text).alias("text"))
    counted = token_lengths(held, text="text", path=path, out="n_tokens")
    pieces = F.greatest(F.ceil(F.col("n_tokens") / max_length), F.lit(1)).cast("int")
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    cut = cut.withColumn("piece_start", F.col("piece").cast("long") * max_length)
    cut = written(cut.withColumn("piece_length", F.least(F.col("n_tokens") - F.col("piece_start"), F.lit(max_length)).cast("int")), "pieces")
    histogram = cut.groupBy("piece_length").agg(F.count("*").alias("n")).toPandas()  # at most max_length + 1 rows
    bounds = optimal_bounds(histogram["piece_length"].to_numpy(), histogram["n"].to_numpy(), buckets)
    rows = int(histogram["n"].sum())
    bucket: Column = F.lit(max(0, len(bounds) - 1))
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("piece_length") <= bounds[i], i).otherwise(bucket)
    bound = F.element_at(F.lit(bounds or [0]), F.col("bucket") + 1).cast("int")
    cells = max(1, math.isqrt(rows))
    place = F.xxhash64(F.lit(seed), F.col("row").getField(key), F.col("piece"))
    placed = cut.withColumns({"bucket": bucket.cast("int"), "place": place}).withColumns({"bound": bound, "cell": F.pmod(F.col("place"), F.lit(cells)).cast("int")})
    counts = placed.groupBy("bucket", "cell").agg(F.count("*").alias("n"))
    along = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", "cell", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket", "cell").orderBy("place", "piece_length")
    fit = F.greatest(F.floor(F.lit(budget) / F.greatest("bound", F.lit(1))), F.lit(1))
    numbered = placed.join(starts, ["bucket", "cell"]).withColumn("number", F.col("before") + F.row_number().over(within) - 1)
    made = numbered.withColumns({
        "batch": F.floor(F.col("number") / fit).cast("long"),
        "slot": (F.col("number") % fit).cast("long"),
        "padding": F.col("bound") - F.col("piece_length")})
    return made.select(*[F.col("row").getField(c).alias(c) for c in others], *[F.col(c).alias(out[c]) for c in OUTPUTS])


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", *OUTPUTS)
