"""I-Match fingerprints with randomised lexicon subsets.

Terms are lower-cased runs of letters and digits. The lexicon holds the terms whose document frequency lies in a band of
inverse document frequency: 1 / 200 to 1 / 20 of all documents. As a document has d distinct terms in the mean, at most
200 * d terms can be in the band, whatever the corpus; the lexicon is sent to the tasks as a bitmap of fixed size over
term hashes (2**19 bits), so a few per cent of other terms are kept too, the same ones in every text.

A text keeps its distinct terms in the lexicon. At each level l of a fixed ladder, the same for all texts, they fall by
their hash into 2**l random subsets, from the whole lexicon (level 0, the classic I-Match) to about single terms; the
sorted terms of every subset are hashed, and these hashes are folded into 32 bins, of which each keeps its least. Level -1
does the same with single terms, in the lexicon or not, so texts with few terms in it, or none, are compared too. Likeness
of two fingerprints is the Dice share of equal hashes, on the best level: a changed term spoils one subset, not the others.
A text's size decides nothing, so a copy that loses or gains a term loses no more than that term's share.

Equal texts have equal fingerprints. A text without terms (null counts as empty) has one hash, of the text itself.
Rows with equal doc_id are ordered by text; doc_id must be a number. Extra columns are ignored.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm import native, ordering

BAND = (1 / 200, 1 / 20)
LEXICON_BITS, SUBSETS = 19, 32
LADDER = (0, 4, 8, 12)
#: Text bytes that one task puts in order.
BUCKET_BYTES = 32 << 20
_TERM = "[^\\p{L}\\p{N}]+"


def terms(text: Column) -> Column:
    """Hashes of a text's distinct terms."""
    return F.transform(F.array_distinct(F.filter(F.split(F.lower(text), _TERM, -1), lambda x: x != "")), lambda x: F.xxhash64(x))


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND, n: int | None = None) -> Column:
    """A literal bitmap (2**LEXICON_BITS bits in 64-bit numbers) of the hashes of the terms in the band. n: number of docs."""
    n = docs.count() if n is None else n
    counts = docs.select(F.explode(terms(native.whole(text))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    chosen = counts.filter(F.col("df").between(band[0] * n, band[1] * n))
    bit = F.col("term").bitwiseAND(F.lit((1 << LEXICON_BITS) - 1).cast("long"))
    cells = chosen.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(term & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (LEXICON_BITS - 6), np.int64)
    for row in cells.toLocalIterator():  # at most 8192 rows, at any size of the corpus
        out[row["cell"]] = row["bits"]
    return F.expr(f"from_json('{out.tolist()}', 'array<bigint>')")


def kept_terms(every: str, bitmap: Column) -> Column:
    cell = lambda x: F.shiftright(x.bitwiseAND(F.lit((1 << LEXICON_BITS) - 1).cast("long")), 6).cast("int")
    return F.filter(F.col(every), lambda x: F.getbit(F.get(bitmap, cell(x)), x.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)


def _folded(keys: str) -> str:
    """The least of each bin, of sorted keys with the bin above 32 bits."""
    return f"filter({keys}, (k, j) -> j = 0 or shiftright(k, 32) <> shiftright(get({keys}, j - 1), 32))"


def with_fingerprint(df: DataFrame, text: str, out: str, bitmap: Column) -> DataFrame:
    """df with `out`: array of struct<level int, hashes array<bigint>>, of level -1 and those of LADDER that have terms."""
    df = df.withColumn("__all", terms(F.col(text))).withColumn("__in", kept_terms("__all", bitmap))
    df = df.withColumn("__b-1", F.expr(f"sort_array(transform(__all, h -> ((shiftrightunsigned(h, 20) & {SUBSETS - 1}) << 32) | (xxhash64(h) & 4294967295L)))"))
    for i in LADDER:
        # the subset's number above 52 bits of the term's hash, sorted, so that a subset is a run
        df = df.withColumn(f"__k{i}", F.expr(f"sort_array(transform(__in, h -> shiftleft(shiftrightunsigned(h, 20) & {(1 << i) - 1}L, 52) | shiftrightunsigned(xxhash64(h), 12)))"))
        df = df.withColumn(f"__s{i}", F.expr(
            f"filter(transform(__k{i}, (k, j) -> if(j = 0 or shiftrightunsigned(k, 52) <> shiftrightunsigned(get(__k{i}, j - 1), 52), j, -1)), j -> j >= 0)"))
        df = df.withColumn(f"__b{i}", F.expr(
            f"sort_array(transform(__s{i}, (a, j) -> ((shiftrightunsigned(get(__k{i}, a), 52) & {SUBSETS - 1}) << 32)"
            f" | (xxhash64(slice(__k{i}, a + 1, coalesce(get(__s{i}, j + 1), size(__k{i})) - a)) & 4294967295L)))"))
    none = F.array(F.struct(F.lit(-1).alias("level"), F.array(F.xxhash64(text)).alias("hashes")))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.expr(_folded(f"`__b{i}`")).alias("hashes")) for i in (-1, *LADDER)])
    return df.withColumn(out, F.when(F.size("__all") == 0, none).otherwise(F.filter(levels, lambda x: F.size(x["hashes"]) > 0))).drop(
        "__all", "__in", "__b-1", *(f"__{x}{i}" for x in "ksb" for i in LADDER))


def likeness(a: str, b: str) -> Column:
    """Dice share of equal subset hashes on the best shared level, 0 to 1."""
    same = "size(array_intersect(x.hashes, y.hashes)) * 2D / greatest(size(x.hashes) + size(y.hashes), 1)"
    return F.expr(f"coalesce(array_max(flatten(transform({a}, x -> transform(filter({b}, y -> y.level = x.level), y -> {same})))), 0D)")


def text_of(fingerprint: str) -> Column:
    """level:hash,hash;level:hash,hash;..."""
    return F.expr(f"array_join(transform({fingerprint}, x -> concat(x.level, ':', array_join(transform(x.hashes, h -> lower(hex(h))), ','))), ';')")


def edited_neighbours(docs: DataFrame, *, key: str = "doc_id", text: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of every text and of its edit (its last quarter replaced by the start of the next document)."""
    docs = docs.select(F.col(key), native.whole(text).alias("text"))
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()  # two numbers
    bitmap = lexicon(docs, "text", band, n)
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    rows, bucket, guest = ordering.with_next(docs, key, buckets)
    rows = with_fingerprint(rows, "text", "fp", bitmap)
    order = Window.partitionBy(bucket).orderBy(guest, F.col(key).asc_nulls_first(), "text")
    near = rows.withColumns({"next_text": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)}).filter(~F.col(guest))
    n = F.length("text").cast("long")
    part = F.floor(n / 4).cast("int")
    edit = F.concat(F.substring(F.col("text"), F.lit(1), (n - part).cast("int")), F.substring(F.col("next_text"), F.lit(1), part))
    return with_fingerprint(near.withColumn("edited", edit), "edited", "edited_fp", bitmap).select(
        F.col(key), n.alias("n_chars"), "text", "edited", "fp", "edited_fp", "next_fp")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), text_of("fp").alias("fingerprint"),
        text_of("edited_fp").alias("edited_fingerprint"), likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
