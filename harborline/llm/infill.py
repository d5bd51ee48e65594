"""Fill-in-middle examples: DuckDB's SQL over the Arrow batches of each task.

A text is cut into units, runs of white space with the word behind them, which together are the whole text. Two cuts fall
behind numbers of units that a hash of the document's key gives; what lies before, between and behind them is written in
the order suffix, prefix, middle (form "spm") or prefix, suffix, middle ("psm") behind marks. Other texts stay "plain":
empty ones, those that hold a mark, and those that the hash picks.

Each batch is cut into slices of about SLICE_BYTES of text, so that a task holds the units of one slice at a time, and
of one text at least. DuckDB keeps no file and spills nothing to disk.

A null text counts as an empty one. A null key is hashed as an empty string; rows with equal keys get the same numbers.
Columns of docs are carried along as they are; where a name of an output is taken, the output gets an underscore in front
(`names` tells). Without rows there are none in the result.
"""

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from harborline.llm import native
from harborline.llm import words as W

SEED, PLAIN_FROM, SPM_BELOW = "42", 50, 80
SLICE_BYTES = 4 << 20
#: The marks, and the pattern of units.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

OUTPUTS = {"infilled": StringType(), "form": StringType(), "n_units": LongType(), "prefix_chars": LongType(), "middle_chars": LongType()}

#: The steps from a row's number, key and text to its example; {given} is the relation of the rows.
STEPS = rf"""
with hashed as (select row, text, regexp_extract_all(text, '{UNIT}') as units, sha256('{{seed}}:' || key) as hex from {{given}}),
numbered as (select row, text, units, len(units)::ubigint as n, ('0x' || hex[1:8])::ubigint as h1, ('0x' || hex[9:16])::ubigint as h2, ('0x' || hex[17:24])::ubigint as h3, ('0x' || hex[25:32])::ubigint as h4 from hashed),
cut as (select row, text, units, n::bigint as n, least(h1 % (n + 1), h2 % (n + 1))::bigint as low, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as high,
  case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}') or h3 % 100 >= {{plain_from}} then 'plain' when h4 % 100 < {{spm_below}} then 'spm' else 'psm' end as form from numbered),
parts as (select row, text, n, form, case when form <> 'plain' then array_to_string(list_slice(units, 1, low), '') end as prefix, case when form <> 'plain' then array_to_string(list_slice(units, low + 1, high), '') end as middle,
  case when form <> 'plain' then array_to_string(list_slice(units, high + 1, n), '') end as suffix from cut)
select row, case form when 'spm' then '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle else text end as infilled,
  form, n as n_units, length(prefix)::bigint as prefix_chars, length(middle)::bigint as middle_chars from parts"""


def names(docs: DataFrame) -> dict[str, str]:
    """The outputs' names beside docs' columns."""
    return {out: native.name(docs, out) for out in OUTPUTS}


def _examples(key: str, text: str, columns: list[str], sql: str, schema: pa.Schema):
    outputs = pa.schema([pa.field(n, pa.string() if isinstance(t, StringType) else pa.int64()) for n, t in OUTPUTS.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""}) as db:
            for batch in batches:
                for part in W.slices(batch, text, SLICE_BYTES):
                    texts = part.column(text)
                    texts = texts.fill_null("") if texts.null_count else texts
                    given = pa.table({"row": pa.array(range(part.num_rows), pa.int64()), "key": part.column(key), "text": texts})
                    db.register("given", given)
                    found = db.sql(sql).to_arrow_table()
                    db.unregister("given")
                    kept = pa.Table.from_batches([part.select(columns)]).take(found.column("row"))
                    made = found.select(outputs.names).cast(outputs)
                    yield from pa.Table.from_arrays([*kept.columns, *made.columns], schema=schema).to_batches()

    return run


def infill(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """docs with infilled (the example), form, n_units, prefix_chars and middle_chars (code points; null if plain)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = names(docs)
    schema = StructType([*docs.schema.fields])
    for n, kind in OUTPUTS.items():
        schema = schema.add(out[n], kind)
    hashed = native.name(docs, "__key")
    sql = STEPS.format(given="given", seed=seed, plain_from=plain_from, spm_below=spm_below)
    keyed = docs.withColumn(hashed, F.coalesce(F.col(key).cast("string"), F.lit("")))
    return keyed.mapInArrow(_examples(hashed, text, docs.columns, sql, to_arrow_schema(schema)), schema)


def restored(infilled: Column, form: Column) -> Column:
    """The text that an example was made of. A mark can't arise where two parts meet, and the text held none."""
    between = lambda a, b: F.split_part(F.split_part(infilled, F.lit(a), F.lit(2)), F.lit(b), F.lit(1))
    middle = F.split_part(infilled, F.lit(MIDDLE), F.lit(2))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    return F.when(form == "spm", spm).when(form == "psm", psm).otherwise(infilled)


def digest(docs: DataFrame) -> DataFrame:
    made = infill(docs.select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", sha(F.col("infilled")).alias("output_sha256"), sha(restored(F.col("infilled"), F.col("form"))).alias("restored_sha256"))


_GIVEN = "(select row_number() over () as row, coalesce(doc_id::varchar, '') as key, coalesce(text, '') as text, doc_id from documents)"
ORACLE_SQL = f"""with given as materialized {_GIVEN}, made as ({STEPS.format(given='given', seed=SEED, plain_from=PLAIN_FROM, spm_below=SPM_BELOW)})
select doc_id, n_units as n, form, prefix_chars, middle_chars, sha256(infilled) as output_sha256, sha256(given.text) as restored_sha256 from made join given using (row)"""
