"""Quality rules as a bitmask ledger.

Each rule is evaluated once a document; a 64-bit mask of failed rules and the measurements are stored. A policy is a
versioned set of rules: applying it is one bitwise AND, and ablations (what a policy would reject without a rule) come
from counts by failure mask, at most 2**rules rows, without another look at a text.

A null or empty text has no words: all measurements are 0 and it fails `few_words`. Measurements are made on each row
by itself, so repeated rows get equal results; extra columns are carried along.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm import native

#: Rules by bit, in order: a condition on measurements that is true where the rule fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_trigrams": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines and n_lines >= 4",
    "capitals": "2 * n_capitals > word_chars",
}

#: Policies by version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "1": ("few_words", "repeated_trigrams"),
    "2": ("few_words", "repeated_trigrams", "symbols", "word_length", "repeated_lines", "capitals"),
}
BASE_POLICY, POLICY = "1", "2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def mask(policy: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in POLICIES[policy])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements (in place of columns of such names). A word counts as repeated if a 3-word window over it starts twice or more in the text.

    Windows are found again by sorting: a key holds the upper bits of a window's 64-bit hash and its place in as many
    lower bits as the text needs; equal neighbours are compared on the full hash.
    """
    whole = native.whole(text)
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(native.WHITE)) != "")
    out = docs.withColumns({"__text": whole}).withColumns({"__words": native.words(F.col("__text")), "__lines": lines})
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": (F.length("__text") - F.length(F.regexp_replace("__text", "[#*$%&|<>]", ""))).cast("long"),
        "n_capitals": (F.length("__text") - F.length(F.regexp_replace("__text", "[A-Z]", ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__runs": F.expr("if(size(__words) < 3, array(), transform(sequence(2, greatest(size(__words) - 1, 2)), i -> xxhash64(get(__words, i - 2), get(__words, i - 1), get(__words, i))))").cast("array<bigint>"),
    })
    out = out.withColumn("__low", F.expr("shiftleft(1L, cast(ceil(log2(size(__runs) + 2)) as int)) - 1"))
    out = out.withColumn("__keys", F.expr("if(size(__runs) = size(array_distinct(__runs)), cast(array() as array<bigint>), sort_array(transform(__runs, (h, i) -> (h & ~__low) | i)))"))
    twin = "((x & ~__low) = (get(__keys, {j}) & ~__low) and get(__runs, cast(x & __low as int)) = get(__runs, cast(get(__keys, {j}) & __low as int)))"
    again = f"coalesce({twin.format(j='j - 1')}, false) or coalesce({twin.format(j='j + 1')}, false)"
    out = out.withColumn("__again", F.expr(f"sort_array(filter(transform(__keys, (x, j) -> if({again}, x & __low, -1L)), x -> x >= 0))"))
    out = out.withColumn("n_repeat_words", F.expr("aggregate(transform(__again, (x, j) -> least(3L, coalesce(get(__again, j + 1) - x, 3L))), 0L, (a, b) -> a + b)"))
    return out.drop("__text", "__words", "__lines", "__runs", "__low", "__keys", "__again")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with measurements and `failed_rules`, the mask of the rules that fail."""
    bits: Column = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0).cast("long"))
    return measured(docs, text).withColumn("failed_rules", bits)


def passes(policy: str = POLICY) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def passing(docs: DataFrame, policy: str = POLICY, text: str = "text") -> DataFrame:
    """The rows of docs that pass a policy. A row number, which is never negative, keeps the optimizer from moving the
    condition below the measurements, where it would be made of many copies of them. The ledger is made beside docs'
    columns, which are kept in one struct meanwhile, so that none of them is overwritten."""
    kept = docs.select(F.struct(*docs.columns).alias("__docs"), F.col(text).alias("text"))
    numbered = ledger(kept).withColumn("__row", F.monotonically_increasing_id())
    return numbered.filter(passes(policy) & (F.col("__row") >= 0)).select("__docs.*")


def ablations(kept: DataFrame, policy: str = POLICY) -> DataFrame:
    """For each rule of a policy: rows that fail it, that only it rejects, and that pass without it."""
    chosen = F.col("failed_rules").bitwiseAND(F.lit(mask(policy)).cast("long"))
    counts = kept.groupBy(chosen.alias("failed")).agg(F.count("*").alias("rows"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = counts.select("failed", "rows", F.inline(rules))
    hit, alone = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed") == F.col("bit")
    total = lambda on: F.coalesce(F.sum(F.when(on, F.col("rows"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(
        total(hit).alias("n_failed"), total(alone).alias("n_only_this_rule"),
        total((F.col("failed") == 0) | alone).alias("n_kept_without_rule"), F.bit_or("failed").alias("failed_with_it"))


ORACLE_SQL = r"""
with d as (select doc_id, row_number() over () as n, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
i as (select n, unnest(generate_series(1, len(w) - 2)) as i from d),
t as (select n, i, w[i] || chr(0) || w[i + 1] || chr(0) || w[i + 2] as t from i join d using (n)),
r as (select n, i, count(*) over (partition by n, t) as often from t),
c as (select n, count(distinct j)::bigint as n_repeat_words from (select n, unnest([i, i + 1, i + 2]) as j from r where often > 1) group by n),
m as (select doc_id, text, len(w)::bigint as n_words, len(array_to_string(w, ''))::bigint as word_chars, (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g')))::bigint as n_capitals,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines, coalesce(n_repeat_words, 0) as n_repeat_words from d left join c using (n)),
f as (select *, len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines from m),
b as (select *, (case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end + case when 100 * n_symbols > 30 * n_words then 4 else 0 end
        + case when word_chars < 2 * n_words or word_chars > 20 * n_words then 8 else 0 end + case when 2 * n_dup_lines > n_lines and n_lines >= 4 then 16 else 0 end + case when 2 * n_capitals > word_chars then 32 else 0 end)::bigint as failed_rules from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_rules & 3) <> 0 as base_failed, failed_rules = 0 as kept, failed_rules from b"""


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes(BASE_POLICY)).alias("base_failed"), passes().alias("kept"), "failed_rules")
