r"""Personal data by bootstrapped contextual extraction, with built-in functions only.

Seeds are the base spans (email, ip, card, phone; each a fixed pattern and a check). Every run of words with a digit or
an @ is a candidate instance; the two words before it, lower-cased, are its lexical pattern. Patterns and instances make a
bipartite graph, summed over all documents. In each round a pattern's confidence in a kind is the share of its distinct
instances that are believed to be of the kind, smoothed, and an instance is believed as much as its best pattern; beliefs
only rise, and rounds go on until no pattern is added and the confidences have settled. Candidates behind a pattern of
high confidence and support that no base span touches become spans of kind `found_<kind>`. A candidate with fewer than two
words between it and the last one, or the start of the text, has no pattern.

Counts are made by (pattern, instance) before anything is gathered by pattern or instance, so a frequent word is no hot
group. Texts are not shuffled. Null and empty texts have no spans. Rows with equal id and equal text get equal spans.
Without seeds there are no patterns. Places in a text are running sums in blocks of sqrt(n) matches, so a text with n
matches takes about n * sqrt(n) / 2 additions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm.store import written

#: Kinds in order and what they match. Look-behinds start a match only where a greedy search from the left
#: would, and possessive loops neither give back nor recurse; the matches are the same.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS: dict[str, str] = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: A cheap test that a text can hold the kind at all.
_MAYBE = {"email": "instr({t}, '@') > 0", "ip": r"{t} rlike '[0-9]\\.[0-9]'", "card": "{t} rlike '[0-9][\\\\x20-]?[0-9]'", "phone": r"{t} rlike '\\+[0-9]'"}
_BYTE = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"
#: The last two words before a candidate, in reversed text.
_CONTEXT = r"^[\x20\x09-\x0D]+([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)"
CONFIDENCE, SUPPORT, SMOOTHING, SETTLED = 0.8, 5, 1.0, 1e-3
#: Code points in a block of a text that spans are cut out of.
BLOCK = 4096


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _valid(kind: str, x: str) -> str:
    if kind == "ip":
        return f"{x} rlike {_sql(rf'^0*{_BYTE}([.]0*{_BYTE}){{3}}$')}"
    if kind == "card":
        digits = f"transform(split(reverse({_digits(x)}), ''), (d, i) -> if(i % 2 = 0, cast(d as int), cast(d as int) * 2 - if(cast(d as int) > 4, 9, 0)))"
        return f"length({_digits(x)}) between 14 and 19 and aggregate(if(length({_digits(x)}) between 14 and 19, {digits}, array(1)), 0, (a, b) -> a + b) % 10 = 0"
    if kind == "phone":
        return f"length({_digits(x)}) between 10 and 15"
    return "true"


def _let(name: str, value: str, body: str) -> str:
    """The body, with a name for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _running(values: str, add: str = "a + y") -> str:
    """Running sums (or what `add` makes of a and y, from 0L on) of an array of numbers."""
    at = "cast(i div w as int)"
    sums = f"transform(v, (x, i) -> aggregate(slice(v, {at} * w + 1, cast(i % w as int) + 1), get(u, {at}), (a, y) -> {add}))"
    parts = f"transform(sequence(0, cast((size(v) - 1) div w as int)), k -> aggregate(slice(v, k * w + 1, w), 0L, (a, y) -> {add}))"
    before = f"transform(t, (x, k) -> aggregate(slice(t, 1, k), 0L, (a, y) -> {add}))"
    some = _let("w", "cast(ceil(sqrt(size(v))) as int)", _let("t", parts, _let("u", before, sums)))
    return _let("v", values, f"if(size(v) = 0, cast(array() as array<bigint>), {some})")


def with_matches(df: DataFrame, text: str, pattern: str, out: str, maybe: str = "true") -> DataFrame:
    """df with `out`: the matches as array of struct<start, end, value>, in code points; and `out`_gaps, the pieces between."""
    p = _sql(pattern)
    df = df.withColumn("__m", F.expr(f"if({maybe}, regexp_extract_all({text}, {p}, 0), cast(array() as array<string>))"))
    df = df.withColumn(f"{out}_gaps", F.expr(f"if(size(__m) > 0, split({text}, {p}, -1), cast(array() as array<string>))"))
    ends = _running(_let("g", f"{out}_gaps", "transform(__m, (x, i) -> cast(length(get(g, i)) + length(x) as bigint))"))
    spans = _let("m", "__m", _let("e", ends, "transform(m, (x, i) -> struct(get(e, i) - length(x) as start, get(e, i) as `end`, x as value))"))
    return df.withColumn(out, F.expr(spans)).drop("__m")


def with_base(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with `out`: the base spans as array of struct<start, rank, end, kind>, by start, then kind as listed."""
    for rank, kind in enumerate(KINDS):
        df = with_matches(df, text, PATTERNS[kind], f"__{kind}", _MAYBE[kind].format(t=text))
        df = df.withColumn(f"__{kind}", F.expr(f"transform(filter(__{kind}, x -> {_valid(kind, 'x.value')}), x -> struct(x.start, {rank} as rank, x.`end`, '{kind}' as kind))"))
    every = F.array_sort(F.concat(*[F.col(f"__{k}") for k in KINDS]))
    return df.withColumn(out, every).drop(*(f"__{k}" for k in KINDS), *(f"__{k}_gaps" for k in KINDS))


def _cores(value: str) -> str:
    """Start of a candidate's core (without marks around it), and its end, within the candidate."""
    return f"length(regexp_extract({value}, '^[^A-Za-z0-9+(]*', 0)), length({value}) - length(regexp_extract({value}, '[^A-Za-z0-9)]*$', 0))"


def scanned(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, base, seen): base spans, and candidates as array of struct<start, end, context, instance, kind>."""
    rows = docs.select(F.col(key), native.whole(text).alias("__text")).withColumn("text_hash", F.xxhash64("__text"))
    rows = with_base(rows, "__text", "base")
    rows = with_matches(rows, "__text", CANDIDATE, "__seen", "__text rlike '[0-9@]'")
    rows = rows.withColumn("__kinds", F.expr(_kinds("base", "__seen")))
    context = f"lower(reverse(regexp_extract(reverse(get(g, i)), {_sql(_CONTEXT)}, 1)))"
    lead, tail = _cores("x.value").split(", length(x.value)")
    seen = _let("g", "__seen_gaps", _let("k", "__kinds", f"""filter(transform(__seen, (x, i) -> struct(
        x.start + {lead} as start, x.start + length(x.value){tail} as `end`,
        {context} as context,
        substring(x.value, {lead} + 1, length(x.value){tail} - {lead}) as instance,
        get(k, i) as kind)), c -> c.context <> '' and c.`end` > c.start)"""))
    return rows.withColumn("seen", F.expr(seen)).select(key, "text_hash", "base", "seen")


def _kinds(base: str, seen: str) -> str:
    """The kind of a base span that touches each of the candidates, or null. Both are sorted by start and candidates don't
    overlap: the base span that reaches farthest of those that start up to a candidate, or the next one, touches it."""
    events = f"array_sort(concat(transform({base}, b -> struct(b.start as at, 0 as candidate, b.`end` as stop, b.rank as rank)), transform({seen}, x -> struct(x.start as at, 1 as candidate, x.`end` as stop, 0 as rank))))"
    reach = _running("transform(e, b -> if(b.candidate = 0, b.stop * 8 + b.rank, 0L))", "greatest(a, y)")
    near = "if(get(e, j + 1).candidate = 0 and get(e, j + 1).at < x.stop, get(e, j + 1).rank, null)"
    rank = f"if(x.candidate = 0, -1, if(get(r, j) div 8 > x.at, cast(get(r, j) % 8 as int), {near}))"
    names = ", ".join(f"'{k}'" for k in KINDS)
    return _let("e", events, _let("r", reach, f"transform(filter(transform(e, (x, j) -> {rank}), k -> k is null or k >= 0), k -> get(array({names}), k))"))


def confident_patterns(seen: DataFrame) -> DataFrame:
    """(context, kind, confidence, support) of the patterns that may name new instances. seen: context, instance, kind."""
    edges = written(seen.groupBy("context", "instance").agg(F.max("kind").alias("seed")), "pattern-edges")
    known = written(edges.filter("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind")).withColumn("belief", F.lit(1.0)), "seeds")
    seeds, before = known, None
    total = written(edges.groupBy("context").agg(F.count("*").alias("n")), "pattern-sizes")
    while True:
        held = edges.join(known, "instance").groupBy("context", "kind").agg(F.sum("belief").alias("mass"), F.count(F.when(F.col("belief") >= 1, 1)).alias("support"))
        sure = held.join(total, "context").select("context", "kind", (F.col("mass") / (F.col("n") + SMOOTHING)).alias("confidence"), "support")
        patterns = written(sure.filter((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT)), "patterns")
        now = patterns.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if now[0] == (before or (0, 0))[0] and (before is None or now[1] - before[1] <= SETTLED * now[0]):
            break
        before = now
        new = edges.filter("seed is null").join(patterns, "context").groupBy("instance", "kind").agg(F.max("confidence").alias("belief"))
        known = written(seeds.unionByName(new.join(seeds.select("instance"), "instance", "left_anti")), "believed-instances")
    return patterns.groupBy("context").agg(F.max_by(F.struct("kind", "support"), "confidence").alias("k"), F.max("confidence").alias("confidence")).select("context", "k.kind", "k.support", "confidence")


def find_private(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: key, text_hash, base, spans (base spans and found ones, sorted)."""
    rows = written(scanned(docs, key=key, text=text).withColumn("row", F.monotonically_increasing_id()), "private-rows")
    return _with_found(rows)


def _found(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by..., found): spans of candidates behind confident patterns, without those that a base span touches."""
    seen = rows.select(*by, "base", F.inline("seen"))
    patterns = confident_patterns(seen.select("context", "instance", "kind")).select("context", F.col("kind").alias("of"))
    new = seen.filter("kind is null").join(patterns, "context").select(*by, F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.concat(F.lit("found_"), "of").alias("kind")).alias("span"))
    return new.groupBy(*by).agg(F.collect_set("span").alias("found"))


def _with_found(rows: DataFrame) -> DataFrame:
    found = _found(rows, ["row"])
    none = F.expr("slice(base, 1, 0)")
    return rows.join(found, "row", "left").withColumn("spans", F.array_sort(F.concat("base", F.coalesce("found", none)))).drop("row", "seen", "found")


def masked_text(text: str, spans: str) -> Column:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    low, high = f"greatest(A - k * {BLOCK}, 0)", f"least(Z - k * {BLOCK}, {BLOCK})"
    cut = f"if(Z <= A, '', array_join(transform(sequence(A div {BLOCK}, (Z - 1) div {BLOCK}), k -> substring(get(b, cast(k as int)), cast({low} + 1 as int), cast({high} - {low} as int))), ''))"
    piece = lambda a, z: cut.replace("A", a).replace("Z", z)
    one = f"if(i > 0 and x.start < p, '', concat({piece('p', 'x.start')}, '[', upper(replace(x.kind, 'found_', '')), ']'))"
    each = f"transform(s, (x, i) -> {_let('p', 'if(i = 0, 0L, get(m, i - 1))', one)})"
    reach = _running("transform(s, x -> x.`end`)", "greatest(a, y)")
    rest = piece("get(m, size(m) - 1)", f"length({text})")
    whole = _let("s", spans, _let("m", reach, _let("b", f"regexp_extract_all({text}, '(?s).{{1,{BLOCK}}}', 0)", f"concat(array_join({each}, ''), {rest})")))
    return F.expr(f"if(size({spans}) = 0, {text}, {whole})")


def mask(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """docs with personal data masked in the text, and its length in `size` where docs have that column. Columns are kept
    in one struct meanwhile, so that none is overwritten."""
    found = _found(written(scanned(docs, key=key, text=text), "private-rows"), [key, "text_hash"]).toDF("__key", "__hash", "found")
    found = written(found, "private-found")  # its size tells whether texts must be shuffled to meet it
    mine = with_base(docs.select(F.struct(*docs.columns).alias("docs"), native.whole(text).alias("text")), "text", "base")
    joined = mine.join(found, F.col(f"docs.{key}").eqNullSafe(F.col("__key")) & (F.xxhash64("text") == F.col("__hash")), "left")
    spans = joined.withColumn("spans", F.array_sort(F.concat("base", F.coalesce("found", F.expr("slice(base, 1, 0)")))))
    masked = spans.withColumn("masked", F.when(F.col(f"docs.{text}").isNotNull(), masked_text("text", "spans")))
    out = {text: F.col("masked")}
    if size in docs.columns:
        out[size] = F.when(F.size("spans") > 0, F.length("masked")).otherwise(F.col(f"docs.{size}")).cast(docs.schema[size].dataType)
    return masked.select(*[out.get(c, F.col(f"docs.{c}")).alias(c) for c in docs.columns])


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.`end`)), ',')")


def digest(found: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
