r"""Chat formatting by quotation linking, with built-in functions only.

A line's quote level is the number of > marks before its text. Lines of one level in a row are a passage; passages are
put back into one line each, lower-cased and stripped of marks, so that quotes match that were wrapped anew. A passage,
and all of a level together, is hashed as a whole and looked up among the own passages and whole texts of messages: the
latest earlier message of the same conversation that has it is linked. Passages that aren't found there are cut into
sentences, which are looked up in the same way (for shortened quotes); only then come other conversations, the latest
earlier one first. Passages under LEAST_WORDS words are compared with whole messages of the same conversation only.

A link weighs as many sentences as it covers, over the number of messages that have its words themselves, so what
everybody says counts little. The parent is the message with most weight at level 1, or at the lowest level with any link
(ties: the latest). A conversation whose messages answer an earlier conversation joins its thread.

The latest earlier message is found by digits of the turn (or conversation) in base 64: rows of a hash meet in groups of
64 at most, level by level, so a sentence that a third of all messages share pairs nothing with everything.

Messages lose their quotes and the line that introduces one (`... wrote:`). A parent is earlier than its replies, so the
order thread, conversation, turn puts each reply after what it answers; rows are range-sorted, never gathered.

A null text stays null, an empty one stays empty; neither has a parent by quotes. In `formatted` a message's own "<|" is written "<||" and a role's "|" is written "||", so that neither can
look like a mark. Conversations and turns are numbers, or texts of numbers: their order tells which message is earlier. A null conversation or turn has no
parent. Repeated rows stay, with equal results. Extra columns are dropped.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.store import written

LEAST_WORDS = 3
QUOTE = r"^[ \\t]*((?:>[ ]?)+)"
#: A line that ends so and stands before a deeper quote introduces it, in any language.
INTRODUCES = r": *$"


def _lines(text: str) -> str:
    return rf"transform(split(coalesce({text}, ''), '\n', -1), l -> struct(length(regexp_replace(regexp_extract(l, '{QUOTE}', 1), '[^>]', '')) as level, regexp_replace(l, '{QUOTE}', '') as body))"


def _plain(body: str) -> str:
    return f"btrim(regexp_replace(lower({body}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"


def _sentences(body: str) -> str:
    plain = f"filter(transform(split({body}, '[.!?]+', -1), s -> {_plain('s')}), s -> size(split(s, ' ')) >= {LEAST_WORDS})"
    return f"array_distinct(transform({plain}, s -> xxhash64(s)))"


def _passages(bodies: str) -> str:
    """array<struct<level, hash, short, sentences>> of array<struct<level, body>>; hashes differ from those of sentences."""
    plain = f"filter(transform({bodies}, p -> struct(p.level, p.body, {_plain('p.body')} as plain)), p -> p.plain <> '')"
    return f"array_distinct(transform({plain}, p -> struct(p.level, xxhash64(p.plain, 'passage') as hash, size(split(p.plain, ' ')) < {LEAST_WORDS} as short, {_sentences('p.body')} as sentences)))"


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, text_hash, own (text without quotes), own_hashes, passages (quoted), n_quoted (sentences)."""
    df = messages.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("text_hash"))
    df = df.withColumn("__lines", F.expr(_lines("text")))
    df = df.withColumn("__lines", F.expr(f"transform(__lines, (l, i) -> struct(l.level, l.body, l.body rlike '{INTRODUCES}' and coalesce(get(__lines, i + 1).level, 0) > l.level as intro))"))
    df = df.withColumn("__own", F.expr("transform(filter(__lines, l -> l.level = 0 and not l.intro), l -> l.body)"))
    quoted = F.expr("size(filter(__lines, l -> l.level > 0)) > 0")
    own = F.when(F.col("text").isNull(), None).when(quoted, F.btrim(F.array_join("__own", "\n"), F.lit(" \n\t\r"))).otherwise(F.col("text"))
    df = df.withColumn("own", own)
    df = df.withColumn("__starts", F.expr("filter(transform(__lines, (l, i) -> if(i = 0 or l.level <> get(__lines, i - 1).level, i, -1)), i -> i >= 0)"))
    body = lambda lines: f"array_join(transform(filter({lines}, l -> not l.intro), l -> l.body), ' ')"
    run = "slice(__lines, a + 1, coalesce(get(__starts, j + 1), size(__lines)) - a)"
    df = df.withColumn("__runs", F.expr(f"transform(__starts, (a, j) -> struct(get(__lines, a).level as level, {body(run)} as body))"))
    levels = "array_distinct(transform(filter(__lines, l -> l.level > 0), l -> l.level))"
    df = df.withColumn("__whole", F.expr(f"transform({levels}, v -> struct(v as level, {body('filter(__lines, l -> l.level = v)')} as body))"))
    df = df.withColumn("passages", F.expr(_passages("concat(filter(__runs, r -> r.level > 0), __whole)")))
    df = df.withColumn("n_quoted", F.expr(f"aggregate(__whole, 0L, (n, w) -> n + size({_sentences('w.body')}))"))
    runs = "if(size(__whole) > 0, filter(__runs, r -> r.level = 0), array())"
    df = df.withColumn("__own_passages", F.expr(_passages(f"concat(array(struct(0 as level, coalesce(own, '') as body)), {runs})")))
    # the first is the whole text; parts of it count if they aren't short
    df = df.withColumn("own_hashes", F.expr("array_distinct(flatten(transform(__own_passages, (p, i) -> concat(if(i = 0 or not p.short, array(p.hash), array()), p.sentences))))"))
    return df.drop("__lines", "__own", "__starts", "__runs", "__whole", "__own_passages")


def _latest_before(rows: DataFrame, asked: DataFrame, keys: list[str], at: str, low: int, high: int) -> DataFrame:
    """asked (keys, at), with found: the struct<at, turn> of rows with equal keys and the largest smaller at."""
    top = next(k for k in range(1, 12) if k == 11 or low >> 6 * k == high >> 6 * k)
    digits = F.explode(F.sequence(F.lit(0), F.lit(top - 1)))
    spread = lambda df: df.withColumn("k", digits).withColumns({
        "node": F.expr(f"if(k = {top - 1}, 0L, shiftright({at}, 6 * (k + 1)))"), "child": F.expr(f"shiftright({at}, 6 * k)")})
    best = spread(rows).groupBy(*keys, "k", "node", "child").agg(F.max(F.struct(F.col(at).alias("at"), "turn")).alias("best"))
    nodes = best.groupBy(*keys, "k", "node").agg(F.collect_list(F.struct("child", "best")).alias("children"))
    joined = spread(asked).join(nodes, [*keys, "k", "node"]).withColumn("found", F.expr("array_max(filter(children, c -> c.child < child)).best"))
    return joined.filter("found is not null").groupBy(*keys, at).agg(F.max("found").alias("found"))


def quote_links(found: DataFrame) -> DataFrame:
    """conv_id, turn, text_hash, level, of_conv, of_turn, weight: what each message quotes, by level."""
    found = found.filter("conv_id is not null and turn is not null").withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})
    found = written(found.select("conv_id", "turn", "text_hash", "own_hashes", "passages"), "hashes")
    passages = found.select("conv_id", "turn", "text_hash", F.inline("passages")).distinct()
    one = lambda h, whole, n: F.struct(h.alias("hash"), F.lit(whole).alias("whole"), n.cast("long").alias("n"))
    units = F.concat(F.array(one(F.col("hash"), True, F.greatest(F.size("sentences"), F.lit(1)))), F.transform("sentences", lambda h: one(h, False, F.lit(1))))
    asked = written(passages.select("conv_id", "turn", "text_hash", "level", "short", F.col("hash").alias("passage"), F.inline(units)), "quoted-hashes")
    own = found.select("conv_id", "turn", F.explode("own_hashes").alias("hash")).join(asked.select("hash").distinct(), "hash", "left_semi")
    own = written(own.distinct(), "own-hashes")
    low, high, first, last = own.agg(F.min("conv_id"), F.max("conv_id"), F.min("turn"), F.max("turn")).first()
    asks = found.agg(F.max("turn"), F.max("conv_id")).first()
    last, high = max(last or 0, asks[0] or 0), max(high or 0, asks[1] or 0)
    low, first = (x if x is not None else 0 for x in (low, first))
    here = _latest_before(own, asked.select("conv_id", "hash", "turn").distinct(), ["conv_id", "hash"], "turn", first, last)
    asked = written(asked.join(here.select("conv_id", "hash", "turn", F.col("found.at").alias("here")), ["conv_id", "hash", "turn"], "left"), "quoted-here")
    last_turns = own.groupBy("hash", "conv_id").agg(F.max("turn").alias("turn"))
    far = _latest_before(last_turns, asked.filter("here is null and not short").select("hash", "conv_id").distinct(), ["hash"], "conv_id", low, high)
    asked = asked.join(far.withColumnRenamed("found", "far"), ["hash", "conv_id"], "left").filter("here is not null or far is not null and not short")
    linked = asked.join(own.groupBy("hash").agg(F.count("*").alias("messages")), "hash").select(
        "conv_id", "turn", "text_hash", "level", "passage", "whole", F.col("here").isNull().alias("away"), F.expr("if(here is null, far.at, conv_id)").alias("of_conv"),
        F.coalesce("here", "far.turn").alias("of_turn"), F.expr(f"n * {1 << 40}L div messages").alias("weight"))
    link = F.struct("of_conv", "of_turn", "weight")
    each = linked.groupBy("conv_id", "turn", "text_hash", "level", "passage").agg(
        F.max(F.when(F.col("whole"), F.struct(~F.col("away"), link.alias("link")))).alias("whole"), F.collect_list(F.when(~F.col("whole"), link)).alias("parts"),
        F.bool_or(~F.col("whole") & ~F.col("away")).alias("parts_here"))
    used = F.when(F.col("whole").isNotNull() & (F.expr("whole.col1") | ~F.col("parts_here")), F.array("whole.link")).otherwise(F.col("parts"))
    return each.select("conv_id", "turn", "text_hash", "level", F.inline(used)).groupBy("conv_id", "turn", "text_hash", "level", "of_conv", "of_turn").agg(F.sum("weight").alias("weight"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, thread): the first conversation that a conversation's messages answer, directly or through others."""
    up = written(parents.filter("of_conv < conv_id").groupBy("conv_id").agg(F.min("of_conv").alias("thread")), "threads")
    while True:
        higher = up.select(F.col("conv_id").alias("thread"), F.col("thread").alias("above"))
        new = written(up.join(higher, "thread", "left").select("conv_id", F.coalesce("above", "thread").alias("thread"), F.col("above").isNotNull().alias("moved")), "threads")
        up = new.select("conv_id", "thread")
        if new.filter("moved").isEmpty():
            return up


def reply_ordered(messages: DataFrame) -> DataFrame:
    """thread, conv_id, turn, role, text (without quotes), formatted, n_quoted, parent_conv, parent_turn; in reply order."""
    found = parsed(messages)
    links = written(quote_links(found), "quote-links")
    best = F.max(F.struct(-F.col("level"), "weight", "of_conv", "of_turn")).alias("best")
    parents = links.groupBy("conv_id", "turn", "text_hash").agg(best).select("conv_id", "turn", "text_hash", "best.of_conv", "best.of_turn")
    joined = found.join(parents, ["conv_id", "turn", "text_hash"], "left").join(threads(parents), "conv_id", "left")
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("<||"))
    role = F.replace(F.coalesce("role", F.lit("user")), F.lit("|"), F.lit("||"))
    turn: Column = F.concat(F.lit("<|"), role, F.lit("|>\n"), safe(F.coalesce("own", F.lit(""))), F.lit("\n<|end|>\n"))
    return joined.select(
        F.coalesce("thread", "conv_id").alias("thread"), "conv_id", "turn", "role", F.col("own").alias("text"), turn.alias("formatted"),
        "n_quoted", F.col("of_conv").alias("parent_conv"), F.col("of_turn").alias("parent_turn"),
    ).orderBy("thread", "conv_id", "turn")
