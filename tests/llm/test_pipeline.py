import hashlib
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from harborline.llm import packing
from harborline.llm.store import written
from tests.llm import data
from tests.llm.test_dedup import _components, _shingles
from tests.llm.test_native import _private


def test_no_rows_and_rows_of_nulls(spark, none, tmp_path):
    none.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() == 0
    nulls = spark.createDataFrame([tuple([None] * len(none.columns))] * 3, none.schema)
    nulls.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0
    for _, stage in corpus_pipeline.STAGES[1:]:  # rows that the quality rules would have rejected
        assert stage(spark, nulls, "").count() == 3


def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = written(stage(spark, now, str(tmp_path)), name)
        seen[name] = now
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == before.columns
    assert 0 < seen["near_duplicates"].count() < seen["quality_rules"].count() < docs.count()
    assert seen["personal_data"].count() == seen["near_duplicates"].count()
    texts = {r["text"] for r in seen["personal_data"].collect()}
    assert {r["text"] for r in seen["mix_sources"].collect()} <= texts
    run = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: Counter(tuple(r) for r in packing.digest(df).collect())
    assert key(run) == key(seen["pack_lengths"])


def _passes(text):
    """Policy 2 of the quality rules."""
    w = data.words(text)
    n, chars = len(w), sum(map(len, w))
    runs = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    again = {j for i in range(n - 2) if runs[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if data.words(x)]
    symbols, capitals = len(re.findall(r"[#*$%&|<>]", text or "")), len(re.findall("[A-Z]", text or ""))
    repeated = len(lines) >= 4 and 2 * (len(lines) - len(set(lines))) > len(lines)
    return n >= 50 and 100 * len(again) <= 50 * n and 100 * symbols <= 30 * n and 2 * n <= chars <= 20 * n and not repeated and 2 * capitals <= chars


def _one_of_each(rows):
    component = {(doc, n): comp for doc, n, comp in _components(rows)}
    return list({(r[0], r[1]): r for r in rows if r[0] == component[(r[0], len(_shingles(r[1])))]}.values())


def _masked(text):
    found = [(m.start(), 9, m.end(), "email") for m in re.finditer(r"(?<=write to )desk[0-9]+-[a-z]+", text)]
    out, at = "", 0
    for start, _, end, kind in sorted(_private(text) + found):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def _mixed(rows):
    """(doc_id, text, source) as often as the mix takes it."""
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    queue = []
    for i, source in enumerate(sources):
        own = sorted((hashlib.md5(f"mix-1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), len(data.words(r[1])), r) for r in rows if r[2] == source)
        whole, served, weight = sum(n for _, n, _ in own), 0, i % 3 + 1
        for place, n, r in own:
            served += n
            queue += [((2 * ((k - 1) * whole + served) - n) / (2 * weight), "n" if source is None else f"s{source}", place, n, k, r) for k in (1, 2, 3)]
    budget, end, out = sum(len(data.words(r[1])) for r in rows), 0, []
    for *_, n, _, r in sorted(queue, key=lambda q: q[:5]):
        end += n
        if 2 * end - n <= 2 * budget:
            out.append(r)
    return out


def test_the_pipeline_is_that_of_brute_force(spark, rows, tmp_path):
    planted = {0: "", 1: " write to a{0}@b.org or +1 743 555 38{0:02d} ", 2: " write to desk{0}-lund now "}
    mine = [(r[0], r[1] and r[1] + planted[0 if r[0] is None else 2 if r[0] == 108 else int(r[0] % 4 > 0)].format(r[0]), *r[2:]) for r in rows]
    spark.createDataFrame(mine, data.SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    good = [r for r in mine if _passes(r[1])]
    kept = _one_of_each(good)
    assert len(rows) > len(good) > len(kept) > 10
    clean = [(r[0], _masked(r[1]), r[3]) for r in kept]
    assert sum("[EMAIL]" in r[1] for r in clean) > 5 and sum("desk" in r[1] for r in kept) == 1
    taken = _mixed(clean)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = [(r[0], len(tokenizer.encode(r[1], add_special_tokens=False).ids)) for r in taken]
    found = [tuple(r) for r in packing.digest(corpus_pipeline.run(spark, str(tmp_path))).collect()]
    bounds = [b for _, b in sorted({(r[5], r[6]) for r in found})]
    assert sum(r[9] for r in found) == data.least_padding(Counter(r[4] for r in found), packing.BUCKETS)
    assert Counter(found) == data.packed(spark, lengths, bounds)
