"""Ranked search against scores of all documents in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from harborline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranking(docs, items, k=10):
    """Rows of (item, rank, doc, score)."""
    counts = [(key, Counter(terms(text))) for key, text in docs]
    counts = [(key, c, c.total()) for key, c in counts if c]
    total, df = sum(n for _, _, n in counts), Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if df[t]}
        scores = [(sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * len(counts)) // total))) for t, w in weights.items()), key) for key, c, n in counts]
        best = sorted((-s, key is None, 0 if key is None else key) for s, key in scores if s > 0)[:k]
        out += [(item, r, None if null else key, -s) for r, (s, null, key) in enumerate(best, 1)]
    return Counter(out)


def made(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(120)] + ["Zürich", "42", "x_y", "A-B", "İ", "ß", " ", "中文"]
    docs = [(rng.randint(0, 3 * n) if rng.random() > 0.1 else None, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 30, 200])))) for _ in range(n)]
    docs += [(1, None), (2, ""), (3, " ...! "), (None, None)] + [(rng.randint(0, 99), docs[7][1]) for _ in range(30)] + [docs[9]] * 15
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 40])))) for i in range(12)] + [(20, docs[7][1]), (21, None), (22, "!"), (23, "notthere"), (24, docs[9][1] + " notthere"), (25, docs[9][1] * 2)]
    return docs, items


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, "clash", 1) for x in docs], "doc_id long, text string, key string, n int").repartition(3)
    q = lexical.term_counts(spark.createDataFrame([(*x, "clash", 1) for x in items], "item_id long, text string, terms string, score int"), "item_id", "text")
    index = lexical.build(d, queries=q if options.pop("asked", True) else None)
    return index, Counter(tuple(r) for r in lexical.search(index, q, **options).collect())


@pytest.mark.parametrize(("n", "asked", "k"), [(400, True, 10), (60, False, 10), (250, True, 3)])
def test_equals_scores_of_all(spark, n, asked, k):
    docs, items = made(n, n)
    _, got = run(spark, docs, items, asked=asked, k=k)
    assert got == ranking(docs, items, k)


def test_small_ranges_blocks_and_tasks(spark, monkeypatch):
    for name, value in (("RANGE_DOCS", 20), ("RANGE_ENTRIES", 300), ("BLOCK_TERMS", 50), ("PARTITION_DOCS", 100)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = made(500, 2)
    index, got = run(spark, docs, items)
    assert got == ranking(docs, items) and index.ranges.count() > 20


def test_bounds_hold_and_branches_are_left_closed(monkeypatch):
    rng = np.random.default_rng(1)
    docs, width = 700, 50
    dense = np.where(rng.random((docs, width)) < 0.2, rng.integers(1, 10**6, (docs, width)), 0)
    dense[:, 0] += 1
    dense[300] = 10**6 + 5  # more than any bound without it
    doc, term = np.nonzero(dense)
    levels, first, node_terms, values = lexical._tree(doc, term, dense[doc, term], docs, width)
    assert levels == [700, 88, 11, 2, 1] and len(first) == sum(levels) + 1
    start = np.concatenate(([0], np.cumsum(levels)))
    for level in range(len(levels)):
        for node in range(levels[level]):
            here = slice(first[start[level] + node], first[start[level] + node + 1])
            below = dense[node * 8**level : (node + 1) * 8**level].max(0)
            got = np.zeros(width, np.int64)
            got[node_terms[here]] = values[here]
            assert (got == below).all()
    opened = Counter()
    real = lexical._Range.children
    monkeypatch.setattr(lexical._Range, "children", lambda self, level, node, weights: opened.update([level]) or real(self, level, node, weights))
    import pyarrow as pa

    block = lexical._Block([{"query": 5, "terms": [f"t{i}" for i in range(width)], "weights": [int(w) for w in rng.integers(1, 9000, width)]}])
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    blob = lambda x: pa.array([x.astype("<i4").tobytes()], pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0]), one(pa.array(range(docs))), one(pa.array([f"t{i}" for i in range(width)])), blob(dense.max(0)), one(pa.array(levels, pa.int32())), blob(first), blob(node_terms), blob(values)],
        ["range", "keys", "terms", "tops", "levels", "first", "node_terms", "node_values"])
    best = lexical._Best(1, 0)
    lexical._descend([lexical._Range(batch, 0, block)], block, 0, best)
    scores = dense @ block.weight[np.argsort([int(t[1:]) for t in block.terms.to_pylist()])]
    assert best.rows == [(-int(scores.max()), False, int(scores.argmax()))] and opened == {4: 1, 3: 1, 2: 1, 1: 1}


def test_no_rows(spark, none):
    docs, items = made(20, 3)
    assert run(spark, [], items)[1] == Counter() and run(spark, docs, [])[1] == Counter() and run(spark, docs, [(1, None)])[1] == Counter()


def test_texts_as_keys(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")] + [(f"k{i}", "other words") for i in range(9)], "id string, body string")
    q = lexical.term_counts(spark.createDataFrame([("q", "X!")], "id string, body string"), "id", "body")
    assert [(r["rank"], r["doc"]) for r in lexical.search(lexical.build(d, key="id", text="body", queries=q), q).orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]
