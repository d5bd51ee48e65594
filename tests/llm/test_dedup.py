import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from harborline.llm import near_dedup, substrings
from harborline.llm import words as W
from tests.llm.data import words

LOWER = {i: i + 32 for i in range(65, 91)}


def _shingles(text):
    w = tuple(words((text or "").translate(LOWER)))
    return frozenset([w] if 0 < len(w) < 5 else [w[i : i + 5] for i in range(len(w) - 4)])


def _components(rows):
    sets = [_shingles(r[1]) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(a & sets[j])
                if a and label[i] != label[j] and 100 * both >= 75 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = r[0] if x not in least or least[x] is None else min(v for v in (least[x], r[0]) if v is not None)
    return Counter((r[0], len(s), r[0] if not s else least[x]) for r, s, x in zip(rows, sets, label, strict=True))


def test_near_duplicates_are_those_of_brute_force(docs, rows):
    found = near_dedup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == _components(rows)


def test_one_document_of_each_group_stays(docs, rows):
    kept = near_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns
    stay = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    expected = Counter()
    brute = {(doc, n): comp for (doc, n, comp) in _components(rows)}
    for r in rows:
        n = len(_shingles(r[1]))
        if n == 0:
            expected[(r[0], r[1])] += 1
        elif r[0] == brute[(r[0], n)]:
            expected[(r[0], r[1])] = 1
    assert stay == expected


def test_no_rows(none):
    assert near_dedup.near_duplicates(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.75, 0.9):
        pool = rng.integers(0, 2**64, 4000, dtype=np.uint64)
        n = int(2000 * 2 * share / (1 + share))
        a, b = np.unique(pool[:2000]), np.unique(np.concatenate((pool[:n], pool[2000 : 4000 - n])))
        regs = [near_dedup.registers(np.zeros(len(x), np.int64), x, 1) for x in (a, b)]
        est, used = near_dedup.estimate(regs[0], regs[1], np.array([len(a)]), np.array([len(b)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(est[0] - true) < 4 * np.sqrt(true * (1 - true) / used[0]) + 0.01


def test_many_edited_copies_are_linked_as_by_brute_force(spark):
    import random

    rng = random.Random(3)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    rows = []
    for i in range(150):
        copy = [w if rng.random() > rng.choice([0.0, 0.02, 0.05, 0.1]) else f"e{rng.randint(0, 9999)}" for w in base]
        rows.append((i, " ".join(copy)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == _components(rows)


def test_substrings_are_removed_as_by_brute_force(docs, rows):
    starts = Counter()
    for r in rows:
        w = words(r[1])
        starts.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    expected = Counter()
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if starts[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected[(r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    found = substrings.digest(substrings.remove_repeats(docs)).collect()
    assert Counter(tuple(r) for r in found) == expected
    assert sum(k[2] for k in expected) > 0


def test_words_that_collide_under_polynomials_are_told_apart(spark):
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    rows = [(1, " ".join([a] * 40)), (2, " ".join([b] * 40)), (3, " ".join([a, *"cdefg"])), (4, " ".join([b, *"cdefg"])), (5, a), (6, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == _components(rows)
    mixed = [(1, " ".join([a, *map(str, range(40))])), (2, " ".join([b, *map(str, range(40))]))]
    repeats = {r["doc_id"]: r["repeats"] for r in substrings.remove_repeats(spark.createDataFrame(mixed, "doc_id long, text string")).collect()}
    assert [[(s["first_word"], s["end_word"]) for s in repeats[i]] for i in (1, 2)] == [[(1, 41)], [(1, 41)]]


def test_repeated_spans_tell_the_removed_words(docs):
    for r in substrings.remove_repeats(docs).collect():
        assert sum(s["end_word"] - s["first_word"] for s in r["repeats"]) == r["n_removed"]
        assert len(words(r["kept_text"])) == r["n_words"] - r["n_removed"]


def test_word_places_and_packing():
    texts = pa.array(["  a\x0bbc\x1cd é\n", None, "", "x", " y z\t"])
    data, ends = W.utf8(texts)
    starts, stops, firsts = W.find(data, ends)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, stops, strict=True)] == [w for t in texts.to_pylist() for w in words(t)]
    assert firsts.tolist() == [0, 3, 3, 3, 4, 6]
    values = np.unique(np.random.default_rng(1).integers(0, 2**64, 999, dtype=np.uint64))
    assert (W.unpack(W.pack(values)) == values).all() and len(W.unpack(b"")) == 0


def test_many_rows_without_ids(spark):
    """Rows under one key meet their own text only."""
    import time

    rng = random.Random(8)
    prose = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)) for _ in range(1000)]
    rows = [(None, t) for t in prose] + [(None, t + " more") for t in prose]
    began = time.time()
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 2000 and {r["n_shingles"] for r in found} == {36, 37} and {r["component_id"] for r in found} == {None}
    assert time.time() - began < 120
