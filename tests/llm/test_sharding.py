"""Shards against a partition found by trying all capacities over the whole order."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from harborline.llm import sharding

SCHEMA = "doc_id long, text string, shard string, size string, __h string, __row int, h int, place int"


def least_capacity(sizes, shards):
    def fits(c):
        n, filled = 1, 0
        for s in sizes:
            if filled + s > c:
                n, filled = n + 1, 0
            filled += s
        return n <= shards

    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        c = (low + high) // 2
        low, high = (low, c) if fits(c) else (c + 1, high)
    return low


def ordered_groups(spark, texts):
    """(hash, bytes of the group) in order of hash; only the hash is Spark's."""
    distinct = sorted({t or "" for t in texts})
    h = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for t in distinct], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    sizes = Counter()
    for t in texts:
        sizes[h[t or ""]] += len((t or "").encode()) + 1
    return sorted(sizes.items())


def checked(spark, rows, got, shards):
    """got: rows with doc_id, text, size, shard, slot."""
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    slots, places, filled = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        assert r["n"] == len((r["text"] or "").encode()) + 1 and 0 <= r["at"] < shards
        slots[r["at"]].append(r["slot"])
        places[r["text"] or ""].add(r["at"])
        filled[r["at"]] += r["n"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())
    sizes, alone = [s for _, s in ordered_groups(spark, [r[1] for r in rows])], []
    left = sum(sizes)
    for s in sorted(sizes, reverse=True)[: shards - 1]:
        if s * (shards - len(alone)) <= left:
            break
        alone.append(s)
        left -= s
        sizes.remove(s)
    assert max(filled.values(), default=0) == max([*alone, least_capacity(sizes, shards - len(alone))])
    return filled


def run(spark, rows, shards=8):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = sharding.names(df)
    made = sharding.assign(df, shards=shards)
    assert made.columns == [*df.columns, *out.values()]
    return made.select("*", F.col(out["shard"]).alias("at"), F.col(out["size"]).alias("n")).collect()


def made_rows(n, seed, hot=0, longest=40):
    rng = random.Random(seed)
    texts = [None, "", "é😀", "hot text " * 5] + ["".join(rng.choice("abc é") for _ in range(rng.randint(1, longest))) for _ in range(n)]
    rows = [(i if i % 9 else None, t, "clash", "clash", "clash", 1, 2, 3) for i, t in enumerate(texts)]
    return rows + rows[:20] + [(1000 + i, "hot text " * 5, *[None] * 6) for i in range(hot)]


@pytest.mark.parametrize(("n", "hot", "shards", "longest"), [(600, 0, 8, 40), (300, 700, 8, 40), (5, 0, 8, 40), (40, 3, 5, 2000), (200, 0, 1, 40)])
def test_shards_are_whole_and_least(spark, n, hot, shards, longest):
    rows = made_rows(n, n, hot, longest)
    checked(spark, rows, run(spark, rows, shards), shards)


def test_even_shares_and_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCKS_HELD", 2)
    monkeypatch.setattr(sharding, "CELL_BYTES", 500)
    rows = made_rows(3000, 5)
    filled = checked(spark, rows, run(spark, rows), 8)
    assert max(filled.values()) - min(filled.values()) < 400


def test_hot_text_leaves_even_rest(spark):
    rows = made_rows(800, 3, 1500)
    filled = sorted(checked(spark, rows, run(spark, rows), 8).values())
    assert filled[-1] > 3 * filled[-2] and filled[-2] - filled[0] < 300


def test_no_rows_and_texts_as_keys(spark, none):
    assert sharding.assign(none).isEmpty() and sharding.digest(none).isEmpty()
    keyed = sharding.assign(spark.createDataFrame([("a", "x"), (None, "x"), ("b", "yy")], "id string, body string"), key="id", text="body", shards=2).collect()
    assert sorted(r["slot"] for r in keyed if r["body"] == "x") == [0, 1]
    assert {r["shard"] for r in keyed} == {0, 1}


def test_files_and_reruns(spark, docs, rows, tmp_path):
    path, back = sharding.write(docs, str(tmp_path / "shards"))
    first = Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in back.collect())
    again = Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in sharding.assign(docs.repartition(5)).collect())
    assert Counter((d, t, s) for d, t, s, _ in first.elements()) == Counter((d, t, s) for d, t, s, _ in again.elements()) and sum(first.values()) == len(rows)
    assert sum(sharding.read(spark, path, s).count() for s in range(8)) == len(rows)
    for r in sharding.digest(docs).collect():
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["text_crc32"] < 1 << 32
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.digest(docs).collect()) == want
