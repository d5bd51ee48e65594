"""Small documents with every awkward case, and brute-force versions of the operators."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from harborline.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, node long, rows int"


def made(seed: int = 1) -> list[tuple]:
    """Clean prose, copies, edited copies, shared passages, junk; nulls, empty and repeated rows; clashing column names."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = prose(60)
    out, texts = [], []
    for i in range(60):
        words = prose(rng.choice([1, 3, 4, 5, 34, 35, 36, 70, 150, 400]))
        if i % 7 == 0:
            at = rng.randint(0, len(words))
            words = words[:at] + passage + words[at:]
        if i % 11 == 0 and texts:
            words = WORD.findall(rng.choice(texts))
            for _ in range(len(words) // 60):
                words[rng.randrange(len(words))] = "changed"
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    texts += [texts[3], texts[20].upper(), "x y z " * 80, "", "  \n\t ", None, "Ünï 😀 cödé " * 30, "one\ntwo\none\n\ntwo\nthree", "a", "a b c d", "a b c d"]
    for i, text in enumerate(texts):
        source = [None, "s1", "s2", "é", "S"][i % 5] if i % 3 else "hot"
        out.append((i * 3 if i else None, text, "en", source, len(text or ""), "clash", 7, 1))
    out += [out[5], out[5], (out[9][0], "another text under a used number", None, None, None, None, None, None)]
    out.append((10_000, " ".join(prose(20_000)), "en", "hot", None, None, None, None))
    return out


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def least_padding(counts: Counter, buckets: int) -> int:
    """The least padding of lengths (with counts) in at most so many buckets."""
    lengths = sorted(counts)
    best = {0: 0}
    for _ in range(buckets):
        new = dict(best)
        for j in range(1, len(lengths) + 1):
            for i in range(j):
                if i in best:
                    cost = best[i] + sum(counts[x] * (lengths[j - 1] - x) for x in lengths[i:j])
                    new[j] = min(new.get(j, cost), cost)
        best = new
    return best[len(lengths)]


def packed(spark, documents: list[tuple], bounds: list[int], budget: int = packing.TOKEN_BUDGET) -> Counter:
    """Rows of packing's digest for (doc_id, n_tokens), with given bounds; only the places' hashes are Spark's."""
    pieces = [(doc, n, k, min(n - k * packing.MAX_LENGTH, packing.MAX_LENGTH)) for doc, n in documents for k in range(max(1, math.ceil(n / packing.MAX_LENGTH)))]
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pieces)], "doc_id long, n long, piece int, length int, i int")
    place = {r["i"]: r["place"] for r in df.select("i", F.xxhash64(F.lit(packing.SEED), "doc_id", "piece").alias("place")).collect()}
    cells = max(1, math.isqrt(len(pieces)))
    by_bucket: dict[int, list] = {}
    for i, p in enumerate(pieces):
        by_bucket.setdefault(next(b for b, x in enumerate(bounds) if p[3] <= x), []).append((place[i] % cells, place[i], p[3], p))
    out = Counter()
    for bucket, members in by_bucket.items():
        fit = max(1, budget // max(1, bounds[bucket]))
        for number, (_, _, length, (doc, n, k, _)) in enumerate(sorted(members, key=lambda m: m[:3])):
            out[(doc, n, k, k * packing.MAX_LENGTH, length, bucket, bounds[bucket], number // fit, number % fit, bounds[bucket] - length)] += 1
    return out
