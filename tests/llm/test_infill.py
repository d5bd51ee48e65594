"""Fill-in-middle against a version in plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harborline.llm import infill
from tests.llm import data

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, form string, infilled string, n_units int, __key string"


def example(doc_id, text, seed="42", plain_from=50, spm_below=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= plain_from:
        return text, "plain", len(units), None, None
    if h4 % 100 < spm_below:
        return f"<S>{s}<P>{p}<M>{m}", "spm", len(units), len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", len(units), len(p), len(m)


AWKWARD = [None, "", " ", "\n\t  ", "a", " a", "a ", "a <P> mark", "<S>", "<", "ends in <", "<P", "P> starts", "é😀 ü\x0b\x0cx", "no break space", "nul\x00 byte", "Q" * 50_000, " " * 50_000, "w é" * 200_000]


@pytest.fixture(scope="module")
def cases():
    return [(i * 7 + j, text, "clash", "clash", 1, "clash") for j in range(7) for i, text in enumerate(AWKWARD)] + [(None, "a b c", None, None, None, None)] * 2 + [(5, "one two", None, None, None, None)] * 3


@pytest.fixture(scope="module")
def made(spark, cases):
    return infill.infill(spark.createDataFrame(cases, SCHEMA).repartition(3)).cache()


def test_equals_brute_force_with_clashing_names(made, cases):
    assert made.columns == ["doc_id", "text", "form", "infilled", "n_units", "__key", "_infilled", "_form", "_n_units", "prefix_chars", "middle_chars"]
    got = Counter(tuple(r) for r in made.collect())
    assert got == Counter((*r, *example(r[0], r[1])) for r in cases)
    assert {r[7] for r in got} == {"plain", "spm", "psm"}


def test_restores_texts(made):
    back = infill.restored(F.col("_infilled"), F.col("_form"))
    assert made.filter(~back.eqNullSafe(F.coalesce("text", F.lit("")))).isEmpty()


def test_rates_and_seed(spark, cases):
    few = spark.createDataFrame(cases, SCHEMA).drop("form")
    all_psm = infill.infill(few, seed="7", plain_from=100, spm_below=0).collect()
    assert Counter((r["_infilled"], r["form"]) for r in all_psm) == Counter(example(r[0], r[1], "7", 100, 0)[:2] for r in cases)


def test_texts_as_keys_and_no_rows(spark, none):
    keyed = infill.infill(spark.createDataFrame([("k1", "a b"), (None, "c d")], "id string, body string"), key="id", text="body").collect()
    assert {r["infilled"] for r in keyed} == {example("k1", "a b")[0], example(None, "c d")[0]}
    assert infill.infill(none).isEmpty() and infill.digest(none).count() == 0


def test_digest_of_made_documents(docs):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter()
    for r in data.made():
        text, form, n, p, m = example(r[0], r[1])
        want[(r[0], n, form, p, m, sha(text), sha(r[1] or ""))] += 1
    assert Counter(tuple(r) for r in infill.digest(docs).collect()) == want
