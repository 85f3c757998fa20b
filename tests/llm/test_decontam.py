"""Decontamination: substitutions, insertions, borders, and clean texts."""

import random

import pytest

from touchline.llm import decontam
from touchline.llm.queries import op8_decontamination

from .conftest import ODD, frame

ITEMS = "item_id int, text string, doc_id string, extra int"


def prose(rng, n):
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randint(0, 400)}" for _ in range(n)]


def pairs(df):
    return {(r["doc_id"], r["item_id"]): r for r in df.collect()}


def items(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], ITEMS)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    bench = [prose(rng, n) for n in (14, 20, 37, 59, 8)]
    rows, want = [], set()
    for d in range(200):
        own = prose(rng, rng.choice([0, 5, 40, 300]))
        kind = d % 8
        if kind in (1, 2, 3, 4, 5):
            i = d % len(bench)
            part = list(bench[i])
            if kind == 2:  # every sixth word replaced
                part = [w if j % 6 != 3 else "other" for j, w in enumerate(part)]
            if kind == 3:  # signs and capitals
                part = [f"“{w.upper()}”," for w in part]
            if kind == 4:  # a word more in the middle
                part.insert(len(part) // 2, "added")
            if kind == 5:  # lines and blanks
                part = " \n ".join(part).split(" ")
            at = rng.randint(0, len(own))
            own = own[:at] + part + own[at:]
            if kind in (1, 3, 5) or len(bench[i]) >= 14:
                want.add((d, i))
        if kind == 6:  # a short piece of an item is no passage
            own += bench[3][:6]
        rows.append((d, " ".join(own), "en", "s"))
    return frame(spark, rows), items(spark, [" ".join(b) for b in bench]), want


@pytest.mark.parametrize("block_tokens", [1_000_000, 30])
def test_planted_passages_and_nothing_else(planted, block_tokens):
    docs, bench, want = planted
    found = pairs(decontam.contaminated(docs, bench, block_tokens=block_tokens))
    assert want <= set(found)
    assert {d for d, _ in found} <= {d for d in range(200) if d % 8 in (1, 2, 3, 4, 5)}
    left = decontam.decontaminate(docs, bench, block_tokens=block_tokens)
    assert left.schema == docs.schema
    assert {r["doc_id"] for r in left.collect()} == set(range(200)) - {d for d, _ in found}


def test_odd_rows(spark, odd, none):
    bench = items(spark, [None, "", "one", "quick brown fox jumps over the lazy dog near the river bank", "x y", "QUICK brown fox jumps over the lazy dog near the river bank!"])
    found = decontam.contaminated(odd, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, k) for i in (1, 8, 8) for k in (3, 5)] or sorted(
        (r["doc_id"], r["item_id"]) for r in found
    ) == sorted([(1, 3), (1, 5), (8, 3), (8, 3), (8, 5), (8, 5)])
    assert decontam.decontaminate(odd, bench).count() == len(ODD) - 3
    assert decontam.contaminated(none, bench).count() == 0 == decontam.contaminated(odd, bench.limit(0)).count()
    assert decontam.decontaminate(odd, bench.limit(0)).count() == len(ODD)


def test_agreement_takes_the_best_stretch():
    import numpy as np

    doc = np.array([9, 1, 2, 3, 4, 0, 6, 7, 8, 9, 0, 0, 0, 0, 5], dtype=np.uint64)
    item = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9], dtype=np.uint64)
    assert decontam.agreement(doc, item, 1).tolist() in ([0, 1, 2, 3], [0, 1, 2, 3, 5, 6, 7, 8], [5, 6, 7, 8])
    assert decontam.agreement(doc, item, -8).tolist() == [8]
    assert decontam.agreement(doc, item, 40).tolist() == []


def test_query_finds_every_whole_item(spark, small):
    def tokens(text):
        return [w for w in map(decontam.token_hash, text.split()) if w]

    found = set(pairs(op8_decontamination(spark, small)))
    bench = [(r["item_id"], tokens(r["text"])) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    whole, any_ten = set(), set()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        own = tokens(r["text"] or "")
        runs = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for item, words in bench:
            if any(tuple(words[i : i + 5]) in runs for i in range(len(words) - 4)):
                any_ten.add((r["doc_id"], item))
            if any(own[i : i + len(words)] == words for i in range(len(own) - len(words) + 1)):
                whole.add((r["doc_id"], item))
    assert whole and whole <= found and found <= any_ten | whole
