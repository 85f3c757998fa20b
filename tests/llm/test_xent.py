"""LM scoring against dictionaries of counts."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from touchline.llm import xent
from touchline.llm.decontam import token_hash
from touchline.llm.queries import op9_lm_scoring

from .conftest import ODD, frame


def toks(text):
    return [h for h in map(token_hash, re.split(r"[ \t\n\r\x0b\x0c]+", text or "")) if h]


def expected(rows):
    """(tokens, target loss, background loss) of (text, target) rows."""
    texts = [(toks(t), good) for t, good in rows]
    seen = Counter(w for t, _ in texts for w in t)
    vocab = {w for w, n in seen.items() if n >= 2}
    size = len(vocab) + 2
    models = []
    mapped = [(["^"] + [w if w in vocab else "?" for w in t], good) for t, good in texts]
    counts = [Counter(), Counter()]
    for t, good in mapped:
        for pair in zip(t, t[1:]):
            counts[1][pair] += 1
            counts[0][pair] += good
    keep = {p for p in counts[1] if any(c[p] >= 2 for c in counts)}
    for c in counts:
        first, second = Counter(), Counter()
        for (a, b), n in c.items():
            first[a] += n
            second[b] += n
        n = sum(second.values())
        direct = {p: max(c[p] - xent.DISCOUNT, 0) / max(1, first[p[0]]) for p in keep}
        left = Counter()
        for (a, _), d in direct.items():
            left[a] += d
        one = lambda b, second=second, n=n: (second[b] + 1) / (n + size)
        back = lambda a, left=left: max(1e-9, 1 - left[a])
        models.append((direct, back, one))
    out = []
    for t, _ in mapped:
        losses = []
        for direct, back, one in models:
            own = [-math.log(direct.get((a, b), 0) + back(a) * one(b)) for a, b in zip(t, t[1:])]
            losses.append(sum(own) / len(own) if own else 0.0)
        out.append((len(t) - 1, *losses))
    return out


def agree(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[0] == w[0] and g[1:] == pytest.approx(w[1:], abs=2e-4)


def test_odd_rows(odd, none):
    model = xent.train(odd.selectExpr("*", "lang = 'en' as good"), "text", "good")
    rows = xent.score(odd, model).collect()
    want = expected([(r[1], r[2] == "en") for r in ODD])
    key = lambda x: tuple(round(v, 2) for v in x)
    agree(sorted(((r["n_tokens"], r["target_loss"], r["background_loss"]) for r in rows), key=key), sorted(want, key=key))
    assert all(r["score"] == pytest.approx(r["target_loss"] - r["background_loss"]) for r in rows)
    empty = xent.train(none.selectExpr("*", "true as good"), "text", "good")
    assert xent.score(none, model).count() == 0 and xent.score(odd, empty).count() == len(ODD)


def shown(model):
    """Losses of the bigrams and of the words in a model's table, by key."""
    pairs, words = {}, dict(model.fixed)
    for r in model.table.collect():
        for name, width, into in (("pair", xent.PAIR_VALUES, pairs), ("word", xent.WORD_VALUES, words)):
            values = np.frombuffer(r[f"{name}_values"], np.float32).reshape(-1, width)
            into |= dict(zip(np.frombuffer(r[f"{name}s"], np.int64).tolist(), values.tolist(), strict=True))
    return pairs, words


def key(*hashes):
    signed = np.array(hashes, np.uint64).view(np.int64)
    return int(xent.pair_key(signed[:1], signed[1:])[0]) if len(signed) > 1 else int(signed[0])


def test_chances_add_up_to_one(spark):
    """Over all words after any word, both models spend at most one, and all of it if every word was seen."""
    docs = frame(spark, [(i, "a b a c a b b c d d a b " * 3, "en", "s") for i in range(4)]).selectExpr("*", "doc_id = 1 as good")
    pairs, words = shown(xent.train(docs, "text", "good"))
    hashes = [token_hash(w) for w in "abcd"]
    assert set(words) == {xent.UNKNOWN, xent.START, *map(key, hashes)}
    for k in range(2):
        for a in hashes:
            back = words[key(a)][k]
            own = [pairs.get(key(a, b), [back + words[key(b)][2 + k]] * 2)[k] for b in hashes]
            own += [back + words[x][2 + k] for x in (xent.UNKNOWN, xent.START)]
            assert sum(math.exp(-x) for x in own) == pytest.approx(1.0, abs=1e-3)


def test_target_like_texts_score_lower(spark):
    rows = [(i, "good prose about rivers and hills " * 4, "en", "s") for i in range(30)]
    rows += [(100 + i, "buy cheap pills now click here " * 4, "en", "s") for i in range(30)]
    docs = frame(spark, rows)
    model = xent.train(docs.selectExpr("*", "doc_id < 20 as good"), "text", "good")
    own = {r["doc_id"]: r["score"] for r in xent.score(docs, model).collect()}
    assert max(own[i] for i in range(30)) < min(own[100 + i] for i in range(30))


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    good = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    rows = op9_lm_scoring(spark, small).orderBy("doc_id").collect()
    agree([(r["n_tokens"], r["target_loss"], r["background_loss"]) for r in rows], expected([(r["text"], r["doc_id"] in good) for r in docs]))


def test_entries_grow_with_the_corpus(spark):
    """A word and a bigram seen twice have entries, however many tokens there are."""
    common = " ".join(f"c{i}" for i in range(50)) + " "
    rows = [(i, common * 150, "en", "s") for i in range(40)] + [(100 + i, "rare pair", "en", "s") for i in range(2)]
    pairs, words = shown(xent.train(frame(spark, rows).selectExpr("*", "doc_id < 5 as good"), "text", "good"))
    rare, pair = token_hash("rare"), token_hash("pair")
    assert {key(rare), key(pair)} <= set(words) and key(rare, pair) in pairs


def test_small_sections_and_folds(spark, small, monkeypatch):
    """Many sections, tasks that let go often, many slices and copies give what one of each gives."""
    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("doc_id", "text", "doc_id % 3 = 0 as good")
    want = {r["doc_id"]: r for r in xent.score(docs, xent.train(docs, "text", "good")).collect()}
    for name, value in (("SECTION_TOKENS", 5000), ("TASK_ENTRIES", 3000), ("ASK_KEYS", 2000), ("SCORE_BYTES", 20_000), ("COUNT_SLICE", 30_000)):
        monkeypatch.setattr(xent, name, value)
    model = xent.train(docs, "text", "good")
    assert model.sections > 3
    # Twice the documents of the corpus, so that sections are copied.
    got = xent.score(docs.unionByName(docs), model).collect()
    assert len(got) == 2 * len(want)
    for r in got:
        assert (r["n_tokens"], r["target_loss"], r["background_loss"]) == pytest.approx((want[r["doc_id"]]["n_tokens"], want[r["doc_id"]]["target_loss"], want[r["doc_id"]]["background_loss"]), abs=1e-5)


def test_words_seen_once_and_their_neighbours(spark):
    """Bigrams of the unknown word: rare after rare, after the start, at the end, and beside known words."""
    rows = [(i, t, "en", "s") for i, t in enumerate(["q1 q2 a", "q3 a b q4", "a q5 b", "q6", "b a q7 q8", "a q9 b a q10"])]
    docs = frame(spark, rows).selectExpr("*", "doc_id % 2 = 0 as good")
    got = xent.score(docs, xent.train(docs, "text", "good")).orderBy("doc_id").collect()
    agree([(r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got], expected([(t, i % 2 == 0) for i, t, *_ in rows]))


def test_equal_rows_are_dealt_to_slices(spark, monkeypatch):
    monkeypatch.setattr(xent, "SCORE_BYTES", 4000)
    rows = [(None, "one text that many rows hold", "en", "s")] * 3000 + [(1, "another text", "en", "s")]
    docs = frame(spark, rows).selectExpr("*", "doc_id = 1 as good")
    got = xent.score(docs, xent.train(docs, "text", "good")).groupBy("doc_id", "n_tokens").count().collect()
    assert sorted((r["n_tokens"], r["count"]) for r in got) == [(2, 1), (6, 3000)]


def test_tokens_of_columns_are_those_of_words():
    texts = ["_a_ \x01b\x02 ÀB c- (d) ' '' E.F \x1c\x1c x\x00 İ ﬁ A1_ a__b __ é. .É", "", None, *[r[1] for r in ODD]]
    hashes, row = xent.tokens(pa.array(texts, pa.string()))
    assert hashes.tolist() == [h for t in texts for h in toks(t)]
    assert row.tolist() == [i for i, t in enumerate(texts) for _ in toks(t)]


def test_word_hashes_are_those_of_one_word():
    made = [bytes((i * 7 + j * 31) % 256 for j in range(n)) for n in range(70) for i in range(5)]
    column = pa.array(made, pa.binary())
    assert xent.word_hashes(column).tolist() == [xxhash.xxh64_intdigest(w) for w in made]
    assert xent.word_hashes(column.slice(40, 99)).tolist() == [xxhash.xxh64_intdigest(w) for w in made[40:139]]
    letters = [f"{x}{chr(c)}b{y}" for c in range(0x21, 0x500) for x, y in (("", ""), (chr(c), chr(c)), ("_É", "!"))]
    text = " ".join(letters)
    assert xent.tokens(pa.array([text]))[0].tolist() == toks(text)


class Handed:
    """In place of a table: takes down the functions that its tasks would run."""

    def __getattr__(self, name):
        return lambda *made: setattr(self, f"{name}_of", made[0]) or self


def test_tasks_that_count_bigrams_hold_little():
    """What a task holds at once, in bytes of arrays a bigram, and that its sections add up to all bigrams."""
    words = [f"w{i * i % 49_999}" for i in range(600_000)]
    texts = [" ".join(words[i : i + 3000]) for i in range(0, len(words), 3000)]
    table = Handed()
    xent.pair_counts(table, 50)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 == 0 for i in range(len(texts))])], ["text", "target"])
    tracemalloc.start()
    handed = list(table.mapInArrow_of(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 66 * len(words)
    sections = {}
    for r in (r for b in handed for r in b.to_pylist()):
        sections.setdefault(r["section"], []).append(r)
    schema = pa.schema([("section", pa.int32()), *((c, pa.binary()) for c in ("firsts", "runs", "seconds", "counts"))])
    got = [r for s in sections.values() for r in table.applyInArrow_of(pa.Table.from_pylist(s, schema)).to_pylist()]
    want = [Counter(), Counter()]
    for i, t in enumerate(texts):
        for pair in zip([xent.START, *toks(t)], toks(t)):
            want[0][pair] += 1
            want[1][pair] += i % 3 == 0
    signed = lambda x: int(np.array([x], np.uint64).view(np.int64)[0])
    assert {(r["a"], r["b"]): (r["all"], r["target"]) for r in got} == {(signed(a), signed(b)): (n, want[1][a, b]) for (a, b), n in want[0].items() if n >= 2}
