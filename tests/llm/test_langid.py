"""Language identification: held-out accuracy, filters and odd rows."""

import numpy as np
import pyarrow as pa
import pytest

from touchline.llm import langid
from touchline.llm.queries import op6_language_id

from .conftest import ODD, frame


def windows(word):
    own = f" {word} ".encode()
    return [(n, own[i : i + n]) for n in langid.SIZES for i in range(len(own) - n + 1)]


def test_grams_are_the_windows_of_each_word():
    vocab = pa.array(["the", "", "a", "été"])
    gram, owner = langid.grams(vocab)
    want = sorted((i, int.from_bytes(bytes([n]) + w, "big")) for i, v in enumerate(vocab.to_pylist()) if v for n, w in windows(v))
    assert sorted(zip(owner.tolist(), gram.tolist())) == want
    assert not len(langid.grams(pa.array([], pa.string()))[0])


def test_filters_hold_every_gram_and_the_chance_hits_are_as_corrected():
    rng = np.random.default_rng(2)
    held = rng.integers(0, 2**40, 200_000)
    masks = np.zeros(langid.SLOTS, np.uint64)
    np.bitwise_or.at(masks, langid.slots(held), np.uint64(1))
    model = langid.Model(("x",), masks)
    assert (np.bitwise_and.reduce(masks[langid.slots(held)], axis=1) == 1).all()
    other = rng.integers(2**41, 2**42, 200_000)
    chance = np.bitwise_and.reduce(masks[langid.slots(other)], axis=1).mean()
    assert chance == pytest.approx(model.fill()[0], rel=0.1)


def test_odd_rows(odd):
    model = langid.train(odd)
    assert model.languages == ("de", "en", "fr")
    told = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert langid.identify(odd, model).count() == len(ODD)
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 for i in (3, 4, 5, 9))
    assert told[1]["lang_pred"] == told[6]["lang_pred"] == "en"
    kept = langid.keep_identified(odd, model)
    assert kept.schema == odd.schema
    assert {3, 4, 5, 9} & {r["doc_id"] for r in kept.collect()} == set() and kept.where("doc_id = 8").count() == 2


def test_nothing_to_learn_from(spark, odd, none):
    model = langid.train(none)
    assert {r["lang_pred"] for r in langid.identify(odd, model).collect()} == {"und"}
    assert langid.keep_identified(odd, model).count() == 0
    assert langid.identify(none, langid.train(odd)).count() == 0
    many = frame(spark, [(i, f"text {i}", f"l{i:03d}", "s") for i in range(70)])
    with pytest.raises(ValueError, match="languages"):
        langid.train(many)


def test_text_of_unknown_words_is_rejected(spark):
    model = langid.train(frame(spark, [(i, "the cat sat on the mat " * 3, "en", "s") for i in range(5)]))
    rows = frame(spark, [(1, "the cat sat", "en", "s"), (2, "zzyzx qqwxq vvkkj", "en", "s")])
    assert [r["doc_id"] for r in langid.keep_identified(rows, model).collect()] == [1]


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_language_id(spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 200 and np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in out]) > 0.98


def test_texts_are_read_in_small_pieces(monkeypatch):
    """No more than ``TEXT_SLICE`` bytes are split into words at a time, and counts do not hang on it."""
    class Docs:
        def mapInArrow(self, run, schema):
            return run

    batch = pa.RecordBatch.from_pydict({"text": ["the cat sat on the mat " * 20_000, "le chat " * 60_000] * 4, "lang": ["en", "fr"] * 4})
    seen, split = [], langid.words
    monkeypatch.setattr(langid, "words", lambda texts: seen.append(texts.nbytes) or split(texts))

    def told():
        out = pa.Table.from_batches(list(langid.count_grams(Docs())(iter([batch])))).group_by(["lang", "gram"]).aggregate([("n", "sum")])
        return {(r["lang"], r["gram"]): r["n_sum"] for r in out.to_pylist()}

    small = told()
    assert len(seen) > 2
    monkeypatch.setattr(langid, "TEXT_SLICE", 1 << 30)
    assert told() == small
