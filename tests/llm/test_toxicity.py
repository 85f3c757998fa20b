"""Toxicity: the composed automaton against its parts, odd rows, and held-out documents."""

import random

import numpy as np
import pyarrow as pa

from touchline.llm import toxicity as tox
from touchline.llm.queries import op3_toxicity

from .conftest import ODD, frame

INSULTS = {"idiot": 1.0, "lowei*": 2.0}


def test_composition_reads_as_the_parts_do():
    rng = random.Random(0)
    for _ in range(300):
        read = [rng.randrange(6) for _ in range(rng.randint(0, 15))]
        states, want = [t.start for t in tox.GRAMMAR], []
        state, got = 0, []
        for r in read:
            steps = [t.step(s, r) for t, s in zip(tox.GRAMMAR, states)]
            states = [s for s, _ in steps]
            want.append(np.prod([w for _, w in steps]))
            got.append(tox.WORTH[state, r])
            state = tox.MOVES[state, r]
        assert np.allclose(got, want)


def total(text):
    return float(tox.clause_features(pa.array([text]), INSULTS)[0, 0])


def test_clauses():
    plain, aimed = total("what an idiot"), total("you are an idiot")
    assert 0 < plain < aimed and total("idiot") == plain == 1.0
    assert total("you are not an idiot") < plain
    assert total("he said you are an idiot") < aimed
    assert total("he said nothing. you are an idiot") == aimed and total("you went.\nidiot") == plain
    assert 0 < total("they kill time") and total("we kill time") < total("you kill")
    assert total("loweischaft") == 2.0 and total("Lowei") == total("lowe") == 0.0 and total("IDIOT!") == 1.0
    assert total("") == total("nothing here") == 0.0
    assert tox.clause_features(pa.array(["idiot. idiot", None, "a idiot loweixy"]), INSULTS)[:, 2:].tolist() == [[2, 2], [0, 0], [1, 2]]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_odd_rows(spark, odd, none):
    given = labels(spark, [(i, 1, i % 2, "x") for i in range(12)] + [(None, 1, 1, "x"), (1, 1, None, "x"), (8, 1, 1, "x")])
    model = tox.train(odd, given)
    rows = tox.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    flat = tox.train(odd, given.where("toxic = 0"))
    assert not flat.insults and {round(r["score"], 6) for r in tox.score(odd, flat).collect()} == {round(1 / (len(flat_rows(odd, given)) + 2), 6)}
    assert tox.score(none, model).count() == 0 and tox.train(none, given).insults == {}


def flat_rows(odd, given):
    ids = {r["doc_id"] for r in given.where("toxic = 0").collect()}
    return [r for r in odd.collect() if r["doc_id"] in ids]


def test_learned_words_and_stems_count_in_other_texts(spark):
    rng = random.Random(3)
    prose = lambda n: [rng.choice("river hill stone cloud meadow path") for _ in range(n)]
    rows, own = [], []
    for i in range(400):
        text = prose(40)
        if i % 5 == 0:
            text[rng.randrange(40)] = rng.choice(["scum", f"badst{rng.randrange(10**6)}"])
            text[rng.randrange(40)] = rng.choice(["scum", f"badst{rng.randrange(10**6)}"])
        rows.append((i, " ".join(text), "en", "s"))
        own.append((i, 1, int(i % 5 == 0), "x"))
    docs = frame(spark, rows)
    model = tox.train(docs, labels(spark, own).where("doc_id < 200"))
    told = {r["doc_id"]: r["score"] for r in tox.score(docs, model).collect()}
    assert np.mean([(told[i] >= 0.3) == (i % 5 == 0) for i in range(200, 400)]) > 0.95


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in op3_toxicity(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in toxic]
    hit = sum(r["predicted"] and toxic[r["doc_id"]] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.9 and hit / sum(toxic[r["doc_id"]] for r in rows) > 0.85


def test_all_matched_clauses_are_counted(spark):
    docs = frame(spark, [(1, "you are a fool. " * 40, "en", "s")])
    model = tox.Model({"fool": 1.0}, np.zeros(5))
    assert [r["clauses"] for r in tox.score(docs, model).collect()] == [40]
