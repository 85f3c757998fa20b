"""Divergence audit against plain counting, and the pointer sort against sorted()."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from touchline.llm import divergence

from .conftest import ODD, frame

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(rows, least_docs, top):
    """The audit by definition, of (lang, source, text) rows."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, own = lang or "", source or "", terms(text)
        groups[lang].add(source)
        counts[lang, source].update(own)
        docs[lang].update(set(own))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(count, kept=kept):
            all_n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (all_n + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            apart = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, upto in (("pair", pairs, len(pairs)), ("term", apart, top)):
                out += [(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(sorted(found)[:upto], 1)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_pointer_sort(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(400)] + ["long" * 5000] * 2
    groups = np.array([rng.randrange(3) for _ in words])
    text = np.frombuffer("".join(w + " " for w in words).encode() + bytes(8), dtype=np.uint8)
    size = np.array([len(w) for w in words])
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    order, begins = divergence.sort_pointers(text, start, size, groups)
    wanted = sorted(range(len(words)), key=lambda i: (groups[i], words[i], i))
    assert order.tolist() == wanted
    same = [(groups[i], words[i]) for i in wanted]
    assert begins.tolist() == [i == 0 or same[i] != same[i - 1] for i in range(len(same))]


def test_odd_rows(spark, odd, none):
    rows = [(lang, s, t) for _, t, lang, s in ODD]
    for least, top in ((1, 3), (2, 10), (99, 10)):
        assert found(divergence.audit(odd, least_docs=least, top=top)) == plain(rows, least, top)
    assert divergence.audit(none).count() == 0


@pytest.mark.parametrize(("block", "section", "step"), [(3, 40, 4), (2, 10**6, 4096), (128, 25, 1)])
def test_blocks_and_sections(spark, block, section, step):
    rng = random.Random(block)
    rows = []
    for i in range(300):
        source = rng.choice(["hot"] * 4 + [f"s{j}" for j in range(9)] + [None, ""])
        rows.append((rng.choice(["xx", "xx", "yy", None]), source, " ".join(f"{rng.choice('abÉé')}{'z' * rng.randrange(12)}" for _ in range(rng.randrange(30)))))
    rows += [("lone", "s", "word")] * 12 + [("bare", "s", None), ("bare", "t", "12 34")]
    docs = frame(spark, [(i, t, lang, s) for i, (lang, s, t) in enumerate(rows)]).repartition(5)
    assert found(divergence.audit(docs, block_size=block, section_rows=section, step=step)) == plain(rows, 10, 10)
    kept = divergence.kept_counts(docs.select("lang", "source", "text").na.fill(""))
    assert kept.count() == kept.select("lang", "term", "source").distinct().count()


def test_slices_are_folded():
    import pyarrow as pa

    text = ["One two two", "TWO three", "één É é", None, ""]
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "a", "b", "b", ""], "source": ["s", "s", "t", "", ""], "text": text})
    whole = divergence.counted(batch).to_pylist()
    parts = divergence._folded([divergence.counted(batch.slice(i, 1)) for i in range(5)]).to_pylist()
    assert sorted(map(str, whole)) == sorted(map(str, parts)) and {r["term"]: (r["n"], r["docs"]) for r in whole if r["lang"] == "a"}["two"] == (3, 2)
