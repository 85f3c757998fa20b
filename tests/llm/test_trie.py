"""Prefix trie against a plain trie of tuples."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from touchline.llm import trie
from touchline.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv string, digest string, `a.b` int, depth int, least long"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], SCHEMA)


def own_turns(rows):
    """Turns of each conversation in order, as (role, text)."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(t)] for c, t in out.items()}


def rebuilt(convs):
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
    return {c: convs.get(c - c % 20, [])[: heads[c]] + t[heads[c] :] for c, t in convs.items()}


def plain(convs):
    """The trie's rows, by definition."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [totals[k] for k in children[node]]
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, held in members.items():
        end = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), len(children[node]), *totals[node], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def case(n, vocabulary, most, seed):
    """Conversations that share prefixes; copies, a long one, ties in turn, nulls."""
    import random

    rng, rows = random.Random(seed), []
    for c in range(n):
        size = rng.randint(1, most)
        for t in range(size):
            rows.append((c * 3 - 7, t, rng.choice(["user", None, "assistant"]), f"word{rng.randrange(vocabulary)} and  more" if rng.random() < 0.9 else None))
    rows += [(1000 + i, t, "user", f"long {t}") for i in range(2) for t in range(40 + i)]
    rows += [(2000 + i, 0, "user", "the same") for i in range(30)]
    rows += [(3000, None, "b", "x"), (3000, 1, "a", "y"), (3000, 1, "a", "x"), (3000, 1, "a", "x"), (None, 0, "user", "nobody"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("block", [1, 3, 7, trie.BLOCK])
def test_trie_equals_plain_one(spark, block):
    rows = case(60, 2, 6, block)
    turns = trie.numbered(frame(spark, rows).repartition(5))
    assert rows_of(trie.trie(turns, trie.lengths(turns), block)) == plain(own_turns(rows))


def test_borrowed_heads(spark):
    rows = case(80, 3, 5, 5)
    turns = trie.numbered(frame(spark, rows).repartition(3))
    convs = rebuilt(own_turns(rows))
    assert min(map(len, convs.values())) == 0  # some are left without turns
    assert rows_of(trie.trie(*trie.borrowed_heads(turns, trie.lengths(turns)), 4)) == plain(convs)


def test_empty_table_and_long_texts(spark):
    none = trie.numbered(frame(spark, []))
    assert trie.trie(none, trie.lengths(none)).count() == 0
    rows = [(1, 0, "user", "word " * 200_000), (2, 0, "user", "word " * 200_000 + "x"), (3, 0, "user", "word " * 200_000)]
    turns = trie.numbered(frame(spark, rows))
    assert rows_of(trie.trie(turns, trie.lengths(turns))) == plain(own_turns(rows))


def test_query(spark, small):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    assert rows_of(op13_prefix_trie(spark, small)) == plain(rebuilt(own_turns(rows)))
