"""Prefix trie of conversations by truncation peeling.

A turn's prefix is known by its depth and two polynomial hashes of the turns up to it, which are running
sums and so need no task that holds a conversation. Peeling descends from the greatest depth: nodes that
survive from below and conversations that end here are regrouped by prefix, told, and lose their last turn.
A task peels the conversations it has, cut into segments of ``BLOCK`` depths; what it tells of a node is a
part, and parts of one node add up.

Two descents are needed. The first finds the nodes, their members and, as their owner, the smallest member.
An owner of a node owns all its nodes below, so each node is counted once where its owner's conversation is
peeled: the second descent sees owners only and adds up what must count distinct nodes.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.running import running
from touchline.session import materialise

from .mixing import words
from .tables import col

PRIME = (1 << 61) - 1
# Any two numbers below the prime do; these come from a seeded generator.
BASES = tuple(int(x) for x in np.random.default_rng(13).integers(1 << 59, PRIME, 2))
#: A segment holds at most so many turns of a conversation.
BLOCK = 512
#: Conversations of a group of so many borrow their first turns from the first of them; at most so many turns.
GROUP, MOST_BORROWED = 20, 3
NODE = ["depth", "n1", "n2"]


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, digest, words) of each turn, ``place`` from 1 by turn (null first); rows without an id are left out.

    Null role or text is empty. Turns at one number are ordered by the digest of role and text.
    """
    who, what = F.coalesce(col(role), F.lit("")), F.coalesce(col(text), F.lit(""))
    turns = conversations.where(col(conv_id).isNotNull()).select(
        col(conv_id).cast("long").alias("conv"),
        col(turn).alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what)).alias("digest"),
        words(what).alias("words"),
    )
    placed = running(materialise(turns), ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest")], {"place": F.lit(1).cast("long")})
    return materialise(placed.select("conv", "place", "digest", "words"))


def lengths(turns: DataFrame) -> DataFrame:
    return materialise(turns.groupBy("conv").agg(F.max("place").alias("length")))


def borrowed_heads(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their group of ``GROUP`` ids: turns and lengths.

    Conversation c drops its first crc32(c) % 4 turns and begins with so many of the group's first one,
    fewer if that has fewer or is not there. It may be left without turns.
    """
    wanted = (F.crc32(F.col("conv").cast("string")) % (MOST_BORROWED + 1)).alias("wanted")
    base = convs.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    plan = convs.select("conv", "length", wanted, (F.col("conv") - F.col("conv") % GROUP).alias("of"))
    plan = plan.join(base, F.col("of") == F.col("base"), "left")
    taken = F.least("wanted", F.coalesce("base_length", F.lit(0)))
    plan = materialise(plan.select("conv", "of", "wanted", taken.alias("taken"), (taken + F.greatest(F.col("length") - F.col("wanted"), F.lit(0))).alias("length")))
    own = turns.join(plan.select("conv", "wanted", "taken"), "conv").where(F.col("place") > F.col("wanted"))
    own = own.select("conv", (F.col("place") - F.col("wanted") + F.col("taken")).alias("place"), "digest", "words")
    heads = turns.where(F.col("place") <= MOST_BORROWED).withColumnRenamed("conv", "of")
    head = plan.where("taken > 0").select("conv", "of", "taken").join(heads, "of").where(F.col("place") <= F.col("taken"))
    return materialise(own.unionByName(head.select("conv", "place", "digest", "words"))), plan.select("conv", "length")


def _terms(batches):
    """The summands of both hashes: the turn's number times the base to its depth."""
    power = functools.lru_cache(1 << 16)(pow)
    for batch in batches:
        at, digests = batch["depth"].to_pylist(), batch["digest"].to_pylist()
        sums = []
        for base, cut in zip(BASES, (slice(0, 16), slice(16, 32)), strict=True):
            own = (int(x[cut], 16) % PRIME * power(base, d, PRIME) % PRIME for x, d in zip(digests, at, strict=True))
            sums.append(pa.array(own, pa.int64()))
        arrays = [batch["conv"], batch["depth"], batch["words"], *sums]
        yield pa.RecordBatch.from_arrays(arrays, ["conv", "depth", "words", "t1", "t2"])


def segments(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, block, chain, length, below): the node and parent of each turn of a segment, and the words below it."""
    terms = turns.withColumnRenamed("place", "depth").mapInArrow(_terms, "conv long, depth long, words long, t1 long, t2 long")
    exact = {f"s{i}": F.col(f"t{i}").cast("decimal(20,0)") for i in (1, 2)}
    summed = running(materialise(terms), ["conv"], [F.col("depth")], exact)

    def key(name: str, value: Column) -> Column:
        return (value % F.lit(PRIME)).cast("long").alias(name)

    node = [key(f"n{i}", F.col(f"s{i}")) for i in (1, 2)]
    parent = [key(f"p{i}", F.col(f"s{i}") - F.col(f"t{i}")) for i in (1, 2)]
    part = F.floor((F.col("depth") - 1) / block).alias("block")
    cut = summed.select("conv", part, F.struct("depth", *node, *parent, "words").alias("turn"))
    cut = cut.groupBy("conv", "block").agg(F.array_sort(F.collect_list("turn")).alias("chain"), F.sum("turn.words").alias("own"))
    deeper = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("below", F.coalesce(F.sum("own").over(deeper), F.lit(0)))
    whole = convs.join(cut, "conv", "left").select(
        "conv",
        F.coalesce("block", F.lit(0)).alias("block"),
        F.coalesce("chain", F.array().cast(cut.schema["chain"].dataType)).alias("chain"),
        "length",
        F.coalesce("below", F.lit(0)).alias("below"),
    )
    return materialise(whole)


class Peel:
    """One descent over some segments of one block; ``told`` gathers parts of nodes."""

    def __init__(self, chain: dict[str, np.ndarray], starts: np.ndarray, floor: int):
        self.chain, self.starts, self.floor = chain, starts[:-1], floor
        self.deepest = floor + np.diff(starts)

    def at(self, who: np.ndarray, depth: int, name: str) -> np.ndarray:
        """A field of the turn at ``depth``; the root has no turn, and zeros."""
        return self.chain[name][self.starts[who] + depth - self.floor - 1] if depth else np.zeros(len(who), dtype=np.int64)

    def run(self, state: dict[str, np.ndarray], merge: dict[str, np.ufunc], step, told: list) -> None:
        """Descend; ``step(depth, words, state)`` returns the columns to tell, and changes ``state`` to what its parent takes over."""
        order = np.argsort(-self.deepest, kind="stable")
        ends = -self.deepest[order]
        lowest = self.floor + 1 if self.floor else 0
        who, now, done = np.zeros(0, dtype=np.int64), {k: v[:0] for k, v in state.items()}, 0
        for depth in range(int(self.deepest.max(initial=-1)), lowest - 1, -1):
            # Conversations that end here join the nodes that survive from below ...
            upto = int(np.searchsorted(ends, -depth, "right"))
            new, done = order[done:upto], upto
            who = np.concatenate((who, new))
            now = {k: np.concatenate((v, state[k][new])) for k, v in now.items()}
            # ... and are regrouped by their prefix; any member stands for its group.
            one, two = self.at(who, depth, "n1"), self.at(who, depth, "n2")
            by = np.lexsort((two, one))
            one, two = one[by], two[by]
            first = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
            who, one, two = who[by][first], one[first], two[first]
            now = {k: merge[k].reduceat(v[by], first) for k, v in now.items()}
            out = step(depth, self.at(who, depth, "words"), now)
            same = {"depth": np.full(len(who), depth), "n1": one, "n2": two}
            told.append(same | {k: v if isinstance(v, np.ndarray) else self.at(who, depth, v) for k, v in out.items()})


def _found(depth: int, words: np.ndarray, now: dict[str, np.ndarray]) -> dict:
    """First descent: members, how many end here, and the words of members from here down."""
    now["under"] = now["under"] + now["n"] * words
    out = {"p1": "p1", "p2": "p2", "words": words, "n": now["n"], "least": now["least"], "ended": now["ended"], "under": now["under"]}
    now["ended"] = np.zeros_like(now["ended"])
    return out


def _owned(depth: int, words: np.ndarray, now: dict[str, np.ndarray]) -> dict:
    """Second descent: distinct children, childless nodes and words of distinct nodes from here down.

    ``attach`` is the least depth above which a member owns its nodes; only the owner's is below ``depth``.
    """
    mine = now["attach"] < depth
    now["distinct"] = now["distinct"] + np.where(mine, words, 0)
    top = (now["attach"] == depth - 1).astype(np.int64)
    out = {"kids": now["kids"], "leaves": now["leaves"], "distinct": now["distinct"], "top": top}
    now["kids"] = mine.astype(np.int64)
    return out


FOUND = "depth long, n1 long, n2 long, p1 long, p2 long, words long, n long, least long, ended long, under long"
OWNED = "depth long, n1 long, n2 long, kids long, leaves long, distinct long, top long"


def _descent(block: int, first: bool):
    """The function of ``mapInArrow`` for one of the descents."""

    def run(batches):
        for batch in batches:
            blocks, convs, length = (batch[c].to_numpy() for c in ("block", "conv", "length"))
            below = batch["below"].to_numpy()
            offsets = batch["chain"].offsets.to_numpy().astype(np.int64)
            turns = batch["chain"].flatten()
            fields = dict(zip((f.name for f in turns.type), (x.to_numpy() for x in turns.flatten()), strict=True))
            told: list[dict] = []
            for b in np.unique(blocks):
                own = np.flatnonzero(blocks == b)
                size = np.diff(offsets)[own]
                starts = np.concatenate(([0], np.cumsum(size)))
                index = np.repeat((offsets[:-1] - offsets[0])[own] - starts[:-1], size) + np.arange(starts[-1])
                peel = Peel({k: v[index] for k, v in fields.items()}, starts, int(b) * block)
                last = peel.deepest
                if first:
                    state = {"n": np.ones(len(own), dtype=np.int64), "least": convs[own], "ended": (last == length[own]).astype(np.int64), "under": below[own]}
                    peel.run(state, {"n": np.add, "least": np.minimum, "ended": np.add, "under": np.add}, _found, told)
                else:
                    attach = batch["attach"].to_numpy()[own]
                    above = attach <= last
                    state = {
                        "attach": attach,
                        "kids": ((length[own] > last) & above).astype(np.int64),
                        "leaves": batch["leaf"].to_numpy()[own],
                        "distinct": np.where(above, below[own], batch["own_words"].to_numpy()[own]),
                    }
                    peel.run(state, {"attach": np.minimum, "kids": np.add, "leaves": np.add, "distinct": np.add}, _owned, told)
            if told:
                yield pa.RecordBatch.from_pydict({k: np.concatenate([t[k] for t in told]) for k in told[0]})

    return run


def _digests(batches):
    """SHA-256 of the comma-joined texts of each node, which come in order, piece by piece."""
    now, sha, out = None, None, []
    for batch in batches:
        for *node, part in zip(*(batch[c].to_pylist() for c in (*NODE, "ids")), strict=True):
            if node != now:
                if now:
                    out.append((*now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(part.encode())
            else:
                sha.update(b"," + part.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [*NODE, "ends_sha256"])
            out = []
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, sha.hexdigest())], [*NODE, "ends_sha256"])


def ends(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes at which conversations end: a digest of their ids, ascending, comma-joined.

    The ids of a node are joined in ranges of ids, by many tasks; only these texts pass through one task,
    which streams them, as a digest must.
    """
    last = F.element_at("chain", -1)
    at_root = F.size("chain") == 0
    node = [F.when(at_root, F.lit(0)).otherwise(last[k]).cast("long").alias(k) for k in ("n1", "n2")]
    done = parts.where(at_root | (last["depth"] == F.col("length"))).select("conv", F.col("length").alias("depth"), *node)
    ranged = done.repartitionByRange("conv").withColumn("range_at", F.spark_partition_id())
    ids = F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",")
    joined = ranged.groupBy(*NODE, "range_at").agg(ids.alias("ids"))
    in_order = joined.repartition(*NODE).sortWithinPartitions(*NODE, "range_at")
    return in_order.mapInArrow(_digests, "depth long, n1 long, n2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: distinct sequence of the first turns of conversations, from the root without turns.

    ``turns`` and ``convs`` come from ``numbered`` and ``lengths``; a conversation may have no turns. Columns, all
    long: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves
    (childless nodes in the subtree), saved_tokens (words that sharing saves in the subtree) and, as text,
    ends_sha256 (digest of the ids of members that end here; of nothing, where none does). Without conversations
    there is no root. Equal conversations are members of the same nodes.
    """
    parts = segments(turns, convs, block)
    found = parts.mapInArrow(_descent(block, True), FOUND)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "words", "least")]
    nodes = materialise(found.groupBy(*NODE).agg(*same, *(F.sum(c).alias(c) for c in ("n", "ended", "under"))))

    owners = nodes.groupBy(F.col("least").alias("conv")).agg(
        (F.min("depth") - 1).alias("attach"), F.sum("words").alias("own_words"), F.max((F.col("n") == F.col("ended")).cast("long")).alias("leaf")
    )
    second = parts.join(owners, "conv").mapInArrow(_descent(block, False), OWNED)
    sums = second.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in ("kids", "leaves", "distinct")), F.max("top").alias("top"))
    told = materialise(nodes.join(sums, NODE).join(ends(parts), NODE, "left"))

    # A node's parent has the same owner, unless the owner's nodes begin here.
    begins = (F.col("top") == 1) & (F.col("depth") > 0)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("least").alias("parent"))
    inner = told.where(~begins).withColumn("parent", F.when(F.col("depth") > 0, F.col("least")))
    both = inner.unionByName(told.where(begins).join(above, ["depth", "p1", "p2"]))
    return both.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("under") - F.col("distinct")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
