"""Cross-entropy difference of two n-gram models with one vocabulary.

Words seen at least ``LEAST_COUNT`` times are the vocabulary; all others are one symbol. Bigrams of the
target rows and of the background (all rows) are counted over it, and both models are discounted
bigrams that fall back on their unigrams; bigrams seen as often have an entry of their own. A
document's score is the mean over its tokens of the target's loss less the background's: below 0 it
is more like the target.

The least count is fixed, so vocabulary and entries grow with the corpus, and both stay tables. A bigram
seen twice has two words seen twice, so bigrams are counted as they stand: tasks hand over packed arrays
by section of the bigram's hash, and only what is seen twice becomes a row. Words seen once stand in
one place, so a pass over words that keeps their neighbours gives the bigrams of the unknown word.

To score, documents are dealt into slices of bounded size by a hash; each slice asks once for each of
its words and bigrams (packed by section of the model, which is packed alike), and the answers meet the
slice's texts. Slices are taken in ``ROUNDS`` parts, each written before the next, which bounds the disk
that questions and answers take to a share of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import drop_tables, materialise

from .batches import sectioned, slices, sums, words
from .decontam import token_hash
from .tables import col

#: Holds at every size; that a word below it stands in one place is used.
LEAST_COUNT = 2
DISCOUNT = 0.5
#: Text that is split at once, and words or bigrams that a task holds: what a worker of Python takes beside its libraries.
COUNT_SLICE, TASK_ENTRIES = 2 << 20, 1_500_000
#: Bigrams that a task hands over at once.
HAND_OVER = 300_000
#: Tokens of the corpus for each section of bigrams, and keys that a task asks at once.
SECTION_TOKENS, ASK_KEYS = 2_000_000, 3_000_000
#: Text of a slice of documents that is scored together, and the parts of the slices.
SCORE_BYTES, ROUNDS = 8 << 20, 3
#: Keys of the unknown word and the start of a text. Those of words are odd, those of bigrams even.
UNKNOWN, START = 2, 4
#: Losses of a bigram and of a word.
PAIR_VALUES, WORD_VALUES = 2, 8


@dataclass(frozen=True)
class Model:
    """``table``: written rows (section, pairs, pair_values, words, word_values), packed arrays sorted by key.

    A bigram has its losses under target and background. A word has those of falling back after it and of
    it as a unigram, then those of the bigrams (word, unknown) and (unknown, word), not a number
    without an entry. ``fixed`` has the values of the unknown word and of the start; ``tokens`` is the size
    of the corpus.
    """

    table: DataFrame
    sections: int
    tokens: int
    fixed: dict[int, list[float]]


def section_of(keys: np.ndarray, sections: int) -> np.ndarray:
    return ((keys.view(np.uint64) >> np.uint64(1)) % np.uint64(sections)).astype(np.int64)


class Fold:
    """Sums by key, in bounded memory; ``about`` holds numbers that go with a key."""

    def __init__(self):
        self.size, self.parts = 0, []

    def add(self, keys: np.ndarray, facts: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.size += len(keys)
        if len(keys):
            self.parts.append((keys, *facts, *counts))

    def take(self, about: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Different keys in order, their first facts and the sums of their counts."""
        keys, *rest = map(np.concatenate, zip(*self.parts, strict=True))
        self.__init__()
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(differs(keys))
        sums_of = [np.add.reduceat(c[order], first, dtype=np.int64) for c in rest[about:]]
        return keys[first], [f[order[first]] for f in rest[:about]], sums_of


def differs(values: np.ndarray) -> np.ndarray:
    """Whether each value is not the one before it; the first is not."""
    return np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[differs(values)]


_SIGNS = "".join(map(chr, [c for c in range(128) if not chr(c).isalnum()]))
#: Words of ASCII and the letters of Latin-1, whose lower case and edges do not depend on Python.
_PLAIN = r"\A[\x00-\x7F\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]*\z"
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def word_hashes(words: pa.Array) -> np.ndarray:
    """XXH64 of each word, all words of one length at a time; words of 32 bytes and more one by one."""
    words = words.cast(pa.large_binary())
    _, bounds, data = words.buffers()
    starts = np.frombuffer(bounds, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data, length = np.frombuffer(data or b"", np.uint8), np.diff(starts)
    out = np.empty(len(words), np.uint64)
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        if n >= 32:
            out[at] = [xxhash.xxh64_intdigest(data[x : x + n]) for x in starts[at].tolist()]
            continue
        cells = data[starts[at][:, None] + np.arange(n)]
        h = np.full(len(at), _P5 + np.uint64(n))
        for k in range(0, n - 7, 8):
            lane = np.ascontiguousarray(cells[:, k : k + 8]).view("<u8").ravel().astype(np.uint64, copy=False)
            h = _turned(h ^ _turned(lane * _P2, 31) * _P1, 27) * _P1 + _P4
        if n & 4:
            lane = np.ascontiguousarray(cells[:, n & ~7 : (n & ~7) + 4]).view("<u4").ravel().astype(np.uint64)
            h = _turned(h ^ lane * _P1, 23) * _P2 + _P3
        for k in range(n & ~3, n):
            h = _turned(h ^ cells[:, k].astype(np.uint64) * _P5, 11) * _P1
        h = (h ^ h >> np.uint64(33)) * _P2
        h = (h ^ h >> np.uint64(29)) * _P3
        out[at] = h ^ h >> np.uint64(32)
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row, and the text of each; ``token_hash`` over columns where words are plain."""
    codes, vocab, offsets = words(texts)
    plain = pc.match_substring_regex(vocab, _PLAIN)
    trimmed = pc.utf8_lower(pc.ascii_trim(vocab, _SIGNS)).filter(plain)
    own, at = np.zeros(len(vocab), np.uint64), plain.to_numpy(zero_copy_only=False)
    own[at] = np.where(pc.binary_length(trimmed).to_numpy() > 0, word_hashes(trimmed) | np.uint64(1), np.uint64(0))
    own[~at] = np.fromiter(map(token_hash, vocab.filter(pc.invert(plain)).to_pylist()), np.uint64, np.count_nonzero(~at))
    hashes = own[codes] if len(own) else own
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    kept = hashes != 0
    return hashes[kept], row[kept]


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Even key of each bigram of word keys."""
    x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.view(np.uint64)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ x >> np.uint64(32)) & ~np.uint64(1)).view(np.int64)


def text_pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second word key of all bigrams of all texts in a row, each text from its start on, and the text of each."""
    hashes, row = tokens(texts)
    b = hashes.view(np.int64)
    a = np.concatenate(([START], b[:-1]))[: len(b)].astype(np.int64)
    return np.where(np.diff(row, prepend=-1) != 0, START, a), b, row


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, prev, next, all, target, end_all, end_target) of every word of column ``text``.

    Counts are over all rows and over those whose column ``target`` is true, ``end_`` those at the end of a
    text. ``prev`` and ``next`` are the neighbours of a word seen once (START, and 0 at the end).
    """
    facts, counts = ["word", "prev", "next"], ["all", "target", "end_all", "end_target"]

    def told(fold: Fold) -> pa.RecordBatch:
        word, beside, sums_of = fold.take(2)
        alone = sums_of[0] == 1
        return pa.RecordBatch.from_arrays([*map(pa.array, (word, *(x * alone for x in beside), *sums_of))], facts + counts)

    def run(batches):
        fold = Fold()
        for batch in batches:
            for part in slices(batch, "text", COUNT_SLICE):
                a, b, row = text_pairs(part["text"])
                wanted = part["target"].to_numpy(zero_copy_only=False)[row]
                last = np.diff(row, append=-1) != 0
                after = np.where(last, 0, np.append(b[1:], 0)[: len(b)])
                if not len(b):
                    continue
                one = Fold()
                one.add(b, [a, after], [np.ones(len(b), np.int32), wanted, last, last & wanted])
                fold.add(*one.take(2))
                if fold.size > TASK_ENTRIES:
                    yield told(fold)
        if fold.size:
            yield told(fold)

    schema = ", ".join(f"{c} long" for c in facts + counts)
    added = [F.max(c).alias(c) for c in facts[1:]] + [F.sum(c).alias(c) for c in counts]
    return docs.select("text", "target").mapInArrow(run, schema).groupBy("word").agg(*added)


def _joined(left: DataFrame, right: DataFrame, on: str, key: str, how: str = "left") -> DataFrame:
    """``left`` with the columns of ``right`` of equal key; by shuffle, as both grow with the corpus."""
    right = right.withColumnRenamed(key, "joined_key")
    return left.join(right.hint("shuffle_merge"), F.col(on) == F.col("joined_key"), how).drop("joined_key")


def pair_counts(docs: DataFrame, sections: int) -> DataFrame:
    """(a, b, all, target): bigrams seen ``LEAST_COUNT`` times in all rows; ``target`` counts the target's.

    Tasks hand over each section's bigrams as first words with the number of their followers, the followers
    and the counts. A section is counted in one task; it holds a bigram once for each time a task lets go.
    """

    names = ["section", "firsts", "runs", "seconds", "counts"]
    # Bits of the section in the order of bigrams, then of the first word, and the rest of the bigram's hash.
    bits = (sections - 1).bit_length()
    first_bits = (64 - bits) // 2
    rest = 64 - bits - first_bits

    def told(parts: list) -> Iterator[pa.RecordBatch]:
        a, b, target = map(np.concatenate, zip(*parts, strict=True))
        parts.clear()
        key = pair_key(a, b)
        section = section_of(key, sections).astype(np.int32)
        # Equal bigrams of one task meet, but for accidents of the hash; those are added up in the section.
        place = a.view(np.uint64) >> np.uint64(64 - first_bits) << np.uint64(rest) | key.view(np.uint64) >> np.uint64(64 - rest)
        if bits:
            place |= section.astype(np.uint64) << np.uint64(64 - bits)
        order = np.argsort(place)
        del key, place
        a, b = a[order], b[order]
        first = np.flatnonzero(differs(a) | differs(b))
        a, b, section = a[first], b[first], section[order[first]]
        every = np.diff(np.append(first, len(order))).astype(np.int32)
        target = np.add.reduceat(target[order], first, dtype=np.int32)
        del order, first
        bounds = np.append(np.flatnonzero(differs(section)), len(section))
        rows, held = [], 0
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = np.flatnonzero(differs(a[start:end]))
            runs = np.diff(np.append(own, end - start)).astype(np.int32)
            counts = every[start:end].tobytes() + target[start:end].tobytes()
            rows.append((int(section[start]), a[start:end][own].tobytes(), runs.tobytes(), b[start:end].tobytes(), counts))
            held += end - start
            if held > HAND_OVER or end == len(section):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], names)
                rows, held = [], 0

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", COUNT_SLICE):
                a, b, row = text_pairs(part["text"])
                if not len(b):
                    continue
                parts.append((a, b, part["target"].to_numpy(zero_copy_only=False)[row]))
                size += len(b)
                if size > TASK_ENTRIES:
                    yield from told(parts)
                    size = 0
        if parts:
            yield from told(parts)

    def count(packed: pa.Table) -> pa.Table:
        read = lambda c, t: [np.frombuffer(x, t) for x in packed[c].to_pylist()]
        a = np.concatenate([np.repeat(x, n) for x, n in zip(read("firsts", np.int64), read("runs", np.int32), strict=True)])
        b = np.concatenate(read("seconds", np.int64))
        every, target = np.concatenate([x.reshape(2, -1) for x in read("counts", np.int32)], axis=1)
        key = pair_key(a, b)
        order = np.argsort(key)
        first = np.flatnonzero(differs(key[order]))
        del key
        every, target = (np.add.reduceat(c[order], first, dtype=np.int64) for c in (every, target))
        keep = every >= LEAST_COUNT
        at = order[first[keep]]
        return pa.table([a[at], b[at], every[keep], target[keep]], ["a", "b", "all", "target"])

    packed = docs.select("text", "target").mapInArrow(run, "section int, firsts binary, runs binary, seconds binary, counts binary")
    return packed.groupBy("section").applyInArrow(count, "a long, b long, all long, target long")


def unknown_pairs(seen: DataFrame) -> DataFrame:
    """The same of bigrams with the unknown word, from the neighbours of the words that are seen once."""
    rare = seen.where(F.col("all") < LEAST_COUNT)
    once = rare.select("word", F.lit(True).alias("once"))

    def beside(side: str) -> DataFrame:
        # Added up by neighbour before the join, so that a neighbour of very many rare words is one row.
        by = rare.where(F.col(side) != 0).groupBy(F.col(side).alias("other")).agg(F.sum("all").alias("all"), F.sum("target").alias("target"))
        return _joined(by, once, "other", "word")

    unknown = F.lit(UNKNOWN).cast("long")
    before = beside("prev").select(F.when(F.col("once"), unknown).otherwise(F.col("other")).alias("a"), unknown.alias("b"), "all", "target")
    after = beside("next").where(F.col("once").isNull()).select(unknown.alias("a"), F.col("other").alias("b"), "all", "target")
    found = before.unionByName(after).groupBy("a", "b").agg(F.sum("all").alias("all"), F.sum("target").alias("target"))
    return found.where(F.col("all") >= LEAST_COUNT)


def _packed(words: DataFrame, entries: DataFrame, sections: int) -> DataFrame:
    """The model's table from (key, values) of words and (a, b, losses) of bigrams."""

    def keyed(batches):
        for batch in batches:
            key = pair_key(batch["a"].to_numpy(), batch["b"].to_numpy())
            both = np.stack([batch["target_loss"].to_numpy(), batch["all_loss"].to_numpy()], axis=1)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * PAIR_VALUES), pa.array(both.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(key), values], ["key", "values"])

    def pack(rows: pa.Table) -> pa.Table:
        key, lists = rows["key"].to_numpy(), rows["values"].combine_chunks()
        flat, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        out = [rows["section"][:1].cast(pa.int32())]
        for odd, width in ((0, PAIR_VALUES), (1, WORD_VALUES)):
            at = np.flatnonzero((key & 1) == odd)
            at = at[np.argsort(key[at].view(np.uint64))]
            out += [pa.array([key[at].tobytes()], pa.binary()), pa.array([flat[starts[at, None] + np.arange(width)].tobytes()], pa.binary())]
        return pa.table(out, ["section", "pairs", "pair_values", "words", "word_values"])

    plain = entries.where((F.col("a") != UNKNOWN) & (F.col("b") != UNKNOWN)).mapInArrow(keyed, "key long, values array<float>")
    both = words.where(~F.col("key").isin(UNKNOWN, START)).unionByName(plain)
    section = F.pmod(F.shiftrightunsigned("key", 1), F.lit(sections)).cast("int")
    schema = "section int, pairs binary, pair_values binary, words binary, word_values binary"
    return both.select(section.alias("section"), "key", "values").groupBy("section").applyInArrow(pack, schema)


def train(docs: DataFrame, text: str, target: str) -> Model:
    """Both models from ``docs``; rows whose ``target`` is not true are background only."""
    own = docs.select(col(text).alias("text"), F.coalesce(col(target).cast("boolean"), F.lit(False)).alias("target"))
    sides = ("target", "all")
    seen = materialise(word_counts(own))
    n = seen.agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in sides), F.count_if(F.col("all") >= LEAST_COUNT).alias("known")).first()
    size, sections = n["known"] + 2, max(1, math.ceil(n["all"] / SECTION_TOKENS))
    known = materialise(pair_counts(own, sections))
    counts = known.unionByName(unknown_pairs(seen))

    def stated(rows: DataFrame, key: int, first: str, second: str) -> DataFrame:
        """One row, of a symbol that is no word: sums over ``rows``."""
        told = [F.coalesce(F.sum(F.expr(e.replace("?", m))), F.lit(0)).alias(f"{c}_{m}") for c, e in (("first", first), ("second", second)) for m in sides]
        return rows.agg(*told).select(F.lit(key).cast("long").alias("key"), *(f"{c}_{m}" for c in ("first", "second") for m in sides))

    words = seen.where(F.col("all") >= LEAST_COUNT).select(
        F.col("word").alias("key"), *((F.col(m) - F.col(f"end_{m}")).alias(f"first_{m}") for m in sides), *(F.col(m).alias(f"second_{m}") for m in sides)
    )
    words = words.unionByName(stated(seen.where(F.col("all") < LEAST_COUNT), UNKNOWN, "`?` - `end_?`", "`?`"))
    words = words.unionByName(stated(seen, START, "`end_?`", "0"))
    mass = counts.groupBy("a").agg(*(F.sum(F.greatest(F.col(m) - DISCOUNT, F.lit(0.0))).alias(f"mass_{m}") for m in sides))
    first = {m: F.greatest(f"first_{m}", F.lit(1)) for m in sides}
    left = [F.greatest(1 - F.coalesce(f"mass_{m}", F.lit(0.0)) / first[m], F.lit(1e-9)).alias(f"left_{m}") for m in sides]
    chance = [((F.col(f"second_{m}") + 1) / float(n[m] + size)).alias(f"chance_{m}") for m in sides]
    words = materialise(_joined(words, mass, "key", "a").select("key", *(first[m].alias(f"first_{m}") for m in sides), *left, *chance))

    told = _joined(counts, words.select("key", *(f"{c}_{m}" for c in ("first", "left") for m in sides)), "a", "key", "inner")
    direct = [(F.greatest(F.col(m) - DISCOUNT, F.lit(0.0)) / F.col(f"first_{m}")).alias(f"direct_{m}") for m in sides]
    told = told.select("a", "b", *direct, *(f"left_{m}" for m in sides))
    told = _joined(told, words.select("key", *(f"chance_{m}" for m in sides)), "b", "key", "inner")
    loss = [(-F.log(F.col(f"direct_{m}") + F.col(f"left_{m}") * F.col(f"chance_{m}"))).cast("float").alias(f"{m}_loss") for m in sides]
    entries = materialise(told.select("a", "b", *loss))
    drop_tables(seen, known)

    after = entries.where(F.col("b") == UNKNOWN).select("a", *(F.col(f"{m}_loss").alias(f"after_{m}") for m in sides))
    before = entries.where(F.col("a") == UNKNOWN).select("b", *(F.col(f"{m}_loss").alias(f"before_{m}") for m in sides))
    full = _joined(_joined(words, after, "key", "a"), before, "key", "b")
    values = [-F.log(f"{c}_{m}") for c in ("left", "chance") for m in sides]
    values += [F.coalesce(f"{c}_{m}", F.lit(float("nan"))) for c in ("after", "before") for m in sides]
    full = full.select("key", F.array(*(v.cast("float") for v in values)).alias("values"))
    fixed = {r["key"]: r["values"] for r in full.where(F.col("key").isin(UNKNOWN, START)).collect()}
    table = materialise(_packed(full, entries, sections))
    drop_tables(words, entries)
    return Model(table, sections, n["all"], fixed)


def losses(texts: pa.Array, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss a token of each text under the target and the background, and the number of tokens.

    ``keys`` are sorted and hold those of the model among the texts' words and bigrams, UNKNOWN and START;
    ``values`` has a row of eight for each.
    """
    a, b, row = text_pairs(texts)

    def place(wanted, default):
        # In order, so that the search stays where it was.
        order = np.argsort(wanted)
        at = np.empty(len(wanted), np.int64)
        at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
        return np.where(keys[at] == wanted, at, default)

    unknown, start = (int(np.searchsorted(keys, k)) for k in (UNKNOWN, START))
    pair, begins = place(pair_key(a, b), -1), a == START
    b = place(b, unknown)
    a = np.where(begins, start, np.concatenate(([start], b[:-1]))[: len(b)])
    offsets = np.searchsorted(row, np.arange(len(texts) + 1))
    n = np.diff(offsets)
    out = np.zeros((2, len(n)))
    for m in range(2):
        own = np.where(b == unknown, values[a, 4 + m], np.where(a == unknown, values[b, 6 + m], np.where(pair >= 0, values[pair, m], np.nan)))
        loss = np.where(np.isnan(own), values[a, m] + values[b, 2 + m], own)
        out[m] = sums(loss.astype(np.float64), offsets) / np.maximum(n, 1)
    return out, n


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row; ``score`` is the difference.

    Null texts and texts without a word have no tokens and score 0; ids may be null or repeat; other
    columns are not read. Without target rows the target model knows only the vocabulary. Equal rows
    are dealt to slices by their place in the table. The rows are written when this is called.
    """
    own = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    out = [materialise(_score_part(own, model, part, size)) for part in range(ROUNDS)]
    for one in out[1:]:
        out[0] = out[0].unionByName(one)
    return out[0]


def _score_part(own: DataFrame, model: Model, part: int, size: int) -> DataFrame:
    """Scores of the rows of one part; ``size`` is the text of all in bytes."""
    id_type = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, score double"
    n = max(1, math.ceil(size / ROUNDS / SCORE_BYTES))
    # Questions of so many slices meet one copy of a section: copies grow with the documents over the corpus of the model.
    copies = max(1, math.ceil(size / 4 / max(model.tokens, SECTION_TOKENS)))
    sections, fixed = model.sections, model.fixed
    mine = own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == part)
    row = F.monotonically_increasing_id()
    dealt = mine.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text", row), F.lit(n)).cast("int")).repartition("slice")

    def ask(batches):
        asked: dict[int, list[np.ndarray]] = {}
        held = 0

        def told():
            for s in list(asked):
                keys = distinct(np.concatenate(asked.pop(s)))
                rows = list(sectioned(section_of(keys, sections), keys))
                columns = [pa.array([x for x, _ in rows], pa.int32()), pa.array([s % copies] * len(rows), pa.int32()), pa.array([s] * len(rows), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x for _, x in rows], pa.binary())], ["section", "copy", "slice", "asked"])

        for batch in batches:
            for piece in slices(batch, "text", COUNT_SLICE):
                a, b, row = text_pairs(piece["text"])
                pair, to = pair_key(a, b), piece["slice"].to_numpy()[row]
                order = np.argsort(to, kind="stable")
                bounds = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(order))
                for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                    at = order[start:end]
                    asked.setdefault(int(to[at[0]]), []).append(distinct(np.concatenate((distinct(b[at]), pair[at]))))
                    held += len(asked[int(to[at[0]])][-1])
            if held > ASK_KEYS:
                asked = {s: [distinct(np.concatenate(keys))] for s, keys in asked.items()}
                held = sum(len(keys) for keys, in asked.values())
                if held > ASK_KEYS // 2:
                    yield from told()
                    held = 0
        yield from told()

    def answer(questions: pa.Table, held: pa.Table) -> pa.Table:
        parts = {c: np.frombuffer(b"".join(held[c].to_pylist()), t) for c, t in (("pairs", np.uint64), ("pair_values", np.float32), ("words", np.uint64), ("word_values", np.float32))}
        rows = []
        for s, packed in zip(questions["slice"].to_pylist(), questions["asked"].to_pylist(), strict=True):
            keys, found = np.frombuffer(packed, np.uint64), [s]
            for odd, name, width in ((0, "pair", PAIR_VALUES), (1, "word", WORD_VALUES)):
                wanted, there = keys[(keys & np.uint64(1)) == odd], parts[f"{name}s"]
                at = np.searchsorted(there, wanted)
                hit = at < len(there)
                hit[hit] = there[at[hit]] == wanted[hit]
                found += [wanted[hit].tobytes(), parts[f"{name}_values"].reshape(-1, width)[at[hit]].tobytes()]
            rows.append(found)
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.table([pa.array(x, t) for x, t in zip(columns, (pa.int32(), *[pa.binary()] * 4), strict=True)], ["slice", "pairs", "pair_values", "words", "word_values"])

    def told(texts: pa.Table, found: pa.Table) -> pa.Table:
        read = lambda c, t: np.frombuffer(b"".join(found[c].to_pylist()), t)
        keys = np.concatenate((read("pairs", np.int64), read("words", np.int64), np.array(list(fixed), np.int64)))
        values, pairs = np.full((len(keys), WORD_VALUES), np.nan, np.float32), len(read("pairs", np.int64))
        values[:pairs, :PAIR_VALUES] = read("pair_values", np.float32).reshape(-1, PAIR_VALUES)
        values[pairs:] = np.concatenate((read("word_values", np.float32), np.ravel(list(fixed.values())))).reshape(-1, WORD_VALUES)
        # A task may ask for a slice more than once.
        order = np.argsort(keys)
        order = order[differs(keys[order])]
        keys, values, out = keys[order], values[order], []
        for batch in texts.to_batches():
            for piece in slices(batch, "text", COUNT_SLICE):
                (target, background), tokens_in = losses(piece["text"], keys, values)
                out.append(pa.RecordBatch.from_arrays(
                    [piece["doc_id"], *map(pa.array, (tokens_in.astype(np.int64), target, background, target - background))],
                    ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
                ))
        none = pa.schema([("doc_id", texts.schema.field("doc_id").type), ("n_tokens", pa.int64()), *((c, pa.float64()) for c in ("target_loss", "background_loss", "score"))])
        return pa.Table.from_batches(out, out[0].schema if out else none)

    # All columns go to both sides, so that the texts are dealt once.
    asked = dealt.mapInArrow(ask, "section int, copy int, slice int, asked binary")
    held = model.table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    answers = asked.groupBy("section", "copy").cogroup(held.groupBy("section", "copy"))
    answers = answers.applyInArrow(answer, "slice int, pairs binary, pair_values binary, words binary, word_values binary")
    return dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(told, schema)
