"""Language identification with language-bitmask n-gram filters.

Each language has a Bloom filter of the n-grams that are typical of it. The filters are
bit-sliced: one table of slots, whose bit l belongs to language l, so that one lookup (the AND of
a few slots) returns all languages that hold an n-gram. A document is decided by the number of its
n-grams in each language, after taking off the hits that the filter's fill makes by chance.

N-grams are runs of bytes inside a word and its two borders, so a text is read as words, and
each different word of a slice is looked up once. Training counts n-grams by language over all
labelled documents; counts are folded in tasks and then by key. The table has a fixed number of
slots, the bound under which it is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialise

from .batches import slices, sums, words
from .tables import col, plain_names

SIZES = (3, 4)
SLOTS = 1 << 21
PROBES = 3
MOST_LANGUAGES = 63
UNKNOWN = "und"
#: An n-gram is typical of a language if it comes there so often, in comparison with its best language, and twice at least.
SHARE, LEAST_COUNT = 0.1, 2
#: Below this share of known n-grams a text is rejected by ``keep_identified``.
LEAST_KNOWN = 0.1
TASK_GRAMS, PENDING = 2_000_000, 8
#: Bytes of text that are read as words at a time; a worker's peak grows with it, its time does not fall.
TEXT_SLICE = 1 << 20


@dataclass(frozen=True)
class Model:
    """``masks[slot]``: bit l is set if the slot belongs to ``languages[l]``."""

    languages: tuple[str, ...]
    masks: np.ndarray

    def fill(self) -> np.ndarray:
        """Chance that an n-gram which a language does not hold hits it all the same."""
        bits = [(self.masks >> np.uint64(i)) & np.uint64(1) for i in range(len(self.languages))]
        return np.array([float(b.mean()) ** PROBES for b in bits])


def letters_only(vocab: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.replace_substring_regex(vocab, r"[^\pL]+", ""))


def grams(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all words, with the position of their word. Borders count as a space."""
    if not len(vocab):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.frombuffer(b" " + b" ".join(vocab.cast(pa.binary()).to_pylist()) + b" ", dtype=np.uint8).astype(np.int64)
    border = text == 32
    word = np.cumsum(border) - 1
    found, owner = [], []
    for n in SIZES:
        last = len(text) - n + 1
        if last <= 0:
            continue
        code, inside = np.full(last, n, np.int64), np.ones(last, bool)
        for j in range(n):
            code = code << 8 | text[j : last + j]
            if 0 < j < n - 1:
                inside &= ~border[j : last + j]
        found.append(code[inside])
        owner.append(word[:last][inside])
    return np.concatenate(found), np.concatenate(owner)


def slots(gram: np.ndarray) -> np.ndarray:
    """Slots of each n-gram, one column a probe."""
    x = gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(33)) | np.uint64(1)
    return ((x[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(SLOTS)).astype(np.int64)


def lookup(masks: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The languages of each n-gram as bits, in pieces that stay in cache."""
    out = np.empty(len(gram), np.uint64)
    for lo in range(0, len(gram), 1 << 16):
        out[lo : lo + (1 << 16)] = np.bitwise_and.reduce(masks[slots(gram[lo : lo + (1 << 16)])], axis=1)
    return out


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of (text, lang) rows, folded in each task."""

    def run(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        entries = 0

        def fold(pairs):
            gram, at = np.unique(np.concatenate([g for g, _ in pairs]), return_inverse=True)
            return gram, np.bincount(at, np.concatenate([n for _, n in pairs]), len(gram)).astype(np.int64)

        def told():
            for lang, pairs in held.items():
                gram, n = fold(pairs)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", TEXT_SLICE):
                codes, vocab, offsets = words(part["text"])
                gram, owner = grams(letters_only(vocab))
                lang = part["lang"].dictionary_encode()
                of_word = np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(offsets))
                for i, name in enumerate(lang.dictionary.to_pylist()):
                    times = np.bincount(codes[of_word == i], minlength=len(vocab))[owner]
                    used = times > 0
                    held.setdefault(name, []).append(fold([(gram[used], times[used])]))
                    if len(held[name]) > PENDING:
                        held[name] = [fold(held[name])]
                entries = sum(len(g) for p in held.values() for g, _ in p)
                if entries > TASK_GRAMS:
                    yield from told()
        yield from told()

    return docs.mapInArrow(run, "lang string, gram long, n long")


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Filters of the languages in ``lang``; rows with null text or label teach nothing.

    More than ``MOST_LANGUAGES`` different labels are refused. No labelled row gives a model without
    languages, which answers ``und``.
    """
    labelled = docs.select(col(text).alias("text"), col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = materialise(count_grams(labelled).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # Relative to the gram's best language; one language's total is the sum of its rows.
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(r["lang"] for r in totals)
    if not languages:
        return Model((), np.zeros(SLOTS, np.uint64))
    share = F.create_map(*(F.lit(x) for r in totals for x in (r["lang"], 1.0 / r["total"])))
    place = F.create_map(*(F.lit(x) for i, name in enumerate(languages) for x in (name, i)))
    own = counts.select("gram", "n", (F.col("n") * share[F.col("lang")]).alias("rate"), place[F.col("lang")].alias("place"))
    of_gram = own.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("n", "rate", "place")).alias("rows"))
    typical = F.filter("rows", lambda r: (r["n"] >= LEAST_COUNT) & (r["rate"] >= SHARE * F.col("best")))
    bit = F.aggregate(typical, F.lit(0).cast("long"), lambda a, r: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), r["place"])))
    masked = of_gram.select("gram", bit.alias("mask")).where("mask != 0")

    def spread(batches):
        for batch in batches:
            at = slots(batch["gram"].to_numpy())
            mask = np.repeat(batch["mask"].to_numpy(), PROBES)
            yield pa.RecordBatch.from_arrays([pa.array(at.ravel().astype(np.int32)), pa.array(mask)], ["slot", "mask"])

    filled = masked.mapInArrow(spread, "slot int, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros(SLOTS, np.uint64)
    masks[filled["slot"].to_numpy()] = filled["mask"].to_numpy().astype(np.uint64)
    return Model(languages, masks)


def decide(texts: pa.Array, model: Model, fill: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and share of known n-grams of each text."""
    codes, vocab, offsets = words(texts)
    clean = letters_only(vocab)
    gram, owner = grams(clean)
    held = lookup(model.masks, gram)
    per_word = lambda x: np.bincount(owner, x, len(vocab))
    in_doc = lambda x: sums(per_word(x)[codes] if len(vocab) else np.zeros(0), offsets)
    n = in_doc(np.ones(len(gram)))
    hits = np.stack([in_doc(((held >> np.uint64(i)) & np.uint64(1)).astype(float)) for i in range(len(model.languages))], axis=1)
    real = np.clip((hits - n[:, None] * fill) / (1 - np.minimum(fill, 0.999)), 0, None)
    best, total = real.argmax(axis=1), real.sum(axis=1)
    top = real[np.arange(len(best)), best]
    letters = sums((pc.binary_length(clean).to_numpy(zero_copy_only=False) > 0)[codes].astype(np.int64) if len(vocab) else np.zeros(0, np.int64), offsets) > 0
    score = np.where(letters & (total > 0), top / np.maximum(total, 1e-9), 0.0)
    known = np.where(n > 0, top / np.maximum(n, 1), 0.0)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
    return names, np.clip(score, 0.0, 1.0), np.clip(known, 0.0, 1.0)


def _shared(docs: DataFrame, model: Model):
    return docs.sparkSession.sparkContext.broadcast((model, model.fill()))


def identify(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, known) of every row.

    ``lang_pred`` is ``und`` for null texts and texts without a letter. Ties go to the language that
    sorts first. ``score`` is the language's part of all corrected hits, ``known`` its part of the
    text's n-grams. Other columns are not read; repeated rows are answered each.
    """
    shared = _shared(docs, model)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, lang_pred string, score double, known double"

    def run(batches):
        model, fill = shared.value
        for batch in batches:
            for part in slices(batch, "text", TEXT_SLICE):
                if model.languages:
                    names, score, known = decide(part["text"], model, fill)
                else:
                    names, score, known = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(names), pa.array(score), pa.array(known)], ["doc_id", "lang_pred", "score", "known"])

    return docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least_known: float = LEAST_KNOWN) -> DataFrame:
    """The rows of ``docs`` whose language is known; texts without letters, or with hardly a known n-gram, go."""
    shared = _shared(docs, model)
    plain, names = plain_names(docs)
    body = names[docs.columns.index(text)]

    def run(batches):
        model, fill = shared.value
        for batch in batches:
            for part in slices(batch, body, TEXT_SLICE):
                if model.languages:
                    told, _, known = decide(part[body], model, fill)
                    yield part.filter(pa.array((np.array(told, dtype=object) != UNKNOWN) & (known >= least_known)))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
