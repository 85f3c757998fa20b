"""Toxicity by a weighted finite-state pattern grammar over clauses.

Small transducers read a clause as symbols (insult, threat, target, negation, reported speech,
other): one gives weight to insults and threats, one raises it near a target, one lowers it after a
negation, one lowers it in reported speech. They are composed into one automaton, and a clause
scores the sum of what its matches give. An insult counts in full on its own, as ``_worth`` gives it;
what stands around it in its clause only raises or lowers that. A threat alone counts little.

Function words are fixed lists. Insults are learned: words and word stems that stand in many more
toxic than other labelled texts. A logistic curve over the document's clause scores gives the
score. Both are fitted on at most ``SAMPLE_ROWS`` labelled rows, picked by a hash of their id; every
document is scored in full.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, words
from .tables import col

SAMPLE_ROWS = 40_000
#: An insult stands in so many toxic texts at least, and its log odds against other texts are that high.
LEAST_TEXTS, LEAST_ODDS = 3, 2.5
#: Stems are word beginnings of these lengths; a word's own entry goes before its longest stem's.
STEMS = (4, 5, 6)
MOST_FEATURE = 12.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Function words of the grammar in four languages.
TARGETS = "you your yours he she they them him her u du dich dir ihr euch sie tu toi te vous ils elle usted ustedes ti él ella ellos".split()
NEGATIONS = "not never no isn't aren't don't doesn't wasn't nicht kein keine nie niemals pas jamais nunca jamás".split()
REPORTS = "said says say told wrote claimed called sagte schrieb nannte behauptete dit disait écrit dijo dice escribió llamó".split()
THREATS = "kill hurt beat destroy stab shoot töten umbringen schlagen tuer frapper matar golpear".split()
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_CLAUSE_END = r"[.,;:!?\n][\"'»”)]*$"


@dataclass(frozen=True)
class Transducer:
    """``step(state, symbol)`` gives the next state and the factor for what the symbol is worth."""

    start: int
    step: Callable[[int, int], tuple[int, float]]


def _memory(symbol: int, span: int, factor: float) -> Transducer:
    """Multiplies insults and threats that come within ``span`` words after ``symbol``."""

    def step(state: int, read: int) -> tuple[int, float]:
        worth = factor if state and read in (INSULT, THREAT) else 1.0
        return (span if read == symbol else max(0, state - 1)), worth

    return Transducer(0, step)


def _reported(factor: float) -> Transducer:
    """Multiplies whatever comes in a clause after a verb of saying."""
    return Transducer(0, lambda state, read: (1 if state or read == REPORT else 0, factor if state else 1.0))


def _worth(insult: float, threat: float) -> Transducer:
    return Transducer(0, lambda state, read: (0, {INSULT: insult, THREAT: threat}.get(read, 0.0)))


#: Insults count in full without a target; a threat counts little until a target is near.
GRAMMAR = (_worth(1.0, 0.2), _memory(TARGET, 4, 1.5), _memory(NEGATION, 3, 0.4), _reported(0.6))


def compose(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, np.ndarray]:
    """One automaton for all parts: next state and worth by state and symbol; state 0 is the start."""
    place = {tuple(t.start for t in parts): 0}
    waiting, moves, worth = [next(iter(place))], [], []
    while len(moves) < len(waiting):
        state = waiting[len(moves)]
        row, gain = [], []
        for read in range(REPORT + 1):
            steps = [t.step(s, read) for t, s in zip(parts, state, strict=True)]
            new = tuple(s for s, _ in steps)
            if new not in place:
                place[new] = len(waiting)
                waiting.append(new)
            row.append(place[new])
            gain.append(float(np.prod([w for _, w in steps])))
        moves.append(row)
        worth.append(gain)
    return np.array(moves), np.array(worth)


MOVES, WORTH = compose(GRAMMAR)


@dataclass(frozen=True)
class Model:
    """Weight of each insult (word, or stem with ``*``), and the logistic curve."""

    insults: dict[str, float]
    curve: np.ndarray


def clean(word: str) -> str:
    return _EDGES.sub("", word.lower())


def entries(word: str) -> list[str]:
    """Lexicon entries under which a word may stand, the nearest first."""
    return [word, *(word[:n] + "*" for n in reversed(STEMS) if len(word) > n)] if word else []


def symbol(word: str, insults: dict[str, float]) -> tuple[int, float]:
    """Class and weight of a cleaned word."""
    for e in entries(word):
        if e in insults:
            return (INSULT, insults[e]) if insults[e] > 0 else (OTHER, 0.0)
    for kind, listed in ((THREAT, _THREATS), (TARGET, _TARGETS), (NEGATION, _NEGATIONS), (REPORT, _REPORTS)):
        if word in listed:
            return kind, 1.0
    return OTHER, 0.0


_THREATS, _TARGETS, _NEGATIONS, _REPORTS = map(frozenset, (THREATS, TARGETS, NEGATIONS, REPORTS))


def clause_features(texts: pa.Array, insults: dict[str, float]) -> np.ndarray:
    """Of each text: sum of its clauses' scores, highest clause, number of matched clauses, different insults."""
    codes, vocab, offsets = words(pc.replace_substring(pc.fill_null(texts, ""), "\n", " . "))
    out = np.zeros((len(texts), 4))
    if not len(vocab):
        return out
    own = [symbol(clean(w), insults) for w in vocab.to_pylist()]
    kind, weight = np.array([k for k, _ in own]), np.array([w for _, w in own])
    ends = pc.match_substring_regex(vocab, _CLAUSE_END).to_numpy(zero_copy_only=False)[codes]
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    clause = np.cumsum(np.concatenate(([False], ends[:-1])) | (np.diff(row, prepend=-1) != 0))
    kinds = kind[codes]
    hit = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
    seen: dict[int, set[int]] = {}
    for c in np.unique(clause[hit]).tolist():
        lo, hi = np.searchsorted(clause, c), np.searchsorted(clause, c, "right")
        state, score = 0, 0.0
        for k, w in zip(kinds[lo:hi].tolist(), weight[codes[lo:hi]].tolist(), strict=True):
            score += WORTH[state, k] * w
            state = MOVES[state, k]
        r = int(row[lo])
        out[r, 0] += score
        out[r, 1] = max(out[r, 1], score)
        out[r, 2] += 1
        seen.setdefault(r, set()).update(codes[lo:hi][kinds[lo:hi] == INSULT].tolist())
    for r, found in seen.items():
        out[r, 3] = len(found)
    return out


def bounded(x: np.ndarray) -> np.ndarray:
    """Features as the curve takes them: each at most ``MOST_FEATURE``."""
    return np.minimum(x, MOST_FEATURE)


def entry_counts(labelled: DataFrame) -> DataFrame:
    """(entry, toxic, others): in how many texts of either label each word or stem stands, of (text, label) rows."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 16 << 20):
                codes, vocab, offsets = words(part["text"])
                label = part["label"].to_numpy(zero_copy_only=False) > 0
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                own = [entries(clean(w)) for w in vocab.to_pylist()]
                place: dict[str, int] = {}
                listed = np.fromiter((place.setdefault(e, len(place)) for e in itertools.chain.from_iterable(own)), np.int64)
                many = np.array([len(e) for e in own], dtype=np.int64)
                begin = np.cumsum(many) - many
                # Each word of each text once, then its entries, each once for the text.
                pair = np.unique(row * len(vocab) + codes) if len(codes) else np.zeros(0, np.int64)
                r, w = pair // max(1, len(vocab)), pair % max(1, len(vocab))
                at = np.repeat(begin[w] - (np.cumsum(many[w]) - many[w]), many[w]) + np.arange(many[w].sum())
                pair = np.unique(np.repeat(r, many[w]) * max(1, len(place)) + listed[at])
                r, e = pair // max(1, len(place)), pair % max(1, len(place))
                toxic = np.bincount(e[label[r]], minlength=len(place))
                others = np.bincount(e[~label[r]], minlength=len(place))
                # An entry that no toxic text of this slice holds still counts against it.
                yield pa.RecordBatch.from_arrays([pa.array(list(place), pa.string()), pa.array(toxic), pa.array(others)], ["entry", "toxic", "others"])

    counted = labelled.mapInArrow(run, "entry string, toxic long, others long")
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"))


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the first coefficient is the intercept."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    b = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge * max(1, len(x)) / 100] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b = b - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (p - y) + keep @ b)
    return b


def sample_labels(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """(label_id, label): one row an id, its highest label; at most ``rows``, those of the smallest hashes."""
    one = labels.select(col(doc_id).alias("label_id"), col(label).cast("int").alias("label")).dropna()
    one = one.groupBy("label_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and curve from the labelled rows among ``docs``.

    Null labels and ids teach nothing. Without rows of both kinds the lexicon is empty and the score
    is the share of toxic labels (one half if there is none).
    """
    from touchline.session import materialise

    wanted = F.broadcast(sample_labels(labels, doc_id, label, rows))
    own = docs.select(col(doc_id).alias("id"), col(text).alias("text")).join(wanted, F.col("id") == F.col("label_id"))
    own = materialise(own.select("text", "label"))
    n = {r["label"] > 0: r["count"] for r in own.groupBy("label").count().collect()}
    toxic, others = n.get(True, 0), n.get(False, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("others") + 0.5) / (others + 1))
    least = max(LEAST_TEXTS, toxic / 1000)
    known = entry_counts(own).withColumn("odds", odds).where(F.col("toxic") >= least).where(F.col("odds") >= LEAST_ODDS)
    insults = {r["entry"]: min(3.0, r["odds"] / 4) for r in known.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(insults)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = bounded(clause_features(part["text"], shared.value))
                yield pa.RecordBatch.from_arrays([part["label"], *map(pa.array, x.T)], ["label", "a", "b", "c", "d"])

    rows_ = own.mapInArrow(run, "label int, a double, b double, c double, d double").toArrow()
    x = np.stack([rows_[c].to_numpy() for c in "abcd"], axis=1)
    y = (rows_["label"].to_numpy() > 0).astype(float)
    if not (0 < y.sum() < len(y)):
        share = (y.sum() + 1) / (len(y) + 2)
        return Model({}, np.array([np.log(share / (1 - share)), 0, 0, 0, 0]))
    return Model(insults, fit_curve(x, y))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, clauses) of every row: score from 0 to 1, and the number of matched clauses.

    Null and empty texts match nothing and get the lowest score of the curve; null ids and repeated
    rows are answered each; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double, clauses long"

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                x = clause_features(part["text"], model.insults)
                p = 1 / (1 + np.exp(-np.clip(model.curve[0] + bounded(x) @ model.curve[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(p), pa.array(x[:, 2].astype(np.int64))], ["doc_id", "score", "clauses"])

    return docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(run, schema)
