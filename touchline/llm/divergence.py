"""Audit of how far sources of a language diverge in their words.

Counting is a sort of pointers: the starts of all words of a slice of texts, an Arrow buffer, are put in
order by multikey quicksort with eight bytes as one character, so that a level of the sort is one array
operation over all classes that are still open. Runs of equal words then give occurrences and documents for
each source. Slices of a task are folded, and the counts of all tasks meet once, by language and word.

Shares are whole numbers, so nothing depends on the order of sums. For pairs of sources only words that one
of both has are compared; what is left is one product. A task compares blocks of sources over a section of
the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.running import running
from touchline.session import materialise

from .batches import slices
from .tables import col

SLICE = 4 << 20
#: Counted rows that a task holds before it passes them on.
FOLD_ROWS, OUT_ROWS = 2_000_000, 1 << 16
LEAST_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Sources of a block, rows of a section, words compared at once.
BLOCK, SECTION_ROWS, STEP = 128, 20_000, 4096

_byte = np.arange(256, dtype=np.uint8)
_letter = ((_byte | 0x20) >= ord("a")) & ((_byte | 0x20) <= ord("z")) & (_byte < 0x80)
# A byte of a word in lower case, and zero for any other.
_WORD_BYTE = np.where(_letter, _byte | 0x20, np.where(_byte >= 0x80, _byte, 0)).astype(np.uint8)
# The first k bytes of eight.
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], dtype=np.uint64)


def sort_pointers(text: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by group, then bytes, and where runs of equal ones begin; equal words keep their order.

    ``text`` has eight bytes more than any word needs.
    """
    window = np.ndarray((len(text) - 7,), dtype=">u8", buffer=text, strides=(1,))
    order = np.argsort(group, kind="stable")
    begins = np.diff(group[order], prepend=-1) != 0
    # Places of words whose class is still open, and the class of each.
    places, depth = np.arange(len(start)), 0
    while len(places):
        words = order[places]
        keys = window[start[words] + np.minimum(depth, size[words])].astype(np.uint64) & _FIRST[np.clip(size[words] - depth, 0, 8)]
        classes = np.cumsum(begins[places])
        by = np.lexsort((keys, classes))
        words, keys = words[by], keys[by]
        order[places] = words
        parts = np.diff(keys, prepend=keys[:1]) != 0
        begins[places] |= parts
        depth += 8
        # A class goes on if it has more than one word and its words may be longer.
        heads = np.flatnonzero(begins[places])
        many = np.repeat(np.diff(np.append(heads, len(places))) > 1, np.diff(np.append(heads, len(places))))
        places = places[many & (size[words] >= depth)]
    return order, begins


def counted(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one slice: occurrences and rows of each word."""
    texts = pc.fill_null(batch["text"], "").cast(pa.large_binary())
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    own = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    text = np.zeros(len(own) + 8, dtype=np.uint8)
    text[: len(own)] = _WORD_BYTE[own]
    inside = text[: len(own)] != 0
    filled = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[filled[0]], after[filled[1] - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    size = end - start
    doc = np.searchsorted(offsets, start, "right") - 1

    langs, sources = (batch[c].dictionary_encode() for c in ("lang", "source"))
    code = langs.indices.to_numpy().astype(np.int64) * max(len(sources.dictionary), 1) + sources.indices.to_numpy()
    order, begins = sort_pointers(text, start, size, code[doc])
    heads = np.flatnonzero(begins)
    if not len(heads):
        return TABLE.empty_table()
    doc = doc[order]
    changed = begins.copy()
    changed[1:] |= doc[1:] != doc[:-1]
    held = np.add.reduceat(changed.astype(np.int64), heads)
    n = np.diff(np.append(heads, len(order)))
    first = order[heads]
    ends = np.concatenate(([0], np.cumsum(size[first])))
    letters = text[np.repeat(start[first] - ends[:-1], size[first]) + np.arange(ends[-1])]
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters))
    row = pa.array(doc[heads])
    return pa.table([batch["lang"].take(row), batch["source"].take(row), terms.cast(pa.string()), pa.array(n), pa.array(held)], schema=TABLE)


TABLE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batches):
    held, rows = [], 0
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            held.append(counted(part))
            rows += held[-1].num_rows
            if rows > FOLD_ROWS:
                yield from _folded(held).to_batches(OUT_ROWS)
                held, rows = [], 0
    if held:
        yield from _folded(held).to_batches(OUT_ROWS)


def _folded(tables: list[pa.Table]) -> pa.Table:
    if len(tables) == 1:
        return tables[0]
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(TABLE.names).cast(TABLE)


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, total) of words in at least ``least_docs`` rows of their language; ``total`` is its occurrences there."""
    rows = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # One exchange by language and word serves the sums and the windows.
    sums = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    word = Window.partitionBy("lang", "term")
    told = sums.withColumns({"held": F.sum("docs").over(word), "total": F.sum("n").over(word)})
    return materialise(told.where(F.col("held") >= least_docs).select("lang", "term", "source", "n", "total"))


def share(n: Column, all_n: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (all_n + 2 * terms)), exactly; 1 where nothing is kept."""
    wide = "decimal(20,0)"
    whole = (all_n + 2 * terms).cast(wide)
    top = (n + 2).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(whole > 0, (top - top % F.when(whole > 0, whole)) / F.when(whole > 0, whole)).otherwise(0).cast("long") + 1


def distance(p: Column, q: Column) -> Column:
    square = (p - q) * (p - q)
    return ((square - square % (p + q)) / (p + q)).cast("decimal(38,0)").cast("long")


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _comparison(of_block: int, step: int):
    """Parts of the values of all pairs (smaller source first) of two blocks over a section of words.

    Rows without a word give a source's share of an absent word, its number of words, and that of the language.
    """

    def run(key, table):
        lang, section, a, b = (k.as_py() for k in key)
        heads = table.filter(pc.is_null(table["term"])).sort_by("place")
        rows = table.filter(pc.is_valid(table["term"]))
        place, none = heads["place"].to_numpy(), heads["p"].to_numpy()
        own, total = heads["words"].to_numpy(), int(heads["lang_words"][0].as_py())
        block = (place - 1) // of_block
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        terms = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        by = np.argsort(terms, kind="stable")
        terms, p = terms[by], rows["p"].to_numpy()[by]
        who = np.searchsorted(place, rows["place"].to_numpy()[by])
        value = np.zeros((len(left), len(right)), dtype=np.int64)
        both = np.zeros_like(value)
        cuts = np.searchsorted(terms, np.arange(0, (terms[-1] if len(terms) else -1) + 1 + step, step))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            shares = np.broadcast_to(none, (step, len(place))).copy()
            there = np.zeros((step, len(place)), dtype=bool)
            at = terms[low:high] % step, who[low:high]
            shares[at], there[at] = p[low:high], True
            for i, s in enumerate(left):
                held = np.flatnonzero(there[:, s])
                value[i] += _distances(shares[held, s][:, None], shares[np.ix_(held, right)]).sum(axis=0)
                both[i] += there[np.ix_(held, right)].sum(axis=0)
            for j, s in enumerate(right):
                held = np.flatnonzero(there[:, s])
                alone = _distances(shares[held, s][:, None], none[left][None, :])
                value[:, j] += np.where(there[np.ix_(held, left)], 0, alone).sum(axis=0)
        # Words that neither has: all but those of either, which is known once for all sections.
        absent = both + (total - own[left][:, None] - own[right][None, :] if section == 0 else 0)
        value += absent * _distances(none[left][:, None], none[right][None, :])
        i, j = np.nonzero(place[left][:, None] < place[right][None, :])
        names = heads["source"].combine_chunks()
        arrays = [pa.array([lang] * len(i), pa.string()), names.take(pa.array(left[i])), names.take(pa.array(right[j])), pa.array(value[i, j])]
        return pa.table(arrays, names=["lang", "source", "item", "value"])

    return run


def pair_values(kept: DataFrame, groups: DataFrame, block_size: int = BLOCK, section_rows: int = SECTION_ROWS, step: int = STEP) -> DataFrame:
    """(lang, source, item, value) for each source and each other one of its language.

    ``groups``: lang, source, place (from 1 in its language), p_none, words, lang_words, lang_rows, lang_sources.
    """
    sections = F.floor(F.col("lang_rows") / section_rows).cast("int") + 1
    blocks = F.floor((F.col("lang_sources") - 1) / block_size).cast("int")
    of = groups.select("lang", "source", "place", sections.alias("sections"), blocks.alias("blocks"), "words", "lang_words", "p_none")
    heads = of.withColumn("section", F.explode(F.sequence(F.lit(0), F.col("sections") - 1)))
    heads = heads.select("lang", "section", "place", "blocks", F.lit(None).cast("string").alias("term"), F.col("p_none").alias("p"), "source", "words", "lang_words")
    rows = kept.join(of.select("lang", "source", "place", "sections", "blocks"), ["lang", "source"])
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("words", "long"), ("lang_words", "long"))]
    rows = rows.select("lang", F.pmod(F.hash("term"), F.col("sections")).alias("section"), "place", "blocks", "term", "p", *nothing)
    block = F.floor((F.col("place") - 1) / block_size).cast("int")
    dealt = heads.unionByName(rows).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks"))))
    dealt = dealt.withColumns({"a": F.least("other", block), "b": F.greatest("other", block)}).drop("other", "blocks")
    parts = dealt.groupBy("lang", "section", "a", "b").applyInArrow(_comparison(block_size, step), "lang string, source string, item string, value long")
    half = materialise(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP, **sizes: int
) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by divergence, and the words that set a source apart.

    Words are runs of letters A-Z and of characters beyond ASCII, A-Z in lower case. A language keeps the words in
    at least ``least_docs`` of its rows, equal rows counted each; null lang, source and text are empty. Part ``pair``
    ranks all other sources of a language (value 0 if it keeps no word), part ``term`` the ``top`` words of which the
    source has a greater share than its language. Ties go by UTF-8 order. A language of one source has no pairs, an
    empty table no rows. ``sizes`` are those of ``pair_values``; they do not change the result.
    """
    rows = docs.select(*(F.coalesce(col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = kept_counts(rows, least_docs)
    words = kept.groupBy("lang", "term").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    langs = words.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("lang_words"), F.sum("n").alias("lang_n"), F.sum("rows").alias("lang_rows"))
    held = kept.groupBy(F.col("lang").alias("held_lang"), F.col("source").alias("held_source")).agg(F.count("*").alias("words"), F.sum("n").alias("all_n"))
    placed = running(materialise(rows.select("lang", "source").distinct()), ["lang"], [F.col("source")], {"place": F.lit(1).cast("long")})
    per_lang = placed.groupBy(F.col("lang").alias("size_lang")).agg(F.count("*").alias("lang_sources"))
    groups = placed.join(per_lang, F.col("lang") == F.col("size_lang")).join(langs, F.col("lang") == F.col("of"), "left")
    groups = groups.join(held, (F.col("lang") == F.col("held_lang")) & (F.col("source") == F.col("held_source")), "left")
    groups = groups.select("lang", "source", "place", "lang_sources", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("words", "all_n", "lang_words", "lang_n", "lang_rows")))
    groups = materialise(groups.withColumn("p_none", share(F.lit(0), F.col("all_n"), F.col("lang_words"))))

    of = groups.select("lang", "source", "all_n", "lang_words", "lang_n")
    shares = kept.join(of, ["lang", "source"]).select(
        "lang", "source", "term",
        share(F.col("n"), F.col("all_n"), F.col("lang_words")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("lang_words")).alias("q"),
    )
    shares = materialise(shares)

    def ranked(found: DataFrame, part: str) -> DataFrame:
        best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    apart = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return ranked(pair_values(shares, groups, **sizes), "pair").unionByName(ranked(apart, "term").where(F.col("rank") <= top))
