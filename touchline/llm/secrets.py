"""Secret scan with corpus-wide ownership frequency.

Candidates are found by fixed patterns, with their places in code points. The hash of every
candidate value is then counted over the whole corpus by distinct repositories and owners. A
value that many owners hold is a copied example; a value that few owners hold and that looks
random is reported as live, with a span of its own.

Only DataFrame functions are used. A scan reads the texts once and passes on candidates, not
texts; counting folds (value, owner, repository) before each shuffle, so that a value that a
third of the corpus holds is a few rows a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialise

from .tables import col

# The kinds in their order, with the pattern, the group that holds the value, and its least length.
# A run that fails the length test is consumed all the same. For the last two kinds a run is found whole or not at
# all, so the length can stand in the pattern.
KINDS = (
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", "(AKIA[A-Z0-9]{12,})", 1, 16),
    ("hex", "([0-9a-f]{32,})", 1, 32),
)
LIVE = "live"
#: A value in this many distinct owners or more is a copied example.
EXAMPLE_OWNERS = 3
#: A live-looking value has digits and letters and at least so many different characters.
LIVE_CHARACTERS = 8


def _found(text: Column, order: int) -> Column:
    """What one kind finds in a text: lengths of the gaps before the matches, of the matches, and the values.

    ``split`` gives what lies between the matches. NULL where there is none.
    """
    _, pattern, group, _ = KINDS[order]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # In two of the kinds the match is the value.
    whole = values if pattern.startswith("(") and not pattern.startswith("(?") else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.struct(
        F.lit(order).alias("kind"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        values.alias("value"),
    )
    return F.when(text.rlike(pattern), found)


def candidates(docs: DataFrame, doc_id: str, text: str, owner: str, repository: str) -> DataFrame:
    """(row, doc_id, owner, repository, found) of every row, written once; null text is empty."""
    body = F.coalesce(col(text), F.lit(""))
    found = F.array_compact(F.array(*(_found(body, k) for k in range(len(KINDS)))))
    names = ((doc_id, "doc_id"), (owner, "owner"), (repository, "repository"))
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), *(col(a).alias(b) for a, b in names), found.alias("found")))


def placed(scanned: DataFrame) -> DataFrame:
    """(row, owner, repository, kind, start, end, value_start, value, value_hash) of each match that is long enough.

    Places are running sums over the matches of a text, so their cost grows with the number of matches.
    """
    kinds = scanned.select("row", "owner", "repository", F.explode("found").alias("of"))
    each = kinds.select("row", "owner", "repository", "of.kind", F.posexplode(F.arrays_zip("of.gap", "of.size", "of.value")).alias("at", "m"))
    # There is one gap more than matches.
    each = each.select("row", "owner", "repository", "kind", "at", "m.*").where(F.col("size").isNotNull())
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    least = F.element_at(F.array(*(F.lit(k[3]) for k in KINDS)), F.col("kind") + 1)
    kept = each.where(F.length("value") >= least)
    # The value ends the match: nothing in the patterns follows the group.
    return kept.select(
        "row", "owner", "repository", "kind", (F.col("end") - F.col("size")).alias("start"), "end",
        (F.col("end") - F.length("value")).alias("value_start"), "value", F.sha2("value", 256).alias("value_hash"),
    )


def ownership(hits: DataFrame) -> DataFrame:
    """(value hash, owners, repositories): how many distinct ones hold each value of (value, owner, repository) rows."""
    pairs = hits.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("held"))
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("held").alias("repositories"))


def live_looking(value: Column) -> Column:
    characters = F.array_size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (characters >= LIVE_CHARACTERS)


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (places of the patterns' matches) and secrets (values with verdicts).

    ``base``: array of (start, kind, end), by start and then kind. ``secrets``: array of (start, end, value,
    owners, repositories, live), one for each place of a value. Null text or text without a match gives empty
    arrays, a null owner counts as one owner more, equal rows are reported each, other columns are not read.
    A value counts once for each owner however often it is repeated.
    """
    scanned = candidates(docs, doc_id, text, owner, repository)
    hits = materialise(placed(scanned))
    held = ownership(hits).withColumnRenamed("value_hash", "held_hash")
    judged = hits.join(held, F.col("value_hash") == F.col("held_hash"))
    judged = judged.withColumn("live", live_looking(F.col("value")) & (F.col("owners") < example_owners))
    span = F.struct("start", "kind", "end")
    secret = F.struct(F.col("value_start").alias("start"), "end", "value", "owners", "repositories", "live")
    # Sets, as two kinds may find one value at one place.
    of_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("base"), F.array_sort(F.collect_set(secret)).alias("secrets"))
    of_row = of_row.withColumnRenamed("row", "judged_row")
    none = {c: F.array().cast(of_row.schema[c].dataType) for c in ("base", "secrets")}
    return scanned.join(of_row, F.col("row") == F.col("judged_row"), "left").select(
        "doc_id", *(F.coalesce(c, empty).alias(c) for c, empty in none.items())
    )


def span_text(spans: Column) -> Column:
    """(start, kind, end) structs as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k[0]) for k in KINDS), F.lit(LIVE))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(each, ",")


def digest(scan: DataFrame) -> DataFrame:
    """Counts and span texts of ``scan_secrets``: base spans and, after them in kind, the live values'."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    live = F.filter("secrets", lambda s: s["live"])
    added = F.transform(live, lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    return scan.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", added))).alias("spans"),
        F.size(live).cast("long").alias("n_live"),
    )
