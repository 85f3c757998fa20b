"""Line deduplication against plain loops."""

import hashlib
from collections import defaultdict

from touchline.llm import line_dedup
from touchline.llm.queries import op5_line_dedup

from .conftest import ODD, frame

SPACE = " \t\n\r\x0b\x0c"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected(rows, least=10):
    """(n_lines, n_dropped, kept) of each row; a null id is one document after all others."""
    rows = [(2**63 - 1 if r[0] is None else r[0], r[1]) for r in rows]
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= least and len(holders[key(x)]) > 1 and min(holders[key(x)]) != d)]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def found(df):
    return sorted((str(r["doc_id"]), r["s"]["n_lines"], r["s"]["n_dropped"], r["s"]["kept_sha256"], r["text"] or "") for r in df.collect())


def wanted(rows):
    return sorted(
        (str(r[0]), n, gone, hashlib.sha256(kept.encode()).hexdigest(), kept) for r, (n, gone, kept) in zip(rows, expected(rows), strict=True)
    )


def test_odd_rows(odd):
    done = line_dedup.dedup_lines(odd, stats="s")
    assert done.columns == [*odd.columns, "s"]
    assert found(done) == wanted(ODD)
    assert done.where("text is null").count() == odd.where("text is null").count()


def test_columns_stay_without_stats_and_stats_replace_a_column(odd):
    assert line_dedup.dedup_lines(odd).schema == odd.schema
    again = line_dedup.dedup_lines(odd, stats="KEY")
    assert "key" not in again.columns and again.where("KEY.n_lines > 0").count() == len(ODD)


def test_empty_table(none):
    assert line_dedup.dedup_lines(none, stats="s").count() == 0


def test_a_full_filter_changes_nothing(spark):
    """With the least filter every line is suspected; the exact step decides all the same."""
    rows = [(i, f"line number {i} alone\nthe common line\n{'é' * 9}\n{'é' * 10}\nshort", "en", "s") for i in range(300)]
    few = line_dedup.dedup_lines(frame(spark, rows), stats="s", filter_bits=2048)
    assert found(few) == wanted(rows)


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = sorted(map(tuple, op5_line_dedup(spark, small).collect()))
    assert got == sorted((d, n, gone, hashlib.sha256(k.encode()).hexdigest()) for (d, _), (n, gone, k) in zip(docs, expected(docs), strict=True))
