"""Views that read the given tables as matches, match reports, player lines and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A match number is order key * PAIRS + pair number. A prime, so that remainders of match numbers stay mixed.
PAIRS = 1_000_003


def _side(position: int, column: str) -> Column:
    return F.max(F.when(F.col("place") == position, F.col(column)))


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lines of an order a row: lines 1 and 2, 3 and 4, and so on; the last of an odd number has no partner."""
    columns = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax".split()
    order = "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax".split()
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    numbered = lines.withColumn("rn", F.row_number().over(w) - 1)
    return (
        numbered.withColumns({"pair": F.floor(F.col("rn") / 2), "place": F.col("rn") % 2 + 1})
        .groupBy("l_orderkey", "pair")
        .agg(
            (F.first("l_orderkey") * PAIRS + F.first("pair")).alias("match_no"),
            _side(1, "l_suppkey").alias("hs"),
            _side(2, "l_suppkey").alias("aw"),
            _side(1, "l_quantity").cast("int").alias("hq"),
            _side(2, "l_quantity").cast("int").alias("aq"),
            _side(1, "l_partkey").alias("hp"),
            _side(2, "l_partkey").alias("ap"),
            _side(1, "l_discount").alias("hd"),
            _side(2, "l_discount").alias("ad"),
            _side(1, "l_tax").alias("ht"),
            F.max("place").alias("lines"),
        )
    )


def line_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many order lines stand in a match, in a pair of one supplier, or without a partner."""
    use = F.when(F.col("lines") == 1, "left_over").when(F.col("hs") == F.col("aw"), "same_supplier").otherwise("in_match")
    return line_pairs(spark, sf_dir).groupBy(use.alias("use")).agg(F.sum("lines").cast("long").alias("n_lines"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match per pair of lines of an order whose suppliers, the teams, differ."""
    pairs = line_pairs(spark, sf_dir).where("hs <> aw")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    home = supplier.toDF("hs", "home_name", "home_bal")
    away = supplier.toDF("aw", "away_name", "away_bal")
    # Orders meet their customers first: pairs, dealt by order already, are not dealt by customer as well.
    placed = (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("o_orderkey", "o_orderdate", "r_name")
    )
    joined = pairs.join(placed, F.col("o_orderkey") == F.col("l_orderkey")).join(home, "hs").join(away, "aw")

    def score(q: str) -> Column:
        return F.col(q) % 6

    def half(q: str) -> Column:
        return F.floor(score(q) / 2).cast("int")

    def letter(h: Column, a: Column) -> Column:
        return F.when(h > a, "H").when(h < a, "A").otherwise("D")

    no = F.col("match_no")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    prices = {
        "Home": F.lit(1.2) + F.col("hd") * 20,
        "Draw": F.lit(3.0) + F.col("ht") * 10,
        "Away": F.lit(1.2) + F.col("ad") * 20,
    }
    part_counts = {"Fouls": 15, "Yellow": 5, "Red": 2, "Corners": 12}
    return joined.select(
        "match_no",
        F.col("r_name").alias("Division"),
        F.col("o_orderdate").cast("date").alias("MatchDate"),
        F.concat_ws(":", two(F.floor((no % 1440) / 60)), two(no % 60)).alias("MatchTime"),
        F.col("hs").alias("home_key"),
        F.col("aw").alias("away_key"),
        F.col("home_name").alias("HomeTeam"),
        F.col("away_name").alias("AwayTeam"),
        score("hq").alias("FTHome"),
        score("aq").alias("FTAway"),
        letter(score("hq"), score("aq")).alias("FTResult"),
        half("hq").alias("HTHome"),
        half("aq").alias("HTAway"),
        letter(half("hq"), half("aq")).alias("HTResult"),
        (F.col("home_bal") + F.col("hd") * 100).alias("HomeElo"),
        (F.col("away_bal") + F.col("ad") * 100).alias("AwayElo"),
        (F.col("hp") % 10).alias("Form3Home"),
        (F.col("ap") % 10).alias("Form3Away"),
        (F.col("hp") % 16).alias("Form5Home"),
        (F.col("ap") % 16).alias("Form5Away"),
        *[p.alias(f"Odd{n}") for n, p in prices.items()],
        *[(p + 0.1).alias(f"Max{n}") for n, p in prices.items()],
        (F.col("hq") % 20).alias("HomeShots"),
        (F.col("aq") % 20).alias("AwayShots"),
        (F.col("hq") % 7).alias("HomeTarget"),
        (F.col("aq") % 7).alias("AwayTarget"),
        *[
            (F.col(part) % modulus).alias(f"{side}{name}")
            for name, modulus in part_counts.items()
            for side, part in (("Home", "hp"), ("Away", "ap"))
        ],
    )


def matches_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``matches`` as a raw file would hold them: text, with gaps and odd spellings of numbers."""
    no = F.col("match_no")

    def unless(modulus: int, value: Column, otherwise: str | None = None) -> Column:
        return F.when(no % modulus == 0, F.lit(otherwise)).otherwise(value)

    typed = matches(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in typed.columns if c not in ("match_no", "home_key", "away_key")}
    text["MatchDate"] = unless(101, text["MatchDate"], "soon")
    text["MatchTime"] = F.when(no % 11 == 0, F.lit(None)).when(no % 13 == 0, "late").otherwise(text["MatchTime"])
    goals = F.when(no % 3 == 0, F.concat(text["FTHome"], F.lit(".0"))).otherwise(text["FTHome"])
    text["FTHome"] = unless(97, goals)
    text["HomeElo"] = unless(61, text["HomeElo"], "n/a")
    text["OddHome"] = unless(89, text["OddHome"], "0")
    text["OddDraw"] = unless(53, text["OddDraw"], "")
    text["HTResult"] = unless(41, text["HTResult"])
    return typed.select("match_no", *[v.alias(c) for c, v in text.items()])


def report_name(key: Column, name: Column) -> Column:
    """How the report source spells a team."""
    return (
        F.when(key % 7 == 0, F.concat(F.lit("United "), name))
        .when(key % 3 == 0, F.concat(F.lit("FC "), name))
        .when(key % 3 == 1, F.replace(name, F.lit("Supplier"), F.lit("Süpplier")))
        .otherwise(name)
    )


def feed_date() -> Column:
    """Report dates are up to a day off."""
    return F.date_add("MatchDate", (F.col("match_no") % 3 - 1).cast("int"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_url and title of a report per match."""
    return titled(matches(spark, sf_dir))


def titled(matches: DataFrame) -> DataFrame:
    """match_url and title of a report for each of ``matches``."""
    title = F.concat(
        report_name(F.col("home_key"), F.col("HomeTeam")),
        F.lit(" vs. "),
        report_name(F.col("away_key"), F.col("AwayTeam")),
        F.lit(" Match Report – "),
        F.date_format(feed_date(), "EEEE MMMM d, yyyy"),
    )
    return matches.select(
        F.concat(F.lit("/en/matches/"), F.col("match_no").cast("string")).alias("match_url"),
        title.alias("match_title"),
    )


def report_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select(report_name(F.col("s_suppkey"), F.col("s_name")).alias("team_name"))


def match_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("team_name"))


def manual_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-made pairs: the names no rule finds, and a few that overrule one.

    Some partners are spelt in capitals with a blank behind.
    """
    key, name = F.col("s_suppkey"), F.col("s_name")
    partner = F.when(key % 5 == 0, F.concat(F.upper(name), F.lit(" "))).otherwise(name)
    return (
        table(spark, sf_dir, "supplier")
        .where((key % 7 == 0) | (key % 21 == 3))
        .select(report_name(key, name).alias("fbref_team"), partner.alias(" cfdm_team "))
    )


# Leading fields of the two layouts the lines are written in.
OLD_WIDTH, NEW_WIDTH = 23, 31


def player_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of ragged CSV text per order line."""
    year = F.year("l_shipdate") + 20
    new = year >= 2018
    columns = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_returnflag l_linestatus l_shipdate".split()
    # The table is one row group; its text is made, and later read, by many tasks.
    lines = spread(table(spark, sf_dir, "lineitem").select(*columns))
    part, number = F.col("l_partkey"), F.col("l_linenumber")

    def stat(i: int) -> Column:
        whole = ((F.col("l_quantity").cast("int") * i + part) % 40).cast("string")
        if i in (19, 20, 21):
            return F.when(new, F.concat(whole, F.lit("."), number.cast("string"))).otherwise(whole)
        if i == 26:
            return F.concat(whole, F.lit("%"))
        if i % 4 == 0:
            return F.concat(whole, F.lit(".0"))
        return whole

    def lead(i: int) -> Column:
        if i == 1:
            player = F.concat(F.lit('"Player, '), part.cast("string"), F.lit('"'))
            return F.when(number == 7, F.lit("16 Players")).otherwise(player)
        if i == 2:
            return F.lit('"say ""ten"""')
        if i < 6:
            return F.concat(F.lit(f"f{i}-"), (part % 11).cast("string"))
        return F.when((part + i) % 9 == 0, F.lit("")).otherwise(stat(i))

    kind = F.when(F.col("l_returnflag") == "A", "keeper").when(F.col("l_returnflag") == "R", "Summary")
    slug = F.concat(F.lit("L"), (F.col("l_suppkey") % 5).cast("string"))
    order = F.col("l_orderkey")
    title = F.concat(
        F.lit('"Home '),
        (order % 100).cast("string"),
        F.lit(" vs. Away "),
        (order % 97).cast("string"),
        F.lit(' Match Report – Monday May 7, 2018"'),
    )
    tail = [
        F.concat(F.lit("/en/matches/"), order.cast("string")),
        slug,
        F.concat_ws("-", (year - 1).cast("string"), year.cast("string")),
        kind.otherwise("summary"),
        F.col("l_linestatus"),
        title,
        slug,
        year.cast("string"),
    ]

    def line(width: int) -> Column:
        return F.concat_ws(",", *[lead(i) for i in range(1, width + 1)], *tail)

    text = (
        F.when(number == 6, F.lit("short,row"))
        .when(new & (part % 10 == 0), line(NEW_WIDTH - 2))
        .when(new, line(NEW_WIDTH))
        .otherwise(line(OLD_WIDTH))
    )
    return lines.select(text.alias("value"))


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An HTML report per match: heading, links, and two stat tables, one of them in a comment."""
    no = F.col("match_no").cast("string")

    def cells(tag: str, *values: Column) -> Column:
        inner = [F.concat(F.lit(f'<{tag} class="x">'), v, F.lit(f"</{tag}>")) for v in values]
        return F.concat(F.lit("<tr>"), *inner, F.lit("</tr>"))

    def stat_table(key: str, kind: str, *lines: Column) -> Column:
        head = F.concat(
            F.lit("<thead>"),
            cells("th", F.lit("Group")),
            cells("th", F.lit("Player"), F.lit("Min"), F.lit("Gls")),
            F.lit("</thead>"),
        )
        opening = F.concat(F.lit('<table class="stats" id="stats_team-'), F.col(key).cast("string"))
        return F.concat(opening, F.lit(f'_{kind}">'), head, F.lit("<tbody>"), *lines, F.lit("</tbody></table>"))

    home = stat_table(
        "home_key",
        "summary",
        cells("td", F.concat(F.lit("<a href='/en/players/1'>A &amp; B "), no, F.lit("</a>")), F.lit("90"), F.lit("")),
        cells("td", F.lit("2 <b>Players</b>"), F.lit(" 180 "), F.col("FTHome").cast("string")),
        F.lit('<tr><td colspan="2">a<br>b <table><tr><td>in</td></tr></table></td><td>&nbsp;7</td></tr>'),
    )
    away = stat_table("away_key", "keeper", cells("td", F.lit("K&eacute;v <i>&#x1F600;</i>&#33;"), F.lit("90"), F.col("FTAway").cast("string")))
    other = F.lit('<table id="results"><tr><td>no stats</td></tr></table>')
    links = F.concat(
        F.lit('<td data-stat="score"><a class="s" href="/en/matches/'),
        no,
        F.lit('">again</a></td><a href="/en/matches/'),
        (F.col("match_no") + 1).cast("string"),
        F.lit('">next</a><a href="/en/matches/'),
        no,
        F.lit('">same</a><a href="/about">about</a>'),
    )
    html = F.concat(
        F.lit("<html><body><h1 class='t'> <b>"),
        F.col("HomeTeam"),
        F.lit("</b> vs. "),
        F.col("AwayTeam"),
        F.lit("</h1>"),
        links,
        other,
        home,
        F.lit("<!-- "),
        away,
        F.lit(" --></body></html>"),
    )
    return spread(matches(spark, sf_dir)).select(F.concat(F.lit("page/"), no).alias("url"), html.alias("html"))


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with outcome probabilities and both spellings of the prices."""
    no = F.col("match_no")
    h = 1.0 + F.col("hp_").cast("double")
    d = 1.0 + F.col("dp_").cast("double")
    a = 1.0 + F.col("ap_").cast("double")
    total = h + d + a
    base = matches(spark, sf_dir).withColumns(
        {"hp_": F.col("HomeShots") % 9, "dp_": F.col("HomeFouls") % 4, "ap_": F.col("AwayShots") % 9}
    )
    return base.select(
        "match_no",
        "MatchDate",
        F.col("FTResult").alias("y_outcome"),
        (h / total).alias("p_H"),
        (d / total).alias("p_D"),
        (a / total).alias("p_A"),
        F.when(no % 29 == 0, F.lit(None)).otherwise(F.col("OddHome")).alias("odd_H"),
        F.when(no % 31 == 0, F.lit(None)).otherwise(F.col("OddDraw")).alias("odd_D"),
        F.when(no % 37 == 0, F.lit(1.0)).otherwise(F.col("OddAway")).alias("odd_A"),
    )
