"""SQL that gives the same results as the registered queries, written on its own for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 as {name}"


def rs(names: list[str], prefix: str = "") -> str:
    return ", ".join(r(prefix + n, n) for n in names)


# ---- shared views as common table expressions

_SCORES = {"Fouls": 15, "Yellow": 5, "Red": 2, "Corners": 12}
_COUNTS = ", ".join(
    f"{part} % {mod} as {side}{name}" for name, mod in _SCORES.items() for side, part in (("Home", "hp"), ("Away", "ap"))
)

M = f"""
ln as (
  select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax) as rn from lineitem),
pr as (
  select h.l_orderkey * 1000003 + (h.rn - 1) // 2 as match_no, h.l_orderkey as order_key, h.l_suppkey as hs, a.l_suppkey as aw,
         cast(h.l_quantity as int) as hq, cast(a.l_quantity as int) as aq, h.l_partkey as hp, a.l_partkey as ap,
         h.l_discount as hd, a.l_discount as ad, h.l_tax as ht
  from ln h join ln a on a.l_orderkey = h.l_orderkey and h.rn % 2 = 1 and a.rn = h.rn + 1
  where h.l_suppkey <> a.l_suppkey),
m as (
  select match_no, r_name as Division, cast(o_orderdate as date) as MatchDate,
    concat(lpad(cast(cast(floor((match_no % 1440) / 60) as int) as varchar), 2, '0'), ':',
           lpad(cast(match_no % 60 as varchar), 2, '0')) as MatchTime,
    hs as home_key, aw as away_key, sh.s_name as HomeTeam, sa.s_name as AwayTeam,
    hq % 6 as FTHome, aq % 6 as FTAway,
    case when hq % 6 > aq % 6 then 'H' when hq % 6 < aq % 6 then 'A' else 'D' end as FTResult,
    (hq % 6) // 2 as HTHome, (aq % 6) // 2 as HTAway,
    case when (hq % 6) // 2 > (aq % 6) // 2 then 'H' when (hq % 6) // 2 < (aq % 6) // 2 then 'A' else 'D' end as HTResult,
    sh.s_acctbal + hd * 100 as HomeElo, sa.s_acctbal + ad * 100 as AwayElo,
    hp % 10 as Form3Home, ap % 10 as Form3Away, hp % 16 as Form5Home, ap % 16 as Form5Away,
    cast(1.2 as double) + hd * 20 as OddHome, cast(3.0 as double) + ht * 10 as OddDraw,
    cast(1.2 as double) + ad * 20 as OddAway,
    cast(1.2 as double) + hd * 20 + cast(0.1 as double) as MaxHome,
    cast(3.0 as double) + ht * 10 + cast(0.1 as double) as MaxDraw,
    cast(1.2 as double) + ad * 20 + cast(0.1 as double) as MaxAway,
    hq % 20 as HomeShots, aq % 20 as AwayShots, hq % 7 as HomeTarget, aq % 7 as AwayTarget,
    {_COUNTS}
  from pr join orders on o_orderkey = order_key join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
  join supplier sh on sh.s_suppkey = hs join supplier sa on sa.s_suppkey = aw)"""

ORACLE["line_usage"] = f"""with {M.split("m as (")[0].rstrip().rstrip(",")},
al as (select h.l_suppkey as hs, a.l_suppkey as aw, a.l_orderkey as other from ln h
  left join ln a on a.l_orderkey = h.l_orderkey and a.rn = h.rn + 1 where h.rn % 2 = 1)
select case when other is null then 'left_over' when hs = aw then 'same_supplier' else 'in_match' end as use,
  cast(sum(case when other is null then 1 else 2 end) as bigint) as n_lines from al group by 1"""

_PLAIN = (
    "Division HomeTeam AwayTeam FTResult FTAway HTHome HTAway AwayElo Form3Home Form3Away Form5Home Form5Away "
    "OddAway MaxHome MaxDraw MaxAway HomeShots AwayShots HomeTarget AwayTarget HomeFouls AwayFouls "
    "HomeYellow AwayYellow HomeRed AwayRed HomeCorners AwayCorners"
).split()

# The text table: every column a string, with gaps.
T = (
    M
    + """,
t as (
  select match_no,
    case when match_no % 101 = 0 then 'soon' else cast(MatchDate as varchar) end as MatchDate,
    case when match_no % 11 = 0 then null when match_no % 13 = 0 then 'late' else MatchTime end as MatchTime,
    case when match_no % 97 = 0 then null when match_no % 3 = 0 then cast(FTHome as varchar) || '.0'
         else cast(FTHome as varchar) end as FTHome,
    case when match_no % 61 = 0 then 'n/a' else cast(HomeElo as varchar) end as HomeElo,
    case when match_no % 89 = 0 then '0' else cast(OddHome as varchar) end as OddHome,
    case when match_no % 53 = 0 then '' else cast(OddDraw as varchar) end as OddDraw,
    case when match_no % 41 = 0 then null else HTResult end as HTResult,
    """
    + ", ".join(f"cast({c} as varchar) as {c}" for c in _PLAIN)
    + " from m)"
)


def _d(c: str) -> str:
    return f"try_cast({c} as double)"


def _sides(home: str, away: str, diff: str) -> str:
    return f"{_d(home)} as {home}, {_d(away)} as {away}, {_d(home)} - {_d(away)} as {diff}"


# Base features, unrounded.
FB = (
    T
    + f""",
fb0 as (
  select match_no, Division, MatchDate, coalesce(MatchTime, '') as MatchTime, HomeTeam, AwayTeam,
    try_cast(MatchDate as date) as match_date,
    concat_ws('|', Division, MatchDate, HomeTeam, AwayTeam) as cfmd_match_id,
    try_cast(FTHome as integer) as FTHome, try_cast(FTAway as integer) as FTAway,
    try_cast(HTHome as integer) as HTHome, try_cast(HTAway as integer) as HTAway,
    coalesce(HTResult, '') as HTResult,
    {_sides("HomeElo", "AwayElo", "elo_diff")},
    {_sides("Form3Home", "Form3Away", "form3_diff")}, {_sides("Form5Home", "Form5Away", "form5_diff")},
    {_d("OddHome")} as OddHome, {_d("OddDraw")} as OddDraw, {_d("OddAway")} as OddAway,
    1.0 / nullif({_d("OddHome")}, 0) as qh, 1.0 / nullif({_d("OddDraw")}, 0) as qd,
    1.0 / nullif({_d("OddAway")}, 0) as qa,
    {_d("MaxHome")} as MaxHome, {_d("MaxDraw")} as MaxDraw, {_d("MaxAway")} as MaxAway,
    {_sides("HomeShots", "AwayShots", "shots_diff")},
    {_sides("HomeTarget", "AwayTarget", "shots_on_target_diff")},
    {_sides("HomeFouls", "AwayFouls", "fouls_diff")}, {_sides("HomeYellow", "AwayYellow", "yellow_diff")},
    {_sides("HomeRed", "AwayRed", "red_diff")}, {_sides("HomeCorners", "AwayCorners", "corners_diff")}
  from t),
fb1 as (
  select *, case when FTHome > FTAway then 'H' when FTHome < FTAway then 'A' else 'D' end as y_outcome,
    case when FTHome > FTAway then 1 else 0 end as y_home_win,
    HomeElo / nullif(HomeElo + AwayElo, 0) as elo_ratio,
    qh + qd + qa as qsum, ln(MaxAway) - ln(MaxHome) as log_odds_away_vs_home,
    HomeTarget / nullif(HomeShots, 0) as shot_acc_home, AwayTarget / nullif(AwayShots, 0) as shot_acc_away,
    (corners_diff + shots_diff) / 2.0 as dominance_index,
    Form5Home - Form3Home as form_momentum_home, Form5Away - Form3Away as form_momentum_away
  from fb0),
fb as (
  select *, qh / nullif(qsum, 0) as p_home, qd / nullif(qsum, 0) as p_draw, qa / nullif(qsum, 0) as p_away,
    qsum as overround, shot_acc_home - shot_acc_away as shot_acc_diff
  from fb1)"""
)

FB_TEXT = "match_no Division MatchDate MatchTime HomeTeam AwayTeam match_date cfmd_match_id".split()
FB_LABEL = "FTHome FTAway y_outcome y_home_win HTHome HTAway HTResult".split()
FB_NUMBER = (
    "HomeElo AwayElo elo_diff elo_ratio Form3Home Form3Away form3_diff Form5Home Form5Away form5_diff "
    "OddHome OddDraw OddAway qh qd qa qsum p_home p_draw p_away overround MaxHome MaxDraw MaxAway "
    "log_odds_away_vs_home HomeShots AwayShots shots_diff HomeTarget AwayTarget shots_on_target_diff "
    "shot_acc_home shot_acc_away shot_acc_diff HomeFouls AwayFouls fouls_diff HomeYellow AwayYellow yellow_diff "
    "HomeRed AwayRed red_diff HomeCorners AwayCorners corners_diff dominance_index "
    "form_momentum_home form_momentum_away"
).split()

ORACLE["features_base"] = f"with {FB} select {', '.join(FB_TEXT + FB_LABEL)}, {rs(FB_NUMBER)} from fb"
ORACLE["odds_implied"] = (
    f"with {FB} select match_no, "
    f"{rs('OddHome OddDraw OddAway qh qd qa qsum p_home p_draw p_away overround'.split())} from fb"
)
ORACLE["label_summary"] = f"""with {FB} select count(*) as rows,
  count(*) filter (where FTHome is not null and FTAway is not null) as rows_with_label from fb"""

# ---- history

TV = (
    FB
    + """,
b as (
  select *, coalesce(cast(epoch(try_strptime(MatchTime, '%H:%M')) as bigint) % 86400, 0) as sec from fb),
b2 as (select *, cast(case when sec < 0 then sec + 86400 else sec end as integer) as match_time_sort from b),
tv as (
  select match_no, 'home' as side, match_date, match_time_sort, Division, HomeTeam as team, AwayTeam as opponent,
    FTHome as goals_for, FTAway as goals_against, HomeElo as elo from b2
  union all
  select match_no, 'away', match_date, match_time_sort, Division, AwayTeam, HomeTeam, FTAway, FTHome, AwayElo from b2),
tm as (
  select *, case when goals_for > goals_against then 3 when goals_for = goals_against then 1 else 0 end as points,
    case when goals_for > goals_against then 1 else 0 end as win,
    case when goals_for = goals_against then 1 else 0 end as draw,
    case when goals_for < goals_against then 1 else 0 end as loss
  from tv)"""
)
_ORDER = (
    "partition by team order by match_date nulls last, match_time_sort, Division nulls last, "
    "opponent nulls last, match_no, side"
)
ROLL = (
    TV
    + f""",
lg as (
  select *, elo - lag(elo) over (w) as elo_change, match_date - lag(match_date) over (w) as rest
  from tm window w as ({_ORDER})),
ro as (
  select *, cast(rest as integer) as rest_days,
    cast(sum(goals_for) over w3 as bigint) as gf_last3, cast(sum(goals_against) over w3 as bigint) as ga_last3,
    cast(sum(points) over w3 as bigint) as pts_last3, avg(elo_change) over w3 as elo_trend3,
    cast(sum(goals_for) over w5 as bigint) as gf_last5, cast(sum(goals_against) over w5 as bigint) as ga_last5,
    cast(sum(points) over w5 as bigint) as pts_last5, avg(elo_change) over w5 as elo_trend5,
    cast(sum(points) over w3 - sum(points) over w6 as bigint) as form_momentum
  from lg window w3 as ({_ORDER} rows between 3 preceding and 1 preceding),
    w5 as ({_ORDER} rows between 5 preceding and 1 preceding),
    w6 as ({_ORDER} rows between 6 preceding and 4 preceding))"""
)
_ROLLED = "gf_last3 ga_last3 pts_last3 elo_trend3 gf_last5 ga_last5 pts_last5 elo_trend5".split()


def _history(side: str, alias: str) -> str:
    names = [*_ROLLED, "rest_days", "form_momentum"]
    return ", ".join(
        r(f"{alias}.{n}", f"{side}_{n}") if n.startswith("elo") else f"{alias}.{n} as {side}_{n}" for n in names
    )


ORACLE["team_view"] = f"""with {TV} select match_no, side, match_date, match_time_sort, Division, team, opponent,
  goals_for, goals_against, {r("elo", "elo")}, points, win, draw, loss from tm"""
ORACLE["elo_change"] = f"with {ROLL} select match_no, side, {r('elo_change', 'elo_change')} from ro"
ORACLE["rest_days"] = f"with {ROLL} select match_no, side, rest_days from ro"
ORACLE["rolling_form"] = (
    f"with {ROLL} select match_no, side, "
    + ", ".join(r(n, n) if n.startswith("elo") else n for n in _ROLLED)
    + " from ro"
)
ORACLE["form_momentum"] = f"with {ROLL} select match_no, side, form_momentum from ro"
_MATCH = "b2.match_no, b2.MatchDate, b2.MatchTime, b2.Division, b2.HomeTeam, b2.AwayTeam, b2.FTHome, b2.FTAway"
ORACLE["lagged_features"] = f"""with {ROLL} select {_MATCH}, {rs(["HomeElo", "AwayElo"], "b2.")}, b2.y_outcome,
  {_history("home", "h")}, {_history("away", "a")}
from b2 join ro h on h.match_no = b2.match_no and h.side = 'home'
join ro a on a.match_no = b2.match_no and a.side = 'away'"""
ORACLE["stream_history"] = f"""with {ROLL} select b2.match_no, {_history("home", "h")}, {_history("away", "a")}
from b2 join ro h on h.match_no = b2.match_no and h.side = 'home' join ro a on a.match_no = b2.match_no and a.side = 'away'"""
ORACLE["lagged_three_key"] = f"""with {ROLL} select {_MATCH}, {rs(["HomeElo", "AwayElo"], "b2.")},
  {_history("home", "h")}, {_history("away", "a")}
from b2
left join ro h on h.team = b2.HomeTeam and h.match_date = b2.match_date and h.match_time_sort = b2.match_time_sort
left join ro a on a.team = b2.AwayTeam and a.match_date = b2.match_date and a.match_time_sort = b2.match_time_sort"""

_STREAK_OUT = """match_no, side, match_date, match_time_sort, Division, team, opponent, goals_for, goals_against,
  case when goals_for > goals_against then 'W' when goals_for = goals_against then 'D' else 'L' end as result"""
_CONDITION = {"win": "win = 1", "losing": "loss = 1", "nowin": "win = 0", "noloss": "loss = 0"}
_RUN = f"{_ORDER} rows between unbounded preceding and current row"
_GROUPS = ", ".join(
    f"sum(case when {c} then 0 else 1 end) over ({_RUN}) as g_{k}" for k, c in _CONDITION.items()
)


def _in_group(kind: str) -> str:
    return _ORDER.replace("partition by team", f"partition by team, g_{kind}")


def _backwards(kind: str) -> str:
    # Written for the forward order read from the end: rows left in the group, this one included.
    return f"count(*) over ({_in_group(kind)} rows between current row and unbounded following)"


STREAK = TV + f", g as (select *, {_GROUPS} from tm)"
_DOCUMENTED = ", ".join(
    f"sum(case when {c} then 1 else 0 end) over ({_in_group(k)} rows between unbounded preceding and current row) as s_{k}"
    for k, c in _CONDITION.items()
)
_WRITTEN = ", ".join(
    [f"case when {_CONDITION[k]} then row_number() over ({_in_group(k)}) else 0 end as s_{k}" for k in ("win", "losing")]
    + [f"case when {_CONDITION[k]} then {_backwards(k)} else 0 end as s_{k}" for k in ("nowin", "noloss")]
)
_IN = ", ".join(
    f"cast(coalesce(lag(s_{k}) over ({_ORDER}), 0) as bigint) as {k}_streak_in" for k in _CONDITION
)
ORACLE["streaks"] = f"with {STREAK}, s as (select *, {_DOCUMENTED} from g) select {_STREAK_OUT}, {_IN} from s"
ORACLE["streaks_as_written"] = f"with {STREAK}, s as (select *, {_WRITTEN} from g) select {_STREAK_OUT}, {_IN} from s"
ORACLE["latest_matches"] = f"""with {STREAK}, s as (select *, {_DOCUMENTED} from g),
o as (select {_STREAK_OUT}, {_IN} from s)
select * from o qualify row_number() over (partition by team order by match_date desc nulls last,
  match_time_sort desc, Division desc, opponent desc, match_no desc) <= 20"""

_HOT = ROLL.replace("b2 as (select *,", "b2 as (select * replace (case when match_no % 3 = 0 then 'HOT' else HomeTeam end as HomeTeam),")
ORACLE["rolling_hot_team"] = f"""with {_HOT}, g as (select *, {_GROUPS} from tm), s as (select *, {_DOCUMENTED} from g),
o as (select match_no, side, {_IN} from s)
select ro.match_no, ro.side, team, gf_last5, pts_last5, {r("elo_trend5", "elo_trend5")}, rest_days, form_momentum, win_streak_in, noloss_streak_in
from ro join o on o.match_no = ro.match_no and o.side = ro.side"""

# ---- derived columns of an entry form

_DERIVED = "elo_diff elo_ratio form3_diff form5_diff qh qd qa qsum p_home p_draw p_away overround".split()
_BLANKED = [*_DERIVED, "log_odds_away_vs_home", "shot_acc_diff"]
_GIVEN = (
    "HomeElo AwayElo Form3Home Form3Away Form5Home Form5Away OddHome OddDraw OddAway MaxHome MaxDraw MaxAway "
    "shot_acc_home shot_acc_away"
).split()
FORM = (
    FB
    + ", ef as (select match_no, "
    + ", ".join(_GIVEN)
    + ", "
    + ", ".join(
        f"case when (match_no + {i}) % 3 = 0 then 0.0 when (match_no + {i}) % 3 = 1 then null else {c} end as {c}"
        for i, c in enumerate(_BLANKED)
    )
    + " from fb)"
)


def _fill(c: str, expr: str) -> str:
    return f"case when {c} is null or {c} = 0 then {expr} else {c} end as {c}"


def _form(ratio: str, log_odds: str) -> str:
    kept = ", ".join(_GIVEN)
    return f"""with {FORM},
f1 as (select match_no, {kept},
  {_fill("elo_diff", "HomeElo - AwayElo")}, {_fill("elo_ratio", ratio)},
  {_fill("form3_diff", "Form3Home - Form3Away")}, {_fill("form5_diff", "Form5Home - Form5Away")},
  {_fill("shot_acc_diff", "shot_acc_home - shot_acc_away")},
  {_fill("qh", "1.0 / nullif(OddHome, 0)")}, {_fill("qd", "1.0 / nullif(OddDraw, 0)")},
  {_fill("qa", "1.0 / nullif(OddAway, 0)")}, {_fill("log_odds_away_vs_home", log_odds)},
  qsum, p_home, p_draw, p_away, overround from ef),
f2 as (select * exclude (qsum), {_fill("qsum", "case when coalesce(qh, qd, qa) is not null then coalesce(qh, 0) + coalesce(qd, 0) + coalesce(qa, 0) end")} from f1),
f3 as (select * exclude (p_home, p_draw, p_away, overround), {_fill("p_home", "qh / nullif(qsum, 0)")},
  {_fill("p_draw", "qd / nullif(qsum, 0)")}, {_fill("p_away", "qa / nullif(qsum, 0)")},
  {_fill("overround", "qsum")} from f2)
select match_no, {rs(_GIVEN + _BLANKED)} from f3"""


ORACLE["fill_derived"] = _form("HomeElo / nullif(HomeElo + AwayElo, 0)", "ln(MaxAway / MaxHome)")
ORACLE["fill_derived_form"] = _form(
    "HomeElo / nullif(AwayElo, 0)", "case when OddAway > 0 and OddHome > 0 then ln(OddAway / OddHome) end"
)

# ---- player lines, straight from the order lines

_WIDTH = "case when year(l_shipdate) + 20 >= 2018 then case when l_partkey % 10 = 0 then 29 else 31 end else 23 end"


def _stat(i: int) -> str:
    whole = f"cast((cast(l_quantity as int) * {i} + l_partkey) % 40 as varchar)"
    value = whole
    if i in (19, 20, 21):
        value = f"case when y >= 2018 then {whole} || '.' || cast(l_linenumber as varchar) else {whole} end"
    elif i == 26:
        value = f"{whole} || '%'"
    elif i % 4 == 0:
        value = f"{whole} || '.0'"
    return f"case when {i} > w then null when (l_partkey + {i}) % 9 = 0 then '' else {value} end as c{i:02d}"


_LEAD = ", ".join(
    [
        "case when l_linenumber = 7 then '16 Players' else 'Player, ' || cast(l_partkey as varchar) end as c01",
        """'say "ten"' as c02""",
        *[f"'f{i}-' || cast(l_partkey % 11 as varchar) as c{i:02d}" for i in (3, 4, 5)],
        *[_stat(i) for i in range(6, 32)],
    ]
)
PL = f"""
l0 as (select *, year(l_shipdate) + 20 as y, {_WIDTH} as w from lineitem where l_linenumber <> 6),
pl as (select {_LEAD}, w + 8 as width,
  concat(case when l_returnflag = 'A' then 'keeper' else 'summary' end, '_', case when y >= 2018 then 'neu' else 'alt' end) as tag,
  '/en/matches/' || cast(l_orderkey as varchar) as match_url,
  'L' || cast(l_suppkey % 5 as varchar) as league,
  cast(y - 1 as varchar) || '-' || cast(y as varchar) as season,
  case when l_returnflag = 'A' then 'keeper' when l_returnflag = 'R' then 'Summary' else 'summary' end as table_type,
  l_linestatus as team_hint,
  'Home ' || cast(l_orderkey % 100 as varchar) || ' vs. Away ' || cast(l_orderkey % 97 as varchar)
    || ' Match Report – Monday May 7, 2018' as match_title,
  'L' || cast(l_suppkey % 5 as varchar) as league_slug, cast(y as varchar) as season_end
  from l0)"""
_TAIL = "match_url, league, season, table_type, team_hint, match_title, league_slug, season_end"

ORACLE["ragged_split"] = f"""with {PL} select tag, cast(width as bigint) as width, c01, c02, c06,
  case when width = 39 then c31 end as c31, {_TAIL} from pl"""
_SIZED = """sized as (
  select case when l_linenumber = 6 then null else year(l_shipdate) + 20 end as season_end,
    case when l_linenumber = 6 then 2
         when year(l_shipdate) + 20 < 2018 then 31 when l_partkey % 10 = 0 then 37 else 39 end as width
  from lineitem)"""
ORACLE["width_profile"] = f"""with {_SIZED} select cast(season_end as integer) as season_end,
  cast(width as integer) as width, count(*) as n_rows from sized group by 1, 2"""
ORACLE["top_widths"] = f"""with {_SIZED} select cast(width as integer) as width, count(*) as n_rows
  from sized group by 1 order by 2 desc, 1 limit 5"""

_OLD = dict(zip("fls fld off crs tklw intr og pkwon pkcon".split(), range(15, 24)))
_NEW = dict(
    zip(
        "touches tkl intr blocks xg npxg xag sca gca pass_cmp pass_att pass_cmp_pct pass_prg carries carries_prg "
        "take_ons_att take_ons_succ".split(),
        range(15, 32),
    )
)
_COMMON = dict(zip("min gls ast pk pkatt sh sot crdy crdr".split(), range(6, 15)))
_ALL = [*_COMMON, *"fls fld off crs tklw tkl intr blocks og pkwon pkcon touches xg npxg xag sca gca".split(),
        *"pass_cmp pass_att pass_cmp_pct pass_prg carries carries_prg take_ons_att take_ons_succ".split()]
_DECIMAL = ("xg", "npxg", "xag", "pass_cmp_pct")


def _harmonised(places: dict[str, int], era: str) -> str:
    out = []
    for n in _ALL:
        kind = "double" if n in _DECIMAL else "integer"
        i = {**_COMMON, **places}.get(n)
        text = f"replace(c{i:02d}, '%', '')" if n == "pass_cmp_pct" and i else f"c{i:02d}" if i else "null"
        out.append(f"try_cast({text} as {kind}) as {n}")
    return f"""select c01 as player, c03 as nation, c04 as pos, c05 as age, {", ".join(out)}, {_TAIL} from pl
      where tag = 'summary_{era}' and lower(c01) not like '%players%'"""


PU = PL + f", pu as ({_harmonised(_OLD, 'alt')} union all {_harmonised(_NEW, 'neu')})"
ORACLE["harmonise_players"] = (
    f"with {PU} select player, nation, pos, age, "
    + ", ".join(r(n, n) if n in _DECIMAL else n for n in _ALL)
    + f", {_TAIL} from pu"
)
ORACLE["harmonise_two_tables"] = ORACLE["harmonise_players"]
_SUMS = {n: f"{n}_sum" for n in _ALL if n not in ("og", "pkwon", "pkcon", "touches", "pass_cmp_pct")} | {
    "crdy": "yel_sum",
    "crdr": "red_sum",
    "intr": "int_sum",
    "blocks": "blk_sum",
    "take_ons_att": "take_att_sum",
    "take_ons_succ": "take_succ_sum",
}
_TEAM = "match_url, league_slug, season_end, team_hint"
TA = PU + f""", ta as (select {_TEAM}, {", ".join(f"sum({n}) as {s}" for n, s in _SUMS.items())},
  avg(pass_cmp_pct) as pass_cmp_pct_avg from pu group by all)"""
_P90 = "gls ast sh sot xg sca pass_prg".split()


def _p90(n: str) -> str:
    return r(f"case when min_sum > 0 then {n}_sum * 90.0 / min_sum end", f"{n}_p90")


ORACLE["team_aggregate"] = f"""with {TA} select {_TEAM},
  {", ".join(r(s, s) if n in _DECIMAL else f"cast({s} as bigint) as {s}" for n, s in _SUMS.items())},
  {r("pass_cmp_pct_avg", "pass_cmp_pct_avg")}, {", ".join(_p90(n) for n in _P90)},
  {r("case when take_att_sum > 0 then take_succ_sum * 1.0 / take_att_sum end", "take_on_succ_rate")} from ta"""
ORACLE["enrich_titles"] = f"""with {TA}, ti as (select match_url, min(match_title) as match_title from pu group by 1)
select match_url, league_slug, season_end, team_hint, cast(min_sum as bigint) as min_sum, {_p90("gls")}, match_title,
  split_part(match_title, ' vs. ', 1) as home_team_fb,
  split_part(split_part(match_title, ' vs. ', 2), ' Match Report', 1) as away_team_fb,
  'May 7, 2018' as match_date_fb
from ta left join ti using (match_url)"""

# ---- pages

_CLEAN = r"regexp_replace(regexp_replace(h, '\s*<[^>]*>\s*', '', 'g'), '^\s+|\s+$', '', 'g')"
ORACLE["page_titles"] = rf"""with p as (select url, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) as h,
  regexp_matches(html, '(?is)<h1[^>]*>.*?</h1>') as found from pages)
select url, case when found then replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
  {_CLEAN}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', ' '), '&middot;', '·'),
  '&copy;', '©'), '&ndash;', '–'), '&mdash;', '—'), '&amp;', '&') end as match_title from p"""
ORACLE["page_links"] = r"""with p as (select url, regexp_extract_all(html, '<a\s[^>]*?href="(/[^"]*)"', 1) as hs from pages),
e as (select url, unnest(hs) as h, generate_subscripts(hs, 1) as i from p),
f as (select url, h, min(i) as first_i from e group by 1, 2)
select url, cast(row_number() over (partition by url order by first_i) - 1 as integer) as position,
  'https://example.org' || h as link from f"""
ORACLE["report_titles"] = f"""with {M} select 'page/' || cast(match_no as varchar) as url,
  HomeTeam || 'vs. ' || AwayTeam as match_title from m"""
_LINK = "'https://fbref.com/en/matches/' || cast({} as varchar)"
ORACLE["report_links"] = f"""with {M}
select 'page/' || cast(match_no as varchar) as url, 0 as position, {_LINK.format("match_no")} as link from m
union all select 'page/' || cast(match_no as varchar), 1, {_LINK.format("match_no + 1")} from m"""
ORACLE["score_links"] = f"""with {M} select 'page/' || cast(match_no as varchar) as url, 0 as position,
  {_LINK.format("match_no")} as link from m"""
ORACLE["page_tables"] = f"""with {M}, p as (select *, 'page/' || cast(match_no as varchar) as url,
  HomeTeam || 'vs. ' || AwayTeam as match_title from m)
select url, match_title, 1 as table_no, 'team-' || cast(home_key as varchar) as team_hint, 'summary' as table_type,
  0 as row_no, 'Player|Min|Gls' as header, 'A & B ' || cast(match_no as varchar) || '|90|' as cells from p
union all
select url, match_title, 1, 'team-' || cast(home_key as varchar), 'summary', 1, 'Player|Min|Gls',
  '2 Players|180|' || cast(FTHome as varchar) from p
union all
select url, match_title, 1, 'team-' || cast(home_key as varchar), 'summary', 2, 'Player|Min|Gls', 'a b in|a b in|7' from p
union all
select url, match_title, 3, 'team-' || cast(away_key as varchar), 'keeper', 0, 'Player|Min|Gls',
  'Kév 😀!|90|' || cast(FTAway as varchar) from p"""

SG = """sg as (
  select n_name as league_slug, n_nationkey as competition, cast(y as integer) as season_end,
    cast(y - 1 as varchar) || '-' || cast(y as varchar) as season from nation, range({}, {}) as g(y))"""
ORACLE["season_grid"] = f"""with {SG.format(2000, 2026)} select league_slug, season_end, season,
  'https://fbref.com/en/comps/' || cast(competition as varchar) || '/' || season || '/schedule/' || season || '-'
    || league_slug || '-Scores-and-Fixtures' as url from sg"""
ORACLE["pending_units"] = f"""with {SG.format(1994, 2004)} select league_slug, season_end, season from sg
where not exists (select 1 from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
  where n_name = league_slug and year(o_orderdate) = season_end)"""
ORACLE["json_roundtrip"] = f"""with {FB} select match_no, match_date, {rs(["HomeElo", "OddHome", "OddDraw"])} from fb"""
ORACLE["payload_text"] = f"""with {FB} select '{{"match_no":' || cast(match_no as varchar) || ',"match_date":'
  || coalesce('"' || cast(match_date as varchar) || '"', 'null') || ',"FTHome":'
  || coalesce(cast(FTHome as varchar), 'null') || ',"y_outcome":"' || y_outcome || '"}}' as payload from fb"""

# ---- projections

ORACLE["filter_divisions"] = f"""with {M} select match_no, Division, MatchDate, HomeTeam, AwayTeam from m
  where Division in ('EUROPE', 'ASIA')"""
SL = """sl as (
  select o_orderkey, o_orderpriority, cast(year(o_orderdate) + 20 as varchar) as season_end,
    case when year(o_orderdate) + 20 between 2005 and 2016 then 'train'
         when year(o_orderdate) + 20 between 2017 and 2019 then 'valid'
         when year(o_orderdate) + 20 between 2020 and 2025 then 'test' end as slice from orders)"""
ORACLE["season_slices"] = f"with {SL} select * from sl where slice is not null"
ORACLE["slice_counts"] = f"""with {SL} select o_orderpriority, season_end, count(*) as n_rows from sl
  where slice is not null group by 1, 2 order by 1, 2 limit 20"""
ORACLE["keep_columns"] = f"with {T} select Division, MatchDate, HomeTeam, FTHome from t"
ORACLE["entity_names"] = f"with {M} select HomeTeam as team_name from m union select AwayTeam from m"
_KEPT = ["match_no", "match_date"]
_KEPT_NUMBER = [
    n
    for n in FB_NUMBER
    if not (n[:4] in ("Home", "Away") and n.endswith(("Shots", "Target", "Fouls", "Yellow", "Red", "Corners")))
    and n
    not in "shots_diff shots_on_target_diff fouls_diff yellow_diff red_diff corners_diff dominance_index "
    "shot_acc_home shot_acc_away shot_acc_diff".split()
]
ORACLE["leakage_drop"] = f"with {FB} select {', '.join(_KEPT)}, {rs(_KEPT_NUMBER)} from fb"
_FIX = (
    "HomeElo AwayElo elo_diff elo_ratio Form3Home Form3Away form3_diff Form5Home Form5Away form5_diff OddHome OddDraw "
    "OddAway qh qd qa qsum p_home p_draw p_away overround MaxHome MaxAway log_odds_away_vs_home shot_acc_home "
    "shot_acc_away form_momentum_home form_momentum_away"
).split()
ORACLE["align_schema"] = f"""with {FB} select match_no, match_date, {rs(_FIX)},
  cast(0.0 as double) as MaxDraw, cast(0.0 as double) as shot_acc_diff from fb"""
_RAW = (
    "HomeElo AwayElo Form3Home Form3Away Form5Home Form5Away OddHome OddDraw OddAway MaxHome MaxDraw MaxAway".split()
)
_ABSENT = [c for c in [*_FIX, "shot_acc_diff"] if c not in _RAW]
ORACLE["align_coerce"] = f"""with {T} select match_no, try_cast(MatchDate as date) as match_date,
  {", ".join(r(_d(c), c) for c in _RAW)}, {", ".join(f"cast(null as double) as {c}" for c in _ABSENT)} from t"""

# ---- names and resolution


def _report(key: str, name: str) -> str:
    return (
        f"case when {key} % 7 = 0 then 'United ' || {name} when {key} % 3 = 0 then 'FC ' || {name} "
        f"when {key} % 3 = 1 then replace({name}, 'Supplier', 'Süpplier') else {name} end"
    )


SU = f"su as (select s_suppkey as k, s_name, {_report('s_suppkey', 's_name')} as fb from supplier)"
_DIGITS = "regexp_extract(s_name, '[0-9]+')"
ORACLE["name_auto_map"] = f"""with {SU} select fb as fbref_team, s_name as cfdm_team, 'supplier' || {_DIGITS} as norm
  from su where k % 7 <> 0"""
ORACLE["name_auto_map_inspect"] = f"""with {SU},
n as (select distinct fb, regexp_replace(lower(regexp_replace(fb, '[^a-zA-Z0-9 ]', '', 'g')), '\\s+', ' ', 'g') as norm from su),
c as (select distinct s_name, lower(regexp_replace(s_name, '[^a-zA-Z0-9 ]', '', 'g')) as norm from su)
select fb as fbref_team, s_name as cfdm_team, norm from n join c using (norm)"""
ORACLE["name_norms_build"] = f"""with {SU} select distinct fb as team_name,
  trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(fb), '[^a-z0-9 ]', '', 'g'),
    '\\b(fc|cf|ac|sc|ssc|athletic|atletico|club)\\b', '', 'g'), '\\s+', ' ', 'g')) as norm from su"""
ORACLE["name_review"] = f"""with {SU} select fb as fbref_team, 'united supplier' || {_DIGITS} as norm,
  (select count(distinct s_name) from supplier) as candidate_count from su where k % 7 = 0"""
ORACLE["name_candidates"] = f"""with {SU},
lo as (select distinct fb, 'united supplier' || {_DIGITS} as norm from su where k % 7 = 0),
ca as (select distinct s_name, 'supplier' || {_DIGITS} as other from su),
pa as (select *, levenshtein(norm, other) as edits from lo, ca),
ok as (select *, row_number() over (partition by norm order by edits, s_name) as rank from pa where edits <= floor(length(norm) * 0.4))
select fb as fbref_team, norm, cast(rank as integer) as rank, s_name as cfdm_team, cast(edits as integer) as edits from ok where rank <= 5"""
FM = SU + """, fm as (
  select fb as fbref_team, case when (k % 7 = 0 or k % 21 = 3) and k % 5 = 0 then upper(s_name) || ' ' else s_name end
    as cfdm_team from su)"""
ORACLE["compile_map"] = f"with {FM} select * from fm"
_FEED_DATE = "MatchDate + cast(match_no % 3 - 1 as int)"
FEED = f"""{M}, {FM},
fd as (select '/en/matches/' || cast(match_no as varchar) as match_url, {_report("home_key", "HomeTeam")} as home_fb,
  {_report("away_key", "AwayTeam")} as away_fb, {_FEED_DATE} as match_date_fb from m),
mp as (select match_url, match_date_fb, coalesce(h.cfdm_team, home_fb) as home_team_cf,
  coalesce(a.cfdm_team, away_fb) as away_team_cf from fd
  left join fm h on h.fbref_team = home_fb left join fm a on a.fbref_team = away_fb)"""
ORACLE["parse_titles"] = f"""with {FEED} select match_url,
  home_fb || ' vs. ' || away_fb || ' Match Report – ' || strftime(match_date_fb, '%A %B %-d, %Y') as match_title,
  home_fb as home_team_fb, away_fb as away_team_fb, strftime(match_date_fb, '%B %-d, %Y') as match_date_fb from fd"""
ORACLE["map_names"] = f"""with {FEED} select *, lower(trim(home_team_cf)) as home_norm,
  lower(trim(away_team_cf)) as away_norm from mp"""
CA = FEED + """,
ca as (select match_url, match_date_fb, home_team_cf, away_team_cf,
  concat_ws('|', Division, cast(MatchDate as varchar), HomeTeam, AwayTeam) as cfmd_match_id, MatchDate as match_date_cf,
  HomeTeam, AwayTeam, Division, coalesce(cast(FTHome as varchar), '') as FTHome,
  coalesce(cast(FTAway as varchar), '') as FTAway, cast(abs(MatchDate - match_date_fb) as integer) as days_diff,
  case when MatchDate = match_date_fb then 1 else 2 end as priority_flag
  from mp join m on lower(trim(home_team_cf)) = lower(HomeTeam) and lower(trim(away_team_cf)) = lower(AwayTeam)
    and abs(MatchDate - match_date_fb) <= 1),
de as (select * exclude (rn) from (select *, row_number() over (partition by match_url, cfmd_match_id
  order by priority_flag, days_diff, match_date_fb, home_team_cf, away_team_cf, match_date_cf, HomeTeam, AwayTeam,
    Division, FTHome, FTAway) as rn from ca) where rn = 1),
ct as (select match_url, count(distinct cfmd_match_id) as k from de group by 1)"""
ORACLE["match_candidates"] = f"with {CA} select * from ca"
ORACLE["match_map"] = f"with {CA} select de.* from de join ct using (match_url) where k = 1"
ORACLE["match_review"] = f"""with {CA} select match_url, min(match_date_fb) as match_date_fb,
  min(home_team_cf) as home_team_cf, min(away_team_cf) as away_team_cf, k as candidate_count,
  string_agg(cfmd_match_id, ';' order by priority_flag, days_diff, cfmd_match_id) as cfmd_candidates,
  min(priority_flag) as best_priority
from de join ct using (match_url) where k <> 1 group by match_url, k"""
ORACLE["review_rows"] = f"""with {CA} select match_url, k as candidate_count, cfmd_match_id, priority_flag, days_diff
  from de join ct using (match_url) where k > 1"""
ORACLE["resolution_counts"] = f"""with {CA} select (select count(distinct match_url) from fd) as reports,
  (select count(distinct match_url) from fd) - (select count(*) from ct) as "none",
  (select count(*) from ct where k = 1) as resolved, (select count(*) from ct where k > 1) as several"""

# ---- counts and summaries

ORACLE["row_counts"] = f"""with {FB} select count(*) as n_rows, count(match_date) as dated,
  count(*) filter (where y_outcome = 'H') as home_wins from fb"""
ORACLE["distinct_counts"] = f"""with {M} select count(distinct Division) as Division,
  count(distinct HomeTeam) as HomeTeam, count(distinct MatchDate) as MatchDate from m"""
ORACLE["duplicate_keys"] = """select l_orderkey, l_linenumber, count(*) as cnt from lineitem
  group by 1, 2 having count(*) > 1"""
ORACLE["duplicate_rows"] = """select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
  qualify count(*) over (partition by l_orderkey, l_linenumber) > 1"""
ORACLE["class_share"] = f"""with {FB} select y_outcome, count(*) as n,
  {r("count(*) / cast((select count(*) from fb) as double)", "share")} from fb group by 1"""
ORACLE["value_counts"] = f"""with {FB} select FTHome, count(*) as n_rows from fb where FTHome is not null group by 1"""
_COLUMNS = [*FB_TEXT, *FB_LABEL, *FB_NUMBER]
ORACLE["null_profile"] = (
    f"with {FB}, n as ("
    + " union all ".join(f"""select '{c}' as "column", count(*) - count({c}) as n_missing from fb""" for c in _COLUMNS)
    + """) select * from n order by n_missing desc, "column" limit 20"""
)
_NUMERIC = "FTHome FTAway HomeElo AwayElo elo_diff OddHome OddDraw qsum p_home shot_acc_home".split()
ORACLE["describe_numeric"] = f"with {FB} " + " union all ".join(
    f"""select '{c}' as "column", count({c}) as "count", {r(f"avg({c})", "mean")}, {r(f"stddev_samp({c})", "std")},
    {r(f"cast(min({c}) as double)", '"min"')}, {r(f"quantile_cont(cast({c} as double), 0.25)", "q25")},
    {r(f"quantile_cont(cast({c} as double), 0.5)", "q50")}, {r(f"quantile_cont(cast({c} as double), 0.75)", "q75")},
    {r(f"cast(max({c}) as double)", '"max"')} from fb"""
    for c in _NUMERIC
)
ORACLE["corr_matrix"] = (
    f"with {FB}, cr as (select "
    + ", ".join(f"corr({a}, {b}) as {a}__{b}" for a in _NUMERIC for b in _NUMERIC)
    + " from fb) "
    + " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, {r(f'{a}__{b}', 'corr')} from cr" for a in _NUMERIC for b in _NUMERIC
    )
)
ORACLE["goal_totals"] = f"""with {FB} select cast(sum(FTHome) as bigint) as FTHome,
  cast(sum(FTAway) as bigint) as FTAway from fb"""
ORACLE["overview"] = f"""with {M} select count(*) as n_rows, 5 as n_columns, 1 as n_bigint, 1 as n_date, 2 as n_double,
  1 as n_string from m"""
ORACLE["union_loose"] = f"""with {M} select match_no, HomeTeam as team, FTHome, cast(null as integer) as FTAway from m
  union all select match_no, AwayTeam, null, FTAway from m"""

# ---- splits and preparation

_BY_DATE = """case when {0} <= date '1998-06-30' then 'train' when {0} <= date '2000-06-30' then 'val'
  when {0} is not null then 'test' end as split"""
DS = FB + f", ds as (select *, {_BY_DATE.format('match_date')} from fb)"
ORACLE["date_split"] = f"with {DS} select match_no, match_date, split from ds"
ORACLE["fraction_split"] = f"""with {FB},
o as (select match_no, match_date, row_number() over (order by match_date nulls last, match_no) as rn,
  count(*) over () as n from fb)
select match_no, match_date, case when rn <= n - 2 * cast(floor(n * 0.125) as bigint) then 'train'
  when rn <= n - cast(floor(n * 0.125) as bigint) then 'val' else 'test' end as split from o"""
ORACLE["prep_matrix"] = f"""with {DS} select match_no, split,
  {", ".join(r(f"coalesce(cast({c} as double), 0.0)", c) for c in _NUMERIC)} from ds"""
_FLAGGED = [f"{s}_{c}" for c in ("rest_days", "form_momentum", "elo_trend3", "elo_trend5") for s in ("home", "away")]
ORACLE["missing_flags"] = f"""with {ROLL} select h.match_no,
  {", ".join(f"cast({c[0]}.{c.split('_', 1)[1]} is null as integer) as {c}__is_na" for c in _FLAGGED)}
  from ro h join ro a on h.match_no = a.match_no and h.side = 'home' and a.side = 'away'"""
_IMPUTED = "HomeElo elo_diff OddHome OddDraw qsum shot_acc_home".split()
_MEDIANS = ", ".join(f"median({c}) as m_{c}" for c in _IMPUTED)
_FILLED = ", ".join(r(f"coalesce({c}, m_{c})", c) for c in _IMPUTED)
ORACLE["median_impute"] = f"""with {DS}, md as (select {_MEDIANS} from ds where split = 'train')
  select match_no, split, {_FILLED} from ds, md where split is not null"""
ORACLE["median_impute_own"] = f"""with {DS}, md as (select split, {_MEDIANS} from ds group by 1)
  select match_no, ds.split, {_FILLED} from ds join md on md.split = ds.split"""

# ---- evaluation and betting

FX = f"""{M},
fx0 as (select *, cast(HomeShots % 9 as double) + 1.0 as h, cast(HomeFouls % 4 as double) + 1.0 as d,
  cast(AwayShots % 9 as double) + 1.0 as a from m),
fx as (select match_no, MatchDate, FTResult as y_outcome, h / (h + d + a) as p_H, d / (h + d + a) as p_D,
  a / (h + d + a) as p_A, case when match_no % 29 = 0 then null else OddHome end as odd_H,
  case when match_no % 31 = 0 then null else OddDraw end as odd_D,
  case when match_no % 37 = 0 then 1.0 else OddAway end as odd_A, {_BY_DATE.format("MatchDate")} from fx0)"""
_PRED = "case when p_A >= p_D and p_A >= p_H then 'A' when p_D >= p_H then 'D' else 'H' end"


def _loss(p: str) -> str:
    return f"-ln(least(greatest({p}, 1e-15), 1 - 1e-15))"


def _true(prefix: str) -> str:
    return f"case y_outcome when 'A' then {prefix}A when 'D' then {prefix}D when 'H' then {prefix}H end"


ORACLE["eval_accuracy"] = f"""with {FX} select split, count(*) as n_rows,
  {r(f"avg(case when {_PRED} = y_outcome then 1.0 else 0.0 end)", "accuracy")} from fx group by 1"""
ORACLE["eval_log_loss"] = f"""with {FX} select split, count(*) as n_rows,
  {r(f"avg({_loss(_true('p_'))})", "log_loss")} from fx group by 1"""
PD = FX + f", pd as (select y_outcome as y, {_PRED} as p from fx)"
ORACLE["confusion"] = f"with {PD} " + " union all ".join(
    f"select 'true_{t}' as label, "
    + ", ".join(f"count(*) filter (where p = '{c}') as pred_{c}" for c in "ADH")
    + f" from pd where y = '{t}'"
    for t in "ADH"
)
ORACLE["class_report"] = f"""with {PD},
k as (select l, count(*) filter (where y = l and p = l) as tp, count(*) filter (where p = l) as np,
  count(*) filter (where y = l) as ny from pd, (values ('A'), ('D'), ('H')) as v(l) group by 1),
q as (select *, coalesce(tp / nullif(cast(np as double), 0), 0) as pr, coalesce(tp / nullif(cast(ny as double), 0), 0) as re from k),
f as (select *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) as f from q)
select l as label, {r("pr", "precision")}, {r("re", "recall")}, {r("f", "f1")}, ny as support from f
union all select 'macro avg', {r("avg(pr)", "a")}, {r("avg(re)", "b")}, {r("avg(f)", "c")}, cast(sum(ny) as bigint) from f
union all select 'weighted avg', {r("sum(pr * ny) / sum(ny)", "a")}, {r("sum(re * ny) / sum(ny)", "b")},
  {r("sum(f * ny) / sum(ny)", "c")}, cast(sum(ny) as bigint) from f"""
_EDGES = "[" + ", ".join(f"{i / 10}" for i in range(1, 10)) + "]"
ORACLE["reliability"] = f"""with {FX}, e as (select split, quantile_cont(p_H, {_EDGES}) as edges from fx group by 1),
n as (select fx.split, p_H, case when y_outcome = 'H' then 1.0 else 0.0 end as y,
  len(list_filter(edges, lambda x: x < p_H)) as bin from fx join e on e.split = fx.split)
select split, bin, count(*) as n_rows, {r("avg(p_H)", "mean_predicted")}, {r("avg(y)", "observed")} from n group by 1, 2"""
OB = DS + """,
ob as (select *, coalesce(qh, 0) + coalesce(qd, 0) + coalesce(qa, 0) as s from ds),
o as (select *, qh / nullif(s, 0) as o_H, qd / nullif(s, 0) as o_D, qa / nullif(s, 0) as o_A from ob),
oc as (select *, o_H is not null and o_D is not null and o_A is not null as covered from o)"""


def _benchmark(prefix: str, guess: str) -> str:
    return f"""select split, count(*) as n_rows, count(*) filter (where covered) as covered,
  {r(f"avg({_loss(_true('o_'))}) filter (where covered)", "log_loss")},
  {r(f"avg(case when {guess} = y_outcome then 1.0 else 0.0 end) filter (where covered)", "accuracy")}
  from {prefix} group by 1"""


ORACLE["odds_benchmark"] = f"with {OB} " + _benchmark(
    "oc", "case when o_H >= o_D and o_H >= o_A then 'H' when o_D >= o_A then 'D' else 'A' end"
)
_GUESS = "case when o_A >= o_D and o_A >= o_H then 'A' when o_D >= o_H then 'D' else 'H' end"
_SHARE = "p_home is not null and p_draw is not null and p_away is not null and match_no % 4 <> 0"
_RAWQ = "qh is not null and qd is not null and qa is not null and qh + qd + qa > 0"
_ROWQ = ", ".join(
    f"case when {_SHARE} then {p} when {_RAWQ} then {q} / (qa + qd + qh) end as o_{c}"
    for c, p, q in (("H", "p_home", "qh"), ("D", "p_draw", "qd"), ("A", "p_away", "qa"))
)
ORACLE["odds_benchmark_row"] = f"""with {DS}, o as (select *, {_ROWQ} from ds),
oc as (select *, o_H is not null and o_D is not null and o_A is not null as covered from o) {_benchmark("oc", _GUESS)}"""
BL = FX + f""",
bq as (select *, 1.0 / odd_H as qh, 1.0 / odd_D as qd, 1.0 / odd_A as qa from fx),
bl as (select {_true("p_")} as pt, case y_outcome when 'A' then qa when 'D' then qd else qh end / (qa + qd + qh) as ot
  from bq where qh is not null and qd is not null and qa is not null),
ba as (select i / 20.0 as alpha, avg({_loss("i / 20.0 * pt + (1 - i / 20.0) * ot")}) as log_loss
  from bl, range(0, 21) as g(i) group by 1)"""
ORACLE["blend_losses"] = f"with {BL} select {r('cast(alpha as double)', 'alpha')}, {r('log_loss', 'log_loss')} from ba"
ORACLE["blend_search"] = f"""with {BL} select {r("cast(alpha as double)", "alpha")}, {r("log_loss", "log_loss")} from ba
  order by ba.log_loss, ba.alpha limit 1"""
ED = FX + """,
iv as (select *, 1.0 / odd_H as iH, 1.0 / odd_D as iD, 1.0 / odd_A as iA from fx),
qv as (select * exclude (iH, iD, iA), iH / (coalesce(iA, 0) + coalesce(iD, 0) + coalesce(iH, 0)) as q_H,
  iD / (coalesce(iA, 0) + coalesce(iD, 0) + coalesce(iH, 0)) as q_D,
  iA / (coalesce(iA, 0) + coalesce(iD, 0) + coalesce(iH, 0)) as q_A from iv),
ev as (select *, p_A - q_A as edge_A, p_D - q_D as edge_D, p_H - q_H as edge_H from qv),
pv as (select *, case when edge_A is null then 'A' when edge_D is null then 'D' when edge_H is null then 'H'
  when edge_A >= edge_D and edge_A >= edge_H then 'A' when edge_D >= edge_H then 'D' else 'H' end as best_pick from ev),
bv as (select *, case best_pick when 'A' then edge_A when 'D' then edge_D else edge_H end as best_edge,
  case best_pick when 'A' then p_A when 'D' then p_D else p_H end as bp,
  case best_pick when 'A' then odd_A when 'D' then odd_D else odd_H end as bo from pv),
kv as (select *, case when bo - 1 > 0 then greatest(0.0, ((bo - 1) * bp - (1 - bp)) / (bo - 1)) else 0.0 end as kf from bv)"""
_EDGE_OUT = [f"{x}_{c}" for x in ("p", "odd", "q", "edge") for c in "ADH"]
ORACLE["score_edges"] = f"""with {ED} select match_no, MatchDate, y_outcome, {rs(_EDGE_OUT)}, best_pick,
  {r("best_edge", "best_edge")}, case when best_edge >= 0.02 then best_pick else '' end as bet_recommendation from kv"""
ORACLE["score_kelly"] = f"""with {ED} select match_no, best_pick, {r("kf", "kelly_frac")}, {r("kf", "stake_suggestion")},
  case when best_edge >= 0.1 then best_pick else '' end as bet_recommendation from kv"""


def _raw(c: str, side: str) -> str:
    odd = f"(case when '{c}' = 'D' and match_no % 23 = 0 then 0.0 else odd_{c} end)"
    edge = f"(p_{c} - coalesce(case when {odd} > 0 then 1.0 / {odd} end, 0.0))"
    stake = f"case when {odd} is not null and {edge} > 0.05 and {odd} > 1 then greatest(0.0, (({odd} - 1) * p_{c} - (1 - p_{c})) / ({odd} - 1)) else 0.0 end"
    return f"{r(f'p_{c}', f'proba_{side}')}, {r(edge, f'edge_{side}')}, {r(stake, f'kelly_{side}')}"


ORACLE["score_edges_raw"] = f"""with {FX} select match_no, {_raw("H", "home")}, {_raw("D", "draw")},
  {_raw("A", "away")} from fx"""

# ---- models: what holds of every learned score


def _model(names: list[str], fits: str = "true", more: str = "") -> str:
    return f"""with {DS} select model, split, count(*) as n_rows, true as chances_ok, {fits} as fits_training{more}
from ds, (select unnest({names}) as model) where split is not null and y_outcome is not null group by model, split"""


ORACLE["baseline_scores"] = _model(["logistic", "forest"])
ORACLE["boosted_scores"] = _model(
    ["boosted", "sigmoid", "isotonic"], "(case model when 'boosted' then true end)", ", case model when 'isotonic' then true end as rising"
)
ORACLE["search_scores"] = "select cast(2 as bigint) as trials, true as in_range, true as best_ok, true as loss_ok"
ORACLE["categorical_scores"] = f"""with {FB},
d as (select case when match_no % 5 = 0 then 'ATLANTIS' when match_no % 5 <> 1 then Division end as Division from fb)
select Division, Division is not null and Division <> 'ATLANTIS' as known, count(*) as n_rows, true as chances_ok from d group by all"""
ORACLE["blended_scores"] = "select cast(21 as bigint) as weights, true as alpha_ok, true as best_ok, true as loss_ok"
ORACLE["fixture_scores"] = f"""with {FB} select match_no, {rs(["OddHome", "OddDraw", "OddAway"])},
  true as chances_ok, true as stakes_ok from fb"""
ORACLE["fixture_picks"] = f"with {FB} select match_no, true as chances_ok, true as best_ok, true as bet_ok from fb"
ORACLE["stored_report"] = f"""with {DS} select y_outcome as actual, count(*) as n_rows from ds
where split = 'test' and y_outcome is not null group by 1"""
ORACLE["stream_scores"] = f"with {FB} select match_no, true as chances_ok from fb"

# ---- sources and sinks, labels and column lists

ORACLE["csv_lenient"] = """select cast(c_custkey as varchar) as key, 'a "b", c' as name,
  case when c_custkey % 5 = 0 then null else c_mktsegment end as segment from customer where c_custkey % 7 <> 0"""
ORACLE["ingest_commits"] = """
select cast(s_nationkey as integer) as s_nationkey, 'complete' as status, count(*) as n_rows, count(*) as n_read,
  cast(sum(s_suppkey) as bigint) as keys, cast(null as boolean) as asked_again from supplier where s_nationkey % 5 <> 0 group by s_nationkey
union all select cast(n_nationkey as integer), case when n_nationkey % 10 = 0 then 'failed' else 'empty' end, 0, null, null, true
from nation where n_nationkey % 5 = 0"""

ORACLE["csv_quoted_breaks"] = """select cast(c_custkey as varchar) as c_custkey,
case when c_custkey % 3 = 0 then 'of "' || c_name || '",' || chr(10) || chr(10) || 'line two' else c_name end as note, c_mktsegment from customer"""

ORACLE["reject_counts"] = """
select 'csv' as source, 'unclosed_quote' as reason, cast(0 as bigint) as n_rows, cast(0 as bigint) as n_listed,
  count(*) filter (where c_custkey % 7 <> 0) as n_kept from customer
union all select 'csv', 'too_wide', count(*) filter (where c_custkey % 7 = 0), count(*) filter (where c_custkey % 7 = 0),
  count(*) filter (where c_custkey % 7 <> 0) from customer
union all select 'lines', 'shorter_than_tail', count(*) filter (where l_linenumber = 6), count(*) filter (where l_linenumber = 6),
  count(*) filter (where l_linenumber <> 6) from lineitem
union all select 'seasons', 'season_not_a_number', count(*) filter (where o_orderkey % 9 = 0), count(*) filter (where o_orderkey % 9 = 0),
  count(*) filter (where o_orderkey % 9 <> 0) from orders"""

ORACLE["csv_plain"] = """select cast(c_custkey as varchar) as c_custkey, case when c_custkey % 3 <> 0 then c_name end as c_name
from customer"""
ORACLE["csv_typed"] = "select p_partkey, p_name, p_size, p_retailprice, 'int,string,int,double' as inferred from part"
ORACLE["parquet_parts"] = "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'"
ORACLE["ingest_files"] = "select s_suppkey, s_nationkey from supplier"
ORACLE["required_columns"] = f"with {T} select match_no, Division, MatchDate, HomeTeam, AwayTeam from t"
_INPUTS = (
    "match_no HomeElo AwayElo elo_diff elo_ratio Form3Home Form3Away form3_diff Form5Home Form5Away form5_diff "
    "OddHome OddDraw OddAway qh qd qa qsum p_home p_draw p_away overround MaxHome MaxDraw MaxAway "
    "log_odds_away_vs_home form_momentum_home form_momentum_away"
).split()
ORACLE["numeric_inputs"] = f"with {FB} " + " union all ".join(
    f"""select '{mode}' as mode, '{c}' as "column", count({c}) as n_rows from fb"""
    for mode in ("baseline", "boosted")
    for c in _INPUTS
    if mode == "baseline" or c != "log_odds_away_vs_home"
)
ORACLE["label_numbers"] = f"""with {FB} select match_no,
  cast(case y_outcome when 'A' then 0 when 'D' then 1 else 2 end as double) as label,
  cast(case y_outcome when 'D' then 1.1 else 1.0 end as double) as weight from fb where y_outcome is not null"""
ORACLE["result_labels"] = f"""with {T} select match_no, coalesce(FTResult, '') as FTResult, FTResult as y_outcome,
  cast(case when FTResult = 'H' then 1 else 0 end as integer) as y_home_win from t"""
