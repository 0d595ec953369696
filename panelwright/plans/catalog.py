"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import evaluate as E
from panelwright.operators import joins as J
from panelwright.operators import quality as Q
from panelwright.operators import series as W
from panelwright.operators.blocks import positions
from panelwright.operators.model import forecast_nested, forecast_rows, predict_one_step, score_sums
from panelwright.operators.spline import fill_spline
from panelwright.operators.upsert import change_counts, merge_batch
from panelwright.plans import forecast as forecasts
from panelwright.plans import training
from panelwright.plans.driver_panels import (
    EVENTS, ORDERS, event_panel, gappy_panel, nations, order_pages, order_panel, perturbed, priorities, regions,
    stored_panel, table)
from panelwright.session import work_dir
from panelwright.sources import files, html, sinks, tables
from panelwright.sources.price_table import PriceTable
from panelwright.sources.registry import RunRegistry
from panelwright.streaming import ingest as streams
from panelwright.schema import substitutes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PANEL_SQL = """
op as (
  select r_name as region, o_orderpriority as priority, o_orderdate::date as day,
         cast(round_even(sum(cast(round_even(o_totalprice*100, 0) as bigint))
                         / (100.0::double * count(*)), 0) as bigint) as price
  from orders join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  group by all)"""

GAPPY_SQL = PANEL_SQL + """,
gap as (select region, priority, day, case when day(day) % 4 <> 0 then price end as price from op)"""

EVENT_SQL = """
ev as (select event_type, ts, arg_max(value, event_id) as value from events group by all)"""

# The coefficients of the fixed rollouts, oldest lag first.
WEIGHTS = (0.05, 0.05, 0.1, 0.1, 0.15, 0.2, 0.3)

PAIRS = {"1-URGENT": "2-HIGH", "2-HIGH": "1-URGENT", "3-MEDIUM": "5-LOW", "5-LOW": "3-MEDIUM"}


def query(sql: str | None = None, ctes: str = PANEL_SQL) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = f"with recursive {ctes.strip()}\n{sql}" if ctes else sql
        return fn
    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage of the session, until its ``release``."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- scans, filters, limits ---------------------------------------------------------------------

@query("select * from op where region = 'ASIA' and priority = '2-HIGH' order by day desc limit 100")
def price_history(spark, sf):
    return W.price_history(order_panel(spark, sf), ORDERS, 100, region="ASIA", priority="2-HIGH")


@query("select * from op where lower(region) = 'asia' order by day desc, region, priority limit 50")
def price_history_any_case(spark, sf):
    return W.price_history(order_panel(spark, sf), ORDERS, 50, case_insensitive=True, region="asia", priority="")


@query("select least(count(*), 60) as jumlah_data from op where region = 'EUROPE'")
def history_count(spark, sf):
    return W.row_count(W.price_history(order_panel(spark, sf), ORDERS, 60, region="EUROPE"))


@query("select distinct region, priority from op")
def series_keys(spark, sf):
    return W.series_keys(order_panel(spark, sf), ORDERS)


@query("select region, priority, max(day) as last_time, arg_max(price, day) as last_value from op group by all")
def last_observation(spark, sf):
    return W.last_observation(order_panel(spark, sf), ORDERS)


@query("select count(*) = 0 as is_empty from orders", ctes="")
def emptiness_gate(spark, sf):
    return tables.is_empty(table(spark, sf, "orders"))


# --- windows ------------------------------------------------------------------------------------

LATEST_SQL = "from op qualify row_number() over (partition by region, priority order by day desc) <= 7"


@query(f"select region, priority, day, price {LATEST_SQL}")
def latest_n(spark, sf):
    return W.latest_n(order_panel(spark, sf), 7, ORDERS)


@query(f"""select region, priority,
       string_agg(strftime(day, '%Y-%m-%d') || '=' || price, ';' order by day) as history
       from (select * {LATEST_SQL}) group by all""")
def latest_windows(spark, sf):
    windows = W.latest_windows(order_panel(spark, sf), 7, ORDERS)
    text = F.transform("history", lambda p: F.concat(
        S.iso_date(p["time"]), F.lit("="), p["value"].cast("string")))
    return windows.withColumn("history", F.array_join(text, ";"))


@query("""
, ends as (select region, priority, max(day) as last_day, arg_max(price, day) as price from op group by all),
filled as (
  select region, priority, day, price from op
  union all
  select region, priority, unnest(generate_series(last_day + interval 1 day, date '2001-08-03',
         interval 1 day))::date as day, price
  from ends where date_diff('day', last_day, date '2001-08-03') between 1 and 7)
select region, priority, day, price from filled
qualify row_number() over (partition by region, priority order by day desc) <= 7""")
def locf_asof(spark, sf):
    windows = W.latest_windows(order_panel(spark, sf), 7, ORDERS)
    return W.window_rows(W.carry_forward(windows, F.lit("2001-08-03").cast("date"), 7), ORDERS)


LAGS_SQL = ", ".join(f"lag({{c}}, {i}) over w as lag_{i}" for i in range(7, 0, -1))


@query(f"""select region, priority, day, price, {LAGS_SQL.format(c='price')}, price as y from op
window w as (partition by region, priority order by day) qualify lag_7 is not null""")
def supervised_lags(spark, sf):
    return W.tidy(W.supervised(stored_panel(spark, sf), 7, 1, ORDERS))


@query("""select region, priority, day, price, weekday,
  lag(price, 2) over w as price_lag_2, lag(price, 1) over w as price_lag_1, price as price_y,
  lead(price, 1) over w as price_lead_1, lead(price, 2) over w as price_lead_2,
  lag(weekday, 2) over w as weekday_lag_2, lag(weekday, 1) over w as weekday_lag_1, weekday as weekday_y,
  lead(weekday, 1) over w as weekday_lead_1, lead(weekday, 2) over w as weekday_lead_2
from (select *, cast(dayofweek(day) + 1 as integer) as weekday from op)
window w as (partition by region, priority order by day)""")
def supervised_multivariate(spark, sf):
    panel = stored_panel(spark, sf).withColumn("weekday", F.dayofweek("day"))
    return W.tidy(W.supervised(panel, 2, 3, ORDERS, ["price", "weekday"], drop_incomplete=False))


@query("""select event_type, ts, value, lag(value, 3) over w as lag_3, lag(value, 2) over w as lag_2,
  lag(value, 1) over w as lag_1, value as y from ev
window w as (partition by event_type order by ts) qualify lag_3 is not null""", EVENT_SQL)
def event_lags(spark, sf):
    panel, spec = event_panel(spark, sf)
    return W.tidy(W.supervised(panel, 3, 1, spec))


POSITION_SQL = """, ranked as (
  select *, row_number() over (partition by region, priority order by day) as pos,
         count(*) over (partition by region, priority) as n from op),
parted as (select *, case when pos <= floor(n * 0.7::double) then 'train' else 'test' end as split from ranked)"""


@query(POSITION_SQL + " select region, priority, day, price, pos, n, split from parted")
def temporal_split(spark, sf):
    return W.tidy(W.temporal_split(stored_panel(spark, sf), ORDERS))


@query("""select event_type, ts, value, pos, n,
  case when pos <= floor(n * 0.7::double) then 'train' else 'test' end as split
from (select *, row_number() over (partition by event_type order by ts) as pos,
             count(*) over (partition by event_type) as n from ev)""", EVENT_SQL)
def event_split(spark, sf):
    panel, spec = event_panel(spark, sf)
    return W.tidy(W.temporal_split(panel, spec))


@query("""select * from op where (region, priority) in
  (select (region, priority) from op group by region, priority having count(*) >= 520)""")
def long_enough(spark, sf):
    return Q.long_enough(stored_panel(spark, sf), 520, ORDERS)


@query("""select o_custkey, o_orderkey, o_totalprice from orders where o_custkey in
  (select o_custkey from orders group by 1 having count(*) >= 10)""", ctes="")
def long_enough_customers(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return Q.long_enough(orders, 10, ORDERS.with_keys("o_custkey"))


@query(POSITION_SQL + """ select region, priority, day, price, split from parted where (region, priority) in
  (select (region, priority) from parted group by region, priority
   having count(*) filter (where split = 'train') >= 365 and count(*) filter (where split = 'test') >= 157)""")
def split_long_enough(spark, sf):
    """The series both of whose parts have enough rows."""
    rows = W.tidy(W.temporal_split(stored_panel(spark, sf), ORDERS))
    return Q.split_long_enough(rows, ORDERS, train=365, test=157).drop("pos", "n")


# --- gap filling --------------------------------------------------------------------------------

def fill_sql(part: str) -> str:
    return f"""
, ranked as (select *, row_number() over (partition by region, priority order by day) as pos,
                    count(*) over (partition by region, priority) as n from gap),
parted as (select *, case when pos <= floor(n * 0.7::double) then 'train' else 'test' end as split from ranked),
seen as (
  select *, last_value(case when price is not null then pos end ignore nulls) over b as ppos,
            last_value(price ignore nulls) over b as pval,
            first_value(case when price is not null then pos end ignore nulls) over a as npos,
            first_value(price ignore nulls) over a as nval
  from parted
  window b as (partition by region, priority{part} order by day rows between unbounded preceding and current row),
         a as (partition by region, priority{part} order by day rows between current row and unbounded following)),
filled as (
  select region, priority, day, split, pos, n, price as known,
         coalesce(price::double, pval::double + (nval::double - pval::double)
                  * ((pos - ppos)::double / (npos - ppos)::double), pval::double, nval::double) as price
  from seen)"""


@query(fill_sql("") + """
select region, priority, day, round_even(price / 100.0::double, 0) * 100.0::double as price, pos, n from filled""",
       GAPPY_SQL)
def linear_interp(spark, sf):
    return W.tidy(W.fill_linear(gappy_panel(spark, sf), ORDERS, step=100))


@query(fill_sql(", split") + """
select region, priority, day, split, pos, n, round_even(price / 100.0::double, 0) * 100.0::double as price
from filled""", GAPPY_SQL)
def linear_interp_by_split(spark, sf):
    rows = W.temporal_split(gappy_panel(spark, sf), ORDERS)
    return W.tidy(W.fill_linear(rows, ORDERS, part="split", step=100))


@query("""
, gap as (select event_type, ts, case when minute(ts) % 4 <> 0 then value end as value from ev),
ranked as (select *, row_number() over (partition by event_type order by ts) as pos,
                  count(*) over (partition by event_type) as n from gap),
seen as (
  select *, last_value(case when value is not null then pos end ignore nulls) over b as ppos,
            last_value(value ignore nulls) over b as pval,
            first_value(case when value is not null then pos end ignore nulls) over a as npos,
            first_value(value ignore nulls) over a as nval
  from ranked
  window b as (partition by event_type order by ts rows between unbounded preceding and current row),
         a as (partition by event_type order by ts rows between current row and unbounded following))
select event_type, ts, pos, n,
       round(coalesce(value, pval + (nval - pval) * ((pos - ppos)::double / (npos - ppos)::double), pval, nval), 6)
         as value
from seen""", EVENT_SQL)
def event_interp(spark, sf):
    panel, spec = event_panel(spark, sf)
    panel = panel.withColumn("value", F.when(F.minute("ts") % 4 != 0, F.col("value")))
    return W.tidy(W.fill_linear(panel, spec)).withColumn("value", F.round("value", 6))


def spline_sql(part: str) -> str:
    """The spline of every series (or of its parts): the tridiagonal system by elimination down the known points and
    substitution back, one recursion each."""
    label = "split" if part else "''"
    return fill_sql(part) + f""",
known as (
  select region, priority, {label} as part, pos::double as x, price::double as y,
         row_number() over w as i, count(*) over (partition by region, priority, {label}) as k
  from parted where price is not null window w as (partition by region, priority, {label} order by pos)),
steps as (select *, x - lag(x) over w as h0, lead(x) over w - x as h1,
                 (lead(y) over w - y) / (lead(x) over w - x) - (y - lag(y) over w) / (x - lag(x) over w) as bend
          from known where k >= 4 window w as (partition by region, priority, part order by i)),
coef as materialized (
  select region, priority, part, i, k, 6 * bend as r,
         case when i = 2 then 0 else h0 - case when i = k - 1 then h1 * h1 / h0 else 0 end end as l,
         case when i = k - 1 then 0 else h1 - case when i = 2 then h0 * h0 / h1 else 0 end end as u,
         2 * (h0 + h1) + case when i = 2 then h0 + h0 * h0 / h1 else 0 end
           + case when i = k - 1 then h1 + h1 * h1 / h0 else 0 end as d
  from steps where i between 2 and k - 1),
down as (
  select region, priority, part, i, k, u / d as c, r / d as e from coef where i = 2
  union all
  select n.region, n.priority, n.part, n.i, n.k, n.u / (n.d - n.l * p.c) as c, (n.r - n.l * p.e) / (n.d - n.l * p.c) as e
  from down p join coef n on n.region = p.region and n.priority = p.priority and n.part = p.part and n.i = p.i + 1),
eliminated as materialized (select * from down),
back as (
  select region, priority, part, i, e as m from eliminated where i = k - 1
  union all
  select n.region, n.priority, n.part, n.i, n.e - n.c * p.m as m
  from back p join eliminated n on n.region = p.region and n.priority = p.priority and n.part = p.part and n.i = p.i - 1),
inner_m as (select s.*, b.m from steps s left join back b using (region, priority, part, i)),
curve as (
  select region, priority, part, x, coalesce(m,
    case when i = 1 then lead(m) over w - h1 / lead(h1) over w * (lead(m, 2) over w - lead(m) over w)
         when i = k then lag(m) over w - h0 / lag(h0) over w * (lag(m, 2) over w - lag(m) over w) end) as m
  from inner_m window w as (partition by region, priority, part order by i)),
bent as (
  select f.*, coalesce(s.price::double, a * pval + b * nval + ((a * a * a - a) * p.m + (b * b * b - b) * q.m) * (npos - ppos) * (npos - ppos) / 6.0) as cubic,
         ppos is not null and npos is not null as inside
  from (select *, (npos - pos)::double / nullif(npos - ppos, 0) as a, (pos - ppos)::double / nullif(npos - ppos, 0) as b from seen) s
  join filled f using (region, priority, day)
  left join curve p on p.region = s.region and p.priority = s.priority and p.part = {label.replace("split", "s.split")} and p.x = s.ppos
  left join curve q on q.region = s.region and q.priority = s.priority and q.part = {label.replace("split", "s.split")} and q.x = s.npos),
judged as (select *, coalesce(bool_or(inside and (cubic is null or cubic < 0 or cubic > 500000))
                              over (partition by region, priority{part}), false) as bad from bent)
select region, priority, day, {"split, " if part else ""}pos, n,
       round_even(case when bad or not inside then price else cubic end / 100.0::double, 0) * 100.0::double as price
from judged"""


@query(spline_sql(""), GAPPY_SQL)
def spline_interp(spark, sf):
    return W.tidy(fill_spline(gappy_panel(spark, sf), ORDERS, step=100))


@query(spline_sql(", split"), GAPPY_SQL)
def spline_interp_by_split(spark, sf):
    rows = W.temporal_split(gappy_panel(spark, sf), ORDERS)
    return W.tidy(fill_spline(rows, ORDERS, part="split", step=100))


@query(fill_sql("") + """, bad as (
  select region, priority, coalesce(bool_or(price > 400000), false) as bad from filled group by all)
select region, priority, day, bad, case when bad then round_even(price / 100.0::double, 0) * 100.0::double
  when known is not null then round_even(known / 100.0::double, 0) * 100.0::double end as price
from filled join bad using (region, priority)""", GAPPY_SQL)
def spline_fallback(spark, sf):
    """Known prices above the highest plausible one turn a whole series to linear filling."""
    gap = gappy_panel(spark, sf)
    bad = gap.groupBy("region", "priority").agg(F.coalesce(F.max(F.col("price") > 400000), F.lit(False)).alias("bad"))
    known = gap.select("region", "priority", "day", F.col("price").isNotNull().alias("known"))
    filled = W.tidy(fill_spline(gap, ORDERS, step=100, high=400000))
    rows = filled.join(known, ORDERS.natural_key).join(bad, ["region", "priority"])
    return rows.select("region", "priority", "day", "bad",
                       F.when(F.col("bad") | F.col("known"), F.col("price")).alias("price"))


# --- scaling, windows, metrics ------------------------------------------------------------------

SCALER_SQL = POSITION_SQL + """,
sc as (select min(price)::double as vmin, max(price)::double as vmax from parted where split = 'train')"""


@query(SCALER_SQL + " select vmin, vmax from sc")
def minmax_fit(spark, sf):
    rows = W.temporal_split(stored_panel(spark, sf), ORDERS)
    return E.fit_scaler(rows.filter(F.col("split") == "train"), "price")


@query(SCALER_SQL + """ select region, priority, day, split, round((price - vmin) / (vmax - vmin), 9) as scaled
from parted cross join sc""")
def minmax_scaled(spark, sf):
    rows = W.temporal_split(stored_panel(spark, sf), ORDERS)
    scaler = E.fit_scaler(rows.filter(F.col("split") == "train"), "price")
    rows = W.tidy(E.scaled(rows, scaler, "price", "scaled"))
    return rows.select("region", "priority", "day", "split", F.round("scaled", 9).alias("scaled"))


@query(SCALER_SQL + f""", s as (
  select region, priority, day, split, (price - vmin) / (vmax - vmin) as v from parted cross join sc)
select region, priority, day, split, {', '.join(
    f'round(lag(v, {i}) over w, 9) as lag_{i}' for i in range(7, 0, -1))}, round(v, 9) as y
from s window w as (partition by region, priority order by day) qualify lag(v, 7) over w is not null""")
def train_test_windows(spark, sf):
    rows = W.temporal_split(stored_panel(spark, sf), ORDERS)
    windows, _ = training.training_windows(rows, ORDERS)
    rounded = {f"lag_{i}": F.round(f"lag_{i}", 9) for i in range(7, 0, -1)}
    return windows.withColumns({**rounded, "y": F.round("y", 9)})


NAIVE_SQL = """, naive as (
  select *, lag(price) over (partition by region, priority order by day) as prediction from op)
"""
METRICS_SQL = """count(*) as n,
  round(avg(case when price <> 0 then abs((price - prediction)::double / price) end) * 100, 6) as mape,
  round(sqrt(avg((price - prediction)::double * (price - prediction))), 6) as rmse,
  round(avg(abs((price - prediction)::double)), 6) as mae
from naive where prediction is not null"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mape", "rmse", "mae")})


@query(NAIVE_SQL + "select " + METRICS_SQL)
def naive_eval(spark, sf):
    naive = E.naive_forecast(stored_panel(spark, sf), ORDERS)
    return _rounded(E.error_metrics(naive, "price", "prediction"))


@query(NAIVE_SQL + "select region, priority, " + METRICS_SQL + " group by all")
def naive_eval_by_series(spark, sf):
    naive = E.naive_forecast(stored_panel(spark, sf), ORDERS)
    return _rounded(E.error_metrics(naive, "price", "prediction", ORDERS.keys))


@query(NAIVE_SQL + """select region, priority, day, price, prediction, price - prediction as residual
from naive where prediction is not null""")
def naive_residuals(spark, sf):
    return E.residuals(E.naive_forecast(stored_panel(spark, sf), ORDERS), "price", "prediction")


@query("""select region, priority, day, round(greatest(0.0, least(1.0, (price - 100000) / 300000.0::double)), 9)
  as clipped, (price < 0 or price > 400000) as implausible from op""")
def clipped_prices(spark, sf):
    unit = S.scale(F.col("price"), F.lit(100000.0), F.lit(400000.0))
    return order_panel(spark, sf).select(
        "region", "priority", "day", F.round(S.clip01(unit), 9).alias("clipped"),
        S.implausible(F.col("price").cast("double"), 400000).alias("implausible"))


# --- validation and names -----------------------------------------------------------------------

REQUESTS_SQL = """, req as (
  select c_custkey as id, case when c_custkey % 7 = 0 then lower(r_name) else r_name end as region,
         list_extract(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', '6-NEVER'],
                      cast(c_custkey % 6 + 1 as bigint)) as priority,
         cast(c_custkey % 33 as integer) as durasi
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
checked as (
  select *, case when region not in (select r_name from region) then 'unknown region'
                 when priority not in (select o_orderpriority from orders) then 'unknown priority'
                 when durasi not between 1 and 30 then 'horizon out of range' end as reason from req)"""


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = table(spark, sf, "customer"), nations(spark, sf)
    names = F.array(*[F.lit(n) for n in (
        "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEVER")])
    id_ = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        id_.alias("id"), F.when(id_ % 7 == 0, F.lower("region")).otherwise(F.col("region")).alias("region"),
        F.get(names, (id_ % 6).cast("int")).alias("priority"), (id_ % 33).cast("int").alias("durasi"))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    dims = {"region": regions(spark, sf), "priority": priorities(spark, sf)}
    return Q.check_requests(_requests(spark, sf), dims)


@query(REQUESTS_SQL + """
select id, region, priority, durasi, coalesce(reason, case when n is null or n < 7 then 'insufficient data' end)
  as reason, last_day
from checked left join (select region, priority, least(count(*), 7) as n, max(day) as last_day from op group by all)
  using (region, priority)""")
def validated_requests(spark, sf):
    windows = W.latest_windows(stored_panel(spark, sf), 7, ORDERS)
    joined = J.requests_with_history(_checked(spark, sf), windows, ORDERS)
    last = F.when(F.size("history") > 0, F.element_at("history", -1)["time"])
    return joined.select("id", "region", "priority", "durasi", "reason", last.alias("last_day"))


@query(REQUESTS_SQL + """
select id, region, priority, durasi, coalesce(reason, 'insufficient data') as reason
from checked left join (select region, priority, least(count(*), 7) as n from op group by all) using (region, priority)
where reason is not null or n is null or n < 7""")
def forecast_rejects(spark, sf):
    """The requests that get no forecast, each with its reason."""
    lost = forecasts.rejects(stored_panel(spark, sf), _checked(spark, sf), lag=7, spec=ORDERS)
    return lost.select("id", "region", "priority", "durasi", "reason")


@query(REQUESTS_SQL + " select coalesce(reason, 'ok') as reason, count(*) as n_rows from checked group by 1")
def rejected_request_counts(spark, sf):
    return Q.count_reasons(_checked(spark, sf))


@query("""
select o_orderkey, day, status, price, reason, count(*) as copies from (
  select o_orderkey, o_orderdate::date as day, case when o_orderkey % 17 = 0 then '' else o_orderstatus end as status,
    case when o_orderkey % 13 = 0 then 0 when o_orderkey % 11 = 0 then null
         else cast(round_even(o_totalprice, 0) as bigint) end as price,
    case when o_orderkey % 17 = 0 then 'empty status' when o_orderkey % 13 = 0 then 'price not positive'
         when o_orderkey % 11 = 0 then 'unreadable price' end as reason from orders) group by all""", ctes="")
def record_checks(spark, sf):
    key = F.col("o_orderkey")
    price = S.rupiah(S.round_int(F.col("o_totalprice")))
    raw = F.when(key % 13 == 0, F.lit("0")).when(key % 11 == 0, F.lit("-")).otherwise(price)
    records = table(spark, sf, "orders").select(
        key, F.col("o_orderdate").cast("date").alias("day"),
        F.when(key % 17 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("status"), raw.alias("raw"))
    spec = ORDERS.with_keys("status")
    checked = Q.check_records(records.withColumn("price", F.lit(None).cast("bigint")), spec, raw="raw")
    return checked.groupBy("o_orderkey", "day", "status", "price", "reason").agg(F.count("*").alias("copies"))


@query("""select c_custkey, n_name as name from customer join nation on c_nationkey = n_nationkey
where c_custkey % 5 <> 0""", ctes="")
def canonical_names(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    raw = F.concat(F.lit(" "), F.translate(F.lower("n_name"), "_", "-"), F.lit(". "))
    raw = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("Semua "), raw)).otherwise(raw)
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", raw.alias("raw"))
    names = nation.select(F.col("n_name").alias("name"))
    return J.canonical_names(rows, names, "raw", "name").select("c_custkey", "name")


@query("""select l_orderkey, l_linenumber,
  case l_orderkey % 5 when 0 then null when 1 then null else cast(round(l_extendedprice, 0) as bigint) end as scraped,
  case l_orderkey % 5 when 0 then null when 1 then round(l_extendedprice, 0) when 2 then null
    else cast(round(l_extendedprice, 0) as bigint)::double end as cleaned
from lineitem""", ctes="")
def clean_price_text(spark, sf):
    whole = F.round("l_extendedprice", 0).cast("bigint")
    kind = F.col("l_orderkey") % 5
    text = (F.when(kind == 0, F.lit("-")).when(kind == 1, F.concat(F.lit(" +"), whole.cast("string")))
            .when(kind == 2, S.rupiah(whole)).when(kind == 3, F.format_number(whole, 0))
            .otherwise(F.concat(F.lit(" "), whole.cast("string"), F.lit("\t"))))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", S.clean_price_string(text).alias("scraped"), S.clean_price(text).alias("cleaned"))


SHOPS_SQL = """
select s_name as nama_toko, l_returnflag as platform, p_name as nama_produk, p_type as jenis_cabai,
  cast(case l_orderkey % 5 when 0 then 0 when 1 then p_size * 1000 + 500 when 4 then null
       else cast(l_quantity as bigint) * 1000 end as integer) as harga,
  case when l_linenumber = 1 then '' else 'kg' end as satuan, '' as lokasi,
  cast(case when l_orderkey % 7 = 0 then 0 else 4 + (l_orderkey % 9) / 10.0::double end as float) as rating,
  'l/' || l_orderkey as link_toko, 'g/' || l_partkey as gambar_produk,
  case when l_orderkey % 5 = 4 then 'unreadable price' end as reason
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey"""


@query(SHOPS_SQL, ctes="")
def clean_shops(spark, sf):
    return _clean_shops(spark, sf).withColumnRenamed("gambar_toko", "gambar_produk")


def _clean_shops(spark: SparkSession, sf: str) -> DataFrame:
    line, part, supplier = (table(spark, sf, t) for t in ("lineitem", "part", "supplier"))
    rows = line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
    key, quantity = F.col("l_orderkey"), F.col("l_quantity").cast("bigint")
    size, kind = F.col("p_size").cast("bigint"), (key % 5).cast("int")
    before = F.get(F.array(F.lit(None), F.lit(""), F.lit("Rp "), F.lit(""), F.lit("tanya ")), kind)
    after = F.get(F.array(F.lit(""), F.lit(".5"), F.lit(".000"), F.lit(",000"), F.lit("")), kind)
    price = F.concat(before, F.when(kind == 1, size).otherwise(quantity).cast("string"), after)
    rating = F.when(key % 7 == 0, F.lit("baru")).otherwise(
        F.concat(F.lit(" 4,"), (key % 9).cast("string")))
    raw = rows.select(
        F.col("s_name").alias(" nama_toko "), F.col("l_returnflag").alias("platform"),
        F.col("p_name").alias("nama_produk"), F.col("p_type").alias("jenis_cabai"), price.alias("harga"),
        F.when(F.col("l_linenumber") > 1, "kg").alias("satuan"), F.lit(None).cast("string").alias("lokasi"),
        rating.alias("rating"), F.concat(F.lit("l/"), key.cast("string")).alias("link_toko"),
        F.concat(F.lit("g/"), F.col("l_partkey").cast("string")).alias("gambar_produk"))
    return tables.clean_shops(raw)


@query(f"select * exclude (reason) from ({SHOPS_SQL}) where reason is null", ctes="")
def shop_listing(spark, sf):
    return tables.shop_listing(Q.passed(_clean_shops(spark, sf)))


@query("""select o_orderkey, try_strptime(replace(t, ' ', ''), '%d/%m/%Y')::date as day from (
  select o_orderkey, case when o_orderkey % 9 = 0 then '31/02/2026' when o_orderkey % 10 = 0 then 'x'
    else strftime(o_orderdate, ' %d/ %m/%Y') end as t from orders)""", ctes="")
def header_dates(spark, sf):
    key = F.col("o_orderkey")
    text = (F.when(key % 9 == 0, F.lit("31/02/2026")).when(key % 10 == 0, F.lit("x"))
            .otherwise(F.date_format("o_orderdate", " dd/ MM/yyyy")))
    return table(spark, sf, "orders").select("o_orderkey", S.header_date(text).alias("day"))


@query("""select l_orderkey, l_linenumber, round_even(l_extendedprice / 100.0::double, 0) * 100.0::double as hundreds,
  cast(round_even(l_extendedprice, 0) as bigint) as whole from lineitem""", ctes="")
def rounded_prices(spark, sf):
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", S.round_to(price, 100).alias("hundreds"), S.round_int(price).alias("whole"))


@query("""select o_orderkey, replace(o_orderpriority, ' ', '_') as file_key, o_orderstatus as first,
  replace(o_orderpriority, ' ', '_') || '_x' as second,
  strftime(o_orderdate + interval 3 day, '%Y-%m-%d') as later from orders""", ctes="")
def file_stems(spark, sf):
    key = S.file_key(F.col("o_orderpriority"))
    path = F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit("_"), key, F.lit("_x.csv"))
    first, second = S.stem_keys(S.file_stem(path), ("first", "second"))
    return table(spark, sf, "orders").select(
        "o_orderkey", key.alias("file_key"), first, second,
        S.iso_date(F.date_add("o_orderdate", 3)).alias("later"))


@query("""select region, priority, day, case region when 'AFRICA' then '1000' when 'ASIA' then '0010'
  when 'EUROPE' then '0001' when 'AMERICA' then '0100' else '0000' end as slots from
  (select case region when 'AMERICA' then 'ASIA' when 'ASIA' then 'AMERICA' else region end as region,
          priority, day from op)""")
def one_hot_regions(spark, sf):
    swapped = (F.when(F.col("region") == "AMERICA", "ASIA").when(F.col("region") == "ASIA", "AMERICA")
               .otherwise(F.col("region")))
    slots = S.one_hot(F.col("region"), ["ASIA", "AFRICA", "EUROPE", "AMERICA"])
    return (order_panel(spark, sf).withColumn("region", swapped)
            .select("region", "priority", "day",
                    F.array_join(F.transform(slots, lambda x: x.cast("int").cast("string")), "").alias("slots")))


# --- joins --------------------------------------------------------------------------------------

@query("""select n_name as nation, o_orderpriority as priority, (m - to_days(k))::date as day
from nation, (select distinct o_orderpriority from orders), (select max(o_orderdate)::date as m from orders),
  (select unnest([0, 1, 2]) as k)""", ctes="")
def dims_cross_days(spark, sf):
    orders = table(spark, sf, "orders")
    spec = ORDERS.with_keys("nation", "priority")
    names = table(spark, sf, "nation").select(F.col("n_name").alias("nation"))
    as_of = orders.agg(F.max("o_orderdate").cast("date")).scalar()
    return J.dims_by_days(names, priorities(spark, sf).withColumnRenamed("name", "priority"), J.last_days(as_of), spec)


@query("""select n_name as nation, o_orderpriority as priority, day,
  lo + ('0x' || substr(md5(concat_ws('|', '42', strftime(day, '%Y-%m-%d'), n_name, o_orderpriority)), 1, 8))::bigint
       % (hi - lo + 1) as price, true as is_synthetic
from (select n_name, o_orderpriority, (m - to_days(k))::date as day,
        case o_orderpriority when '1-URGENT' then 40000 else 30000 end::bigint as lo,
        case o_orderpriority when '1-URGENT' then 80000 when '2-HIGH' then 55000 else 60000 end::bigint as hi
      from nation, (select distinct o_orderpriority from orders), (select max(o_orderdate)::date as m from orders),
        (select unnest([0, 1, 2]) as k))""", ctes="")
def simulated_panel(spark, sf):
    orders = table(spark, sf, "orders")
    spec = ORDERS.with_keys("nation", "priority")
    names = table(spark, sf, "nation").select(F.col("n_name").alias("nation"))
    as_of = orders.agg(F.max("o_orderdate").cast("date")).scalar()
    ranges = {"1-URGENT": (40_000, 80_000), "2-HIGH": (30_000, 55_000)}
    return tables.simulated_panel(names, priorities(spark, sf).withColumnRenamed("name", "priority"), as_of, 3, 42, spec, ranges)


@query(f"""
, pairs(item, substitute) as (values {', '.join(f"('{a}', '{b}')" for a, b in PAIRS.items())})
select g.region, g.priority, g.day, g.price, coalesce(g.price, o.price) as filled
from (select region, priority, day, case when (day(day) + length(priority)) % 4 <> 0 then price end as price from op) g
left join pairs on g.priority = item
left join (select region, priority, day, case when (day(day) + length(priority)) % 4 <> 0 then price end as price
           from op) o on o.region = g.region and o.day = g.day and o.priority = substitute""")
def substitute_fill(spark, sf):
    known = (F.day("day") + F.length("priority")) % 4 != 0
    panel = stored_panel(spark, sf).withColumn("price", F.when(known, F.col("price")))
    return J.fill_from_substitute(panel, substitutes(spark, PAIRS), ORDERS)


# --- upsert, sinks, streams ---------------------------------------------------------------------

UPSERT_SQL = """, target as (select * from op where dayofyear(day) % 3 <> 0),
batch as (
  select region, priority, day, v.seq as seq, v.price as price from (
    select region, priority, day, unnest(
      case when day(day) % 5 = 0 then [{'seq': 1, 'price': price + 100}, {'seq': 2, 'price': price + 100},
                                       {'seq': 3, 'price': price + day(day) % 3}]
           else [{'seq': 3, 'price': price + day(day) % 3}] end) as v
    from op where dayofyear(day) % 3 = 0 or day(day) % 2 = 0)),
newest as (select region, priority, day, arg_max(price, seq) as price from batch group by all),
merged as (select region, priority, day, coalesce(n.price, t.price)::bigint as price
           from target t full join newest n using (region, priority, day)),
steps as (select b.price as price, coalesce(lag(b.price) over (partition by region, priority, day order by seq), t.price) as prev,
                 t.price is null and seq = min(seq) over (partition by region, priority, day) as fresh
          from batch b left join target t using (region, priority, day)),
counts as (select cast(count(*) filter (where fresh) as bigint) as inserted,
                  cast(count(*) filter (where not fresh and b_price is distinct from prev) as bigint) as updated
           from (select fresh, prev, price as b_price from steps))"""


@query(UPSERT_SQL + " select * from merged")
def upsert_panel(spark, sf):
    target, batch = perturbed(stored_panel(spark, sf))
    return merge_batch(target, batch, ORDERS).select(*ORDERS.columns)


@query(UPSERT_SQL + " select * from counts")
def upsert_counts(spark, sf):
    target, batch = perturbed(stored_panel(spark, sf))
    return change_counts(target, batch, ORDERS)


def _table(spark: SparkSession, name: str) -> PriceTable:
    schema = spark.createDataFrame([], "region string, priority string, day date, price bigint").schema
    return PriceTable(spark, scratch(spark, name), schema, ORDERS, period="yyyy")


@query(UPSERT_SQL + " select merged.*, inserted, updated from merged, counts")
def stored_upsert(spark, sf):
    """Both loads through the stored table; its counts come from the run log."""
    prices = _table(spark, "stored_upsert")
    target, batch = perturbed(stored_panel(spark, sf))
    prices.upsert(target.withColumn("seq", F.lit(0)), 0)
    prices.upsert(batch, 1)
    log = prices.runs().filter(F.col("run_id") == 1).select(F.struct("inserted", "updated")).scalar()
    return prices.read().withColumn("inserted", log["inserted"]).withColumn("updated", log["updated"])


@query(UPSERT_SQL + """, other as (select region || '-B' as region, priority, day, price from target)
select * from merged union all select * from other""")
def stored_upsert_two_sources(spark, sf):
    """Two sources in turn, then the first one's runs again, as after a restart: nothing is lost or applied twice."""
    prices = _table(spark, "two_sources")
    target, batch = perturbed(stored_panel(spark, sf))
    first = target.withColumn("seq", F.lit(0))
    prices.upsert(first, 0, source="A")
    prices.upsert(first.withColumn("region", F.concat("region", F.lit("-B"))), 0, source="B")
    prices.upsert(batch, 1, source="A")
    prices.upsert(first, 0, source="A")
    prices.upsert(batch, 1, source="A")
    return prices.read()


CORRECTED_SQL = UPSERT_SQL.replace("target as (select * from op", """target as (
  select region, priority, day, case when day(day) % 7 = 0 then price + 7 else price end as price from op""")


@query(CORRECTED_SQL + " select merged.*, inserted, updated, false as first_try from merged, counts")
def stored_upsert_two_writers(spark, sf):
    """While one writer works out a batch, another commits corrections to the same periods. The first one's commit is refused,
    and its upsert starts again from the corrected prices: every row of both is there, and counted."""
    prices = _table(spark, "two_writers")
    target, batch = perturbed(stored_panel(spark, sf))
    prices.upsert(target.withColumn("seq", F.lit(0)), 0, source="A")
    late = prices.begin(prices.prepare(batch, 1, source="A"))
    corrections = target.where(F.day("day") % 7 == 0).withColumn("price", F.col("price") + 7)
    prices.upsert(corrections.withColumn("seq", F.lit(0)), 0, source="B")
    done = prices.finish(late)
    prices.upsert(batch, 1, source="A")
    log = prices.runs().where("source = 'A' and run_id = 1").select(F.struct("inserted", "updated")).scalar()
    return prices.read().withColumns({
        "inserted": log["inserted"], "updated": log["updated"], "first_try": F.lit(done)})


def _loaded(spark: SparkSession, sf: str, name: str) -> PriceTable:
    """A stored table after a first load and a batch on top of it, not compacted."""
    prices = _table(spark, name)
    target, batch = perturbed(stored_panel(spark, sf))
    prices.upsert(target.withColumn("seq", F.lit(0)), 0)
    prices.upsert(batch, 1)
    return prices


@query(UPSERT_SQL + """ select *, 2 as parts_before, 1 as parts_after from merged""")
def stored_compaction(spark, sf):
    """The rows of a table after its periods were made one part each and the old parts removed."""
    prices = _loaded(spark, sf, "compaction")
    most = lambda: F.lit(max(len(parts) for parts in prices.state().by_period().values()))
    before = most()
    prices.compact()
    prices.vacuum()
    return prices.read().withColumns({"parts_before": before, "parts_after": most()})


@query(UPSERT_SQL + """ select * from merged
qualify row_number() over (partition by region, priority order by day desc) <= 7""")
def stored_latest(spark, sf):
    """The newest rows of every series; only the periods that hold them are opened."""
    return _loaded(spark, sf, "latest").latest(7)


@query(UPSERT_SQL + " select * from merged where region = 'ASIA' and priority = '2-HIGH'")
def stored_lookup(spark, sf):
    """One series of the stored table, from the files that hold it."""
    return _loaded(spark, sf, "lookup").lookup(region="ASIA", priority="2-HIGH")


@query(UPSERT_SQL + """ select region, priority, count(*) as n_rows, min(day) as first, max(day) as last
from merged group by all""")
def stored_series(spark, sf):
    """What the zones of the stored table know of its series."""
    return _loaded(spark, sf, "series").series()


@query("select region, priority, day, price + 1 as price from op")
def stream_arrival_order(spark, sf):
    """Two files of one micro-batch hold the same keys; the one that came later wins, and has no sequence column."""
    prices, base = _table(spark, "stream_arrival"), scratch(spark, "arrivals")
    panel = stored_panel(spark, sf).select(*ORDERS.columns)
    for step in (0, 1):
        at = F.lit(f"2024-01-0{step + 1} 00:00:00").cast("timestamp")
        (panel.withColumn("price", F.col("price") + step).withColumn("fetched_at", at)
         .coalesce(1 + step).write.mode("append").parquet(f"{base}/in"))
    kind = panel.withColumn("fetched_at", F.current_timestamp()).schema
    streams.ingest(streams.snapshot_stream(spark, f"{base}/in", kind), prices, f"{base}/checkpoint",
                   "arrivals").awaitTermination()
    return prices.read()


@query(UPSERT_SQL + " select * from merged")
def stream_upsert(spark, sf):
    """The same two loads as snapshot files that arrive one after the other in a watched folder."""
    prices, base = _table(spark, "stream_upsert"), scratch(spark, "snapshots")
    target, batch = perturbed(stored_panel(spark, sf))
    for part in (target.withColumn("seq", F.lit(0)), batch):
        part.write.mode("append").parquet(f"{base}/in")
        stream = streams.snapshot_stream(spark, f"{base}/in", part.select(*ORDERS.columns, "seq").schema)
        streams.ingest(stream, prices, f"{base}/checkpoint", "snapshots").awaitTermination()
    return prices.read()


@query("select region, priority, day, price from op")
def html_report_rows(spark, sf):
    pages = order_pages(order_panel(spark, sf))
    return Q.passed(html.report_rows(pages, regions(spark, sf), ORDERS)).select(*ORDERS.columns)


@query(POSITION_SQL + " select region, priority, split, count(*) as n_rows from parted group by all")
def split_counts(spark, sf):
    rows = W.tidy(W.temporal_split(stored_panel(spark, sf), ORDERS))
    return rows.groupBy("region", "priority", "split").agg(F.count("*").alias("n_rows"))


@query(POSITION_SQL + """ select case when region = 'ASIA' then 'AFRI_CA' when region = 'AFRICA' then 'AFRI CA'
  else region end as region, priority, split, day, price from parted""")
def split_export(spark, sf):
    """Delimited files by part and bucket; names that would share a path keep their rows apart."""
    path = scratch(spark, "split_export")
    region = F.when(F.col("region") == "ASIA", "AFRI_CA").when(F.col("region") == "AFRICA", "AFRI CA")
    rows = W.tidy(W.temporal_split(stored_panel(spark, sf), ORDERS))
    sinks.export_splits(rows.withColumn("region", F.coalesce(region, "region")), path, ORDERS)
    schema = "region string, priority string, day date, price bigint, split string, _bucket int"
    return spark.read.schema(schema).option("header", True).csv(path).drop("_bucket")


@query("select region, priority, day, price from op where region <> 'EUROPE' union all "
       "select region, priority, day, price from op where region = 'ASIA'")
def append_and_replace(spark, sf):
    path, panel = scratch(spark, "append"), stored_panel(spark, sf)
    sinks.append(panel, path)
    sinks.replace(panel.filter(F.col("region") != "EUROPE"), path)
    sinks.append(panel.filter(F.col("region") == "ASIA"), path)
    return tables.scan_panel(spark, path, ORDERS)


@query("select region, priority, day, price from op where not (region = 'ASIA' and priority = '5-LOW')")
def series_folder(spark, sf):
    """Delimited files named by series, read back; one series has an unreadable price and drops whole."""
    path, panel = scratch(spark, "series"), order_panel(spark, sf)
    broken = (F.col("region") == "ASIA") & (F.col("priority") == "5-LOW") & (F.day("day") % 2 == 1)
    text = F.when(broken, F.lit("kosong")).otherwise(F.col("price").cast("string"))
    out = panel.select(F.col("day").alias("date"), text.alias(" price "),
                       F.concat_ws("_", "region", "priority").alias("series"))
    out.hint("rebalance", "series").write.partitionBy("series").option("header", True).csv(path)
    return files.load_series_folder(spark, path, ORDERS, in_folders=True).rows


@query("""select region, priority, day,
  case when day(day) % 4 = 0 then null else price::double end as price
from op where day(day) <> 31 and region <> 'AFRICA' and (region, priority) in
  (select (region, priority) from op where day(day) <> 31 group by region, priority having count(*) >= 500)""")
def training_folder(spark, sf):
    """The tolerant load: other header names, D/M/Y and unreadable dates, unknown keys, unreadable prices,
    short series."""
    path, panel = scratch(spark, "series"), order_panel(spark, sf)
    text = F.when(F.day("day") % 4 == 0, F.lit("-")).otherwise(S.rupiah(F.col("price")))
    day = F.when(F.day("day") == 31, F.lit("31/02/2000")).otherwise(F.date_format("day", "d/M/yyyy"))
    out = panel.select(day.alias("Tgl Laporan"), F.substr(text, F.lit(3)).alias("Harga (Rp)"),
                       F.concat_ws("_", "region", "priority").alias("series"))
    out.hint("rebalance", "series").write.partitionBy("series").option("header", True).csv(path)
    dims = {"region": regions(spark, sf).filter(F.col("name") != "AFRICA"), "priority": priorities(spark, sf)}
    return files.load_training_folder(spark, path, dims, ORDERS, min_rows=500, in_folders=True,
                                      date_formats=["d/M/yyyy"]).rows


@query("""select region, priority, case when region = 'AFRICA' then 'unknown name'
  when count(*) < 520 then 'too short' end as reason,
  case when region = 'AFRICA' then 0 else count(*) end as n_rows from op group by region, priority""")
def folder_counters(spark, sf):
    path, panel = scratch(spark, "series"), order_panel(spark, sf)
    out = panel.select(F.col("day").alias("Tanggal"), F.col("price").alias("PRICE"),
                       F.concat_ws("_", "region", "priority").alias("series"))
    out.hint("rebalance", "series").write.partitionBy("series").option("header", True).csv(path)
    dims = {"region": regions(spark, sf).filter(F.col("name") != "AFRICA"), "priority": priorities(spark, sf)}
    load = files.load_training_folder(spark, path, dims, ORDERS, min_rows=520, in_folders=True)
    return load.files.select("region", "priority", "reason", "n_rows")


@query(NAIVE_SQL + """select 'run-1' as run_id, name, value from (select """ + METRICS_SQL + """) t
unpivot (value for name in (mape, rmse, mae))""")
def logged_metrics(spark, sf):
    path = scratch(spark, "metrics")
    naive = E.naive_forecast(stored_panel(spark, sf), ORDERS)
    sinks.append_metrics(_rounded(E.error_metrics(naive, "price", "prediction")).drop("n"), path, "run-1")
    return spark.read.parquet(path).select("run_id", "name", "value")


# --- forecasts ----------------------------------------------------------------------------------

def rollout_sql(source: str, horizon: int) -> str:
    score = " + ".join(["0.0::double", *[f"{w}::double * win[{i + 1}]" for i, w in enumerate(WEIGHTS)]])
    return f"""
, sc as (select min(price)::double as vmin, max(price)::double as vmax from {source}),
start as (
  select region, priority, max(day) as last_day, arg_max(price, day)::double as last_price,
         list((price - vmin) / (vmax - vmin) order by day) as win
  from (select * from {source} qualify row_number() over (partition by region, priority order by day desc) <= 7), sc
  group by region, priority having count(*) = 7),
roll as (
  select region, priority, last_day, last_price, win, 0 as step, 0.0::double as p from start
  union all
  select region, priority, last_day, last_price, list_append(win[2:], q) as win, step + 1 as step, q as p
  from (select *, {score} as q from roll where step < {horizon})),
days as (
  select region, priority, {horizon} as durasi, last_day as tanggal_terakhir, last_price as harga_terakhir,
         step, (last_day + to_days(step))::date as day,
         cast(round_even(p * (vmax - vmin) + vmin, 0) as bigint) as price
  from roll, sc where step > 0)"""


def _rolled(spark: SparkSession, sf: str, horizon: int, before: str | None = None) -> DataFrame:
    panel = stored_panel(spark, sf)
    if before:
        panel = panel.filter(F.col("day") < F.lit(before).cast("date"))
    requests = forecasts.every_series(panel, horizon, ORDERS)
    return forecasts.forecast(panel, requests, WEIGHTS, E.fit_scaler(panel, "price"), spec=ORDERS)


@query(rollout_sql("op", 14) + " select * from days")
def forecast_rollout(spark, sf):
    return forecast_rows(_rolled(spark, sf, 14), ORDERS)


@query(rollout_sql("op", 5) + """ select region, priority, durasi, harga_terakhir,
  strftime(tanggal_terakhir, '%Y-%m-%d') as tanggal_terakhir,
  string_agg(strftime(day, '%Y-%m-%d') || '=' || price, ';' order by step) as data from days group by all""")
def forecast_responses(spark, sf):
    nested = forecast_nested(_rolled(spark, sf, 5), ORDERS)
    text = F.transform("data", lambda d: F.concat(d["day"], F.lit("="), d["price"].cast("string")))
    return nested.withColumn("data", F.array_join(text, ";"))


@query(rollout_sql("op", 7) + """ select region, priority, durasi || ' Hari' as durasi, step,
  strftime(day, '%Y-%m-%d') as tanggal_prediksi, 'Rp ' || replace(format('{:,}', price), ',', '.') as harga_prediksi
from days""")
def rupiah_report(spark, sf):
    return forecasts.report(_rolled(spark, sf, 7), ORDERS)


@query(", past as (select * from op where day < date '2001-06-01')" + rollout_sql("past", 30) + """
select days.*, op.price as aktual from days left join op using (region, priority, day)""")
def forecast_vs_actual(spark, sf):
    rows = forecast_rows(_rolled(spark, sf, 30, before="2001-06-01"), ORDERS)
    return J.with_actual(rows, stored_panel(spark, sf), ORDERS)


@query()
def glm_holdout(spark, sf):
    """Holdout errors per series of a model fitted on the train part."""
    return training.train(gappy_panel(spark, sf), ORDERS).metrics_by_series


@query()
def glm_forecast(spark, sf):
    """Seven days ahead for every series, by a model fitted on the same panel."""
    panel = stored_panel(spark, sf)
    run = training.train(panel, ORDERS, spline=False)
    requests = forecasts.every_series(panel, 7, ORDERS)
    return forecast_rows(forecasts.forecast_with(run.model, panel, requests, run.scaler, spec=ORDERS), ORDERS)


RUN_SQL = """
, cleaned as (select region, priority, day, round_even(price / 100.0::double, 0) * 100.0::double as price,
    row_number() over s as pos, count(*) over (partition by region, priority) as n
  from op window s as (partition by region, priority order by day)),
parts as (select *, case when pos <= floor(n * 0.7::double) then 'train' else 'test' end as split from cleaned where n >= 17),
sc as (select min(price) as vmin, max(price) as vmax from parts where split = 'train'),
win as (select region, priority, split, (price - vmin) / (vmax - vmin) as y,
    LAGS
  from parts, sc),
train as (select * from win where split = 'train' and lag_7 is not null),
scores as (
  select 'region' as name, region as level, count(*) as n, sum(y) as v from train group by region union all
  select 'priority', priority, count(*), sum(y) from train group by priority SUMS)
select 'score' as part, name, level, n, round(v, 3) as target, round(v, 3) as found from scores
union all select 'scaler', 'vmin', null, 1, vmin, vmin from sc
union all select 'scaler', 'vmax', null, 1, vmax, vmax from sc
union all select 'params', 'lag', null, 1, 7, 7
union all select 'params', 'split_ratio', null, 1, 0.7, 0.7
union all select 'params', 'total_features', null, 1, f, f from (
  select (7 + count(distinct region) + count(distinct priority))::double as f from train)
""".replace("LAGS", ", ".join(
                f"lag((price - vmin) / (vmax - vmin), {i}) over (partition by region, priority order by day) as lag_{i}"
                for i in range(7, 0, -1))).replace("SUMS", " ".join(
                    f"union all select 'lag_{i}', null, count(*), sum(y * lag_{i}) from train" for i in range(7, 0, -1)))


@query(RUN_SQL)
def trained_run(spark, sf):
    """A training run, logged and read back: parameters, scaler, and the score equations of the stored model. At the optimum of
    the likelihood, predictions and targets have the same sum at every key level and with every lag."""
    run = training.train(stored_panel(spark, sf), ORDERS, spline=False)
    registry = RunRegistry(spark, scratch(spark, "registry"))
    training.log_run(run, registry, "first")
    found = registry.current()
    scores = score_sums(predict_one_step(found.model, run.fitted.drop("prediction")), ORDERS)
    sums = [F.round(c, 3).alias(name) for c, name in (("target", "target"), ("predicted", "found"))]
    scores = scores.select(F.lit("score").alias("part"), F.col("term").alias("name"), "level", "n", *sums)
    value = F.col("value").cast("double")
    rest = found.scaler.unpivot([], ["vmin", "vmax"], "name", "value").select(F.lit("scaler").alias("part"), "name", value.alias("v"))
    rest = rest.unionByName(found.params.select(F.lit("params").alias("part"), "name", value.alias("v")))
    return scores.unionByName(rest.select("part", "name", F.lit(None).cast("string").alias("level"), F.lit(1).cast("long").alias("n"),
                                          F.col("v").alias("target"), F.col("v").alias("found")))
