"""The same results as plain SQL, for comparison in another engine.

``VIEWS`` are named building blocks; ``CHECKS`` hold one final query per key.
``sql(key)`` puts the blocks a query needs in front of it.
"""

from __future__ import annotations

import re

from checks import domain

_NAMES = {
    name: name
    for name in ("supplier", "part", "lineitem", "orders", "events", "coded_part", "company_count")
}

VIEWS: dict[str, str] = {
    "company_count": domain.COMPANY_COUNT.format(**_NAMES),
    "coded_part": domain.CODED_PART.format(**_NAMES),
    "division_lookup": domain.DIVISION_LOOKUP.format(**_NAMES),
    "gl_account": domain.GL_ACCOUNT.format(**_NAMES),
    "gl_transaction": domain.GL_TRANSACTION.format(**_NAMES),
    "invoice_dso": domain.INVOICE_DSO.format(**_NAMES),
    "financial_period": domain.FINANCIAL_PERIOD,
    "bookmarks": domain.BOOKMARKS.format(**_NAMES),
}

# ---------------------------------------------------------------- dimension
VIEWS["domestic"] = """
select * from division_lookup where eurocurrency = '1' and country like '%NL%'
"""
VIEWS["eligible"] = """
select division from domestic where allow_data_sharing is null or allow_data_sharing = 'True'
"""
VIEWS["sectors"] = """
select division, case when subsectorcode = '69' then 'M69' else sectorcode end as sectorcode
from domestic
"""

# ------------------------------------------------------------------- ledger
VIEWS["account_code"] = """
select id, division,
       substr(case when length(rgscode) >= 7 then rgscode else exactrgscode end, 1, 10) as rgscode
from gl_account
where length(rgscode) >= 7 or length(exactrgscode) >= 10
"""
VIEWS["current_tx"] = """
select * from (
  select *, row_number() over (partition by id order by sysmodified desc, x_sysingested desc,
             glaccount desc, amountdc desc, entrydate desc, type desc, x_isdeleted desc) as rn
  from gl_transaction)
where rn = 1 and x_isdeleted = 'N'
"""
VIEWS["tx_period"] = """
select *, case when substr(entrydate, 1, 7) < '1990-01' then '1989-12'
               else substr(entrydate, 1, 7) end as entryperiod,
       case when type = '310' then 'Y' else 'N' end as hastype310
from current_tx
where entrydate >= '1984-01-01' and entrydate < '2025-01-01'
"""
VIEWS["coded_tx"] = """
select a.division, t.entryperiod, a.rgscode, t.hastype310, t.amountdc
from tx_period t join account_code a on a.id = t.glaccount
"""
VIEWS["level4"] = """
select division, entryperiod, rgscode, hastype310,
       sum(amountdc) as amount, count(amountdc) as transactions
from coded_tx group by all
"""
VIEWS["ledger"] = """
select division, entryperiod, aggregate, cast(sum(amount) as double) as value,
       cast(sum(transactions) as bigint) as transactions,
       label || case when hastype310 = 'Y' then '-hastype310' else '' end as type
from (select *, substr(rgscode, 1, 7) as aggregate, 'RGSL3' as label from level4
      union all
      select *, substr(rgscode, 1, 4) as aggregate, 'RGSL2' as label from level4)
where (length(aggregate) = 7 and label = 'RGSL3') or (length(aggregate) = 4 and label = 'RGSL2')
group by division, entryperiod, aggregate, label, hastype310
"""

# ----------------------------------------------------------------- invoices
VIEWS["matches"] = """
select division, matchid, count(distinct uniqueinvoicenumber) as invoices,
       count(distinct paymentid) as payments
from invoice_dso where division is not null group by division, matchid
"""
VIEWS["good_invoices"] = """
select i.division, substr(i.paymententrydate, 1, 7) as entryperiod, i.atbip, i.paymentdays
from invoice_dso i join matches m on i.division = m.division and i.matchid = m.matchid
where m.payments = 1 and m.invoices >= 1 and i.paymentmethod = 'B' and i.atbip >= 0
"""
VIEWS["d2c"] = """
select division, entryperiod, aggregate, round(avg(atbip), 4) as value,
       count(*) as transactions, 'Days to Cash In' as type
from (select *, 'D2C_all' as aggregate from good_invoices
      union all select *, 'D2C_30d' from good_invoices where abs(paymentdays - 30) < 3
      union all select *, 'D2C_14d' from good_invoices where abs(paymentdays - 14) < 3)
group by division, entryperiod, aggregate
"""

# ----------------------------------------------------------------- measures
VIEWS["bad"] = """
select distinct division from (
  select division, aggregate from ledger where aggregate in ('BVrd', 'BLimKas')
  group by division, aggregate having sum(cast(value as decimal(28,2))) < -0.1)
"""
VIEWS["eligible_measures"] = """
select m.* from (select * from ledger union all select * from d2c) m
where m.division in (select division from eligible)
"""
VIEWS["measures"] = """
select * from eligible_measures where division not in (select division from bad)
"""

# -------------------------------------------------------------- company KPIs
VIEWS["open_measures"] = "select distinct * from measures where type not like '%310'"
VIEWS["revenue"] = """
select division, entryperiod, cast(-sum(cast(value as decimal(28,2))) as double) as value,
       'Revenue' as aggregate
from open_measures where aggregate in ('WOmz', 'WOvb') group by division, entryperiod
"""
VIEWS["cost"] = """
select division, entryperiod, cast(sum(cast(value as decimal(28,2))) as double) as value,
       'Cost' as aggregate
from open_measures where aggregate in ('WPer', 'WBed', 'WKpr', 'WAfs', 'WFbe')
group by division, entryperiod
"""
VIEWS["profitability"] = """
select r.division, r.entryperiod, (r.value - c.value) / nullif(r.value, 0) as value,
       'Profitability' as aggregate
from revenue r join cost c on r.division = c.division and r.entryperiod = c.entryperiod
"""
VIEWS["cash_position"] = """
select division, entryperiod,
       cast(sum(cast(value as decimal(28,2))) over (
         partition by division order by entryperiod
         rows between 10000 preceding and current row) as double) as value,
       'CashFlowPosition' as aggregate
from open_measures where aggregate = 'BLim'
"""
VIEWS["cash_monthly"] = """
select division, entryperiod, cast(sum(cast(value as decimal(28,2))) as double) as value,
       'CashFlowMonthly' as aggregate
from open_measures where aggregate = 'BLim' group by division, entryperiod
"""
VIEWS["kpis"] = """
select * from (
  select * from revenue union all select * from cost union all select * from profitability
  union all select * from cash_position union all select * from cash_monthly
  union all select division, entryperiod, value, aggregate from open_measures
            where aggregate in ('D2C_30d', 'D2C_14d', 'D2C_all'))
where value is not null and entryperiod >= '1995-01' and entryperiod < '2001-11'
"""
VIEWS["profiled_kpis"] = """
select k.*, d.sectorcode, d.group_id, d.size_of_merged_group
from kpis k join domestic d on d.division = k.division
"""

# ----------------------------------------------------------- power transform
# Companies without a sector are one group.
VIEWS["d2c_kpis"] = """
select * replace (coalesce(sectorcode, '-') as sectorcode)
from profiled_kpis where aggregate like 'D2C%'
"""
VIEWS["grid"] = "select unnest(range(-1280, 1281)) as g"


def _transform(x: str, lam: str) -> str:
    # Next to the logarithmic cases a power minus one has no digits left.
    return (
        f"case when {x} >= 0 then case when abs({lam}) < 1e-7 then ln({x} + 1)"
        f" else (pow({x} + 1, {lam}) - 1) / {lam} end"
        f" else case when abs(2 - {lam}) < 1e-7 then -ln(1 - {x})"
        f" else -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) end end"
    )


# Days are never negative, so one power is enough. Every exponent is tried; powers are taken
# of the ratio to the group's largest (negative exponents: smallest) value, as plain ones
# overflow. The added constant of the transform moves no variance.
VIEWS["day_ratios"] = """
select *, ln(1 + value) as size, max(ln(1 + value)) over w as high, min(ln(1 + value)) over w as low
from d2c_kpis window w as (partition by entryperiod, aggregate, sectorcode)
"""
VIEWS["scored"] = """
select entryperiod, aggregate, sectorcode, g, count(*) as n,
       case when max(high) = min(low) then 0
            else var_pop(case when g = 0 then size
                              when g > 0 then exp(g / 20.0 * (size - high)) / (g / 20.0)
                              else exp(g / 20.0 * (size - low)) / (g / 20.0) end) end as variance,
       2 * g / 20.0 * max(case when g > 0 then high else low end) as log_scale,
       sum(size) as jacobian
from day_ratios, grid where g / 20.0 * high <= 600
group by entryperiod, aggregate, sectorcode, g
"""
VIEWS["likelihood"] = """
select *, lag(llf) over w as before_llf, lead(llf) over w as after_llf,
       row_number() over (partition by entryperiod, aggregate, sectorcode
                          order by llf desc nulls last, g) as best
from (select *, case when variance > 0 then
             -n / cast(2 as double) * (ln(variance) + log_scale) + (cast(g as double) / 20 - 1) * jacobian
             end as llf from scored)
window w as (partition by entryperiod, aggregate, sectorcode order by g)
"""
VIEWS["exponents"] = """
select entryperiod, aggregate, sectorcode, cast(n as double) as length,
       case when llf is null then cast(1 as double)
            when before_llf - 2 * llf + after_llf < 0 then
              (g + (before_llf - after_llf) / (2 * (before_llf - 2 * llf + after_llf)))
              / cast(20 as double)
            else g / cast(20 as double) end as lam
from likelihood where best = 1
"""
VIEWS["transformed"] = f"""
select k.*, e.lam, e.length, {_transform('k.value', 'e.lam')} as value_t
from d2c_kpis k join exponents e using (entryperiod, aggregate, sectorcode)
"""

# ---------------------------------------------------------- monthly outliers
VIEWS["sized_kpis"] = """
select *, count(division) over (partition by entryperiod, group_id, aggregate) as group_size
from profiled_kpis
"""
VIEWS["sortable_kpis"] = """
select s.*, case when s.aggregate like 'D2C%' then t.value_t else s.value end as sort_value,
       case when s.aggregate like 'D2C%' then 'sector ' || s.sectorcode
            else 'group ' || coalesce(cast(s.group_id as varchar), '-') end as peer
from sized_kpis s left join transformed t
  on s.division = t.division and s.entryperiod = t.entryperiod and s.aggregate = t.aggregate
"""
# The transform is increasing; by plain values, ranks stay apart where doubles run out of digits.
VIEWS["ranked_kpis"] = """
select *, percent_rank() over (partition by entryperiod, aggregate, peer
                               order by value) as percentile
from sortable_kpis
"""
VIEWS["fenced_kpis"] = """
select *, coalesce(q3 - q1, 0) as iqr from (
  select *, max(case when percentile < 0.25 then sort_value end) over w as q1,
         min(case when percentile > 0.75 then sort_value end) over w as q3
  from ranked_kpis window w as (partition by entryperiod, aggregate, peer))
"""
VIEWS["flagged_kpis"] = """
select *, case when too_small or sort_value > q3 + 1.5 * iqr or sort_value < q1 - 1.5 * iqr
               then 'Y' else 'N' end as is_1point5_iqr_outlier,
       case when too_small or sort_value > q3 + 3.0 * iqr or sort_value < q1 - 3.0 * iqr
               then 'Y' else 'N' end as is_3point0_iqr_outlier
from (select *, group_size < 5 and aggregate not like 'D2C%' as too_small from fenced_kpis)
"""

# -------------------------------------------------------------- sector KPIs
VIEWS["average_rows"] = """
select division, entryperiod, 'd2c_30d_mean' as kpi, 'days' as unit, value
from flagged_kpis where aggregate = 'D2C_30d' and is_1point5_iqr_outlier = 'N'
union all
select division, entryperiod, 'positive_cash_flow_position', 'percent',
       case when value > 10000 then 100.0 else 0.0 end
from flagged_kpis where aggregate = 'CashFlowPosition' and is_3point0_iqr_outlier = 'N'
union all
select division, entryperiod, 'positive_cash_flow_monthly', 'percent',
       case when value > 0 then 100.0 else 0.0 end
from flagged_kpis where aggregate = 'CashFlowMonthly' and is_3point0_iqr_outlier = 'N'
"""
VIEWS["average_members"] = """
select a.*, s.sectorcode from average_rows a join sectors s on a.division = s.division
"""
VIEWS["sector_means"] = """
select entryperiod, 'ALL' as sectorcode, kpi, avg(value) as value, count(value) as population, unit
from average_members group by entryperiod, kpi, unit
union all
select entryperiod, sectorcode, kpi, avg(value), count(value), unit
from average_members group by entryperiod, sectorcode, kpi, unit
"""
VIEWS["good_revenue"] = """
select division, entryperiod, value from flagged_kpis
where aggregate = 'Revenue' and is_3point0_iqr_outlier = 'N'
"""
VIEWS["growth"] = """
select now.division, now.entryperiod, now.value as revenue, ago.value as lastyear_revenue
from good_revenue now join good_revenue ago
  on ago.division = now.division
 and ago.entryperiod = cast(cast(substr(now.entryperiod, 1, 4) as int) - 1 as varchar)
                       || '-' || substr(now.entryperiod, 6, 2)
"""
VIEWS["growth_members"] = """
select g.*, s.sectorcode from growth g join sectors s on g.division = s.division
"""


def _growth(sector: str, group_by: str) -> str:
    now, ago = (
        f"cast(sum(cast({c} as decimal(28,2))) as double)"
        for c in ("revenue", "lastyear_revenue")
    )
    return (
        f"select entryperiod, {sector} as sectorcode, 'total_growth_lastyear' as kpi,"
        f" ({now} - {ago}) / nullif({ago}, 0) * 100.0 as value,"
        f" count(division) as population, 'percent' as unit"
        f" from growth_members group by {group_by}"
    )


VIEWS["sector_growth"] = (
    _growth("'ALL'", "entryperiod")
    + " union all "
    + _growth("sectorcode", "entryperiod, sectorcode")
)
VIEWS["points"] = """
select entryperiod, sectorcode, kpi, round(value, 4) as value, population, unit
from (select * from sector_means union all select * from sector_growth)
where entryperiod >= '1995-01' and entryperiod <= '2001-10'
"""
VIEWS["full_grid"] = """
select * from (select distinct entryperiod from points), (select distinct sectorcode from points),
              (select distinct kpi from points)
"""
VIEWS["dense_points"] = """
select g.entryperiod, g.sectorcode, g.kpi, p.value, p.population, p.unit
from full_grid g left join points p
  on p.entryperiod = g.entryperiod and p.sectorcode = g.sectorcode and p.kpi = g.kpi
where g.entryperiod <= '2001-08'
"""

# ----------------------------------------------------------------- seasonal
_SECTORS = "('ALL', 'G', 'F', 'I', 'N', 'M69', 'C')"
VIEWS["published"] = f"""
select * from dense_points where sectorcode in {_SECTORS}
  and kpi in ('total_growth_lastyear', 'positive_cash_flow_monthly',
              'positive_cash_flow_position', 'd2c_30d_mean')
"""
VIEWS["months"] = """
select sectorcode, kpi, strftime(unnest(generate_series(
         cast(min(entryperiod) || '-01' as timestamp), cast(max(entryperiod) || '-01' as timestamp),
         interval 1 month)), '%Y-%m') as entryperiod
from published group by sectorcode, kpi
"""
VIEWS["calendar"] = """
select m.sectorcode, m.kpi, m.entryperiod, p.value, p.population, p.unit,
       row_number() over (partition by m.sectorcode, m.kpi order by m.entryperiod) as pos
from months m left join published p using (sectorcode, kpi, entryperiod)
"""
VIEWS["neighbours"] = """
select c.*,
       (select max(pos) from calendar l where l.sectorcode = c.sectorcode and l.kpi = c.kpi
          and l.pos <= c.pos and l.value is not null) as left_pos,
       (select min(pos) from calendar r where r.sectorcode = c.sectorcode and r.kpi = c.kpi
          and r.pos >= c.pos and r.value is not null) as right_pos
from calendar c
"""
VIEWS["filled"] = """
select n.*, case when n.value is not null then n.value
                 when r.value is null then l.value
                 else l.value + (r.value - l.value) / (n.right_pos - n.left_pos)
                                * (n.pos - n.left_pos) end as filled
from neighbours n
left join calendar l on l.sectorcode = n.sectorcode and l.kpi = n.kpi and l.pos = n.left_pos
left join calendar r on r.sectorcode = n.sectorcode and r.kpi = n.kpi and r.pos = n.right_pos
"""
VIEWS["history"] = """
select * from (select *, row_number() over (partition by sectorcode, kpi
                                            order by entryperiod desc) as age from filled)
where age <= 60
"""
VIEWS["detrended"] = """
select *, avg(seasonal_part) over (partition by sectorcode, kpi, calendar_month) as month_mean
from (
  select *, substr(entryperiod, 6, 2) as calendar_month,
         count(filled) over (partition by sectorcode, kpi) as points,
         filled - (case when count(filled) over around = 11 then sum(filled) over around end
                   + (lag(filled, 6) over w + lead(filled, 6) over w) / 2) / 12 as seasonal_part
  from history
  window w as (partition by sectorcode, kpi order by entryperiod),
         around as (partition by sectorcode, kpi order by entryperiod
                    rows between 5 preceding and 5 following))
"""
VIEWS["levels"] = """
select sectorcode, kpi, avg(month_mean) as level
from (select distinct sectorcode, kpi, calendar_month, month_mean from detrended)
group by sectorcode, kpi
"""
VIEWS["adjusted"] = """
select d.*, case when points >= 24 then filled - (month_mean - level) end as adjusted
from detrended d join levels l on l.sectorcode = d.sectorcode and l.kpi = d.kpi
"""
VIEWS["henderson"] = """
select * from (values (-6, -0.01935::double), (-5, -0.02786), (-4, 0.0), (-3, 0.06549),
  (-2, 0.14736), (-1, 0.21434), (0, 0.24006), (1, 0.21434), (2, 0.14736), (3, 0.06549),
  (4, 0.0), (5, -0.02786), (6, -0.01935)) t(d, w)
"""
VIEWS["trends"] = """
select a.sectorcode, a.kpi, a.pos, sum(b.adjusted * w) / sum(w) as trend
from adjusted a, henderson h, adjusted b
where b.sectorcode = a.sectorcode and b.kpi = a.kpi and b.pos = a.pos + d
  and a.adjusted is not null and b.adjusted is not null
group by a.sectorcode, a.kpi, a.pos
"""
VIEWS["series"] = """
select a.entryperiod, a.sectorcode, a.kpi, a.unit, a.population, a.value,
       a.adjusted as deseasonalizedvalue, t.trend as trendvalue
from adjusted a left join trends t using (sectorcode, kpi, pos)
where a.age <= 39
"""


# Weekdays are counted day by day, and six effects eliminated one after the other.
VIEWS["t_days"] = """
select strftime(day, '%Y-%m') as month, d,
       (count(*) filter (isodow(day) = d) - count(*) filter (isodow(day) = 7))::double as x
from (select unnest(generate_series(cast(min(entryperiod) || '-01' as timestamp) - interval 13 month,
             cast(max(entryperiod) || '-01' as timestamp) + interval 1 month, interval 1 day)) as day
      from history), range(1, 7) t(d)
group by all
"""
VIEWS["t_dx"] = """
select strftime(cast(month || '-01' as timestamp) + to_months(behind::int), '%Y-%m') as month, d, sum(sign * x) as x
from t_days, (values (0, 1), (1, -1), (12, -1), (13, 1)) t(behind, sign)
group by all having count(*) = 4
"""
VIEWS["t_dy"] = """
select sectorcode, kpi, entryperiod as month,
       filled - lag(filled) over w - lag(filled, 12) over w + lag(filled, 13) over w as y
from history window w as (partition by sectorcode, kpi order by entryperiod)
"""
VIEWS["t_step0"] = """
select sectorcode, kpi, a.d as i, b.d as j, sum(a.x * b.x) as v
from t_dy join t_dx a using (month) join t_dx b using (month) where y is not null
group by sectorcode, kpi, a.d, b.d
union all
select sectorcode, kpi, d, 7, sum(x * y) from t_dy join t_dx using (month) where y is not null
group by sectorcode, kpi, d
"""
for _k in range(1, 7):
    VIEWS[f"t_step{_k}"] = f"""
    select sectorcode, kpi, i, j,
           case when i = {_k} then v / top else v - in_column * in_row / top end as v
    from (
      select *, max(case when i = {_k} and j = {_k} and v > 1e-6 then v end) over (partition by sectorcode, kpi) as top,
             max(case when j = {_k} then v end) over (partition by sectorcode, kpi, i) as in_column,
             max(case when i = {_k} then v end) over (partition by sectorcode, kpi, j) as in_row
      from t_step{_k - 1})
    """
VIEWS["t_part"] = """
select sectorcode, kpi, month as entryperiod, sum(v * x) as part
from t_step6 join t_days on d = i where j = 7
group by all having count(v) = 6
"""
# The moving season joins each month to its neighbours by distance and weight.
VIEWS["year_mean"] = """
select d, case when abs(d) = 6 then 0.5 else 1.0 end::double / 12 as w from range(-6, 7) t(d)
"""
VIEWS["same_month"] = """
select f, s * y * 12 as d, w::double as w
from (values ('short', 0, 3), ('short', 1, 2), ('short', 2, 1),
             ('long', 0, 3), ('long', 1, 3), ('long', 2, 2), ('long', 3, 1)) t(f, y, w),
     (values (1), (-1)) u(s) where y > 0 or s = 1
"""
VIEWS["ends"] = """
select ahead, d, h.w + lost / n + (d - middle) * tilt * slope / (1 + n * (n - 1) * (n + 1) / 12.0 * slope) as w
from henderson h, (
  select ahead, 7 + ahead as n, (ahead - 6) / 2.0::double as middle, 4 / (pi() * 3.5 * 3.5) as slope,
         (select coalesce(sum(w), 0) from henderson where d > ahead) as lost,
         (select coalesce(sum((d - (ahead - 6) / 2.0::double) * w), 0) from henderson where d > ahead) as tilt
  from range(0, 7) t(ahead))
where d <= ahead
"""
VIEWS["m_start"] = """
select sectorcode, kpi, entryperiod, row_number() over (partition by sectorcode, kpi order by entryperiod) as pos,
       case when count(filled) over (partition by sectorcode, kpi) >= 24 then filled end as x
from history
"""


def _mean_of_year(name: str, source: str, column: str) -> None:
    """``name``: the 2x12 mean of ``column`` where all its months exist."""
    VIEWS[name] = f"""
select a.sectorcode, a.kpi, a.pos, sum(b.{column} * w) as mean
from {source} a, year_mean y, {source} b
where b.sectorcode = a.sectorcode and b.kpi = a.kpi and b.pos = a.pos + d
group by a.sectorcode, a.kpi, a.pos having count(b.{column}) = 13
"""


def _season_of(name: str, source: str, kind: str, weight: str = "1.0") -> None:
    """``name``: weighted mean of ``si`` over the same month of other years, less the nearest yearly mean."""
    VIEWS[f"{name}_raw"] = f"""
select a.*, s.raw from {source} a left join (
  select a.sectorcode, a.kpi, a.pos, coalesce(
           case when sum(w * {weight}) > 0 then sum(w * {weight} * b.si) / sum(w * {weight}) end,
           sum(w * b.si) / sum(w)) as raw
  from {source} a, same_month m, {source} b
  where f = '{kind}' and b.sectorcode = a.sectorcode and b.kpi = a.kpi and b.pos = a.pos + d and b.si is not null
  group by a.sectorcode, a.kpi, a.pos) s using (sectorcode, kpi, pos)
"""
    _mean_of_year(f"{name}_level", f"{name}_raw", "raw")
    VIEWS[name] = f"""
select r.* exclude (raw), raw - coalesce((
    select arg_min(l.mean, (abs(l.pos - r.pos), l.pos > r.pos))
    from {name}_level l where l.sectorcode = r.sectorcode and l.kpi = r.kpi), 0) as season
from {name}_raw r
"""


def _usual_of(name: str, source: str, irregular: str) -> None:
    """``name``: ``source`` and ``u``, ``x`` with extremes brought in by a moving deviation taken twice."""
    VIEWS[name] = f"""
select * exclude (irregular, spread_1, spread_2),
  case when spread_2 is null or spread_2 = 0 or irregular is null then 1.0
       when abs(irregular) >= 2.5 * spread_2 then 0.0
       when abs(irregular) > 1.5 * spread_2 then 2.5 - abs(irregular) / spread_2 else 1.0 end::double as e,
  x - coalesce(irregular * (1 - e), 0) as u
from (select *, sqrt(avg(irregular * irregular) filter (abs(irregular) <= 2.5 * spread_1) over near) as spread_2
  from (select *, sqrt(avg(irregular * irregular) over near) as spread_1
    from (select *, {irregular} as irregular from {source})
    window near as (partition by sectorcode, kpi order by entryperiod rows between 30 preceding and 30 following))
  window near as (partition by sectorcode, kpi order by entryperiod rows between 30 preceding and 30 following))
"""


def _trend_of(name: str, source: str, column: str) -> None:
    """``name``: Henderson trend of ``column``, mirrored weights at the start."""
    VIEWS[name] = f"""
select a.sectorcode, a.kpi, a.pos, sum(b.{column} * w) as trend
from (select *, count({column}) over (partition by sectorcode, kpi order by pos rows between 6 preceding and 1 preceding) as behind,
             count({column}) over (partition by sectorcode, kpi order by pos rows between 1 following and 6 following) as ahead
      from {source}) a, ends h, {source} b
where a.{column} is not null and b.{column} is not null and b.sectorcode = a.sectorcode and b.kpi = a.kpi
  and ((a.ahead < 6 and h.ahead = a.ahead and b.pos = a.pos + d)
    or (a.ahead = 6 and h.ahead = a.behind and b.pos = a.pos - d))
group by a.sectorcode, a.kpi, a.pos
"""


_mean_of_year("m_mean1", "m_start", "x")
VIEWS["m_si1"] = "select m.*, x - mean as si from m_start m left join m_mean1 using (sectorcode, kpi, pos)"
VIEWS["m_middle"] = """
select *, median(si) over (partition by sectorcode, kpi, substr(entryperiod, 6, 2)) as middle from m_si1
"""
_usual_of("m_bent", "m_middle", "si - middle")
VIEWS["m_clean"] = "select * exclude (u, middle) from m_bent"
_season_of("m_season1b", "m_clean", "short", "b.e")
VIEWS["m_again"] = "select * exclude (e) from m_season1b"
_usual_of("m_usual1", "m_again", "si - season")
_mean_of_year("m_mean2", "m_usual1", "u")
VIEWS["m_si2"] = """
select m.* exclude (si, season, e), u - mean as si from m_usual1 m left join m_mean2 using (sectorcode, kpi, pos)
"""
_season_of("m_season2", "m_si2", "short")
VIEWS["m_sa2"] = "select *, u - season as sa from m_season2"
_trend_of("m_trend2", "m_sa2", "sa")
VIEWS["m_rest"] = """
select m.* exclude (si, u, sa), trend from m_sa2 m left join m_trend2 using (sectorcode, kpi, pos)
"""
_usual_of("m_usual2", "m_rest", "x - season - trend")
VIEWS["m_si3"] = "select * exclude (season, trend), u - trend as si from m_usual2"
_season_of("m_season3", "m_si3", "long")
VIEWS["m_adjusted"] = "select *, x - season as adjusted, u - season as smooth from m_season3"
_trend_of("m_trend3", "m_adjusted", "smooth")

# ----------------------------------------------------------------- elements
VIEWS["fiscal_years"] = """
select division, finyear, min(startdate) as startdate, max(enddate) as enddate
from financial_period group by division, finyear
"""
VIEWS["spine_months"] = """
select strftime(unnest(generate_series(timestamp '1996-12-01', timestamp '2001-12-01',
                                       interval 1 month)), '%Y-%m') as entryperiod
"""
VIEWS["fiscal_spine"] = """
select f.division, m.entryperiod, f.finyear
from fiscal_years f join spine_months m
  on cast(m.entryperiod || '-01' as date) between f.startdate and f.enddate
"""
VIEWS["element_rows"] = """
select * from measures where not (aggregate like 'W%' and type like '%310%')
"""
VIEWS["spine"] = """
select * from fiscal_spine where division in (select division from element_rows)
"""
VIEWS["element_codes"] = """
select * from (values
  ('Revenues-C', 'PL', 'WOmz'), ('Revenues-C', 'PL', 'WOvb'), ('EmployeeCosts-D', 'PL', 'WPer'),
  ('CostOfGoods-D', 'PL', 'WKpr'), ('AccountReceivables-D', 'BS', 'BVorDeb'),
  ('Stock-D', 'BS', 'BVrd'), ('WorkInProgress-D', 'BS', 'BPro'), ('Bank-D', 'BS', 'BLimBan'),
  ('Bank-D', 'BS', 'BLimKru'), ('Cash-D', 'BS', 'BLimKas'), ('TaxToClaim-D', 'BS', 'BVorBtw'),
  ('OtherReceivables-D', 'BS', 'BVorOvr'), ('OtherReceivables-D', 'BS', 'BVorOva'),
  ('Securities-D', 'BS', 'BEff'), ('AccountPayables-C', 'BS', 'BSchCre'),
  ('Equity-C', 'BS', 'BEiv'), ('Provisions-C', 'BS', 'BVrz'), ('LongtermDebt-C', 'BS', 'BLas'),
  ('TaxToPay-C', 'BS', 'BSchBtw'), ('TaxToPay-C', 'BS', 'BSchVpb'),
  ('TaxToPay-C', 'BS', 'BSchOvb'), ('OtherDebts-C', 'BS', 'BSchKol'),
  ('OtherDebts-C', 'BS', 'BSchSav'), ('OtherDebts-C', 'BS', 'BSchSal'),
  ('OtherDebts-C', 'BS', 'BSchLhe'), ('OtherDebts-C', 'BS', 'BSchOvs'),
  ('OtherDebts-C', 'BS', 'BSchOpa')) t(element, statement, code)
"""
VIEWS["element_names"] = """
select distinct element, statement from element_codes union all select 'NetIncome-C', 'PL'
"""
VIEWS["element_months"] = """
select division, entryperiod, element, sum(cast(value as decimal(28,2))) as value,
       sum(case when type like '%310%' then -cast(value as decimal(28,2)) end) as reversed
from (select m.*, c.element from element_rows m join element_codes c on c.code = m.aggregate
      union all
      select m.*, 'NetIncome-C' from element_rows m
      where length(aggregate) = 4 and aggregate like 'W%')
group by division, entryperiod, element
"""
VIEWS["element_spine"] = """
select s.division, s.finyear, s.entryperiod, n.element, n.statement,
       coalesce(m.value, 0) as value, coalesce(m.reversed, 0) as reversed
from spine s cross join element_names n
left join element_months m on m.division = s.division and m.entryperiod = s.entryperiod
                          and m.element = n.element
"""
VIEWS["elements"] = """
select division, entryperiod, element,
       cast(case when statement = 'PL' then sum(value) over in_year
                 else sum(value) over to_date + sum(reversed) over in_year end as double)
         as cumvalue
from element_spine
window in_year as (partition by division, finyear, element order by entryperiod
                   rows between unbounded preceding and current row),
       to_date as (partition by division, element order by entryperiod
                   rows between unbounded preceding and current row)
"""

# ------------------------------------------------------------------- ratios
VIEWS["nonzero"] = """
select division, entryperiod, element, cast(cumvalue as decimal(28,2)) as v
from elements where cumvalue <> 0
"""


def _in(*names: str) -> str:
    return "element in (" + ", ".join(f"'{n}'" for n in names) + ")"


_QUICK = (
    "Bank-D", "AccountReceivables-D", "TaxToClaim-D", "OtherReceivables-D",
    "Securities-D", "AccountPayables-C", "TaxToPay-C", "OtherDebts-C",
)


def _ratio(kpi: str, rows: str, num: str, den: str, value: str) -> str:
    return f"""
select division, entryperiod, numerator, denominator, {value} as value, '{kpi}' as kpi
from (select division, entryperiod, cast(sum({num}) as double) as numerator,
             cast(sum({den}) as double) as denominator
      from {rows} group by division, entryperiod)
"""


def _simple(kpi: str, needed: str, num: str, den: str, value: str) -> str:
    return _ratio(
        kpi,
        f"(select * from nonzero where {needed})",
        f"case when {num} then v end",
        f"case when {den} then v end",
        value,
    )


_REVENUE = f"{_in('Revenues-C')} and v < 0"
VIEWS["employee_costs"] = _simple(
    "employee_costs", _in("Revenues-C", "EmployeeCosts-D"),
    f"{_in('EmployeeCosts-D')} and v > 0", _REVENUE,
    "case when numerator > 0 and denominator < 0 then numerator / denominator * -100 end",
)
VIEWS["receivable_days"] = _simple(
    "receivable_days", _in("Revenues-C", "AccountReceivables-D"),
    f"{_in('AccountReceivables-D')} and v > 0", _REVENUE,
    "case when numerator > 0 and denominator < 0 then numerator / denominator * -365 end",
)
VIEWS["gross_margin"] = _simple(
    "gross_margin", _in("Revenues-C", "CostOfGoods-D"), "true", _REVENUE,
    "case when denominator < 0 then 100.0 * numerator / denominator end",
)
VIEWS["roe"] = _simple(
    "roe", _in("NetIncome-C", "Equity-C"), _in("NetIncome-C"),
    f"{_in('Equity-C')} and v < 0",
    "case when denominator < 0 then 100 * numerator / denominator end",
)
VIEWS["inventory_turnover"] = _simple(
    "inventory_turnover", _in("CostOfGoods-D", "Stock-D"),
    f"{_in('CostOfGoods-D')} and v > 0", f"{_in('Stock-D')} and v > 0",
    "case when numerator > 0 and denominator > 0 then numerator / denominator end",
)
VIEWS["quick_ratio"] = _simple(
    "quick_ratio", _in("Cash-D", *_QUICK), "v > 0 or element = 'Cash-D'",
    "v < 0 and element <> 'Cash-D'",
    "case when denominator <> 0 then -1 * numerator / denominator end",
)
VIEWS["current_parts"] = f"""
select division, entryperiod, element, v from nonzero where {_in('Stock-D', 'WorkInProgress-D')}
union all select division, entryperiod, 'quick up', cast(numerator as decimal(28,2))
  from quick_ratio
union all select division, entryperiod, 'quick down', cast(denominator as decimal(28,2))
  from quick_ratio
"""
VIEWS["current_ratio"] = _ratio(
    "current_ratio", "current_parts",
    "case when element in ('quick up', 'Stock-D') or (element = 'WorkInProgress-D' and v > 0)"
    " then v end",
    "case when element = 'quick down' or (element = 'WorkInProgress-D' and v < 0) then v end",
    "case when denominator <> 0 then -1 * numerator / denominator end",
)
VIEWS["solvency_parts"] = f"""
select division, entryperiod, element, v from nonzero
where {_in('Equity-C', 'Provisions-C', 'LongtermDebt-C')}
union all select division, entryperiod, 'current down', cast(denominator as decimal(28,2))
  from current_ratio
"""
VIEWS["solvability"] = _ratio(
    "solvability", "solvency_parts",
    "case when element = 'Equity-C' and v < 0 then -v end",
    "case when element = 'current down' or"
    " (element in ('Provisions-C', 'LongtermDebt-C') and v < 0) then -v end",
    "case when denominator <> 0 then 100 * numerator / denominator end",
)
RATIO_NAMES = (
    "employee_costs", "receivable_days", "gross_margin", "roe",
    "inventory_turnover", "quick_ratio", "current_ratio", "solvability",
)
VIEWS["ratios"] = " union all ".join(f"select * from {r}" for r in RATIO_NAMES)
VIEWS["negative_flag"] = f"""
select distinct division, entryperiod from nonzero
where {_in('Stock-D', 'Cash-D')} and v < -0.1
"""
VIEWS["profiled_ratios"] = """
select r.*, d.group_id, d.size_of_merged_group, r.value is null as value_is_null,
       case when n.division is null then 'N' else 'Y' end as negative_stock_cash
from ratios r join domestic d on d.division = r.division
left join negative_flag n on n.division = r.division and n.entryperiod = r.entryperiod
"""
VIEWS["ranked_ratios"] = """
select *, percent_rank() over (partition by group_id, entryperiod, kpi, value_is_null,
            negative_stock_cash order by value nulls first) as percentile
from profiled_ratios
"""
VIEWS["ratio_fences"] = """
select group_id, entryperiod, kpi, value_is_null, negative_stock_cash, count(*) as group_size,
       max(case when percentile < 0.25 then value end) as q1,
       coalesce(min(case when percentile > 0.75 then value end),
                max(case when percentile < 0.25 then value end)) as q3
from ranked_ratios group by group_id, entryperiod, kpi, value_is_null, negative_stock_cash
"""
VIEWS["flagged_ratios"] = """
select *, case when group_size < 5 or value > q3 + 1.5 * iqr or value < q1 - 1.5 * iqr
                 or value_is_null or negative_stock_cash = 'Y' then 'Y' else 'N' end
            as is_1point5_iqr_outlier,
       case when group_size < 5 or value > q3 + 3.0 * iqr or value < q1 - 3.0 * iqr
                 or value_is_null or negative_stock_cash = 'Y' then 'Y' else 'N' end
            as is_3point0_iqr_outlier
from (select r.*, f.group_size, f.q1, f.q3, f.q3 - f.q1 as iqr
      from ranked_ratios r left join ratio_fences f
        on f.group_id = r.group_id and f.entryperiod = r.entryperiod and f.kpi = r.kpi
       and f.value_is_null = r.value_is_null
       and f.negative_stock_cash = r.negative_stock_cash)
"""
VIEWS["cube_members"] = """
select r.entryperiod, r.kpi, r.value, coalesce(d.sizedescription, 'Unknown') as sizedescription,
       coalesce(d.sectorcode, 'Unknown') as sectorcode,
       coalesce(d.subsectorcode, 'Unknown') as subsectorcode
from flagged_ratios r join domestic d on d.division = r.division
where r.is_3point0_iqr_outlier = 'N' and r.value is not null
"""


def _cube(value: str) -> str:
    return f"""
select entryperiod, sizedescription, sectorcode, subsectorcode, value, population, kpi,
       case when kpi = 'receivable_days' then 'days'
            when kpi in ('quick_ratio', 'inventory_turnover', 'current_ratio') then 'ratio'
            else 'percent' end as unit
from (
  select entryperiod, kpi, sectorcode,
         case when grouping(sizedescription) = 1 then 'ALL' else sizedescription end
           as sizedescription,
         case when grouping(subsectorcode) = 1 then 'ALL' else subsectorcode end
           as subsectorcode,
         {value} as value, count(value) as population
  from cube_members
  group by entryperiod, kpi, sectorcode, cube (sizedescription, subsectorcode))
where sizedescription <> 'Unknown' and sectorcode <> 'Unknown' and subsectorcode <> 'Unknown'
  and entryperiod <= '2001-08'
"""


VIEWS["median_cells"] = _cube("quantile_disc(value, 0.5)")
VIEWS["mean_cells"] = _cube("avg(value)")

# ------------------------------------------------------------------ serving
VIEWS["served_points"] = f"""
select kpi, sectorcode, entryperiod, value, population, unit, deseasonalizedvalue, trendvalue
from series where sectorcode in {_SECTORS} and sectorcode not in ('Unknown', '')
  and entryperiod >= '1998-09' and entryperiod < '2001-09'
"""
VIEWS["served_rows"] = """
select lower(sectorcode || '-' || kpi) as kpi_identifier, lower(sectorcode) as sectorcode, kpi,
       row_number() over (partition by sectorcode, kpi order by entryperiod) as position,
       count(*) over (partition by sectorcode, kpi) as points,
       entryperiod, round(value, 2) as value, cast(population as double) as population, unit,
       round(deseasonalizedvalue, 2) as deseasonalizedvalue, round(trendvalue, 2) as trendvalue
from served_points
"""
VIEWS["latest_cells"] = """
select * from median_cells where entryperiod = (select max(entryperiod) from median_cells)
"""
VIEWS["ratio_rows"] = """
select lower(kpi || '-' || sectorcode || '-' || subsectorcode || '-' || sizedescription)
         as kpi_identifier, lower(kpi) as kpi, lower(sectorcode) as sector,
       lower(subsectorcode) as subsector, lower(sizedescription) as companysize,
       round(value, 2) as value, cast(population as int) as population
from latest_cells where population > 3
"""
VIEWS["good_bookmarks"] = """
select *, row_number() over (partition by servicename order by updated desc, s3key desc) as age
from bookmarks where status = 'OK'
"""

# ------------------------------------------------------------------- checks
CHECKS: dict[str, str] = {}

_MEASURE = "division, entryperiod, aggregate, round(value, 4) as value, transactions, type"
CHECKS["scan_project"] = "select id, division, rgscode, exactrgscode from gl_account"
CHECKS["scan_partition_filter"] = """
select division, country, sectorcode, subsectorcode, sizedescription from domestic
"""
CHECKS["latest_snapshot"] = """
select cast(o_orderdate as date)::varchar as syscreated, o_orderkey, o_totalprice from orders
where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)
"""
CHECKS["scan_file_sample"] = """
select o_orderkey, o_totalprice, strftime(cast(o_orderdate as date), '%Y-%m') as month
from orders join (
  select month, row_number() over (order by md5('42:month=' || month || ':0')) as place,
         count(*) over () as months
  from (select distinct strftime(cast(o_orderdate as date), '%Y-%m') as month from orders)
) as ranked on strftime(cast(o_orderdate as date), '%Y-%m') = ranked.month
where place <= ceil(0.25 * months)
"""
CHECKS["scan_mixed_types"] = """
select l_orderkey, l_linenumber,
       cast(case when l_linenumber <= 2 then trunc(l_quantity) else round(l_quantity, 2) end as double)
         as amount
from lineitem
"""
CHECKS["table_round_trip"] = """
select id, division, rgscode, cast(null as varchar) as added from gl_account
"""
CHECKS["snapshot_round_trip"] = """
select uniqueinvoicenumber, 2 * atbip as atbip, paymentmethod from invoice_dso
where paymentmethod = 'B'
"""
CHECKS["account_code_choice"] = "select id, division, rgscode from account_code"
CHECKS["ledger_dedup"] = """
select id, type, entrydate, glaccount, cast(amountdc as double) as amountdc from current_tx
"""
CHECKS["ledger_period"] = """
select id, entrydate, case when substr(entrydate, 1, 7) < '1997-01' then '1996-12'
                           else substr(entrydate, 1, 7) end as entryperiod,
       case when type = '310' then 'Y' else 'N' end as hastype310
from current_tx where entrydate >= '1996-01-01' and entrydate < '2001-06-01'
"""
CHECKS["ledger_join"] = """
select division, entryperiod, rgscode, hastype310, cast(amount as double) as amount, transactions
from level4
"""
CHECKS["ledger_rollup"] = f"select {_MEASURE} from ledger"
CHECKS["dso_match_class"] = """
select division, matchid, invoices, payments,
       case when payments = 1 and invoices = 1 then 'single'
            when payments = 1 and invoices > 1 then 'multi' else 'unusable' end as match_class
from matches
"""
CHECKS["dso_by_term"] = f"select {_MEASURE} from d2c"
CHECKS["eligible_divisions"] = "select division from eligible"
CHECKS["consent_report"] = """
select count(*) filter (where allow_data_sharing = 'False') as refused, count(*) as divisions
from domestic
"""
CHECKS["raw_measures"] = f"select {_MEASURE} from measures"
CHECKS["bad_divisions"] = "select division from bad"
CHECKS["bad_division_filter"] = f"""
select {_MEASURE} from ledger where division not in (select division from bad)
"""
_KPI = "division, entryperiod, aggregate, round(value, 4) as value"
for _key, _names in {
    "kpi_revenue": "('Revenue')",
    "kpi_cost": "('Cost')",
    "kpi_profitability": "('Profitability')",
    "kpi_cash_flow_position": "('CashFlowPosition')",
    "kpi_cash_flow_monthly": "('CashFlowMonthly')",
    "kpi_d2c": "('D2C_30d', 'D2C_14d', 'D2C_all')",
}.items():
    CHECKS[_key] = f"select {_KPI} from kpis where aggregate in {_names}"
CHECKS["kpi_union"] = f"select {_KPI} from kpis"
CHECKS["kpi_repeated_measures"] = CHECKS["kpi_union"]
CHECKS["kpi_window"] = f"""
select {_KPI} from kpis where entryperiod >= '1997-01' and entryperiod < '2000-05'
"""
CHECKS["kpi_enriched"] = f"""
select {_KPI}, sectorcode, cast(group_id as double) as group_id, size_of_merged_group
from profiled_kpis
"""
CHECKS["yeo_johnson_lambda"] = """
select entryperiod, aggregate, sectorcode, round(lam, 3) as "lambda", length from exponents
"""
CHECKS["yeo_johnson_transform"] = """
select division, entryperiod, aggregate, round(value, 4) as value,
       sign(value_t) * round(ln(1 + abs(value_t)), 4) as value_t, length from transformed
"""


def _fence(column: str) -> str:
    # Powers of days can be of any size, so they are compared by their logarithm.
    return (
        f"case when aggregate like 'D2C%' then sign({column}) * round(ln(1 + abs({column})), 4)"
        f" else round({column}, 3) end as {column}"
    )


CHECKS["mkt_outlier"] = f"""
select division, entryperiod, aggregate, round(value, 4) as value, is_1point5_iqr_outlier,
       is_3point0_iqr_outlier, round(percentile, 6) as percentile,
       cast(group_id as double) as group_id,
       size_of_merged_group, group_size as size_of_group_per_period, {", ".join(map(_fence, ("q1", "q3", "iqr")))}
from flagged_kpis
"""
_POINT = "entryperiod, sectorcode, kpi, round(value, 4) as value, population, unit"
CHECKS["sector_override"] = "select division, sectorcode from sectors"
CHECKS["sector_kpi_mean"] = f"select {_POINT} from sector_means where kpi = 'd2c_30d_mean'"
CHECKS["sector_kpi_finite"] = CHECKS["sector_kpi_mean"]
CHECKS["sector_kpi_median"] = """
select entryperiod, 'ALL' as sectorcode, aggregate as kpi,
       round(quantile_disc(value, 0.5), 4) as value, count(*) as population, 'days' as unit
from flagged_kpis where aggregate like 'D2C%' group by entryperiod, aggregate
union all
select f.entryperiod, s.sectorcode, f.aggregate, round(quantile_disc(f.value, 0.5), 4), count(*),
       'days'
from flagged_kpis f join sectors s on s.division = f.division
where f.aggregate like 'D2C%' group by f.entryperiod, s.sectorcode, f.aggregate
"""
CHECKS["sector_kpi_exact_median"] = CHECKS["sector_kpi_median"]
CHECKS["sector_positive_cash"] = f"""
select {_POINT} from sector_means where kpi like 'positive_cash_flow%'
"""
CHECKS["revenue_yoy"] = """
select division, entryperiod, round(revenue, 2) as revenue,
       round(lastyear_revenue, 2) as lastyear_revenue from growth
"""
CHECKS["sector_total_growth"] = f"select {_POINT} from sector_growth"
CHECKS["sector_points"] = f"select {_POINT} from points"
CHECKS["kpi_densify"] = """
select entryperiod, sectorcode, kpi, round(value, 4) as value,
       cast(population as double) as population, unit from dense_points
"""
CHECKS["series_interpolate"] = """
select sectorcode, kpi, entryperiod, round(value, 4) as value, round(filled, 6) as filled
from filled
"""
CHECKS["series_tail"] = """
select sectorcode, kpi, entryperiod, round(filled, 6) as filled from history
"""
CHECKS["seasonal_adjust"] = """
select entryperiod, sectorcode, kpi, unit, cast(population as double) as population,
       round(value, 4) as value, round(deseasonalizedvalue, 4) as deseasonalizedvalue from series
"""
CHECKS["seasonal_trend"] = """
select entryperiod, sectorcode, kpi, round(trendvalue, 4) as trendvalue from series
"""
CHECKS["trading_day_effects"] = """
select entryperiod, sectorcode, kpi, round(coalesce(part, 0), 4) as tradingday,
       round(filled - coalesce(part, 0), 4) as filled
from history left join t_part using (sectorcode, kpi, entryperiod)
"""
CHECKS["seasonal_moving"] = """
select entryperiod, sectorcode, kpi, round(adjusted, 6) as deseasonalizedvalue, round(trend, 6) as trendvalue
from m_adjusted left join m_trend3 using (sectorcode, kpi, pos)
"""
CHECKS["legacy_period"] = """
select case when entryperiod < '1997-01' then '2016-12' else entryperiod end as entryperiod,
       count(*) as measures
from measures where not (aggregate like 'W%' and type like '%310%') group by 1
"""
CHECKS["fiscal_year_bounds"] = """
select division, finyear, cast(startdate as varchar) as startdate,
       cast(enddate as varchar) as enddate from fiscal_years where finyear <= 1999
"""
CHECKS["fiscal_spine"] = "select division, entryperiod, finyear from fiscal_spine"
CHECKS["eol_elements"] = """
select division, entryperiod, element, round(cumvalue, 2) as cumvalue from elements
"""
for _name in RATIO_NAMES:
    CHECKS[f"eol_ratio_{_name}"] = f"""
select division, entryperiod, kpi, round(numerator, 2) as numerator,
       round(denominator, 2) as denominator, round(value, 4) as value from {_name}
"""
CHECKS["eol_negative_flag"] = "select division, entryperiod from negative_flag"
CHECKS["eol_outlier"] = """
select division, entryperiod, kpi, round(numerator, 2) as numerator,
       round(denominator, 2) as denominator, round(value, 4) as value, is_1point5_iqr_outlier,
       is_3point0_iqr_outlier, round(percentile, 6) as percentile,
       cast(group_id as double) as group_id, size_of_merged_group,
       cast(group_size as double) as size_of_group_per_period, round(q1, 4) as q1,
       round(q3, 4) as q3, round(iqr, 4) as iqr, negative_stock_cash
from flagged_ratios
"""
_CELL = (
    "entryperiod, sizedescription, sectorcode, subsectorcode, round(value, 4) as value,"
    " population, kpi, unit"
)
CHECKS["eol_cube_median"] = f"select {_CELL} from median_cells"
CHECKS["eol_cube_exact_median"] = CHECKS["eol_cube_median"]
CHECKS["eol_cube_mean"] = f"select {_CELL} from mean_cells"
CHECKS["eol_latest_period"] = f"select {_CELL} from latest_cells"
CHECKS["eol_publishable"] = f"select {_CELL} from median_cells where population > 3"
CHECKS["serve_marketing_select"] = """
select kpi, sectorcode, entryperiod, round(value, 4) as value,
       cast(population as double) as population, unit,
       round(deseasonalizedvalue, 4) as deseasonalizedvalue, round(trendvalue, 4) as trendvalue
from served_points
"""
_SERVED = (
    "kpi_identifier, sectorcode, kpi, position, entryperiod, value, population, unit,"
    " deseasonalizedvalue, trendvalue"
)
CHECKS["serve_series_docs"] = f"select {_SERVED} from served_rows"
CHECKS["serve_lookup_full"] = f"""
select {_SERVED} from served_rows where kpi_identifier = 'g-d2c_30d_mean'
"""
CHECKS["serve_lookup_recent"] = """
select kpi_identifier, sectorcode, kpi,
       position - greatest(points - 12, 0) as position, entryperiod, value,
       population, unit, deseasonalizedvalue, trendvalue
from served_rows where kpi_identifier = 'all-total_growth_lastyear' and position > points - 12
"""
CHECKS["serve_upsert"] = """
select lower(sectorcode || '-' || kpi) as kpi_identifier,
       case when kpi = 'd2c_30d_mean' then 'new' else 'old' end as source,
       count(*) as points
from served_points group by sectorcode, kpi
"""
CHECKS["quality_gate"] = """
select (select count(distinct kpi_identifier) from served_rows) as series,
       cast(28 as bigint) as expected_series,
       count(*) filter (where kpi = 'd2c_30d_mean' and not coalesce(
         value > 0 and value < 70 and population > 3, false)) as bad_days,
       count(*) filter (where kpi = 'total_growth_lastyear' and not coalesce(
         value > -100 and value < 100 and population > 3, false)) as bad_growth,
       (select count(distinct kpi_identifier) from served_rows) = 28
       and count(*) filter (where kpi = 'd2c_30d_mean' and not coalesce(
         value > 0 and value < 70 and population > 3, false)) = 0
       and count(*) filter (where kpi = 'total_growth_lastyear' and not coalesce(
         value > -100 and value < 100 and population > 3, false)) = 0 as passed
from served_rows
"""
CHECKS["serve_eol_documents"] = """
select kpi_identifier, kpi, sector, subsector, companysize, value, population from ratio_rows
"""
CHECKS["serve_eol_scan"] = """
select sector as "Sector", subsector as "SubSector", companysize as "CompanySize", kpi as "KPI",
       population as "Population", value as "Value" from ratio_rows
"""
CHECKS["publish_reconcile"] = """
select (select count(*) from latest_cells where population > 3) as published,
       (select count(*) from ratio_rows) as loaded,
       (select count(*) from latest_cells where population > 3)
         = (select count(*) from ratio_rows) as matches
"""
_BOOKMARK = "s3key, servicename, status, strftime(updated, '%Y-%m-%d %H:%M:%S') as updated"
CHECKS["bookmark_append"] = f"""
select {_BOOKMARK} from bookmarks
union all
select 'snapshot-2001-11-01', servicename, 'OK', '2001-11-01 00:00:00'
from (select distinct servicename from bookmarks)
"""
CHECKS["rollback_target"] = """
select servicename, s3key, strftime(updated, '%Y-%m-%d %H:%M:%S') as updated
from good_bookmarks where age = 2
"""
CHECKS["rollback_status"] = """
select b.s3key, b.servicename,
       case when n.s3key is not null then 'Corrupted' else b.status end as status,
       case when n.s3key is not null then '2001-11-01 00:00:00'
            else strftime(b.updated, '%Y-%m-%d %H:%M:%S') end as updated
from bookmarks b
left join (select servicename, s3key from good_bookmarks g where age = 1
           and exists (select 1 from good_bookmarks s
                       where s.servicename = g.servicename and s.age = 2)) n
  on n.servicename = b.servicename and n.s3key = b.s3key
"""

_WORD = re.compile(r"[a-z_0-9]+")


def _needed(text: str, found: set[str]) -> set[str]:
    for word in set(_WORD.findall(text)) & VIEWS.keys() - found:
        found.add(word)
        _needed(VIEWS[word], found)
    return found


def sql(key: str) -> str:
    """Self-contained SQL text of a check, reading only the given tables."""
    needed = _needed(CHECKS[key], set())
    blocks = [f"{name} as ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    head = "with " + ",\n".join(blocks) + "\n" if blocks else ""
    return head + CHECKS[key].strip()
