"""For each query the plain SQL (DuckDB dialect) that gives the same rows.

The SQL states the meaning directly, not the way Spark gets there: window sums are joins by date
range, movers of a window are a join of two grouped windows, and so on.
"""

from __future__ import annotations

# --- driver tables seen as events, lines and facts -----------------------------------------

_RAW = """
raw_events as (
  select strftime(l_shipdate, '%Y%m%d') as event_date,
         epoch_us(l_shipdate) + l_orderkey * 8 + l_linenumber as micros,
         case l_returnflag when 'N' then 'Purchase' when 'A' then 'add_to_cart'
              else 'view_item' end as event_name,
         cast(l_suppkey as varchar) as user_pseudo_id,
         l_linestatus as country, l_returnflag as region,
         case when tax < 3 then 'desktop' when tax < 5 then 'mobile' when tax < 7 then 'tablet'
              when tax > 7 then 'smart tv' end as device_category,
         case when discount = 0 then '' else 'src_' || discount end as source,
         case when l_linestatus = 'F' then '' else 'cpc' end as medium,
         'campaign_' || tax as campaign,
         '/part/' || l_partkey as page_location,
         case when discount >= 5 then '/supplier/' || l_suppkey end as page_referrer,
         l_orderkey as ga_session_id,
         case when l_quantity > 2 then l_linenumber else 0 end as n_items,
         l_partkey, l_returnflag, l_extendedprice
  from (select *, cast(round(l_discount * 100) as integer) as discount,
               cast(round(l_tax * 100) as integer) as tax from lineitem)
),
base as (
  select cast(strptime(event_date, '%Y%m%d') as date) as event_dt,
         make_timestamp(micros) as event_timestamp, *
  from raw_events
),
exploded as (
  select b.*, l_partkey || '-' || i as item_id, 'item ' || i as item_name,
         l_returnflag as item_category, case when i < 7 then l_extendedprice end as price,
         cast(i as bigint) as quantity
  from base b, unnest(generate_series(1, n_items)) as u(i)
),
flat as (
  select * from exploded
  union all
  select *, null, null, null, null, null from base where n_items = 0
)"""

_EVENT_COLUMNS = """event_dt, event_timestamp, event_name, user_pseudo_id, country, region,
  device_category, source, medium, campaign, page_location, page_referrer, ga_session_id"""
_ITEM_COLUMNS = "item_id, item_name, item_category, price, quantity"

_FLAT_EVENTS = """
flat_events as (
  select cast(ts as date) as event_dt, ts as event_timestamp, upper(event_type) as event_name,
         case when event_type <> 'signup' then cast(user_id as varchar) end as user_pseudo_id,
         cast(null as varchar) as country, cast(null as varchar) as region,
         case event_type when 'view' then 'desktop' when 'click' then 'mobile'
              when 'error' then 'kiosk' when 'purchase' then '(unknown)' end as device_category,
         case event_type when 'error' then '' when 'view' then null
              else 'web_' || event_type end as source,
         case event_type when 'click' then '' else 'organic' end as medium,
         'k' || k as campaign, '/' || event_type as page_location,
         cast(null as varchar) as page_referrer,
         case when event_type <> 'view' then event_id end as ga_session_id,
         k as item_id, 'item ' || k as item_name, cast(null as varchar) as item_category,
         case when k <> '7' then value end as price, cast(1 as bigint) as quantity
  from (select *, json_extract_string(props, '$.k') as k from events)
)"""


def _row_key(ts: str) -> str:
    return (
        f"md5(coalesce(strftime({ts}, '%Y-%m-%d %H:%M:%S.%f'), '') || '|' "
        "|| coalesce(lower(event_name), '') || '|' || coalesce(user_pseudo_id, '') || '|' "
        "|| coalesce(cast(ga_session_id as varchar), '') || '|' || coalesce(item_id, ''))"
    )


def _standardised(flat: str) -> str:
    return f"""select event_dt, event_timestamp as event_ts, user_pseudo_id,
    lower(event_name) as event_name, nullif(source, '') as source, nullif(medium, '') as medium,
    nullif(campaign, '') as campaign, device_category, country, region, page_location,
    page_referrer, ga_session_id, item_id, item_name, item_category, price, quantity,
    {_row_key('event_timestamp')} as row_key
  from {flat}"""


def _staged(flat: str, name: str = "staged") -> str:
    """Ties within a row key are cut by price: the copies differ in nothing else."""
    return f"""
keyed as ({_standardised(flat)}),
{name} as (
  select * exclude (rn) from (
    select *, row_number() over (partition by row_key order by price asc nulls last) as rn
    from keyed)
  where rn = 1
)"""


_TWICE = f"""{_FLAT_EVENTS},
delivered as (
  select * from flat_events
  union all
  select * replace (price + 1 as price) from flat_events
),{_staged('delivered')}"""

_LINES = """
worth as (
  select l_orderkey,
         cast(sum(cast(l_extendedprice * (1 - l_discount) as decimal(20, 6))) as double) as price
  from lineitem group by 1
),
lines as (
  select cast(o_orderdate as date) as date, o_orderkey, price,
         c_mktsegment as source, nullif(o_orderpriority, '4-NOT SPECIFIED') as medium,
         n_name as campaign
  from orders join worth on o_orderkey = l_orderkey
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
),
purchases as (
  select date, sum(cast(price as decimal(20, 6))) as revenue,
         count(distinct o_orderkey) as orders
  from lines group by 1
),
attribution as (
  select date, source, medium, campaign, sum(cast(price as decimal(20, 6))) as revenue,
         count(distinct o_orderkey) as orders
  from lines group by 1, 2, 3, 4
),
span as (
  select min(cast(o_orderdate as date)) as d0, max(cast(o_orderdate as date)) as d1 from orders
),
calendar as (
  select cast(unnest(generate_series(d0, d1, interval 1 day)) as date) as date from span
)"""


def _windows(anchors: str, month: str) -> str:
    start = "date - 29" if month == "rolling30" \
        else "cast(date - interval 1 month as date) + 1"
    return f"""
starts as (
  select date as insight_date, t.insight_type,
         case t.insight_type when 'Day' then date when 'Week' then date - 6
              when 'Month' then {start} else (select d0 from span) end as window_start
  from {anchors} cross join (values ('Total'), ('Month'), ('Week'), ('Day')) t(insight_type)
),
windows as (
  select insight_date, insight_type, window_start, insight_date as window_end,
         cast(window_start - cast(insight_date - window_start + 1 as integer) as date) as prev_start,
         cast(window_start - 1 as date) as prev_end
  from starts
)"""


_LATEST = "(select d1 as date from span)"

_KPIS = """
kpi_sums as (
  select w.*,
         coalesce(sum(revenue) filter (p.date >= window_start), 0) as rc,
         coalesce(sum(orders) filter (p.date >= window_start), 0) as oc,
         coalesce(sum(revenue) filter (p.date < window_start), 0) as rp,
         coalesce(sum(orders) filter (p.date < window_start), 0) as op
  from windows w left join purchases p on p.date between w.prev_start and w.window_end
  group by all
),
kpis as (
  select insight_date, insight_type, window_start, window_end, prev_start, prev_end,
         cast(rc as double) as revenue, cast(oc as bigint) as orders,
         coalesce(cast(rc as double) / nullif(cast(oc as double), 0), 0) as aov,
         cast(rp as double) as prev_revenue, cast(op as bigint) as prev_orders,
         coalesce(cast(rp as double) / nullif(cast(op as double), 0), 0) as prev_aov,
         cast(rc - rp as double) as delta_abs,
         cast(rc - rp as double) / nullif(cast(rp as double), 0) as delta_pct
  from kpi_sums
)"""


def _scored(pairs: str, size: str, rate: str, missing_zero: bool, min_revenue: str | None) -> str:
    """``pairs`` has the window, the channel and decimal rc, rp."""
    share = "abs(cast(rc - rp as double) / nullif(cast(rp as double), 0))"
    share = f"coalesce({share}, 0)" if missing_zero else share
    where = f"where cast(rc as double) >= {min_revenue}" if min_revenue else ""
    return f"""
scored as (
  select insight_date, insight_type, window_start, source, medium, campaign,
         cast(rc as double) as revenue_cur, cast(rp as double) as revenue_prev,
         cast(rc - rp as double) as delta_abs,
         cast(rc - rp as double) / nullif(cast(rp as double), 0) as delta_pct,
         abs(cast(rc - rp as double)) * cast({size} as double)
           + {share} * cast({rate} as double) as impact_score
  from ({pairs}) {where}
),
ranked as (
  select *, row_number() over (
    partition by insight_date, insight_type, window_start
    order by impact_score desc nulls last, revenue_cur desc, revenue_prev desc,
             source nulls last, medium nulls last, campaign nulls last) as rn
  from scored
),
top as (
  select insight_date, insight_type, window_start, cast(rn as integer) as rank, source, medium, campaign,
         revenue_cur, revenue_prev, delta_abs, delta_pct, impact_score
  from ranked where rn <= 8
)"""


_PAIRS = """
  select insight_date, insight_type, window_start, source, medium, campaign,
         coalesce(sum(revenue) filter (a.date >= window_start), 0) as rc,
         coalesce(sum(revenue) filter (a.date < window_start), 0) as rp
  from windows w join attribution a on a.date between w.prev_start and w.window_end
  group by 1, 2, 3, 4, 5, 6"""

_FULL_JOIN_PAIRS = """
  select insight_date, insight_type, window_start, source, medium, campaign,
         coalesce(rc, 0) as rc, coalesce(rp, 0) as rp
  from (select insight_date, insight_type, window_start, source, medium, campaign,
               sum(revenue) as rc
        from windows join attribution on date between window_start and window_end
        group by 1, 2, 3, 4, 5, 6) c
  full join
       (select insight_date, insight_type, window_start, source, medium, campaign,
               sum(revenue) as rp
        from windows join attribution on date between prev_start and prev_end
        group by 1, 2, 3, 4, 5, 6) p
  using (insight_date, insight_type, window_start, source, medium, campaign)"""

_DAILY = f"""{_LINES},{_windows(_LATEST, 'rolling30')},{_KPIS},
{_scored(_PAIRS, '0.6', '0.4', True, None)}"""
_BACKFILL = f"""{_LINES},{_windows('calendar', 'calendar')},{_KPIS},
{_scored(_PAIRS, '0.7', '0.3', False, '50')}"""

_FILLED = f"""{_LINES},
filled as (
  select c.date, coalesce(revenue, 0) as revenue, coalesce(orders, 0) as orders
  from calendar c left join purchases p on p.date = c.date
)"""

# --- texts ---------------------------------------------------------------------------------

# fixed values: the texts that stored insights carry
_ACTIONS = ("['Validate GA4 → warehouse pipeline.', 'Review paid campaigns & pacing.', "
            "'Assess promo/seasonality effects.']")
_SHORT_ACTIONS = ("['Review channel changes and data freshness.', "
                  "'Validate tagging and paid spend pacing.']")
_EDGE = r"'^[\s\x0b]+|[\s\x0b]+$'"


def _clean(lines: str) -> str:
    return (f"list_filter(list_transform(coalesce({lines}, []), lambda s: "
            f"regexp_replace(s, {_EDGE}, '', 'g')), lambda s: s <> '')")


_SPOKEN = f"""
spoken as (
  select conv_id, turn, role, text,
         '  ' || string_split(text, chr(10))[1] || ' ' || chr(9) as headline,
         string_split(text, '.') as bullets,
         case when role <> 'user' then string_split(text, ',') end as actions
  from conversations
),
clean as (
  select conv_id, turn, regexp_replace(headline, {_EDGE}, '', 'g') as headline,
         {_clean('bullets')} as bullets, {_clean('actions')} as actions
  from spoken
)"""


def _template(kpis: str) -> str:
    return f"""
told as (
  select *,
         case when revenue <= 0 and orders <= 0 then 'No purchase activity in this period.'
              else 'Low activity in this period.' end as headline,
         ['Window: ' || window_start || ' → ' || window_end,
          'Revenue: $' || format('{{:,}}', cast(round_even(revenue, 0) as bigint))
            || ', Orders: ' || format('{{:,}}', orders),
          'Check channel spend, tagging, and data freshness.'] as bullets,
         {_ACTIONS} as actions
  from {kpis}
)"""


_KPI_PREFIXED = """t.window_start as kpi_window_start, t.window_end as kpi_window_end,
       revenue as kpi_revenue, orders as kpi_orders, aov as kpi_aov,
       prev_revenue as kpi_prev_revenue, prev_orders as kpi_prev_orders, prev_aov as kpi_prev_aov,
       t.delta_abs as kpi_delta_abs, t.delta_pct as kpi_delta_pct"""
_MOVER = """m.rank - 1 as mover_pos,
       case when m.rank > 0 then coalesce(nullif(m.source, ''), '(none)') end as source,
       case when m.rank > 0 then coalesce(nullif(m.medium, ''), '(none)') end as medium,
       case when m.rank > 0 then coalesce(nullif(m.campaign, ''), '(none)') end as campaign,
       m.revenue_cur, m.revenue_prev, m.delta_abs, m.delta_pct,
       case when m.rank > 0 then coalesce(m.impact_score, 0) end as impact_score"""
_WITH_MOVERS = """left join top m on m.insight_date = t.insight_date
  and m.insight_type is not distinct from t.insight_type and m.window_start = t.window_start"""
_DAILY_CARD = """array_to_string([headline, '• ' || bullets[1], '• ' || bullets[2], '',
  'Next steps', '– ' || actions[1]], chr(10))"""
_BACKFILL_CARD = """array_to_string([headline, '• ' || bullets[1], '• ' || bullets[2],
  '• ' || bullets[3], '', 'Next steps', '– ' || actions[1], '– ' || actions[2],
  '– ' || actions[3]], chr(10))"""


def _whole(card: str, created: str = "cast(null as timestamp)", where: str = "") -> str:
    """All columns of the template's insights, a row for each mover."""
    return f"""
select t.insight_date, t.insight_type, t.window_start, t.window_end, headline,
       array_to_string(bullets, '|') as bullets, array_to_string(actions, '|') as actions,
       {_KPI_PREFIXED}, 'default' as model_name, cast(0 as bigint) as prompt_tokens,
       {created} as created_at, '' as raw_prompt, '{{}}' as raw_response,
       {card} as display_text, {_MOVER}
from told t {_WITH_MOVERS} {where}"""


def _prompt(limits: str) -> str:
    text = (
        "Summarise the revenue figures below for a business reader: short, plain, actionable.\n"
        + limits + "Figures, as JSON: {}\n"
        "Answer with one JSON object, and with nothing else, that has this JSON schema: "
        '{"type": "object", "required": ["headline", "bullets", "actions"], "properties": '
        '{"headline": {"type": "string"}, "bullets": {"type": "array", "items": '
        '{"type": "string"}}, "actions": {"type": "array", "items": {"type": "string"}}}}\n')
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


_FIRST_LOAD = """
loaded as (
  select date as insight_date, 'Day' as insight_type, orders || ' orders' as headline,
         'first' as model_name, timestamp '2024-01-01' as created_at
  from purchases
),
updates as (
  select insight_date, t.insight_type, headline || ', revised' as headline,
         'second' as model_name, timestamp '2024-01-02' as created_at
  from loaded cross join (values ('Day'), (null)) t(insight_type)
)"""

_UPSERTED = """
both_runs as (
  select insight_date, case when year(insight_date) < 1995 then 'day' else 'Day' end
           as insight_type, headline, model_name, created_at
  from loaded where year(insight_date) < 1995 or day(insight_date) % 2 = 1
  union all
  select * from updates where year(insight_date) >= 1995 and day(insight_date) % 2 = 0
),
upserted as (
  select *, cast(null as date) as window_start, cast(null as date) as window_end,
         cast(null as integer) as n_bullets, cast(null as double) as revenue,
         cast(null as bigint) as prompt_tokens, cast(null as varchar) as raw_prompt,
         cast(null as varchar) as raw_response, cast(null as varchar) as display_text
  from both_runs
)"""

ORACLE: dict[str, str] = {
    # scans, sources, sinks
    "scan_date_range": f"""with {_FLAT_EVENTS}
select event_dt, event_timestamp, event_name, user_pseudo_id, country, region, device_category,
       source, medium, campaign, page_location, page_referrer, ga_session_id
from flat_events where event_dt between date '2024-01-03' and date '2024-01-28'""",
    "roundtrip_partitioned": f"with {_FLAT_EVENTS} select *, event_dt as date from flat_events",
    "load_by_pattern": f"""with {_FLAT_EVENTS}
select *, event_dt as date
from flat_events where event_dt between date '2024-01-01' and date '2024-01-24'""",
    "skipped_files": f"""with {_FLAT_EVENTS}
select event_dt as date, count(*) as n_rows,
       cast(case when event_dt in (date '2024-01-05', date '2024-01-09') then 1 else 0 end as bigint)
         as n_skipped
from flat_events group by 1""",
    "incremental_load": f"""with {_FLAT_EVENTS},
days as (
  select event_dt as date, count(*) as n, cast(sum(cast(price as decimal(20, 6))) as double) as price,
         cast(case when event_dt in (date '2024-01-05', date '2024-01-09', date '2024-01-25')
                   then 1 else 0 end as bigint) as bad
  from flat_events group by 1)
select date, n as n_rows, price, n as n_in_ledger, bad as n_failed, bad as n_reasons,
       cast(1 as bigint) as n_loads from days""",
    "lake_listing": f"""with {_FLAT_EVENTS}
select distinct event_dt as date, 'date=' || event_dt as folder, true as has_files,
       true as all_hold_bytes, true as listed_once from flat_events""",
    "named_tables": f"""with {_LINES}
select p.date, cast(any_value(p.revenue) as double) as revenue,
       cast(sum(a.revenue) as double) as channel_revenue
from purchases p join attribution a on a.date = p.date group by 1""",
    "materialised_layers": f"""with {_TWICE}
select event_dt as date,
       cast(sum(cast(price * quantity as decimal(20, 6))) as double) as revenue,
       count(distinct {{'u': user_pseudo_id, 's': ga_session_id, 't': event_ts}}) as orders
from staged where event_name = 'purchase' and price is not null and quantity is not null
group by 1""",
    "variant_to_typed": f"with {_FLAT_EVENTS} select * from flat_events",
    "variant_cast_losses": f"""with {_FLAT_EVENTS}
select count(*) filter (event_name = 'CLICK') as ga_session_id,
       """ + ", ".join(
           f"cast(0 as bigint) as {c}" for c in (_EVENT_COLUMNS + ", " + _ITEM_COLUMNS).replace(
               ",", " ").split() if c != "ga_session_id") + " from flat_events",
    "reload_date_range": f"""with {_FLAT_EVENTS}
select * replace (case when event_dt between date '2024-01-10' and date '2024-01-20'
                       then price + 1 else price end as price), event_dt as date
from flat_events
where not (event_dt between date '2024-01-10' and date '2024-01-20' and event_name = 'ERROR')
  and event_dt <> date '2024-01-15'""",
    "insight_schema_evolve": f"""with {_LINES},{_FIRST_LOAD}
select insight_date, cast(null as varchar) as insight_type, headline, model_name,
       cast(null as date) as window_end, cast(null as bigint) as prompt_tokens,
       cast(null as varchar) as display_text from loaded
union all
select insight_date, insight_type, headline, model_name, null, null, null from updates""",
    "upsert_insights": f"with {_LINES},{_FIRST_LOAD},{_UPSERTED} select * from upserted",
    "upsert_insights_strict": f"""with {_LINES},{_FIRST_LOAD},{_UPSERTED}
select * from upserted union all select * from upserted where insight_type is null""",
    "insights_for_date": f"""with {_LINES},{_FIRST_LOAD}
select insight_date, insight_type, headline from loaded, span where insight_date = d1
union all
select insight_date, insight_type, headline from updates, span
where insight_date = d1 and insight_type is null""",
    "latest_insights": f"""with {_LINES},{_FIRST_LOAD}
select insight_date, insight_type, left(headline, 80) as headline
from (select *, row_number() over (partition by insight_date, insight_type
                                   order by created_at desc, headline) as rn
      from (select * from loaded union all select * from updates))
where rn = 1 order by insight_date desc, insight_type asc nulls last limit 16""",
    # flattening and staging
    "flatten_params": f"with {_RAW} select {_EVENT_COLUMNS} from base",
    "explode_items": f"""with {_RAW}
select event_dt, event_name, user_pseudo_id, {_ITEM_COLUMNS} from exploded""",
    "flatten_explode": f"with {_RAW} select {_EVENT_COLUMNS}, {_ITEM_COLUMNS} from flat",
    "flatten_keyjoin": f"""with {_RAW}
select b.event_dt, b.event_timestamp, b.event_name, b.user_pseudo_id, b.country, b.region,
       b.device_category, b.source, b.medium, b.campaign, b.page_location, b.page_referrer,
       b.ga_session_id, i.item_id, i.item_name, i.item_category, i.price, i.quantity
from base b left join exploded i on i.event_dt = b.event_dt and i.event_name = b.event_name
  and i.user_pseudo_id = b.user_pseudo_id""",
    "stg_events": f"with {_TWICE} select * from staged",
    "row_key": f"""with {_RAW}
select event_timestamp as event_ts, lower(event_name) as event_name, user_pseudo_id,
       ga_session_id, item_id, {_row_key('event_timestamp')} as row_key from flat""",
    "dedup_lineitem": """select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
             l_tax, l_returnflag, l_linestatus) as rn from lineitem) where rn = 1""",
    "purchase_lines": f"""with {_TWICE}
select event_dt, event_ts, user_pseudo_id, source, medium, campaign, item_id, price, quantity
from staged where event_name = 'purchase' and price is not null and quantity is not null""",
    # facts and dimensions
    "fct_purchases_daily": f"""with {_LINES}
select date, cast(revenue as double) as revenue, orders,
       cast(revenue as double) / cast(orders as double) as aov from purchases""",
    "fct_attribution_daily": f"""with {_LINES}
select * replace (cast(revenue as double) as revenue) from attribution""",
    "attribution_from_events": f"""with {_RAW},{_staged('flat')}
select event_dt as date, source, medium, campaign,
       cast(sum(cast(price * quantity as decimal(20, 6))) as double) as revenue,
       count(distinct {{'u': user_pseudo_id, 's': ga_session_id, 't': event_ts}}) as orders
from staged where event_name = 'purchase' and price is not null and quantity is not null
group by 1, 2, 3, 4""",
    "dim_channel": f"""with {_LINES}
select distinct source, medium, campaign,
       md5(coalesce(length(source) || ':' || source, '-') || '|'
        || coalesce(length(medium) || ':' || medium, '-') || '|'
        || coalesce(length(campaign) || ':' || campaign, '-')) as channel_key
from attribution""",
    "date_span": """select min(cast(o_orderdate as date)) as min_date,
       max(cast(o_orderdate as date)) as max_date from orders""",
    "purchases_zero_filled": f"""with {_FILLED}
select date, cast(revenue as double) as revenue, orders from filled""",
    "star_channel": f"""with {_LINES}
select md5(coalesce(length(source) || ':' || source, '-') || '|'
        || coalesce(length(medium) || ':' || medium, '-') || '|'
        || coalesce(length(campaign) || ':' || campaign, '-')) as channel_key,
       source, medium, campaign, cast(year(date) as integer) as year,
       cast(sum(revenue) as double) as revenue, cast(sum(orders) as bigint) as orders
from attribution group by all""",
    "revenue_reconciliation": f"""with {_RAW},
delivered as (
  select d.delivery, d.every, flat.* replace (price + copy as price)
  from flat cross join (values ('few copies', 997), ('many copies', 10)) d(delivery, every)
  cross join (values (0), (0), (1)) c(copy)
  where copy = 0 or ga_session_id % every = 0),
keyed as (select delivery, {_row_key('event_timestamp')} as row_key, event_name, price, quantity
          from delivered),
staged as (
  select delivery, lower(event_name) as event_name, price, quantity from (
    select *, row_number() over (partition by delivery, row_key order by price asc nulls last) as rn
    from keyed) where rn = 1),
mart as (
  select delivery, cast(sum(cast(price * quantity as decimal(20, 6))) as double) as mart_revenue
  from staged where event_name = 'purchase' and price is not null and quantity is not null
  group by 1),
baseline as (
  select delivery, cast(sum(cast(price * quantity as decimal(20, 6))) as double) as baseline_revenue
  from (select distinct delivery, event_dt, user_pseudo_id, ga_session_id, item_id, item_name,
               price, quantity
        from delivered where lower(event_name) = 'purchase' and price is not null)
  group by 1)
select delivery, mart_revenue, baseline_revenue, mart_revenue - baseline_revenue as gap,
       abs(mart_revenue - baseline_revenue) <= abs(baseline_revenue) * cast(0.01 as double)
         as within_tolerance
from mart join baseline using (delivery)""",
    "source_labels": f"""with {_LINES}
select case source when 'MACHINERY' then 'Private' when 'HOUSEHOLD' then 'Home'
            else source end as source_label, cast(sum(revenue) as double) as revenue
from attribution group by 1""",
    # periods, KPIs, movers
    "period_windows": f"with {_LINES},{_windows('calendar', 'rolling30')} select * from windows",
    "period_windows_edate": f"with {_LINES},{_windows('calendar', 'calendar')} select * from windows",
    "kpi_window": f"with {_LINES},{_windows(_LATEST, 'rolling30')},{_KPIS} select * from kpis",
    "kpi_backfill": f"with {_LINES},{_windows('calendar', 'calendar')},{_KPIS} select * from kpis",
    "rolling_kpis": f"""with {_LINES},{_windows('calendar', 'rolling30')},{_KPIS}
select insight_date as date,
  max(revenue) filter (insight_type = 'Day') as day_revenue,
  max(revenue) filter (insight_type = 'Week') as week_revenue,
  max(revenue) filter (insight_type = 'Month') as month_revenue,
  max(prev_revenue) filter (insight_type = 'Day') as prev_day_revenue,
  max(prev_revenue) filter (insight_type = 'Week') as prev_week_revenue,
  max(prev_revenue) filter (insight_type = 'Month') as prev_month_revenue,
  max(revenue) filter (insight_type = 'Total') as total_revenue,
  max(orders) filter (insight_type = 'Day') as day_orders,
  max(orders) filter (insight_type = 'Week') as week_orders,
  max(orders) filter (insight_type = 'Month') as month_orders,
  max(prev_orders) filter (insight_type = 'Day') as prev_day_orders,
  max(prev_orders) filter (insight_type = 'Week') as prev_week_orders,
  max(prev_orders) filter (insight_type = 'Month') as prev_month_orders,
  max(orders) filter (insight_type = 'Total') as total_orders
from kpis group by 1""",
    "movers_fulljoin": f"""with {_LINES},{_windows(_LATEST, 'rolling30')},
{_scored(_FULL_JOIN_PAIRS, '0.6', '0.4', True, None)} select * exclude (window_start) from top""",
    "movers_nullsafe": f"with {_DAILY} select * exclude (window_start) from top",
    "movers_conditional": f"""with {_LINES},{_windows(_LATEST, 'calendar')},
{_scored(_PAIRS, '0.7', '0.3', False, '50')} select * exclude (window_start) from top""",
    "movers_backfill": f"with {_BACKFILL} select * exclude (window_start) from top",
    "movers_records": f"""with {_DAILY}
select insight_date, insight_type, rank - 1 as pos,
       coalesce(nullif(source, ''), '(none)') as source,
       coalesce(nullif(medium, ''), '(none)') as medium,
       coalesce(nullif(campaign, ''), '(none)') as campaign,
       revenue_cur, revenue_prev, delta_abs, delta_pct, impact_score from top""",
    "movers_rank": f"""with {_DAILY}
select insight_date, insight_type, source, medium, campaign, impact_score,
       cast(rank() over (partition by insight_date, insight_type
                         order by impact_score desc nulls last) as integer) as impact_rank
from scored""",
    # trends
    "trend_ma7": f"""with {_FILLED}
select date, cast(revenue as double) as revenue,
       cast(sum(revenue) over w as double) / cast(count(*) over w as double) as revenue_ma7
from filled window w as (order by date rows between 6 preceding and current row)""",
    "trend_wow": f"""with {_FILLED}
select date, cast(revenue as double) as revenue, cast(ago as double) as revenue_lag7,
       cast(revenue - ago as double) as revenue_delta7,
       cast(revenue - ago as double) / nullif(cast(ago as double), 0) as revenue_pct7
from (select *, lag(revenue, 7) over (order by date) as ago from filled)""",
    "trend_zscore": f"""with {_FILLED},
z as (
  select date, cast(revenue as double) as revenue,
         (cast(revenue as double) - avg(cast(revenue as double)) over w)
           / nullif(stddev_samp(cast(revenue as double)) over w, 0) as z
  from filled window w as (order by date rows between 28 preceding and 1 preceding)
)
select date, revenue, round(z, 6) as zscore, coalesce(abs(z) >= 2, false) as is_anomaly from z""",
    "channel_trends": f"""with {_LINES},
grid as (
  select s.source, s.medium, s.campaign, c.date, coalesce(a.revenue, 0) as revenue,
         cast(coalesce(a.orders, 0) as bigint) as orders
  from calendar c cross join (select distinct source, medium, campaign from attribution) s
  left join attribution a on a.date = c.date and a.source is not distinct from s.source
    and a.medium is not distinct from s.medium and a.campaign is not distinct from s.campaign
),
t as (
  select source, medium, campaign, date, revenue, orders,
         cast(sum(revenue) over (w rows between 6 preceding and current row) as double)
           / cast(count(*) over (w rows between 6 preceding and current row) as double) as ma,
         lag(revenue, 7) over w as ago,
         (cast(revenue as double)
            - avg(cast(revenue as double)) over (w rows between 28 preceding and 1 preceding))
           / nullif(stddev_samp(cast(revenue as double))
                    over (w rows between 28 preceding and 1 preceding), 0) as z
  from grid window w as (partition by source, medium, campaign order by date)
)
select source, medium, campaign, date, cast(revenue as double) as revenue, orders, ma as revenue_ma7,
       cast(ago as double) as revenue_lag7, cast(revenue - ago as double) as revenue_delta7,
       cast(revenue - ago as double) / nullif(cast(ago as double), 0) as revenue_pct7,
       round(z, 6) as zscore, coalesce(abs(z) >= 2, false) as is_anomaly
from t""",
    "period_over_period": f"""with {_FILLED},
shifted as (
  select date, revenue, 'YoY' as comparison, cast(date - interval 12 month as date) as base_date
  from filled union all
  select date, revenue, 'QoQ', cast(date - interval 3 month as date) from filled union all
  select date, revenue, 'MoM', cast(date - interval 1 month as date) from filled union all
  select date, revenue, 'WoW', date - 7 from filled
)
select s.date, comparison, base_date, cast(s.revenue as double) as revenue,
       cast(b.revenue as double) as base_revenue,
       cast(s.revenue - b.revenue as double) as delta_abs,
       cast(s.revenue - b.revenue as double) / nullif(cast(b.revenue as double), 0) as delta_pct
from shifted s join filled b on b.date = s.base_date""",
    # scalar functions
    "scalar_dates": """select o_orderkey, cast(o_orderdate as date) as day,
       cast(null as date) as no_day,
       cast(cast(o_orderdate as date) - interval 1 month as date) as month_before from orders""",
    "scalar_timestamps": """select event_id, epoch_us(ts) as micros, ts,
       make_timestamp(-epoch_us(ts) - 1) as before_epoch,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts_text from events""",
    "scalar_formatting": """select o_orderkey, cast(o_orderdate as date) + 1 as next_day,
       '/events/date=' || strftime(o_orderdate, '%Y-%m-%d') || '/' as folder,
       format('{:,}', o_orderkey) as key_text from orders""",
    # texts
    "sanitize_insight": f"""with {_SPOKEN},
t as (
  select conv_id, turn, headline, bullets[1:4] as b,
         case when len(actions) = 0 then {_ACTIONS} else actions[1:3] end as a from clean
)
select conv_id, turn, headline, cast(len(b) as integer) as n_bullets,
       array_to_string(b, '|') as bullets, cast(len(a) as integer) as n_actions,
       array_to_string(a, '|') as actions from t""",
    "display_text_compact": f"""with {_SPOKEN},
t as (
  select conv_id, turn, list_filter([substring(headline, 1, 90)], lambda s: s <> '') as h,
         list_transform(bullets[1:2], lambda s: '• ' || substring(s, 1, 120)) as b,
         list_transform(case when len(actions) = 0 then {_SHORT_ACTIONS} else actions[1:2] end,
                        lambda s: '– ' || substring(s, 1, 120)) as a from clean
)
select conv_id, turn,
       array_to_string((h || b || ['', 'Next steps'] || a)[1:6], chr(10)) as display_text
from t""",
    "display_text_wide": f"""with {_SPOKEN},
t as (
  select conv_id, turn, list_filter([headline], lambda s: s <> '') as h,
         list_transform(bullets[1:4], lambda s: '• ' || s) as b,
         list_transform(case when len(actions) = 0 then {_ACTIONS} else actions[1:3] end,
                        lambda s: '– ' || s) as a from clean
)
select conv_id, turn,
       array_to_string(list_transform((h || b || ['', 'Next steps'] || a)[1:9],
                                      lambda s: substring(s, 1, 240)), chr(10)) as display_text
from t""",
    "parse_response": f"""with {_SPOKEN},
told as (
  select *, case when actions is null then cast(to_json({{'headline': headline, 'bullets': bullets}})
                                            as varchar)
            else cast(to_json({{'headline': headline, 'bullets': bullets, 'actions': actions}})
                      as varchar) end as as_json
  from spoken
),
given as (
  select *, kind = 'gap' or (kind = 'as it is' and role = 'assistant') as parsed,
         case when kind = 'goes on' then as_json || ' and so on'
              when kind = 'fence' then as_json || chr(10) || '```'
              when role = 'system' then trim(cast(to_json(bullets) as varchar))
              else regexp_replace(text, {_EDGE}, '', 'g') end as plain
  from told cross join (values ('as it is'), ('goes on'), ('fence'), ('gap')) k(kind)
),
t as (
  select conv_id, turn || ' ' || kind as turn,
         case when parsed then substring(headline, 1, 90) else 'AI insight' end as headline,
         list_transform(case when parsed then bullets[1:2] else [plain] end,
                        lambda s: substring(s, 1, 110)) as b,
         list_transform(case when parsed then coalesce(actions, [])[1:2] else [] end,
                        lambda s: substring(s, 1, 110)) as a
  from given
)
select conv_id, turn, headline, cast(len(b) as integer) as n_bullets,
       array_to_string(b, '|') as bullets, cast(len(a) as integer) as n_actions,
       coalesce(array_to_string(a, '|'), '') as actions from t""",
    "default_insight": f"""with {_LINES},{_windows('calendar', 'calendar')},{_KPIS},
{_template('kpis')}
select insight_date, insight_type, headline, array_to_string(bullets, '|') as bullets,
       array_to_string(actions, '|') as actions from told""",
    "generator_gate": f"""with {_LINES},{_windows('calendar', 'calendar')},{_KPIS}
select insight_date, insight_type,
       revenue >= 100000 and orders >= 2 and window_end >= date '1996-01-01' as use_model
from kpis""",
    "prompt_payload": f"""with {_DAILY}
select t.insight_date, t.insight_type, lower(t.insight_type) as period, {_KPI_PREFIXED}, {_MOVER}
from kpis t {_WITH_MOVERS}""",
    "prompt_text": f"""with {_LINES},{_windows(_LATEST, 'rolling30')}
select insight_date, insight_type, p.preset, p.text from windows cross join (values
  ('daily', {_prompt("Limits: a headline of up to 90 characters, 2 bullets and 2 actions of up to "
                     "110 characters each.\n")}),
  ('backfill', {_prompt("")})) p(preset, text)""",
    "generated_insights": f"""with {_BACKFILL},
named as (
  select insight_date, insight_type, list(coalesce(nullif(campaign, ''), '(none)') order by rank)
           as campaigns
  from top group by 1, 2)
select k.insight_date, k.insight_type, orders || ' orders' as headline,
       array_to_string([lower(k.insight_type)] || coalesce(campaigns, [])[1:3], '|') as bullets,
       cast(3 as integer) as n_actions, 'told' as model_name, cast(3 as bigint) as prompt_tokens,
       orders || ' orders' as raw_headline
from kpis k left join named n
  on n.insight_date = k.insight_date and n.insight_type = k.insight_type""",
    "insights_latest": f"with {_DAILY},{_template('kpis')} {_whole(_DAILY_CARD)}",
    "insights_backfill": f"with {_BACKFILL},{_template('kpis')} {_whole(_BACKFILL_CARD)}",
    "run_latest_stored": f"""with {_DAILY},{_template('kpis')}
{_whole(_DAILY_CARD, "timestamp '2024-01-02'")}""",
    "run_backfill_whole": f"""with {_BACKFILL},{_template('kpis')}
{_whole(_BACKFILL_CARD, "timestamp '2024-01-01'")}""",
    "run_backfill_stored": f"""with {_BACKFILL},{_template('kpis')}
{_whole(_BACKFILL_CARD, "timestamp '2024-01-01'",
        "where t.insight_date >= (select d0 + 365 from span)")}""",
    "insight_holes": f"""with {_BACKFILL},{_template('kpis')}
{_whole(_BACKFILL_CARD, where="where t.insight_type = 'Total' and day(t.insight_date) = 1 "
                              "or t.insight_date = date '1995-06-15'")}""",
    "insight_changes": f"""with {_BACKFILL},{_template('kpis')},
changed as (
  select unnest([d0 + 500, d0 + 501, d1 - 40, d1])::date as day from span)
{_whole(_BACKFILL_CARD, "case when exists (select 1 from windows w join changed c "
        "on c.day between w.prev_start and w.window_end where w.insight_date = t.insight_date "
        "and w.insight_type = t.insight_type) then timestamp '2024-01-02' "
        "else timestamp '2024-01-01' end")}""",
    "window_sums_at": f"""with {_LINES},{_windows('calendar', 'calendar')},{_KPIS}
select * from kpis""",
    "free_window": f"""with {_LINES},
windows as (
  select d1 as insight_date, cast(null as varchar) as insight_type,
         cast(d1 - n as date) as window_start, d1 as window_end,
         cast(d1 - n - n - 1 as date) as prev_start, cast(d1 - n - 1 as date) as prev_end
  from span cross join (values (9), (99)) v(n)
),{_KPIS},{_scored(_PAIRS, '0.6', '0.4', True, None)},{_template('kpis')} {_whole(_DAILY_CARD)}""",
    "window_labels": f"""with {_LINES},{_windows('calendar', 'rolling30')},
named as (
  select *, cast(window_end - window_start as integer) + 1 as days,
         cast(prev_end - prev_start as integer) + 1 as prev_days from windows)
select insight_date, insight_type,
       case when days = 1 then 'On ' || window_end
            else 'Last ' || days || ' days to ' || window_end end as label,
       case when prev_days = 1 then 'On ' || prev_end
            else 'Last ' || prev_days || ' days to ' || prev_end end as prev_label
from named""",
    # data quality
    "dq_not_null": f"""with {_TWICE}
select c.column_name, count(*) filter (case c.column_name
    when 'event_dt' then event_dt is null when 'event_ts' then event_ts is null
    when 'event_name' then event_name is null when 'user_pseudo_id' then user_pseudo_id is null
    else row_key is null end) as failures
from staged cross join (values ('event_dt'), ('event_ts'), ('event_name'), ('user_pseudo_id'),
                               ('row_key')) c(column_name)
group by 1""",
    "dq_unique": f"""with {_TWICE}
select row_key, count(*) as n from keyed group by 1 having count(*) > 1""",
    "dq_accepted_values": f"""with {_TWICE}
select device_category, count(*) as n from staged
where device_category not in ('desktop', 'mobile', 'tablet', '(unknown)') group by 1""",
    "dq_row_key_recompute": f"""with {_TWICE}
select count(*) as n_rows,
       count(*) filter (case item_id when '7' then reverse(row_key) when '8' then null
                        else row_key end is distinct from {_row_key('event_ts')}) as mismatches
from staged""",
    "dq_purchase_lines": f"""with {_TWICE},
p as (select * from staged where event_name = 'purchase')
select 'staging' as layer, count(*) as n_rows,
       count(*) filter (price is null or quantity is null) as n_incomplete from p
union all
select 'lines', count(*), count(*) filter (price is null or quantity is null) from p
where price is not null and quantity is not null""",
    "dq_param_keys": """select t.param,
       (select case when t.param = 'page_location'
                    then count(*) filter (l_returnflag not in ('N', 'A')) else 0 end
        from lineitem) as failures
from (values ('page_location'), ('page_referrer'), ('ga_session_id')) t(param)""",
}
