"""The named queries again, written independently as DuckDB SQL over the sample tables.

``TABLES`` holds one SELECT per galaxy or raw table; ``_sql`` puts the ones a
query mentions (and the ones those mention) in front of it as CTEs.
"""

from __future__ import annotations

import re


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(values, key: str) -> str:
    return f"({_list(values)})[cast({key} % {len(values)} as int) + 1]"


SOURCES = _pick(["Google Ads", "Facebook Ads", "Organic Search", "Direct", "Email", "Referral"], "event_id")
DEVICES = _pick(["Desktop", "Mobile", "Tablet"], "event_id")
RAW_COUNTRIES = _pick(["US", "USA", "US of A", "UK", " U.K. ", "Canada", "N/A", "usa"], "c_custkey")
TIERS = _pick(["Platinum", "Gold", "Silver"], "c_custkey")


def _money(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _title(x: str) -> str:
    words = f"regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def _na(x: str) -> str:
    return f"case when {x} in ('', 'NULL', 'N/A', 'NaN') then null else {x} end"


def _parsed(x: str) -> str:
    return f"try_strptime({x}, ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%Y-%m-%d %H:%M:%S', '%d-%b-%Y', '%m/%d/%y %I:%M %p'])"


def _accepted(x: str) -> str:
    p = _parsed(x)
    return (
        f"cast(case when {p} between timestamp '2020-01-01' and timestamp '2027-12-31' then {p} end as date)"
    )


def _spelled(day: str, key: str) -> str:
    return f"""case when {key} % 200 = 0 then '202-01-01' when {key} % 100 = 0 then 'NULL'
        when {key} % 90 = 0 then '0202-01-01' when {key} % 70 = 0 then 'invalid_date'
        when {key} % 55 = 0 then '2019-12-31'
        when {key} % 4 = 0 then strftime({day}, '%m/%d/%Y') when {key} % 9 = 0 then strftime({day}, '%d/%m/%Y')
        when {key} % 13 = 0 then strftime({day}, '%Y-%m-%d') || ' 10:30:00'
        when {key} % 17 = 0 then strftime({day}, '%d-%b-%Y')
        when {key} % 19 = 0 then strftime({day}, '%m/%d/%y') || ' 09:15 PM'
        else strftime({day}, '%Y-%m-%d') end"""


def _months(later: str, earlier: str) -> str:
    return f"((year({later}) - year({earlier})) * 12 + month({later}) - month({earlier}))"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round(cast({part} as double) * 100.0 / nullif(cast({whole} as double), 0), {digits})"


def _ratio(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def _cents(x: str) -> str:
    """Two decimals, half a cent up as written in decimals; a double's binary value may lie just below the half."""
    return f"cast(round(cast({x} as decimal(30, 9)), 2) as double)"


def _ratio0(a: str, b: str) -> str:
    return f"coalesce({_ratio(a, b)}, 0.0)"


SIGNUP = "(date '1995-01-01' + cast(({k} * 37) % 2000 as int))"
TITLE_NAME = _title(_strip("coalesce(full_name, 'Missing Name')"))
EMAIL = "lower(" + _strip("coalesce(email, 'no-email@example.com')") + ")"
COUNTRY_RAW = _strip("coalesce(country, 'Unknown')")
COUNTRY = (
    f"case when {COUNTRY_RAW} in ('US', 'USA', 'US of A') then 'United States' "
    f"when {COUNTRY_RAW} in ('UK', 'U.K.') then 'United Kingdom' else {COUNTRY_RAW} end"
)
STATUS_RAW = _strip("coalesce(status, 'Completed')")
STATUS = f"upper(({STATUS_RAW})[1]) || lower(({STATUS_RAW})[2:])"

CALENDAR = """
  strftime(d, '%Y-%m-%d') as date_key, strftime(d, '%Y-%m-%d') as date, year(d) as year, quarter(d) as quarter,
  'Q' || quarter(d) as quarter_name, month(d) as month, monthname(d) as month_name,
  strftime(d, '%b') as month_short, day(d) as day, isodow(d) as day_of_week, dayname(d) as day_name,
  cast(isodow(d) >= 6 as bigint) as is_weekend"""

TABLES = {
    # retail, clean
    "dim_customers": f"""
        select c_custkey as customer_id, c_name as full_name, lower(c_name) || '@example.com' as email,
               n_name as country, {SIGNUP.format(k='c_custkey')} as signup_date
        from customer join nation on c_nationkey = n_nationkey""",
    "dim_products": f"""
        select p_partkey as product_id, p_name as product_name, p_type as category,
               {_money('p_retailprice')} as base_price from part""",
    "fact_sales": f"""
        select l_orderkey || '-' || l_linenumber as order_item_id, l_orderkey as order_id, o_custkey as customer_id,
               l_partkey as product_id, cast(o_orderdate as date) as order_date, cast(l_quantity as int) as quantity,
               {_money('l_extendedprice')} as unit_price,
               {_money('cast(l_quantity as int) * ' + _money('l_extendedprice'))} as line_subtotal,
               {_money(_money('l_tax') + ' * 100')} as shipping_fee,
               case o_orderstatus when 'F' then 'Completed' when 'O' then 'Pending' else 'Cancelled' end as status,
               greatest(0, {_months('o_orderdate', SIGNUP.format(k='o_custkey'))}) as month_index
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fact_web_traffic": f"""
        select event_id as session_id, user_id as customer_id, cast(ts as date) as session_date,
               {SOURCES} as traffic_source, {DEVICES} as device_type, 1 + event_id % 15 as pages_viewed,
               cast(floor(value) as int) as duration_seconds,
               cast(event_type = 'error' as int) as bounced, cast(event_type = 'signup' as int) as converted
        from events where event_type <> 'purchase'""",
    "event_sales": f"""
        select event_id as order_item_id, event_id // 2 as order_id, user_id as customer_id,
               event_id % 200 as product_id, cast(ts as date) as order_date, cast(event_id % 4 + 1 as int) as quantity,
               {_money('value')} as unit_price, {_money('(event_id % 4 + 1) * ' + _money('value'))} as line_subtotal,
               {_money("'5.00'")} as shipping_fee,
               case when event_id % 7 = 0 then 'Cancelled' else 'Completed' end as status
        from events where event_type = 'purchase'""",
    "retail_bounds": """
        select min(d) - 5 as lo, max(d) + 5 as hi from (
          select signup_date as d from dim_customers union all select order_date from fact_sales
          union all select session_date from fact_web_traffic)""",
    "dim_date": f"""
        select {CALENDAR} from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d
        from retail_bounds)""",
    # retail, dirty, as text with no-value tokens nulled
    "raw_customers": f"""
        select customer_id, {_na('full_name')} as full_name, {_na('email')} as email, {_na('country')} as country,
               {_na('signup_date')} as signup_date, row_order
        from (select 'CUST' || c_custkey as customer_id,
          case when copy = 1 then c_name || ' duplicate' when c_custkey % 70 = 0 then ''
               when c_custkey % 15 = 0 then ' ' || chr(9) || ' ' || lower(c_name) || '  '
               when c_custkey % 11 = 0 then 'mary-jane o''brien 3RD ' || c_custkey else lower(c_name) end as full_name,
          case when c_custkey % 95 = 0 then '' else ' ' || upper(c_name) || '@EXAMPLE.COM' end as email,
          {RAW_COUNTRIES} as country,
          {_spelled("(date '2021-01-01' + cast((c_custkey * 37) % 2000 as int))", 'c_custkey')} as signup_date,
          c_custkey * 2 + copy as row_order
        from (select *, 0 as copy from customer union all
              select *, 1 as copy from customer where c_custkey % 50 = 0))""",
    "raw_products": f"""
        select product_id, {_na('product_name')} as product_name, {_na('category')} as category,
               try_cast({_na('base_price')} as decimal(18,2)) as base_price
        from (select 'PRD' || p_partkey as product_id,
          case when p_partkey % 60 = 0 then '   ' when p_partkey % 40 = 0 then ''
               when p_partkey % 5 = 0 then '  ' || p_name || ' ' else p_name end as product_name,
          case when p_partkey % 33 = 0 then '' else p_type end as category,
          case when p_partkey % 100 = 0 then '-50.00' when p_partkey % 77 = 0 then 'NaN'
               when p_partkey % 49 = 0 then '99999.99' else cast({_money('p_retailprice')} as varchar) end as base_price
        from part)""",
    "raw_orders": f"""
        select order_id, customer_id, {_na('order_date')} as order_date, {_na('status')} as status,
               cast(shipping_fee as decimal(18,2)) as shipping_fee, row_order
        from (select 'ORD' || o_orderkey as order_id,
          case when o_orderkey % 111 = 0 then 'CUSTX' || o_custkey else 'CUST' || o_custkey end as customer_id,
          {_spelled("(cast(o_orderdate as date) + 9131)", 'o_orderkey')} as order_date,
          case when copy = 1 then 'Returned' when o_orderkey % 60 = 0 then '' when o_orderkey % 61 = 0 then 'on HOLD'
               when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then ' Pending '
               else 'CANCELLED' end as status,
          (o_orderkey % 20) || '.50' as shipping_fee, o_orderkey * 2 + copy as row_order
        from (select *, 0 as copy from orders union all
              select *, 1 as copy from orders where o_orderkey % 80 = 0))""",
    "raw_items": f"""
        select order_item_id, order_id, product_id, try_cast({_na('quantity')} as int) as quantity,
               cast(unit_price as decimal(18,2)) as unit_price
        from (select l_orderkey || '-' || l_linenumber as order_item_id, 'ORD' || l_orderkey as order_id,
          'PRD' || l_partkey as product_id,
          case when (l_orderkey + l_linenumber) % 250 = 0 then '-1' when l_orderkey % 251 = 0 then ''
               else cast(cast(l_quantity as int) as varchar) end as quantity,
          case when l_partkey % 97 = 0 then '0' else cast({_money('l_extendedprice')} as varchar) end as unit_price
        from lineitem)""",
    "raw_sessions": f"""
        select session_id, customer_id, {_na('session_date')} as session_date,
               {_na('traffic_source')} as traffic_source, {_na('device_type')} as device_type,
               pages_viewed, duration_seconds, bounced, converted
        from (select 'SESS' || event_id as session_id,
          case when event_id % 120 = 0 then 'CUSTX' else 'CUST' end || user_id as customer_id,
          {_spelled('cast(ts as date)', 'event_id')} as session_date,
          case when event_id % 45 = 0 then '' else {SOURCES} end as traffic_source,
          case when event_id % 46 = 0 then 'N/A' else ' ' || {DEVICES} end as device_type,
          case when event_id % 300 = 0 then -2 else event_id % 15 + 1 end as pages_viewed,
          case when event_id % 350 = 0 then -30 else cast(floor(value) as int) end as duration_seconds,
          cast(event_type = 'error' as int) as bounced, cast(event_type = 'signup' as int) as converted
        from events)""",
    # retail, modelled from the dirty tables
    "m_products": f"""
        select product_id, {_strip("coalesce(product_name, 'Unknown Product')")} as product_name,
               {_strip("coalesce(category, 'General')")} as category, base_price
        from raw_products where base_price > 0 and base_price <= 5000""",
    "first_customers": """
        select * from raw_customers
        qualify row_number() over (partition by customer_id order by row_order) = 1""",
    "m_customers": f"""
        select customer_id, {TITLE_NAME} as full_name, {EMAIL} as email, {COUNTRY} as country,
               coalesce({_accepted('signup_date')}, date '2024-01-01') as signup_date
        from first_customers""",
    "kept_orders": """
        select * from raw_orders qualify row_number() over (partition by order_id order by row_order) = 1""",
    "m_sales": f"""
        select i.order_item_id, i.order_id, o.customer_id, i.product_id, o.d as order_date, i.quantity, i.unit_price,
               {_money('i.quantity * i.unit_price')} as line_subtotal, o.shipping_fee, {STATUS} as status,
               greatest(0, {_months('o.d', 'c.signup_date')}) as month_index
        from raw_items i
        join (select *, {_accepted('order_date')} as d from kept_orders) o on i.order_id = o.order_id
        join m_customers c on o.customer_id = c.customer_id
        where o.d is not null and i.quantity > 0 and i.unit_price > 0
          and i.product_id in (select product_id from m_products)""",
    "m_traffic": f"""
        select session_id, customer_id, d as session_date,
               {_strip("coalesce(traffic_source, 'Organic')")} as traffic_source,
               {_strip("coalesce(device_type, 'Desktop')")} as device_type,
               pages_viewed, duration_seconds, bounced, converted
        from (select *, {_accepted('session_date')} as d from raw_sessions)
        where d is not null and pages_viewed > 0 and duration_seconds >= 0
          and customer_id in (select customer_id from m_customers)""",
    "m_calendar": f"""
        select {CALENDAR} from (
          select cast(unnest(generate_series(min(d) - 5, max(d) + 5, interval 1 day)) as date) as d
          from (select signup_date as d from m_customers union all select order_date from m_sales
                union all select session_date from m_traffic))""",
    # agency
    "managers": f"""
        select s_suppkey as manager_id, s_name as name, r_name as region,
               {_money('greatest(' + _money('s_acctbal') + ', 0) * 10')} as target_monthly_revenue
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "clients": f"""
        select c_custkey as client_id, c_name as company_name, c_mktsegment as industry, {TIERS} as client_tier,
               abs({_money('c_acctbal')}) as monthly_retainer_fee,
               date '1995-01-01' + cast(c_custkey % 1500 as int) as onboarding_date,
               c_custkey % 7 as primary_account_manager_id
        from customer""",
    "campaigns": f"""
        select p_partkey as campaign_id, p_partkey % 150 as client_id, p_name as campaign_name,
               p_type as marketing_channel, {_money(_money('p_retailprice') + ' * 10')} as monthly_ad_budget from part""",
    "ads": f"""
        select cast(l_shipdate as date) as date, l_partkey as campaign_id, l_partkey % 150 as client_id,
               {_money(_money('l_extendedprice') + ' * ' + _money('l_discount'))} as ad_spend,
               cast(l_quantity as bigint) * (l_partkey % 20 + 30) as impressions, cast(l_quantity as bigint) as clicks,
               l_linenumber % 3 as conversions, {_money('l_extendedprice')} as client_conversion_revenue
        from lineitem""",
    "billing": f"""
        select cast(date_trunc('month', o_orderdate) as date) as invoice_date, 'INV' || o_orderkey as invoice_id,
               o_custkey as client_id, o_custkey % 7 as manager_id, retainer as retainer_billing,
               markup as ad_management_markup, {_money('total - retainer - markup')} as consulting_billing,
               total as total_billing_amount
        from (select *, {_money('total * 0.60')} as retainer, {_money('total * 0.15')} as markup
              from (select *, {_money('o_totalprice')} as total from orders))""",
    "agency_dates": "select distinct date as date_key, month(date) as month from ads",
    # with seeded faults
    "bad_customers": """
        select * replace (case when customer_id % 10 = 0 then 10 else customer_id end as customer_id)
        from dim_customers""",
    "bad_products": """
        select * replace (case when product_id % 400 <> 0 then product_id end as product_id,
                          case when product_id % 50 = 0 then 0 else base_price end as base_price)
        from dim_products""",
    "bad_dates": "select * from dim_date where day <> 29",
    "bad_sales": f"""
        select * replace (
          case when order_id % 211 <> 0 then order_item_id end as order_item_id,
          case when order_id % 101 = 0 then -quantity else quantity end as quantity,
          case when order_id % 307 = 0 then 0 else unit_price end as unit_price,
          case when order_id % 997 = 0 then line_subtotal + {_money("'0.02'")} else line_subtotal end as line_subtotal,
          case when order_id % 503 = 0 then -customer_id - 1
               when order_id % 509 <> 0 then customer_id end as customer_id)
        from fact_sales""",
    "bad_traffic": """
        select * replace (
          case when session_id % 13 = 0 then null when session_id % 17 = 0 then 1 else session_id end as session_id,
          case when session_id % 19 = 0 then 0 else pages_viewed end as pages_viewed,
          case when session_id % 23 = 0 then -30 else duration_seconds end as duration_seconds,
          case when session_id % 29 = 0 then 2 else bounced end as bounced,
          case when session_id % 31 = 0 then 3 else converted end as converted)
        from fact_web_traffic""",
    "bad_managers": """
        select * replace (
          case when manager_id % 9 = 0 then -target_monthly_revenue - 1 else target_monthly_revenue end
            as target_monthly_revenue,
          case when manager_id % 6 = 0 then 6 else manager_id end as manager_id)
        from managers""",
    "bad_clients": """
        select * replace (
          case when client_id % 40 = 0 then -monthly_retainer_fee - 1 else monthly_retainer_fee end
            as monthly_retainer_fee,
          case when client_id % 31 = 0 then -5 else primary_account_manager_id end as primary_account_manager_id,
          case when client_id % 37 <> 0 then client_id end as client_id)
        from clients""",
    "bad_campaigns": """
        select * replace (
          case when campaign_id % 41 = 0 then -monthly_ad_budget else monthly_ad_budget end as monthly_ad_budget,
          case when campaign_id % 43 = 0 then 43 else campaign_id end as campaign_id)
        from campaigns""",
    "bad_agency_dates": "select * from agency_dates where month <> 2",
    "bad_ads": """
        select * replace (case when campaign_id % 47 = 0 then -ad_spend - 1 else ad_spend end as ad_spend,
                          case when campaign_id % 59 <> 0 then date end as date)
        from ads""",
    "bad_billing": """
        select * replace (
          case when client_id % 53 = 0 then -total_billing_amount when client_id % 67 = 0 then total_billing_amount + 1
               else total_billing_amount end as total_billing_amount,
          case when client_id % 71 = 0 then -1 else manager_id end as manager_id,
          case when client_id % 73 <> 0 then invoice_id end as invoice_id)
        from billing""",
    # shared steps
    "valued": """
        select customer_id, (select max(order_date) from fact_sales) - max(order_date) as recency_days,
               count(distinct order_id) as frequency, sum(line_subtotal) as monetary_value
        from fact_sales where status <> 'Cancelled' group by customer_id""",
    "scored": """
        select *, ntile(5) over (order by recency_days desc, customer_id) as r_score,
               ntile(5) over (order by frequency, customer_id) as f_score,
               ntile(5) over (order by monetary_value, customer_id) as m_score from valued""",
    "ranked": """
        select *, row_number() over (partition by customer_id, session_date
                    order by duration_seconds desc, pages_viewed desc, session_id) as session_rank
        from fact_web_traffic""",
    "attributed": """
        select s.*, coalesce(t.traffic_source, 'Direct/Unattributed') as attributed_source,
               coalesce(t.device_type, 'Unknown') as attributed_device
        from event_sales s left join (select * from ranked where session_rank = 1) t
          on s.customer_id = t.customer_id and s.order_date = t.session_date
        where s.status <> 'Cancelled'""",
    "client_ads": """
        select client_id, sum(ad_spend) as spend, sum(client_conversion_revenue) as revenue from ads group by 1""",
    "invoice_starts": "select client_id, min(invoice_date) as started from billing group by 1",
    "billing_grid": f"""
        select strftime(started, '%Y-%m') as cohort_month, {_months('invoice_date', 'started')} as month_index,
               count(distinct client_id) as active, sum(total_billing_amount) as total
        from billing join invoice_starts using (client_id) group by 1, 2""",
    "billing_report": f"""
        select cohort_month, s.active as cohort_size, g.month_index, g.active as active_clients,
               round(cast(g.total as double), 2) as total_billing,
               {_pct('g.active', 's.active')} as client_retention_pct,
               {_pct('g.total', 's.total')} as revenue_retention_pct
        from billing_grid g join (select * from billing_grid where month_index = 0) s using (cohort_month)""",
}


def _needed(text: str, seen: list[str]) -> None:
    for name, body in TABLES.items():
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)


def _sql(select: str) -> str:
    names: list[str] = []
    _needed(select, names)
    if not names:
        return select.strip()
    ctes = ",\n".join(f"{n} as ({TABLES[n].strip()})" for n in names)
    return f"with {ctes}\n{select.strip()}"


def _attribution(grain: str = "", full: bool = False, columns: str | None = None) -> str:
    """Attribution at an optional grain: ``grain`` is SQL over ``{d}`` with its alias as last word."""
    name = grain.split()[-1] if grain else None
    by_t = f", {grain.format(d='session_date')}" if grain else ""
    by_s = f", {grain.format(d='order_date')}" if grain else ""
    extra = f", coalesce(t.{name}, s.{name}) as {name}" if grain else ""
    on = f" and t.{name} = s.{name}" if grain else ""
    body = f"""
        select coalesce(t.traffic_source, s.src) as traffic_source{extra},
               cast(coalesce(t.n, 0) as bigint) as total_sessions,
               cast(coalesce(t.bounced, 0) as bigint) as bounced_sessions,
               round({_ratio('t.bounced', 't.n')} * 100, 2) as bounce_rate_pct,
               round({_ratio('t.converted', 't.n')} * 100, 2) as session_conversion_rate_pct,
               cast(coalesce(s.orders, 0) as bigint) as total_orders, cast(coalesce(s.units, 0) as bigint) as units_sold,
               round(cast(coalesce(s.revenue, 0) as double), 2) as gross_revenue,
               round({_ratio('coalesce(s.revenue, 0)', 'coalesce(t.n, 0)')}, 2) as revenue_per_session,
               round({_ratio('coalesce(s.revenue, 0)', 'coalesce(s.orders, 1)')}, 2) as average_order_value
        from (select traffic_source{by_t}, count(session_id) as n, sum(bounced) as bounced, sum(converted) as converted
              from fact_web_traffic group by all) t
        {'full' if full else 'left'} join
             (select attributed_source as src{by_s}, count(distinct order_id) as orders, sum(quantity) as units,
                     sum(line_subtotal) as revenue from attributed group by all) s
          on t.traffic_source = s.src{on}"""
    return f"select {columns} from ({body})" if columns else body


def _checks(specs: list[tuple]) -> str:
    """One SELECT per check: (name, detail with %d, SQL returning the violations)."""
    rows = []
    for number, (name, detail, count) in enumerate(specs, start=1):
        rows.append(f"select {number} as check_no, '{name}' as test_name, ({count}) as violations, '{detail}' as detail")
    union = "\nunion all\n".join(rows)
    return f"""
        select cast(check_no as bigint) as check_no, test_name,
               case when violations = 0 then 'PASSED' else 'FAILED' end as status,
               cast(violations as bigint) as violations,
               replace(detail, '%d', cast(cast(violations as bigint) as varchar)) as details
        from ({union})"""


def _null(label: str, table: str, where: str):
    return f"Null Check: {label}", "Found %d null values in PK.", f"select count(*) from {table} where {where}"


def _uniq(label: str, table: str, key: str):
    return (
        f"Uniqueness Check: {label}.{key}",
        "Found %d duplicate primary keys.",
        f"select count({key}) - count(distinct {key}) from {table}",
    )


def _ref(label: str, table: str, key: str, dim: str, dim_key: str):
    return (
        f"Referential Integrity: {label}",
        "Found %d orphaned records.",
        f"select count(*) from {table} where {key} not in (select {dim_key} from {dim})",
    )


def _val(label: str, table: str, where: str, detail: str):
    return f"Logical Value Check: {label}", detail, f"select count(*) from {table} where {where}"


def _retail_checks(customers: str, products: str, dates: str, sales: str, traffic: str) -> str:
    low = "Found %d records with negative or zero values."
    return _checks([
        _null("dim_customers.customer_id", customers, "customer_id is null"),
        _null("dim_products.product_id", products, "product_id is null"),
        _null("dim_date.date_key", dates, "date_key is null"),
        _null("fact_sales.order_item_id", sales, "order_item_id is null"),
        _null("fact_web_traffic.session_id", traffic, "session_id is null"),
        _uniq("dim_customers", customers, "customer_id"),
        _uniq("dim_products", products, "product_id"),
        _uniq("dim_date", dates, "date_key"),
        _uniq("fact_sales", sales, "order_item_id"),
        _uniq("fact_web_traffic", traffic, "session_id"),
        _ref("fact_sales -> dim_customers", sales, "customer_id", customers, "customer_id"),
        _ref("fact_sales -> dim_products", sales, "product_id", products, "product_id"),
        _ref("fact_sales -> dim_date", sales, "order_date", dates, "cast(date_key as date)"),
        _ref("fact_web_traffic -> dim_customers", traffic, "customer_id", customers, "customer_id"),
        _ref("fact_web_traffic -> dim_date", traffic, "session_date", dates, "cast(date_key as date)"),
        _val("fact_sales.quantity", sales, "quantity <= 0", low),
        _val("fact_sales.unit_price", sales, "unit_price <= 0", low),
        _val("dim_products.base_price", products, "base_price <= 0", low),
        _val("fact_web_traffic.pages_viewed", traffic, "pages_viewed <= 0", low),
        _val("fact_web_traffic.duration_seconds", traffic, "duration_seconds < 0", low),
        _val("fact_web_traffic.bounced (binary check)", traffic, "bounced not in (0, 1)", low),
        _val("fact_web_traffic.converted (binary check)", traffic, "converted not in (0, 1)", low),
        (
            "Calculation Check: line_subtotal",
            "Found %d records where subtotal does not match qty * price.",
            f"select count(*) from {sales} where abs(line_subtotal - quantity * unit_price) > 0.01",
        ),
    ])


def _agency_checks(managers: str, clients: str, campaigns: str, dates: str, ads: str, billing: str) -> str:
    low = "Found %d records with negative values."
    return _checks([
        _null("dim_account_managers.manager_id", managers, "manager_id is null"),
        _null("dim_clients.client_id", clients, "client_id is null"),
        _null("dim_campaigns.campaign_id", campaigns, "campaign_id is null"),
        _null("dim_date.date_key", dates, "date_key is null"),
        _null("fact_ad_performance.campaign_id", ads, "campaign_id is null or date is null"),
        _null("fact_client_billing.invoice_id", billing, "invoice_id is null"),
        _uniq("dim_account_managers", managers, "manager_id"),
        _uniq("dim_clients", clients, "client_id"),
        _uniq("dim_campaigns", campaigns, "campaign_id"),
        _uniq("dim_date", dates, "date_key"),
        _uniq("fact_client_billing", billing, "invoice_id"),
        _ref("dim_clients -> dim_account_managers", clients, "primary_account_manager_id", managers, "manager_id"),
        _ref("dim_campaigns -> dim_clients", campaigns, "client_id", clients, "client_id"),
        _ref("fact_ad_performance -> dim_date", ads, "date", dates, "date_key"),
        _ref("fact_ad_performance -> dim_campaigns", ads, "campaign_id", campaigns, "campaign_id"),
        _ref("fact_client_billing -> dim_clients", billing, "client_id", clients, "client_id"),
        _ref("fact_client_billing -> dim_account_managers", billing, "manager_id", managers, "manager_id"),
        _val("dim_account_managers.target_monthly_revenue", managers, "target_monthly_revenue < 0", low),
        _val("dim_clients.monthly_retainer_fee", clients, "monthly_retainer_fee < 0", low),
        _val("dim_campaigns.monthly_ad_budget", campaigns, "monthly_ad_budget < 0", low),
        _val("fact_ad_performance.ad_spend", ads, "ad_spend < 0", low),
        _val("fact_client_billing.total_billing_amount", billing, "total_billing_amount < 0", low),
        (
            "Calculation Check: billing_sum",
            "Found %d records where total billing does not match sum of details.",
            f"select count(*) from {billing} where abs(total_billing_amount - "
            "(retainer_billing + ad_management_markup + consulting_billing)) > 0.01",
        ),
    ])


AGENCY_NAMES = ("managers", "clients", "campaigns", "agency_dates", "ads", "billing")
AGENCY_CLEAN = _agency_checks(*AGENCY_NAMES)
AGENCY_BAD = _agency_checks(*[f"bad_{n}" for n in AGENCY_NAMES])

BADGE = (
    "case when {x} >= 1.0 then '🏆 Target Exceeded' when {x} >= 0.8 then '🟢 Target Met' "
    "when {x} >= 0.6 then '🟡 At Risk' else '🔴 Action Required' end"
)
REV = "sum(line_subtotal)"
SALES_KPIS = f"""cast({REV} as double) as total_revenue, cast(sum(quantity) as bigint) as units_sold,
    {_ratio0(REV, 'count(distinct order_id)')} as average_order_value,
    {_ratio0(REV, 'count(distinct customer_id)')} as customer_lifetime_value,
    count(distinct customer_id) as active_customers"""
AD_KPIS = f"""cast(sum(ad_spend) as double) as managed_ad_spend,
    cast(sum(client_conversion_revenue) as double) as client_revenue_generated,
    {_ratio0('sum(client_conversion_revenue)', 'sum(ad_spend)')} as managed_roas,
    {_ratio0('sum(ad_spend)', 'sum(conversions)')} as cost_per_acquisition,
    {_ratio0('sum(clicks)', 'sum(impressions)')} as click_through_rate"""
BILLING_KPIS = f"""cast(sum(total_billing_amount) as double) as total_billing,
    {_ratio0('sum(total_billing_amount)', "count(distinct date_trunc('month', invoice_date))")}
      as average_monthly_billing,
    count(distinct client_id) as active_clients"""


def _attainment(by: str) -> str:
    attained = _ratio0("coalesce(b.billed, 0)", "t.target")
    monthly = _ratio0("coalesce(b.billed, 0)", "b.months")
    of_target = _ratio0(monthly, "t.target")
    return f"""
        select {by}, cast(coalesce(b.billed, 0) as double) as total_billing, {monthly} as average_monthly_billing,
               cast(t.target as double) as target, {attained} as attainment, {BADGE.format(x=attained)} as badge,
               {of_target} as monthly_attainment, {BADGE.format(x=of_target)} as monthly_badge
        from (select {by}, sum(target_monthly_revenue) as target from managers group by 1) t
        left join (select m.{by}, sum(total_billing_amount) as billed, count(distinct invoice_date) as months
                   from billing join managers m using (manager_id) group by 1) b using ({by})"""


def _retention(by: str = "") -> str:
    extra = f", {by}" if by else ""
    return f"""
        select strftime(month, '%Y-%m-%d') as month{extra}, active_customers, starting_customers,
               {_ratio0('active_customers', 'starting_customers')} as retention
        from (select date_trunc('month', order_date) as month{extra}, count(distinct customer_id) as active_customers
              from fact_sales group by all)
        join (select date_trunc('month', order_date) as month,
                     count(distinct case when month_index = 0 then customer_id end) as starting_customers
              from fact_sales group by 1) using (month)"""


def _portfolio(where_manager: str = "true", where_client: str = "true", dates: str = "true") -> str:
    return f"""
        with_m as (select * from managers where {where_manager}),
        with_c as (select * from clients where {where_client}
                   and primary_account_manager_id in (select manager_id from with_m)),
        with_b as (select primary_account_manager_id as manager_id, count(distinct c.client_id) as n,
                          sum(total_billing_amount) as billed,
                          count(distinct strftime(invoice_date, '%Y-%m')) as months
                   from with_c c left join (select * from billing where {dates.format(d='invoice_date')}) b
                     on c.client_id = b.client_id group by 1),
        with_p as (select primary_account_manager_id as manager_id, sum(ad_spend) as spend,
                          sum(client_conversion_revenue) as revenue
                   from with_c c left join (select * from ads where {dates.format(d='date')}) a
                     on c.client_id = a.client_id group by 1)
        select m.manager_id, m.name as manager_name, m.region,
               cast(m.target_monthly_revenue as double) as monthly_revenue_target,
               coalesce(b.n, 0) as active_clients, round(cast(coalesce(b.billed, 0) as double), 2) as total_billing_managed,
               {_cents(_ratio0('b.billed', 'b.months'))} as avg_monthly_billing,
               round(cast(coalesce(p.spend, 0) as double), 2) as client_ad_spend_managed,
               round(cast(coalesce(p.revenue, 0) as double), 2) as client_conversion_revenue_generated,
               round(case when coalesce(p.spend, 0) > 0 then {_ratio('coalesce(p.revenue, 0)', 'p.spend')} else 0.0 end, 2)
                 as overall_managed_roas
        from with_m m left join with_b b using (manager_id) left join with_p p using (manager_id)"""


def _counts(**tables: str) -> str:
    return "\nunion all\n".join(
        f"select '{name}' as table_name, (select count(*) from {table}) as {{n}}" for name, table in tables.items()
    )


M_COUNTS = _counts(dim_customers="m_customers", dim_products="m_products", dim_date="m_calendar",
                   fact_sales="m_sales", fact_web_traffic="m_traffic")
AGENCY_TABLES = dict(dim_account_managers="managers", dim_clients="clients", dim_campaigns="campaigns",
                     fact_ad_performance="ads", fact_client_billing="billing")
A_COUNTS = _counts(**AGENCY_TABLES, dim_date="agency_dates").format(n="row_count")
A_LOADED = _counts(**AGENCY_TABLES, dim_date_agency="agency_dates").format(n="rows_loaded")

DATES_OUT = "strftime({c}, '%Y-%m-%d') as {c}"
M_CUSTOMERS = f"select customer_id, full_name, email, country, {DATES_OUT.format(c='signup_date')} from m_customers"
M_TRAFFIC = f"""
    select session_id, customer_id, {DATES_OUT.format(c='session_date')}, traffic_source, device_type,
           cast(pages_viewed as bigint) as pages_viewed, cast(duration_seconds as bigint) as duration_seconds,
           cast(bounced as bigint) as bounced, cast(converted as bigint) as converted from m_traffic"""
COHORTS = f"""
    select strftime(started, '%Y-%m') as cohort_month, n as cohort_size, month_index, active as active_customers,
           {_pct('active', 'n')} as retention_percentage
    from (select started, {_months('month', 'started')} as month_index, count(*) as active
          from (select distinct customer_id, date_trunc('month', order_date) as month from fact_sales
                where status <> 'Cancelled')
          join (select customer_id, date_trunc('month', min(order_date)) as started from fact_sales
                where status <> 'Cancelled' group by 1) using (customer_id) group by 1, 2)
    join (select started, count(*) as n from
            (select customer_id, date_trunc('month', min(order_date)) as started from fact_sales
             where status <> 'Cancelled' group by 1) group by 1) using (started)"""
PAIR_LINES = """
    select category, product_name, country, customer_id, line_subtotal
    from fact_sales join dim_products using (product_id) join dim_customers using (customer_id)"""
REASONS = f"""
    select 'customers' as table_name, case when row_number() over (partition by customer_id order by row_order) > 1
           then 'duplicate_customer' else 'clean' end as reject_reason from raw_customers
    union all
    select 'products', case when base_price <= 0 or base_price > 5000 then 'bad_price'
           when base_price is null then 'missing_price' else 'clean' end from raw_products
    union all
    select 'orders', reason from (select case
           when row_number() over (partition by order_id order by row_order) > 1 then 'duplicate_order'
           when {_accepted('order_date')} is null then 'no_valid_date'
           when customer_id not in (select customer_id from first_customers) then 'unknown_customer'
           else 'clean' end as reason from raw_orders)
    union all
    select 'order_items', case when quantity <= 0 or unit_price <= 0 then 'bad_item_value'
           when quantity is null or unit_price is null then 'missing_item_value'
           when product_id not in (select product_id from m_products) then 'unknown_product'
           else 'clean' end from raw_items
    union all
    select 'sessions', case when {_accepted('session_date')} is null then 'no_valid_date'
           when pages_viewed <= 0 or duration_seconds < 0 then 'bad_session_value'
           when customer_id not in (select customer_id from first_customers) then 'unknown_customer'
           else 'clean' end from raw_sessions"""

_SELECTS = {
    # cleansing
    "product_price_filter": "select product_id, cast(base_price as double) as base_price from m_products",
    "first_orders": "select order_id, status from kept_orders",
    "title_cased_names": f"select {TITLE_NAME} as full_name, count(*) as n_rows from raw_customers group by 1",
    "standard_countries": f"select {COUNTRY} as country, count(*) as n_rows from raw_customers group by 1",
    "default_emails": f"select {EMAIL} as email, count(*) as n_rows from raw_customers group by 1",
    "parsed_order_dates": f"""
        select order_id, row_order,
               case when year({_parsed('order_date')}) >= 1000 or order_date like '0202%'
                    then strftime({_parsed('order_date')}, '%Y-%m-%d') end as parsed_date,
               strftime({_accepted('order_date')}, '%Y-%m-%d') as accepted_date from raw_orders""",
    "order_statuses": f"select {STATUS} as status, count(*) as n_rows from raw_orders group by 1",
    "sane_items": """
        select product_id, count(*) as n_items, cast(sum(quantity) as bigint) as quantity from raw_items
        where quantity > 0 and unit_price > 0 and product_id in (select product_id from m_products) group by 1""",
    "orders_of_known_customers": """
        select customer_id, count(*) as n_orders from raw_orders
        where customer_id in (select customer_id from raw_customers) group by 1""",
    "reject_accounting": f"select table_name, reject_reason, count(*) as row_count from ({REASONS}) group by 1, 2",
    "malformed_lines": """
        select 'order_items' as table_name, case
          when (cast(split_part(order_item_id, '-', 1) as bigint) + cast(split_part(order_item_id, '-', 2) as bigint)) % 40 = 0
            or (cast(split_part(order_item_id, '-', 1) as bigint) + cast(split_part(order_item_id, '-', 2) as bigint)) % 41 = 0
            then 'malformed_line'
          when quantity <= 0 or unit_price <= 0 then 'bad_item_value'
          when quantity is null or unit_price is null then 'missing_item_value'
          when product_id not in (select product_id from m_products) then 'unknown_product' else 'clean' end as reject_reason,
          count(*) as row_count
        from raw_items group by all""",
    "rejected_orders": f"""
        select * from (select order_id, row_order, case
          when row_number() over (partition by order_id order by row_order) > 1 then 'duplicate_order'
          when {_accepted('order_date')} is null then 'no_valid_date'
          when customer_id not in (select customer_id from first_customers) then 'unknown_customer' end as reject_reason
        from raw_orders) where reject_reason is not null""",
    "defaulted_signups": f"""
        select cast({_accepted('signup_date')} is null as bigint) as signup_defaulted, count(*) as n_customers
        from first_customers group by 1""",
    # models
    "model_products": "select product_id, product_name, category, cast(base_price as double) as base_price from m_products",
    "model_customers": M_CUSTOMERS,
    "model_sales": f"""
        select order_item_id, order_id, customer_id, product_id, {DATES_OUT.format(c='order_date')},
               cast(quantity as bigint) as quantity, cast(unit_price as double) as unit_price,
               cast(line_subtotal as double) as line_subtotal, cast(shipping_fee as double) as shipping_fee, status,
               cast(month_index as bigint) as month_index from m_sales""",
    "model_traffic": M_TRAFFIC,
    "model_calendar": "select * from m_calendar",
    "model_row_counts": M_COUNTS.format(n="row_count"),
    "signup_month_index": "select cast(month_index as bigint) as month_index, count(*) as n_lines from fact_sales group by 1",
    "agency_clients": f"""
        select client_id, {_title(_strip("chr(9) || lower(company_name) || ' o''hara inc '"))} as company_name,
               industry, client_tier, cast(monthly_retainer_fee as double) as monthly_retainer_fee,
               {DATES_OUT.format(c='onboarding_date')}, primary_account_manager_id from clients""",
    "agency_managers": f"""
        select manager_id, {_title('lower(name)')} as name, region,
               cast(target_monthly_revenue as double) as target_monthly_revenue from managers""",
    "agency_calendar": """
        select distinct strftime(date, '%Y-%m-%d') as date_key, year(date) as year, month(date) as month,
               monthname(date) as month_name, 'Q' || quarter(date) as quarter, dayname(date) as day_of_week,
               cast(isodow(date) >= 6 as bigint) as is_weekend from ads""",
    "agency_row_counts": A_COUNTS,
    "expected_daily_spend": f"""
        select strftime(date_trunc('month', d), '%Y-%m-%d') as month, campaign_id, client_id, daily as daily_budget,
               greatest(5.0, daily * case when isodow(d) >= 6 then cast(0.7 as double) else cast(1.1 as double) end)
                 as expected_spend, count(*) as days
        from (select campaign_id, p.client_id, onboarding_date, cast(monthly_ad_budget as double) / 30.0 as daily
              from campaigns p join clients c on p.client_id = c.client_id)
        join (select cast(unnest(generate_series(min(onboarding_date), max(onboarding_date), interval 1 day)) as date) as d
              from clients)
          on d >= onboarding_date
        group by all""",
    "monthly_invoices": f"""
        select strftime(m, '%Y-%m-%d') as invoice_date,
               'INV-' || strftime(m, '%Y%m') || '-' || cast(client_id as varchar) as invoice_id, client_id,
               primary_account_manager_id as manager_id, cast(fee as double) as retainer_billing,
               cast(markup as double) as ad_management_markup, cast(hours as double) as consulting_billing,
               cast(fee + markup + hours as double) as total_billing_amount
        from (select c.*, monthly_retainer_fee as fee, {_money('coalesce(budget, 0) * 0.15')} as markup,
                     {_money('(c.client_id % 36 + 5) * 150')} as hours
              from clients c left join (select client_id, sum(monthly_ad_budget) as budget from campaigns group by 1) b
                on c.client_id = b.client_id)
        join (select cast(unnest(generate_series(
                date_trunc('month', min(onboarding_date)), date_trunc('month', max(onboarding_date)), interval 1 month)) as date) as m
              from clients)
          on m >= date_trunc('month', onboarding_date)""",
    # analytics
    "rfm_segments": """
        select customer_id, full_name, email, country, recency_days, frequency,
               cast(monetary_value as double) as monetary_value, r_score, f_score, m_score,
               cast(r_score + f_score + m_score as double) / 3.0 as average_rfm_score,
               case when r_score >= 4 and f_score >= 4 then 'Champions'
                    when r_score >= 3 and f_score >= 3 then 'Loyal Customers'
                    when r_score >= 4 and f_score = 2 then 'Promising'
                    when r_score = 3 and f_score = 2 then 'Need Attention'
                    when r_score >= 4 and f_score = 1 then 'New Customers'
                    when r_score <= 2 and f_score >= 4 then 'Cannot Lose Them'
                    when r_score <= 2 and f_score = 3 then 'At Risk'
                    when r_score = 2 and f_score <= 2 then 'About to Sleep'
                    else 'Lost / Inactive' end as rfm_segment
        from scored join dim_customers using (customer_id)""",
    "retention_cohorts": COHORTS,
    "retention_cohorts_by_loads": COHORTS,
    "best_sessions": f"""
        select session_id, customer_id, {DATES_OUT.format(c='session_date')}, traffic_source, device_type,
               cast(pages_viewed as bigint) as pages_viewed, cast(duration_seconds as bigint) as duration_seconds
        from ranked where session_rank = 1""",
    "attributed_sales": """
        select order_item_id, order_id, cast(line_subtotal as double) as line_subtotal, attributed_source,
               attributed_device from attributed""",
    "channel_attribution": _attribution(),
    "channel_attribution_full": _attribution(full=True),
    "channel_grid": f"""
        select marketing_channel, count(distinct campaign_id) as total_campaigns,
               round(cast(sum(ad_spend) as double), 2) as total_ad_spend,
               cast(sum(impressions) as bigint) as total_impressions, cast(sum(clicks) as bigint) as total_clicks,
               cast(sum(conversions) as bigint) as total_conversions,
               round(cast(sum(client_conversion_revenue) as double), 2) as conversion_revenue,
               {_pct('sum(clicks)', 'sum(impressions)', 3)} as ctr_pct,
               round({_ratio('sum(ad_spend)', 'sum(clicks)')}, 2) as avg_cpc,
               round({_ratio('sum(ad_spend)', 'sum(conversions)')}, 2) as avg_cpa,
               {_pct('sum(conversions)', 'sum(clicks)')} as conversion_rate_pct,
               round({_ratio('sum(client_conversion_revenue)', 'sum(ad_spend)')}, 2) as channel_roas
        from campaigns join ads using (campaign_id) group by 1""",
    "client_billing_cohorts": "select * from billing_report",
    "billing_cohorts_by_loads": "select * from billing_report",
    # measures
    "sales_kpis_total": f"select {SALES_KPIS} from fact_sales",
    "sales_kpis_by_status": f"select year(order_date) as order_year, status, {SALES_KPIS} from fact_sales group by 1, 2",
    "conversion_by_day": f"""
        select strftime(day, '%Y-%m-%d') as day, coalesce(orders, 0) as orders, coalesce(sessions, 0) as sessions,
               {_ratio0('coalesce(orders, 0)', 'coalesce(sessions, 0)')} as conversion_rate
        from (select order_date as day, count(distinct order_id) as orders from event_sales group by 1)
        full join (select session_date as day, count(session_id) as sessions from fact_web_traffic group by 1)
          using (day)""",
    "conversion_total": f"""
        select o as orders, s as sessions, {_ratio0('o', 's')} as conversion_rate
        from (select (select count(distinct order_id) from event_sales) as o,
                     (select count(session_id) from fact_web_traffic) as s)""",
    "revenue_growth": f"""
        with_months as (select cast(date_trunc('month', order_date) as date) as m, cast({REV} as double) as r
                        from fact_sales group by 1)
        select strftime(a.m, '%Y-%m-%d') as month, a.r as total_revenue, b.r as prior_year,
               {_ratio0('(a.r - b.r)', 'b.r')} as growth
        from with_months a left join with_months b on b.m = a.m - interval 12 month""",
    "signup_cohort_retention": _retention(),
    "signup_cohort_retention_by_status": _retention("status"),
    "ad_kpis_by_channel": f"""
        select marketing_channel, {AD_KPIS} from ads join campaigns using (campaign_id) group by 1""",
    "billing_kpis_by_manager": f"select manager_id, {BILLING_KPIS} from billing group by 1",
    "billing_kpis_by_month": f"""
        select strftime(invoice_date, '%Y-%m-%d') as invoice_date, {BILLING_KPIS} from billing group by billing.invoice_date""",
    "target_attainment_by_region": _attainment("region"),
    "target_attainment_by_manager": _attainment("manager_id"),
    # reports
    "category_drilldown": f"""
        select category, product_name, country,
               2 - grouping(category) - grouping(product_name) as depth, grouping(country) as all_countries,
               cast({REV} as double) as total_revenue,
               {_ratio0(REV, 'count(distinct customer_id)')} as customer_lifetime_value
        from ({PAIR_LINES}) group by grouping sets
          ((category, product_name, country), (category, product_name), (category, country), (category), (country), ())""",
    "category_by_country": "select category, " + ", ".join(
        f"cast(sum(line_subtotal) filter (where country = 'NATION_{i}') as double) as NATION_{i}" for i in range(25)
    ) + f" from ({PAIR_LINES}) group by 1",
    "rfm_heat_grid": "select r_score, " + ", ".join(
        f"cast(sum(line_subtotal) filter (where f_score = {i}) as double) as f_{i}" for i in range(1, 6)
    ) + " from fact_sales join scored using (customer_id) group by 1",
    "rfm_cell_transactions": f"""
        select order_item_id, order_id, customer_id, product_id, {DATES_OUT.format(c='order_date')},
               cast(line_subtotal as double) as line_subtotal, status
        from fact_sales where customer_id in (select customer_id from scored where r_score = 5 and f_score = 5)""",
    "portfolio_drilldown": f"""
        with_level as (
          select 3 - grouping(region) - grouping(name) - grouping(company_name) as depth, region, name, company_name,
                 sum(billed) as billed, sum(spend) as spend, sum(revenue) as revenue
          from managers left join clients on manager_id = primary_account_manager_id
          left join (select client_id, sum(total_billing_amount) as billed from billing group by 1) using (client_id)
          left join client_ads using (client_id)
          group by rollup (region, name, company_name)
          having grouping(company_name) = 1 or count(client_id) > 0),
        with_target as (
          select 2 - grouping(region) - grouping(name) as depth, region, name, sum(target_monthly_revenue) as target
          from managers group by rollup (region, name))
        select l.depth, l.region, l.name as manager_name, l.company_name,
               cast(coalesce(billed, 0) as double) as total_billing,
               cast(coalesce(spend, 0) as double) as managed_ad_spend,
               {_ratio0('revenue', 'spend')} as managed_roas,
               {BADGE.format(x=_ratio0('coalesce(billed, 0)', 'target'))} as badge
        from with_level l join with_target t
          on l.region is not distinct from t.region and l.name is not distinct from t.name
         and least(l.depth, 2) = t.depth""",
    "billing_heat_matrix": "select cohort_month, month_index, revenue_retention_pct / 100.0 as retention from billing_report",
    "channel_by_year": _attribution(
        "year({d}) as year",
        columns="traffic_source, year, total_sessions, session_conversion_rate_pct, gross_revenue, bounce_rate_pct",
    ),
    "channel_by_month": _attribution("strftime({d}, '%Y-%m-01') as month"),
    "channel_scatter": _attribution(
        columns="traffic_source, session_conversion_rate_pct, bounce_rate_pct, gross_revenue"
    ),
    "channel_months": "select month, cast(sum(total_sessions) as bigint) as total_sessions, "
    "round(sum(gross_revenue), 2) as gross_revenue from (" + _attribution("strftime({d}, '%Y-%m-01') as month") + ") group by 1",
    "monthly_trend": f"""
        select strftime(m, '%Y-%m-%d') as month, cast(coalesce(r, 0) as double) as total_revenue,
               coalesce(o, 0) as orders, coalesce(s, 0) as sessions,
               {_ratio0('coalesce(o, 0)', 'coalesce(s, 0)')} as conversion_rate
        from (select date_trunc('month', order_date) as m, {REV} as r, count(distinct order_id) as o
              from fact_sales group by 1)
        full join (select date_trunc('month', session_date) as m, count(session_id) as s
                   from fact_web_traffic group by 1) using (m)""",
    "category_share": f"""
        select category, cast(r as double) as total_revenue,
               round({_ratio0('cast(r as double) * 100.0', 'sum(r) over ()')}, 2) as market_share_pct
        from (select category, {REV} as r from fact_sales join dim_products using (product_id) group by 1)""",
    "actual_vs_target": f"""
        select manager_id, name as manager_name, {_cents('monthly')} as average_monthly_billing,
               target as monthly_target, round({_ratio0('monthly', 'target')} * 100.0, 2) as attainment_pct,
               {BADGE.format(x=_ratio0('monthly', 'target'))} as badge
        from (select manager_id, name, cast(target_monthly_revenue as double) as target,
                     {_ratio0('billed', 'months')} as monthly
              from managers left join (select manager_id, sum(total_billing_amount) as billed,
                                              count(distinct invoice_date) as months from billing group by 1)
                using (manager_id))""",
    # checks
    "retail_checks": _retail_checks("dim_customers", "dim_products", "dim_date", "fact_sales", "fact_web_traffic"),
    "retail_checks_on_faults": _retail_checks("bad_customers", "bad_products", "bad_dates", "bad_sales", "bad_traffic"),
    "agency_checks": AGENCY_CLEAN,
    "agency_checks_on_faults": AGENCY_BAD,
    "agency_verdict": f"""
        select cast(bool_and(status = 'PASSED') as bigint) as all_passed,
               count(*) filter (where status = 'FAILED') as failed_checks from ({AGENCY_CLEAN})""",
    "check_report_file": f"select test_name, status, details from ({AGENCY_BAD})",
    # sources and sinks
    "retail_csv_scan": _counts(customers="raw_customers", products="raw_products", orders="raw_orders",
                               order_items="raw_items", sessions="raw_sessions").format(n="row_count"),
    "retail_csv_model": M_CUSTOMERS,
    "agency_csv_scan": """
        select cast(campaign_id as varchar) as campaign_id, count(*) as n_rows,
               cast(sum(ad_spend) as double) as ad_spend, strftime(max(date), '%Y-%m-%d') as last_date
        from ads group by ads.campaign_id""",
    "published_retail": M_COUNTS.format(n="rows_loaded"),
    "published_agency": A_LOADED,
    "quarantined_rows": f"select table_name, reject_reason, count(*) as row_count from ({REASONS}) group by 1, 2",
    "appended_billing": """
        select strftime(invoice_date, '%Y-%m-%d') as invoice_date, 2 * count(*) as n_invoices,
               cast(2 * sum(total_billing_amount) as double) as total_billing
        from billing group by billing.invoice_date""",
    "exported_traffic": M_TRAFFIC,
    "exported_retail": M_COUNTS.format(n="row_count"),
    "exported_agency": A_COUNTS,
    "items_by_header": """
        select product_id, count(*) as n_items, cast(sum(quantity) as bigint) as quantity,
               cast(sum(quantity * unit_price) as double) as amount from raw_items
        where quantity > 0 and unit_price > 0 group by 1""",
    "named_query_results": COHORTS,
    "retail_table_set": _counts(
        dim_customers="dim_customers", dim_products="dim_products", dim_date="dim_date", fact_sales="fact_sales",
        fact_web_traffic="fact_web_traffic", cohort_retention_results=f"({COHORTS})",
        rfm_segmentation_results="(select customer_id from scored join dim_customers using (customer_id))",
    ).format(n="row_count"),
    "agency_table_set": _counts(
        **AGENCY_TABLES, dim_date_agency="agency_dates", manager_portfolio_results="managers",
        campaign_channel_results="(select distinct marketing_channel from ads join campaigns using (campaign_id))",
        client_billing_cohorts="billing_report",
    ).format(n="row_count"),
    "agency_set_billing_cohorts": "select * from billing_report",
    "warehouse_tables": A_LOADED,
    "attribution_view": _attribution(),
}


def _with_own_steps(select: str) -> str:
    """A SELECT that begins with its own ``with_...`` steps, put behind the shared CTEs."""
    names: list[str] = []
    _needed(select, names)
    ctes = ",\n".join(f"{n} as ({TABLES[n].strip()})" for n in names)
    return f"with {ctes},\n{select.strip()}"


ORACLES: dict[str, str] = {
    name: _with_own_steps(select) if select.strip().startswith("with_") else _sql(select)
    for name, select in _SELECTS.items()
}
ORACLES["manager_leaderboard"] = _with_own_steps(_portfolio())
ORACLES["sliced_portfolio"] = _with_own_steps(
    _portfolio(
        "region in ('ASIA', 'EUROPE', 'AFRICA')",
        "industry in ('FURNITURE', 'MACHINERY')",
        "{d} between date '1996-01-01' and date '1998-12-31'",
    )
)
ORACLES["portfolio_of_managers"] = _with_own_steps(
    _portfolio(
        "name in ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')",
        dates="{d} between date '1996-01-01' and date '1998-12-31'",
    )
)
