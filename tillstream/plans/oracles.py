"""The same queries in plain SQL over the same tables, for an independent engine."""

from __future__ import annotations

from tillstream.functions.codes import CURRENCY_CODES
from tillstream.plans.bindings import RATED_CODES

CODES, RATED = "".join(CURRENCY_CODES), "".join(RATED_CODES)
PAIR_CODES = ", ".join(f"'{c}'" for c in CURRENCY_CODES)

VIEWS = {
    "sales": f"""
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as transaction_id,
          cast(l_partkey as varchar) as product_id, p_name as product_name, p_type as product_category,
          p_retailprice as product_price, cast(l_quantity as int) as product_quantity,
          p_brand as product_brand, p_retailprice * cast(l_quantity as int) as total_amount,
          substr('{CODES}', 3 * c_nationkey + 1, 3) as currency, c_name as customer_id,
          l_shipdate as transaction_date,
          case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'credit_card'
               when o_orderpriority = '3-MEDIUM' then 'debit_card' else 'online_transfer' end as payment_method
        from lineitem join part on l_partkey = p_partkey
          join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "live": f"""
        select event_id as arrival_seq, cast(event_id as varchar) as transaction_id,
          cast(user_id % 6 as varchar) as product_category, value as product_price,
          cast(json_extract(props, '$.k') as int) % 10 + 1 as product_quantity,
          value * (cast(json_extract(props, '$.k') as int) % 10 + 1) as total_amount,
          substr('{CODES}', cast(3 * (user_id % 39) + 1 as int), 3) as currency,
          cast(user_id as varchar) as customer_id, ts as transaction_date
        from events where event_type = 'purchase'""",
    "updates": f"""
        select event_id as arrival_seq,
          substr('{RATED}', cast(3 * (user_id % 37) + 1 as int), 3) as from_currency,
          case when event_type = 'signup' then 'USD'
               else substr('{CODES}', cast(3 * (event_id % 39) + 1 as int), 3) end as to_currency,
          cast(value as decimal(18,6)) as exchange_rate, ts as last_updated
        from events where event_type <> 'purchase'""",
    "latest": """
        select from_currency, to_currency, exchange_rate, last_updated from updates
        qualify row_number() over (partition by from_currency, to_currency order by arrival_seq desc) = 1""",
    "dirty_updates": """
        select arrival_seq, case when arrival_seq % 97 <> 0 then from_currency end as from_currency,
          case when arrival_seq % 89 = 0 then to_currency || 'X' else to_currency end as to_currency,
          cast(exchange_rate - 2 as decimal(18,6)) as exchange_rate,
          case when arrival_seq % 101 <> 0 then last_updated end as last_updated
        from updates""",
    "checked_updates": """
        select *, concat_ws(',',
          case when from_currency is null then 'missing_from_currency' end,
          case when to_currency is null then 'missing_to_currency' end,
          case when length(from_currency) > 3 then 'long_from_currency' end,
          case when length(to_currency) > 3 then 'long_to_currency' end,
          case when exchange_rate is null or exchange_rate <= 0 then 'rate_not_positive' end,
          case when last_updated is null then 'missing_last_updated' end) as violations
        from dirty_updates""",
    "dirty_live": """
        select arrival_seq, case when arrival_seq % 83 <> 0 then transaction_id end as transaction_id,
          case when arrival_seq % 50 <> 0 then product_category end as product_category,
          product_price, product_quantity, total_amount, currency,
          case when arrival_seq % 71 = 0 then repeat('x', 300) else customer_id end as customer_id,
          case when arrival_seq % 61 <> 0 then transaction_date end as transaction_date
        from live""",
    "usd": "select from_currency as code, exchange_rate as rate from latest where to_currency = 'USD'",
    "converted": """
        select s.* replace (total_amount * coalesce(cast(rate as double), 1.0) as total_amount),
          case when rate is null then 'missing' else 'hit' end as rate_status
        from sales s left join usd on currency = code""",
    "converted_live": """
        select s.* replace (total_amount * coalesce(cast(rate as double), 1.0) as total_amount),
          case when rate is null then 'missing' else 'hit' end as rate_status
        from live s left join usd on currency = code""",
    "changes": """
        select from_currency as code, last_updated as since, exchange_rate as rate from updates
        where to_currency = 'USD'
        qualify row_number() over (partition by from_currency, last_updated order by arrival_seq desc) = 1""",
    "converted_asof": """
        select s.* replace (total_amount * coalesce(cast(rate as double), 1.0) as total_amount),
          case when rate is null then 'missing' else 'hit' end as rate_status
        from live s asof left join changes on currency = code and transaction_date >= since""",
    "upserted": """
        select * exclude (rate_status) from converted
        qualify row_number() over (partition by transaction_id
          order by transaction_date desc, cast(product_id as bigint) desc) = 1""",
    "daily": """
        select cast(transaction_date as date) as transaction_date, product_category as category,
          sum(cast(total_amount as decimal(24,6))) as amount
        from converted group by all""",
    "odd": """
        select event_id, value, cast(json_extract(props, '$.k') as int) as k,
          cast(json_extract(props, '$.k') as int) % 8 as kind from events""",
}
# Which views each view reads.
USES = {
    "latest": ["updates"], "dirty_updates": ["updates"], "checked_updates": ["dirty_updates"],
    "dirty_live": ["live"], "usd": ["latest"], "converted": ["sales", "usd"],
    "converted_live": ["live", "usd"], "changes": ["updates"], "converted_asof": ["live", "changes"],
    "upserted": ["converted"], "daily": ["converted"],
}


def _needed(view: str, found: list[str]) -> list[str]:
    for other in USES.get(view, []):
        _needed(other, found)
    if view not in found:
        found.append(view)
    return found


def over(views: str, select: str) -> str:
    """A statement over the named views."""
    found: list[str] = []
    for view in views.split():
        _needed(view, found)
    ctes = ", ".join(f"{v} as ({VIEWS[v].strip()})" for v in found)
    return f"with {ctes} {select.strip()}"


def day_sums(view: str) -> str:
    return f"""select cast(transaction_date as date) as transaction_date,
        cast(sum(cast(total_amount as decimal(24,6))) as double) as total_sales from {view} group by 1"""


LIVE_COLUMNS = "transaction_id, product_category, product_price, product_quantity, total_amount, currency, customer_id, transaction_date"
MONEY_SUM = "cast(sum(cast(total_amount as decimal(24,6))) as double)"

SQL = {
    "latest_rate_by_arrival": over("latest", "select * from latest"),
    "latest_rate_by_event_time": over("updates", """
        select from_currency, to_currency, exchange_rate, last_updated from updates
        qualify row_number() over (partition by from_currency, to_currency
          order by last_updated desc, arrival_seq desc) = 1"""),
    "rate_grid": over("latest", f"""
        , codes as (select unnest([{PAIR_CODES}]) as code),
        pairs as (select code as from_currency, unnest([{PAIR_CODES}]) as to_currency from codes)
        select p.from_currency, p.to_currency,
          case when p.from_currency = p.to_currency then cast(1 as decimal(18,6)) else exchange_rate end as exchange_rate,
          p.from_currency = p.to_currency or exchange_rate is not null as covered
        from pairs p left join latest l on p.from_currency = l.from_currency and p.to_currency = l.to_currency"""),
    "insert_if_absent": over("updates latest", """
        select * from latest where to_currency = 'USD'
        union all
        select from_currency, to_currency, exchange_rate, last_updated from updates u
        where not exists (select 1 from latest l where l.to_currency = 'USD'
          and l.from_currency = u.from_currency and l.to_currency = u.to_currency)
        qualify row_number() over (partition by from_currency, to_currency order by arrival_seq) = 1"""),
    "seed_when_empty": over("latest", "select * from latest"),
    "rate_quarantine": over("checked_updates",
        "select * from checked_updates where exchange_rate is null or exchange_rate <= 0"),
    "rate_quality_split": over("checked_updates", "select * from checked_updates"),
    "rate_accepted_latest": over("checked_updates", """
        select from_currency, to_currency, exchange_rate, last_updated from checked_updates
        where violations = ''
        qualify row_number() over (partition by from_currency, to_currency order by arrival_seq desc) = 1"""),
    "txn_quality_split": over("dirty_live", """
        select *, concat_ws(',',
          case when transaction_id is null then 'missing_transaction_id' end,
          case when length(transaction_id) > 255 then 'long_transaction_id' end,
          case when length(product_category) > 255 then 'long_product_category' end,
          case when length(currency) > 255 then 'long_currency' end,
          case when length(customer_id) > 255 then 'long_customer_id' end,
          case when transaction_date is null then 'missing_transaction_date' end,
          case when product_category is null then 'missing_product_category' end) as violations
        from dirty_live"""),
    "future_rate_guard": over("updates", """
        , checked as (select *, concat_ws(',',
          case when exchange_rate is null or exchange_rate <= 0 then 'rate_not_positive' end,
          case when last_updated > timestamp '2024-01-20 00:00:00' then 'future_last_updated' end) as violations
          from updates)
        select * from checked where violations <> ''"""),
    "enrich_latest": over("converted", "select * from converted"),
    "enrich_latest_shuffled": over("converted", "select * from converted"),
    "enrich_unavailable": over("live", "select *, 'unavailable' as rate_status from live"),
    "rate_status_counts": over("converted",
        "select currency, rate_status, count(*) as sales from converted group by all"),
    "enrich_asof": over("converted_asof", "select * from converted_asof"),
    "enrich_asof_shuffled": over("converted_asof", "select * from converted_asof"),
    "price_rounded": over("live",
        "select transaction_id, round(product_price / 3, 2) as unit_price from live"),
    "transactions_upsert": over("upserted", "select * from upserted"),
    "category_total": over("converted",
        f"select product_category as category, {MONEY_SUM} as total_sales from converted group by 1"),
    "category_running": over("daily", """
        select transaction_date, category, cast(sum(amount) over (partition by category
          order by transaction_date rows unbounded preceding) as double) as total_sales from daily"""),
    "sales_per_day": over("converted", day_sums("converted")),
    "sales_per_day_live": over("converted_live", day_sums("converted_live")),
    "sales_per_day_asof": over("converted_asof", day_sums("converted_asof")),
    "sales_per_day_unique": over("upserted", day_sums("upserted")),
    "processing_date_category": over("converted_live", f"""
        select date '2024-02-01' as transaction_date, product_category as category, {MONEY_SUM} as total_sales
        from converted_live group by product_category"""),
    "processing_date_day": over("converted_live", f"""
        select date '2024-02-01' as transaction_date, {MONEY_SUM} as total_sales from converted_live
        where cast(transaction_date as date) = (
          select cast(transaction_date as date) from live order by arrival_seq desc limit 1)"""),
    "json_roundtrip": over("live", """
        select transaction_id as key, transaction_id, cast(null as varchar) as product_id,
          cast(null as varchar) as product_name, product_category, product_price, product_quantity,
          cast(null as varchar) as product_brand, total_amount, currency, customer_id, transaction_date,
          cast(null as varchar) as payment_method, cast(null as varchar) as decode_error
        from live"""),
    "rate_messages": over("latest updates", """
        select from_currency, to_currency, exchange_rate, last_updated from updates where exchange_rate > 0
        qualify row_number() over (partition by from_currency, to_currency order by arrival_seq desc) = 1"""),
    "json_defaults": over("odd", """
        select event_id, case when kind = 7 then cast(k as varchar) end as transaction_id,
          case when kind in (1, 3, 7) then value when kind in (0, 2) then cast(0 as double) end as product_price,
          case when kind = 2 then k when kind in (0, 1, 3, 6, 7) then 0 end as product_quantity,
          case when kind <> 4 then cast(0 as double) end as total_amount,
          case kind when 3 then 'unknown_field' when 4 then 'malformed' when 6 then 'bad_product_price' end as decode_error
        from odd where kind <> 5"""),
    "json_ignore_unknown": over("odd", """
        select event_id, case when kind in (1, 3, 7) then value when kind in (0, 2) then cast(0 as double) end as product_price,
          case kind when 4 then 'malformed' when 6 then 'bad_product_price' end as decode_error
        from odd where kind <> 5"""),
    "wire_times": """
        select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as wire_time,
          strftime(ts, '%Y-%m-%d %H:%M:%S') as seed_time from events""",
    "stream_rates": over("updates", """
        select from_currency, to_currency, exchange_rate, last_updated from updates where exchange_rate > 0
        qualify row_number() over (partition by from_currency, to_currency order by arrival_seq desc) = 1"""),
    "stream_rate_quarantine": over("checked_updates", """
        select violations, count(*) as updates from checked_updates where violations <> '' group by 1"""),
    "stream_live_transactions": over("converted_live", """
        select transaction_id, cast(null as varchar) as product_id, cast(null as varchar) as product_name,
          product_category, product_price, product_quantity, cast(null as varchar) as product_brand,
          total_amount, currency, customer_id, transaction_date, cast(null as varchar) as payment_method
        from converted_live"""),
    "stream_category_total": over("converted_live",
        f"select product_category as category, {MONEY_SUM} as total_sales from converted_live group by 1"),
    "stream_day_total": over("converted_live", day_sums("converted_live")),
    "stream_windowed_day": over("converted_live", day_sums("converted_live")),
}
THIRD = """case when {at} >= timestamp '2024-01-21' then 2 when {at} >= timestamp '2024-01-11' then 1 else 0 end"""
SALE_RULES = [
    "missing_transaction_id", "long_customer_id", "missing_transaction_date", "missing_product_category",
]
RATE_RULES = [
    "missing_from_currency", "long_to_currency", "rate_not_positive", "missing_last_updated",
]


def rule_counts(checked: str, rules: list[str]) -> str:
    counts = {"rows": "true", "accepted": "violations = ''"} | {r: f"contains(',' || violations || ',', ',{r},')" for r in rules}
    each = " union all ".join(f"select '{r}' as rule, count(*) as n from checked where {test}" for r, test in counts.items())
    return f"with checked as ({checked}) select * from ({each}) where n > 0"


# Of the first third every seventh sale comes last, when the watermark stands ten seconds behind the second third's newest sale.
LATE = over("converted_live", f"""
    , mark as (
      select max(transaction_date) - interval 10 seconds as mark_time from live where {THIRD.format(at="transaction_date")} = 1
    ), placed as (
      select c.*, {THIRD.format(at="transaction_date")} = 0 and arrival_seq % 7 = 0
        and date_trunc('day', transaction_date) + interval 1 day <= mark_time as late
      from converted_live c, mark
    )""")
SQL["seed_when_filled"] = over("latest", "select * from latest where to_currency = 'USD'")
SQL["stream_rates_refreshed"] = over("live updates", f"""
    , known as (
      select k as third, u.from_currency as code, u.exchange_rate as rate
      from updates u, unnest([0, 1, 2]) as t(k)
      where {THIRD.format(at="u.last_updated")} <= k and u.to_currency = 'USD' and u.exchange_rate > 0
      qualify row_number() over (partition by k, u.from_currency order by u.arrival_seq desc) = 1
    )
    select transaction_id, cast(null as varchar) as product_id, cast(null as varchar) as product_name,
      product_category, product_price, product_quantity, cast(null as varchar) as product_brand,
      total_amount * coalesce(cast(rate as double), 1.0) as total_amount, currency, customer_id, transaction_date,
      cast(null as varchar) as payment_method
    from live left join known on currency = code and third = {THIRD.format(at="transaction_date")}""")
SQL["stream_rates_lost"] = over("converted_live live", f"""
    select l.transaction_id, case when {THIRD.format(at="l.transaction_date")} = 2 then l.total_amount else c.total_amount end as total_amount,
      case when {THIRD.format(at="l.transaction_date")} = 2 then 'unavailable' else rate_status end as rate_status
    from live l join converted_live c using (transaction_id)""")
SQL["stream_redelivered"] = SQL["sales_per_day_live"]
SQL["stream_sale_rule_counts"] = rule_counts(SQL["txn_quality_split"], SALE_RULES)
SQL["stream_rate_rule_counts"] = rule_counts(SQL["rate_quality_split"], RATE_RULES)
SQL["stream_category_total_rebuilt"] = SQL["stream_category_total"]
SQL["stream_late_sales"] = f"{LATE} select transaction_id, total_amount, cast(3 as bigint) as batch_id, 'late' as violations from placed where late"
SQL["stream_closed_days"] = f"{LATE} {day_sums('placed').replace('group by 1', 'where not late group by 1')}"
SQL["stream_transactions_compacted"] = SQL["transactions_upsert"]
SQL["stream_sales_per_day_unique"] = SQL["sales_per_day_unique"]
SQL["stream_sales_per_day_asof"] = SQL["sales_per_day_asof"].replace(
    "where to_currency = 'USD'", "where to_currency = 'USD' and exchange_rate > 0"
)
SQL["stream_transactions"] = SQL["transactions_upsert"]
SQL["stream_sales_per_day"] = SQL["sales_per_day"]
SQL["stream_category_running"] = SQL["category_running"]
SQL["stream_transactions_in_parts"] = SQL["transactions_upsert"]
SQL["stream_category_running_in_parts"] = SQL["category_running"]
SQL["stream_processing_date_day"] = SQL["processing_date_day"]
SQL["stream_processing_date_category"] = SQL["processing_date_category"]
# A sale without an event time has no arrival time either, and without an id no message key.
SQL["stream_sales_quarantine"] = f"""
    select violations, count(*) as sales from ({SQL["txn_quality_split"]}) where violations <> '' group by 1"""
