"""The same results in plain SQL, for an independent engine over the same tables."""

from __future__ import annotations

FEED_SQL = {
    "feed_product": """
  select cast(p_partkey as varchar) as sku, p_name as name,
    case when p_partkey % 97 = 0 then 'n/a' when p_partkey % 89 = 0 then '-1.00'
         else cast(cast(p_retailprice as decimal(12,2)) as varchar) end as price,
    p_type as category,
    case when p_partkey % 83 = 0 then '0' else cast(p_size as varchar) end as popularity
  from part cross join (values (0), (1)) d(k) where d.k = 0 or p_partkey % 10 = 0""",
    "feed_customer": """
  select case when c_custkey % 101 = 0 then null else cast(c_custkey as varchar) end as id,
    split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
    'c' || cast(c_custkey as varchar) || '@example.com' as email,
    case when c_custkey % 7 = 0 then null
         else '07' || lpad(cast(c_custkey as varchar), 9, '0') end as phone_number,
    cast(null as varchar) as address, n_name as city, r_name as country,
    cast(null as varchar) as postcode,
    case when d.k = 0 then '2020-01-01T00:00:00' else '2020-01-01T12:00:00' end as last_change,
    case when d.k = 0 then c_mktsegment else 'MOVED' end as segment
  from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    cross join (values (0), (1)) d(k) where d.k = 0 or c_custkey % 4 = 0""",
    "feed_erasure": """
  select cast(c_custkey as varchar) as customer_id,
    'c' || cast(c_custkey as varchar) || '@example.com' as email
  from customer where c_custkey % 50 = 3 union all select null, null""",
    "feed_line": """
  select 'transaction' as key, cast(o_orderkey as varchar) as transaction_id,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as transaction_time, o_orderdate,
    cast(o_custkey as varchar) as customer_id,
    cast(sum(cast(l_extendedprice as decimal(30,2))) over (partition by o_orderkey)
         + case when o_orderkey % 20 = 0 then 1 else 0 end as decimal(30,2)) as total_cost,
    cast(o_orderkey as varchar) || ' High Street' as address,
    'P' || cast(o_custkey % 100 as varchar) as postcode,
    o_orderpriority as city, o_orderstatus as country,
    cast(l_partkey as varchar) as sku, cast(cast(l_quantity as int) as varchar) as quanitity,
    cast(cast(l_extendedprice as decimal(30,2)) as varchar) as price,
    cast(l_extendedprice as decimal(30,2)) as total
  from lineitem join orders on l_orderkey = o_orderkey""",
    "product_clean": """
  select distinct sku, name, try_cast(price as double) as price, category,
    try_cast(popularity as float) as popularity
  from feed_product
  where try_cast(popularity as float) > 0 and try_cast(price as double) >= 0""",
    "customer_known": """
  select * from feed_customer where id is not null""",
    "customer_erased": """
  select c.* replace (
    case when e.customer_id is null then c.email else sha256(c.email) end as email,
    case when e.customer_id is null then c.phone_number else sha256(c.phone_number) end
      as phone_number)
  from customer_known c left join (
    select distinct customer_id from feed_erasure where customer_id is not null) e
    on c.id = e.customer_id""",
    "customer_latest": """
  select * from customer_erased
  qualify row_number() over (partition by id order by last_change desc) = 1""",
}


# Raw records that break rules, and what is left of them.
BAD_SQL = """
bad_erasure as (
  select cast(null as varchar) as customer_id, cast(null as varchar) as email, 'corrupt' as reason
  from customer where c_custkey % 50 = 4
  union all
  select null, 'c' || cast(c_custkey as varchar) || '@example.com', 'customer-id'
  from customer where c_custkey % 50 = 5),
bad_record as (
  select transaction_id, case when sku::bigint % 41 <> 0 then sku end as sku,
    case when sku::bigint % 43 = 0 then 'abc' else cast(total as varchar) end as total,
    case when transaction_id::bigint % 47 = 0 then 'n/a' else cast(total_cost as varchar) end
      as total_cost,
    case when transaction_id::bigint % 53 = 0 then 'products'
         when transaction_id::bigint % 59 = 0 then 'corrupt' end as reason
  from feed_line)"""


def with_feeds(body: str, *names: str, extra: str = "") -> str:
    """The statement with the named feeds, and those they rest on, as common tables."""
    needs = {
        "product_clean": ["feed_product"],
        "customer_known": ["feed_customer"],
        "customer_erased": ["feed_erasure", "feed_customer", "customer_known"],
        "customer_latest": ["feed_erasure", "feed_customer", "customer_known", "customer_erased"],
    }
    wanted = {n for name in names for n in (name, *needs.get(name, []))}
    tables = ",\n".join(f"{n} as ({FEED_SQL[n]})" for n in FEED_SQL if n in wanted)
    return f"with {tables}{',' if extra else ''}{extra}\n{body}"


LINE = "transaction_id, customer_id, sku, quanitity, total, total_cost"
LANDED_LINE = (
    "key, transaction_id, transaction_time, customer_id, total_cost, address, postcode, city, "
    "country, sku, quanitity, price, total"
)
CURATED = (
    "c.address, c.city, c.country, c.email, c.first_name, c.id, c.last_change, c.last_name, "
    "c.phone_number, c.postcode, c.segment, t.quanitity, t.total, t.total_cost, "
    "t.transaction_id, t.transaction_time, t.total_price, p.category, p.name, p.popularity, t.sku"
)


def running(by: str) -> str:
    return f"sum(total) over (partition by {by} order by total_cost)"


PER_BASKET = "sum(total) over (partition by transaction_id)"


def curated(total: str, extra: str = "", slices: str = "") -> str:
    """The curated table; ``extra`` are computed slice columns, ``slices`` their output."""
    return with_feeds(
        f"""select {CURATED}{slices}
from (select *, {total} as total_price from (select *{extra} from feed_line)) t
join product_clean p on t.sku = p.sku
join customer_latest c on c.id = t.customer_id
where t.total_price = t.total_cost""",
        "feed_line",
        "product_clean",
        "customer_latest",
    )


DAY = ", strftime(o_orderdate, '%Y-%m-%d') as day"
QUARTER = (
    ", strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as date"
    ", lpad(cast(cast(transaction_id as bigint) % 2 as varchar), 2, '0') as hour"
)
PRODUCTS = "select sku, name, price, category, popularity from product_clean"
REJECTS = """select sku, name, price, category, popularity,
  case when coalesce(try_cast(popularity as float) > 0, false) then 'price'
       else 'popularity' end as reason
from feed_product
where not coalesce(try_cast(popularity as float) > 0 and try_cast(price as double) >= 0, false)"""

ORACLE = {
    "envelope_roundtrip": """select doc_id, length(text) as n_chars, md5(text) as text_md5
from documents""",
    "envelope_roundtrip_regex": with_feeds(
        "select 'customer' as key, * from feed_customer", "feed_customer"
    ),
    "feed_route": with_feeds(
        """select 'erasure' as key, cast(0 as int) as "partition", count(*) as n from feed_erasure
union all select 'product', 1, count(*) from feed_product
union all select 'customer', 2, count(*) from feed_customer
union all select 'transaction', 3, count(*) from feed_line""",
        "feed_erasure",
        "feed_product",
        "feed_customer",
        "feed_line",
    ),
    "feed_gz_scan": with_feeds(
        """select feed, '2020-01-01' as date,
  case when length(name) % 2 = 0 then '10' else '00' end as hour, count(*) as n
from (
  select 'erasure' as feed, customer_id as name from feed_erasure
  union all select 'product', sku from feed_product
  union all select 'customer', email from feed_customer
  union all select 'transaction', transaction_id from feed_line)
group by all""",
        "feed_erasure",
        "feed_product",
        "feed_customer",
        "feed_line",
    ),
    "topic_peek": """select event_type as key, props as value, 'events' as topic,
  cast(event_id % 4 as int) as "partition", event_id as "offset"
from events order by event_id limit 20""",
    "transaction_lines": with_feeds(f"select {LANDED_LINE} from feed_line", "feed_line"),
    "transaction_lines_quoted": with_feeds(f"select {LANDED_LINE} from feed_line", "feed_line"),
    "transaction_unknown_fields": with_feeds(
        """select transaction_id, customer_id,
  '{' || case when transaction_id::bigint % 5 = 0
    then '"coupon":{"cents":[1,' || transaction_id || '],"code":"C' || transaction_id || '"}' else '' end
  || case when transaction_id::bigint % 15 = 0 then ',' else '' end
  || case when transaction_id::bigint % 3 = 0 then '"note":"thanks, \\"bye\\""' else '' end || '}' as unknown
from feed_line where transaction_id::bigint % 5 = 0 or transaction_id::bigint % 3 = 0""",
        "feed_line",
    ),
    "product_clean": with_feeds(PRODUCTS, "product_clean"),
    "product_rejected": with_feeds(REJECTS, "feed_product"),
    "customer_not_null": with_feeds("select * from customer_known", "customer_known"),
    "customer_erased": with_feeds("select * from customer_erased", "customer_erased"),
    "customer_erased_salted": with_feeds(
        """select c.* replace (
  case when e.customer_id is null then c.email else sha256('pepper' || c.email) end as email,
  case when e.customer_id is null then c.phone_number else sha256('pepper' || c.phone_number) end
    as phone_number,
  case when e.customer_id is null then c.last_name else sha256('pepper' || c.last_name) end
    as last_name)
from customer_known c left join (
  select distinct customer_id from feed_erasure where customer_id is not null) e
  on c.id = e.customer_id""",
        "feed_erasure",
        "customer_known",
    ),
    "customer_erased_murmur3": with_feeds(
        """select c.*, e.customer_id is not null as masked,
  e.customer_id is not null and c.phone_number is null as null_is_42
from customer_known c left join (
  select distinct customer_id from feed_erasure where customer_id is not null) e
  on c.id = e.customer_id""",
        "feed_erasure",
        "customer_known",
    ),
    "customer_latest": with_feeds("select * from customer_latest", "customer_latest"),
    "customer_latest_until": with_feeds(
        """select * from customer_erased
where last_change > '2020-01-01T06' or phone_number is not null
qualify row_number() over (partition by id order by last_change desc) = 1""",
        "customer_erased",
    ),
    "erasure_land": with_feeds("select customer_id, email from feed_erasure", "feed_erasure"),
    "feed_quality": with_feeds(
        f"""select feed, sum(records)::bigint as records, sum(rejected)::bigint as rejected from (
select 'erasure' as feed, count(*) as records, count(*) filter (customer_id is null) as rejected
from feed_erasure
union all select 'erasure', count(*), count(*) from bad_erasure
union all select 'product', count(*), count(*) filter (where not coalesce(
  try_cast(popularity as float) > 0 and try_cast(price as double) >= 0, false))
from feed_product
union all select 'customer', count(*), count(*) filter (where id is null) from feed_customer
union all select 'transaction', sum(ceil(n / 16.0)), 0 from (
  select count(*) as n from feed_line group by transaction_id)
union all select 'transaction', count(*), count(reason) from bad_record) group by feed""",
        "feed_erasure",
        "feed_product",
        "feed_customer",
        "feed_line",
        extra=BAD_SQL,
    ),
    "erasure_rejected": with_feeds(
        """select customer_id, email, 'customer-id' as reason from feed_erasure
where customer_id is null union all select customer_id, email, reason from bad_erasure""",
        "feed_erasure",
        "feed_line",
        extra=BAD_SQL,
    ),
    "line_rejected": with_feeds(
        """select transaction_id, sku, total, total_cost, case when sku is null then 'sku'
  when try_cast(total as decimal(30,2)) is null then 'total' else 'total_cost' end as reason
from bad_record where reason is null and (sku is null
  or try_cast(total as decimal(30,2)) is null or try_cast(total_cost as decimal(30,2)) is null)""",
        "feed_line",
        extra=BAD_SQL,
    ),
    "basket_running_total": with_feeds(
        f"select {LINE}, {running('customer_id')} as total_price from feed_line", "feed_line"
    ),
    "basket_running_total_by_day": with_feeds(
        f"""select day, {LINE}, {running("day, customer_id")} as total_price
from (select *{DAY} from feed_line)""",
        "feed_line",
    ),
    "basket_total": with_feeds(
        f"select {LINE}, {PER_BASKET} as total_price from feed_line", "feed_line"
    ),
    "line_enriched": with_feeds(
        f"""select {LINE.replace("sku", "t.sku")}, p.name, p.category, p.popularity
from feed_line t join product_clean p on t.sku = p.sku""",
        "feed_line",
        "product_clean",
    ),
    "curated_running": curated(running("customer_id")),
    "curated_running_by_day": curated(running("day, customer_id"), DAY, ", t.day"),
    "curated_per_transaction": curated(PER_BASKET),
    "curated_slice_rewrite": curated(
        running("date, hour, customer_id"),
        QUARTER,
        ", t.date, t.hour, strftime(cast(t.date as date), '%Y') as year"
        ", strftime(cast(t.date as date), '%B') as month",
    ),
    "curated_missing_input": curated(
        running("customer_id"),
        "",
        ", '2020' as year, 'January' as month, '2020-01-01' as date, '10' as hour",
    ),
    "curated_second_day": curated(
        running("date, customer_id"),
        ", case when transaction_id::bigint % 2 = 1 then '2020-01-01' else '2020-01-02' end as date",
        ", '2020' as year, 'January' as month, t.date, '10' as hour",
    ),
    "snapshot_late_product": with_feeds(PRODUCTS, "product_clean"),
    "snapshot_late_customer": with_feeds("select * from customer_latest", "customer_latest"),
    "snapshot_late_erasure": with_feeds("select * from customer_erased", "customer_erased"),
    "curated_late_lines": curated(
        running("customer_id"),
        "",
        ", '2020' as year, 'January' as month, '2020-01-01' as date, '10' as hour",
    ),
    "curated_erased_late": curated(
        running("customer_id"),
        "",
        ", '2020' as year, 'January' as month, '2020-01-01' as date, '10' as hour",
    ),
    "erasure_backfill": curated(
        running("customer_id"),
        "",
        ", '2020' as year, 'January' as month, '2020-01-01' as date, '10' as hour",
    ),
    "landed_compacted": with_feeds(f"select {LANDED_LINE} from feed_line", "feed_line"),
    "stream_product_dedup": with_feeds(PRODUCTS, "product_clean"),
    "stream_product_changes": with_feeds(
        f"""{PRODUCTS}
union all select sku, name || ' (new)', price, category, popularity from product_clean
where sku::bigint % 3 = 0""",
        "product_clean",
    ),
    "stream_event_dedup_watermark": "select * from events",
    "stream_late_rows": """with bounds as (
  select max(ts) as last, min(ts) + 2 * ((max(ts) - min(ts)) / 3) as cut from events),
fated as (
  select event_type, case when ts < cut and ts < last - interval 10 minutes then 'late_event' else 'event' end as fate
  from events, bounds)
select event_type, fate, sum(case when fate = 'event' then 1 else 2 end)::bigint as n from fated group by all
union all
select null, 'repeated', count(*) from fated where fate = 'event'""",
    "stream_transaction_land": with_feeds(
        f"select {LANDED_LINE}, '2020-01-01' as date, '10' as hour from feed_line", "feed_line"
    ),
    "stream_transaction_replayed": with_feeds(f"select {LANDED_LINE} from feed_line", "feed_line"),
    "stream_customer_erased": with_feeds("select * from customer_erased", "customer_erased"),
    "stream_product_rejects": with_feeds(REJECTS, "feed_product"),
    "feeds_to_curated": curated(
        running("customer_id"),
        "",
        ", '2020' as year, 'January' as month, '2020-01-01' as date, '10' as hour",
    ),
}
# The same counts, from what the landing queries reported batch by batch.
ORACLE["batch_metrics"] = ORACLE["feed_quality"]
