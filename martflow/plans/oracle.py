"""Independent SQL for every registered query, runnable by DuckDB over the
test tables (views ``region nation customer supplier part orders lineitem
events ...``). Written from the role mapping in ``sources.testbed``, not
from the Spark code: plain joins, GROUP BY and window functions.
"""

from __future__ import annotations

# Shared building blocks (CTEs). Money: decimal(18,2) sums, double at the edge.
_LINES = """
lines as (
  select o_custkey as customer_id, cast(s_nationkey as bigint) as store_id, l_partkey as product_id,
         cast(o_orderdate as date) as sales_date, l_suppkey as sales_person_id,
         cast(l_quantity as integer) as quantity,
         cast(l_extendedprice as decimal(18,2)) as total_cost,
         l_linestatus || ', ' || l_returnflag as additional_column,
         l_orderkey as order_id, l_linenumber as line_number
  from lineitem join orders on l_orderkey = o_orderkey
               join supplier on l_suppkey = s_suppkey
)"""

_DIMS = """
cust as (
  select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
         split_part(c_name, '#', 2) as last_name, n_name as address,
         cast(c_nationkey as varchar) as pincode, c_mktsegment as phone_number
  from customer left join nation on c_nationkey = n_nationkey
),
store as (
  select cast(n_nationkey as bigint) as id, n_name as address, r_name as store_manager_name
  from nation left join region on n_regionkey = r_regionkey
),
mgr as (select s_nationkey as m_nationkey, min(s_suppkey) as manager_id from supplier group by 1),
team as (
  select s_suppkey as id, split_part(s_name, '#', 1) as first_name,
         split_part(s_name, '#', 2) as last_name, manager_id,
         case when s_suppkey = manager_id then 'Y' else 'N' end as is_manager,
         n_name as address, cast(s_nationkey as varchar) as pincode
  from supplier left join nation on s_nationkey = n_nationkey
                left join mgr on s_nationkey = m_nationkey
)"""

_ENRICHED = """
enriched as (
  select l.* from lines l
  join team t on l.sales_person_id = t.id
  join store s on l.store_id = s.id
  join cust c on l.customer_id = c.customer_id
)"""


def _with(*blocks: str) -> str:
    return "with " + ",\n".join(b.strip() for b in blocks) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["sales_mart"] = _with(_LINES, _DIMS, _ENRICHED, """
totals as (
  select store_id, sales_person_id, substring(cast(sales_date as varchar), 1, 7) as sales_month,
         sum(total_cost) as total_sales
  from enriched group by 1, 2, 3
),
ranked as (
  select *, rank() over (partition by store_id, sales_month order by total_sales desc nulls last) as rnk
  from totals
)""") + """
select r.store_id, r.sales_person_id, t.first_name || ' ' || t.last_name as full_name,
       r.sales_month, cast(r.total_sales as double) as total_sales,
       cast(round(case when rnk = 1 then total_sales * cast(0.01 as decimal(3,2)) else 0 end, 2)
            as double) as incentive
from ranked r join team t on r.sales_person_id = t.id
"""

ORACLE["customer_mart"] = _with(_LINES, _DIMS, _ENRICHED, """
totals as (
  select customer_id, substring(cast(sales_date as varchar), 1, 7) as sales_date_month,
         sum(total_cost) as total_sales
  from enriched group by 1, 2
)""") + """
select t.customer_id, c.first_name || ' ' || c.last_name as full_name, c.address, c.phone_number,
       t.sales_date_month, cast(t.total_sales as double) as total_sales
from totals t join cust c on t.customer_id = c.customer_id
"""

ORACLE["sales_mart_window"] = ORACLE["sales_mart"]
ORACLE["customer_mart_window"] = ORACLE["customer_mart"]

_TOTALS_C = """
ctot as (
  select customer_id, substring(cast(sales_date as varchar), 1, 7) as sales_date_month,
         sum(total_cost) as total_sales
  from enriched group by 1, 2
)"""

_TOTALS_S = """
stot as (
  select store_id, sales_person_id, substring(cast(sales_date as varchar), 1, 7) as sales_month,
         sum(total_cost) as total_sales
  from enriched group by 1, 2, 3
)"""

ORACLE["customer_month_total"] = _with(_LINES, _DIMS, _ENRICHED, _TOTALS_C) + """
select customer_id, sales_date_month, cast(total_sales as double) as total_sales from ctot
"""
ORACLE["customer_month_total_window"] = ORACLE["customer_month_total"]

ORACLE["sales_month_total"] = _with(_LINES, _DIMS, _ENRICHED, _TOTALS_S) + """
select store_id, sales_person_id, sales_month, cast(total_sales as double) as total_sales from stot
"""
ORACLE["sales_month_total_window"] = ORACLE["sales_month_total"]

ORACLE["seller_rank"] = _with(_LINES, _DIMS, _ENRICHED, _TOTALS_S) + """
select store_id, sales_person_id, sales_month, cast(total_sales as double) as total_sales,
       cast(rank() over (partition by store_id, sales_month order by total_sales desc nulls last)
            as bigint) as rnk
from stot
"""

ORACLE["top_seller"] = _with(_LINES, _DIMS, _ENRICHED, _TOTALS_S) + """
select store_id, sales_person_id, sales_month, cast(total_sales as double) as total_sales
from stot
qualify rank() over (partition by store_id, sales_month order by total_sales desc nulls last) = 1
"""

ORACLE["top_k_sellers"] = _with(_LINES, _DIMS, _ENRICHED, _TOTALS_S) + """
select store_id, sales_person_id, sales_month, cast(total_sales as double) as total_sales,
       cast(rank() over (partition by store_id, sales_month order by total_sales desc nulls last)
            as bigint) as rnk
from stot qualify rnk <= 3
"""

_FACT_COLS = """l.order_id, l.line_number, l.customer_id, l.store_id, l.sales_person_id,
       cast(l.sales_date as varchar) as sales_date, cast(l.total_cost as double) as total_cost"""

ORACLE["join_customer"] = _with(_LINES, _DIMS) + f"""
select {_FACT_COLS}, c.first_name, c.last_name, c.address
from lines l join cust c on l.customer_id = c.customer_id
"""

ORACLE["join_store"] = _with(_LINES, _DIMS) + f"""
select {_FACT_COLS}, s.store_manager_name, s.address as store_address
from lines l join store s on l.store_id = s.id
"""

ORACLE["join_sales_team"] = _with(_LINES, _DIMS) + f"""
select {_FACT_COLS}, t.first_name as sales_person_first_name,
       t.last_name as sales_person_last_name, t.manager_id
from lines l join team t on l.sales_person_id = t.id
"""

ORACLE["join_product"] = _with(_LINES) + f"""
select {_FACT_COLS}, l.product_id, p.p_name as product_name,
       cast(cast(p.p_retailprice as decimal(10,2)) as double) as current_price,
       cast(l.quantity as bigint) as quantity,
       cast(cast(p.p_retailprice as decimal(10,2)) * l.quantity as double) as list_total,
       cast(p.p_retailprice as decimal(10,2)) * l.quantity <> l.total_cost as price_mismatch
from lines l join part p on l.product_id = p.p_partkey
"""

ORACLE["star_enrich"] = _with(_LINES, _DIMS) + f"""
select {_FACT_COLS},
       t.first_name as sales_person_first_name, t.last_name as sales_person_last_name,
       t.manager_id, t.is_manager, t.address as sales_person_address,
       t.pincode as sales_person_pincode, s.store_manager_name,
       c.first_name as customer_first_name, c.last_name as customer_last_name,
       c.address as customer_address, c.pincode as customer_pincode,
       c.phone_number as customer_phone_number
from lines l join team t on l.sales_person_id = t.id
             join store s on l.store_id = s.id
             join cust c on l.customer_id = c.customer_id
"""

ORACLE["orphan_facts"] = _with(_LINES, _DIMS) + """
select 'customer' as dimension, count(*) as orphan_rows from lines l
where not exists (select 1 from cust c where c.customer_id = l.customer_id)
union all
select 'store', count(*) from lines l
where not exists (select 1 from store s where s.id = l.store_id)
union all
select 'team', count(*) from lines l
where not exists (select 1 from team t where t.id = l.sales_person_id)
union all
select 'active_customer', count(*) from lines l
where not exists (select 1 from events e where e.user_id = l.customer_id)
"""

ORACLE["manager_rollup"] = _with(_LINES, _DIMS) + """
select t.manager_id, cast(sum(l.total_cost) as double) as team_total,
       count(distinct l.sales_person_id) as members
from lines l join team t on l.sales_person_id = t.id
group by t.manager_id
"""

ORACLE["manager_hierarchy"] = """
with recursive up(member, ancestor, level) as (
  select s_suppkey, s_suppkey // 3, 1 from supplier where s_suppkey // 3 <> s_suppkey
  union all
  select member, ancestor // 3, level + 1 from up where ancestor // 3 <> ancestor
),
own as (
  select l_suppkey as member, sum(cast(l_extendedprice as decimal(18,2))) as amount from lineitem group by 1
)
select ancestor as manager_id, cast(sum(amount) as double) as team_total, count(*) as members,
       cast(max(level) as bigint) as levels
from up join own using (member) where ancestor in (select s_suppkey from supplier) group by ancestor
"""

ORACLE["dim_store"] = """
select cast(n_nationkey as bigint) as id, n_name as address, cast(n_regionkey as varchar) as store_pincode,
       r_name as store_manager_name, cast(null as varchar) as store_opening_date,
       cast(null as varchar) as reviews
from nation left join region on n_regionkey = r_regionkey
"""

ORACLE["dim_key_uniqueness"] = _with(_DIMS) + """
select 'customer.customer_id' as dimension, cast(customer_id as varchar) as key, count(*) as copies
from cust group by customer_id having count(*) > 1
union all
select 'store.id', cast(id as varchar), count(*) from store group by id having count(*) > 1
union all
select 'sales_team.id', cast(id as varchar), count(*) from team group by id having count(*) > 1
union all
select 'product.id', cast(p_partkey as varchar), count(*) from part group by p_partkey having count(*) > 1
union all
select 'product.name', p_name, count(*) from part group by p_name having count(*) > 1
"""

ORACLE["customer_mart_projection"] = _with(_LINES, _DIMS) + """
select l.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
       cast(l.sales_date as varchar) as sales_date, cast(l.total_cost as double) as total_cost
from lines l join team t on l.sales_person_id = t.id
             join store s on l.store_id = s.id
             join cust c on l.customer_id = c.customer_id
"""

ORACLE["sales_mart_projection"] = _with(_LINES, _DIMS) + """
select l.store_id, l.sales_person_id, t.first_name as sales_person_first_name,
       t.last_name as sales_person_last_name, s.store_manager_name, t.manager_id, t.is_manager,
       t.address as sales_person_address, t.pincode as sales_person_pincode,
       substring(cast(l.sales_date as varchar), 1, 7) as sales_month,
       cast(l.sales_date as varchar) as sales_date, cast(l.total_cost as double) as total_cost
from lines l join team t on l.sales_person_id = t.id
             join store s on l.store_id = s.id
             join cust c on l.customer_id = c.customer_id
"""

ORACLE["month_key"] = """
select o_orderkey, strftime(cast(o_orderdate as date), '%Y-%m') as sales_month from orders
"""

ORACLE["full_name"] = """
select c_custkey as customer_id,
       split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) as full_name
from customer
"""

ORACLE["distinct_attributes"] = _with(_LINES, _DIMS, _ENRICHED) + """
select distinct e.store_id, e.sales_person_id, t.first_name || ' ' || t.last_name as full_name,
       substring(cast(e.sales_date as varchar), 1, 7) as sales_month
from enriched e join team t on e.sales_person_id = t.id
"""

_MANIFEST = """
mlog as (
  select cast(user_id as varchar) as file_name,
         case when event_type = 'purchase' then 'I' else 'A' end as status, ts, event_id
  from events
),
mlatest as (
  select file_name, arg_max(status, row(ts, event_id)) as status, max(ts) as event_ts
  from mlog group by file_name
)"""

ORACLE["manifest_latest"] = _with(_MANIFEST) + """
select file_name, status, cast(event_ts as varchar) as event_ts from mlatest
"""

ORACLE["active_files"] = _with(_MANIFEST) + """
select distinct cast(c_custkey as varchar) as file_name from customer
where cast(c_custkey as varchar) in (select file_name from mlatest where status = 'A')
"""

ORACLE["new_files_only"] = _with(_MANIFEST) + """
select cast(c_custkey as varchar) as file_name from customer
where cast(c_custkey as varchar) not in (select file_name from mlatest where status = 'I')
"""

# ---------------------------------------------------------------- drops
# The drop design (one folder per order priority) restated in SQL.
_DROPROWS = """
droprows as (
  select o_custkey as customer_id, cast(s_nationkey as bigint) as store_id,
         p_name as product_name, cast(o_orderdate as date) as sales_date,
         l_suppkey as sales_person_id, cast(p_retailprice as decimal(18,2)) as price,
         cast(l_quantity as integer) as quantity,
         cast(l_extendedprice as decimal(18,2)) as total_cost,
         l_linestatus, l_returnflag,
         case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high'
              when '3-MEDIUM' then 'medium 50% [a] #1' when '4-NOT SPECIFIED' then 'unspecified'
              when '5-LOW' then 'low' end as "drop"
  from lineitem join orders on l_orderkey = o_orderkey
                join supplier on l_suppkey = s_suppkey
                join part on l_partkey = p_partkey
)"""

_CONTRACT = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"

ORACLE["file_listing"] = _with(_DROPROWS) + """
select distinct "drop",
       case when "drop" = 'low' then '.json' else '.csv' end as extension,
       "drop" <> 'low' as accepted
from droprows
"""

ORACLE["header_inventory"] = _with(_DROPROWS) + f"""
select distinct "drop",
  case "drop"
    when 'urgent' then 'customer_id,store_id,product_name,sales_date,sales_person_id,quantity,total_cost'
    when 'high' then '{_CONTRACT},l_linestatus,l_returnflag'
    when 'medium 50% [a] #1' then '{_CONTRACT}'
    when 'unspecified' then 'SOURCE_FILE,L_LINESTATUS,TOTAL_COST,QUANTITY,PRICE,SALES_PERSON_ID,SALES_DATE,PRODUCT_NAME,STORE_ID,CUSTOMER_ID'
  end as header,
  case "drop" when 'urgent' then 7 when 'medium 50% [a] #1' then 8 else 10 end as n_columns
from droprows where "drop" <> 'low'
"""

ORACLE["schema_check"] = _with(_DROPROWS) + """
select distinct "drop", "drop" <> 'urgent' as valid,
       case when "drop" = 'urgent' then 'price' else '' end as missing,
       case "drop" when 'high' then 'l_linestatus,l_returnflag'
                   when 'unspecified' then 'l_linestatus,source_file' else '' end as extras
from droprows where "drop" <> 'low'
"""

ORACLE["quarantine_split"] = _with(_DROPROWS) + """
select "drop", case when "drop" = 'low' then 'extension' else 'missing columns' end as reason,
       case when "drop" = 'urgent' then 'price' end as missing, count(*) as data_rows
from droprows where "drop" in ('urgent', 'low') group by 1, 2, 3
"""

ORACLE["bad_rows"] = _with(_DROPROWS) + """
select "drop", customer_id, sales_person_id, strftime(sales_date, '%d/%m/%Y') as sales_date,
       'sales_date' as bad_columns
from droprows where "drop" = 'high' and l_returnflag = 'R'
"""

_GOOD = """
good as (
  select *, case when "drop" in ('high', 'unspecified')
                 then l_linestatus || ', ' || l_returnflag end as additional_column
  from droprows
  where "drop" in ('high', 'medium 50% [a] #1', 'unspecified')
    and not ("drop" = 'high' and l_returnflag = 'R')
)"""

ORACLE["fold_extra_columns"] = _with(_DROPROWS, _GOOD) + """
select "drop", customer_id, store_id, product_name, cast(sales_date as varchar) as sales_date,
       sales_person_id, cast(price as double) as price, quantity,
       cast(total_cost as double) as total_cost, additional_column
from good
"""

ORACLE["conform_union"] = _with(_DROPROWS, _GOOD) + """
select "drop", count(*) as rows, cast(sum(total_cost) as double) as total_cost,
       count(additional_column) as with_extras
from good group by 1
"""

ORACLE["csv_roundtrip_scan"] = _with(_DROPROWS) + """
select store_id, count(*) as rows, cast(sum(quantity) as bigint) as quantity,
       cast(sum(total_cost) as double) as total_cost
from droprows where "drop" = 'medium 50% [a] #1' group by 1
"""

ORACLE["total_cost_check"] = _with(_DROPROWS) + """
select store_id, count(*) as rows,
       count(case when total_cost <> price * quantity then 1 end) as mismatched,
       count(case when total_cost is null or price is null or quantity is null then 1 end)
         as incomplete
from droprows group by 1
"""

# ---------------------------------------------------------------- sinks
ORACLE["parquet_roundtrip"] = ORACLE["customer_mart"]
ORACLE["latest_run"] = ORACLE["sales_mart"]
ORACLE["jdbc_roundtrip"] = ORACLE["sales_mart"]

ORACLE["partition_pruned_read"] = _with(_LINES, _DIMS, _ENRICHED) + """
select substring(cast(sales_date as varchar), 1, 7) as sales_month, store_id,
       count(*) as rows, cast(sum(total_cost) as double) as total_cost
from enriched
where store_id <= 5 and substring(cast(sales_date as varchar), 1, 7) >= '1998-01'
group by 1, 2
"""

ORACLE["bucketed_join"] = _with(_LINES, _DIMS, _ENRICHED) + """
select e.customer_id, c.first_name || ' ' || c.last_name as full_name,
       cast(sum(e.total_cost) as double) as total_sales, count(*) as lines
from enriched e join cust c on e.customer_id = c.customer_id
group by e.customer_id, c.first_name, c.last_name
"""

# ---------------------------------------------------------------- stream and job


ORACLE["batch_marts"] = _with(_DROPROWS, _GOOD, _DIMS, """
genriched as (
  select g.* from good g
  join team t on g.sales_person_id = t.id
  join store s on g.store_id = s.id
  join cust c on g.customer_id = c.customer_id
),
gtot as (
  select store_id, sales_person_id, substring(cast(sales_date as varchar), 1, 7) as sales_month,
         sum(total_cost) as total_sales
  from genriched group by 1, 2, 3
),
granked as (
  select *, rank() over (partition by store_id, sales_month order by total_sales desc nulls last) as rnk
  from gtot
)""") + """
select r.store_id, r.sales_person_id, t.first_name || ' ' || t.last_name as full_name,
       r.sales_month, cast(r.total_sales as double) as total_sales,
       cast(round(case when rnk = 1 then total_sales * cast(0.01 as decimal(3,2)) else 0 end, 2)
            as double) as incentive
from granked r join team t on r.sales_person_id = t.id
"""

ORACLE["stream_ingest"] = ORACLE["batch_marts"]

# the second version of the drop alone: each content once
ORACLE["corrected_drop"] = ORACLE["batch_marts"].replace(_GOOD.strip(), """good as (
  select * from droprows where "drop" in ('high', 'medium 50% [a] #1', 'low')
)""")
ORACLE["late_dimensions"] = ORACLE["customer_mart"]

# ---------------------------------------------------------------- generator
# The draws restated: MD5 of seed|draw|keys, four 32-bit numbers each.


def _number(draw: int, keys: str, i: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', 42, {draw}, {keys})), {1 + 8 * i}, 8))::bigint"


def _numbered(name: str, select: str, table: str, key: str) -> str:
    return f"""
{name}_b as (select {select}, {_number(0, key, 0)} % 4096 as bucket from {table}),
{name}_p as (select *, row_number() over (partition by bucket order by {key}) - 1 as place from {name}_b),
{name}_s as (select bucket, count(*) as size, row_number() over (order by bucket) - 1 as nth,
                    count(*) over () as filled from {name}_b group by bucket),
{name}_slots as (select s.slot, bucket, size from {name}_s, generate_series(0, 4095) as s(slot)
                 where s.slot % filled = nth)"""


_LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

ORACLE["synth_sales"] = _with(
    _numbered("c", "c_custkey", "customer", "c_custkey"),
    _numbered("s", "s_suppkey, s_nationkey", "supplier", "s_suppkey"),
    _numbered("p", "p_partkey, p_name, p_retailprice", "part", "p_partkey"),
    f"""
d as (select {", ".join(f"{_number(1 + i // 4, _LINE_KEYS, i % 4)} as n{i}" for i in range(8))} from lineitem)
""") + """
select c.c_custkey as customer_id, cast(s.s_nationkey as bigint) as store_id, p.p_name as product_name,
       cast(date '1995-01-01' + cast(n6 % 1000 as integer) as varchar) as sales_date,
       s.s_suppkey as sales_person_id,
       cast(cast(p.p_retailprice as decimal(18,2)) as double) as price,
       cast(n7 % 10 + 1 as integer) as quantity,
       cast(cast(p.p_retailprice as decimal(18,2)) * (n7 % 10 + 1) as double) as total_cost
from d join c_slots cs on n0 % 4096 = cs.slot
       join c_p c on c.bucket = cs.bucket and c.place = n1 % cs.size
       join s_slots ss on n2 % 4096 = ss.slot
       join s_p s on s.bucket = ss.bucket and s.place = n3 % ss.size
       join p_slots ps on n4 % 4096 = ps.slot
       join p_p p on p.bucket = ps.bucket and p.place = n5 % ps.size
"""
