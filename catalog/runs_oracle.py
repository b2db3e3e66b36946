"""Reference SQL of the queries of whole runs."""

from __future__ import annotations

from catalog.inputs import raw_sql
from catalog.oracle import BASE, CALENDAR, SQL, STAR, WITH_PARTNERS, _P, percent, with_

RUN = "'2024-01-20 00:00:00'"
LATELY = "ts >= timestamp '2024-01-13'"

_LOG = f"""select 'orders' as source, 'success' as status, count(*) as records, count(*) as written, false as failed, {RUN} as run_ts from orders
union all select 'events', 'success', count(*), count(*), false, {RUN} from events where {LATELY}
union all select 'nothing', 'skipped', 0, null, false, {RUN}
union all select 'unknown', 'error', null, null, true, {RUN}"""
SQL["extract_run"] = _LOG
SQL["extract_totals"] = f"""select status, count(*) as sources, cast(coalesce(sum(records), 0) as bigint) as records from ({_LOG}) group by 1"""
SQL["extract_read_back"] = f"""select 'events' as _etl_collection, '2024-01-20' as _etl_extraction_date, event_type, 2 * count(*) as rows from events where {LATELY} group by 3
union all select 'orders', '2024-01-20', o_orderstatus, count(*) from orders group by 3"""
SQL["merged_files"] = """select 1 as batch, count(*) as rows, count(c_name) as names, 0::bigint as nations from customer
union all select 2, count(*), 0, count(c_nationkey) from customer"""
SQL["newest_files"] = """with files as (
 select ['External', 'INTERNAL', 'other'][o_custkey % 3 + 1] as stem, cast(o_orderdate as date) as day, o_orderkey as k,
 case when o_orderkey % 2 = 0 then '.xlsx' else '.XLS' end as ending from orders where o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0
), paths as (select lower(stem) as stem, '/in/' || stem || '_' || lpad(cast(k as varchar), 9, '0') || ending as path, day from files where stem <> 'other')
select stem, path, day as "modificationTime" from paths qualify row_number() over (partition by stem order by day desc, path desc) = 1"""
SQL["duplicate_names"] = "select o_orderstatus as status, o_orderpriority as status_1, count(*) as orders from orders group by 1, 2"
SQL["curate_sheets"] = """select p_brand as sheet, '2024-01-20' as dt, count(*) as parts, cast(sum(p_size) as bigint) as sizes,
 max(cast(p_partkey * 3 + 30000 as varchar)) as numbers from part where p_brand in ('Brand#11', 'Brand#22') group by 1"""
SQL["sheet_without_header"] = """with numbered as (
 select nullif(p_brand, 'Brand#11') as sheet, p_partkey, p_size, row_number() over (partition by p_brand order by p_partkey) as n from part)
select sheet, count(*) filter (where n > 1) as rows, cast(min(p_partkey) filter (where n > 1) + 40 as integer) as first_row,
 cast(min(p_partkey) as varchar) as header, cast(sum(p_size) filter (where n > 1) as bigint) as sizes
from numbered group by 1 having count(*) > 1"""
SQL["sinks_read_back"] = f"""select target, n * count(*) as rows, cast(n * sum({_P}) as decimal(28,2)) as total
from orders, (values ('raw', 2), ('staging', 1), ('sized', 1), ('compact', 1), ('report', 1), ('daily', 2), ('laid_out', 1), ('snapshot', 1),
 ('stored', 1), ('view', 1)) t(target, n) group by target, n"""
SQL["stream_latest_events"] = "select user_id, max(ts) as ts, compacted from events, (values (false), (true)) c(compacted) group by user_id, compacted"
SQL["star_of_versions"] = with_(
    {**STAR, **WITH_PARTNERS, "raw_users": raw_sql("users")},
    f"""select {RUN} as _etl_loaded_at, 'dimensions/dim_correspondent' as "table", count(*) as rows from partners
union all select {RUN}, 'dimensions/dim_user', count(*) from raw_users union all select {RUN}, 'dimensions/dim_loan', count(*) from dim_loan
union all select {RUN}, 'facts/fact_loan_status', count(*) from loan_status
union all select {RUN}, 'facts/fact_loan_metrics', count(*) from loan_metrics""",
)
SQL["status_of_versions"] = with_(STAR, "select current_status, count(*) as loans from loan_status group by 1")
SQL["metrics_of_repeated_loans"] = with_(
    {**BASE, "calendar": CALENDAR},
    """select d.year_month, product_type, workflow_type, count(distinct loan_id) as loan_count, cast(2 * sum(dpa_amount) as decimal(28,2)) as total_dpa_volume
from base join calendar d on closing_date_key = d.date_id group by 1, 2, 3""",
)
_UNITS = "cast({0}.amount * 1000000 as hugeint)"


def _change(earlier: str) -> str:
    return percent(f"({_UNITS.format('m')} - {_UNITS.format(earlier)})", _UNITS.format(earlier), "decimal(18,2)")


SQL["growth_of_amounts"] = f"""with monthly as (
 select cast(date_trunc('month', o_orderdate) as date) as month_start,
 cast(sum(case when month(o_orderdate) = 3 then 0 else {_P} * cast(0.0001 as decimal(5,4)) end) as decimal(28,6)) as amount from orders group by 1)
select m.month_start, m.amount, {_change('p')} as mom_pct, {_change('y')} as yoy_pct from monthly m
left join monthly p on p.month_start = m.month_start - interval 1 month left join monthly y on y.month_start = m.month_start - interval 12 month"""
