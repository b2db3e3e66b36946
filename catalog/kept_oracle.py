"""Reference SQL of the queries over kept tables."""

from __future__ import annotations

from catalog.oracle import BASE, RAW_LOANS, SQL, TEXT_NULL, TWO_WAY, _P, closings, with_

SQL["scd2_in_batches"] = SQL["scd2"]
SQL["projected_days"] = f"""select cast(o_orderdate as date) as dt, count(*) as orders, cast(sum({_P}) as decimal(28,2)) as total from orders
where cast(o_orderdate as date) between date '1995-03-10' and date '1995-03-12' group by 1"""
SQL["swapped_tables"] = """with counted as (select count(distinct o_orderstatus) as rows, case when count(*) > 0 then count(*) end as orders from orders)
select step, columns::integer as columns, rows, orders from counted,
(values ('first', 3), ('other columns', 4), ('failed', 4), ('rolled back', 3), ('folder', 2), ('other folder', 3)) s(step, columns)"""
PARTNER_COLUMNS = "correspondent_name nmls_number address city state zip_code account_executive_id".split()
_FAILS = {"bad bluewater id": """"blueWaterId" = 'n/a'""", "no product": '"productType" is null', "no amount": '"dpaAmount" is null'}


def _reasons(tests: dict[str, str]) -> str:
    return "concat_ws('; ', " + ", ".join(f"case when {test} then '{name}' end" for name, test in tests.items()) + ")"


SQL["dead_letters_reprocessed"] = with_(
    {
        **RAW_LOANS,
        "judged": f'select "_id", {_reasons(_FAILS)} as before, "productType", "dpaAmount", "blueWaterId" from raw_loans',
        "fixed": """select "_id", before, "blueWaterId" = 'n/a' as renumbered, before = 'no product' as named,
 concat_ws('; ', case when "productType" is null and before <> 'no product' then 'no product' end, case when "dpaAmount" is null then 'no amount' end) as once
from judged""",
        # What lacks only its product after the first run is recovered by the second.
        "twice": "select *, case when once = 'no product' then '' else once end as after from fixed",
    },
    """select case when before = '' then 'good' when after = '' then 'recovered' else 'open' end as state, after as reasons,
 case when before = '' or after = '' then 0 when before <> after or coalesce(renumbered, false) or named then 2 else 1 end::integer as attempt,
 count(*) as loans, count(distinct "_id") as ids from twice group by 1, 2, 3""",
)
SQL["closings_from_buckets"] = SQL["monthly_closings"]
SQL["buckets_compacted"] = "select user_id, max(ts) as ts from events group by 1"
SQL["stored_schema"] = """select 'c_custkey' as "column", 2 * count(*) as present, '2024-01-01 00:00:00' as run_ts, 'bigint' as type from customer
union all select 'c_name', count(c_name), '2024-01-01 00:00:00', 'string' from customer
union all select 'c_nationkey', count(c_nationkey), '2024-01-02 00:00:00', 'int' from customer"""
SQL["ordered_closings"] = with_(
    {**BASE, "found": closings("base", "DPA", buyer=TWO_WAY)},
    """select row_number() over (order by closing_year desc, closing_month desc, buyer)::integer as place, year_month, buyer, closing_count from found""",
)
SQL["newest_listed_files"] = """select 'external' as stem, o_orderstatus, count(*) as orders from orders where o_orderstatus = 'F' group by 2
union all select 'internal', o_orderstatus, count(*) from orders where o_orderstatus = 'P' group by 2"""
SQL["curate_workbooks"] = """select case p_brand when 'Brand#11' then 'a.xlsx' else 'b.xlsx' end as _source_file, p_name as part_name, cast(p_size as varchar) as size,
 p_type as kind, case p_brand when 'Brand#22' then p_brand end as brand from part where p_brand in ('Brand#11', 'Brand#22')"""
SQL["star_partners_all_columns"] = with_(
    RAW_LOANS, f"""select distinct "correspondentId" as correspondent_id, {", ".join(f"{TEXT_NULL} as {c}" for c in PARTNER_COLUMNS)},
 cast(null as timestamp) as created_at from raw_loans"""
)
SQL["backfill_reduced"] = """select o_orderkey, case when o_orderkey % 50 <> 0 then o_orderpriority else o_orderstatus || ':3' end as priority from orders"""
