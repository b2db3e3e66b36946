"""Reference SQL (DuckDB) for the queries, written from the definitions alone."""

from __future__ import annotations

from catalog.inputs import raw_sql

AS_OF = "date '1999-06-15'"


# ------------------------------------------------------------------ fragments


def clean(c: str) -> str:
    return rf"nullif(trim(regexp_replace({c}, '^\{{value=(.*)\}}$', '\1')), '')"


def money(c: str, kind: str = "decimal(18,2)") -> str:
    return f"try_cast({clean(c)} as {kind})"


def rate(c: str) -> str:
    return money(c, "decimal(10,6)")


def whole(c: str) -> str:
    return f"try_cast(trunc(try_cast({clean(c)} as decimal(38,10))) as integer)"


def date_of(c: str) -> str:
    return f"try_cast(substr({c}, 1, 10) as date)"


def time_of(c: str) -> str:
    return f"try_cast({c} as timestamp)"


def key_of(day: str) -> str:
    return f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as integer)"


def month_text(day: str) -> str:
    return f"strftime({day}, '%Y-%m')"


def month_label(day: str) -> str:
    return f"strftime({day}, '%b %Y')"


def month_sort(day: str) -> str:
    return f"cast(year({day}) * 100 + month({day}) as integer)"


def avg_half_up(c: str, scale: int = 2) -> str:
    """Decimal mean rounded half up, in whole numbers so that no double is involved."""
    units = f"cast(sum({c}) * {10 ** scale} as hugeint)"
    return (
        f"case when count({c}) > 0 then cast(cast((2 * {units} + count({c})) // (2 * count({c})) as decimal(38,{scale}))"
        f" / {10 ** scale} as decimal(18,{scale})) end"
    )


def percent(part: str, total: str, kind: str = "decimal(5,2)") -> str:
    """100 * part / total, rounded half away from zero, in whole numbers."""
    scaled = f"cast({part} as hugeint) * 20000"
    return (
        f"cast(cast(sign({part}) * ((abs({scaled}) + {total}) // (2 * nullif({total}, 0))) as decimal(38,2)) / 100 as {kind})"
    )


def with_(ctes: dict[str, str], query: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes.items()) + "\n" + query


# ---------------------------------------------------------------- star schema

BUCKET = (
    "case regexp_replace(lower({c}), '\\s', '', 'g') when '0-29' then '0-29' when '0to29' then '0-29' when '0_29' then '0-29'"
    " when '30-59' then '30-59' when '30to59' then '30-59' when '30_59' then '30-59'"
    " when '60-89' then '60-89' when '60to89' then '60-89' when '60_89' then '60-89'"
    " when '90+' then '90+' when '90plus' then '90+' when '90' then '90+' end"
)
SETTLED = "case lower({c}) when 'settled' then 'Settled' when 'unsettled' then 'Unsettled' end"
BOOLEAN = (
    "case when lower({c}) in ('true','t','1','yes','y') then true"
    " when lower({c}) in ('false','f','0','no','n') then false end"
)
TEXT_NULL = "cast(null as varchar)"
TIME_NULL = "cast(null as timestamp)"
MONEY_NULL = "cast(null as decimal(18,2))"
RATE_NULL = "cast(null as decimal(10,6))"
INT_NULL = "cast(null as integer)"

RAW_LOANS = {"raw_loans": raw_sql("loans")}

DIM_LOAN = f"""select "_id" as loan_id, "ahLoanNumber" as ah_loan_number, "lenderLoanNumber" as lender_loan_number,
 "usfLoanNumber" as usf_loan_number, {TEXT_NULL} as bsi_loan_number, {TEXT_NULL} as essex_loan_number,
 {whole('"blueWaterId"')} as bluewater_id, "workflowType" as workflow_type, "productType" as product_type,
 "dpaRepaymentType" as dpa_repayment_type, {TEXT_NULL} as first_mortgage_type, {TEXT_NULL} as property_address,
 {TEXT_NULL} as property_city, "propertyState" as property_state, "propertyZip" as property_zip,
 {TEXT_NULL} as property_county, {TEXT_NULL} as property_type, {whole('"numberOfUnits"')} as number_of_units,
 "loanOfficerName" as loan_officer_name, {TEXT_NULL} as loan_officer_email, {TEXT_NULL} as loan_officer_nmls,
 "correspondentId" as correspondent_id, {TEXT_NULL} as created_by_user_id,
 {TEXT_NULL} as purchase_clearing_assigned_to_id, {TEXT_NULL} as purchase_clearing_assistant_assigned_to_id,
 {TEXT_NULL} as eep_processor_id, {TEXT_NULL} as eep_underwriter_id, {TEXT_NULL} as eep_closer_id,
 "secondMortgageInvestorId" as second_mortgage_investor_id, {TEXT_NULL} as investor_org_id,
 "investorName" as investor_name, {clean('"secondMortgageMinNumber"')} as second_mortgage_min_number,
 {time_of('"createdAt"')} as created_at, {date_of('"closingDate"')} as closing_date,
 {date_of('"fundingDate"')} as funding_date, {time_of('"closedAt"')} as closed_at
from raw_loans"""

_ABSENT_TIMES = "second_mortgage_next_payment_due_date second_mortgage_last_payment_made_date purchase_clearing_intake_audit_ready_date purchase_clearing_intake_audit_completion_date second_mortgage_first_payment_due_date"
FACT_STATUS = f"""select "_id" as loan_id, "correspondentId" as correspondent_id, "status" as current_status,
 "health" as health_status, {TEXT_NULL} as health_reason, {TEXT_NULL} as second_mortgage_ownership_status,
 {SETTLED.format(c=clean('"secondMortgageSettledStatus"'))} as second_mortgage_settled_status,
 {BUCKET.format(c=clean('"secondMortgageDelinquencyStatus"'))} as second_mortgage_delinquency_status,
 {BOOLEAN.format(c=clean('"isEmployeeLoan"'))} as is_employee_loan, {TEXT_NULL} as second_mortgage_sold_to,
 {TIME_NULL} as second_mortgage_sold_date, {TEXT_NULL} as second_mortgage_invoice_trade_number,
 {clean('"secondMortgageMinNumber"')} as second_mortgage_min_number, {TEXT_NULL} as eep_processor_id,
 {TEXT_NULL} as eep_underwriter_id, {TEXT_NULL} as eep_closer_id,
 "firstMortgageOwnershipStatus" as first_mortgage_ownership_status,
 {key_of(date_of('"closingDate"'))} as closing_date_key, {key_of(date_of('"fundingDate"'))} as funding_date_key,
 {key_of(date_of('"createdAt"'))} as created_date_key, {key_of(date_of('"purchasedAt"'))} as purchased_date_key,
 {", ".join(f"{INT_NULL} as {n}_key" for n in _ABSENT_TIMES.split())},
 {time_of('"registeredAt"')} as registered_at, {time_of('"lockedAt"')} as locked_at,
 {time_of('"closedAt"')} as closed_at, {time_of('"purchasedAt"')} as purchased_at,
 {", ".join(f"{TIME_NULL} as {n}" for n in f"securitized_at cancelled_at denied_at {_ABSENT_TIMES}".split())},
 {date_of('"fundingDate"')} as funding_date,
 {", ".join(f"{TIME_NULL} as {n}" for n in "clear_to_close_at approved_for_purchase_at all_conditions_cleared_at closed_loan_package_received_at closed_loan_package_indexed_at closed_loan_package_boarded_at collateral_received_at reimbursed_at".split())}
from raw_loans"""

FACT_METRICS = f"""select "_id" as loan_id, "correspondentId" as correspondent_id, "productType" as product_type,
 "workflowType" as workflow_type, {key_of(date_of('"closingDate"'))} as closing_date_key,
 {MONEY_NULL} as first_mortgage_base_amount, {money('"firstMortgageTotalLoanAmount"')} as first_mortgage_total_amount,
 {rate('"firstMortgageInterestRate"')} as first_mortgage_interest_rate, {RATE_NULL} as first_mortgage_ltv,
 {whole('"firstMortgageTerm"')} as first_mortgage_term_months, {money('"dpaAmount"')} as dpa_amount,
 {rate('"dpaPercent"')} as dpa_percent, {money('"secondMortgageUpb"')} as second_mortgage_upb,
 {RATE_NULL} as second_mortgage_interest_rate, {INT_NULL} as second_mortgage_term_months,
 {MONEY_NULL} as purchase_price, {MONEY_NULL} as appraised_value, {rate('"combinedLoanToValueRatio"')} as combined_ltv,
 {MONEY_NULL} as total_income, {MONEY_NULL} as total_assets, {MONEY_NULL} as total_liabilities,
 {rate('"totalBackEndDebtToIncomeRatio"')} as backend_dti, {RATE_NULL} as frontend_dti,
 {whole('"finalQualifyingCreditScore"')} as credit_score, {MONEY_NULL} as monthly_payment,
 {MONEY_NULL} as escrow_payment, {MONEY_NULL} as pmi_payment, {RATE_NULL} as base_price, {RATE_NULL} as total_price
from raw_loans"""

STAR = {
    **RAW_LOANS,
    "dim_loan": DIM_LOAN,
    "loan_status": FACT_STATUS,
    "loan_metrics": FACT_METRICS,
}
BASE = {
    **STAR,
    "base": """select l.*, s.* exclude (loan_id, correspondent_id, second_mortgage_min_number, eep_processor_id,
 eep_underwriter_id, eep_closer_id, closed_at, funding_date),
 m.* exclude (loan_id, correspondent_id, product_type, workflow_type, closing_date_key)
from dim_loan l left join loan_status s using (loan_id) left join loan_metrics m using (loan_id)""",
}

PARTNERS = f"""select "_id" as correspondent_id, "name" as correspondent_name, "nmlsNumber" as nmls_number,
 {TEXT_NULL} as address, {TEXT_NULL} as city, "state" as state, coalesce("zip", "zipCode") as zip_code,
 {time_of('"createdAt"')} as created_at,
 coalesce("accountExecutiveId", nullif(regexp_extract("accountExecutiveIds", '^\\s*\\[\\s*"?([^"\\],\\]]+)', 1), '')) as account_executive_id
from raw_partners"""
WITH_PARTNERS = {"raw_partners": raw_sql("correspondents"), "partners": PARTNERS}

_BORROWER_TEXT = {
    "first_name": "firstName", "middle_name": "middleName", "last_name": "lastName", "suffix": "suffix",
    "email": "email", "primary_phone": "primaryPhoneNumber", "home_phone": "homePhoneNumber", "work_phone": "workPhoneNumber",
    "marital_status": "maritalStatus", "ethnicity": "ethnicity", "race": "race", "sex": "sex",
    "occupancy_type": "occupancyType", "current_address": "currentAddress", "current_city": "currentCity",
    "current_state": "currentState", "current_zip": "currentZip", "employer_name": "employerName", "borrower_type": "position",
}


def children(column: str, position: str) -> dict[str, str]:
    """Elements of a JSON array column of raw_loans, numbered from 0."""
    good = f"""case when json_valid("{column}") then "{column}" end"""
    return {
        "lists": f"""select "_id" as loan_id, cast({good} as json) as items from raw_loans where json_valid("{column}")""",
        "elements": f"""select loan_id, cast(i as integer) as {position}, items->cast(i as integer) as e
from lists, lateral (select unnest(range(cast(json_array_length(items) as bigint))) as i)""",
    }


def child_id(position: str) -> str:
    return f"('0x' || left(md5(loan_id || ':' || {position}), 15))::bigint"


BORROWERS = f"""select {child_id('borrower_position')} as borrower_id, loan_id, borrower_position,
 {", ".join(f"e->>'{raw}' as {name}" for name, raw in _BORROWER_TEXT.items())},
 '***-**-' || right(e->>'ssn', 4) as ssn_masked, try_cast(e->>'dateOfBirth' as date) as date_of_birth,
 {whole("(e->>'fico')")} as credit_score, try_cast(e->>'dti' as double) as dti,
 try_cast(e->>'monthlyIncome' as double) as monthly_income, try_cast(e->>'yearsWorked' as double) as years_worked,
 borrower_position = 0 as is_primary
from elements"""
WITH_BORROWERS = {**children("borrowers", "borrower_position"), "borrowers": BORROWERS}

ENTRIES = f"""select {child_id('array_index')} as eep_processing_entry_id, loan_id, array_index, e->>'_key' as entry_key, {whole("(e->>'_position')")} as entry_position,
 try_cast(e->>'at' as timestamp) as processed_at, coalesce(e->>'userId', e->>'user') as user_id,
 e->>'newProcessingStatus' as new_processing_status from elements"""

CONDITIONS = f"""select "_id" as loancondition_id, "loanId" as loan_id, "conditionSource" as condition_source,
 "conditionType" as condition_type,
 {", ".join(f"{TEXT_NULL} as {n}" for n in "document_name document_type field_name bluewater_field_value_id unconfirmed_field_value confirmed_field_value description".split())},
 {time_of('"createdAt"')} as created_at, {TEXT_NULL} as created_by_id, {time_of('"submittedAt"')} as submitted_at,
 {TEXT_NULL} as submitted_by_id, {time_of('"insufficientAt"')} as insufficient_at, {TEXT_NULL} as insufficient_by_id,
 {time_of('"clearedAt"')} as cleared_at, "clearedById" as cleared_by_id,
 case when "clearedAt" is not null then 'Cleared' when "insufficientAt" is not null then 'Insufficient'
  when "submittedAt" is not null then 'Submitted' else 'Created' end as status
from raw_conditions"""
WITH_CONDITIONS = {"raw_conditions": raw_sql("conditions"), "conditions": CONDITIONS}

CALENDAR = """select d as date_key, cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_id,
 cast(year(d) as integer) as year, cast(month(d) as integer) as month, strftime(d, '%Y-%m') as year_month
from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d from orders)"""

SQL: dict[str, str] = {}

SQL["star_dim_loan"] = with_(
    {**STAR, "investors": raw_sql("investors")},
    """select l.*, coalesce(l.investor_name, i."name") as second_mortgage_investor_name
from dim_loan l left join investors i on l.second_mortgage_investor_id = i."_id" """,
)
SQL["star_loan_status"] = with_(STAR, "select * from loan_status")
SQL["star_loan_metrics"] = with_(STAR, "select * from loan_metrics")
SQL["star_borrowers"] = with_({**RAW_LOANS, **WITH_BORROWERS}, "select * from borrowers")
SQL["star_processing_entries"] = with_({**RAW_LOANS, **children("eepProcessingEntries", "array_index")}, ENTRIES)
SQL["star_correspondents"] = with_(WITH_PARTNERS, "select * from partners")
SQL["star_partners_from_loans"] = with_(
    RAW_LOANS, f"""select distinct "correspondentId" as correspondent_id, {TEXT_NULL} as correspondent_name from raw_loans"""
)
SQL["star_users"] = with_(
    {"raw_users": raw_sql("users")},
    f"""select "_id" as user_id, "name" as user_name, "email" as email, {BOOLEAN.format(c='"disableLogin"')} as disable_login,
 {TEXT_NULL} as postgres_id, {TEXT_NULL} as company_id, "__userType" as user_type,
 "correspondentId" as correspondent_id, {TIME_NULL} as last_active_at from raw_users""",
)
SQL["star_conditions"] = with_(WITH_CONDITIONS, "select * from conditions")
SQL["star_condition_documents"] = with_(
    {
        "raw_conditions": raw_sql("conditions"),
        "lists": """select "_id" as loancondition_id, "loanId" as loan_id, cast("documentTypes" as json) as items
from raw_conditions where "documentTypes" <> ''""",
    },
    """select loancondition_id, loan_id, cast(i as integer) as document_type_position, items->>cast(i as integer) as document_type
from lists, lateral (select unnest(range(cast(json_array_length(items) as bigint))) as i)
where items->>cast(i as integer) is not null""",
)
SQL["star_condition_events"] = """select cast(event_id as varchar) as loanconditionevent_id, cast(user_id as varchar) as loancondition_id,
 event_type, ts as event_at, 'u' || user_id as event_by_id, props as event_text from events"""
SQL["star_exceptions"] = f"""select cast(event_id as varchar) as loanexception_id, cast(user_id as varchar) as loan_id,
 event_type as exception_type, {TEXT_NULL} as description, ts as requested_at, 'u' || (user_id % 7) as requested_by_id,
 case when event_type = 'purchase' then ts end as approved_at, case when event_type = 'purchase' then 'boss' end as approved_by_id,
 case when event_type = 'error' then ts end as denied_at, {TEXT_NULL} as denied_by_id, {TIME_NULL} as created_at,
 {TEXT_NULL} as created_by_id from events"""
SQL["star_holidays"] = f"""select cast(o_orderkey as varchar) as holiday_id, cast(o_orderdate as date) as holiday_date,
 o_orderpriority as holiday_name, case when o_orderstatus = 'F' then 'true' else 'false' end as office_closed,
 {TEXT_NULL} as lock_desk_closes_at, cast(year(o_orderdate) as integer) as holiday_year,
 cast(month(o_orderdate) as integer) as holiday_month from orders"""
SQL["star_documents"] = f"""select cast(doc_id as varchar) as loandocument_id, cast(doc_id as integer) as postgres_id,
 {TEXT_NULL} as postgres_name, cast(doc_id % 100 as varchar) as loan_id, source || '-' || doc_id as name,
 {TEXT_NULL} as description, {TEXT_NULL} as content_type, cast(n_chars as integer) as size_bytes, {INT_NULL} as page_count,
 {", ".join(f"{TEXT_NULL} as {n}" for n in "s3_key s3_multipart_upload_id session_token uploaded_by_id archived_by_id loancondition_id loanconditionevent_id eep_condition_template_name file_hash".split())},
 {", ".join(f"{TIME_NULL} as {n}" for n in "uploaded_at archived_at uploaded_to_bluewater_at".split())},
 cast(null as double) as bluewater_transfer_milliseconds, case when doc_id % 2 = 0 then true end as bluewater_final_version,
 lang as document_type from documents"""
SQL["star_product_volume"] = with_(
    STAR,
    """select p.product_id, p.product_code, p.product_category, v.n as loan_count, v.total as total_volume
from (values (1,'DPA','Assistance'), (2,'EEP','Efficiency'), (3,'White Label','White Label'), (4,'Solar Program','Solar'),
 (5,'CSPortal','Portal'), (6,'Loan Depot','Partner')) p(product_id, product_code, product_category)
left join (select product_type, count(*) as n, cast(sum(first_mortgage_total_amount) as decimal(28,2)) as total
 from loan_metrics group by 1) v on v.product_type = p.product_code""",
)

# -------------------------------------------------------------------- reports

MONTH_COLUMNS = "cast(year(closing_date) as integer) as closing_year, cast(month(closing_date) as integer) as closing_month, strftime(closing_date, '%Y-%m') as year_month"
CLOSING_MEASURES = f"""count(*) as closing_count, cast(sum(coalesce(dpa_amount, 0)) as decimal(28,2)) as total_dpa_amount,
 {avg_half_up("coalesce(dpa_amount, cast(0 as decimal(18,2)))")} as avg_dpa_amount, count(distinct correspondent_id) as correspondent_count"""
CLOSED = "closing_date is not null and upper(coalesce(product_type, '')) = '{}'"
TWO_WAY = """case when upper(coalesce(first_mortgage_ownership_status, '')) like '%USF%' then 'USF'
 when usf_loan_number is not null and trim(usf_loan_number) <> '' then 'USF' else 'MWF' end"""
THREE_WAY = """case when upper(first_mortgage_ownership_status) like '%USF%' then 'USF'
 when usf_loan_number is not null and usf_loan_number <> '' then 'USF' when contract_date is not null then 'MWF' else 'Unknown' end"""
CONTRACTED = {
    **BASE,
    "contracted": f"""select b.*, p."contractDate" as contract_date from base b
left join ({raw_sql("correspondents")}) p on b.correspondent_id = p."_id" """,
}


def closings(source: str, product: str, extra: str = "", buyer: str = "", where: str = "") -> str:
    who = f", {buyer} as buyer" if buyer else ""
    by = "1, 2, 3, 4" if buyer else "1, 2, 3"
    return f"select {MONTH_COLUMNS}{who}, {CLOSING_MEASURES}{extra} from {source} where {CLOSED.format(product)}{where} group by {by}"


ENDS = ", min(closing_date) as first_closing, max(closing_date) as last_closing"
SQL["monthly_closings"] = with_(BASE, closings("base", "EEP", ENDS))
SQL["monthly_closings_one_year"] = with_(BASE, closings("base", "EEP", ENDS, where=" and year(closing_date) = 1998"))
SQL["monthly_closings_by_buyer"] = with_(BASE, closings("base", "DPA", buyer=TWO_WAY))
SQL["monthly_closings_by_buyer_raw"] = with_(BASE, closings("base", "DPA", buyer="first_mortgage_ownership_status"))
THREE = closings("contracted", "DPA", buyer=THREE_WAY)
SQL["monthly_closings_by_buyer_three_way"] = with_(CONTRACTED, THREE)
_PIVOT = "cast(sum(case when buyer = '{0}' then closing_count else 0 end) as bigint) as {1}"
SQL["buyer_pivot"] = with_(
    {**CONTRACTED, "three": THREE},
    f"""select year_month, {_PIVOT.format('USF', 'usf_closings')}, {_PIVOT.format('MWF', 'mwf_closings')},
 {_PIVOT.format('Unknown', 'unknown_closings')}, cast(sum(closing_count) as bigint) as total_closings from three group by 1""",
)
SQL["buyer_yearly"] = with_(
    {**CONTRACTED, "three": THREE},
    f"""select closing_year, {_PIVOT.format('USF', 'usf_total')}, {_PIVOT.format('MWF', 'mwf_total')},
 cast(sum(closing_count) as bigint) as grand_total from three group by 1""",
)
SQL["buyer_share"] = with_(
    {
        **CONTRACTED,
        "counted": f"""select {MONTH_COLUMNS}, {THREE_WAY} as buyer, count(*) as closing_count,
 cast(min(closing_date) as timestamp) as first_closing_date, cast(max(closing_date) as timestamp) as last_closing_date
from contracted where {CLOSED.format('DPA')} group by 1, 2, 3, 4""",
        "totalled": "select *, cast(sum(closing_count) over (partition by year_month) as bigint) as total_closings_month from counted",
    },
    f"""select closing_year, closing_month, year_month as closing_year_month, buyer, closing_count, first_closing_date,
 last_closing_date, total_closings_month, {percent('closing_count', 'total_closings_month')} as buyer_percentage from totalled""",
)
SQL["buyer_share_detail"] = with_(
    CONTRACTED,
    f"""select cast(year(closing_date) as integer) as year, cast(month(closing_date) as integer) as month, {THREE_WAY} as buyer,
 loan_id, correspondent_id, closing_date, dpa_amount from contracted where {CLOSED.format('DPA')}""",
)
REGISTRATIONS = """select cast(year(registered_at) as integer) as registration_year,
 cast(month(registered_at) as integer) as registration_month, strftime(registered_at, '%Y-%m') as year_month,
 coalesce(l.product_type, 'Unknown') as product_type, count(*) as registration_count,
 count(distinct l.correspondent_id) as correspondent_count, min(registered_at) as first_registration,
 max(registered_at) as last_registration
from loan_status s join dim_loan l using (loan_id) where registered_at is not null group by 1, 2, 3, 4"""
SQL["registrations_by_product"] = with_(STAR, REGISTRATIONS)
_REG = "cast(sum(case when product_type = '{0}' then registration_count else 0 end) as bigint) as {1}_registrations"
SQL["registrations_pivot"] = with_(
    {**STAR, "registered": REGISTRATIONS},
    f"""select year_month, {_REG.format('DPA', 'dpa')}, {_REG.format('EEP', 'eep')}, {_REG.format('White Label', 'whitelabel')},
 {_REG.format('Solar Program', 'solar')}, cast(sum(registration_count) as bigint) as total_registrations from registered group by 1""",
)
SQL["registrations_share"] = with_(
    {
        **STAR,
        "registered": REGISTRATIONS,
        "totalled": """select registration_year, registration_month, year_month, product_type, registration_count,
 cast(sum(registration_count) over (partition by year_month) as bigint) as total_registrations_month from registered""",
    },
    f"select *, {percent('registration_count', 'total_registrations_month')} as product_percentage from totalled",
)


def details(hidden: str, buyer: str, product: str, review: str, where: str) -> str:
    parts = f"""loan_id; ah_loan_number as loan_number; lender_loan_number; usf_loan_number; borrower_first_name; borrower_last_name;
 coalesce(borrower_first_name, '') || ' ' || coalesce(borrower_last_name, '') as borrower_name; {product};
 dpa_repayment_type as dpa_program_type; workflow_type; first_mortgage_total_amount as loan_amount; first_mortgage_base_amount;
 dpa_amount; dpa_percent; purchase_price; appraised_value; b.correspondent_id; p.correspondent_name as lender_correspondent;
 loan_officer_name; loan_officer_email; property_address; property_city; property_state; property_zip; property_county; property_type;
 cast(b.created_at as date) as application_received_date; cast(registered_at as date) as registration_date;
 cast(locked_at as date) as lock_date; cast(clear_to_close_at as date) as {review};
 cast(approved_for_purchase_at as date) as approval_date; closing_date; cast(closed_at as date) as funding_date;
 cast(purchased_at as date) as purchase_date; cast(securitized_at as date) as recording_date; current_status as loan_status;
 health_status; first_mortgage_ownership_status as servicing_member"""
    kept = [x.strip() for x in parts.split(";") if x.strip() not in hidden.split()]
    return with_(
        {
            **BASE,
            **WITH_PARTNERS,
            **WITH_BORROWERS,
            "heads": "select loan_id, first_name as borrower_first_name, last_name as borrower_last_name from borrowers where is_primary",
        },
        f"""select {MONTH_COLUMNS}, {buyer} as buyer, {", ".join(kept)} from base b left join heads using (loan_id)
left join partners p on b.correspondent_id = p.correspondent_id{where}""",
    )


SQL["loan_details"] = details(
    "", "first_mortgage_ownership_status", "product_type; first_mortgage_type", "eligibility_review_date", ""
)
SQL["product_loan_details"] = details(
    "first_mortgage_base_amount appraised_value loan_officer_email property_type",
    TWO_WAY, "product_type as dpa_program_name", "clear_to_close_date", f" where {CLOSED.format('DPA')}",
)
SQL["current_overview"] = with_(
    BASE,
    f"""select product_type as product, count(*) as loans, count(closing_date) as closings, count(registered_at) as registrations
from base where closing_date >= {AS_OF} - interval 1 month or registered_at >= {AS_OF} - interval 1 month group by 1""",
)
SQL["ytd_by_product"] = with_(
    BASE,
    f"""select product_type, strftime(closing_date, '%Y-%m') as month, count(*) as closings,
 cast(sum(dpa_amount) as decimal(28,2)) as dpa_volume from base where closing_date >= date_trunc('year', {AS_OF}) group by 1, 2""",
)
SQL["correspondent_dashboard"] = with_(
    {**BASE, **WITH_PARTNERS, "calendar": CALENDAR},
    f"""select p.correspondent_id, p.correspondent_name, d.year, d.month, d.year_month, count(distinct loan_id) as total_loans,
 count(distinct case when current_status = 'Purchased' then loan_id end) as purchased_loans,
 count(distinct case when current_status = 'Cancelled' then loan_id end) as cancelled_loans,
 cast(sum(first_mortgage_total_amount) as decimal(28,2)) as total_loan_volume,
 cast({avg_half_up('first_mortgage_interest_rate', 6)} as decimal(10,6)) as avg_interest_rate,
 cast(sum(credit_score) as double) / count(credit_score) as avg_credit_score,
 cast(sum(dpa_amount) as decimal(28,2)) as total_dpa_amount
from base b left join partners p on b.correspondent_id = p.correspondent_id join calendar d on b.closing_date_key = d.date_id
group by 1, 2, 3, 4, 5""",
)
SQL["monthly_metrics"] = with_(
    {**BASE, "calendar": CALENDAR},
    f"""select d.year, d.month, d.year_month, product_type, workflow_type, count(distinct loan_id) as loan_count,
 cast(sum(first_mortgage_total_amount) as decimal(28,2)) as total_volume, {avg_half_up('first_mortgage_total_amount')} as avg_loan_amount,
 cast(sum(dpa_amount) as decimal(28,2)) as total_dpa_volume, {avg_half_up('dpa_amount')} as avg_dpa_amount,
 cast(sum(credit_score) as double) / count(credit_score) as avg_credit_score,
 {avg_half_up('backend_dti', 6)} as avg_dti, {avg_half_up('combined_ltv', 6)} as avg_ltv
from base join calendar d on closing_date_key = d.date_id group by 1, 2, 3, 4, 5""",
)
SQL["amounts_by_month"] = with_(
    {**STAR, "calendar": CALENDAR},
    f"""select d.year_month, count(*) as dpa_loans, cast(sum(dpa_amount) as decimal(28,2)) as total_dpa,
 {avg_half_up('dpa_percent', 6)} as avg_dpa_percent
from loan_metrics join calendar d on closing_date_key = d.date_id where product_type = 'DPA' group by 1""",
)
SQL["volume_by_product"] = with_(
    STAR,
    "select product_type, count(*) as loan_count, cast(sum(first_mortgage_total_amount) as decimal(28,2)) as total_volume from loan_metrics group by 1",
)

# ---------------------------------------------------------------- procurement

_SHEET_TYPES = "ext int".split()
STANDARD = {
    # standard column: (external sheet column, internal sheet column)
    "first_name": ("borrower_first_name", "first_name"),
    "last_name": ("borrower_last_name", "last_name"),
    "home_buyers_name": ("home_buyers_name", "homebuyers_name"),
    "lender_loan_number": ("lender_loan", "Lender_Loan_Number"),
    "ah_loan_number": (None, "ah_loan_number"),
    "certificate_policy_number": ("certificate_policy", "policy_number"),
    "lender_name": ("lender", "lender_name"),
    "address": ("borrower_address", "address"),
    "city": ("borrower_city", "city"),
    "state": ("borrower_state", "state"),
    "zip": ("borrower_zip", "zip"),
    "county": ("county", None),
    "request_date_raw": ("date_requested_by_lender", "request_date"),
    "closed_bind_raw": ("closed_bind", "close_bind_date"),
    "effective_date_raw": ("effective_date", None),
    "approval_status_raw": ("approval_status", None),
    "policy_type_raw": ("policy_type", "policy_type"),
    "policy_type_secondary_raw": (None, None),
    "premium_raw": ("premium", "premium"),
    "flood_required_raw": ("flood_required", "flood_required"),
    "processor": (None, None),
    "insurance_rep": (None, None),
    "status_raw": ("status", "payment_status"),
    "property_condition_raw": ("property_conditions", "property_condition"),
    "year_built_raw": ("year", "year_built"),
    "sqft": (None, None),
    "flood_zone": ("fema_flood_zone", "flood_zone"),
    "dwelling_amount": ("dwelling_coverage", "dwelling_amount"),
    "carrier": ("carrier_s", None),
    "broker": (None, None),
    "provider": (None, "provider"),
    "sent_to_procurement_date_raw": (None, None),
    "cert_received_date_raw": (None, None),
    "follow_up_date_raw": (None, None),
    "determination_date_raw": (None, None),
}


def _side(tag: str, which: int, source: str) -> str:
    picked = [f'"{pair[which]}" as {n}' if pair[which] else f"{TEXT_NULL} as {n}" for n, pair in STANDARD.items()]
    return f"select '{tag}' as source_type, {', '.join(picked)} from {source}"


SHEETS = {
    "external_sheet": raw_sql("external_sheet"),
    "internal_sheet": raw_sql("internal_sheet"),
    "conformed": _side("External", 0, "external_sheet") + " union all " + _side("Internal Procured", 1, "internal_sheet"),
}


def token(c: str) -> str:
    return f"nullif(regexp_replace(upper(coalesce({c}, '')), '[^A-Z0-9]', '', 'g'), '')"


def squeezed(c: str) -> str:
    return f"nullif(regexp_replace(trim(regexp_replace({c}, '[^A-Z0-9 ]', '', 'g')), ' +', ' ', 'g'), '')"


def lender(c: str) -> str:
    value = f"upper(trim(coalesce({c}, '')))"
    for phrase in ("ITS SUCCESSORS AND/OR ASSIGNS", "AND/OR ASSIGNS", "ITS SUCCESSORS", "ISAOA", "ATIMA"):
        value = f"replace({value}, '{phrase}', ' ')"
    return squeezed(value)


def zip5(c: str) -> str:
    digits = f"regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"
    return f"case when length({digits}) >= 5 then substr({digits}, 1, 5) end"


def sheet_date(c: str) -> str:
    day = f"regexp_replace(trim({c}), '([Tt]|\\s+)\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?(\\.\\d+)?$', '')"
    return f"""cast(case when regexp_matches({day}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast({day} as date)
 when regexp_matches({day}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') then try_strptime({day}, '%m/%d/%Y')
 when regexp_matches({day}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}$')
 then try_strptime(regexp_replace({day}, '(\\d{{2}})$', '20\\1'), '%m/%d/%Y') end as date)"""


def sheet_money(c: str) -> str:
    return f"try_cast(nullif(regexp_replace(coalesce({c}, ''), '[$,\\s]', '', 'g'), '') as double)"


def up(c: str) -> str:
    return f"upper(trim(coalesce({c}, '')))"


FLOOD_CODE = f"""case when {up('flood_required_raw')} in ('NO', 'N', 'FALSE') or {up('flood_required_raw')} like '%NOT REQUIRED%' then 'NOT_REQ'
 when {up('flood_required_raw')} in ('YES', 'Y', 'TRUE') or {up('flood_required_raw')} like '%REQUIRED%' then 'REQ' else 'UNK' end"""
FLOOD_LABEL = "case {c} when 'REQ' then 'Flood Required' when 'NOT_REQ' then 'No Flood Required' else 'Unknown' end"
BY_POLICY = f"({up('policy_type_raw')} like '%FLOOD%' or {up('policy_type_raw')} = 'NFIP')"
ZONE_REQ = f"(starts_with({up('flood_zone')}, 'A') or starts_with({up('flood_zone')}, 'V'))"
ZONE_NOT = f"(starts_with({up('flood_zone')}, 'X') or {up('flood_zone')} in ('B', 'C', 'B/X'))"
STATUS = f"""case when source_type = 'External' then case {up('approval_status_raw')} when 'PENDING ITEMS' then 'PENDING'
 when '' then case {up('status_raw')} when '' then 'BLANK' else {up('status_raw')} end else {up('approval_status_raw')} end
 else case {up('status_raw')} when '' then 'BLANK' else {up('status_raw')} end end"""
TITLE = """case when status_normalized in ('ACTIVE') then 'Active' when status_normalized = 'PENDING' then 'Pending'
 when status_normalized = 'APPROVED' then 'Approved' when status_normalized in ('CANCELLED', 'CANCELED') then 'Cancelled'
 when status_normalized = 'DENIED' then 'Denied' when status_normalized = 'CLOSED WITHOUT APPROVAL' then 'Closed Without Approval'
 when status_normalized like '%PAID%' and status_normalized like '%FULL%' then 'Paid In Full'
 when status_normalized = 'BLANK' then 'Blank' else 'Unmapped' end"""
YEAR_BUILT = "coalesce(case when regexp_matches(trim(year_built_raw), '^[0-9]+$') then try_cast(trim(year_built_raw) as integer) end, try_cast(nullif(regexp_extract(year_built_raw, '(\\d{4})', 1), '') as integer))"
CONDITION = """case when upper(trim(coalesce(property_condition_raw, ''))) in ('C1','C2','C3','C4','C5') then upper(trim(property_condition_raw))
 when trim(coalesce(property_condition_raw, '')) = '' then 'MNF - BLANK' else 'MNF - ' || trim(property_condition_raw) end"""

PROCUREMENT = {
    **SHEETS,
    "keys": f"""select *, concat_ws(' ', nullif(trim(first_name), ''), nullif(trim(last_name), '')) as borrower_name,
 {token('lender_loan_number')} as loan_number_norm, {token('ah_loan_number')} as ah_loan_number_norm,
 {token('certificate_policy_number')} as policy_number_norm, {lender('lender_name')} as lender_name_norm,
 {squeezed(up('address'))} as address_norm, {zip5('zip')} as zip_norm, {YEAR_BUILT} as year_built,
 {sheet_date('request_date_raw')} as request_date, {sheet_date('closed_bind_raw')} as close_bind_date,
 {STATUS} as status_normalized, {FLOOD_CODE} as flood_required_code from conformed""",
    "named": """select *, coalesce(nullif(upper(trim(coalesce(home_buyers_name, ''))), ''), nullif(upper(borrower_name), '')) as loan_key,
 case when address_norm is not null or zip_norm is not null then coalesce(address_norm, '') || '|' || coalesce(zip_norm, '') end as address_key
from keys""",
    "fact": f"""select loan_key, source_type, status_normalized, policy_type_raw, policy_type_secondary_raw, flood_required_raw,
 cast(flood_required_code = 'REQ' as integer) as flood_required_flag, cast(flood_required_code = 'REQ' as integer) as is_flood_policy,
 cast(flood_required_code <> 'REQ' as integer) as is_hazard_policy, provider, lender_name, carrier, broker, state,
 {CONDITION} as property_condition, year_built,
 case when year_built <= 1978 then '1978 or older' when year_built > 1978 then 'Newer than 1978' end as age_bucket, flood_zone,
 {sheet_money('dwelling_amount')} as dwelling_amount, {sheet_money('premium_raw')} as premium, request_date,
 cast(null as date) as sent_to_procurement_date, cast(null as date) as cert_received_date,
 cast(date_trunc('month', request_date) as date) as request_month_start, close_bind_date,
 cast(date_trunc('month', close_bind_date) as date) as close_month_start,
 cast(close_bind_date is not null as integer) as closed_flag, cast(close_bind_date - request_date as integer) as days_to_close,
 home_buyers_name, borrower_name, ah_loan_number, ah_loan_number_norm, lender_loan_number, certificate_policy_number, address, city,
 zip, county, processor, insurance_rep, status_raw, approval_status_raw as approval_status, sqft,
 {sheet_date('effective_date_raw')} as effective_date, loan_number_norm, policy_number_norm,
 case when loan_number_norm is not null then 'LN:' || loan_number_norm else 'NAME:' || loan_key end as loan_key_v2,
 flood_required_code, {FLOOD_LABEL.format(c='flood_required_code')} as flood_required_label, {TITLE} as status_normalized_v2,
 cast({TITLE} <> 'Unmapped' as integer) as status_mapped, lender_name_norm, address_norm, zip_norm, address_key,
 case when loan_number_norm is not null
  then 'LN:' || loan_number_norm || '|' || coalesce(lender_name_norm, '') || '|' || coalesce(address_key, '')
  else 'NAME:' || loan_key || '|' || coalesce(address_key, '') end as loan_key_v3,
 case when flood_required_code <> 'UNK' then flood_required_code when {BY_POLICY} or {ZONE_REQ} then 'REQ'
  when {ZONE_NOT} then 'NOT_REQ' else 'UNK' end as flood_required_inferred_code,
 {FLOOD_LABEL.format(c=f"case when flood_required_code <> 'UNK' then flood_required_code when {BY_POLICY} or {ZONE_REQ} then 'REQ' when {ZONE_NOT} then 'NOT_REQ' end")} as flood_required_inferred_label,
 case when flood_required_code <> 'UNK' then 'raw' when {BY_POLICY} then 'policy-type-inferred'
  when {ZONE_REQ} or {ZONE_NOT} then 'zone-inferred' else 'unresolved' end as flood_required_inference_source,
 cast(null as date) as follow_up_date, cast(null as date) as determination_date,
 lender_name_norm as lender_canonical, lender_name_norm as lender_group, false as lender_alias_is_mapped
from named where loan_key is not null""",
}
LABEL = "coalesce(" + month_label("{c}") + ", 'Blank')"
SORT = "coalesce(" + month_sort("{c}") + ", 0)"
ANY_MONTH = "coalesce(request_month_start, close_month_start)"
VIEW = {
    **PROCUREMENT,
    "analysis": f"""select loan_key, loan_key_v2, loan_key_v3, loan_number_norm, policy_number_norm, ah_loan_number_norm,
 case when upper(source_type) like '%INTERNAL%' then 'Internal Procured' else 'External' end as source, source_type as source_type_raw,
 state, coalesce(nullif(trim(status_normalized_v2), ''), 'Blank') as status, status_normalized, status_normalized_v2,
 coalesce(nullif(trim(policy_type_raw), ''), 'Blank') as policy_type, policy_type_raw, flood_required_flag, flood_required_code,
 flood_required_inferred_code, {FLOOD_LABEL.format(c='flood_required_inferred_code')} as flood_required_bucket, age_bucket, year_built,
 property_condition, dwelling_amount, premium, closed_flag, days_to_close, request_date, close_bind_date, request_month_start,
 close_month_start, {LABEL.format(c='request_month_start')} as request_month_label, {SORT.format(c='request_month_start')} as request_year_month_sort,
 {LABEL.format(c='close_month_start')} as close_month_label, {SORT.format(c='close_month_start')} as close_year_month_sort,
 {LABEL.format(c=ANY_MONTH)} as month_label, {SORT.format(c=ANY_MONTH)} as year_month_sort, 'Jun 1999' as current_month_label,
 cast({LABEL.format(c=ANY_MONTH)} = 'Jun 1999' as integer) as is_current_month, 1 as is_worked_submission,
 cast(closed_flag = 1 as integer) as is_closed_submission, 1 as is_worked_loan_row, cast(closed_flag = 1 as integer) as is_closed_loan_row,
 lender_name, lender_canonical, lender_group, address, city, zip, county, borrower_name
from fact""",
}
SPINE = """select distinct m as month_start, strftime(m, '%b %Y') as month_label, cast(year(m) as integer) as year,
 cast(month(m) as integer) as month_num, cast(year(m) * 100 + month(m) as integer) as year_month_sort
from (select request_month_start as m from fact union all select close_month_start from fact) where m is not null"""
VIEW_SPINE = {**VIEW, "spine": SPINE}

SQL["conform_union"] = with_(SHEETS, "select * from conformed")
SQL["fact_procurement"] = with_(PROCUREMENT, "select * from fact")
SQL["lender_alias"] = with_(
    {
        **PROCUREMENT,
        "aliases": """select distinct 'ACME BANK ' || (s_suppkey % 20) || ' NA' as lender_name_norm, 'Acme ' || (s_suppkey % 20) as canonical
from supplier where s_suppkey % 20 % 2 = 0""",
    },
    """select f.lender_name_norm, coalesce(a.canonical, f.lender_name_norm) as lender_canonical,
 case when a.canonical is not null then 'Acme Group' else f.lender_name_norm end as lender_group,
 a.canonical is not null as lender_alias_is_mapped, count(*) as submissions
from fact f left join aliases a using (lender_name_norm) group by 1, 2, 3, 4""",
)
_FIRST = "first({0} order by coalesce(request_date, date '9999-12-31'), coalesce(close_bind_date, date '9999-12-31'), {0}) filter (where {0} is not null) as {0}"
_MASTER_FIRST = "loan_key loan_key_v2 loan_number_norm policy_number_norm lender_name_norm lender_canonical lender_group address_norm zip_norm address_key address city state zip county".split()
SQL["loan_master"] = with_(
    {
        **PROCUREMENT,
        "grouped": f"""select loan_key_v3, {", ".join(_FIRST.format(c) for c in _MASTER_FIRST)},
 max(cast(source_type like 'Internal%' as integer)) as has_internal_procured, max(cast(source_type = 'External' as integer)) as has_external,
 count(*) as procurement_row_count, min(request_date) as first_request_date, max(request_date) as latest_request_date,
 min(close_bind_date) as first_close_bind_date, max(close_bind_date) as latest_close_bind_date, max(closed_flag) as is_closed_any,
 count(distinct ah_loan_number_norm) as distinct_ah_loan_number_count, max(ah_loan_number_norm) as ah_loan_number_norm,
 count(distinct source_type) > 1 as has_multiple_source_types from fact group by 1""",
        "conflicts": """select loan_number_norm, count(distinct address_key) as distinct_address_key_count,
 count(distinct lender_name_norm) as distinct_lender_count from fact group by 1""",
    },
    """select g.*, distinct_address_key_count, distinct_lender_count,
 case when g.loan_number_norm is not null and policy_number_norm is not null and lender_name_norm is not null and address_key is not null
  then 'Full' else 'Partial' end as key_quality_flag,
 coalesce(distinct_address_key_count > 1, false) as has_address_conflict, coalesce(distinct_lender_count > 1, false) as has_lender_conflict
from grouped g left join conflicts c on g.loan_number_norm = c.loan_number_norm""",
)
SQL["month_spine"] = with_(
    {**PROCUREMENT, "spine": SPINE},
    "select * from spine union all select cast(null as date), 'Blank', cast(null as integer), cast(null as integer), 0",
)
SQL["procurement_analysis"] = with_(VIEW, "select * from analysis")
KPI = f"""select count(*) as worked_submissions, cast(sum(is_closed_submission) as bigint) as closed_submissions,
 count(distinct loan_key_v3) as worked_loans, count(distinct case when is_closed_loan_row = 1 then loan_key_v3 end) as closed_loans,
 count(distinct case when flood_required_inferred_code = 'REQ' then loan_key_v3 end) as loans_flood_required,
 count(distinct case when age_bucket = '1978 or older' then loan_key_v3 end) as worked_loans_1978_or_older,
 count(distinct case when age_bucket = 'Newer than 1978' then loan_key_v3 end) as worked_loans_newer_than_1978 from analysis"""
KPI_RATE = f"select *, {percent('closed_loans', 'worked_loans')} as loans_close_rate_pct from kpi"
SQL["kpi_scorecard"] = with_({**VIEW, "kpi": KPI}, KPI_RATE)
SQL["kpi_filtered"] = with_(
    {**VIEW, "kpi": KPI + " where source = 'External' and state in ('S1', 'S2') and status in ('Pending', 'Approved', 'Blank')"}, KPI_RATE
)
SQL["month_trend"] = with_(
    VIEW_SPINE,
    """select d.month_label, d.year_month_sort, coalesce(w.loans, 0) as worked_loans, coalesce(c.loans, 0) as closed_loans,
 coalesce(w.n, 0) as worked_submissions from spine d
left join (select request_month_start as m, count(distinct loan_key_v3) as loans, count(*) as n from analysis group by 1) w on w.m = d.month_start
left join (select close_month_start as m, count(distinct loan_key_v3) as loans from analysis where is_closed_loan_row = 1 group by 1) c on c.m = d.month_start""",
)


def mean_of_max(value: str, month: str, where: str) -> str:
    return f"""select m, cast(sum(cast(top as decimal(28,6))) as double) / count(top) as mean
from (select {month} as m, loan_key_v3, max({value}) as top from analysis where {where} and {month} is not null group by 1, 2) group by 1"""


def averages(value: str, label: str) -> str:
    return f"""select d.month_label, d.year_month_sort, w.mean as avg_{label}_worked, c.mean as avg_{label}_closed from spine d
left join ({mean_of_max(value, 'request_month_start', 'true')}) w on w.m = d.month_start
left join ({mean_of_max(value, 'close_month_start', 'is_closed_loan_row = 1')}) c on c.m = d.month_start"""


SQL["avg_coverage_by_month"] = with_(VIEW_SPINE, averages("dwelling_amount", "coverage"))
SQL["avg_premium_by_month"] = with_(VIEW_SPINE, averages("premium", "premium"))
SQL["avg_premium_observed"] = with_(
    VIEW,
    f"""select strftime(m, '%b %Y') as month_label, {month_sort('m')} as year_month_sort, m as month_start,
 w.mean as avg_premium_worked, c.mean as avg_premium_closed
from ({mean_of_max('premium', 'request_month_start', 'premium is not null')}) w
full join ({mean_of_max('premium', 'close_month_start', 'premium is not null and is_closed_loan_row = 1')}) c using (m)""",
)
SQL["flood_donut"] = with_(VIEW, "select flood_required_bucket, count(distinct loan_key_v3) as worked_loans from analysis group by 1")
SQL["closed_by_source"] = with_(
    VIEW, "select source, count(distinct case when is_closed_loan_row = 1 then loan_key_v3 end) as closed_loans from analysis group by 1"
)
SQL["filter_lists"] = with_(
    VIEW,
    " union all ".join(
        [f"select distinct '{c}' as list, {c} as value, 0 as sort_key from analysis" for c in ("source", "state", "status", "policy_type")]
        + ["select distinct 'month_label', month_label, request_year_month_sort from analysis"]
    ),
)
SQL["label_check"] = with_(
    VIEW,
    """select count(*) as rows, count(month_label) as with_month_label, count(request_month_label) as with_request_month,
 count(close_month_label) as with_close_month from analysis""",
)
SQL["current_month_default"] = f"""select {month_label('d')} as current_month_label, {month_sort('d')} as year_month_sort, d as as_of_date
from (select cast(max(o_orderdate) as date) as d from orders)"""
SQL["status_and_flood"] = with_(
    PROCUREMENT,
    """select source_type, status_normalized, status_normalized_v2, status_mapped, flood_required_code, flood_required_inferred_code,
 flood_required_inference_source, count(*) as n from fact group by all""",
)
SQL["age_and_condition"] = with_(
    PROCUREMENT, "select year_built, age_bucket, property_condition, count(*) as n from fact group by all"
)

# -------------------------------------------------------------------- landing

SQL["latest_per_key"] = "select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"
SQL["dedupe_report"] = """select count(*) as rows_read, count(distinct (l_orderkey, l_linenumber)) as rows_kept,
 count(*) - count(distinct (l_orderkey, l_linenumber)) as rows_removed from lineitem"""
SQL["incremental_events"] = "select * from events where ts >= timestamp '2024-01-13'"
SQL["json_map_fields"] = "select event_id, 0 as position, cast(props->>'k' as integer) as k, cast(null as varchar) as zz from events"
SQL["conversation_positions"] = "select conv_id, turn, role, turn = 0 as is_primary from conversations"
SQL["document_words"] = """select word, count(*) as uses, cast(max(position) as integer) as last_position
from (select unnest(string_split(lower(text), ' ')) as word, unnest(range(len(string_split(lower(text), ' ')))) as position from documents)
where word <> '' group by 1"""
SQL["backfill_prices"] = """select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as varchar) as price,
 case when o_custkey % 2 = 0 then '' else 'P' end || cast(cast(o_totalprice as decimal(18,2)) as varchar) as upb from orders"""
_P = "cast(o_totalprice as decimal(18,2))"
SQL["flatten_document"] = f"""select cast(o_orderkey as varchar) as "_id", cast(o_custkey as varchar) as "correspondentId",
 '{{"code":"' || o_orderstatus || '","price":' || {_P} || '}}' as state,
 '[{{"kind":"' || o_orderpriority || '","amount":"' || {_P} || '"}},{{"kind":null,"amount":"' || cast({_P} + 1 as decimal(18,2)) || '"}}]' as entries,
 '["' || o_orderstatus || '","' || o_orderpriority || '"]' as tags, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as at,
 case when o_custkey % 2 = 0 then 'true' else 'false' end as flag from orders"""
SQL["choice_struct"] = """select o_orderkey, case o_orderkey % 3 when 0 then cast(o_custkey as varchar) when 1 then o_orderstatus
 else cast(o_orderkey as varchar) end as amount, 'kept' as note from orders"""
SQL["canonical_columns"] = """select o_orderkey as id, case when o_orderkey % 3 = 1 then o_orderstatus
 when o_orderkey % 2 = 0 then o_orderpriority else 'z' end as "loanStatus" from orders"""
SQL["all_string"] = f"""select cast(o_orderkey as varchar) as o_orderkey, case when o_custkey > 10 then 'true' else 'false' end as flag,
 strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as at, '["' || o_orderstatus || '"]' as tags, cast({_P} as varchar) as price from orders"""
SQL["ancient_dates"] = """select o_orderkey, case when o_orderkey % 4 <> 0
 then make_date(year(o_orderdate), month(o_orderdate), least(day(o_orderdate), 28)) end as closing_date from orders"""

# ------------------------------------------------------------ column functions

SQL["money_values"] = with_(
    RAW_LOANS,
    f"""select "_id" as id, {money('"dpaAmount"')} as dpa, {whole('"firstMortgageTerm"')} as term, {whole('"blueWaterId"')} as bluewater,
 {rate('"firstMortgageInterestRate"')} as rate, {clean('"secondMortgageMinNumber"')} as min_number, {MONEY_NULL} as absent from raw_loans""",
)
SQL["money_text"] = with_(
    {"external_sheet": raw_sql("external_sheet")},
    f"select premium, count(*) as n, max({sheet_money('premium')}) as value from external_sheet group by 1",
)
SQL["word_domains"] = with_(STAR, """select is_employee_loan as is_employee, second_mortgage_settled_status as settled,
 second_mortgage_delinquency_status as bucket, count(*) as loans from loan_status group by all""")
SQL["flex_dates"] = with_(
    {"external_sheet": raw_sql("external_sheet")},
    f"select date_requested_by_lender as written, {sheet_date('date_requested_by_lender')} as day, count(*) as n from external_sheet group by 1, 2",
)
SQL["norm_keys"] = with_(
    {"external_sheet": raw_sql("external_sheet")},
    f"""select {token('lender_loan')} as token, nullif(upper(regexp_replace(coalesce(lender_loan, ''), '[^A-Z0-9]', '', 'g')), '') as legacy_token,
 {lender('lender')} as lender, {squeezed(up('borrower_address'))} as address, {zip5('borrower_zip')} as zip, count(*) as n
from external_sheet group by 1, 2, 3, 4, 5""",
)
SQL["ssn_mask"] = "select c_custkey, case when c_custkey % 5 <> 0 then '***-**-' || right(lpad(cast(c_custkey as varchar), 4, '0'), 4) end as masked from customer"
SQL["fk_resolution"] = f"""select c_custkey, cast(c_custkey as varchar) as owner, 's' || c_custkey as loan, 't' || c_custkey as "user",
 'p' || c_custkey as plain, {TEXT_NULL} as absent,
 case when c_custkey % 2 = 0 then cast(c_custkey as varchar) when c_custkey % 3 <> 0 then 'e' || c_custkey end as executive from customer"""
SQL["excel_serial"] = """select o_orderkey, case when n >= 1 then strftime(cast(case when n < 60 then date '1899-12-31' else date '1899-12-30' end
 + cast(floor(n) as integer) as date), '%m/%d/%Y') end as day
from (select o_orderkey, o_orderkey * 7 % 60000 + case when o_orderkey % 2 = 0 then 0.75 else 0 end as n from orders)"""

# ------------------------------------------------------------------- calendar

SQL["calendar_staging"] = with_(
    {"calendar": CALENDAR, "per_day": "select cast(o_orderdate as date) as d, count(*) as orders from orders group by 1"},
    """select date_key, date_id, year, cast(quarter(date_key) as integer) as quarter, month, cast(day(date_key) as integer) as day,
 cast(dayofweek(date_key) + 1 as integer) as day_of_week, cast(weekofyear(date_key) as integer) as week_of_year,
 dayname(date_key) as day_name, monthname(date_key) as month_name, year_month, dayofweek(date_key) in (0, 6) as is_weekend, orders
from calendar left join per_day on d = date_key""",
)
SQL["calendar_curated"] = """with per_day as (select cast(l_shipdate as date) as d, count(*) as lines from lineitem group by 1),
days as (select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as date from per_day)
select date, cast(year(date) as integer) as year, cast(month(date) as integer) as month_number, monthname(date) as month_name,
 strftime(date, '%b') as month_short, strftime(date, '%Y-%m') as year_month, cast(year(date) * 100 + month(date) as integer) as year_month_sort,
 'Q' || quarter(date) as quarter, year(date) || '-Q' || quarter(date) as year_quarter, cast(day(date) as integer) as day,
 cast(isodow(date) as integer) as day_of_week, dayname(date) as day_name, cast(date_trunc('month', date) as date) as month_start,
 last_day(date) as month_end, cast(isodow(date) >= 6 as integer) as is_weekend, lines
from days left join per_day on d = date"""
SQL["date_keys"] = f"""select {key_of('o_orderdate')} as date_id, cast(date_trunc('month', o_orderdate) as date) as month_start,
 count(*) as orders from orders group by 1, 2"""

# ------------------------------------------------------------------ sheet grid

SQL["grid_header"] = """select distinct 'parts.xlsx' as source_uri, p_brand as sheet, 2 as header_idx, 7 as width,
 'Part #|Part Name|Size|Setup Date|Large|Day|Type' as headers from part"""
_GRID_VALUES = """p_partkey || '|' || trim(p_name) || '|' || p_size || '|' ||
 strftime(cast(date '1899-12-30' + cast(p_partkey * 3 + 30000 as integer) as date), '%m/%d/%Y') || '|' ||
 case when p_size > 25 then '1' else '0' end || '|11/18/2024|' || case when p_size % 2 = 0 then p_type else '' end"""
SQL["grid_rows"] = f"""select 'parts.xlsx' as source_uri, p_brand as sheet, cast(p_partkey + 3 as integer) as row_idx,
 {_GRID_VALUES} as "values" from part"""
SQL["grid_cells"] = f"""select sheet, headers[i] as header, count(*) as cells, count(*) filter (where vals[i] <> '') as filled, max(vals[i]) as largest
from (select p_brand as sheet, string_split({_GRID_VALUES}, '|') as vals,
 ['Part #','Part Name','Size','Setup Date','Large','Day','Type'] as headers from part),
 lateral (select unnest(range(1, 8)) as i) group by 1, 2"""
SQL["non_blank_profile"] = with_(
    {"external_sheet": raw_sql("external_sheet")},
    "select " + ", ".join(
        f"""count(*) filter (where trim("{c}") <> '') as "{c}" """
        for c in "borrower_first_name borrower_last_name home_buyers_name lender_loan certificate_policy lender borrower_address borrower_city borrower_state borrower_zip county date_requested_by_lender closed_bind effective_date approval_status status policy_type premium flood_required property_conditions year fema_flood_zone dwelling_coverage carrier_s".split()
    ) + " from external_sheet",
)
SQL["drop_empty_columns"] = "select cast(l_orderkey as varchar) as order_key, l_returnflag as return_flag, count(*) as n from lineitem group by 1, 2"

# -------------------------------------------------------------------- quality

SQL["quality_checks"] = with_(
    {**STAR, "users": raw_sql("users")},
    """select 'domain' as "check", 'o_orderstatus' as subject, count(*) as rows_checked, count(*) filter (where o_orderstatus not in ('F','O')) as violations from orders
union all select 'pattern', 'email', count(email), count(*) filter (where email like 'user1%') from users
union all select 'pattern', 'c_name', count(*), count(*) filter (where right(c_name, 1) <> '1') from customer
union all select 'range', 'credit_score', count(credit_score), count(*) filter (where credit_score < 600 or credit_score > 700) from loan_metrics
union all select 'required', 'loan_id,product_type,closing_date', count(*), count(*) filter (where product_type is null or closing_date is null) from dim_loan
union all select 'unique', 'l_orderkey,l_linenumber', count(*), count(*) - count(distinct (l_orderkey, l_linenumber)) from lineitem
union all select 'unique', 'l_orderkey', count(*), count(*) - count(distinct l_orderkey) from lineitem where l_returnflag = 'R'
union all select 'referential', 'l_suppkey', count(*), count(*) filter (where l_suppkey not in (select o_custkey from orders)) from lineitem""",
)
SQL["duplicate_keys"] = "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1"
SQL["staleness"] = f"""select newest, cast(date_diff('day', newest, {AS_OF}) as integer) as age_days, {AS_OF} - newest > 2 as is_stale
from (select max(cast(o_orderdate as date)) as newest from orders)"""
SQL["dead_letter"] = with_(
    RAW_LOANS,
    f"""select reasons, count(*) as loans from (select concat_ws('; ', case when "blueWaterId" = 'n/a' then 'bad bluewater id' end,
 case when "productType" is null then 'no product' end, case when "dpaAmount" is null then 'no amount' end) as reasons from raw_loans)
where reasons <> '' group by 1""",
)

# ----------------------------------------------- publishing, history and trends

SQL["snapshot_publish"] = f"""select '2024-01-02' as dt, o_orderstatus, count(*) as orders, cast(sum({_P}) as decimal(28,2)) as total from orders group by 2"""
SQL["partition_publish"] = f"""select dt, o_orderstatus, count(*) as orders, cast(sum({_P}) as decimal(28,2)) as total
from orders, (values ('2024-01-01'), ('2024-01-02')) d(dt) group by 1, 2"""
SQL["scd2"] = """with seen as (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events),
changed as (select * from seen where before is null or before <> event_type)
select user_id, event_type, ts as valid_from, lead(ts) over w as valid_to, lead(ts) over w is null as is_current
from changed window w as (partition by user_id order by ts, event_id)"""


# Score and ratio bands; score bands end with their last score, ratio bands before their last ratio.
FICO_BANDS = {"600-639": (600, 639), "640-679": (640, 679), "680-699": (680, 699), "700+": (700, None)}
DTI_BANDS = {"0-39": (0, 40), "40-44": (40, 45), "45-49": (45, 50), "50+": (50, None)}


def scorecard() -> str:
    """All scorecard measures, spelled out by rule."""
    late = {"30-59": "30_to_59", "60-89": "60_to_89", "90+": "90plus"}

    def pair(stem: str, condition: str) -> list[str]:
        return [
            f"count(*) filter (where {condition}) as {stem.format('units')}",
            f"cast(coalesce(sum(second_mortgage_upb) filter (where {condition}), 0) as decimal(28,2)) as {stem.format('volume')}",
        ]

    out = pair("total_servicing_{}", "true")
    for bucket, tag in late.items():
        is_late = f"second_mortgage_delinquency_status = '{bucket}'"
        out += pair("servicing_{}_delinquent_" + tag, is_late)
        for name, (low, high) in FICO_BANDS.items():
            inside = f"credit_score >= {low}" + (f" and credit_score <= {high}" if high else "")
            out += pair(f"delinquency_{tag}_{{}}_by_fico_" + name.replace("-", "_to_").replace("+", "_plus"), f"{is_late} and {inside}")
        for name, (low, high) in DTI_BANDS.items():
            inside = f"backend_dti >= {low}" + (f" and backend_dti < {high}" if high else "")
            out += pair(f"delinquency_{tag}_{{}}_by_dti_" + name.replace("-", "_to_").replace("+", "_plus"), f"{is_late} and {inside}")
    return ", ".join(out)


SQL["servicing_scorecard"] = with_(STAR, f"select current_status, {scorecard()} from loan_status join loan_metrics using (loan_id) group by 1")
SQL["fico_bands"] = with_(
    STAR,
    """select case when credit_score between 600 and 639 then '600-639' when credit_score between 640 and 679 then '640-679'
 when credit_score between 680 and 699 then '680-699' when credit_score >= 700 then '700+' end as band, count(*) as units,
 cast(sum(dpa_amount) as decimal(28,2)) as volume from loan_metrics group by 1""",
)
SQL["yoy_growth"] = with_(
    {
        **STAR,
        "monthly": """select product_type, cast(date_trunc('month', closing_date) as date) as month_start, count(*) as closings
from dim_loan where closing_date is not null and product_type is not null group by 1, 2""",
        "compared": """select a.*, p.closings as previous_month, y.closings as previous_year from monthly a
left join monthly p on a.product_type = p.product_type and p.month_start = a.month_start - interval 1 month
left join monthly y on a.product_type = y.product_type and y.month_start = a.month_start - interval 12 month""",
    },
    f"""select *, {percent('(closings - previous_month)', 'previous_month', 'decimal(18,2)')} as mom_pct,
 {percent('(closings - previous_year)', 'previous_year', 'decimal(18,2)')} as yoy_pct from compared""",
)
SQL["corr_driver"] = """select l_returnflag, round(corr(l_extendedprice, l_quantity), 6) as corr_l_quantity,
 round(corr(l_extendedprice, l_discount), 6) as corr_l_discount from lineitem group by 1"""
SQL["days_to_clear"] = with_(
    WITH_CONDITIONS,
    """select condition_source, status, cast(cast(cleared_at as date) - cast(created_at as date) as integer) as days_to_clear,
 count(*) as conditions from conditions group by 1, 2, 3""",
)
SQL["condition_turnaround"] = with_(
    {
        **WITH_CONDITIONS,
        "aged": f"""select *, cast(cleared_at as date) - cast(submitted_at as date) as took, {AS_OF} - cast(submitted_at as date) as waiting from conditions""",
    },
    """select condition_source, count(took) as finished, cast(sum(took) as double) / count(took) as avg_days,
 count(*) filter (where took > 7) as sla_breaches, count(*) filter (where cleared_at is null) as backlog,
 count(*) filter (where cleared_at is null and waiting > 7) as backlog_overdue from aged group by 1""",
)
SQL["loan_aging"] = with_(
    STAR,
    f"""select case when age < 30 then '0-29' when age < 60 then '30-59' when age < 90 then '60-89' else '90+' end as age_bucket, count(*) as items
from (select {AS_OF} - cast(created_at as date) as age from dim_loan where closing_date is null) group by 1""",
)
SQL["variance"] = with_(
    STAR, "select loan_id, dpa_amount, second_mortgage_upb, cast(second_mortgage_upb - dpa_amount as decimal(18,2)) as variance_amount from loan_metrics"
)
SQL["loan_snapshot"] = with_(
    BASE, f"select {AS_OF} as snapshot_date, loan_id, product_type, current_status, registered_at, dpa_amount, second_mortgage_upb from base"
)
SQL["privacy_policy"] = f"""select c_custkey, sha256('s1' || c_name) as c_name, '***' || right(c_mktsegment, 4) as c_mktsegment,
 {TEXT_NULL} as nation from customer"""
SQL["slicer_counts"] = """select l_returnflag, count(*) as rows, count(distinct l_orderkey) as orders,
 count(distinct case when l_quantity > 30 then l_orderkey end) as large
from lineitem where l_returnflag in ('A', 'R') and l_linestatus = 'O' group by 1"""


from catalog import runs_oracle as _runs  # noqa: E402, F401 - adds its queries

from catalog import kept_oracle as _kept  # noqa: E402, F401 - adds its queries
