"""Raw-zone inputs derived from the given tables.

Each input is a list of (column, SQL expression) over one given table or join.
The expressions are plain SQL, so the same text feeds Spark and the reference
SQL; what is compared is everything computed after them.  Every row of a given
table becomes a row of the input.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_READ: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read once per session."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    found = _READ.get((id(spark), path))
    if found is None:
        found = _READ[id(spark), path] = (spark, spark.read.parquet(path))
    return found[1]


def _text(value: str) -> str:
    return f"cast({value} as string)"


def _iso(day: str) -> str:
    """yyyy-MM-dd text of a date expression."""
    return _text(day)


def _us(day: str, padded: bool = True, short_year: bool = False) -> str:
    """MM/dd/yyyy, M/d/yyyy or M/d/yy text of a date expression."""
    iso = _iso(day)
    if padded:
        month, dom = f"substr({iso}, 6, 2)", f"substr({iso}, 9, 2)"
    else:
        month, dom = _text(f"month({day})"), _text(f"day({day})")
    year = f"substr({iso}, 3, 2)" if short_year else f"substr({iso}, 1, 4)"
    return f"{month} || '/' || {dom} || '/' || {year}"


def _mixed_day(day: str, pick: str, bad: str) -> str:
    """One date in the spellings that sheets use, some of them unreadable."""
    return (
        f"case {pick} % 8 when 0 then {_iso(day)} || ' 00:00:00' when 1 then {_us(day)}"
        f" when 2 then {_us(day, False, True)} when 3 then {_iso(day)} || 'T10:20:30.5'"
        f" when 4 then '{bad}' when 5 then '' when 6 then {_us(day, False)} else ' ' || {_iso(day)} || ' ' end"
    )


ORDER_DAY = "cast(o_orderdate as date)"
SHIP_DAY = "cast(l_shipdate as date)"
PRICE = "cast(o_totalprice as decimal(18,2))"


def _shift(day: str, days: int) -> str:
    return f"({day} {'+' if days >= 0 else '-'} interval '{abs(days)}' day)"


def _at(day: str, days: int, clock: str) -> str:
    moved = f"cast({_shift(day, days)} as date)"
    return f"{_iso(moved)} || 'T{clock}'"


def _borrower(number: str, fico: str, role: str) -> str:
    return (
        f"""'{{"firstName":"First' || {_text(f'({number}) % 50')} || '","lastName":"Last' || {_text(f'({number}) % 97')}"""
        f""" || '","ssn":"' || lpad({_text(f'({number}) % 1000')}, 3, '0') || '-45-' || lpad({_text(f'({number}) % 10000')}, 4, '0')"""
        f""" || '","fico":"' || {fico} || '","dti":"' || {_text(f'30 + ({number}) % 30')} || '.5","position":"{role}"}}'"""
    )


LOANS = [
    ("_id", _text("o_orderkey")),
    ("ahLoanNumber", f"'AH' || {_text('o_orderkey')}"),
    ("lenderLoanNumber", f"'L-' || {_text('o_custkey')} || '-' || {_text('o_orderkey')}"),
    ("usfLoanNumber", f"case o_custkey % 4 when 0 then 'U' || {_text('o_orderkey')} when 1 then '  ' when 2 then '' end"),
    ("blueWaterId", f"case when o_orderkey % 3 = 0 then {_text('o_orderkey')} || '.0' when o_orderkey % 3 = 1 then 'n/a' end"),
    ("workflowType", "case o_orderstatus when 'F' then 'Delegated' when 'O' then 'Prior Approval' end"),
    (
        "productType",
        "case o_orderpriority when '1-URGENT' then 'DPA' when '2-HIGH' then 'dpa' when '3-MEDIUM' then 'EEP'"
        " when '4-NOT SPECIFIED' then 'White Label' else case when o_orderstatus <> 'P' then 'Solar Program' end end",
    ),
    ("dpaRepaymentType", "case when o_custkey % 2 = 0 then 'Repayable' else 'Forgivable' end"),
    ("propertyState", f"'S' || {_text('o_custkey % 50')}"),
    ("propertyZip", f"lpad({_text('o_custkey')}, 5, '8')"),
    ("numberOfUnits", f"{_text('1 + o_orderkey % 4')} || '.0'"),
    ("loanOfficerName", f"'Officer ' || {_text('o_custkey % 200')}"),
    ("correspondentId", _text("o_custkey")),
    ("secondMortgageInvestorId", _text("o_custkey % 120")),
    ("investorName", "case when o_orderkey % 10 = 0 then 'Own Investor' end"),
    ("secondMortgageMinNumber", f"case when o_orderkey % 5 = 0 then '{{value= ' || {_text('o_orderkey')} || ' }}' else ' ' end"),
    ("status", "case o_orderstatus when 'F' then 'Purchased' when 'O' then 'Registered' else 'Cancelled' end"),
    ("health", "case when o_orderkey % 9 = 0 then 'At Risk' else 'OK' end"),
    ("secondMortgageSettledStatus", "case o_orderkey % 5 when 0 then 'SETTLED' when 1 then ' unsettled ' when 2 then 'open' when 3 then '' end"),
    (
        "secondMortgageDelinquencyStatus",
        "case o_orderkey % 8 when 0 then '30 - 59' when 1 then '90 +' when 2 then '90plus' when 3 then '120'"
        " when 4 then '0to29' when 5 then '60_89' when 6 then ' 90 ' end",
    ),
    ("isEmployeeLoan", "case o_custkey % 7 when 0 then 'Yes' when 1 then 'f' when 2 then '1' when 3 then 'maybe' when 4 then ' NO ' when 5 then '' end"),
    (
        "firstMortgageOwnershipStatus",
        "case o_custkey % 3 when 0 then 'Owned - USF' when 1 then 'mwf' end",
    ),
    ("createdAt", _at(ORDER_DAY, -30, "09:30:00")),
    ("registeredAt", f"case when o_custkey % 7 <> 0 then {_at(ORDER_DAY, -20, '11:15:30')} end"),
    ("lockedAt", f"case when o_orderstatus <> 'P' then {_at(ORDER_DAY, -10, '08:00:00')} end"),
    ("closingDate", f"case when o_orderstatus <> 'P' then {_iso(ORDER_DAY)} end"),
    ("closedAt", f"case when o_orderstatus <> 'P' then {_at(ORDER_DAY, 1, '16:45:00')} end"),
    ("purchasedAt", f"case when o_orderstatus = 'F' then {_at(ORDER_DAY, 15, '12:00:00')} end"),
    ("fundingDate", f"case when o_orderkey % 40 = 0 then '1200-01-01' else {_iso(ORDER_DAY)} end"),
    ("dpaAmount", f"case when o_orderkey % 11 = 0 then null when o_orderkey % 2 = 0 then '{{value=' || {_text(PRICE)} || '}}' else {_text(PRICE)} end"),
    ("dpaPercent", "case when o_custkey % 2 = 0 then '3.5' else '5.0' end"),
    ("firstMortgageTotalLoanAmount", _text(f"cast({PRICE} * 2 as decimal(18,2))")),
    ("firstMortgageInterestRate", f"{_text('2 + o_custkey % 5')} || '.' || lpad({_text('o_orderkey % 1000')}, 3, '0')"),
    ("firstMortgageTerm", "case when o_orderkey % 6 = 0 then '180.0' when o_orderkey % 6 = 1 then '' else '360.0' end"),
    ("combinedLoanToValueRatio", f"case when o_orderkey % 5 <> 0 then {_text('90 + o_custkey % 10')} || '.25' end"),
    ("totalBackEndDebtToIncomeRatio", f"{_text('30 + o_orderkey % 30')} || '.' || {_text('o_orderkey % 10')}"),
    ("finalQualifyingCreditScore", f"{_text('560 + o_orderkey % 250')} || '.0'"),
    ("secondMortgageUpb", f"'{{value=' || {_text(PRICE)} || '}}'"),
    (
        "borrowers",
        "case o_orderkey % 6 when 0 then '' when 1 then '[]' when 2 then 'not json'"
        f" when 3 then '[' || {_borrower('o_custkey', _text('600 + o_orderkey % 200'), 'Primary')} || ']'"
        f" else '[' || {_borrower('o_custkey', _text('600 + o_orderkey % 200'), 'Primary')} || ','"
        f" || {_borrower('o_custkey + o_orderkey', _text('580 + o_orderkey % 200'), 'Co-Borrower')} || ']' end",
    ),
    (
        "eepProcessingEntries",
        "case when o_orderpriority = '3-MEDIUM' then '[{\"_key\":\"k' || " + _text("o_orderkey")
        + " || '\",\"_position\":\"0\",\"at\":\"' || " + _at(ORDER_DAY, -3, "10:00:00")
        + " || '\",\"userId\":\"u' || " + _text("o_custkey % 9")
        + " || '\",\"newProcessingStatus\":\"Underwriting\"},{\"_key\":\"m\",\"_position\":\"1.0\",\"user\":\"v1\",\"newProcessingStatus\":\"Closed\"}]' end",
    ),
    ("_etl_extracted_at", "'2024-01-02 03:04:05'"),
]

CORRESPONDENTS = [
    ("_id", _text("c_custkey")),
    ("name", "c_name"),
    ("nmlsNumber", _text("100000 + c_custkey")),
    ("state", f"'S' || {_text('c_nationkey')}"),
    ("zip", f"case when c_custkey % 3 = 0 then {_text('80000 + c_nationkey')} end"),
    ("zipCode", f"case when c_custkey % 4 <> 0 then {_text('90000 + c_nationkey')} end"),
    ("createdAt", "'2020-05-06T07:08:09'"),
    ("accountExecutiveId", f"case when c_custkey % 2 = 0 then 'ae' || {_text('c_nationkey')} end"),
    ("accountExecutiveIds", f"case when c_custkey % 5 = 0 then '[]' else '[\"list' || {_text('c_nationkey')} || '\",\"d\"]' end"),
    ("contractDate", "case when c_custkey % 2 = 1 then '2019-01-01' end"),
]

INVESTORS = [("_id", _text("s_suppkey")), ("name", "s_name")]

USERS = [
    ("_id", _text("s_suppkey")),
    ("name", "s_name"),
    ("email", f"'user' || {_text('s_suppkey')} || '@example.com'"),
    ("disableLogin", "case when s_suppkey % 3 = 0 then 'true' when s_suppkey % 3 = 1 then 'no' end"),
    ("__userType", "case when s_acctbal > 5000 then 'internal' else 'external' end"),
    ("correspondentId", _text("s_suppkey * 3")),
]

CONDITIONS = [
    ("_id", f"{_text('l_orderkey')} || '-' || {_text('l_linenumber')} || '-' || {_text('l_partkey')}"),
    ("loanId", _text("l_orderkey")),
    ("conditionSource", "case l_linestatus when 'O' then 'Underwriter' else 'Closer' end"),
    ("conditionType", "l_returnflag"),
    ("createdAt", _at(SHIP_DAY, -12, "08:00:00")),
    ("submittedAt", f"case when l_linenumber % 4 <> 0 then {_at(SHIP_DAY, -8, '09:00:00')} end"),
    ("insufficientAt", f"case when l_linenumber % 5 = 2 then {_at(SHIP_DAY, -5, '10:00:00')} end"),
    ("clearedAt", f"case when l_returnflag = 'R' then {_at(SHIP_DAY, 0, '17:30:00')} end"),
    ("clearedById", "case when l_returnflag = 'R' then 'u' || " + _text("l_suppkey") + " end"),
    ("documentTypes", "case l_linenumber % 3 when 0 then '[\"Appraisal\",null,\"' || l_returnflag || '\"]' when 1 then '' else '[\"Title\"]' end"),
]

CONDITION_EVENTS = [
    ("_id", _text("event_id")),
    ("loanConditionId", _text("user_id")),
    ("eventType", "event_type"),
    ("at", "ts"),
    ("byId", f"'u' || {_text('user_id')}"),
    ("text", "props"),
]

EXCEPTIONS = [
    ("_id", _text("event_id")),
    ("loanId", _text("user_id")),
    ("exceptionType", "event_type"),
    ("requestedAt", "ts"),
    ("requestedBy", f"'u' || {_text('user_id % 7')}"),
    ("approvedAt", "case when event_type = 'purchase' then ts end"),
    ("approvedById", "case when event_type = 'purchase' then 'boss' end"),
    ("deniedAt", "case when event_type = 'error' then ts end"),
]

HOLIDAYS = [
    ("_id", _text("o_orderkey")),
    ("date", _iso(ORDER_DAY)),
    ("name", "o_orderpriority"),
    ("officeClosed", "case when o_orderstatus = 'F' then 'true' else 'false' end"),
]

LOANDOCUMENTS = [
    ("_id", _text("doc_id")),
    ("postgresId", f"{_text('doc_id')} || '.0'"),
    ("loan", _text("doc_id % 100")),
    ("name", f"source || '-' || {_text('doc_id')}"),
    ("size", _text("n_chars")),
    ("documentType", "lang"),
    ("blueWaterFinalVersion", "case when doc_id % 2 = 0 then 'Y' end"),
]

# Two procurement sheets in their own column names, over submissions: one line item each.
_LENDER = (
    f"case l_suppkey % 5 when 0 then 'Acme Bank ' || {_text('l_suppkey % 20')} || ', N.A. ISAOA/ATIMA'"
    " when 1 then 'acme bank its successors and/or assigns'"
    f" when 2 then 'Acme-Bank ' || {_text('l_suppkey % 20')} when 3 then '' else ' First  National Bank' end"
)
_LOAN_NUMBER = (
    f"case l_orderkey % 4 when 0 then null when 1 then 'ln-' || {_text('o_custkey')} || 'a'"
    f" else 'LN ' || {_text('l_orderkey')} end"
)
_ZIP = (
    f"case o_custkey % 4 when 0 then '84043-1234' when 1 then '2134' when 2 then {_text('80000 + o_custkey % 50')} || '.0' end"
)
_MONEY = (
    "case l_linenumber % 6 when 0 then 'n/a' when 1 then ' ' || {amount} || ' '"
    " when 2 then '' else '$' || {amount} end"
)
_PREMIUM = _MONEY.format(amount=_text("cast(l_extendedprice as decimal(18,2))"))
_COVERAGE = _MONEY.format(amount=_text("cast(cast(l_extendedprice as decimal(18,2)) * 4 as decimal(18,2))"))
_FLOOD = (
    "case l_partkey % 7 when 0 then 'NOT REQUIRED' when 1 then 'Yes - required' when 2 then 'n' when 3 then 'TRUE'"
    " when 4 then 'perhaps' when 5 then '' end"
)
_POLICY = "case l_suppkey % 6 when 0 then 'NFIP' when 1 then 'Private flood' when 2 then 'HO3' when 3 then ' ' when 4 then 'DP3' end"
_ZONE = "case l_partkey % 9 when 0 then 'AE' when 1 then 'x500' when 2 then 'D' when 3 then 'VE' when 4 then 'B' when 5 then 'B/X' when 6 then '' end"
_YEAR = "case l_partkey % 6 when 0 then '1978' when 1 then '1979.0' when 2 then 'c. 1965' when 3 then 'unk' when 4 then " + _text("1900 + l_partkey % 120") + " end"
_CONDITION = "case l_partkey % 5 when 0 then 'c3' when 1 then '' when 2 then 'poor' when 3 then 'C1' end"
_FIRST = f"case when o_custkey % 11 <> 5 then ' Jo' || {_text('o_custkey % 10')} end"
_LAST = f"case when o_custkey % 11 <> 5 then 'Doe' || {_text('o_custkey % 97')} || ' ' else '' end"
_BUYERS = f"case o_custkey % 3 when 0 then 'Buyer ' || {_text('o_custkey')} when 1 then ' ' end"
_ADDRESS = f"case when l_orderkey % 13 <> 0 then {_text('l_orderkey % 90')} || ' Main St.' end"
_CLOSE = f"case when l_returnflag <> 'N' then {_mixed_day(SHIP_DAY, 'l_partkey', '07/01/2026/2026')} end"

SUBMISSIONS = "lineitem join orders on l_orderkey = o_orderkey"
EXTERNAL_SHEET = [
    ("borrower_first_name", _FIRST),
    ("borrower_last_name", _LAST),
    ("home_buyers_name", _BUYERS),
    ("lender_loan", _LOAN_NUMBER),
    ("certificate_policy", f"case when l_linenumber % 3 <> 0 then 'POL/' || {_text('l_partkey')} end"),
    ("lender", _LENDER),
    ("borrower_address", _ADDRESS),
    ("borrower_city", f"'City ' || {_text('o_custkey % 30')}"),
    ("borrower_state", f"'S' || {_text('o_custkey % 5')}"),
    ("borrower_zip", _ZIP),
    ("county", f"case when l_linenumber % 2 = 0 then 'County ' || {_text('l_partkey % 10')} end"),
    ("date_requested_by_lender", _mixed_day(ORDER_DAY, "l_linenumber", "Pending")),
    ("closed_bind", _CLOSE),
    ("effective_date", _iso(SHIP_DAY)),
    (
        "approval_status",
        "case l_suppkey % 7 when 0 then 'Approved' when 1 then 'pending items' when 2 then '' when 3 then 'Odd'"
        " when 4 then 'Closed Without Approval' when 5 then 'canceled' end",
    ),
    ("status", "case l_linenumber % 3 when 0 then 'Active' when 1 then '' end"),
    ("policy_type", _POLICY),
    ("premium", _PREMIUM),
    ("flood_required", _FLOOD),
    ("property_conditions", _CONDITION),
    ("year", _YEAR),
    ("fema_flood_zone", _ZONE),
    ("dwelling_coverage", _COVERAGE),
    ("carrier_s", f"'Carrier ' || {_text('l_suppkey % 8')}"),
]
INTERNAL_SHEET = [
    ("first_name", _FIRST),
    ("last_name", _LAST),
    ("homebuyers_name", _BUYERS),
    ("Lender_Loan_Number", _LOAN_NUMBER),
    ("ah_loan_number", f"case when l_linenumber % 4 <> 0 then 'ah' || {_text('o_custkey + l_linenumber')} end"),
    ("policy_number", f"case when l_linenumber % 3 <> 0 then 'POL/' || {_text('l_partkey')} end"),
    ("lender_name", _LENDER),
    ("address", _ADDRESS),
    ("city", f"'City ' || {_text('o_custkey % 30')}"),
    ("state", f"'S' || {_text('o_custkey % 5')}"),
    ("zip", _ZIP),
    ("request_date", _mixed_day(ORDER_DAY, "l_linenumber", "Pending")),
    ("close_bind_date", _CLOSE),
    ("payment_status", "case l_suppkey % 6 when 0 then 'Active' when 1 then '' when 2 then 'Paid in Full' when 3 then 'Odd' when 4 then ' pending ' end"),
    ("policy_type", _POLICY),
    ("premium", _PREMIUM),
    ("flood_required", _FLOOD),
    ("property_condition", _CONDITION),
    ("year_built", _YEAR),
    ("flood_zone", _ZONE),
    ("dwelling_amount", _COVERAGE),
    ("provider", "'In House'"),
]

INPUTS = {
    "loans": ("orders", LOANS, None),
    "correspondents": ("customer", CORRESPONDENTS, None),
    "investors": ("supplier", INVESTORS, None),
    "users": ("supplier", USERS, None),
    "conditions": ("lineitem", CONDITIONS, None),
    "condition_events": ("events", CONDITION_EVENTS, None),
    "exceptions": ("events", EXCEPTIONS, None),
    "holidays": ("orders", HOLIDAYS, None),
    "loandocuments": ("documents", LOANDOCUMENTS, None),
    # The two sheets split the line items by status; together they hold all of them.
    "external_sheet": (SUBMISSIONS, EXTERNAL_SHEET, "l_linestatus = 'O'"),
    "internal_sheet": (SUBMISSIONS, INTERNAL_SHEET, "l_linestatus <> 'O'"),
}


def _submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    # Both tables grow alike, so they are shuffled at every size, as they would be at scale.
    return lines.join(orders.hint("shuffle_merge"), F.col("l_orderkey") == F.col("o_orderkey"))


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a Spark frame."""
    source, columns, where = INPUTS[name]
    if source == SUBMISSIONS:
        df = _submissions(spark, sf_dir)
    else:
        df = table(spark, sf_dir, source)
    if where:
        df = df.filter(where)
    return df.select(*[F.expr(e).alias(n) for n, e in columns])


def raw_sheets(spark: SparkSession, sf_dir: str, sheets: dict[str, str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Inputs over one source in one frame, read once: the rows with a ``sheet`` tag, and the columns of each tag.

    ``sheets`` maps a tag to an input.  What a column that a row's own input lacks holds is not told.
    """
    columns: dict[str, dict[str, str]] = {tag: {n: e for n, e in INPUTS[name][1]} for tag, name in sheets.items()}
    (source,) = {INPUTS[name][0] for name in sheets.values()}
    df = _submissions(spark, sf_dir) if source == SUBMISSIONS else table(spark, sf_dir, source)
    tag = F.lit(None).cast("string")
    for label, name in sheets.items():
        tag = F.when(F.expr(INPUTS[name][2]), label).otherwise(tag)
    marked = df.withColumn("sheet", tag)

    def value(name: str) -> Column:
        having = {label: F.expr(own[name]) for label, own in columns.items() if name in own}
        # No row of another sheet is asked for the columns of one.
        out = None if len(having) > 1 else next(iter(having.values()))
        for label, own in having.items() if out is None else ():
            out = F.when(F.col("sheet") == label, own) if out is None else out.when(F.col("sheet") == label, own)
        return out.alias(name)

    every = dict.fromkeys(n for own in columns.values() for n in own)
    return marked.select("sheet", *[value(n) for n in every]), {label: list(own) for label, own in columns.items()}


def raw_sql(name: str) -> str:
    """The same input as a SQL query."""
    source, columns, where = INPUTS[name]
    listed = ",\n  ".join(f'{e} as "{n}"' for n, e in columns)
    return f"select\n  {listed}\nfrom {source}" + (f"\nwhere {where}" if where else "")
