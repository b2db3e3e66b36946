"""Raw documents to dimensions and facts.

Each table is a list of fields over a raw frame.  Raw frames are expected to
hold one row per ``_id``; ``build_star`` sees to that.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions import domains
from hearthline.operators import calendar
from hearthline.operators.dedupe import latest_per_key
from hearthline.operators.lookup import lookup
from hearthline.operators.nested import explode_children, explode_texts
from hearthline.schema import (
    Field,
    Record,
    coalesce_spellings,
    columns,
    empty_table,
    fields,
    first_existing,
    first_of_list_fk,
    project,
    resolve_fk,
    safe_col,
)
from hearthline.sources.readers import inline_table

EXTRACTED_AT = "_etl_extracted_at"
LOADED_AT = "_etl_loaded_at"

# The loan products.
PRODUCTS = (
    (1, "DPA", "Down Payment Assistance", "Assistance"),
    (2, "EEP", "Energy Efficient Program", "Efficiency"),
    (3, "White Label", "White Label Program", "White Label"),
    (4, "Solar Program", "Solar Program", "Solar"),
    (5, "CSPortal", "CS Portal", "Portal"),
    (6, "Loan Depot", "Loan Depot", "Partner"),
)
CALENDAR = ("2020-01-01", "2030-12-31")

# Raw fields of each table.  ``raw:name`` where the name is not
# the snake-cased raw one.
LOAN_REFS = "purchaseClearingAssignedTo purchaseClearingAssistantAssignedTo eepProcessor eepUnderwriter eepCloser"


def _refs(names: str) -> list[Field]:
    return [Field(f.source, "ref", f"{f.alias}_id") for f in fields("ref", names)]


DIM_LOAN = [
    Field("_id", name="loan_id"),
    *fields("text", "ahLoanNumber lenderLoanNumber usfLoanNumber bsiLoanNumber essexLoanNumber"),
    *fields("int", "blueWaterId:bluewater_id"),
    *fields("text", "workflowType productType dpaRepaymentType firstMortgageType"),
    *fields("text", "propertyAddress propertyCity propertyState propertyZip propertyCounty propertyType"),
    *fields("int", "numberOfUnits"),
    *fields("text", "loanOfficerName loanOfficerEmail loanOfficerNmlsNumber:loan_officer_nmls"),
    *_refs("correspondent"),
    *fields("text", "createdBy:created_by_user_id"),
    *_refs(LOAN_REFS),
    *fields("text", "secondMortgageInvestorId investorOrgId investorName"),
    *fields("clean", "secondMortgageMinNumber"),
    *fields("timestamp", "createdAt"),
    *fields("date", "closingDate fundingDate"),
    *fields("timestamp", "closedAt"),
]
FACT_LOAN_STATUS = [
    Field("_id", name="loan_id"),
    *_refs("correspondent"),
    *fields("text", "status:current_status health:health_status healthReason secondMortgageOwnershipStatus"),
    *fields("settled", "secondMortgageSettledStatus"),
    *fields("delinquency", "secondMortgageDelinquencyStatus"),
    *fields("bool", "isEmployeeLoan"),
    *fields("text", "secondMortgageSoldTo"),
    *fields("timestamp", "secondMortgageSoldDate"),
    *fields("text", "secondMortgageInvoiceTradeNumber"),
    *fields("clean", "secondMortgageMinNumber"),
    *_refs("eepProcessor eepUnderwriter eepCloser"),
    *fields("text", "firstMortgageOwnershipStatus"),
    *fields(
        "date_key",
        "closingDate:closing_date_key fundingDate:funding_date_key createdAt:created_date_key "
        "purchasedAt:purchased_date_key "
        "secondMortgageNextPaymentDueDate:second_mortgage_next_payment_due_date_key "
        "secondMortgageLastPaymentMadeDate:second_mortgage_last_payment_made_date_key "
        "purchaseClearingIntakeAuditReadyDate:purchase_clearing_intake_audit_ready_date_key "
        "purchaseClearingIntakeAuditCompletionDate:purchase_clearing_intake_audit_completion_date_key "
        "secondMortgageFirstPaymentDueDate:second_mortgage_first_payment_due_date_key",
    ),
    *fields(
        "timestamp",
        "registeredAt lockedAt closedAt purchasedAt securitizedAt cancelledAt deniedAt "
        "secondMortgageNextPaymentDueDate secondMortgageLastPaymentMadeDate "
        "purchaseClearingIntakeAuditReadyDate purchaseClearingIntakeAuditCompletionDate "
        "secondMortgageFirstPaymentDueDate",
    ),
    *fields("date", "fundingDate"),
    *fields(
        "timestamp",
        "clearToCloseAt approvedForPurchaseAt allConditionsClearedAt closedLoanPackageReceivedAt "
        "closedLoanPackageIndexedAt closedLoanPackageBoardedAt collateralReceivedAt reimbursedAt",
    ),
]
FACT_LOAN_METRICS = [
    Field("_id", name="loan_id"),
    *_refs("correspondent"),
    *fields("text", "productType workflowType"),
    *fields("date_key", "closingDate:closing_date_key"),
    *fields(
        "money",
        "firstMortgageBaseLoanAmount:first_mortgage_base_amount "
        "firstMortgageTotalLoanAmount:first_mortgage_total_amount",
    ),
    *fields("rate", "firstMortgageInterestRate firstMortgageLoanToValueRatio:first_mortgage_ltv"),
    *fields("int", "firstMortgageTerm:first_mortgage_term_months"),
    *fields("money", "dpaAmount"),
    *fields("rate", "dpaPercent"),
    *fields("money", "secondMortgageUpb"),
    *fields("rate", "secondMortgageInterestRate"),
    *fields("int", "secondMortgageTerm:second_mortgage_term_months"),
    *fields("money", "purchasePrice appraisedValue"),
    *fields("rate", "combinedLoanToValueRatio:combined_ltv"),
    *fields("money", "totalIncome totalAssetsBalance:total_assets totalLiabilitiesBalance:total_liabilities"),
    *fields("rate", "totalBackEndDebtToIncomeRatio:backend_dti totalFrontEndDebtToIncomeRatio:frontend_dti"),
    *fields("int", "finalQualifyingCreditScore:credit_score"),
    *fields(
        "money",
        "totalMonthlyLoanPayment:monthly_payment escrowMonthlyPayment:escrow_payment "
        "pmiMonthlyPayment:pmi_payment",
    ),
    *fields("rate", "basePrice totalPrice"),
]
DIM_CORRESPONDENT = [
    Field("_id", name="correspondent_id"),
    *fields("text", "name:correspondent_name nmlsNumber address city state"),
]
DIM_USER = [*fields("text", "_id:user_id name:user_name email")]
DIM_INVESTOR = [*fields("text", "_id:investor_id name:investor_name")]
BORROWER = [
    *fields("text", "firstName middleName lastName suffix email"),
    *fields("text", "primaryPhoneNumber:primary_phone homePhoneNumber:home_phone workPhoneNumber:work_phone"),
    *fields("ssn", "ssn:ssn_masked"),
    *fields("date", "dateOfBirth"),
    *fields("int", "fico:credit_score"),
    *fields("double", "dti monthlyIncome"),
    *fields("text", "maritalStatus ethnicity race sex occupancyType"),
    *fields("text", "currentAddress currentCity currentState currentZip employerName"),
    *fields("double", "yearsWorked"),
    *fields("text", "position:borrower_type"),
]
PROCESSING_ENTRY = [
    *fields("text", "_key:entry_key"),
    *fields("int", "_position:entry_position"),
    *fields("timestamp", "at:processed_at"),
    *_refs("user"),
    *fields("text", "newProcessingStatus"),
]
DIM_LOANCONDITION = [
    *fields("text", "_id:loancondition_id loanId conditionSource conditionType documentName documentType"),
    *fields("text", "fieldName blueWaterFieldValueId:bluewater_field_value_id unconfirmedFieldValue"),
    *fields("text", "confirmedFieldValue description"),
    *fields("timestamp", "createdAt"),
    *fields("text", "createdById"),
    *fields("timestamp", "submittedAt"),
    *fields("text", "submittedById"),
    *fields("timestamp", "insufficientAt"),
    *fields("text", "insufficientById"),
    *fields("timestamp", "clearedAt"),
    *fields("text", "clearedById"),
]
DIM_LOANCONDITIONEVENT = [
    *fields("text", "_id:loanconditionevent_id loanConditionId:loancondition_id eventType"),
    *fields("timestamp", "at:event_at"),
    *fields("text", "byId:event_by_id text:event_text"),
]
DIM_LOANEXCEPTION = [
    *fields("text", "_id:loanexception_id"),
    *_refs("loan"),
    *fields("text", "exceptionType description"),
    *fields("timestamp", "requestedAt"),
    *_refs("requestedBy"),
    *fields("timestamp", "approvedAt"),
    *_refs("approvedBy"),
    *fields("timestamp", "deniedAt"),
    *_refs("deniedBy"),
    *fields("timestamp", "createdAt"),
    *_refs("createdBy"),
]
DIM_HOLIDAY = [
    *fields("text", "_id:holiday_id"),
    *fields("date", "date:holiday_date"),
    *fields("text", "name:holiday_name officeClosed lockDeskClosesAt"),
    *fields("year", "date:holiday_year"),
    *fields("month", "date:holiday_month"),
]
DIM_LOANDOCUMENT = [
    *fields("text", "_id:loandocument_id"),
    *fields("int", "postgresId"),
    *fields("text", "postgresName"),
    *_refs("loan"),
    *fields("text", "name description contentType"),
    *fields("int", "size:size_bytes pageCount"),
    *fields("text", "s3Key:s3_key s3MultipartUploadId:s3_multipart_upload_id sessionToken"),
    *fields("timestamp", "uploadedAt"),
    *_refs("uploadedBy"),
    *fields("timestamp", "archivedAt"),
    *_refs("archivedBy"),
    *fields("timestamp", "uploadedToBlueWaterAt:uploaded_to_bluewater_at"),
    *fields("double", "blueWaterTransferMilliseconds:bluewater_transfer_milliseconds"),
    *fields("bool", "blueWaterFinalVersion:bluewater_final_version"),
    Field("loanCondition", "ref", "loancondition_id"),
    Field("loanConditionEvent", "ref", "loanconditionevent_id"),
    *fields("text", "documentType eepConditionTemplateName hash:file_hash"),
]


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    return calendar.staging_calendar(calendar.days(spark, first, last))


def dim_product(spark: SparkSession) -> DataFrame:
    return inline_table(
        spark, PRODUCTS, "product_id int, product_code string, product_name string, product_category string"
    )


def _correspondent_columns(record: Record) -> list[Column]:
    return [
        *columns(record, DIM_CORRESPONDENT),
        coalesce_spellings(record, "zip", "zipCode").alias("zip_code"),
        safe_col(record, "createdAt", "timestamp").alias("created_at"),
        first_of_list_fk(record, "accountExecutiveId", "accountExecutiveIds").alias("account_executive_id"),
    ]


def dim_correspondent(raw: DataFrame) -> DataFrame:
    return raw.select(*_correspondent_columns(Record.of(raw))).filter("correspondent_id is not null")


def correspondents_in_loans(loans: DataFrame) -> DataFrame:
    """Partners as far as loans tell, for when their own collection is missing."""
    record = Record.of(loans)
    nested = record.nested("correspondent")
    if nested is None:
        only_id = loans.select(resolve_fk(record, "correspondent").alias("_id"))
        return latest_per_key(dim_correspondent(only_id), "correspondent_id")
    found = loans.select(*_correspondent_columns(nested)).filter("correspondent_id is not null")
    return latest_per_key(found, "correspondent_id")


def dim_user(raw: DataFrame) -> DataFrame:
    record = Record.of(raw)

    def either(name: str, *others: str) -> Column:
        return first_existing(record, name, *others)

    return project(
        raw,
        DIM_USER,
        domains.safe_bool(either("disableLogin", "disable_login")).alias("disable_login"),
        either("__postgresId", "postgresId").alias("postgres_id"),
        either("__companyId", "companyId").alias("company_id"),
        either("__userType", "userType").alias("user_type"),
        either("__correspondentId", "correspondentId").alias("correspondent_id"),
        safe_col(record, "lastActiveAt", "timestamp").alias("last_active_at"),
    ).filter("user_id is not null")


def dim_investor(raw: DataFrame) -> DataFrame:
    return project(raw, DIM_INVESTOR).filter("investor_id is not null")


def dim_loan(raw: DataFrame, investors: DataFrame | None = None) -> DataFrame:
    """Loans; a missing investor name is looked up by investor key."""
    loans = project(raw, DIM_LOAN)
    if investors is None:
        return loans.withColumn("second_mortgage_investor_name", F.col("investor_name"))
    names = investors.select("investor_id", F.col("investor_name").alias("_looked_up"))
    found = lookup(loans, names, [("second_mortgage_investor_id", "investor_id")])
    name = F.coalesce("investor_name", "_looked_up")
    return found.withColumn("second_mortgage_investor_name", name).drop("_looked_up")


def _loan_children(raw: DataFrame, column: str, position: str, key: str, spec: list[Field], *extra: Column) -> DataFrame:
    """Child table of an array in loans; its key is 60 bits of the MD5 of loan and position."""
    keep = [F.col("_id").cast("string").alias("loan_id")]
    exploded = explode_children(raw, column, keep, position)
    hashed = F.md5(F.concat_ws(":", "loan_id", F.col(position).cast("string")).cast("binary"))
    head = [F.conv(F.left(hashed, F.lit(15)), 16, 10).cast("long").alias(key), F.col("loan_id"), F.col(position)]
    if exploded is None:
        nothing = raw.sparkSession.range(0).select(
            F.lit(None).cast("string").alias("loan_id"), F.lit(None).cast("int").alias(position)
        )
        return nothing.select(*head, *columns(Record({}, F.col), spec), *extra)
    rows, element = exploded
    return rows.select(*head, *columns(element, spec), *extra)


def dim_borrower(raw: DataFrame) -> DataFrame:
    """Borrowers of each loan; numbers only masked, the first one is primary."""
    primary = (F.col("borrower_position") == 0).alias("is_primary")
    return _loan_children(raw, "borrowers", "borrower_position", "borrower_id", BORROWER, primary)


def dim_eep_processing_entry(raw: DataFrame) -> DataFrame:
    """Processing status history of each loan."""
    return _loan_children(
        raw, "eepProcessingEntries", "array_index", "eep_processing_entry_id", PROCESSING_ENTRY
    )


def fact_loan_status(raw: DataFrame) -> DataFrame:
    return project(raw, FACT_LOAN_STATUS)


def fact_loan_metrics(raw: DataFrame) -> DataFrame:
    return project(raw, FACT_LOAN_METRICS)


def loan_wide(raw: DataFrame) -> DataFrame:
    """Loan, status and metrics columns of each raw loan in one projection.

    Equal to joining the three tables by loan when all come from one raw frame,
    without reading it three times or shuffling it.
    """
    spec: dict[str, Field] = {}
    for field in [*DIM_LOAN, *FACT_LOAN_STATUS, *FACT_LOAN_METRICS]:
        spec.setdefault(field.alias, field)
    return project(raw, spec.values())


def dim_loancondition(raw: DataFrame) -> DataFrame:
    record = Record.of(raw)
    stamps = [safe_col(record, n, "text") for n in ("clearedAt", "insufficientAt", "submittedAt")]
    return project(raw, DIM_LOANCONDITION, domains.condition_status(*stamps).alias("status"))


def dim_loancondition_documenttype(raw: DataFrame) -> DataFrame | None:
    """One row per document type asked for; None when the input has no such list."""
    if "documentTypes" not in raw.columns:
        return None
    record = Record.of(raw)
    keep = [safe_col(record, "_id").alias("loancondition_id"), safe_col(record, "loanId").alias("loan_id")]
    return explode_texts(raw, "documentTypes", keep, "document_type_position", "document_type")


def dim_loanconditionevent(raw: DataFrame) -> DataFrame:
    return project(raw, DIM_LOANCONDITIONEVENT)


def dim_loanexception(raw: DataFrame) -> DataFrame:
    return project(raw, DIM_LOANEXCEPTION)


def dim_holiday(raw: DataFrame) -> DataFrame:
    return project(raw, DIM_HOLIDAY)


def dim_loandocument(raw: DataFrame) -> DataFrame:
    return project(raw, DIM_LOANDOCUMENT)


def build_star(spark: SparkSession, raw: Mapping[str, DataFrame | None], run_ts: str) -> dict[str, DataFrame]:
    """All tables that the given raw collections allow, as ``zone/table`` to frame.

    Every keyed collection is reduced to its latest version first.  Missing users,
    investors and partners give empty tables (partners fall back to loans); other
    missing collections give no table.  Frames are lazy: write the deduplicated
    loans once and pass them in when they feed several tables of a large run.
    """
    latest = {
        name: latest_per_key(df, "_id", EXTRACTED_AT) for name, df in raw.items() if df is not None
    }
    loans = latest["loans"]
    investors = dim_investor(latest["investors"]) if "investors" in latest else empty_table(spark, DIM_INVESTOR)
    no_users = spark.range(0).select(F.lit(None).cast("string").alias("_id"))
    tables = {
        "dimensions/dim_date": dim_date(spark),
        "dimensions/dim_product": dim_product(spark),
        "dimensions/dim_correspondent": dim_correspondent(latest["correspondents"])
        if "correspondents" in latest
        else correspondents_in_loans(loans),
        "dimensions/dim_user": dim_user(latest.get("users", no_users)),
        "dimensions/dim_investor": investors,
        "dimensions/dim_loan": dim_loan(loans, investors),
        "dimensions/dim_borrower": dim_borrower(loans),
        "dimensions/dim_eep_processing_entry": dim_eep_processing_entry(loans),
        "facts/fact_loan_status": fact_loan_status(loans),
        "facts/fact_loan_metrics": fact_loan_metrics(loans),
    }
    optional = {
        "loanconditions": {
            "dim_loancondition": dim_loancondition,
            "dim_loancondition_documenttype": dim_loancondition_documenttype,
        },
        "loanconditionevents": {"dim_loanconditionevent": dim_loanconditionevent},
        "loanexceptions": {"dim_loanexception": dim_loanexception},
        "holidays": {"dim_holiday": dim_holiday},
        "loandocuments": {"dim_loandocument": dim_loandocument},
    }
    for collection, builders in optional.items():
        for table, build in builders.items():
            made = build(latest[collection]) if collection in latest else None
            if made is not None:
                tables[f"dimensions/{table}"] = made
    return {name: df.withColumn(LOADED_AT, F.lit(run_ts)) for name, df in tables.items()}
