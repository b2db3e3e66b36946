"""Closed vocabularies: booleans, statuses, flood codes, buckets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.functions.text import as_text, blank_to_null, clean_string, upper_text

# Fixed values -------------------------------------------------------------
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")
DELINQUENCY = {
    "0-29": ("0-29", "0to29", "0_29"),
    "30-59": ("30-59", "30to59", "30_59"),
    "60-89": ("60-89", "60to89", "60_89"),
    "90+": ("90+", "90plus", "90"),
}
STATUS_TITLES = {
    "Active": ("ACTIVE",),
    "Pending": ("PENDING",),
    "Approved": ("APPROVED",),
    "Cancelled": ("CANCELLED", "CANCELED"),
    "Denied": ("DENIED",),
    "Closed Without Approval": ("CLOSED WITHOUT APPROVAL",),
}
FLOOD_LABELS = {"REQ": "Flood Required", "NOT_REQ": "No Flood Required"}
FLOOD_NO = ("NO", "N", "FALSE")
FLOOD_YES = ("YES", "Y", "TRUE")
CONDITION_GRADES = ("C1", "C2", "C3", "C4", "C5")
OLD_HOUSE_YEAR = 1978
FICO_BANDS = {"600-639": (600, 639), "640-679": (640, 679), "680-699": (680, 699), "700+": (700, None)}
DTI_BANDS = {"0-39": (0, 40), "40-44": (40, 45), "45-49": (45, 50), "50+": (50, None)}
# --------------------------------------------------------------------------


def spelled_as(c: Column, spellings: Mapping[str, tuple[str, ...]]) -> Column:
    """The name whose spelling list holds the value, else NULL."""
    pairs = [(word, name) for name, words in spellings.items() for word in words]
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.try_element_at(table, c)


def safe_bool(c: Column) -> Column:
    word = F.lower(clean_string(c))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def settled_status(c: Column) -> Column:
    word = F.lower(clean_string(c))
    return F.when(word.isin("settled", "unsettled"), F.initcap(word))


def delinquency_bucket(c: Column) -> Column:
    return spelled_as(F.regexp_replace(F.lower(clean_string(c)), r"\s+", ""), DELINQUENCY)


def condition_status(cleared: Column, insufficient: Column, submitted: Column) -> Column:
    return F.coalesce(
        F.when(cleared.isNotNull(), "Cleared"),
        F.when(insufficient.isNotNull(), "Insufficient"),
        F.when(submitted.isNotNull(), "Submitted"),
        F.lit("Created"),
    )


def is_internal_source(c: Column) -> Column:
    name = upper_text(c)
    return name.contains("INTERNAL") | name.contains("UNIFICATION")


def status_normalized(source: Column, status: Column, approval: Column) -> Column:
    """Internal rows trust ``status``; external ones ``approval`` first."""
    own = F.coalesce(F.nullif(upper_text(status), F.lit("")), F.lit("BLANK"))
    given = F.nullif(upper_text(approval), F.lit(""))
    given = F.when(given == "PENDING ITEMS", F.lit("PENDING")).otherwise(given)
    return F.when(is_internal_source(source), own).otherwise(F.coalesce(given, own))


def status_title(normalized: Column) -> Column:
    """Display form of a normalised status; unknown words give ``Unmapped``."""
    word = upper_text(normalized)
    return F.coalesce(
        spelled_as(word, STATUS_TITLES),
        F.when(word.contains("PAID") & word.contains("FULL"), "Paid In Full"),
        F.when(word.isin("BLANK", ""), "Blank"),
        F.lit("Unmapped"),
    )


def flood_code(raw: Column) -> Column:
    """REQ, NOT_REQ or UNK from free text; ``not required`` wins over ``required``."""
    return flood_word_code(upper_text(raw))


def flood_word_code(word: Column) -> Column:
    """As ``flood_code``, from an ``upper_text``."""
    return (
        F.when(word.isin(*FLOOD_NO) | word.contains("NOT REQUIRED"), "NOT_REQ")
        .when(word.isin(*FLOOD_YES) | word.contains("REQUIRED"), "REQ")
        .otherwise("UNK")
    )


def flood_label(code: Column) -> Column:
    return F.coalesce(spelled_as(code, {v: (k,) for k, v in FLOOD_LABELS.items()}), F.lit("Unknown"))


def flood_by_policy(policy_type: Column) -> Column:
    word = upper_text(policy_type)
    return F.when(word.contains("FLOOD") | (word == "NFIP"), "REQ")


def flood_by_zone(zone: Column) -> Column:
    word = upper_text(zone)
    return F.when(word.startswith("A") | word.startswith("V"), "REQ").when(
        word.startswith("X") | word.isin("B", "C", "B/X"), "NOT_REQ"
    )


def flood_evidence(raw: Column, policy_type: Column, zone: Column) -> Column:
    """struct(code, source): the first rule that gives an answer, and its name."""
    return flood_choice(flood_code(raw), flood_by_policy(policy_type), flood_by_zone(zone))


def flood_choice(code: Column, by_policy: Column, by_zone: Column) -> Column:
    """As ``flood_evidence``, from the three rules' codes."""
    rules = (
        ("raw", F.nullif(code, F.lit("UNK"))),
        ("policy-type-inferred", by_policy),
        ("zone-inferred", by_zone),
    )
    answers = [
        F.when(code.isNotNull(), F.struct(code.alias("code"), F.lit(name).alias("source")))
        for name, code in rules
    ]
    nothing = F.struct(F.lit("UNK").alias("code"), F.lit("unresolved").alias("source"))
    return F.coalesce(*answers, nothing)


def property_condition(c: Column) -> Column:
    text = F.trim(as_text(c))
    return (
        F.when(F.upper(text).isin(*CONDITION_GRADES), F.upper(text))
        .when(text == "", "MNF - BLANK")
        .otherwise(F.concat(F.lit("MNF - "), text))
    )


def age_bucket(year: Column) -> Column:
    return F.when(year <= OLD_HOUSE_YEAR, f"{OLD_HOUSE_YEAR} or older").when(
        year > OLD_HOUSE_YEAR, f"Newer than {OLD_HOUSE_YEAR}"
    )


def band(c: Column, bands: Mapping[str, tuple[float, float | None]], whole_numbers: bool = False) -> Column:
    """Name of the band a number falls in, else NULL.

    Upper ends are inclusive for whole-number bands and exclusive otherwise.
    """
    def inside(low: float, high: float | None) -> Column:
        if high is None:
            return c >= low
        return (c >= low) & ((c <= high) if whole_numbers else (c < high))

    return F.coalesce(*[F.when(inside(*ends), name) for name, ends in bands.items()])


def fico_band(c: Column) -> Column:
    return band(c, FICO_BANDS, whole_numbers=True)


def dti_band(c: Column) -> Column:
    return band(c, DTI_BANDS)


def buyer_from_marks(ownership: Column, usf_number: Column) -> Column:
    """Two-way buyer: named in the ownership text, or holding its loan number."""
    return F.when(upper_text(ownership).contains("USF") | blank_to_null(usf_number).isNotNull(), "USF").otherwise("MWF")


def buyer_three_way(ownership: Column, usf_number: Column, contract_date: Column) -> Column:
    """As above, but MWF needs a contract date and the rest is ``Unknown``."""
    named = upper_text(ownership).contains("USF") | (as_text(usf_number) != "")
    return F.when(named, "USF").when(contract_date.isNotNull(), "MWF").otherwise("Unknown")
