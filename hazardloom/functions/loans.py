"""Loan-level projections: cleaning, derived origination fields, event flags, dummies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import columns as C
from . import constants as K


def clean_numeric_sentinels(df: DataFrame, rules: Mapping[str, float] | None = None) -> DataFrame:
    """NULL every value that reaches its column's sentinel; absent columns are skipped."""
    rules = K.NUMERIC_SENTINELS if rules is None else rules
    return df.withColumns({c: C.null_from(c, s) for c, s in rules.items() if c in df.columns})


def clean_string_sentinels(df: DataFrame, rules: Mapping[str, str] | None = None) -> DataFrame:
    rules = K.STRING_SENTINELS if rules is None else rules
    return df.withColumns({c: F.nullif(F.col(c), F.lit(s)) for c, s in rules.items() if c in df.columns})


def replace_value(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.nullif(F.col(column), F.lit(value)))


def term_filter(df: DataFrame, term: int = 360) -> DataFrame:
    return df.where(F.col("OriginalLoanTerm") == term)


def add_vintage(df: DataFrame, key: str = "LoanSequenceNumber", pivot: int = 90) -> DataFrame:
    """Vintage year and quarter from the key text (F YY Q n ...), two-digit years below the
    pivot belonging to this century."""
    yy = F.substring(key, 2, 2).cast("smallint")
    year = F.when(yy >= pivot, yy + F.lit(1900)).otherwise(yy + F.lit(2000))
    return df.withColumns({
        "VintageYear": year.cast("smallint"),
        "VintageQuarter": F.substring(key, 5, 1).cast("smallint"),
    })


def add_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "FICO_bucket": C.bucket("CreditScore", K.FICO_CUTS, K.FICO_LABELS,
                                right_closed=False, missing="Missing"),
        "LTV_bucket": C.bucket("OriginalLoantoValueLTV", K.LTV_CUTS, K.LTV_LABELS,
                               right_closed=True, missing="Missing"),
        "VintageBucket": C.bucket("VintageYear", K.VINTAGE_CUTS, K.VINTAGE_LABELS,
                                  right_closed=True),
    })


def add_risk_groups(df: DataFrame) -> DataFrame:
    """Coarse groups of the competing-risk curves; values outside the outer edges get NULL."""
    return df.withColumns({
        "fico_grp": C.interval("CreditScore", *K.FICO_GROUPS),
        "ltv_grp": C.interval("OriginalLoantoValueLTV", *K.LTV_GROUPS),
        "vintage_grp": C.interval("VintageYear", *K.VINTAGE_GROUPS),
    })


def prepare_origination(df: DataFrame, key: str = "LoanSequenceNumber", term: int = 360) -> DataFrame:
    """Term filter, sentinel cleaning and derived fields in one projection chain."""
    df = clean_string_sentinels(clean_numeric_sentinels(term_filter(df, term)))
    return add_buckets(add_vintage(df, key))


def add_event_flags(df: DataFrame, credit_codes: Sequence[int] = tuple(K.CREDIT_CODES)) -> DataFrame:
    zbc = F.col("ZeroBalanceCode")
    prepaid = F.coalesce(zbc == K.PREPAID_CODE, F.lit(False))
    return df.withColumns({
        "Prepaid": prepaid,
        "CreditTerminated": F.coalesce(zbc.isin(list(credit_codes)), F.lit(False)),
        "Terminated": zbc.isNotNull(),
        "Event_Prepay": prepaid.cast("tinyint"),
    })


def floor_duration(df: DataFrame, column: str = "Duration") -> DataFrame:
    d = F.coalesce(F.col(column), F.lit(1))
    return df.withColumn(column, F.greatest(d, F.lit(1)).cast("smallint"))


def add_rate_change(df: DataFrame) -> DataFrame:
    return df.withColumn("RateChange", F.col("OriginalInterestRate") - F.col("LastInterestRate"))


def event_name(prepaid: str = "prepaid", defaulted: str = "defaulted"):
    return (F.when(F.col(prepaid) == 1, "Prepaid").when(F.col(defaulted) == 1, "Defaulted")
            .otherwise("Censored"))


def event_code(prepaid: str = "prepaid", defaulted: str = "defaulted"):
    """1 = prepaid, 2 = defaulted, 0 = censored; prepayment wins where both are set."""
    return (F.when(F.col(prepaid) == 1, 1).when(F.col(defaulted) == 1, 2).otherwise(0)).cast("tinyint")


def any_event(prepaid: str = "prepaid", defaulted: str = "defaulted"):
    return C.flag((F.col(prepaid) == 1) | (F.col(defaulted) == 1))


def cox_dummies(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_Purchase": C.flag(F.col("LoanPurpose") == "P"),
        "is_CashOutRefi": C.flag(F.col("LoanPurpose") == "C"),
        "is_Investment": C.flag(F.col("OccupancyStatus") == "I"),
        "is_SecondHome": C.flag(F.col("OccupancyStatus") == "S"),
        "is_FirstTimeBuyer": C.flag(F.col("FirstTimeHomebuyerFlag") == "Y"),
        "is_Condo": C.flag(F.col("PropertyType") == "CO"),
        "is_PUD": C.flag(F.col("PropertyType") == "PU"),
        "has_MI": C.flag(F.col("MortgageInsurancePercentage") > 0),
        "is_MultiBorrower": C.flag(F.col("NumberofBorrowers") > 1),
    })


def panel_dummies(df: DataFrame, purpose: str = "loan_purpose", occupancy: str = "occupancy") -> DataFrame:
    return df.withColumns({
        "LP_Purchase": C.flag(F.col(purpose) == "P", "double"),
        "LP_NoCashRefi": C.flag(F.col(purpose) == "N", "double"),
        "Occ_Investment": C.flag(F.col(occupancy) == "I", "double"),
        "Occ_SecondHome": C.flag(F.col(occupancy) == "S", "double"),
    })


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce to double (bad text becomes NULL) and drop rows with any gap."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns}).dropna(subset=list(columns))
