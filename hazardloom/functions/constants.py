"""Codes, cut points, labels and defaults the results depend on."""

# --- fixed values: missing-value sentinels of the raw loan files ---------------
NUMERIC_SENTINELS = {
    "CreditScore": 9999,
    "OriginalLoantoValueLTV": 999,
    "OriginalCombinedLoantoValueCLTV": 999,
    "OriginalDebttoIncomeRatio": 999,
    "MortgageInsurancePercentage": 999,
    "NumberofBorrowers": 99,
    "NumberofUnits": 99,
}
STRING_SENTINELS = {
    "Channel": "9",
    "FirstTimeHomebuyerFlag": "9",
    "OccupancyStatus": "9",
    "LoanPurpose": "9",
    "PropertyType": "99",
}

# --- fixed values: raw column lists --------------------------------------------
ORIGINATION_COLUMNS = [
    "LoanSequenceNumber", "CreditScore", "FirstPaymentDate", "FirstTimeHomebuyerFlag",
    "MaturityDate", "MortgageInsurancePercentage", "NumberofUnits", "OccupancyStatus",
    "OriginalCombinedLoantoValueCLTV", "OriginalDebttoIncomeRatio", "OriginalUPB",
    "OriginalLoantoValueLTV", "OriginalInterestRate", "Channel", "PropertyState",
    "PropertyType", "LoanPurpose", "OriginalLoanTerm", "NumberofBorrowers",
    "PrepaymentPenaltyMortgageFlag", "SuperConformingFlag", "HARPIndicator",
    "ProgramIndicator",
]
PERFORMANCE_COLUMNS = [
    "LoanSequenceNumber", "MonthlyReportingPeriod", "LoanAge", "ZeroBalanceCode",
    "CurrentInterestRate", "CurrentLoanDelinquencyStatus", "CurrentActualUPB",
]

# --- fixed values: bucket cut points and labels --------------------------------
# half-open: value < cut goes to the label at the same position, the rest to the last
FICO_CUTS = [620, 660, 700, 740, 780]
FICO_LABELS = ["<620", "620-659", "660-699", "700-739", "740-779", "780+"]
# right-closed: value <= cut goes to the label at the same position
LTV_CUTS = [60, 70, 80, 90, 95]
LTV_LABELS = ["<=60", "61-70", "71-80", "81-90", "91-95", "96+"]
VINTAGE_CUTS = [2003, 2007, 2011, 2015, 2019]
VINTAGE_LABELS = ["1999-2003", "2004-2007", "2008-2011", "2012-2015", "2016-2019", "2020+"]

# right-closed groups of the competing-risk strata
FICO_GROUPS = ([0, 680, 740, 850], ["FICO < 680", "FICO 680–740", "FICO > 740"])
LTV_GROUPS = ([0, 80, 100], ["LTV ≤ 80", "LTV > 80"])
VINTAGE_GROUPS = ([1998, 2007, 2015, 2025], ["1999–2007", "2008–2015", "2016–2025"])

PURPOSE_LABELS = {"P": "Purchase", "N": "Refi (No Cash-Out)", "C": "Refi (Cash-Out)"}

# strata drawn in the log-log check of proportional hazards
LOGLOG_STRATA = [
    ("FICO_bucket", "FICO Score", ["<620", "660-699", "740-779", "780+"]),
    ("LTV_bucket", "Original LTV", ["<=60", "71-80", "81-90", "96+"]),
    ("LoanPurpose", "Loan Purpose", ["P", "N", "C"]),
]

# --- fixed values: termination codes -------------------------------------------
PREPAID_CODE = 1
CREDIT_CODES = [2, 3, 9]

# --- fixed values: features ----------------------------------------------------
NUMERIC_FEATURES = [
    "CreditScore", "OriginalLoantoValueLTV", "OriginalCombinedLoantoValueCLTV",
    "OriginalDebttoIncomeRatio", "OriginalUPB", "OriginalInterestRate",
    "MortgageInsurancePercentage", "NumberofBorrowers", "OriginalLoanTerm",
]
CATEGORICAL_FEATURES = [
    "LoanPurpose", "OccupancyStatus", "FirstTimeHomebuyerFlag", "PropertyType",
    "Channel", "PropertyState",
]
TOP_LEVELS = 20
COX_COVARIATES = [
    "FICO_z", "LTV_z", "Rate_z", "UPB_z", "DTI_z", "DTI_missing", "is_Purchase",
    "is_CashOutRefi", "is_Investment", "is_SecondHome", "is_FirstTimeBuyer", "is_Condo",
    "is_PUD", "has_MI", "is_MultiBorrower",
]
MACRO_COVARIATES = ["MortgageRate", "Treasury10Y", "Unemployment", "HPI_YoY"]
PANEL_STATIC = [
    "FICO", "LTV", "DTI", "UPB", "orig_rate",
    "LP_Purchase", "LP_NoCashRefi", "Occ_Investment", "Occ_SecondHome",
]
PANEL_DYNAMIC = ["ELTV", "unemployment", "hpi_yoy", "rate_incentive"]
COVARIATE_LABELS = {
    "FICO_z": "FICO (standardized)",
    "LTV_z": "LTV (standardized)",
    "Rate_z": "Orig. Interest Rate (std)",
    "UPB_z": "Loan Balance (standardized)",
    "DTI_z": "DTI (standardized)",
    "DTI_missing": "DTI Missing",
    "is_Purchase": "Purchase (vs Refi)",
    "is_CashOutRefi": "Cash-Out Refi",
    "is_Investment": "Investment Property",
    "is_SecondHome": "Second Home",
    "is_FirstTimeBuyer": "First-Time Buyer",
    "is_Condo": "Condo",
    "is_PUD": "PUD",
    "has_MI": "Has Mortgage Insurance",
    "is_MultiBorrower": "Multiple Borrowers",
    "MortgageRate_z": "30yr Mortgage Rate (std)",
    "Treasury10Y_z": "10yr Treasury Rate (std)",
    "Unemployment_z": "Unemployment Rate (std)",
    "HPI_YoY_z": "HPI Growth YoY (std)",
}
MODEL_ORDER = ["LogReg", "RF", "LGBM", "Cox", "LinearCox", "DeepCox"]

# --- fixed values: replayed encoder (stored vocabulary, zero impute) -------------
REPLAY_LEVELS = {
    "LoanPurpose": ["P", "N", "C"],
    "OccupancyStatus": ["P", "I", "S"],
    "FirstTimeHomebuyerFlag": ["N", "Y"],
    "PropertyType": ["SF", "PU", "CO", "MH", "CP"],
    "Channel": ["R", "T", "C", "B"],
    "PropertyState": [
        "CA", "FL", "IL", "TX", "MI", "NY", "OH", "PA", "VA", "NC",
        "WA", "MN", "GA", "NJ", "AZ", "CO", "MA", "MD", "WI", "MO",
    ],
}
REPLAY_DEFAULT_VINTAGE = 2010

# --- fixed values: horizons, splits, defaults -----------------------------------
MONTH_GRID = 360
KEY_MONTHS = [12, 24, 36, 60, 84, 120, 180, 240]
HORIZONS = [12, 24, 36, 60]
LANDMARKS = [12, 24, 36, 60, 84, 120]
DATA_CUTOFF = 202509
TRAIN_END, TEST_START, TEST_END = 2014, 2015, 2019
VALIDATION_FRACTION = 0.10
SEED = 42
SEQUENCE_MONTHS = 120
RANKING_SIGMA = 0.1
RANKING_WEIGHT = 0.2
BASE_PREPAY_HAZARD = 0.008
BASE_DEFAULT_HAZARD = 0.004
FRED_SERIES = [
    ("MORTGAGE30US.csv", "MortgageRate"),
    ("DGS10.csv", "Treasury10Y"),
    ("UNRATE.csv", "Unemployment"),
    ("CSUSHPINSA.csv", "HPI"),
    ("FPCPITOTLZGUSA.csv", "CPI_YoY"),
]

# --- fixed values: rate scenarios ------------------------------------------------
SHOCKS_BP = [-300, -200, -100, 0, 100, 200, 300]
COUPON_PCT = 5.0
MARKET_PCT = 5.3
REPRESENTATIVE_LOAN = {
    "FICO": 742.0, "LTV": 74.0, "DTI": 35.0, "unemployment": 4.0, "hpi_yoy": 2.0,
}
SCENARIO_MONTHS = 120
PEAK_AGE = 36
PATHS = 200
PATH_SIGMA_BP = 25.0
FACE_AMOUNT = 300000.0

# --- fixed values: archetype loans ------------------------------------------------
ARCHETYPES = [
    # name, FICO, LTV, orig_rate, DTI, UPB
    ("Prime FRM", 760, 65, 4.0, 28, 300000),
    ("Median FRM", 700, 80, 5.5, 38, 250000),
    ("Subprime FRM", 640, 95, 6.5, 45, 200000),
]
