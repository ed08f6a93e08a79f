"""Words, labels, bounds, defaults and formats the results depend on."""

# Fixed values.
TITLE_WORDS = ("JR", "SR", "III", "II", "PHD", "MR", "MRS", "MS", "DR", "NIECE", "SON", "DAUGHTER")
TITLE_PUNCTUATION = ".,()"
SPECIAL_CHARACTERS = r"[^A-Za-z0-9 ]"
UNKNOWN_CODE = "UN"
GENDER_CODES = {"M": ("M", "MALE"), "F": ("F", "FEMALE")}
AGE_BOUNDS = (18, 35, 60)
AGE_LABELS = ("Paediatric", "Young Adult", "Middle Aged", "Senior")
DATE_FORMAT = "yyyy-MM-dd"
SILVER_TYPES = {"age": "int", "billing_amount": "decimal(18,2)", "room_number": "int"}
SILVER_DATES = ("date_of_admission", "discharge_date")
NULL_DEFAULTS = {
    "medication": "Not Prescribed",
    "test_results": "Pending",
    "insurance_provider": "Unknown",
    "MiddleName": "",
}
AGE_RANGE = (0, 120)
STAY_RANGE = (0, 365)
ABNORMAL = "Abnormal"
HASH_SEPARATOR = "||"
SILVER_PARTITIONS = ("_ingest_date", "medical_condition")
CONDITION_KEYS = ("medical_condition",)
BILLING_KEYS = ("insurance_provider", "age_group", "medical_condition")
DEMOGRAPHIC_KEYS = ("age_group", "gender", "medical_condition")
# The nine questions: what is totalled or averaged, and the name of the answer.
INSURER_TOTAL = ("insurance_provider", "total_billing_amount", "grand_total")
AGE_GROUP_AVG_BILLING = ("age_group", "avg_billing_amount", "avg_bill")
CONDITION_TOTAL = ("medical_condition", "total_billing_amount", "condition_total")
AGE_GROUP_PATIENTS = ("age_group", "total_patients", "total")
GENDER_AVG_BILLING = ("gender", "avg_billing_amount", "avg_bill")
CONDITION_ABNORMAL = ("medical_condition", "abnormal_test_rate_pct", "avg_abnormal")
