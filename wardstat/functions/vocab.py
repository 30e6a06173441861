"""Fixed values that must equal the reference's for right results.

Everything in this module is data (word lists, lookup tables, bounds, names),
stated plainly and in the reference's natural order. No logic lives here.
"""

# --- fixed values: textual missing-value placeholders (after strip + lower) ---
PLACEHOLDERS = ["", "-", "--", "na", "n/a", "unknown", "<missing>"]

# --- fixed values: dictionaries for categorical canonicalisation ---
GENDER_MAP = {"m": "male", "male": "male", "mal": "male", "f": "female", "female": "female",
              "femal": "female", "o": "other", "other": "other", "1": "male", "0": "female"}
ETHNICITY_MAP = {"white": "white", "caucasian": "white",
                 "black": "black", "african american": "black", "african-american": "black", "aa": "black",
                 "hispanic": "hispanic_or_latino", "latino": "hispanic_or_latino",
                 "latina": "hispanic_or_latino", "hispanic/latino": "hispanic_or_latino"}
DRUG_MAP = {"warfarine": "warfarin",
            "metformine": "metformin", "met formin": "metformin",
            "omeprazol": "omeprazole",
            "gabapentine": "gabapentin",
            "amoxycillin": "amoxicillin", "amoxicilin": "amoxicillin",
            "lisinipril": "lisinopril", "lisino pril": "lisinopril",
            "ibuprofin": "ibuprofen", "ibuprophen": "ibuprofen",
            "atorvastatine": "atorvastatin", "atorvastain": "atorvastatin",
            "tramadole": "tramadol",
            "insulin glargine": "insulin glargine",
            "none": "no_drug"}
ROUTE_MAP = {"iv": "intravenous", "im": "intramuscular", "sc": "subcutaneous"}
DIAGNOSIS_MAP = {"htn": "hypertension", "dm2": "type 2 diabetes", "t2dm": "type 2 diabetes",
                 "afib": "atrial fibrillation", "ckd": "chronic kidney disease", "oa": "osteoarthritis",
                 "hld": "hyperlipidemia", "chf": "heart failure"}
SMOKING_MAP = {"yes": "current", "y": "current", "true": "current", "1": "current", "current": "current",
               "no": "never", "n": "never", "false": "never", "0": "never", "never": "never",
               "former": "former", "ex smoker": "former", "ex-smoker": "former", "ex": "former"}

# --- fixed values: binary outcome labels ---
BINARY_ZERO = ["0", "no", "false", "ineffective"]
BINARY_ONE = ["1", "yes", "true", "effective"]

# --- fixed values: duration labels meaning one year (exact, case-sensitive) ---
DURATION_LABELS = {"ongoing": 365, "chronic": 365, "lifetime": 365}

# --- fixed values: patterns ---
DOSAGE_MG_PATTERN = r"(?:^|\D)(\d+\.?\d*)\s*mg(?:\D|$)"
PLAIN_NUMBER_PATTERN = r"^\d+\.?\d*$"
BLOOD_PRESSURE_PATTERN = r"(\d{2,3})\s*/\s*(\d{2,3})"
POUNDS_PER_KG = 2.20462
FEET_TO_CM = 30.48
FEET_RANGE = (4, 8)

# --- fixed values: date formats tried in order (Spark datetime patterns) ---
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "MMMM d, yyyy", "MM/dd/yyyy"]

# --- fixed values: plausible closed ranges; outside -> NULL ---
RANGES = {
    "age": (0, 120), "weight_kg": (2, 300), "height_cm": (50, 250), "bmi": (5, 100),
    "systolic_bp": (50, 250), "diastolic_bp": (30, 150), "heart_rate": (20, 250),
    "temperature_f": (90, 110), "hemoglobin": (3, 25), "wbc_count": (500, 100000),
    "alt_enzyme": (0, 1000), "ast_enzyme": (0, 1000), "creatinine": (0.1, 20),
    "egfr": (0, 200), "hba1c": (2, 25), "total_cholesterol": (50, 1000),
    "dosage_mg": (0, 5000), "duration_days": (0, 3650), "concurrent_drugs": (0, 50),
}
BMI_RANGE = (5, 100)

# --- fixed values: schema ---
DROP_COLUMNS = ["patient_id_1", "age_1", "gender_1", "drug_name_1", "Weight_lbs",
                "blood_pressure", "Notes", "Extra_Col_1", "Extra_Col_2", "unnamed_0"]
FINAL_COLUMNS = [
    "patient_id", "age", "gender", "ethnicity", "weight_kg", "height_cm", "bmi",
    "systolic_bp", "diastolic_bp", "heart_rate", "temperature_f", "hemoglobin",
    "wbc_count", "alt_enzyme", "ast_enzyme", "creatinine", "egfr", "hba1c",
    "total_cholesterol", "drug_name", "dosage_mg", "duration_days", "route",
    "concurrent_drugs", "diagnosis", "smoking_status", "alcohol_use", "admission_date",
    "treatment_outcome", "adverse_event", "readmission_30d",
]
ALIASES = {
    "patient_id": ["patient_id", "patient id", "patientid"],
    "age": ["age"], "gender": ["gender"], "ethnicity": ["ethnicity"],
    "weight_kg": ["weight_kg", "weightkg", "weight"],
    "height_cm": ["height_cm", "heightcm", "height"],
    "bmi": ["bmi"],
    "systolic_bp": ["systolic_bp", "systolicbp", "systolic"],
    "diastolic_bp": ["diastolic_bp", "diastolicbp", "diastolic"],
    "heart_rate": ["heart_rate", "heartrate", "pulse"],
    "temperature_f": ["temperature_f", "temperaturef", "temp"],
    "hemoglobin": ["hemoglobin", "hb"],
    "wbc_count": ["wbc_count", "wbc"],
    "alt_enzyme": ["alt_enzyme", "alt"], "ast_enzyme": ["ast_enzyme", "ast"],
    "creatinine": ["creatinine"], "egfr": ["egfr"], "hba1c": ["hba1c"],
    "total_cholesterol": ["total_cholesterol", "cholesterol"],
    "drug_name": ["drug_name", "drugname", "drug"],
    "dosage_mg": ["dosage_mg", "dosage"],
    "duration_days": ["duration_days", "duration"],
    "route": ["route"],
    "concurrent_drugs": ["concurrent_drugs", "concurrentdrugs"],
    "diagnosis": ["diagnosis"],
    "smoking_status": ["smoking_status", "smoking"],
    "alcohol_use": ["alcohol_use", "alcohol"],
    "admission_date": ["admission_date", "admissiondate", "admit_date"],
    "treatment_outcome": ["treatment_outcome", "treatmentoutcome"],
    "adverse_event": ["adverse_event", "adverse"],
    "readmission_30d": ["readmission_30d", "readmission30d"],
}
KEY_CANDIDATES = ["Patient_ID", "patient_id", "patientid"]

NUMERIC_COLUMNS = [
    "age", "weight_kg", "height_cm", "bmi", "systolic_bp", "diastolic_bp",
    "heart_rate", "temperature_f", "hemoglobin", "wbc_count", "alt_enzyme",
    "ast_enzyme", "creatinine", "egfr", "hba1c", "total_cholesterol",
    "dosage_mg", "duration_days", "concurrent_drugs",
]
CATEGORICAL_COLUMNS = ["gender", "ethnicity", "drug_name", "route", "diagnosis", "smoking_status", "alcohol_use"]
PREDICTORS = NUMERIC_COLUMNS + CATEGORICAL_COLUMNS
OUTCOME_COLUMNS = ["treatment_outcome", "adverse_event", "readmission_30d"]
TARGET = "treatment_outcome"
IQR_COLUMNS = ["age", "bmi", "dosage_mg", "hemoglobin", "creatinine", "alt_enzyme", "ast_enzyme"]
IQR_FACTOR = 1.5

# --- fixed values: engineered features ---
ENGINEERED_CATEGORICAL = ["kidney_stage", "bmi_category", "age_group"]
ENGINEERED_NUMERIC = ["liver_risk", "polypharmacy", "elderly_high_dose", "de_ritis_ratio"]
ENGINEERED_COLUMNS = ENGINEERED_CATEGORICAL + ENGINEERED_NUMERIC
FEATURE_NUMERIC = NUMERIC_COLUMNS + ENGINEERED_NUMERIC
FEATURE_CATEGORICAL = CATEGORICAL_COLUMNS + ENGINEERED_CATEGORICAL
LIVER_LIMIT = 40
POLYPHARMACY_MIN = 5
ELDERLY_AGE = 65

# --- fixed values: leakage columns removed before modelling ---
LEAKAGE_COLUMNS = ["patient_id", "treatment_outcome", "admission_date", "adverse_event", "readmission_30d"]

# --- fixed values: text limits of the stored patients table ---
TEXT_LIMITS = {"gender": 16, "ethnicity": 64, "drug_name": 64, "route": 32, "diagnosis": 128,
               "smoking_status": 32, "alcohol_use": 32}

# --- fixed values: prediction service ---
CUTOFF = 0.50
OUTCOME_LABELS = {1: "Effective", 0: "Ineffective"}
