"""Values that outputs and inputs must equal; nothing here is computed."""

# --- fixed values: columns and domains of the labelled table -----------------
LABEL_COLUMN = "species"
FEATURE_COLUMNS = (
    "island",
    "culmen_length_mm",
    "culmen_depth_mm",
    "flipper_length_mm",
    "body_mass_g",
    "sex",
)
LABELLED_DDL = (
    "species STRING, island STRING, culmen_length_mm DOUBLE, culmen_depth_mm DOUBLE, "
    "flipper_length_mm DOUBLE, body_mass_g DOUBLE, sex STRING"
)
FEATURE_DDL = (
    "island STRING, culmen_length_mm DOUBLE, culmen_depth_mm DOUBLE, "
    "flipper_length_mm DOUBLE, body_mass_g DOUBLE, sex STRING"
)
LABEL_DOMAIN = ("Adelie", "Chinstrap", "Gentoo")

# --- fixed values: spellings of a missing value in CSV text ------------------
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: content types and error texts -----------------------------
CSV_TYPE = "text/csv"
JSON_TYPE = "application/json"
NO_INPUT = "No input data received."
NO_RESPONSE = "No predictions/probabilities received from the model."

# --- fixed values: split sizes and seeds -------------------------------------
TEST_PERCENT = 20
TEST_SEED = 42
FOLD_SEED = 41
FOLDS = 3

# --- fixed values: training, tuning, gate ------------------------------------
HIDDEN_LAYERS = (10, 8)
BATCH_SIZE = 32
LEARNING_RATE = 0.01
DEFAULT_EPOCHS = 20
TUNING_EPOCHS = (10, 30, 50)
LOG_PATTERNS = {
    "loss": r"loss: ([0-9\.]+)",
    "accuracy": r"accuracy: ([0-9\.]+)",
    "val_accuracy": r"val_accuracy: ([0-9\.]+)",
}
ACCURACY_PATH = "metrics.accuracy.model_1"
ACCURACY_THRESHOLD = 0.6
GATE_MESSAGE = "Model's accuracy is less than accuracy threshold"

# --- fixed values: registry and monitors -------------------------------------
PENDING_STATUS = "PendingManualApproval"
APPROVED_STATUS = "Approved"
MONITOR_TYPES = ("DataQuality", "ModelQuality")
VIOLATED_STATUS = "CompletedWithViolations"
REPORT_TYPES = ("text/csv", "application/json")
MODEL_TASK = "CLASSIFICATION"
MODEL_DOMAIN = "MACHINE_LEARNING"

# --- fixed values: layouts of event and file texts ---------------------------
GROUND_TRUTH_DDL = (
    "groundTruthData STRUCT<data: STRING, encoding: STRING>, "
    "eventMetadata STRUCT<eventId: STRING>, eventVersion STRING"
)
GROUND_TRUTH_PATH_FORMAT = "yyyy/MM/dd/HH/mmss"
VERSION_SUFFIX_FORMAT = "MMddHHmmss"
PREDICTIONS_DDL = "predictions ARRAY<ARRAY<DOUBLE>>"
