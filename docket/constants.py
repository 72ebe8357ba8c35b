"""Names, markers, thresholds and search bounds the jobs share."""

# Column names, markers and numbers that the case data and the
# published method prescribe.
KEY = "codigo_processo"
TARGET = "resultado_processo"
JOB_TITLE = "cargo"
FLAG_AS_TEXT = "vt"
EVIDENCE_PATTERN = "prova"
TENURE_PATTERN = "tempo_cargo"
INVALID = "INV"
YES = "SIM"
NO = "NÃO"
MISSING = "Missing"
POSITIVE = "Positivo"
NEGATIVE = "Negativo"
TRUE_TEXT = "True"
FALSE_TEXT = "False"

DOMINANT_SHARE = 0.9
RAREST_MIN_ROWS = 5
HIGH_CARD_RATIO = 0.3
KEEP_FEATURES = 30
VOTES_TO_DROP = 2
SEED = 9
TRAIN_FOLDS = 10
SELECTOR_FOLDS = 5
TRIALS = 100
SELECTOR_DEPTH = 5
SHADOW_ROUNDS = 1000
POPULATION = 100
GENERATIONS = 40
GENERATIONS_WITHOUT_GAIN = 10

# Sizes of our own: a column of more values than the first is coded by a dictionary of at most as many codes as the second.
MAX_NOMINAL = 256
MAX_CODES = 255

METRICS = (
    "recall_class0",
    "recall_class1",
    "precision_class0",
    "precision_class1",
    "f1_class0",
    "f1_class1",
    "accuracy",
)

# Search laws, one line per parameter: (name, law, low, high, step).
BOOSTED_SPACE = (
    ("learning_rate", "loguniform", 0.001, 0.5, None),
    ("reg_alpha", "loguniform", 0.001, 1.0, None),
    ("reg_lambda", "loguniform", 0.001, 1.0, None),
    ("subsample", "uniform", 0.2, 1.0, None),
    ("colsample_bytree", "uniform", 0.2, 1.0, None),
    ("min_child_samples", "quniform", 1, 100, 1),
    ("num_leaves", "quniform", 2, 50, 1),
    ("subsample_freq", "quniform", 1, 10, 1),
    ("n_estimators", "quniform", 100, 5000, 1),
)
BAGGED_SPACE = (
    ("n_estimators", "quniform", 50, 300, 10),
    ("num_leaves", "quniform", 2, 100, 1),
    ("subsample", "uniform", 0.3, 0.95, None),
    ("colsample_bytree", "uniform", 0.3, 0.95, None),
)
ADDITIVE_SPACE = (
    ("learning_rate", "loguniform", 0.001, 0.5, None),
    ("max_rounds", "quniform", 10, 3000, 1),
    ("interactions", "quniform", 0, 20, 1),
    ("max_leaves", "quniform", 2, 10, 1),
    ("outer_bags", "quniform", 8, 16, 1),
    ("max_bins", "quniform", 8, 128, 1),
    ("max_interaction_bins", "quniform", 8, 64, 1),
    ("min_samples_leaf", "quniform", 1, 30, 1),
)
SPACES = {"boosted": BOOSTED_SPACE, "bagged": BAGGED_SPACE, "additive": ADDITIVE_SPACE}
