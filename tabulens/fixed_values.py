"""Constants, grids, name lists and tokens that results depend on."""

# Outlier criteria: number of standard deviations and inter-quartile-range factor.
NR_STDEV = 2
IQR_FACTOR = 1.5

# Seed and test share of every reproducible sample and split.
SEED = 42
TEST_SHARE = 0.3

# Rows the capped studies fit on.
FIT_ROWS = 1_000

# A candidate model replaces the best one only if it is better by more than this.
DELTA_IMPROVE = 0.001

# CSV tokens read as missing (the public pandas default list).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Extra text that counts as missing in the missing-value profile (lower case).
UNKNOWN_TOKEN = "unknown"

# Column-name parts that mark a date variable in the granularity study.
DATE_NAME_PARTS = ["date", "time", "year"]

# Date levels in order.
DATE_LEVELS = ["year", "quarter", "month", "day", "hour"]

# Text accepted as a number.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?|[nN]a[nN])\s*$"

# Fill values of the "constant" strategy.
FILL_NUMERIC = -1
FILL_SYMBOLIC = "NA"
FILL_BINARY = False

# Study grids.
KNN_STUDY_K = list(range(1, 50, 2))
KNN_STUDY_METRICS = ["manhattan", "euclidean", "chebyshev"]
KNN_EVALUATE_K = [1, 5, 10, 15, 20, 25]
TREE_STUDY_CRITERIA = ["entropy", "gini"]
TREE_STUDY_DEPTHS = [2, 4, 6, 8, 10, 15, 20, 25]
LOGISTIC_STUDY_PENALTIES = ["l1", "l2"]
LOGISTIC_STUDY_ITERATIONS = [10, 50, 100, 500, 1000, 2500, 5000]
MLP_STUDY_SCHEDULES = ["constant", "invscaling", "adaptive"]
MLP_STUDY_RATES = [0.5, 0.05, 0.005, 0.0005]
MLP_STUDY_LAG = 250
MLP_STUDY_MAX_ITERATIONS = 2500
ADAM_RATE = 0.001

# Leaderboard: one configuration per model.
LEADERBOARD = {
    "NaiveBayes": {"variant": "gaussian"},
    "KNN": {"k": 5, "metric": "manhattan"},
    "DecisionTree": {"criterion": "entropy", "max_depth": 10},
    "LogReg": {"penalty": "l2", "max_iter": 1000},
    "MLP": {"hidden": 50, "max_iter": 500},
}
