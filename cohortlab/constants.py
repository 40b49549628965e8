"""Fixed values the results depend on.

Everything here is a value that must stay exactly as written for results to
match the study definition (sentinels, scale divisors, the flag order, the
special-character class of the note cleaner). Keep them together, in natural
order, as plain text.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Stand-in instant for "no date" (missing out time, living subject).
SENTINEL_TS = "9000-01-01 00:00:00"
SENTINEL_MS = 221845392000000          # epoch millis of SENTINEL_TS in UTC
# Constant index date carried on every subject, and its placeholder age.
INDEX_TS = "1971-01-01 00:00:00"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

MS_HOUR = 3_600_000
MS_DAY = 86_400_000
MS_YEAR = 31_536_000_000               # 365 days

# Age handling: recorded ages at or above 300 years are masked ages -> 89.
AGE_MASK_AT = 300.0
AGE_MASK_TO = 89.0
MIN_AGE = 18.0
# Feature scaling divisors: largest possible age and severity score.
MAX_AGE = 89.0
MAX_SCORE = 163.0
# Minimum number of kept words per subject for the note cohort.
MIN_WORDS = 100
# Label windows, in whole days after the out time (inclusive).
DAYS_30 = 30
DAYS_1Y = 365
# Category substring of notes dropped at load (matched lower-case).
EXCLUDED_CATEGORY = "discharge"

# The 30 comorbidity flags, in the packing order of the source table.
FLAG_NAMES = [
    "congestive_heart_failure", "cardiac_arrhythmias", "valvular_disease",
    "pulmonary_circulation", "peripheral_vascular", "hypertension", "paralysis",
    "other_neurological", "chronic_pulmonary", "diabetes_uncomplicated",
    "diabetes_complicated", "hypothyroidism", "renal_failure", "liver_disease",
    "peptic_ulcer", "aids", "lymphoma", "metastatic_cancer", "solid_tumor",
    "rheumatoid_arthritis", "coagulopathy", "obesity", "weight_loss",
    "fluid_electrolyte", "blood_loss_anemia", "deficiency_anemias",
    "alcohol_abuse", "drug_abuse", "psychoses", "depression",
]

# The 17 numeric fields of the severity-score table, in table order.
SCORE_FIELDS = [
    "sapsii", "sapsii_prob", "age_score", "hr_score", "sysbp_score", "temp_score",
    "pao2fio2_score", "uo_score", "bun_score", "wbc_score", "potassium_score",
    "sodium_score", "bicarbonate_score", "bilirubin_score", "gcs_score",
    "comorbidity_score", "admissiontype_score",
]

# Note cleaner. Step 1 replaces this character class with a space: the range
# space..hyphen (0x20-0x2D), then . / : ; < = > ? @ [ \ ] ^ _ ` { } ~ and the
# minus sign U+2212. Written so that Java regex and RE2 read it the same way.
SPECIAL_CHARS_CLASS = r"[\x20-\x2D./:;<=>?@\[\\\]^_`{}~\x{2212}]"
# Step 2: any word that contains a digit (ASCII word characters).
DIGIT_WORD = r"\w*\d\w*"
# Steps 3 and 4: a single letter or comma between two whitespace characters.
LONE_CHAR = r"[ \t\n\x0B\f\r][A-Z,a-z][ \t\n\x0B\f\r]"
# Token separator: exactly one whitespace character (Java's \s).
WHITESPACE_CHAR = r"[ \t\n\x0B\f\r]"
# Kept tokens are longer than this many characters.
MIN_TOKEN_CHARS_EXCLUSIVE = 3

# Default stop words: Spark ML's English list
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
DEFAULT_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he "
    "him his himself she her hers herself it its itself they them their theirs "
    "themselves what which who whom this that these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t can "
    "will just don should now i'll you'll he'll she'll we'll they'll i'd you'd "
    "he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't "
    "doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot "
    "could here's how's let's ought that's there's what's when's where's who's "
    "why's would"
).split(" ")

# Study defaults: split proportion, target positive share after rebalancing,
# hour sweep, model settings (EXP-3 has an L2 parameter of its own).
TRAIN_PROPORTION = 0.7
TARGET_POSITIVE_SHARE = 0.3
HOURS_START, HOURS_STOP, HOURS_STEP = 0, 240, 12
TOPIC_HOURS_START = 12
N_FOLDS = 5
LDA_K = 50
LDA_ITERATIONS = 50
SVM_ITERATIONS = 300
SVM_REG = 100.0
RETROSPECTIVE_TOPIC_REG = 0.1
BASELINE_GRID = {"intercept": [True], "iterations": [200, 300, 400],
                 "reg": [0.1, 1.0, 10.0, 50.0, 100.0]}
DERIVED_GRID = {"intercept": [False, True], "iterations": [200, 300, 400],
                "reg": [0.1, 1.0, 10.0, 100.0]}
# ------------------------------------------------------------ end fixed values
