"""Fixed values.

Everything in this file must stay exactly as it is for results to be right:
thresholds, vocabularies, word lists, patterns and table layouts.
"""

SEED = 42

# --- cohorts -------------------------------------------------------------
EARLY_MINUTES = 120.0
LONG_MINUTES = 3000.0
COHORT_OTHER = "Other reviews"
COHORT_EARLY = "Early positive"
COHORT_LONG = "Long-play negative"
COHORTS = [COHORT_OTHER, COHORT_EARLY, COHORT_LONG]
MAX_HELPFUL_VOTES = 50000.0
MIN_PLOTTED_HOURS = 0.01
DENSITY_SAMPLE = 100000
DENSITY_GRID = 200
DENSITY_BIN = 0.001

# --- boolean vocabularies --------------------------------------------------
BOOLEAN_WORDS = {
    "extended": (["true", "1", "1.0", "yes"], ["false", "0", "0.0", "no"]),
    "basic": (["true", "1", "yes"], ["false", "0", "no"]),
    "rating": (
        ["true", "1", "1.0", "yes", "recommended", "positive"],
        ["false", "0", "0.0", "no", "not recommended", "negative"],
    ),
}
MISSING_ID_WORDS = ["", "nan", "none", "<na>"]

# --- completion study --------------------------------------------------------
REVIEWS_PER_ITEM = 1000
LOW_COMPLETION = 25.0
HIGH_COMPLETION = 75.0
TEXT_SAMPLE_LIMIT = 12000
MIN_TEXTS_PER_SIDE = 100
REVIEW_CHAR_LIMIT = 2000
TOP_TERMS = 16
TFIDF_MIN_DOCUMENTS = 10
TFIDF_MAX_SHARE = 0.96
TFIDF_MAX_FEATURES = 7000
# (upper bound in hours, label); a bin holds its lower bound, not its upper one
PLAYTIME_BINS = [
    (5.0, "Under 5 hours"),
    (20.0, "5–20 hours"),
    (100.0, "20–100 hours"),
    (float("inf"), "100+ hours"),
]
COMPLETION_GROUPS = ["Low", "Middle", "High"]

# contraction rules, applied in this order after lowering the text
CONTRACTIONS = [
    (r"\bcan't\b", "cannot"),
    (r"\bwon't\b", "will not"),
    (r"\bit's\b", "it is"),
    (r"\bthat's\b", "that is"),
    (r"\bthere's\b", "there is"),
    (r"\bwhat's\b", "what is"),
    (r"\bi'm\b", "i am"),
    (r"\b([a-z]+)n't\b", "$1 not"),
    (r"\b([a-z]+)'re\b", "$1 are"),
    (r"\b([a-z]+)'ve\b", "$1 have"),
    (r"\b([a-z]+)'ll\b", "$1 will"),
    (r"\b([a-z]+)'d\b", "$1 would"),
    (r"\b([a-z]+)'s\b", "$1"),
]

# theme word lists
POSITIVE_PLAY_SOCIAL = (
    "fun friend friends multiplayer nice good strategy "
    "exciting funny enjoy awesome casual social coop"
).split()
POSITIVE_STORY_ART = (
    "story stories character characters soundtrack favorite "
    "masterpiece beautiful amazing best world lore ending "
    "art music emotional"
).split()
NEGATIVE_PLAY_ACCESS = (
    "try tried trying start started launch loading load "
    "screen crash crashes crashed lag laggy performance "
    "controls tutorial confusing hard difficult boring refund"
).split()
NEGATIVE_SERVICE_COMMUNITY = (
    "server servers mod mods cheater cheaters cheating "
    "hacker hackers toxic update updates dev devs "
    "developer developers ban banned community multiplayer "
    "item items dlc microtransaction microtransactions"
).split()

# stop words added to the general English list
CUSTOM_STOP_WORDS = (
    "game games steam really just like thing things "
    "im ive dont didnt doesnt isnt wasnt werent "
    "cant couldnt wouldnt shouldnt http https www com "
    "eh yo af xd lol lmao sus meh poop gud "
    "goood okay ok yeah yes nope"
).split()

# the English list that ships with Spark's StopWordsRemover, apostrophes removed
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now ill youll hell "
    "shell well theyll id youd hed shed wed theyd im youre hes shes its were "
    "theyre ive weve youve theyve isnt arent wasnt werent havent hasnt hadnt "
    "dont doesnt didnt wont wouldnt shant shouldnt mustnt cant couldnt cannot "
    "could heres hows lets ought thats theres whats whens wheres whos whys "
    "would"
).split()

# --- cluster labels ----------------------------------------------------------
# the words of the item's own title are added to these
LABEL_STOP_WORDS = (
    "game games play played playing really "
    "just like good great time hours steam"
).split()
LABEL_TERMS = 3
LABEL_MIN_DOCUMENTS = 2
LABEL_MAX_SHARE = 0.9
LABEL_MAX_FEATURES = 3000
LABEL_FALLBACK = "mixed reviews"

# --- consensus and critics ----------------------------------------------------
MIN_ITEM_REVIEWS = 30
MIN_CRITIC_REVIEWS = 5
OUTLIER_DELTA = 0.25
TAIL_SIZE = 5
PREVIEW_ROWS = 10
CRITIC_URL = "https://www.metacritic.com/game/%s/critic-reviews/?platform=pc"
CRITIC_COUNT_PATTERN = r"Showing (\d+) Critic Reviews"

# canonical numerals: digit groups 0-9 for units, tens, hundreds and 0-4 for thousands
ROMAN_UNITS = ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]
ROMAN_TENS = ["", "x", "xx", "xxx", "xl", "l", "lx", "lxx", "lxxx", "xc"]
ROMAN_HUNDREDS = ["", "c", "cc", "ccc", "cd", "d", "dc", "dcc", "dccc", "cm"]
ROMAN_THOUSANDS = ["", "m", "mm", "mmm", "mmmm"]
ROMAN_PATTERN = (
    "^(m{0,4})(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
)
ROMAN_MAX = 4999

# --- profiles and search -------------------------------------------------------
SAMPLE_PER_SENTIMENT = 150
MIN_SAMPLE_CHARS = 20
CLUSTERS_PER_SENTIMENT = 4
KMEANS_RESTARTS = 10
KMEANS_ROUNDS = 100
PUBLIC_USERS = 50000
PUBLIC_STATE = 3
CANDIDATE_POOL = 20
AVOID_PENALTY = 0.75
READABLE_CHARS = 90
EXCERPT_CHARS = 420
MIN_RATE = 70.0
RESULTS = 5
SENTIMENTS = ["positive", "negative"]

# name of the default text encoder, for the manifest
MODEL_NAME = "hashed-tfidf"
