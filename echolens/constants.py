"""Fixed values of the comment data model.

These lists are part of the result contract: labels, tiers, word lists and
display names must keep exactly these values for reports to be comparable
between runs.
"""

from __future__ import annotations

# --- sentiment labels and methods ------------------------------------------
POSITIVE = "positif"
NEGATIVE = "negatif"
NEUTRAL = "netral"
UNCLASSIFIED = "tidak_terklasifikasi"
CLASSIFIED = (POSITIVE, NEGATIVE, NEUTRAL)
LABELS = CLASSIFIED + (UNCLASSIFIED,)

METHODS = ("model", "model_failed", "llm", "llm_failed", "lexicon")

# Raw class names of the base classifier.
MODEL_LABELS = {"label_0": POSITIVE, "label_1": NEUTRAL, "label_2": NEGATIVE}

# --- account tiers, in priority order --------------------------------------
TIERS = ("kol", "official", "affiliate", "unknown")
TIER_KEYWORDS = {"kol": "kol", "official": "official", "affiliate": "affiliate"}
TIER_TITLES = {
    "kol": "KOL",
    "official": "Official",
    "affiliate": "Affiliate",
    "unknown": "Tidak diketahui",
}
# The overview table names the last tier differently from the deep dive.
TIER_OVERVIEW_TITLES = {**TIER_TITLES, "unknown": "Unknown"}
DEFAULT_ACCOUNT_TYPE = "unknown"
DEFAULT_QUOTA = (50, 30, 20)
SECONDS_PER_VIDEO = 123

# --- exclusion reasons ------------------------------------------------------
REASON_UPLOADER = "video_uploader"
REASON_INTERNAL = "internal_account"
REASON_UNKNOWN_TEXT = "belum dikecualikan - cek manual"

# --- collection caps --------------------------------------------------------
MAX_COMMENTS = 200
MAX_REPLIES = 5
MAX_PAGES = 40
MAX_REPLY_PAGES = 5
VIDEO_SITE = "https://www.tiktok.com"

# --- report thresholds ------------------------------------------------------
MIN_MONTH_VOLUME = 20
MIN_VIDEO_COMMENTS = 30
MIN_KEYWORD_DOCS = 15
KEYWORD_MIN_LENGTH = 3
KEYWORDS_PER_GROUP = 12
TOP_COMMENTS_PER_LABEL = 8
LEADERBOARD_SIZE = 8
EXPLORER_ROWS = 150
TIER_EXAMPLES = 5
TIER_EXAMPLES_SHORT = 3
TOP_WORDS_PER_TIER = 15
TOP_PAIRS_PER_TIER = 8
MIN_PAIR_COUNT = 2
QUOTES_PER_LABEL = 5
TOP_ACCOUNTS = 20
ESCALATION_FAILURE_LIMIT = 0.10
NEUTRAL_BAND = 0.15
ACCURACY_TARGET = 0.80
THRESHOLDS = (0.50, 0.60, 0.70, 0.80, 0.90, 0.95, 0.99)
MIN_NARRATIVE_VOLUME = 30

MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "Mei", "Jun",
    "Jul", "Agu", "Sep", "Okt", "Nov", "Des",
)
# Lower-case month tokens that mark "Agu 26"-style dates in prose.
MONTH_TOKENS = (
    "jan", "feb", "mar", "apr", "mei", "jun", "jul",
    "agu", "ags", "sep", "okt", "nov", "des",
)

# --- word lists --------------------------------------------------------------
NEGATIONS = ("tidak", "bukan", "belum", "jangan")

DEFAULT_STOPWORDS = (
    "yang", "dan", "di", "ke", "dari", "untuk", "dengan", "itu", "ini",
    "ada", "saya", "kamu", "kita", "juga", "aja", "saja", "lah", "sih",
    "nya", "atau", "karena", "jadi", "lagi", "bisa", "kalau", "pada",
)

SLANG = {
    "gak": "tidak", "ga": "tidak", "gk": "tidak", "ngga": "tidak",
    "nggak": "tidak", "kaga": "tidak", "tdk": "tidak",
    "bgt": "banget", "bngt": "banget",
    "yg": "yang", "dgn": "dengan", "dr": "dari", "utk": "untuk",
    "krn": "karena", "karna": "karena", "sm": "sama",
    "tp": "tapi", "jd": "jadi", "jgn": "jangan", "udh": "sudah",
    "udah": "sudah", "sdh": "sudah", "blm": "belum", "blum": "belum",
    "gmn": "bagaimana", "gimana": "bagaimana", "knp": "kenapa",
    "org": "orang", "skrg": "sekarang", "sy": "saya", "gw": "saya",
    "gue": "saya", "aq": "saya", "ak": "saya",
}

LEXICON = {
    "bagus": 0.8, "baguus": 0.8, "mantap": 0.9, "keren": 0.8, "suka": 0.7,
    "senang": 0.7, "senangnya": 0.7, "puas": 0.6, "recommended": 0.7,
    "cocok": 0.6, "membantu": 0.7, "sembuh": 0.8, "aman": 0.5, "terbaik": 0.9,
    "jelek": -0.8, "buruk": -0.8, "parah": -0.7, "kecewa": -0.8,
    "mahal": -0.5, "lambat": -0.5, "gagal": -0.7, "rusak": -0.7,
    "bohong": -0.8, "penipu": -0.9, "palsu": -0.7, "nyesel": -0.7,
    "sakit": -0.4, "alergi": -0.5, "ruam": -0.5,
}

# theme -> words, in declared order
THEMES = {
    "dosage_usage": ("minum", "sendok", "botol", "campur", "konsumsi"),
    "price_availability": ("harga", "beli", "order", "cod"),
    "age_eligibility": ("umur", "usia", "tahun", "bulan", "bb", "tinggi", "stunting"),
    "safety_side_effects": ("efek", "samping", "alergi", "aman", "reaksi"),
    "result_complaints": ("hasil", "ngefek", "naik", "turun"),
    "counterfeit_authenticity": ("asli", "palsu", "ori", "tiru"),
}
THEME_TITLES = {
    "dosage_usage": "Dosis & cara pakai",
    "price_availability": "Harga & tempat beli",
    "age_eligibility": "Usia & kelayakan",
    "safety_side_effects": "Efek samping & keamanan",
    "result_complaints": "Hasil tidak terasa / tidak ngefek",
    "counterfeit_authenticity": "Keaslian & barang palsu",
}

CAUSAL_CONNECTORS = (
    "karena", "disebabkan", "menyebabkan", "sebab", "dikarenakan",
    "menunjukkan bahwa", "sehingga", "akibatnya", "akibat dari", "berdampak",
)

# --- patterns ----------------------------------------------------------------
# Unicode whitespace and word characters spelled out, so that the meaning does
# not depend on a regex dialect's idea of \s and \w.
SPACE = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
NON_SPACE = r"[^\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
URL_PATTERN = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
MENTION_PATTERN = rf"@{WORD}+"
TOKEN_PATTERN = r"[a-z0-9']+"
EMOJI_PATTERN = (
    r"[\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1F6FF}"
    r"\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"
)
VIDEO_ID_PATTERN = r"(?:/(?:video|photo)/|^)(\d{6,})"
SHORT_LINK_PATTERN = rf"(?i)^https?://(?:vt|vm)\.tiktok\.com/{NON_SPACE}+$"
FORMULA_PATTERN = r"^[=+\-@]"
NUMBER_PATTERN = r"[+-]?[0-9][0-9.,]*[0-9]|[+-]?[0-9]+"
