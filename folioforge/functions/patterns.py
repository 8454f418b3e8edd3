"""Fixed values of the directory grammar: dash sets, patterns, word lists, thresholds.

They must equal the published rules for right results, so they stand here plainly, together.
The dash sets differ on purpose and are not merged.
"""

# dashes of the grammar: en, em, horizontal bar, figure, hyphen
DASHES = "–—―‒-"
# dash glyphs that comparison makes one hyphen: U+2010 to U+2015 and U+2212
COMPARE_DASHES = "‐‑‒–—―−"

# line tags
THREE_DIGITS = r"[0-9]{3,}"
LEADING_DASH = rf"^\s*[{DASHES}]"
INCOME_IN_LINE = rf"[0-9][0-9 ]*\s*[{DASHES}]\s*[0-9]|\b[0-9]{{3,}}\b"
LETTER = "[A-Za-zÅÄÖåäö]"
AD_TOKENS = (
    r"\b(A\.?\s?T\.?|R\.?\s?T\.?|Riks ?tel|Allm ?tel|Telegrafadress|Telefon|"
    r"Rikstelef|gatan [0-9]|torg [0-9]|Kr\.|KRONOR|PRIS|FRÅN|FRITT|MODERNA|"
    r"Konfektion|Skrädderi|Bankir|Byrå|import|IMPORT|fabrik|Fabrik)\b"
)
BIG_FONT = 1.6
SHORT_LINE = 3

# page quality
CLEAN_INCOME = r"[0-9][0-9 ]*[–—]\s*[0-9]"
DIRTY_INCOME = r"[0-9]{3,}[ \-]+[0-9]{3,}"
SURNAME_AT_START = r"^\s*([A-ZÅÄÖ][A-Za-zÅÄÖåäö:\-]+)\s*,"
BODY_MIN_ENTRIES, BODY_MIN_RATIO = 20, 0.45
TRAINABLE = {"gutter_conf": 0.7, "n_entry": 45, "n_ad": 4, "entry_ratio": 0.6}

# records
DASH_RUN = rf"^\s*([{DASHES}](?:\s*[{DASHES}])*)\s*"
NUMBER_GROUP = r"[0-9][0-9 ]*[0-9]|[0-9]"
NUMBER_1936 = "[0-9][0-9  ]*"
INCOME_1936 = rf"^\s*({NUMBER_1936})?\s*[{DASHES}]\s*({NUMBER_1936})?\s*$"
ONLY_NUMBER_1936 = rf"^\s*{NUMBER_1936}\s*$"
PARISHES = ("A", "Bk", "Bm", "E", "Ee", "G", "H", "Hö", "J", "Jh", "Kh", "Kl", "Kt", "Ma", "Mt", "N", "O", "S", "SG")
COMPANY = r"A\.?\s*[–—-]\s*B\.?"
WIFE = r"(?i)\bhustru\b"
INSTITUTION = r"(?i)stiftelse|fond|kassa|kapital|A\.?\s*[–—-]\s*B\.?|bolag|förening|stipend"
TITLE_FIRST = r"(?i)^(hustru|änkefru|enkefru|fru|fröken|fr\.|d:r|stärbh\.?)$"
CITIES = (
    "Stockholm", "Göteborg", "Falun", "Norrmalm", "Malmö", "Uppsala", "Norrköping", "Gävle", "Örebro", "Helsingborg", "Borås",
    "Eskilstuna", "Jönköping", "Karlstad", "Sundsvall", "Linköping", "Lund", "Halmstad", "Landskrona", "Kalmar", "Västerås",
    "Söderhamn", "Hudiksvall",
)
CITY_BAND = 0.12
BUMP_MAX_CHARS = 24

# consensus
HIGH_AGREEMENT, LOW_AGREEMENT = 0.85, 0.60
CLUSTER_SIM, FUSE_SIM, ALIGN_SIM, SPINE_SIM = 0.80, 0.78, 0.55, 0.62
SPINE_AHEAD, SPINE_BACK = 6, 2
BAND_RADIUS, CORROBORATED = 10, 0.80
ENGINE_NAMES = {
    "paddleocr": "paddle", "paddle": "paddle", "surya_text": "surya", "surya": "surya", "tesseract_swe": "tesseract_swe",
    "tesseract_frak": "tesseract_frak", "tesseract_frakswe": "tesseract_frakswe", "tesseract": "tesseract", "kraken": "kraken",
    "doctr": "doctr", "dots": "dots", "dots.ocr": "dots", "dotsocr": "dots", "olmocr": "olmocr", "olmocr-2-7b": "olmocr",
}
NOT_ENGINES = ("surya_layout", "quality", "split")
SEPARATOR_LINE = r"^=====.*=====\s*$"
MATH_TAG = r"</?math>"
REGION_SUFFIX = r"^(.*?)_([A-Za-z]+[0-9]*|col[LR]|r[0-9]+|region[0-9]+)$"
WHOLE_PAGE_STEM = r"^(SSA_[0-9]+)_(.+)$"

# evaluation
FRONT_MATTER = r"(?s)^\s*---\s*\n.*?\n---\s*\n"
FENCE = r"(?i)^```[a-z]*\s*|\s*```\s*\z"
TAG = r"<[^>]+>"
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
SCORE_WEIGHTS = {"cer": 0.40, "comma_f1": 0.35, "field_count_ratio": 0.25}
MIN_REFERENCE, MIN_COLUMN_TEXT = 40, 80

# assembly
YEARS_IN_HEADER = ("1934", "1935", "1936")
PAGE_NUMBER = r"\b([0-9]{1,4})\b"

# correction
EDGE_MARKS = r"^[\s.,;:()\[\]\"'–—―‒-]+|[\s.,;:()\[\]\"'–—―‒-]+$"
ACCEPT_NED, ACCEPT_GROWTH, ACCEPT_EXTRA, ACCEPT_SHORT = 0.5, 1.5, 8, 6
CHUNK_BYTES, MIN_LETTERS = 110, 6

# images
LAP_NORM, STD_NORM, INK_NORM = 130.0, 28.0, 0.10
FADED = {"laplacian_var": 80.0, "contrast_std": 19.0, "ink_density": 0.055}
GUTTER_OK, GUTTER_WEAK = 0.25, 0.55
