"""Limits, word lists and formats that results must agree on."""

# Store
TTL_DAYS = 30
DEFAULT_SOURCE_TYPE = "web"
LATEST_ENTRIES = 3
PROBLEMS_PER_LOOKUP = 5
MISSING = "N/A"
NEVER = "never"
UNKNOWN_SUBJECT = "?"

# Extraction
DECK_EXTENSIONS = [".ppt", ".pptx", ".pps", ".ppsx", ".odp"]
MIN_CHUNKS = 4
MAX_PAGES_PER_CHUNK = 20
RENDER_DPI = 150
MAX_ATTEMPTS = 3
SECONDS_PER_PAGE = 30
MIN_SECONDS = 180
MAX_SECONDS = 900
MAX_SPLIT_DEPTH = 3
RATE_LIMIT_MARKERS = [
    "429",
    "rate limit",
    "quota",
    "resource_exhausted",
    "resource exhausted",
    "too many requests",
]
ERROR_CHARS = 400

# A section of a response: heading line with a bare number, then everything up to the next numbered heading. The lenient
# form takes any white space around the heading, the strict one wants a line of its own.
SECTION = {
    "compat": r"(?Us)##\s+[Ss]lide\s+(\d+)\s*\n(.*?)(?=\n##\s+[Ss]lide\s+\d+|\z)",
    "strict": (
        r"(?s)(?:\A|(?<=\n))##[ \t]+[Ss]lide[ \t]+(\d+)[ \t]*(?:\n|\z)"
        r"(.*?)(?=(?:(?<=\n)|\n)##[ \t]+[Ss]lide[ \t]+\d+[ \t]*(?:\n|\z)|\z)"
    ),
}

# Texts of a deck's index; {…} are filled
INDEX_HEAD = [
    "# Extracted: {deck}", "- Total pages: {total}", "- Extracted range: {start} to {end}", "- DPI: {dpi}",
    "- Slides extracted: {extracted}", "", "## Slide Index",
]

# Unicode white space (the characters a Unicode-aware strip removes)
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Prompt formats ({numbers}, {count}, {files} are filled per chunk)
EXTRACTION_RULES = (
    "For each slide output a section with '## Slide N' (N = slide number) "
    "followed by ALL text verbatim, diagram descriptions, and formulas. "
    "Output sections for slides: {numbers}. Do not skip or merge any slide."
)
INLINE_PROMPT = "These are {count} lecture slides (slides {numbers}): {files} "
LISTED_PROMPT = "Read the following image files in order — they are academic lecture slides:\n{files}\n\n"
PLACEHOLDER = (
    "[Extracted as part of batch with slides {first}-{last}. "
    "See slide {first} for full batch text if parsing failed.]"
)

# Curriculum
TIERS = {"🔴": "CRITICAL", "🟠": "HIGH", "🟡": "MEDIUM", "🟢": "LOW"}
TIER_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
ADVANCED_ORDER = ["Very High", "High", "Medium", "Low"]
WANTED_PROBLEMS = 5
TOP_TOPICS = 3
SAMPLE_PAGES = 5
CONCEPTS_PER_CHECKPOINT = 3
DIAGNOSTIC_QUESTIONS = 3
REVISION_WEEKS = 2
WEEKS_PER_MONTH = 4
QUIZ_SLOTS = [
    ("Easy", "JEE Mains 2023-style MCQ"),
    ("Medium", "Numerical Answer Type"),
    ("Hard", "JEE Advanced MRQ — one or more correct"),
    ("Medium", "Conceptual MCQ"),
    ("Hard", "Paragraph-based"),
]
SOURCE_ORDER = ["ncert.nic.in", "khanacademy.org", "physicswallah.live", "brilliant.org"]
SEARCH_TEMPLATES = [
    "{topic} JEE Mains explained site:ncert.nic.in OR site:khanacademy.org",
    "{topic} IIT JEE concepts and solved problems",
    "{topic} JEE Advanced previous year questions",
]
PROBLEM_SEARCH_TEMPLATES = [
    "{topic} JEE Mains previous year questions solved",
    "{topic} JEE Advanced questions with solutions",
]
INCLUDE_TERMS = [
    "definition", "definitions", "algorithm", "algorithms", "theorem", "theorems", "proof", "proofs",
    "example", "examples", "complexity", "implementation",
]
SKIP_TERMS = [
    "logistics", "admin", "grading", "rubric", "rubrics", "schedule", "schedules", "office", "history",
    "biography", "biographies", "syllabus", "motivation", "bibliography", "references",
]
COMMON_ABBREVIATIONS = ["CPU", "URL", "PDF"]
