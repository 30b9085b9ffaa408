"""Values that results depend on.  Data only; the rules that use them are elsewhere."""

# ---------------------------------------------------------------------------
# Must stay as they are for results to be right.
# ---------------------------------------------------------------------------

NOT_SPECIFIED = "not specified"
PLACEHOLDERS = ["N/A", "Unknown", ""]
CLEANED_PLACEHOLDERS = ["n/a", "na", "unknown", ""]

VALID_STATUSES = ["Bachelor", "Master", "PhD", "Postdoctoral researchers", "Faculty"]

REQUIRED_LEVEL = {
    "bachelor": "high school diploma",
    "master": "bachelor",
    "phd": "master",
    "postdoctoral researchers": "phd",
}

LEVEL_PATTERNS = [
    (r"^master('?s)?$", "master"),
    (r"^bachelor('?s)?$", "bachelor"),
    (r"^ph\.?d'?s?$", "phd"),
    (r"^postdoctoral", "postdoctoral researchers"),
    (r"^faculty", "faculty"),
]

DEGREES = ["bachelor", "master", "phd", "postdoctoral researchers", "faculty"]
LANGUAGE_LEVELS = ["beginner", "intermediate", "advanced"]
LANGUAGE_RANK = {"beginner": 1, "intermediate": 2, "advanced": 3}

EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@(gmail|hotmail|example)\.(com|org|net|edu)$"
COUNTRY_PATTERN = r"^[A-Za-z\s]+$"
DECIMAL_PATTERN = r"([0-9]+(?:\.[0-9]+)?)"
DIGITS_PATTERN = r"([0-9.]+)"
AGE_RANGE = (18, 100)

PROGRAM_COUNTRY = "germany"
PROGRAM_INTAKE = "fall"
SOURCE_SUFFIX_PATTERN = r"\s*•\s*DAAD$"

DATE_FORMAT = "dd/MM/yyyy"
DATE_TIME_FORMAT = "dd/MM/yyyy HH:mm"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Headings and stop headings of the free-text sections.
DESCRIPTION_HEADINGS = ["programme description", "program description"]
DESCRIPTION_STOPS = [
    "target group", "academic requirements", "duration", "number of",
    "scholarship value", "application papers", "application deadline",
]
OBJECTIVE_HEADINGS = ["objective"]
OBJECTIVE_STOPS = [
    r"who can apply\?", r"what can be funded\?", "duration of the funding", "value", "selection",
]
VALUE_HEADINGS = [r"scholarship\s+value", "value"]
VALUE_STOPS = [
    "selection", "further information", "to allow you", "please note", "application papers",
]
FUNDED_HEADINGS = [r"what can be funded\?"]
FUNDED_STOPS = ["duration of the funding", "who can apply", "duration"]
DEADLINE_HEADINGS = ["application deadline", "deadline"]
DEADLINE_PROCEDURE_STOPS = ["application documents", "application location", "please note"]
DEADLINE_OVERVIEW_STOPS = [
    "application papers", "application requirements", "scholarship value", "duration",
]
REQUIREMENT_HEADINGS = ["academic requirements"]
REQUIREMENT_STOPS = [
    "number of", "duration", "scholarship value", "application papers", "application deadline",
]
DURATION_HEADINGS = ["duration"]
DURATION_STOPS = [
    "scholarship value", "number of scholarships", "application papers", "application deadline",
]
FUNDING_DURATION_HEADINGS = ["duration of the funding"]
FUNDING_DURATION_STOPS = ["value", "scholarship value", "selection", "further information"]
DOCUMENT_HEADINGS = ["application documents", "documents", "required documents"]
DOCUMENT_STOPS = ["application location", "application deadline", "please note"]
PAPER_HEADINGS = ["application papers"]
PAPER_STOPS = ["application deadline", "number of", "duration", "scholarship value"]

# Websites.
URL_DOMAINS = [
    r"daad\.de", r"study-in-germany\.de", r"(?:bafög|bafoeg)\.de", r"uni-[\w-]+\.de",
    r"tu-[\w-]+\.de", r"fh-[\w-]+\.de", r"studienstiftung\.de", r"funding-guide\.de",
    r"research-in-germany\.org",
]
URL_EXTENSIONS = r"html?|php|aspx?|jsp|pdf|doc|docx|txt"
URL_NOISE = r"(?<=/)[^/]*(?:Further|extrainfo\.A)(?=[.,;)\s]|$)"
URL_TRAILING = r"""[.,;:"')}\]]+$"""
URL_KEEP = r"(?:extrainfo|en)(?:\.|/|$)"
URL_SPECIAL_WORDS = ["bafög", "bafoeg"]
URL_SPECIAL_DEFAULT = "https://www.bafög.de"

GROUP_KEYS = [
    "scholarship_name", "description", "program_country", "funding_info", "program_level",
    "required_level", "deadline", "intake", "exams", "fields_of_study", "duration",
    "documents", "website", "instructions",
]
EMBEDDING_FIELDS = [
    "scholarship_name", "description", "program_country", "origin_country", "program_level",
    "required_level", "fields_of_study_code", "funding_category", "status",
]

FIELDS_OF_STUDY = {
    "00": "Generic programmes and qualifications",
    "01": "Education",
    "02": "Arts and humanities",
    "03": "Social sciences, journalism and information",
    "04": "Business, administration and law",
    "05": "Natural sciences, mathematics and statistics",
    "06": "Information and Communication Technologies (ICTs)",
    "07": "Engineering, manufacturing and construction",
    "08": "Agriculture, forestry, fisheries and veterinary",
    "09": "Health and welfare",
    "10": "Services",
}
ALLOWED = {
    "funding_category": ["fully funded", "partially funded", "not specified"],
    "program_level": ["bachelor", "master", "phd", "postdoctoral researchers", "faculty"],
    "required_level": [
        "high school diploma", "bachelor", "master", "phd", "postdoctoral researchers", "faculty",
    ],
    "intake": ["spring", "fall", "not specified"],
    "status": ["open", "closed", "not specified"],
}

# Click stream and recommendations.
TOPICS = ["search_events", "filter_events", "details_events", "faq_events"]
SAVE_TOPIC = "details_events"
SAVE_ELEMENT = "save button"
ITEM_LABEL = "Scholarship ID:"
CACHE_PREFIX = "recommendations"
GENERAL_USER = "general"
CACHE_TTL_SECONDS = 3600
TOP_ITEMS = 5
TOP_PEOPLE = 6

# Person graph.
EDGE_WEIGHTS = {
    "HAS_SKILL": 2, "HAS_DEGREE": 3, "HAS_CERTIFICATION": 2, "HAS_HONOR": 1,
    "WORKED_AT": 3, "SPEAKS": 2, "LIVES_IN": 1,
}
SIMILARITY_EDGES = [
    "HAS_SKILL", "SPEAKS", "HAS_DEGREE", "HAS_CERTIFICATION", "HAS_HONOR", "WORKED_AT",
]
WALK_LENGTH = 80
WALKS_PER_NODE = 15
WALK_DIMENSION = 128

# Page parsing: tag and classes of a catalogue's items, of the title and the link in them.
CATALOGUE_ITEM = ("div", "ecl-content-item-block__item contextual-region ecl-u-mb-l ecl-col-12")
CATALOGUE_TITLE = ("span", "ecl-link__label")
CATALOGUE_LINK = ("a", "ecl-link ecl-link--standalone ecl-link--icon")
BLOCK_TAGS = ["h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "div", "ul", "ol"]
