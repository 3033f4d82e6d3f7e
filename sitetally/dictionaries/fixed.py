"""Word lists, lookup tables, patterns and formats that results depend on."""

# Labels of where a listing came from.
SOURCE_1 = "yelp"
SOURCE_2 = "google_places"
SOURCE_EXISTING = "existing"

# Candidate paths of a site.
TARGET_PATHS = (
    "",
    "/appointment",
    "/appointments",
    "/book",
    "/schedule",
    "/forms",
    "/new-patient-forms",
    "/pay",
    "/payment",
    "/patient-portal",
    "/portal",
    "/contact",
)

# Markers of a challenge page.
CHALLENGE_MARKERS = (
    "captcha",
    "are you human",
    "unusual traffic",
    "cloudflare",
    "verify you are a human",
)

# Fixed value: pages worth citing as evidence.
EVIDENCE_PATTERN = r"(patientviewer\.com|operadds\.com|WebForms\.html|/pay|/appointment|/forms?)"

# Patterns that put an external link in a category.
LINK_PATTERNS = {
    "booking": (
        "book", "appointment", "schedule", "calendar",
        "nexhealth", "localmed", "zocdoc", "weave", "solutionreach",
        "recallmax", r"dental4\.me", "curvehero", "yapi",
    ),
    "payment": ("pay", "payment", "billing", "stripe", "square"),
    "forms": ("form", "intake", "jotform", "typeform", "docusign"),
}

# Service hosts and their vendor, first key found in the host decides; None is left out.
VENDOR_MAP = (
    ("nexhealth", "NexHealth"),
    ("zocdoc", "Zocdoc"),
    ("localmed", "LocalMed"),
    ("getweave", "Weave"),
    ("dental4.me", "Flex/Curve Dental"),
    ("patientviewer", "Open Dental"),
    ("swellcx", "Swell"),
    ("carestack", "CareStack"),
    ("ident.ws", "iDent"),
    ("securehealthform", "SecureHealthForm"),
    ("square", "Square"),
    ("carecredit", "CareCredit"),
    ("stripe", "Stripe"),
    ("rectanglehealth", "Rectangle Health"),
    ("jotform", "JotForm"),
    ("typeform", "Typeform"),
    ("gravityforms", "Gravity Forms"),
    ("intakeq", "IntakeQ"),
    ("facebook", None),
    ("twitter", None),
    ("instagram", None),
    ("youtube", None),
)

# Portals whose host tells the software in use.
PORTAL_SOFTWARE = (
    ("dentrixascend", "dentrix"),
    ("patientviewer", "open_dental"),
    ("denticon", "denticon"),
)

# Words in a search snippet that name a software vendor.
SNIPPET_VENDORS = (
    ("open_dental", ("open dental",)),
    ("dentrix", ("dentrix",)),
    ("eaglesoft", ("eaglesoft",)),
    ("curve_dental", ("curve dental", "curvehero")),
    ("denticon", ("denticon",)),
    ("practice_web", ("practice-web", "practiceweb")),
    ("dolphin", ("dolphin",)),
)

# Whole words in a job text that name a software vendor.
JOB_TEXT_VENDORS = (
    ("open_dental", "open dental"),
    ("dentrix", "dentrix"),
    ("eaglesoft", "eaglesoft"),
)

# Alternatives of a job search.
SEARCH_ALTERNATIVES = (
    "Open Dental", "Dentrix", "Eaglesoft", "Curve Dental", "Denticon", "Practice-Web", "Dolphin",
)
