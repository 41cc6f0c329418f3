"""Rule sets as data. Those under 'fixed values' must read as the source system's do for equal results."""

from __future__ import annotations

# Topic tags and the substrings that set them.
TOPIC_RULES = {
    "housing": ["housing", "homekey", "multifamily", "supportive housing", "homelessness", "tenant"],
    "homelessness": ["homeless", "homelessness", "outreach", "coordinated entry", "interim housing"],
    "public_safety": ["fire", "security", "sheriff", "crime", "probation", "public safety"],
    "probation": ["probation", "halls", "camps"],
    "jails": ["jail", "incarcerated", "cremation"],
    "behavioral_health": ["mental health", "behavioral health", "health"],
    "governance": ["agreement", "authority", "delegated authority", "policy", "equity framework", "oversight"],
    "contracting": ["contract", "sole source", "agreement", "amendment", "master agreements"],
    "budget": ["budget", "fund", "appropriation", "measure ula"],
    "labor": ["workers", "compensation"],
    "data_systems": ["systems", "system", "maintenance", "engineering", "data integration", "dashboard", "hmis", "coordinated entry"],
}

# Why a topic matters.
TOPIC_EXPLANATIONS = {
    "behavioral_health": "it touches behavioral-health services or delivery capacity",
    "budget": "it affects spending plans, revenues, or fiscal commitments",
    "contracting": "it changes vendor relationships or procurement commitments",
    "data_systems": "it affects infrastructure, operations, or technical systems",
    "governance": "it changes oversight, authority, or formal operating rules",
    "homelessness": "it affects homelessness-response policy or service delivery",
    "housing": "it affects housing supply, siting, or supportive housing delivery",
    "jails": "it touches jail operations, detention conditions, or custodial services",
    "labor": "it may affect workforce conditions or staffing",
    "probation": "it affects probation operations or youth justice systems",
    "public_safety": "it affects emergency response, law enforcement, or public safety operations",
}

# Scoring lists and sentences.
HIGH_PRIORITY_TOPICS = ["behavioral_health", "homelessness", "housing", "probation", "public_safety"]
HIGH_PRIORITY_KEYWORDS = ["amendment", "approve", "award", "budget", "contract", "expenditure plan", "master agreement", "retroactive", "sole source", "special parcel tax"]
ACTION_RULES = [("sole source", "sole_source_contract"), ("amendment", "contract_amendment"), ("extend", "contract_amendment"), ("award", "contract_award"), ("adopt", "policy_adoption"), ("approve", "board_approval"), ("approval", "board_approval")]
CONTRACT_ACTIONS = ["contract_amendment", "contract_award", "sole_source_contract"]
DECISION_ACTIONS = ["board_approval", "contract_award", "policy_adoption"]
TREND_KEYWORDS = ["retroactive", "extend", "master agreement", "on-call", "sole source"]
NO_EXPLANATION = "This matters because it could signal an operational or policy decision that merits follow-up."
PRIORITY_SENTENCES = {
    "high": " It likely deserves closer review in the next digest.",
    "medium": " It is worth monitoring as part of the current agenda batch.",
    "low": " It can stay in the routine monitoring queue unless related items accumulate.",
}
DIGEST_TOPICS = ["housing", "homelessness", "probation", "public_safety", "behavioral_health"]

# Path screening.
CANCELLATION_TOKENS = ["cancelled", "canceled", "notice-of-cancellation"]
SUPPORTING_PARTS = ["supporting_docs", "supporting-docs"]
PAGE_PARSER, PAGE_NAME_TOKEN = "la_city_primegov_html", "_html-"
NON_ITEM_PARSERS = ["lacounty_govdelivery_email"]

# Roles of supporting documents, the first that fits the lowered text; a pattern is a regular expression.
DOCUMENT_ROLES = [
    (r"statement of proceedings|\b(minutes|draft minutes)\b", "minutes"),
    (r"\b(slide deck|presentation)\b", "presentation"),
    (r"\b(bylaws|charter|membership slate|meeting dates)\b", "governance_doc"),
    (r"board letter", "board_letter"),
    (r"resolution", "resolution"),
    (r"\b(agreement|amendment)\b", "agreement"),
    (r"motion", "motion"),
    (r"\b(report|spending plan|strategic plan|workplan|work plan|metrics|dashboard)\b", "report"),
]
ROLE_OF_PATH, ROLE_OF_REST = "supporting_document", "attachment"

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

#: Rules of our own over words that occur in the driver's invented prose.
DEMO_RULES = {
    "contact": ["@"],
    "licence": ["license", "copyright"],
    "origin": ["from", "desde"],
    "company": ["with", "avec", "mit "],
    "reference": ["this", "that"],
    "article": ["the ", "der ", "les "],
}
DEMO_HIGH = ["contact", "licence", "origin"]
