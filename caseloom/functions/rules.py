"""Fixed values of the rule operators: word lists, headings, enumerations. Operators take them as parameters."""

# --- document selection ---------------------------------------------------------------------------------------------

SELECTION_VERSION = "selection_v1"
HIGH_VALUE_TITLES = ("report", "factual", "transcript", "interview", "attachment", "exhibit", "analysis", "summary", "chairman", "maintenance records")
NEGATIVE_TITLES = ("photo", "image", "video", "audio", "gallery", "correspondence", "invoice", "receipt", "cover sheet", "administrative")
SELECTION_RATIONALES = {
    "photo_only": "Rejected because the docket item appears to be photo-only rather than a document PDF.",
    "negative_title": "Rejected because the title matches a known low-value or non-document pattern.",
    "no_pdf": "Rejected because the docket item does not present a clear PDF signal.",
    "low_value": "Rejected because the title does not meet the conservative high-value document rule set.",
    "selected": "Selected because the docket item is a PDF with a high-value investigative document title.",
}

# --- document types -------------------------------------------------------------------------------------------------

CUES = {
    "preliminary_report": ("preliminary report",),
    "materials_report": ("materials laboratory", "materials lab", "metallurgical"),
    "emergency_response_report": ("emergency response", "emergency preparedness"),
    "factual_report": ("factual report",),
    "interview_transcript": ("interview", "transcript"),
    "investigation_report": ("corrected final report", "final accident report", "investigation report", "investigative report", "pipeline accident report"),
    "attachment_appendix": ("appendix", "attachment", "exhibit"),
    "regulatory_report": ("public service commission report", "railroad commission report", "phmsa field report", "phmsa report", "nrc report", "national response center report", "incident notification report", "police report"),
    "external_reference": ("reference material", "reference", "accident report", "incident report", "weather report", "manual", "procedure", "training", "inspection report", "reporting form", "cover letter", "letter", "memo", "email"),
}
REGULATORY_SETS = (("railroad commission", "report"), ("state fire marshal", "report"), ("state fire marshall", "report"), ("governor", "review council", "report"))
ACCIDENT_CONTEXT = ("ntsb", "pipeline", "aviation")
NOT_INVESTIGATION = ("dot accident report",)
INTERVIEW_GUARD = ("reports from", "summary report", "analysis report", "commission report", "agency report", "preliminary report", "factual report")
DOCUMENT_TYPES = (*CUES, "unknown")

# --- primary narrative ----------------------------------------------------------------------------------------------

TYPE_PRECEDENCE = ("investigation_report", "factual_report")

# --- report structure -----------------------------------------------------------------------------------------------

HEADINGS = {
    "ABSTRACT": "abstract",
    "SUMMARY": "summary",
    "SYNOPSIS": "abstract",
    "EXECUTIVE SUMMARY": "executive_summary",
    "WHAT HAPPENED": "what_happened",
    "WHAT WE FOUND": "what_we_found",
    "WHAT WE RECOMMENDED": "what_we_recommended",
    "FACTUAL INFORMATION": "factual_information",
    "HISTORY OF FLIGHT": "factual_information",
    "PERSONNEL INFORMATION": "factual_information",
    "AIRCRAFT INFORMATION": "factual_information",
    "METEOROLOGICAL INFORMATION": "factual_information",
    "AIRPORT INFORMATION": "factual_information",
    "AERODROME INFORMATION": "factual_information",
    "FLIGHT RECORDERS": "factual_information",
    "WRECKAGE AND IMPACT INFORMATION": "factual_information",
    "MEDICAL AND PATHOLOGICAL INFORMATION": "factual_information",
    "FIRE": "factual_information",
    "SURVIVAL ASPECTS": "factual_information",
    "TESTS AND RESEARCH": "factual_information",
    "ORGANIZATIONAL AND MANAGEMENT INFORMATION": "factual_information",
    "ADDITIONAL INFORMATION": "factual_information",
    "ANALYSIS": "analysis",
    "CONCLUSIONS": "conclusions",
    "FINDINGS": "findings",
    "PROBABLE CAUSE": "probable_cause",
    "PROBABLE CAUSE AND FINDINGS": "probable_cause",
    "SAFETY RECOMMENDATIONS": "recommendations",
    "RECOMMENDATIONS": "recommendations",
    "LESSONS LEARNED": "lessons_learned",
    "NEW RECOMMENDATIONS": "recommendations",
    "PREVIOUSLY ISSUED RECOMMENDATIONS": "recommendations",
    "PREVIOUSLY ISSUED SAFETY RECOMMENDATIONS": "recommendations",
    "PREVIOUSLY ISSUED RECOMMENDATION REITERATED IN THIS REPORT": "recommendations",
    "PREVIOUSLY ISSUED RECOMMENDATIONS REITERATED IN THIS REPORT": "recommendations",
}
SECTION_ORDER = ("abstract", "summary", "executive_summary", "what_happened", "what_we_found", "what_we_recommended", "factual_information", "analysis", "conclusions", "findings", "probable_cause", "recommendations", "lessons_learned")
STOP_HEADINGS = ("BY THE NATIONAL TRANSPORTATION SAFETY BOARD", "APPENDIX", "APPENDIXES", "REFERENCES")
STOP_PREFIXES = ("APPENDIX ", "APPENDIXES ")
CAUSE_STOPS = (
    "FOR MORE DETAILS ABOUT THIS ACCIDENT",
    "THE NTSB HAS AUTHORITY TO INVESTIGATE",
    "THE NTSB IS AN INDEPENDENT FEDERAL AGENCY",
    "THE NATIONAL TRANSPORTATION SAFETY BOARD NTSB IS AN INDEPENDENT FEDERAL AGENCY",
)
NOISE_PATTERNS = (
    r"^(?:PAGE\s+)?\(?\d+\)?$",
    r"^CORRECTED\s+COPY$",
    r"^(?:NTSB\s+)?(?:PIPELINE|AVIATION|HIGHWAY|RAILROAD|MARINE)\s+(?:ACCIDENT|INVESTIGATION)\s+REPORT(?:\s+REPORT\s+NUMBER\s+[A-Z0-9./_-]+)?(?:\s+\d+)?$",
)
REPORT_ID = r"^(?:PAB|PAR|PIR|PSR)\d{4,5}$"

# --- atomic claims --------------------------------------------------------------------------------------------------

STATUSES = ("ok", "unprocessable")
ASSERTION_MODES = ("stated", "observed", "concluded", "recommended")
POLARITIES = ("affirmed", "negated", "uncertain")
CLAIM_TYPES = ("statement", "observation", "finding", "conclusion", "recommendation")
CANDIDATE_TYPES = ("entities", "events", "conditions", "causal_factors")
CAUSAL_MARKERS = ("because", "caused", "causes", "cause", "due to", "led to", "resulted in", "contributed to", "as a result", "probable cause")
