"""Ordered rules of levels, roles and screens. The first rule that fits decides, unless said otherwise."""

ENTRY, JUNIOR, MID, SENIOR, LEAD, PRINCIPAL, UNKNOWN = "entry level", "junior", "mid", "senior", "lead", "principal", "unknown"
LEVELS = (ENTRY, JUNIOR, MID, SENIOR, LEAD, PRINCIPAL)
LEVEL_SYNONYMS = {
    "entry": ENTRY, "entry level": ENTRY, "entry-level": ENTRY, "intern": ENTRY, "internship": ENTRY, "graduate": ENTRY, "trainee": ENTRY, "learnership": ENTRY, "apprentice": ENTRY,
    "junior": JUNIOR, "jnr": JUNIOR, "jr": JUNIOR,
    "mid": MID, "mid level": MID, "mid-level": MID, "intermediate": MID,
    "senior": SENIOR, "snr": SENIOR, "sr": SENIOR,
    "lead": LEAD, "team lead": LEAD, "staff": LEAD,
    "principal": PRINCIPAL,
}
#: From the lowest rung up, so that the first that fits is also the lowest.
TITLE_LEVELS = (
    (ENTRY, r"\b(graduate|grad|trainee|intern|internship|learner|learnership|apprentice|cadet|bursary|entry[\s\-]?level|no experience)\b"),
    (JUNIOR, r"\b(junior|jnr\.?|jr\.?)\b"),
    (MID, r"\b(mid[\s\-]?level|intermediate)\b"),
    (SENIOR, r"\b(senior|snr\.?|sr\.?|architect)\b"),
    (LEAD, r"\b(lead|leader|staff|head of|manager|supervisor|vp|vice president|director)\b"),
    (PRINCIPAL, r"\b(principal|chief)\b"),
)
_NOUN = r"(?:developer|engineer|analyst|role|position|consultant|technician|administrator|specialist|programmer|tester|designer|support|opportunity)"
DESCRIPTION_LEVELS = (
    (ENTRY, rf"\b(?:graduate programme|graduate program|learnership|internship|no prior experience|no previous experience|entry[\s\-]level\s+{_NOUN}|graduate\s+{_NOUN}|trainee\s+{_NOUN})\b"),
    (JUNIOR, rf"\bjunior\s+{_NOUN}\b"),
    (MID, rf"\b(?:mid[\s\-]?level|intermediate)\s+{_NOUN}\b"),
    (SENIOR, rf"\bsenior\s+{_NOUN}\b"),
    (LEAD, rf"\b(?:lead|principal)\s+{_NOUN}\b"),
)
#: Years up to which a level reaches; above the last, lead.
YEARS_LEVELS = ((0, ENTRY), (2, JUNIOR), (4, MID), (7, SENIOR))

SOFTWARE, SUPPORT, DEVOPS, QA = "Software development", "Technical Support", "DevOps/Cloud", "QA/Testing"
ANALYSIS, MOBILE, SECURITY, DATA = "Business Analysis & Low-code (Power Platform)", "Mobile", "Security", "Data & BI"
ROLES = (SOFTWARE, SUPPORT, DEVOPS, QA, ANALYSIS, MOBILE, SECURITY, DATA)
TITLE_ROLES = (
    (SECURITY, r"\b(cyber\s?security|information security|infosec|security analyst|security engineer|security specialist|soc analyst|soc\b|penetration test|pen test|vulnerability|threat|siem|security operations)\b"),
    (QA, r"\b(qa\b|q\.a\.|quality assurance|software tester|test analyst|test engineer|automation tester|test automation|testing analyst|quality engineer|sdet)\b"),
    (MOBILE, r"\b(flutter|react native|android developer|ios developer|mobile developer|mobile engineer|mobile application developer|app developer)\b"),
    (DEVOPS, r"\b(devops|dev ops|site reliability|sre\b|cloud engineer|cloud architect|cloud administrator|platform engineer|infrastructure engineer|kubernetes|azure engineer|aws engineer|cloud support)\b"),
    (ANALYSIS, r"\b(business analyst|systems analyst|solutions analyst|business systems analyst|power platform|power apps|power automate|power bi|dynamics 365|d365|sharepoint|business intelligence|low.?code|process analyst)\b"),
    (DATA, r"\b(data (?:analyst|engineer|scientist)|analytics (?:analyst|engineer|developer)|reporting analyst|etl developer|data warehouse|machine learning engineer|ml engineer)\b"),
    (SUPPORT, r"\b(it support|service desk|help ?desk|desktop support|technical support|support technician|support analyst|support engineer|support consultant|incident management|customer success|end user support|field technician|it technician|application support|first line|second line|1st line|2nd line)\b"),
    (SOFTWARE, r"\b(software developer|software engineer|developer|programmer|full[\s\-]?stack|front[\s\-]?end|back[\s\-]?end|web developer|software development|\.net|c#|java|python|php|javascript|typescript|react|angular|vue|node|application developer|integration developer|systems developer)\b"),
)
DESCRIPTION_ROLES = (
    (SECURITY, r"\b(cyber\s?security (?:analyst|engineer|specialist)|information security (?:analyst|officer|specialist)|soc analyst|penetration tester)\b"),
    (QA, r"\b(quality assurance (?:engineer|analyst|specialist)|software tester|test analyst|test engineer|automation tester|sdet)\b"),
    (MOBILE, r"\b(mobile (?:developer|engineer)|android developer|ios developer|mobile application developer)\b"),
    (DEVOPS, r"\b(devops engineer|site reliability engineer|cloud engineer|cloud architect|platform engineer|infrastructure engineer)\b"),
    (ANALYSIS, r"\b(business analyst|systems analyst|solutions analyst|business systems analyst|business intelligence developer|process analyst)\b"),
    (SUPPORT, r"\b(it support (?:technician|analyst|engineer|specialist)|service desk (?:analyst|engineer|technician)|help ?desk (?:analyst|technician)|desktop support technician|technical support (?:engineer|analyst|specialist))\b"),
    (DATA, r"\b(data (?:analyst|engineer|scientist)|analytics engineer|reporting analyst|etl developer)\b"),
    (SOFTWARE, r"\b(software developer|software engineer|full[\s\-]?stack (?:developer|engineer)|front[\s\-]?end (?:developer|engineer)|back[\s\-]?end (?:developer|engineer)|web developer|application developer|systems developer|integration developer)\b"),
)
DESCRIPTION_ROLE_CHARS = 1500

PUBLISHED_ROLES, PUBLISHED_LEVELS = (SOFTWARE, MOBILE, QA, ANALYSIS, DATA), (ENTRY, JUNIOR, MID, UNKNOWN)
STAGE_NON_TECH, STAGE_OFF_TRACK, STAGE_ABOVE = "F1 non-tech", "scope off track", "F4 above cohort"
TIER_APPLY, TIER_STRETCH = "apply", "stretch"
YEARS_TOO_MANY, YEARS_TO_APPLY = 4, 2
SENIOR_TITLE = r"\b(senior|snr\.?|sr\.?|lead|principal|head of|chief|manager|architect)\b"
#: Found at a word's start; the end is open.
ACCEPTED = (
    ("developer", r"developer|programmer|software development|software dev"),
    ("tech_engineer", r"(?:software|backend|back[\s\-]?end|frontend|front[\s\-]?end|full[\s\-]?stack|web|mobile|application|apps?|data|devops|dev ops|cloud|platform|infrastructure|site reliability|qa|quality|test|automation|security|network|systems?|solutions?|integration|machine learning|ai|firmware|embedded)[\s\-/]*engineer"),
    ("tech_analyst", r"(?:business|systems?|solutions?|data|test|qa|quality|security|soc|information security|cyber|bi|business intelligence)[\s\-/]*analyst"),
    ("support", r"it support|technical support|service desk|help ?desk|desktop support|application support|end user support|incident management|customer success|support (?:technician|analyst|engineer|specialist|consultant|agent)"),
    ("qa_testing", r"qa\b|quality assurance|software tester|tester|test analyst|test automation|sdet"),
    ("cloud_devops", r"devops|dev ops|sre\b|site reliability|kubernetes|platform engineer|cloud (?:engineer|architect|administrator|specialist|support)"),
    ("data", r"data (?:scientist|engineer|analyst)|machine learning|ml engineer"),
    ("tech_admin", r"(?:systems?|network|database|linux|windows|server|cloud)[\s\-]*(?:administrator|admin)|dba\b|sysadmin"),
    ("tech_architect", r"(?:software|solutions?|technical|cloud|data|systems?|enterprise|application|security)[\s\-]*architect"),
    ("low_code", r"power (?:platform|apps|automate|bi)|dynamics 365|d365|sharepoint|low[\s\-]?code"),
    ("security", r"cyber ?security|information security|infosec|soc analyst|penetration test\w*|ethical hack\w*|security (?:analyst|engineer|specialist|consultant|administrator)"),
    ("mobile", r"(?:mobile|android|ios|flutter|react native)[\s\-]*(?:developer|engineer|programmer)"),
    ("it_generic", r"it (?:technician|specialist|consultant|intern|graduate|professional)|information technology"),
)
BLOCKED = (
    r"mining engineer", r"civil engineer", r"structural engineer", r"mechanical engineer", r"electrical engineer", r"chemical engineer", r"industrial engineer", r"mechatronic\w* engineer", r"process engineer", r"production engineer", r"maintenance engineer", r"site engineer", r"metallurg\w+", r"geolog\w+", r"agronom\w+",
    r"quantity surveyor", r"land surveyor", r"building surveyor", r"surveyor", r"draughts\w+", r"estimator", r"foreman", r"site agent", r"construction manager", r"architectural technologist",
    r"boilermaker", r"millwright", r"welder", r"fitter and turner", r"diesel mechanic", r"panel beater", r"plumber", r"electrician", r"artisan", r"rigger", r"machine operator",
    r"warehouse", r"storeman", r"store man", r"picker packer", r"forklift", r"truck driver", r"delivery driver", r"courier", r"merchandiser", r"cashier", r"retail assistant", r"shop assistant", r"promoter",
    r"nurse", r"pharmacist", r"caregiver", r"paramedic", r"teacher", r"chef", r"waiter", r"waitress", r"barista",
    r"sales", r"telesales", r"business development", r"debt collector", r"call cent\w+ agent", r"contact cent\w+ agent", r"accountant", r"bookkeep\w+", r"payroll", r"credit controller", r"human resources", r"recruitment consultant", r"talent acquisition", r"marketing", r"copywriter", r"social media", r"receptionist", r"personal assistant", r"admin clerk", r"data captur\w+", r"gtm", r"go[\s\-]?to[\s\-]?market",
    r"actuarial (?:analyst|specialist|associate|consultant)", r"(?<!software )(?<!digital )(?<!technical )product developer",
    r"cleaner", r"security guard", r"security officer", r"safety officer", r"sheq", r"hse", r"occupational health",
)
BLOCKED_PATTERN = r"\b(?:" + "|".join(BLOCKED) + r")\b"

#: (phrase, role or None, cadence): daily, or on days of the year that are even or odd.
SEARCH_TERMS = (
    ("software developer", SOFTWARE, "daily"), ("junior developer", SOFTWARE, "daily"), ("software engineer", SOFTWARE, "daily"), ("full stack developer", SOFTWARE, "daily"), ("javascript developer", SOFTWARE, "daily"), ("frontend developer", SOFTWARE, "daily"), ("backend developer", SOFTWARE, "even"), ("c# developer", SOFTWARE, "even"), (".net developer", SOFTWARE, "odd"), ("php developer", SOFTWARE, "odd"), ("python developer", SOFTWARE, "even"), ("java developer", SOFTWARE, "odd"), ("react developer", SOFTWARE, "even"), ("ai developer", SOFTWARE, "odd"),
    ("it support", SUPPORT, "daily"), ("service desk", SUPPORT, "daily"), ("technical support", SUPPORT, "daily"), ("desktop support", SUPPORT, "even"), ("help desk", SUPPORT, "odd"), ("it technician", SUPPORT, "even"), ("customer success", SUPPORT, "odd"),
    ("devops engineer", DEVOPS, "even"), ("cloud engineer", DEVOPS, "even"), ("azure engineer", DEVOPS, "odd"), ("aws engineer", DEVOPS, "odd"),
    ("qa engineer", QA, "even"), ("software tester", QA, "even"), ("test analyst", QA, "odd"), ("automation tester", QA, "odd"),
    ("business analyst", ANALYSIS, "even"), ("systems analyst", ANALYSIS, "odd"), ("power platform developer", ANALYSIS, "even"), ("dynamics 365", ANALYSIS, "odd"), ("sharepoint developer", ANALYSIS, "odd"), ("power bi developer", ANALYSIS, "even"),
    ("flutter developer", MOBILE, "even"), ("mobile developer", MOBILE, "even"), ("android developer", MOBILE, "odd"), ("ios developer", MOBILE, "odd"),
    ("security analyst", SECURITY, "even"), ("soc analyst", SECURITY, "odd"), ("cyber security", SECURITY, "even"), ("information security", SECURITY, "odd"),
    ("software developer internship", SOFTWARE, "daily"), ("developer learnership", SOFTWARE, "even"), ("it internship", None, "daily"), ("it learnership", None, "daily"), ("graduate programme information technology", None, "daily"), ("it graduate programme", None, "even"), ("graduate software engineer", SOFTWARE, "odd"), ("trainee it", None, "odd"),
)

NUMBER_WORDS = {"zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "fifteen": 15}
MOST_YEARS = 20
NUMBER = r"(?:(?<!\d)\d{1,2}(?!\d)|(?<![A-Za-z])(?:" + "|".join(NUMBER_WORDS) + r")(?![A-Za-z]))"
EXPERIENCE = r"(?:experience|exp\.?|working|hands[\s\-]?on|industry|commercial|background|track record|in\s+a\s+similar|as\s+a)"
#: Most specific first; an earlier pattern's span keeps later ones out.
YEARS_PATTERNS = (
    ("range", rf"{NUMBER}\s*(?:-|–|—|\bto\b|\bor\b)\s*{NUMBER}\s*(?:\+\s*)?(?:years?|yrs?)\b"),
    ("bracketed", rf"{NUMBER}\s*\(\s*\d{{1,2}}\s*\)\s*(?:\+\s*)?(?:years?|yrs?)\b"),
    ("at_least", rf"(?:at least|minimum(?:\s+of)?|min\.?|no less than|more than|over|upwards of|in excess of)\s*{NUMBER}\s*(?:\+\s*)?(?:years?|yrs?)\b"),
    ("plus", rf"{NUMBER}\s*(?:\+|plus)\s*(?:years?|yrs?)\b"),
    ("plain", rf"{NUMBER}\s*(?:\+\s*)?(?:years?|yrs?)\b"),
)
PERIOD_BEFORE = r"(?:last|past|next|previous|over the|within the|since|for the past)\s*$"
OTHER_AFTER = r"^\s*(?:contract|degree|diploma|qualification|warranty|guarantee|old|fixed[\s\-]term|ago|nqf)"
HISTORY_AFTER = r"^\W*(?:of\s+)?(?:rich\s+|proud\s+|long\s+)?(?:history|heritage|legacy|excellence|standing|combined|collective|in\s+(?:business|operation|the\s+industry|the\s+market))"
ASKED_BEFORE = r"\b(?:at least|minimum|min\.?|requires?|required|must have|ideally|preferably|proven|with|least)\b\W*$"

CONTEXT_WORDS = ("develop", "engineer", "program", "coding", "code", "language", "backend", "back-end", "server", "stack", "experience", "knowledge", "proficien", "framework", "microservice", "api", "skills", "tech")
CONTEXT_CHARS, FEWEST_SKILLS = 60, 3
SOFT_SKILLS = ("Problem Solving", "Communication", "Documentation", "Customer Service")
BOARD_DAYS, BOARD_DAYS_FLOOR = 7, 5
YEARS_CEILING = {ENTRY: 1, JUNIOR: 3}
SHEET_COLUMNS = ("Date Added to Sheet", "Date Job Posted", "Job Title", "Company", "Role Category", "Location", "Work Policy", "Required Skills", "Nice-to-Have Skills", "Years Exp", "Level", "Type", "Salary", "Summary", "Source", "Apply Link")
EXCLUDE_COLUMNS = ("Date Excluded", "Stage", "Reason", "Job Title", "Company", "Role Label", "Location", "Source", "Apply Link", "Description", "Needs Review")
