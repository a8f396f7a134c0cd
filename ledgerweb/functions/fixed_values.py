"""Fixed values that results depend on: word lists, patterns and thresholds."""

#: A sentence tells of a competitor if it holds one of these.
COMPETITOR_KEYWORDS = [
    "competitor",
    "competitors",
    "compete",
    "competes",
    "competing",
    "competition",
    "competitive",
    "rival",
    "rivals",
]

#: The same for customers.
CUSTOMER_KEYWORDS = [
    "customer",
    "customers",
    "client",
    "clients",
    "significant customer",
    "major customer",
    "largest customer",
    "key customer",
    "principal customer",
    "revenue concentration",
    "customer concentration",
    "accounts for",
    "accounted for",
    "represents",
    "represented",
    "% of revenue",
    "percent of revenue",
    "% of sales",
    "percent of sales",
    "% of net revenue",
    "% of total revenue",
]

#: The same for suppliers.
SUPPLIER_KEYWORDS = [
    "supplier",
    "suppliers",
    "vendor",
    "vendors",
    "supply chain",
    "supply agreement",
    "purchase agreement",
    "source",
    "sources",
    "sourcing",
    "procure",
    "procurement",
    "key supplier",
    "principal supplier",
    "sole supplier",
    "single source",
    "sole source",
    "depend on",
    "reliance on",
    "raw material",
    "raw materials",
    "component",
    "components",
    "manufacturer",
    "manufacturers",
    "contract manufacturer",
]

#: The same for partners.
PARTNER_KEYWORDS = [
    "partner",
    "partners",
    "partnership",
    "partnerships",
    "alliance",
    "alliances",
    "strategic alliance",
    "joint venture",
    "joint ventures",
    "collaboration",
    "collaborate",
    "collaborates",
    "collaborating",
    "agreement with",
    "arrangement with",
    "relationship with",
    "licensing agreement",
    "distribution agreement",
    "strategic relationship",
    "business relationship",
]

#: Upper-case words that are no tickers in prose.
TICKER_BLOCKLIST = [
    "A",
    "B",
    "C",
    "D",
    "E",
    "F",
    "G",
    "H",
    "I",
    "J",
    "K",
    "L",
    "M",
    "N",
    "O",
    "P",
    "Q",
    "R",
    "S",
    "T",
    "U",
    "V",
    "W",
    "X",
    "Y",
    "Z",
    "AD",
    "AI",
    "AN",
    "AS",
    "AT",
    "AB",
    "BE",
    "BY",
    "CE",
    "DO",
    "EC",
    "EU",
    "GO",
    "HE",
    "HR",
    "IN",
    "IP",
    "IS",
    "IT",
    "ON",
    "OR",
    "PC",
    "PR",
    "SA",
    "SO",
    "UK",
    "UP",
    "US",
    "WE",
    "ACT",
    "ACA",
    "ADD",
    "AGE",
    "AID",
    "AIR",
    "ALL",
    "AND",
    "ANY",
    "API",
    "ARE",
    "BDC",
    "BIG",
    "CAR",
    "CAN",
    "CMS",
    "CRM",
    "CPU",
    "DEI",
    "DMA",
    "DNA",
    "DSP",
    "EEA",
    "EPC",
    "ESG",
    "FOR",
    "GDP",
    "GLP",
    "GPU",
    "HAS",
    "HHS",
    "IDN",
    "III",
    "IOT",
    "KEY",
    "NET",
    "NEW",
    "NOW",
    "OLD",
    "ONE",
    "OUR",
    "OUT",
    "PER",
    "QSR",
    "SEC",
    "SEE",
    "SOC",
    "THE",
    "TPG",
    "TWO",
    "USA",
    "VIA",
    "YOU",
    "ALSO",
    "ASIC",
    "BACK",
    "BEEN",
    "BOTH",
    "CARE",
    "CASH",
    "DRUG",
    "EACH",
    "EVEN",
    "FAST",
    "FLEX",
    "FORM",
    "GOOD",
    "HALF",
    "JUST",
    "MANY",
    "MORE",
    "MOST",
    "MUST",
    "NEED",
    "NOTE",
    "ONCE",
    "ONLY",
    "OPEN",
    "PLUS",
    "REAL",
    "RISK",
    "SAFE",
    "SELF",
    "SOME",
    "SUCH",
    "TERM",
    "VERY",
    "WELL",
    "WHEN",
    "WILL",
    "WITH",
    "ABOUT",
    "AUDIO",
    "BEING",
    "CLEAR",
    "FOCUS",
    "GLOBE",
    "IDEAL",
    "LIFE",
    "LIGHT",
    "MEDIA",
    "PRIME",
    "RANGE",
    "SMILE",
    "STILL",
    "THINK",
    "THREE",
    "TOTAL",
    "UNITY",
    "VALUE",
    "VITAL",
]

#: Words that are no company names in prose.
NAME_BLOCKLIST = [
    "advantage",
    "alliance",
    "associates",
    "capital",
    "catalyst",
    "cost",
    "enterprises",
    "financial",
    "focus",
    "group",
    "holdings",
    "industries",
    "insight",
    "investment",
    "investments",
    "joint",
    "management",
    "partners",
    "platform",
    "platforms",
    "premier",
    "progress",
    "regis",
    "reliance",
    "resources",
    "securities",
    "service",
    "services",
    "solution",
    "target",
    "comstock",
    "enact",
    "nasdaq",
    "nyse",
    "new york stock exchange",
    "solutions",
    "system",
    "systems",
    "technology",
    "technologies",
    "ventures",
    "ad",
    "audio",
    "care",
    "cash",
    "core",
    "data",
    "digital",
    "direct",
    "energy",
    "global",
    "growth",
    "health",
    "key",
    "life",
    "light",
    "local",
    "media",
    "mobile",
    "national",
    "network",
    "note",
    "open",
    "plus",
    "power",
    "prime",
    "pro",
    "pure",
    "real",
    "smart",
    "source",
    "star",
    "total",
    "trust",
    "unity",
    "value",
    "vital",
    "web",
    "cms",
    "dei",
    "dna",
    "epc",
    "esg",
    "glp",
    "iot",
    "qsr",
    "strategy",
    "reliability",
]

#: Names that are companies whatever the lists say.
HIGH_VALUE_NAMES = [
    "adobe",
    "alphabet",
    "amazon",
    "apple",
    "cisco",
    "dell",
    "google",
    "intel",
    "microsoft",
    "nvidia",
    "oracle",
    "qualcomm",
    "salesforce",
    "samsung",
    "berkshire",
    "blackrock",
    "citi",
    "citibank",
    "citigroup",
    "costco",
    "disney",
    "goldman",
    "jpmorgan",
    "mastercard",
    "netflix",
    "paypal",
    "pfizer",
    "starbucks",
    "tesla",
    "visa",
    "walmart",
    "berkshire hathaway",
    "dollar general",
    "dollar tree",
    "goldman sachs",
    "home depot",
    "johnson & johnson",
    "jpmorgan chase",
    "lockheed martin",
    "morgan stanley",
    "procter & gamble",
    "wells fargo",
]

#: A relation is denied.
NEGATION_PATTERNS = [
    r"\bnot\s+(?:a\s+)?(?:direct\s+)?competitor",
    r"\bdon't\s+(?:directly\s+)?compete",
    r"\bdo\s+not\s+(?:directly\s+)?compete",
    r"\bno\s+(?:direct\s+)?competition",
    r"\bnot\s+(?:a\s+)?(?:significant\s+)?customer",
    r"\bnot\s+(?:a\s+)?(?:major\s+)?supplier",
    r"\bno\s+longer\s+(?:a\s+)?",
    r"\bformerly\s+",
    r"\bpreviously\s+",
    r"\bused\s+to\s+be\s+",
]

#: A person's career is told.
BIOGRAPHICAL_PATTERNS = [
    r"\bserves?\s+(?:as\s+)?(?:a\s+)?director\b",
    r"\bdirector\s+(?:of|for|at)\b",
    r"\bboard\s+(?:of\s+directors|member|seat)\b",
    r"\bother\s+directorships?\b",
    r"\boutside\s+director\b",
    r"\bindependent\s+director\b",
    r"\bprior\s+to\s+joining\b",
    r"\bpreviously\s+(?:at|with|served)\b",
    r"\bformerly\s+(?:at|with|of)\b",
    r"\bformer\s+(?:executive|officer|president|ceo|cfo|coo)\b",
    r"\bpast\s+(?:employer|experience|position)\b",
    r"\bwork(?:ed)?\s+(?:at|for|with)\b.{0,30}\b(?:before|prior|previously)\b",
    r"\b(?:his|her|their)\s+(?:prior|previous|past)\s+(?:experience|role|position)\b",
    r"\bexperience\s+includes?\b",
    r"\bcareer\s+(?:at|with|includes?)\b",
    r"\bjoined\s+(?:us|the\s+company)\s+from\b",
    r"\bcame\s+to\s+(?:us|the\s+company)\s+from\b",
    r"\b\w+'s\s+time\s+at\b",
    r"\b(?:his|her|their)\s+time\s+at\b",
    r"\bserved\s+as\s+(?:senior\s+)?(?:vice\s+)?(?:president|officer|director|manager)\b",
    r"\bheld\s+(?:the\s+)?(?:position|role|title)s?\s+(?:at|of|with)\b",
    r"\bheld\s+(?:\w+\s+){0,3}(?:executive|management|leadership)\s+positions?\b",
    r"\bpositions?\s+(?:at|with)\s+(?:several|various|multiple)\b",
    r"\bmultinational\s+companies?\s+including\b",
    r"\b(?:before|prior\s+to)\s+(?:\w+\s*,?\s*){0,3}(?:he|she|they)\s+held\b",
    r"\bvarious\s+(?:roles|positions)\s+(?:at|with|in)\b",
    r"\b(?:his|her)\s+(?:roles?\s+)?(?:at|in|with)\s+\w+\s*,?\s+(?:he|she)\s+(?:also\s+)?held\b",
    r"\bbiographical\b",
    r"\bbackground\s+(?:of|includes?)\b",
    r"\bresume\b",
    r"\bcurriculum\s+vitae\b",
    r"\bspent\s+\d+\s+years?\s+(?:at|with)\b",
    r"\b\d+\s+years?\s+(?:at|with|of\s+experience)\b",
]

#: A listing, an exchange or a court case is named.
EXCHANGE_PATTERNS = [
    r"\b(?:NASDAQ|NYSE|AMEX|OTC)\s*:\s*[A-Z]{1,5}\b",
    r"\blisted\s+on\s+(?:the\s+)?(?:NASDAQ|NYSE)\b",
    r"\btraded\s+on\s+(?:the\s+)?(?:NASDAQ|NYSE)\b",
    r"\btrading\s+on\s+(?:the\s+)?(?:NASDAQ|NYSE)\b",
    r"\b(?:NASDAQ|NYSE)\s+(?:stock\s+)?(?:market|exchange)\b",
    r"\bsecurities\s+(?:trade|traded|trading)\s+on\b",
    r"\b(?:Nasdaq|NASDAQ|NYSE)\s+Global\s+(?:Select\s+)?Market\b",
    r"\bcommon\s+stock\s+is\s+(?:listed|traded)\b",
    r"\b(?:sanctions?|investigations?)\s+by\s+(?:Nasdaq|NASDAQ|NYSE)\b",
    r"\b(?:delisted|delisting)\s+from\s+(?:Nasdaq|NASDAQ|NYSE)\b",
    r"\b(?:comply|compliance)\s+with.{0,50}(?:Nasdaq|NASDAQ|NYSE)\b",
    r"\b(?:Nasdaq|NASDAQ|NYSE)\s+listing\s+(?:rules?|requirements?|standards?)\b",
    r"\bv\.\s+\w+(?:,?\s+Inc\.?)?\s*\(",
    r"\bSupreme\s+Court\b.{0,100}\bv\.\b",
    r"\bSouth\s+Dakota\s+v\.\b",
    r"\bcourt(?:'s)?\s+(?:decision|ruling)\s+in\b",
    r"\bSupreme\s+Court(?:'s)?\s+\w+\s+decision\b",
]

#: A group's structure is told.
CORPORATE_PATTERNS = [
    r"\bsubsidiary\s+(?:of|company)\b",
    r"\bcontrolled\s+(?:affiliate|subsidiary|entity)\b",
    r"\bwholly[- ]owned\s+subsidiary\b",
    r"\bparent\s+company\b",
    r"\bholding\s+company\b",
    r"\b(?:company\s+)?(?:that\s+)?owns\s+\w+\b",
    r"\boperating\s+(?:companies|subsidiaries|utilities)\b",
    r"\bspin[- ]?off\s+(?:of|from)\b",
    r"\bspun\s+off\s+from\b",
    r"\bacquir(?:ed|ing)\s+\w+\s+from\b",
    r"\bpurchased?\s+(?:the\s+)?(?:assets?|business)\s+(?:of|from)\b",
    r"\b(?:former|previously)\s+(?:a\s+)?(?:part|division|segment)\s+of\b",
    r"\bcorporate\s+(?:lineage|structure|history)\b",
    r"\borigins?\s+as\s+(?:a\s+)?(?:part|division)\s+of\b",
]

#: A platform is depended on.
PLATFORM_PATTERNS = [
    r"\bapp\s+store(?:s)?\s+(?:operated|run|owned)\s+by\b",
    r"\bdistributed\s+(?:via|through)\s+(?:app\s+)?stores?\b",
    r"\b(?:Apple|Google)\s+(?:App\s+Store|Play\s+Store)\b",
    r"\b(?:iOS|Android)\s+(?:app\s+)?store\b",
    r"\boperating\s+system(?:s)?\s+(?:such\s+as|like|including)\b",
    r"\bmobile\s+operating\s+system(?:s)?\b",
    r"\b(?:Apple's|Google's)\s+(?:iOS|Android)\b",
    r"\binteroperability\s+(?:of|with)\s+.{0,30}(?:mobile\s+)?(?:app|platform)\b",
    r"\bdependent\s+on\s+.{0,30}(?:operating\s+system|platform|app\s+store)\b",
]

#: What tells of a competitor, and how surely.
COMPETITOR_SIGNS = [
    (r"\bcompet(?:e|es|ed|ing|itor|itors)\s+(?:with|against|from)\b", 0.9),
    (r"\bcompetition\s+(?:\w+\s+)*?(?:from|with|includes?)\b", 0.9),
    (r"\bprincipal\s+competitors?\b", 0.95),
    (r"\bmain\s+competitors?\b", 0.95),
    (r"\bcompetitors?,?\s+(?:include|including|are|consist)\b", 0.95),
    (r"\brival(?:s|ry)?\b", 0.7),
    (r"\bcompetitive\s+(?:landscape|environment|market)\b", 0.6),
]

#: What tells of a supplier, and how surely.
SUPPLIER_SIGNS = [
    (r"\bpurchase(?:s|d)?\s+\w*\s*(?:from|through)\b", 0.9),
    (r"\bsource(?:s|d)?\s+\w*\s*(?:from|through)\b", 0.9),
    (r"\bsupplier(?:s)?\s+(?:include|are|such as)\b", 0.9),
    (r"\bprovided\s+by\b", 0.8),
    (r"\bmanufactured\s+by\b", 0.85),
    (r"\bwe\s+(?:use|utilize|rely\s+on)\s+(?:products?|services?|technology)\s+from\b", 0.85),
    (r"\bcomponent(?:s)?\s+(?:from|provided|supplied)\b", 0.8),
    (r"\bvendor(?:s)?\b", 0.6),
]

#: What tells of a customer, and how surely.
CUSTOMER_SIGNS = [
    (r"\bsell(?:s)?\s+.{0,30}?\bto\b", 0.9),
    (r"\bprovide(?:s)?\s+(?:services?|products?)\s+to\b", 0.85),
    (r"\bcustomer(?:s)?\s+(?:include|are|such as)\b", 0.9),
    (r"\bclient(?:s)?\s+(?:include|are|such as)\b", 0.85),
    (r"\bserve(?:s|d)?\s+(?:as\s+)?(?:a\s+)?customer\b", 0.8),
    (r"\bour\s+(?:largest|major|key)\s+customer(?:s)?\b", 0.9),
]

#: What tells of a partner, and how surely.
PARTNER_SIGNS = [
    (r"\bpartner(?:s|ed|ing|ship)?\s+(?:with|include)\b", 0.9),
    (r"\bcollaborat(?:e|es|ed|ing|ion)\s+with\b", 0.85),
    (r"\bstrategic\s+(?:alliance|relationship|partner)\b", 0.85),
    (r"\bjoint\s+venture\b", 0.9),
    (r"\becosystem\s+(?:partner|relationship)s?\b", 0.8),
    (r"\becosystem\s+relationships?\s+(?:with|provide)\b", 0.8),
    (r"\bwork(?:s|ed|ing)?\s+(?:closely\s+)?with\b", 0.5),
]

#: What tells of no business relation, and of what instead.
NO_RELATION_SIGNS = [
    (r"\bv\.\s", "legal_case"),
    (r"\blisted\s+on\b", "exchange"),
    (r"\btrading\s+on\b", "exchange"),
    (r"\bformerly\s+(?:at|with)\b", "biographical"),
    (r"\bprior\s+(?:to|employer)\b", "biographical"),
    (r"\bboard\s+of\s+directors\b", "biographical"),
    (r"\bserves?\s+as\s+(?:a\s+)?director\b", "biographical"),
    (r"\bdirector\s+(?:of|for|at)\s+", "biographical"),
    (r"\bother\s+directorships?\b", "biographical"),
    (r"\bjoined\s+(?:the\s+)?(?:board|company)\b", "biographical"),
    (r'"[^"]*of\s+[^"]*"', "figurative_use"),
]

#: Words that a name loses before it is compared by characters.
CORPORATE_SUFFIXES = [
    "incorporated",
    "corporation",
    "company",
    "limited",
    "holdings",
    "enterprises",
    "industries",
    "international",
    "group",
    "partners",
    "inc",
    "corp",
    "co",
    "ltd",
    "llc",
    "llp",
    "plc",
    "sa",
    "ag",
    "nv",
    "bv",
    "gmbh",
    "lp",
    "intl",
    "hldgs",
    "hlds",
    "grp",
]

#: The same for small words.
NOISE_WORDS = [
    "the",
    "and",
    "of",
    "for",
    "a",
    "an",
]

#: Endings that a name loses, in this order, before it is looked up.
NAME_SUFFIXES = [
    " corporation",
    " incorporated",
    " holdings ltd",
    " holding ltd",
    " holdings",
    " holding",
    " technologies",
    " technology",
    " solutions",
    " platforms",
    " services",
    " systems",
    " group",
    " corp.",
    " corp",
    " inc.",
    " inc",
    " ltd.",
    " ltd",
    " llc",
    " plc",
    " co.",
    " co",
    "/de/",
    "/md/",
    "/nv/",
]

#: Least similarity of a fact and of a candidate, by relation.
TIER_THRESHOLDS = {
    "HAS_COMPETITOR": (0.35, 0.25),
    "HAS_PARTNER": (0.50, 0.30),
    "HAS_SUPPLIER": (0.55, 0.30),
    "HAS_CUSTOMER": (0.55, 0.30),
}

#: Words in a sentence that make a match likelier.
CONTEXT_WORDS = [
    "competitor", "customer", "supplier", "partner", "vendor", "client", "collaboration", "agreement", "contract",
    "relationship",
]

#: Mentions that are words of the language unless a list or a resolved company speaks for them.
GENERIC_MENTIONS = ["target", "master", "apple", "amazon", "google", "microsoft"]

#: Mentions of up to two letters that are companies.
SHORT_MENTIONS = ["ibm", "hp", "ge", "at", "ma"]

#: Contexts in which a filing names its competitors; the last group is the stretch that holds the names.
COMPETITOR_CONTEXTS = [
    r"[Oo]ur\s+(?:current\s+|primary\s+|principal\s+)?competitors?\s+include:?\s*(.{100,3000}?)(?:Patents|We rely|Intellectual|Our\s+(?:intellectual|business)|[A-Z][a-z]+\s+and\s+Proprietary|$)",
    r"[Cc]ompetitors?\s+(?:to\s+[\w\s]+\s+)?include\s+[^.]+such\s+as\s+([A-Z][^.]+)",
    r"(?:principal\s+|primary\s+)?competitor\s+(?:in\s+[\w\s]+\s+)?(?:is|are)\s+([A-Z][^.]{5,150})",
    r"compete\s+with\s+(?:products?\s+from\s+)?([A-Z][^.]{10,200})",
    r"compete\s+(?:directly\s+)?against\s+([A-Z][^.]{10,200}(?:Inc\.|Corp\.|Corporation|Ltd\.))",
    r"competition\s+from\s+(?:our\s+)?(?:primary\s+)?(?:\w+\s+)?(?:competitors?\s+such\s+as\s+)?([A-Z][^.]{10,200}(?:Inc\.|Corp\.|Corporation|Ltd\.))",
    r"competitors?\s+such\s+as\s+([A-Z][^.]{10,200})",
    r"also\s+compete\s+with\s+([A-Z][^.]{10,150})",
]

#: A list of names within such a stretch.
SUCH_AS = r"such\s+as\s+([^;•\n]+)"

#: Names of companies within such a stretch, the surest form first.
COMPANY_NAMES = [
    r"\b([A-Z][a-zA-Z0-9&\.\-]+(?:\s+[A-Z][a-zA-Z0-9&\.\-]+)*)\s+(?:Corporation|Corp\.?|Inc\.?|Ltd\.?|LLC|Company|Co\.)\b",
    r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,4})\b",
    r"\b([A-Z][a-z]{4,15})\b",
    r"\b([A-Z]{3,8})\b",
]

#: Least scores of a strong, moderate and weak match, by characters and by meaning.
CHARACTER_LABELS, SEMANTIC_LABELS = (0.50, 0.30, 0.15), (0.75, 0.60, 0.45)

#: What a decision costs on each of the four tiers.
TIER_COSTS = [0.0, 0.0, 0.001, 0.01]

#: In which order a traversal gives its relations.
RELATION_PRIORITY = {
    "HAS_SUPPLIER": 1,
    "HAS_CUSTOMER": 2,
    "HAS_PARTNER": 3,
    "HAS_COMPETITOR": 4,
    "SIMILAR_DESCRIPTION": 5,
    "SIMILAR_RISK": 6,
}

#: What an industry edge weighs by the classification that made it.
INDUSTRY_WEIGHTS = {
    "SIC": 1.2,
    "INDUSTRY": 0.8,
    "SECTOR": 0.6,
}
