"""Fixed values of the domain: taxonomies, word lists and patterns, as plain data.

They have to equal the values that results are compared with, so they are
written out once, in natural order, and used by the operators as literals.
"""

from __future__ import annotations

# Section categories in report order.
CATEGORIES = (
    "business_overview risk_factors financial_results management_discussion legal_proceedings governance "
    "notes_to_financial_statements properties disclosures market_information exhibits other"
).split()

# Annual-report item to category.
ITEM_CATEGORIES = {
    "1": "business_overview", "1A": "risk_factors", "1B": "disclosures", "2": "properties", "3": "legal_proceedings", "4": "disclosures",
    "5": "market_information", "6": "financial_results", "7": "management_discussion", "7A": "management_discussion", "8": "financial_results",
    "9": "financial_results", "9A": "disclosures", "9B": "disclosures", "9C": "disclosures", "10": "governance", "11": "governance",
    "12": "governance", "13": "governance", "14": "governance", "15": "exhibits", "16": "exhibits",
}
# Items that a 10-K has at the least.
STANDARD_ITEMS = "1 1A 1B 2 3 4 5 6 7 7A 8 9 9A 9B 10 11 12 13 14 15".split()

# Heading patterns, the first that matches the lower-cased heading decides.
HEADING_RULES = [
    (r"item\s+1[^a-z0-9].*business", "business_overview"),
    (r"business\s+overview", "business_overview"),
    (r"item\s+1a[^a-z0-9].*risk", "risk_factors"),
    (r"risk\s+factors?", "risk_factors"),
    (r"item\s+6\b.*financial\s+data", "financial_results"),
    (r"item\s+8\b.*financial\s+statements", "financial_results"),
    (r"selected\s+financial\s+data", "financial_results"),
    (r"financial\s+statements?", "financial_results"),
    (r"results?\s+of\s+operations?", "financial_results"),
    (r"item\s+7[^a]\b.*management", "management_discussion"),
    (r"management.{0,10}discussion", "management_discussion"),
    (r"md&a", "management_discussion"),
    (r"item\s+3\b.*legal", "legal_proceedings"),
    (r"legal\s+proceedings?", "legal_proceedings"),
    (r"item\s+10\b.*directors?", "governance"),
    (r"item\s+11\b.*compensation", "governance"),
    (r"item\s+12\b.*security\s+ownership", "governance"),
    (r"item\s+13\b.*related\s+transactions?", "governance"),
    (r"item\s+14\b.*accounting\s+fees", "governance"),
    (r"corporate\s+governance", "governance"),
    (r"executive\s+compensation", "governance"),
    (r"note\s+\d+", "notes_to_financial_statements"),
    (r"notes?\s+to\s+.*financial\s+statements?", "notes_to_financial_statements"),
    (r"item\s+2\b.*propert", "properties"),
    (r"^propert(?:y|ies)\b", "properties"),
    (r"item\s+5\b.*(?:market|equity|stock)", "market_information"),
    (r"market\s+for\s+.*common\s+(?:equity|stock)", "market_information"),
    (r"common\s+(?:equity|stock).*market\s+(?:price|information)", "market_information"),
    (r"(?:stock|share)\s+(?:price|performance|repurchase)", "market_information"),
    (r"item\s+15\b.*exhibit", "exhibits"),
    (r"item\s+16\b", "exhibits"),
    (r"^exhibits?\b", "exhibits"),
    (r"financial\s+statement\s+schedules?", "exhibits"),
    (r"item\s+1b\b.*unresolved", "disclosures"),
    (r"unresolved\s+staff\s+comments?", "disclosures"),
    (r"item\s+4\b.*mine\s+safety", "disclosures"),
    (r"mine\s+safety\s+disclosures?", "disclosures"),
    (r"item\s+9a\b.*controls?", "disclosures"),
    (r"controls?\s+and\s+procedures?", "disclosures"),
    (r"item\s+9b\b.*other\s+information", "disclosures"),
    (r"item\s+9c\b", "disclosures"),
    (r"disclosure\s+regarding\s+foreign\s+jurisdictions?", "disclosures"),
]

# Words of organisation names.
LEGAL_SUFFIXES = "inc incorporated corp corporation llc ltd limited plc gmbh ag sa bv lp llp l p co".split()
LEADING_ARTICLES = "the an".split()
ACRONYM_IGNORED = "and of the a an companies company".split()
GENERIC_TOKENS = "company corporation inc llc ltd consolidated financial statements statement exhibit item registrant trustee".split()
CONTAINMENT_TOKENS = (
    "group holdings partners capital university health media gas energy school business fund trust bank services "
    "technologies communications securities transaction agreement"
).split()
PERSON_SUFFIXES = "jr sr ii iii iv".split()
PERSON_TITLES = "mr mrs ms dr prof sir".split()

# Single words and phrases that are no organisation, and patterns of such text.
ORG_STOPWORDS = "company llc sec ferc fasb gaap pcaob coso asu aicpa diluted basic weighted equity controller treasury".split()
ORG_STOP_PHRASES = [
    "financial statements", "consolidated financial statements", "the consolidated financial statements", "consolidated balance sheets",
    "supplementary data", "financial statement schedules", "registrant", "registrants", "commission", "board", "board of directors",
    "the board of directors", "trustee", "general counsel", "sec file no",
    "committee of sponsoring organizations of the treadway commission", "the committee of sponsoring organizations of the treadway commission",
    "public company accounting oversight board", "the public company accounting oversight board", "accounting oversight board",
    "management s discussion and analysis of financial condition", "management s discussion and analysis", "issuer purchases of equity",
    "issuer purchases of", "interactive data file", "financial data", "selected financial data", "management s report",
    "management s annual report", "security ownership of certain beneficial owners and management", "regulation s k",
    "registrant s common equity", "internal control integrated framework", "internal control", "equity", "controller",
]
ORG_BOILERPLATE = (
    r"\bact\s+of\s+\d{4}\b|^(?:the\s+)?securities\s+(?:exchange\s+)?act\b|\bsarbanes.oxley\b|\bfinancial\s+statements?\b"
    r"|\bdiscussion\s+and\s+analysis\b|\bpurchases\s+of\s+equity\b|\bregulation\s+s-?k\b"
)
# Words that are no part of a person's name, and titles that announce one.
PERSON_STOPWORDS = (
    "subsidiary subsidiaries product products division business operations revenue income expense expenses goodwill equity asset assets "
    "liability liabilities shares stock statement statements accounting fiscal lease leases item exhibit bermuda bermudas earnings retained "
    "diluted weighted proceeds transactions regulatory depreciation amortization corporate governance compensation compliance missouri illinois "
    "virginia carolina indiana ohio michigan wisconsin georgia florida texas nevada cloud platform service services palantir software solution "
    "solutions network networks system systems"
).split()
ANNOUNCING_TITLES = (
    "mr mrs ms dr prof sir sen rep hon ceo cfo coo cto cso evp svp vp president chairman chairwoman director officer secretary treasurer "
    "general manager principal"
).split()

# Money.
MONEY_SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "chf": "CHF", "usd": "USD", "eur": "EUR", "gbp": "GBP", "jpy": "JPY"}
MONEY_NUMBER = r"\d[\d,]*(?:\.\d+)?"
MONEY_MAGNITUDE = r"(?:\s*(?:thousand|million|billion|trillion)s?)"
MONEY_SYMBOL = r"(?:\$|€|£|¥|CHF|USD|EUR|GBP|JPY)"
MONEY = rf"{MONEY_SYMBOL}\s*{MONEY_NUMBER}{MONEY_MAGNITUDE}?|{MONEY_NUMBER}{MONEY_MAGNITUDE}\s+(?:dollars?|euros?|pounds?)"
MONEY_WORDS = {"dollar": "USD", "euro": "EUR", "pound": "GBP"}
MAGNITUDES = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}

# Thresholds of the contents list and of sections.
TOC_SEARCH, TOC_BLOCK, TOC_MIN_ITEMS, TOC_MAX_GAP = 120_000, 8_000, 4, 400
BARE_SEARCH, BARE_CLUSTER_GAP, BARE_MAX_GAP, TOC_TAIL = 50_000, 800, 150, 500
COVERAGE, ENOUGH_HEADINGS = 0.70, 12

# Table patterns.
UNITS_ANCHOR = r"\((?:in|dollars in|amounts in)\s+(?:millions?|thousands?|billions?)[^)]*\)"
YEAR = r"\b(?:19|20)\d{2}\b"
PERIOD = r"\b(?:year|quarter|q[1-4]|ended|ending|ytd|fiscal|period|months?)\b"
CELL = r"\(?\$?\s*[\d,]+(?:\.\d+)?\s*%?\)?"
PIPE_ROW = r"\|[^|\n]+\|"
VALUE_LINE = r"^[\s\xa0$%().,\-—–]*[\d][\d\s$%().,\-—–]*$"
FOOTNOTE_LINE = r"^\s*\([a-zA-Z1-9]\)\s"
SKIP_LINE = r"^\s*(?:\d{1,4}\s*$|table\s+of\s+contents|[-─═]{10,})"
STOP_LINE = r"^(?:ITEM|PART)\s+\d"

# Page quality.
PAGE_MIN_CHARS, PAGE_MIN_ALPHA, PAGE_MAX_REPLACED, PAGE_MIN_LINE = 50, 0.4, 0.1, 10
