"""Fixed values of the quality model.

These constants define what is measured and corrected; results are only
comparable between runs while they stay as they are.
"""

# --- fixed values: completeness ---------------------------------------------

MIN_LENGTHS = {
    "works": {"title": 6, "journal_title": 6, "abstract": 12, "subTitle": 6},
    "persons": {"firstName": 2, "lastName": 2, "otherNames": 5, "publishedName": 5},
}

FULL_DATE_LENGTH = 10

FIRST_POPULATION_YEAR = 2000

WORK_TYPES = [
    "book",
    "book-chapter",
    "dissertation-thesis",
    "edited-book",
    "journal-article",
    "working-paper",
    "conference-abstract",
    "conference-paper",
    "conference-poster",
]

COUNTRIES = [
    "BE", "BG", "DK", "DE", "EE", "FI", "FR", "GB", "GR", "IE", "IT", "HR", "LV", "LT", "LU", "MT", "NL", "AT", "PL", "PT", "RO",
    "SE", "SK", "SI", "ES", "CZ", "HU", "UK", "CY", "AL", "AD", "IS", "LI", "MC", "ME", "NO", "SM", "CH", "RS", "UA", "BY",
]

# --- fixed values: patterns -------------------------------------------------

# Chinese, Japanese, Korean and Cyrillic letters
FOREIGN_ALPHABET = "[\u4e00-\u9fff\u3040-\u30ff\uac00-\ud7a3а-яА-Я]"
TAG = r"<[a-zA-Z/]+>"
LEADING_NOISE = r"^[^a-zA-Z0-9]+"
TRAILING_NOISE = r"""[^a-zA-Z0-9.!?"'\)]+$"""
NOT_AVAILABLE = r"^[nk][\./]?[na][\./]?$"
DOUBLE_BLANK = r"  "
TEXT_NOISE = rf"({TAG})|({LEADING_NOISE})|({TRAILING_NOISE})|({NOT_AVAILABLE})|({DOUBLE_BLANK})"
NAME_NOISE = r"[\(\)/\t0-9]+"
ABSTRACT_LABEL = r"^[Aa][Bb][Ss][Tt][Rr][Aa][Cc][Tt]"
LINE_BREAKS = r"[\n\r\t]"
BLANKS = r"[ ]{2,}"
EDGE_BLANK = r"^[ ]|[ ]$"
PARENTHESES = r"\(.*\)"
KEY_SEPARATORS = r"[,;:]"
KEY_BLANKS = r"[ ]+"
KEY_QUOTES = "['\"´`]"

BIBTEX = r"^(@[a-zA-Z]+[\s]*\{[\S\s]*\})$"
OWNER_ID = r"^([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9|X])$"
PUBLICATION_ID = r"^([0-9]+)$"
URL = (
    r"^(((http[s]?://)?[A-Za-z0-9.-]+)"
    r"((?:\/[\+~%\/.\w-_\(\)#]*)?\??(?:[-\+~=&;%@.\w_:,/\(\)]*)#?(?:[-\+=&;%@.\w_:,/\(\)]*))?)$"
)
DOI = r"""^(10[.][0-9]{4,}[^\s"\/<>]*\/[^\s"<>]+)$"""
ISSN = r"^((977[\-]?)?(\d[\-]?){6}\d([-]?[0-9xX]))$"
ISBN = r"^(97[89][\-]?)?([0-9][-]?){8}[0-9]([-]?[0-9xX])$"
PERSON_ID = r"^[0-9X\-_]+$"
COUNTRY_CODE = r"^[A-Z]{2}$"
AFFILIATION_YEAR = r"^((19[0-9][0-9])|(20[0-9][0-9]))$"

# year[-month[-day]]; the year itself is compared as a number range
DATE_SHAPE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"
FIRST_VALID_YEAR = 1800

# At least five words with single blanks between them. A word needs only one
# character on the outer sides, which keeps the search linear in the text.
FIVE_WORDS = r"[^\s] [^\s]+ [^\s]+ [^\s]+ [^\s]"

# --- fixed values: corrections ----------------------------------------------

ISSN_LABEL = r"([iI][sS][sS][nN][ :\-.]?)|[ ]"
ISBN_LABEL = r"([iI][sS][bB][nN](([ :\-.]?(10|13)[ :\-.]?)|[ :\-.]?))|[ ]"
URL_NOISE = r"[\\ ]"
DOI_LABEL = r"((http[s]?://)?(((www\.)|(dx\.))?doi\.org/))|[ ]"
NUMBER_SEPARATORS = "./_"

# labelled numbers that hide in other fields
LABELLED_NUMBERS = {
    "issn": r"(?<=([iI][sS][sS][nN][^a-z^A-Z]))(((977)-\d{3}-\d{4}-\d{2}-\d)|(\d{4}-\d{3}[0-9xX]))",
    "isbn": (
        r"(?<=([iI][sS][bB][nN](([ :\-.]?(10|13)[ :\-.]?)|[ :\-.])))"
        r"((97[89][\-]?)?([0-9][-]?){8}[0-9]([-]?[0-9xX]))"
    ),
    "doi": r"""(?<=([dD][oO][iI][ :\-.]))(10[.][0-9]{4,}[^\s"\/<>]*\/[^\s"<>]+)""",
}
SEARCHED_FIELDS = ["doi", "url", "isbn", "issn", "subTitle", "journal_title", "title"]

# fields of a work that the reference table can fill
REFERENCE_FIELDS = ["abstract", "date", "doi", "isbn", "issn", "subTitle", "title", "type", "url"]

# roles that make a contributor an author
AUTHOR_ROLES = ["author", "http://credit.niso.org/contributor-roles/writing-original-draft/"]

# entry types of the citation format; other types are not read
CITATION_TYPES = (
    "article book booklet conference inbook incollection inproceedings manual mastersthesis "
    "misc phdthesis proceedings techreport unpublished"
).split()

# words that stand for themselves in citations, by their first three letters
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
]

# --- fixed values: registries -----------------------------------------------

# organisation type -> (entity, id column, name column)
REGISTRIES = {
    "GRID": ("ROR", "external_ids.GRID.preferred", "name"),
    "ROR": ("ROR", "id", "name"),
    "LEI": ("lei", "id", "name"),
    "FUNDREF": ("fundref", "uri", "primary_name_display"),
}

# --- fixed values: weights --------------------------------------------------

WEIGHTS = {
    "MinLength": {
        "works.title": 14,
        "works.journal_title": 6,
        "works.abstract": 14,
        "works.subTitle": 9,
        "persons.firstName": 5,
        "persons.lastName": 6,
        "persons.otherNames": 5,
        "persons.publishedName": 5,
    },
    "MinValue": {"works.date": 1},
    "NotNull": {
        "persons.affiliations": 19,
        "persons.country": 10,
        "persons.firstName": 30,
        "persons.lastName": 31,
        "persons.id": 45,
        "persons.otherNames": 24,
        "persons.publishedName": 24,
        "works.authors": 38,
        "works.bibtex": 12,
        "works.date": 36,
        "works.journal_title": 11,
        "works.orcid_id": 45,
        "works.orcid_publication_id": 35,
        "works.doi": 34,
        "works.issn": 32,
        "works.isbn": 33,
        "works.abstract": 36,
        "works.subTitle": 12,
        "works.title": 35,
        "works.type": 18,
        "works.url": 28,
        "orgUnits.id": 12,
        "orgUnits.type": 3,
        "orgUnits.name": 12,
    },
    "MinPopulation": {"works.date": 5, "works.type": 1, "works.country": 3},
    "MinObject": {"works": 3, "persons": 1},
    "CorrectValue": {
        "works.bibtex": 8,
        "works.orcid_id": 30,
        "works.orcid_publication_id": 28,
        "works.date": 24,
        "works.url": 25,
        "works.doi": 31,
        "works.issn": 7,
        "works.isbn": 6,
        "works.abstract": 23,
        "works.title": 32,
        "works.subTitle": 16,
        "persons.firstName": 21,
        "persons.lastName": 25,
        "persons.publishedName": 25,
        "persons.otherNames": 26,
        "persons.id": 24,
        "persons.country": 6,
        "persons.affiliations.startYear": 5,
        "persons.affiliations.endYear": 5,
        "orgUnits.name": 8,
    },
    "UniqueValue": {
        "works.bibtex": 1,
        "works.orcid_publication_id": 8,
        "works.doi": 5,
        "persons.id": 8,
        "orgUnits.id": 4,
    },
    "NoContradict": {
        "persons.affiliations.startBeforeEnd": 2,
        "works.isbnXORissn": 4,
        "works.isbnOnlyBook": 3,
    },
    "UniqueObject": {"works": 1},
}

DIMENSIONS = {
    "Completeness": {"MinLength": 5, "MinValue": 2, "NotNull": 7, "MinPopulation": 2, "MinObject": 9},
    "Consistency": {"UniqueValue": 5, "NoContradict": 1, "UniqueObject": 3},
}

# --- fixed values: character folding of duplicate keys ------------------------

FOLDING = {
    161: " ", 162: "cent", 163: "pound", 164: " ", 165: "yen", 166: "|", 167: "paragraph", 168: " ", 169: "(c)", 170: "a",
    171: "\"", 172: "not", 173: "-", 174: "(r)", 175: " ", 176: "degree", 177: "plus-minus", 178: "2", 179: "3", 180: " ",
    181: "micro", 182: " ", 183: " ", 184: " ", 185: "1", 186: "o", 187: "\"", 188: "1/4", 189: "1/2", 190: "3/4", 191: " ",
    224: "a", 225: "a", 226: "a", 227: "a", 229: "a", 230: "ae", 231: "c", 232: "e", 233: "e", 234: "e", 235: "e", 236: "e",
    237: "i", 238: "i", 239: "i", 240: "d", 241: "n", 242: "o", 243: "o", 244: "o", 245: "o", 215: "x", 248: "o", 249: "u",
    250: "u", 251: "u", 253: "y", 254: "p", 223: "ss", 247: ":", 255: "y", 257: "a", 259: "a", 261: "a", 263: "c", 265: "c",
    267: "c", 269: "c", 271: "d", 273: "d", 275: "e", 277: "e", 279: "e", 281: "e", 283: "e", 285: "g", 287: "g", 289: "g",
    291: "g", 293: "h", 295: "h", 297: "i", 299: "i", 301: "i", 303: "i", 305: "i", 307: "ij", 309: "j", 311: "k", 312: "k",
    314: "l", 316: "l", 318: "l", 320: "l", 322: "l", 324: "n", 326: "n", 328: "n", 329: "'n", 331: "n", 333: "o", 335: "o",
    337: "o", 339: "oe", 341: "r", 343: "r", 345: "r", 347: "s", 349: "s", 351: "s", 353: "s", 355: "t", 357: "t", 359: "t",
    361: "u", 363: "u", 365: "u", 367: "u", 369: "u", 371: "u", 373: "w", 375: "y", 378: "z", 380: "z", 382: "z", 383: "s",
    513: "a", 515: "a", 517: "e", 519: "e", 521: "i", 523: "i", 525: "o", 527: "o", 529: "r", 531: "r", 533: "u", 535: "u",
    537: "s", 539: "t", 8208: "-", 8209: "-", 8210: "-", 8211: "-", 8212: "-", 8213: "-", 8216: "'", 8217: "'", 8218: "'",
    8219: "'", 8220: "\"", 8221: "\"", 8222: "\"", 8223: "\"", 8224: "+", 8225: "+", 8226: "-", 8227: "-", 8230: "...",
    8249: "'", 8250: "'", 228: "ae", 246: "oe", 252: "ue",
}
# the same by character, in the order of the code points
FOLDED = {chr(point): text for point, text in sorted(FOLDING.items())}
