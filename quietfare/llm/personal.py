"""Personal information in free text: anchor expansion.

One Aho-Corasick pass over the (folded) text finds *anchors*: at-signs and their
written-out forms, mail schemes, masks, digits, identifier cues such as ``ssn`` or
``plate``, street words, titles, name cues and given names. A local parser per
kind of anchor then expands each to the end of its own grammar, however long,
validates it (checksum, group lengths, digit counts, capitals) and gives the
boundaries. Names that no list holds are found by their frame: verbs that people
are the subject of, cues and titles, a contact beside them, a name they are
coordinated with, and surnames by script. Overlaps go to the kind that is surer.
Folding keeps one character per character, so offsets are those of the text. Runs
of a text that several anchors share are parsed once, so the cost is linear in
the text's length.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietfare.llm.flatmap import text_rows
from quietfare.schemas import SPANS

TYPES = ("EMAIL_ADDRESS", "VEHICLE_VIN", "CREDIT_CARD", "ID_NUMBER", "TLC_LICENSE", "PHONE_NUMBER", "NY_PLATE", "LOCATION", "PERSON")

# Word lists of the anchors.
AT_FORMS = ["@", "＠", "(at)", "[at]", "{at}", " at ", "(arroba)", " arroba "]
VIN_CUES = ["vin", "chassis", "vehicle identification"]
SSN_CUES = ["ssn", "social", "social security", "w-9", "itin"]
PASSPORT_CUES = ["passport", "passeport", "pasaporte", "reisepass", "паспорт", "护照", "paszport"]
STATE_ID_CUES = ["state id", "id", "id card", "identity card", "license", "licence", "driver license", "driver's license", "dni"]
TLC_CUES = ["tlc", "hack license", "hack", "medallion", "badge", "tlc license", "tlc lic"]
PLATE_CUES = ["plate", "tag", "license plate", "plates", "matrícula", "номер машины", "车牌"]
NOT_A_PHONE = ["order", "confirmation", "receipt", "auth", "odometer", "invoice", "case", "batch", "ticket", "ref", "trip", "promo"]
DIGIT_WORDS = ["zero", "oh", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
STREET_ENDS = ["street", "st", "avenue", "ave", "road", "rd", "boulevard", "blvd", "place", "pl", "court", "ct", "terrace", "ter", "lane", "ln", "drive", "dr", "parkway", "pkwy", "way", "highway", "hwy", "alley", "plaza", "crescent", "close"]
STREET_STARTS_ES = ["calle", "c/", "av.", "avda.", "avenida", "paseo", "plaza", "carrera", "camino", "ronda"]
STREET_STARTS_AFTER = ["via", "viale", "piazza", "corso", "vicolo", "largo", "rua", "travessa", "praça", "alameda", "ul.", "al.", "os.", "pl.", "ulica", "aleja", "ул.", "улица", "пр.", "проспект", "пер.", "am", "an der", "auf der", "zum", "zur", "unter den", "im"]
STREET_TAILS = ["straße", "strasse", "str.", "gasse", "allee", "platz", "ring", "ufer", "damm", "chaussee", "straat", "laan", "gracht", "plein", "kade", "gatan", "vägen", "gade", "vej", "veien", "katu", "tie"]
STREET_STARTS_FR = ["rue", "avenue", "av.", "bd", "bd.", "boulevard", "allée", "allee", "place", "chemin", "quai", "impasse", "cours"]
ADDRESS_CUES = ["at", "near", "outside", "lives", "of", "to", "addr:", "address:", "address", "from", "was at", "|", "opposite", "behind", "in", "by"]
TITLES = ["mr", "mrs", "ms", "miss", "dr", "mx", "prof", "sr", "sra", "srta", "mme", "mlle", "herr", "frau", "г-н", "г-жа"]
NAME_CUES = [
    "name:", "name on file", "named", "spelled", "rider", "claimant", "ask for", "neighbor (", "neighbour (", "caller:", "c/o", "witness", "operator is", "seems to be",
    "se llama", "pasajera", "pasajero", "client", "cliente", "cliente:", "passager", "passagère", "rappeler", "reached", "blocked by", "closed for", "opened by", "noted,",
    "wife (", "husband (", "only", "its", "it's", "i am", "i'm", "this is", "->", "owner is", "signed by", "contact", "agent", "driver", "passenger", "from", "for", "per", "fwd:", "riders,",
]
HAN_CUES = ["乘客", "旅客", "顾客", "客户", "车主", "失主", "联系人", "姓名:", "姓名：", "司机", "审核员"]
HAN_STOPS = ["要求", "邮箱", "电话", "表示", "投诉", "反映", "来电", "询问", "希望", "请求", "提供", "声称", "等候", "等了", "没", "未到", "迟到", "取消", "的", "说", "称", "在", "已", "问", "打", "是"]
PARTICLES = ["van", "von", "de", "der", "den", "del", "della", "di", "da", "dos", "du", "la", "le", "bin", "ibn", "ben", "al", "el", "st"]
SUFFIXES = ["Jr", "Sr", "II", "III", "IV", "Esq", "PhD"]
#: Given names that are also words: alone in lower case they need a cue.
WORD_NAMES = ["april", "art", "bill", "chase", "clay", "dawn", "daisy", "faith", "frank", "grace", "grant", "heath", "hope", "iris", "ivy", "jack", "joy", "june", "lily", "mark", "may", "miles", "noor", "pat", "pearl", "ray", "rich", "rob", "rose", "ruby", "sandy", "sky", "summer", "sunny", "violet", "will", "wade"]
GIVEN_NAMES = [
    "adaeze", "ahmed", "aisha", "alejandro", "alexander", "ali", "alice", "amara", "ana", "andrew", "anna", "anouk", "anselm", "anthony", "bastien", "beatriz", "ben", "camila", "carlos", "casimir",
    "catherine", "charles", "chiara", "colm", "daniel", "david", "delphine", "dmitri", "elena", "elif", "elizabeth", "emeka", "emily", "emma", "fatima", "farida", "fernando", "francesca", "george", "greta",
    "hannah", "hassan", "hiro", "ibrahim", "idris", "ilse", "ines", "isabella", "ivan", "jacob", "james", "javier", "jane", "john", "jonas", "joon", "jose", "joseph", "karen", "keiko",
    "kwame", "laura", "leif", "linda", "linnea", "lucan", "lucia", "luis", "maria", "marie", "marisol", "mary", "mateo", "matthew", "mehmet", "michael", "miguel", "mohammed", "nadia", "ngozi",
    "nina", "olga", "oren", "ottilie", "paloma", "patricia", "paul", "pedro", "peter", "petra", "piotr", "priya", "rashid", "ravi", "rebecca", "renzo", "robert", "salome", "samuel", "sarah",
    "sofia", "soraya", "sunniva", "susan", "tamsin", "tariq", "thomas", "thuy", "tobias", "viktor", "wanda", "wei", "william", "yuki", "yusra", "zainab",
]
#: Words that end a name although they could look like one.
NOT_NAMES = ["the", "and", "not", "for", "was", "were", "has", "had", "have", "is", "are", "asks", "says", "said", "can", "could", "tried", "wants", "want", "rides", "ride", "on", "in", "at", "to", "by", "of", "with", "fixed", "rude", "music", "from", "but", "who", "will", "would", "did", "does", "split", "note", "test", "team", "grant", "summer", "chase", "may", "rose", "booked", "called", "left", "got", "or", "no", "new", "old", "day", "night", "a", "an", "it", "he", "she", "they", "we", "you", "i", "this", "that"]

#: Verbs and states whose subject is a person: two capitalised words right before one are a name.
SUBJECT_VERBS = [
    "says", "said", "wants", "wanted", "asks", "asked", "called", "calls", "complains", "complained", "reports", "reported", "left", "lost", "forgot", "requests", "requested", "claims", "claimed", "wrote", "writes", "states", "stated",
    "texted", "emailed", "phoned", "rang", "thanked", "thanks", "disputes", "disputed", "cancelled", "canceled", "booked", "was", "is", "has", "had", "would", "could", "will", "can", "does", "did", "needs", "needed", "thinks", "believes", "paid", "tipped", "waited", "waits",
    "refused", "refuses", "insists", "insisted", "told", "tells", "tried", "met", "saw", "felt", "went", "came", "got", "took", "sent", "signed", "replied", "responded", "confirmed", "confirms", "denied", "denies", "apologised", "apologized", "lives", "works", "drove", "drives", "rude", "noted", "explained", "mentioned", "and", "split",
    "pide", "dice", "dijo", "quiere", "llamó", "reclama", "perdió", "solicita", "demande", "dit", "veut", "appelle", "réclame", "souhaite", "möchte", "sagt", "sagte", "verlangt", "bittet", "fragt", "chiede", "dice", "vuole", "prosi", "mówi", "chce", "pede", "disse", "quer",
]
#: Verbs and words that a person follows.
OBJECT_CUES = ["refunded", "spoke with", "spoke to", "talked to", "talked with", "met", "met with", "contacted", "called", "emailed", "texted", "told", "asked", "thank", "thanks to", "dear", "hello", "hi", "regards,", "sincerely,", "signed,", "passenger", "customer", "guest", "complaint from", "message from", "call from", "mail from", "behalf of", "name is", "account of", "señor", "señora", "sig.", "signor", "signora", "pan", "pani", "senhor", "senhora"]
#: Words that are no part of a personal name: roles, organisations, days, months, and openers of a sentence.
ROLES = {"rider", "riders", "driver", "drivers", "passenger", "customer", "client", "agent", "guest", "caller", "owner", "witness", "neighbor", "neighbour", "operator", "claimant", "member", "contact", "user", "cliente", "pasajera", "pasajero", "passager", "chauffeur", "fahrer", "per", "dear", "hello", "hi", "fwd", "re", "from", "attn", "note", "yesterday", "today", "when", "then", "after", "because", "while", "also", "but", "if", "mr", "mrs", "ms", "miss", "dr", "mx", "prof"}
ORGANISATIONS = {"phone", "email", "car", "wallet", "keys", "bag", "umbrella", "laptop", "desk", "team", "support", "office", "department", "dept", "service", "services", "control", "dispatch", "bank", "company", "inc", "llc", "ltd", "corp", "gmbh", "group", "union", "police", "insurance", "taxi", "cab", "cabs", "limousine", "fleet", "base", "property", "app", "card", "visa", "account", "id", "plate", "license", "licence", "passport", "state", "city", "zone", "trip", "ride", "promo", "surge", "invoice", "order", "receipt", "claim", "ticket", "form", "report", "policy", "page", "meter", "toll", "fare", "fee", "tax", "lost", "found", "customer", "care", "help", "center", "centre", "authority", "commission", "council", "board", "lobby", "room", "suite", "gate", "lounge", "restaurant", "cafe", "bar", "museum", "library", "theater", "theatre", "stadium", "arena", "mall", "church", "clinic", "pharmacy", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "january", "february", "march", "april", "june", "july", "august", "september", "october", "november", "december", "new", "york", "san", "los", "saint", "fort", "mount", "united", "states", "english", "spanish", "french", "german", "airlines", "airways", "express", "bus", "train", "line", "metro", "version", "data", "system", "server", "column", "table", "export", "import", "manual", "section", "chapter", "appendix", "please", "thank", "thanks", "good", "morning", "evening", "afternoon", "best", "regards", "kind"}
#: Adverbs and the like that follow a cue in place of a name.
ADVERBS = {"very", "so", "quite", "really", "too", "still", "just", "out", "always", "never", "now", "there", "here", "also", "only", "all", "more", "less", "almost", "already", "again", "about", "being", "going", "unable", "willing", "happy", "unhappy", "angry", "upset", "late", "early", "please", "please,", "help", "me", "him", "her", "them", "us", "my", "your", "his", "their", "our", "its", "some", "any", "each", "every", "one", "two"}
ROLE_CUES = {"pasajera", "pasajero", "le client", "client", "cliente"}
LOWER_CUES = {"se llama", "name:", "name on file", "named", "ask for", "neighbor (", "neighbour (", "wife (", "husband (", "caller:", "operator is", "seems to be", "owner is", "signed by", "spelled", "noted,", "name is", "opened by", "closed for", "blocked by", "fwd:", "riders,"}
#: Family names that begin a name in Han and Hangul.
HAN_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔汤張劉陳楊黃趙吳馬羅鄭謝許韓馮鄧葉蘇魏呂盧鍾譚陸"
HANGUL_FAMILY = "김이박최정강조윤장임한오서신권황안송전홍유고문양손배백허남심노하곽성차주우구민진지엄채원천방공현함변염여추도소석선설마길연위표명기반왕금옥육인맹제모탁국어은편용"

_DASHES = dict.fromkeys(map(ord, "‐‑‒–—−﹣－"), "-")


def fold(text: str) -> str:
    """``text`` with full-width characters, dashes and unusual spaces as their plain forms, one for one."""
    if text.isascii():
        return text
    out = []
    for c in text:
        if c < "\x80":
            out.append(c)
        elif ord(c) in _DASHES:
            out.append("-")
        elif c.isspace():
            out.append(" " if c not in "  \x85" else "\n")
        else:
            plain = unicodedata.normalize("NFKC", c) if "＀" <= c <= "￯" else str(unicodedata.digit(c)) if c.isdigit() and unicodedata.digit(c, None) is not None else c
            out.append(plain if len(plain) == 1 else c)
    return "".join(out)


def lower(text: str) -> str:
    """Lower case, one character for one."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _alternatives(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


_LOCAL = re.compile(r"[\w.+%'’-]*\w$")
_DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\spunto\s)"
_DOMAIN = re.compile(rf"\s?([A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}})(?![A-Za-z0-9-])")
_WORD_DOT = re.compile(r"dot|punto", re.I)
_MASK = re.compile(r"(?:[*•xX●]{4}[- ]?){1,3}\d{4}(?!\d)")
_CARD = re.compile(r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)|\d{4}([ -]?)\d{6}\2\d{5}(?!\d)")
_SSN = re.compile(r"\d{3}([-. ])\d{2}\1\d{4}(?![\d-])")
_PLAIN9 = re.compile(r"\d{9}(?!\d)")
_PASSPORT = re.compile(r"[A-Za-z]{0,2}\d{7,9}(?!\w)")
_STATE_ID = re.compile(r"[A-Za-z]\d{3}-\d{4}-\d{4}(?![\w-])|[A-Za-z]\d{7,14}(?!\w)|\d{3}([ -])\d{3}\1\d{3}(?![\w-])|\d{9}(?!\w)")
_TLC = re.compile(r"\d{5,8}(?!\w)")
_PLATE = re.compile(r"[A-Za-z]{3}[- ]?\d{4}(?!\w)|[A-Za-z]\d{6}[A-Za-z](?!\w)")
_SURE_PLATE = re.compile(r"(?<![\w-])(?:[A-Z]{3}-\d{4}|T\d{6}C)(?![\w-])")
_EXTENSION = r"(?:,?\s?(?:ext\.?|extension|x|доб\.?|poste|int\.)\s?\d{1,6}(?!\d))?"
_PHONES = [
    re.compile(rf"\+1[ .\-/]?(?:\(\d{{3}}\)\s?|\d{{3}}[ .\-/]?)\d{{3}}[ .\-/]?\d{{4}}(?!\d){_EXTENSION}", re.I),
    re.compile(rf"\+(?!1\D)\d{{1,3}}(?:[ .\-/]?\(?\d{{1,4}}\)?)(?:[ .\-/]?\d{{2,8}}){{1,5}}(?!\d){_EXTENSION}", re.I),
    re.compile(rf"(?:1[ .\-]?)?(?:\(\d{{3}}\)\s?|\d{{3}}[ .\-/]?)\d{{3}}[ .\-/]?\d{{4}}(?!\d){_EXTENSION}", re.I),
    re.compile(rf"\d{{3}}([ .\-])\d{{3}}\1\d{{2}}\1\d{{2}}(?!\d){_EXTENSION}", re.I),
]
_SPOKEN = re.compile(rf"(?:(?:double |triple )?(?:{_alternatives(DIGIT_WORDS)})(?:[ ,-]+(?=(?:double |triple )?(?:{_alternatives(DIGIT_WORDS)})\b)|\b)){{7,15}}", re.I)
_UNIT = r"(?:,? (?:(?i:apt|unit|suite|ste|fl|floor|room|rm)\b\.?|#) ?#? ?(?:\d+-?[A-Za-z]?|[A-Za-z]\d*)(?!\w))?"
_NUMBER = r"\d{1,5}[A-Za-z]?(?:-\d{1,3}[A-Za-z]?)?"
_STREET = re.compile(
    rf"{_NUMBER} (?:(?:east|west|north|south|e|w|n|s)\.? )?(?:(?!(?:{_alternatives(STREET_ENDS)})\b)[^\W\d_][\w'’.-]*? |\d{{1,3}}(?:st|nd|rd|th) ){{1,3}}?(?:{_alternatives(STREET_ENDS)})\b(?:(?<=\brd)\.|(?:(?<=\bst)|(?<=\bave))\.(?! (?-i:[A-ZÀ-Þ]))|\.(?=,? (?-i:[a-z#])|, ))?{_UNIT}", re.I,
)
_BARE_STREET = re.compile(rf"{_NUMBER} [A-Z][a-zà-ÿ'’]{{2,}}(?: (?!(?:Unit|Apt|Suite)\b)[A-Z][a-zà-ÿ'’]{{3,}}(?=,? (?:#|Apt|Unit)))?{_UNIT}(?![\w-])")
_BARE_LOWER = re.compile(rf"{_NUMBER} (?:[a-zà-ÿ'’]{{4,}}|[A-ZÀ-Þ'’]{{4,}}){_UNIT}(?=[,.;|\n]|$)", re.I)
_ES = re.compile(rf"(?:{_alternatives(STREET_STARTS_ES)}) ?(?:de la |de los |del |de )?[^\W\d_][\w'’-]*(?: [^\W\d_][\w'’-]*)?,? (?:(?:núm|num|nº|no)\.? ?)?\d{{1,5}}[A-Za-z]?(?!\w)(?:, (?:piso|apto|puerta)\.? \w+)?", re.I)
_FR = re.compile(rf"\d{{1,4}}(?: (?:bis|ter|quater))?,? (?:{_alternatives(STREET_STARTS_FR)}) (?:de la |de l['’]|des |du |de |d['’])?[^\W\d_][\w'’-]*(?:[ -][A-ZÀ-Þ][\w'’-]*)?", re.I)

_CAP = r"(?:[A-ZÀ-ÞĀ-Ž][\w'’]*(?:-[A-ZÀ-ÞĀ-Ž][\w'’]*)*)"
_PART = rf"(?:(?i:{_alternatives(PARTICLES)})(?:[ -]))"
_LAST = rf"(?:{_PART}{{0,2}}{_CAP}|al-{_CAP})"
_INITIAL = r"(?:[A-ZÀ-Þ]\.(?:-?[A-ZÀ-Þ]\.)*)"
_SUFFIX = rf"(?:,? (?:(?:Jr|Sr|Esq)\b\.?|(?:{'|'.join(SUFFIXES)})\b))?"
_LOWWORD = r"(?:[a-zà-ÿ][\w'’]+(?:-[a-zà-ÿ][\w'’]*)*)"
_CYR = r"(?:[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?)"
_CYR_NAME = re.compile(rf"{_CYR} [А-ЯЁ]\. ?(?:[А-ЯЁ]\.)?|[А-ЯЁ]\. ?(?:[А-ЯЁ]\. ?)?{_CYR}|{_CYR} {_CYR}(?: {_CYR})?")
_AFTER_GIVEN = re.compile(rf"(?:-{_CAP})?(?: {_INITIAL})?(?: {_LAST}){_SUFFIX}")
_INITIAL_NAME = re.compile(rf"{_INITIAL} (?:{_INITIAL} )?{_LAST}{_SUFFIX}")
_TWO_CAPS = re.compile(rf"{_CAP}(?: {_INITIAL})? {_LAST}{_SUFFIX}|{_LAST}, {_CAP}(?: {_INITIAL})?{_SUFFIX}")
_ONE_CAP = re.compile(rf"(?:{_INITIAL} )?{_LAST}{_SUFFIX}")


_FULL_NAME = re.compile(rf"{_CAP}(?: {_INITIAL})*(?: {_CAP}){{0,2}} {_LAST}{_SUFFIX}|{_LAST}, {_CAP}(?: {_INITIAL})*{_SUFFIX}|{_INITIAL} (?:{_INITIAL} )*{_LAST}{_SUFFIX}")
_INITIALS = re.compile(r"(?:[A-ZÀ-Þ]\.[ -]?)+")
_MORE = re.compile(rf"(?: {_INITIAL})? {_LAST}{_SUFFIX}")
_SURNAME = re.compile(rf"{_CAP}|al-{_CAP}")
_LAST_CAP = re.compile(rf"({_CAP}){_SUFFIX}$")
_AFTER_FIRST = re.compile(rf"(?: {_INITIAL})?{_SUFFIX}")
_AFTER_LOWER = re.compile(rf"(?: [a-z]\.)?(?: {_PART}{{0,2}}({_LOWWORD}|al-{_LOWWORD}))(?:,? (?:jr|sr|ii|iii|iv)\b\.?)?")
_VERBS = set(SUBJECT_VERBS)
_LOW_FULL = rf"[\s:(]*({_LOWWORD}(?: [a-z]\.)? (?:{_PART}{{0,2}}){_LOWWORD}(?:,? (?:jr|sr|ii|iii|iv)\b\.?)?)"
_LOWER_NAME = re.compile(rf"{_LOW_FULL}(?=\s*(?:[,.;:)|\n<(/]|$)| (?:{_alternatives([*SUBJECT_VERBS, 'not', 'y', 'et', 'und', 'w/'])})(?!\w))")
_LOWER_SUBJECT = re.compile(rf"{_LOW_FULL}(?= (?:{_alternatives([v for v in SUBJECT_VERBS if v != 'and'])})(?!\w))")
_TO_NAME = re.compile(r"[\s:(\"“«]*(?:(?:Mr|Mrs|Ms|Dr|Prof|Sr|Sra|Mme|M)\.? )?")
_JOINED = re.compile(r",? (?:and|not|or|&|y|e|et|und|oder|i|и) |, ")
_RUN = re.compile(r"[\w'’-]+")
_ALNUM = re.compile(r"[A-Za-z0-9]+")
_CLAUSE = re.compile(r"[;!?\n]|\.(?:\s|$)|\b(?i:vin|chassis)\b")
_VIN_START = re.compile(r"(?<![\w-])(?=[A-Za-z]*\d|[A-Za-z]+[ -])[A-HJ-NPR-Za-hj-npr-z0-9]{2,17}")
_VIN_GROUPS = re.compile(r"[A-Za-z0-9]{2,17}(?:[ -][A-Za-z0-9]{2,14}){0,7}")
_HOUSE = re.compile(r"\d{1,5}(?: ?[a-zA-Z](?!\w))?(?:[/-]\d{1,4}[a-zA-Z]?)?(?![\w%]| (?:янв|фев|мар|апр|мая|июн|июл|авг|сен|окт|ноя|дек))")
_PO_BOX = re.compile(r"(?i:(?<!\w)p\.? ?o\.? ?box|apartado(?: postal)?|postfach|boîte postale|casella postale|skrytka pocztowa)(?: (?i:no)\.?)? \d{1,6}(?!\w)")
_GERMAN_STARTS = {"am", "im", "zum", "zur"}
_GREEK_NAME = re.compile(r"[Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+(?:-[Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+)? [Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+(?: [Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+)?")
_HAN_NAME = re.compile(rf"(?<![一-鿿])[{HAN_FAMILY}][一-鿿]{{1,2}}?(?=先生|女士|小姐|说|說|称|稱|投诉|投訴|表示|打来|打電|要求|询问|反映|来电|[^一-鿿\w]|$)")
_HANGUL_NAME = re.compile(rf"(?:(?<=고객 )|(?<=승객 )|(?<=기사 )|(?<=손님 )|(?<![가-힣]))[{HANGUL_FAMILY}][가-힣]{{2}}(?= ?(?:씨|님)(?![가-힣]{{2}}))|(?:(?<=고객 )|(?<=승객 )|(?<=기사 )|(?<=손님 ))[{HANGUL_FAMILY}][가-힣]{{2}}(?=[이가은는을를]?(?![가-힣]))|(?m:^)[{HANGUL_FAMILY}][가-힣]{{2}}(?m:$)")
_TITLED = re.compile(r"(?:السيدة|السيد|الآنسة|श्रीमती|श्री|सुश्री|জনাব|محترم)\s+([^\W\d_]\w*(?:\s[^\W\d_]\w*)?)(?=\s*[,.;:!?،।]|\s*$|\s)")


@lru_cache(maxsize=16)
def _filler(words: str) -> re.Pattern:
    return re.compile(rf"(?:\s?(?:no|number|num|nr|card|is|on|the|file|reads|of|by|license|licence|lic|id|security|seria|серия|номер|№|#{words})\b\.?|[\s:#.,()\-№])*", re.I)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    kinds: dict[str, list[str]] = {}
    lists = {
        "at": AT_FORMS, "scheme": ["mailto:"], "vin": VIN_CUES, "ssn": SSN_CUES, "passport": PASSPORT_CUES, "state": STATE_ID_CUES, "tlc": TLC_CUES,
        "plate": PLATE_CUES, "mask": ["****", "••••", "xxxx", "●●●●"], "digit": list("0123456789"), "spoken": DIGIT_WORDS, "es": STREET_STARTS_ES,
        "initial": [". "], "title": TITLES, "cue": NAME_CUES + OBJECT_CUES, "verb": SUBJECT_VERBS, "han": HAN_CUES, "given": GIVEN_NAMES + WORD_NAMES,
    }
    for kind, words in lists.items():
        for word in words:
            kinds.setdefault(word, []).append(kind)
    found = ahocorasick.Automaton()
    for word, of in kinds.items():
        found.add_word(word, (word, tuple(of)))
    found.make_automaton()
    return found


def _whole(low: str, start: int, end: int) -> bool:
    """Whether start:end isn't part of a longer word on a side where it begins or ends with a letter."""
    joined = lambda a, b: a.isalnum() and b.isalnum() and a < "⺀" and b < "⺀"  # noqa: E731 - Han needs no blank
    before = start > 0 and joined(low[start - 1], low[start])
    after = end < len(low) and joined(low[end - 1], low[end])
    return not before and not after


class _Reader:
    """Parsers over one text; every parser returns a span or None."""

    def __init__(self, text: str):
        self.plain = fold(text)
        self.low = lower(self.plain)
        self.spans: dict[str, list[tuple[int, int]]] = {t: [] for t in TYPES}
        self.last_token = (0, 0)
        self.fillers: dict[str, tuple[int, int]] = {}
        self.tried: set[int] = set()
        self.initials_end = 0
        runs = [m.span() for m in _RUN.finditer(self.plain)]
        self.run_starts, self.run_ends = [a for a, _ in runs], [b for _, b in runs]

    def add(self, kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] < span[1]:
            self.spans[kind].append(span)

    def email(self, start: int, end: int, form: str) -> tuple[int, int] | None:
        plain = self.plain
        stop = start - 1 if start and plain[start - 1] == " " else start
        begin = stop
        while begin and (plain[begin - 1].isalnum() or plain[begin - 1] in "_.+%'’-"):
            begin -= 1
        domain = _DOMAIN.match(plain, end)
        if begin == stop or not (plain[stop - 1].isalnum() or plain[stop - 1] == "_") or not domain:
            return None
        if form.strip().isalpha() and not _WORD_DOT.search(domain.group(1)):
            return None  # "at" between words is an address only with a written-out dot
        while plain[begin] in ".'’-+%":
            begin += 1
        return begin, domain.end(1)

    def vin(self, end: int) -> tuple[int, int] | None:
        """Seventeen characters in one or more groups behind a cue, in the same clause and before the next cue."""
        for m in _VIN_START.finditer(self.plain, end, self.clause_end(end)):
            begin = m.start()
            tokens = _VIN_GROUPS.match(self.plain, begin)
            if not tokens:
                continue
            size, at = 0, begin
            for part in _ALNUM.finditer(self.plain, begin, tokens.end()):
                word = part.group()
                if re.search(r"[IOQioq]", word) or (size and word.islower() and not any(c.isdigit() for c in word)):
                    break
                size, at = size + len(word), part.end()
                if size >= 17:
                    break
            value = self.plain[begin:at]
            if size == 17 and sum(c.isdigit() for c in value) >= 1 and sum(c.isalpha() for c in value) >= 2 and not (at < len(self.plain) and self.plain[at].isalnum()):
                return begin, at
        return None

    def clause_end(self, at: int) -> int:
        m = _CLAUSE.search(self.plain, at)
        return m.start() if m else len(self.plain)

    def token(self, at: int) -> tuple[int, int]:
        """The run of letters and digits around ``at``; worked out once for all anchors in it."""
        if not self.last_token[0] <= at < self.last_token[1]:
            begin = end = at
            while begin > 0 and self.plain[begin - 1].isalnum():
                begin -= 1
            while end < len(self.plain) and self.plain[end].isalnum():
                end += 1
            self.last_token = begin, end
        return self.last_token

    def run(self, at: int) -> tuple[int, int]:
        """The run of name characters (letters, digits, apostrophes, hyphens) around ``at``, or an empty one."""
        i = bisect.bisect_right(self.run_starts, at) - 1
        return (self.run_starts[i], self.run_ends[i]) if i >= 0 and at < self.run_ends[i] else (at, at)

    def after_cue(self, end: int, pattern: re.Pattern, words: str = r"") -> tuple[int, int] | None:
        """The first match of ``pattern`` behind a cue, over nothing but small words and punctuation."""
        begin, at = self.fillers.get(words, (0, -1))
        if not begin <= end <= at:  # a cue inside a run of small words ends where the run ends
            m = _filler(words).match(self.plain, end)
            at = m.end() if m else end
            self.fillers[words] = end, at
        for place in sorted({at, *([at - 1] if at > end and self.plain[at - 1 : at].isalnum() else [])}):
            found = pattern.match(self.plain, place)
            if found and not (place > 0 and self.plain[place - 1].isalnum()):
                return found.span()
        return None

    def phone(self, at: int) -> tuple[int, int] | None:
        start = at
        if start > 0 and self.plain[start - 1] == "(":
            start -= 1
        if start > 1 and self.plain[start - 1] in " -." and start == at - 1 and self.plain[start - 2] == "1" and (start < 3 or not self.plain[start - 3].isalnum()):
            start -= 2
        if start > 0 and self.plain[start - 1] == "+":
            start -= 1
        before = self.plain[start - 1] if start else " "
        if before.isdigit() or (before.isascii() and before.isalpha()) or (before in ".-/" and start > 1 and self.plain[start - 2].isalnum()) or before in "$€£#":
            return None
        for pattern in _PHONES:
            m = pattern.match(self.plain, start)
            if m:
                digits = sum(c.isdigit() for c in re.split(r"(?i)e|x|д|p|i", m.group())[0])
                rest = self.plain[m.end() : m.end() + 2]
                if not 8 <= digits <= 15 or (len(rest) == 2 and rest[0] in "-/." and rest[1].isdigit()) or (rest[:1].isascii() and rest[:1].isalpha()):
                    continue
                words = re.findall(r"[a-z]+", self.low[max(0, start - 24) : start])
                if m.group().isdigit() and words and any(w in NOT_A_PHONE for w in words[-2:]):
                    return None
                return m.span()
        return None

    def street(self, at: int) -> tuple[int, int] | None:
        before = self.plain[at - 1] if at else " "
        if before.isalnum() or before in ".-/$€#:" or (before == "," and at > 1 and self.plain[at - 2].isdigit()):
            return None
        french = _FR.match(self.plain, at)
        if french:
            return french.span()
        number = _HOUSE.match(self.plain, at)
        if number:  # the number behind the street's name
            named = self.street_before(at)
            if named is not None:
                return named, number.end()
        lead = self.low[max(0, at - 24) : at].rstrip()
        cued = any(lead.endswith(w) and (not w[0].isalpha() or not lead[: -len(w)][-1:].isalpha()) for w in ADDRESS_CUES)
        m = _STREET.match(self.plain, at)
        if m:
            words = m.group().split()
            named = words[1][:1].isupper() or words[1][:1].isdigit() or cued
            last = re.match(r"\s*([A-Za-z]+)", self.plain[m.end() : m.end() + 16])
            if named and not (last and last.group(1).lower() in {"market", "rides", "square", "garage", "station"}):
                return m.span()
            return None
        if cued:
            m = _BARE_STREET.match(self.plain, at) or _BARE_LOWER.match(self.plain, at)
            word = re.split(r"[ ,]", m.group())[1].lower() if m else ""
            if m and word not in NOT_STREETS and word not in STREET_WORDS and not re.match(r" (?:vehicles|rides|miles)", self.low[m.end() : m.end() + 12]):
                return m.span()
        return None

    def street_before(self, at: int) -> int | None:
        """Where a street's name begins that ends right before a house number: its type is a first word (via, ul.) or the name's end (-straße)."""
        stop = at - 2 if self.plain[at - 2 : at] == ", " else at - 1 if self.plain[at - 1 : at] == " " else -1
        if stop < 1:
            return None
        begin, words = stop, 0
        while words < 4:
            dot = self.plain[begin - 1] == "." and begin > 1
            left, right = self.run(begin - 2 if dot else begin - 1)
            if left >= right:
                return None
            word = self.low[left:begin]
            if words == 0 and (word.endswith(tuple(STREET_TAILS)) and len(word) > 5) and self.plain[left].isupper():
                return left
            if words == 0 and word in ("straße", "strasse", "str.", "allee", "platz"):
                front = self.run(left - 2) if left > 1 and self.plain[left - 1] == " " else (0, 0)
                return front[0] if front[0] < front[1] and self.plain[front[0]].isupper() else None
            pair = f"{self.low[self.run(left - 2)[0] : left - 1]} {word}" if left > 1 and self.plain[left - 1] == " " else ""
            if words and (word in STREET_STARTS_AFTER or pair in STREET_STARTS_AFTER) and self.plain[right if right < begin else begin] in " .":
                first = begin + 1
                if self.plain[first : first + 1].isupper() and (word not in _GERMAN_STARTS or self.plain[left].isupper()):
                    return self.run(left - 2)[0] if pair in STREET_STARTS_AFTER else left
            if dot or left < 1 or self.plain[left - 1] != " ":
                return None
            begin, words = left - 1, words + 1
        return None

    def good_last(self, word: str) -> bool:
        return word.lower().strip(".,'’") not in NOT_NAMES and word.lower() not in PLACES and len(word) > 2

    def initials_before(self, at: int, most: int = 4) -> int:
        """Where up to ``most`` initials begin (``J.``, ``J.-P.``, ``J. P.``) that end right before ``at``, after one blank; else ``at``."""
        begin, i, n = at, at, 0
        while n < most and i > 2 and self.plain[i - 1] in " -" and self.plain[i - 2] == "." and self.plain[i - 3].isupper() and (i == 3 or not (self.plain[i - 4].isalnum() or self.plain[i - 4] in "'’")):
            begin = i = i - 3
            n += 1
        return begin

    def surname_before(self, stop: int) -> int | None:
        """Where a capitalised surname with its particles begins that ends at ``stop``."""
        left, right = self.run(stop - 1)
        if left >= right or right != stop or not _SURNAME.fullmatch(self.plain, left, stop):
            return None
        for _ in range(2):
            front = self.run(left - 2) if left > 1 and self.plain[left - 1] == " " else (0, 0)
            if front[0] < front[1] and self.low[front[0] : front[1]] in PARTICLES:
                left = front[0]
        return left

    def given(self, start: int, end: int, cued: bool) -> tuple[int, int] | None:
        """A name from a given name: hyphenated, with initial, surname and suffix, or 'Last, First'."""
        plain = self.plain
        word = plain[start:end]
        if plain[start - 1 : start] in ("'", "’", "@", "_", ".", "+") and self.initials_before(start) == start and not (plain[start - 1] == "." and plain[max(0, start - 2) : start - 1].isupper()):
            return None
        if plain[end : end + 1] in ("@", "_", "'", "’") and plain[end : end + 2] not in ("'s", "’s"):
            return None
        begin, chain = self.run(start)
        if begin < start and plain[start - 1] != "-":
            begin = start
        if plain[end : end + 1] != "-":
            chain = end
        if begin in self.tried:  # one parse for all given names of a hyphenated one
            return None
        self.tried.add(begin)
        if begin > 0 and plain[begin - 1] in "_.+" and begin < start:
            return None
        capital = plain[begin].isupper() and word[:1].isupper()
        if not capital:
            low = _AFTER_LOWER.match(plain, chain)
            if plain[begin].isupper() or not low or not self.good_last(low.group(1)) or (word in WORD_NAMES and not cued):
                return None
            return begin, self.trim(low.end())
        m = _AFTER_GIVEN.match(plain, chain)
        if m:
            last = _LAST_CAP.search(m.group())
            core = last.group(1) if last else m.group().split()[-1]
            next_is_given = lower(core) in _GIVEN
            if self.good_last(core) or next_is_given:
                ends = m.end()
                if next_is_given:
                    more = _MORE.match(plain, ends)
                    if more and self.good_last(more.group().split()[-1]):
                        ends = more.end()
                return self.initials_before(begin), self.trim(ends)
        before = self.surname_before(begin - 2) if plain[begin - 2 : begin] == ", " else None
        if before is not None and self.good_last(plain[before : begin - 2]):
            tail = _AFTER_FIRST.match(plain, chain)
            return before, self.trim(tail.end() if tail else chain)
        return None

    def han(self, end: int) -> tuple[int, int] | None:
        """The Han name behind a cue: two to four characters up to a mark or a word that can't belong to it."""
        name = re.compile(r"[一-鿿]{2,6}").match(self.plain, end)
        if not name:
            return None
        value = name.group()
        size = min([i for i in (value.find(w) for w in HAN_STOPS) if i >= 0] + [len(value)])
        return (end, end + size) if 2 <= size <= 4 else None

    def initialled(self, dot: int) -> tuple[int, int] | None:
        """An initial with a surname, from the initial's dot."""
        plain = self.plain
        if not dot or not plain[dot - 1].isupper() or (dot > 1 and (plain[dot - 2].isalnum() or plain[dot - 2] in "'’")):
            return None
        if dot < self.initials_end:
            return None  # in a row of initials that was parsed from its first
        row = _INITIALS.match(plain, dot - 1)
        if not row:
            return None
        self.initials_end = row.end()
        at = self.initials_before(self.initials_end, 2) if plain[self.initials_end - 1] == " " else dot - 1
        if at and plain[at - 1] in ".-":
            return None
        found = _INITIAL_NAME.match(plain, at)
        if not found:
            return None
        before = self.run(at - 2) if at > 1 and plain[at - 1] == " " else (0, 0)
        after = re.match(r" ?([A-Za-z]+)", plain[found.end() : found.end() + 16])
        words = re.findall(r"[\w'’-]{2,}", found.group())
        if plain[before[0] : before[1]][:1].isdigit() or (after and after.group(1).lower() in STREET_ENDS) or any(lower(w) in PLACES or lower(w) in NOT_NAMES for w in words):
            return None
        return found.start(), self.trim(found.end())

    def is_name(self, begin: int, end: int) -> bool:
        """Whether begin:end reads as a full name of which no word is known to be none."""
        words = [w for w in re.findall(r"[^\W\d_][\w'’]*", self.low[begin:end]) if len(w) > 1 and w not in PARTICLES and w not in _SUFFIX_WORDS]
        return bool(words) and not any(w in PLACES or w in ROLES or w in ORGANISATIONS or w in NOT_STREETS or (w in NOT_NAMES and w not in _GIVEN) for w in words)

    def name_before(self, stop: int) -> tuple[int, int] | None:
        """The capitalised name that ends at ``stop``: two to four words with initials, particles and suffix, or 'Last, First'."""
        plain, at, words, comma = self.plain, stop, [], False
        while at > 0 and len(words) < 7:
            end = at
            dot = plain[at - 1] == "."
            left, right = self.run(at - 2 if dot else at - 1)
            if left >= right or right != at - dot:
                break
            word = plain[left:right]
            name_like = word[:1].isupper() or (word.lower() in PARTICLES and words) or word.startswith("al-") or word.lower() in _SUFFIX_WORDS
            if not name_like or (dot and not (len(word) == 1 or word.lower() in _SUFFIX_WORDS)) or any(c.isdigit() for c in word) or "_" in word:
                break
            if words and word.lower() in ROLES:
                break
            words.append((left, end))
            if left > 1 and plain[left - 1] == " " and plain[left - 2] == "," and not comma and word.lower() not in _SUFFIX_WORDS:
                at, comma = left - 2, True
            elif left > 2 and plain[left - 1] == " " and plain[left - 2] == "," and word.lower() in _SUFFIX_WORDS:
                at = left - 2
            elif left > 0 and plain[left - 1] == " ":
                at = left - 1
            else:
                break
        while words:
            begin = words[-1][0]
            whole = _FULL_NAME.fullmatch(plain, begin, stop)
            if whole and self.is_name(begin, stop):
                inner = [left for left, right in words[1:-1] if lower(plain[left:right]) in _GIVEN]
                return (inner[0] if inner and not comma else begin), self.trim(stop)  # a listed given name further on begins the name
            words.pop()
        return None

    def lower_name(self, at: int, pattern: re.Pattern = _LOWER_NAME) -> tuple[int, int] | None:
        """A name in lower case behind a cue that names somebody: two words up to a mark or to a verb of persons."""
        m = pattern.match(self.plain, at)
        if not m:
            return None
        words = re.findall(r"[^\W\d_][\w'’]*", m.group(1))
        if any(w in NOT_NAMES or w in PLACES or w in ADVERBS or w in ROLES or w in ORGANISATIONS or w in _VERBS or w in PARTICLES and i == 0 for i, w in enumerate(words)):
            return None
        return m.start(1), m.end(1)

    def owner(self, at: int) -> tuple[int, int] | None:
        """The name right before a contact: ``Name <mail>``, ``Name / phone``, ``Name | mail``, ``Name (phone``."""
        stop = at
        while stop and self.plain[stop - 1] in " <(/|,":
            stop -= 1
        gap = self.plain[stop:at]
        if not stop or len(gap) > 4 or not re.search(r"[<(/|]", gap):
            return None
        found = self.name_before(stop)
        if found:
            return found
        begin = max(self.plain.rfind(c, 0, stop) for c in "\n|:>") + 1  # a field of its own
        m = re.compile(rf"\s*({_LOWWORD}(?: [a-z]\.)? (?:{_PART}{{0,2}}){_LOWWORD})").fullmatch(self.plain, begin, stop) if stop - begin < 80 else None
        return m.span(1) if m and self.is_name(*m.span(1)) and not any(w in _VERBS or w in ADVERBS for w in m.group(1).split()) else None

    def trim(self, end: int) -> int:
        if self.plain[end - 2 : end] in ("'s", "’s"):
            return end - 2
        return end

    def named(self, end: int, strong: bool) -> tuple[int, int] | None:
        """A name right behind a cue or title."""
        m = _TO_NAME.match(self.plain, end)
        at = m.end()
        for pattern in ([_INITIAL_NAME, _TWO_CAPS, _ONE_CAP] if strong else [_INITIAL_NAME, _TWO_CAPS]):
            found = pattern.match(self.plain, at)
            if found:
                words = re.findall(r"[\w'’-]{2,}", found.group())
                if words and all(self.good_last(w) or lower(w) in _GIVEN or lower(w) in PARTICLES or lower(w) in _SUFFIX_WORDS for w in words) and not any(w.lower() in STREET_ENDS or w.lower() in NOT_STREETS for w in words):
                    return found.start(), self.trim(found.end())
        return None


NOT_EAST_NAMES = {"高速", "方便", "万一", "白天", "金额", "石头", "江边", "方向", "方式", "高兴", "马上", "何时", "任何", "于是", "余额", "钱包", "史上", "이것은", "정말로", "하지만", "그리고", "고객님", "기사님", "이상의", "주소는", "오늘은", "지금은", "요금이"}
_GREEK, _EAST = re.compile(r"[Α-ΩΆ-Ώ]"), re.compile(r"[一-鿿가-힣]")
_SUFFIX_WORDS = {w.lower() for w in SUFFIXES}
STREET_WORDS = {w.rstrip(".") for w in [*STREET_STARTS_FR, *STREET_STARTS_ES, *STREET_STARTS_AFTER, *STREET_ENDS]}
#: Second words of places, which end no personal name.
PLACES = set(STREET_ENDS) | {"yards", "market", "north", "south", "east", "west", "hill", "hills", "heights", "square", "terminal", "landing", "airfield", "airport", "bridge", "crossing", "basin", "flats", "slip", "gardens", "point", "station", "park", "garage", "island", "beach", "village", "county", "hotel", "hospital", "school", "university"}
NOT_STREETS = {"min", "minutes", "miles", "vehicles", "requests", "rides", "bags", "books", "hours", "usd", "am", "pm", "next", "people", "riders", "trips", "photo", "times", "days", "km", "terminal", "gate", "level", "airfield", "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"}
_GIVEN = set(GIVEN_NAMES) | set(WORD_NAMES)
_WEAK_CUES = {"from", "for", "per", "driver", "agent", "rider", "client", "contact", "passenger", "only", "its", "it's", "named", "spelled", "riders,", "fwd:", "->"}


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, type) of the personal values in a text, in order, without overlaps. None and empty texts have none."""
    if not text:
        return []
    r = _Reader(text)
    low, plain = r.low, r.plain
    cues_end: list[int] = []
    givens: list[tuple[int, int]] = []
    for last, (word, kinds) in _automaton().iter(low):
        end = last + 1
        start = end - len(word)
        for kind in kinds:
            if kind == "digit":
                if start and low[start - 1].isdigit():
                    continue
                begin, stop = r.token(start)
                if stop - begin == 17 and re.fullmatch(r"[A-HJ-NPR-Z0-9]{17}", plain[begin:stop]) and sum(c.isalpha() for c in plain[begin:stop]) > 2:
                    r.add("VEHICLE_VIN", (begin, stop))
                elif begin == start or not plain[begin].isascii():
                    card = _CARD.match(plain, start)
                    if card and 13 <= sum(c.isdigit() for c in card.group()) <= 19 and luhn(re.sub(r"\D", "", card.group())):
                        r.add("CREDIT_CARD", card.span())
                    ssn = _SSN.match(plain, start)
                    if ssn and not (start and plain[start - 1] in "-./+"):
                        r.add("ID_NUMBER", ssn.span())
                    r.add("PHONE_NUMBER", r.phone(start))
                    r.add("LOCATION", r.street(start))
                sure = _SURE_PLATE.match(plain, begin) or _SURE_PLATE.match(plain, max(0, start - 4))
                if sure and not re.search(rf"\b(?:{'|'.join(NOT_A_PHONE)})\W*$", low[max(0, sure.start() - 16) : sure.start()]):
                    r.add("NY_PLATE", sure.span())
            elif kind == "at":
                r.add("EMAIL_ADDRESS", r.email(start, end, word))
            elif kind == "mask":
                m = _MASK.match(plain, start)
                if m and not (start and plain[start - 1] in "*•xX●"):
                    r.add("CREDIT_CARD", m.span())
            elif kind == "han":
                r.add("PERSON", r.han(end))
            elif kind == "initial":
                r.add("PERSON", r.initialled(start))
            elif not _whole(low, start, end):
                continue
            elif kind == "vin":
                r.add("VEHICLE_VIN", r.vin(end))
            elif kind == "ssn":
                r.add("ID_NUMBER", r.after_cue(end, _SSN) or r.after_cue(end, _PLAIN9, "|w-9"))
            elif kind == "passport":
                r.add("ID_NUMBER", r.after_cue(end, _PASSPORT))
            elif kind == "state":
                if not re.search(r"(?:tlc|hack|medallion)\s*$", low[max(0, start - 12) : start]):
                    r.add("ID_NUMBER", r.after_cue(end, _STATE_ID))
            elif kind == "tlc":
                r.add("TLC_LICENSE", r.after_cue(end, _TLC))
            elif kind == "plate":
                r.add("NY_PLATE", r.after_cue(end, _PLATE))
            elif kind == "spoken":
                m = _SPOKEN.match(plain, start)
                if m:
                    r.add("PHONE_NUMBER", (m.start(), m.start() + len(m.group().rstrip(" ,-"))))
            elif kind == "es":
                m = _ES.match(plain, start)
                if m:
                    r.add("LOCATION", m.span())
            elif kind == "title":
                gap = re.compile(r"\.? ").match(plain, end)
                suffix = word == "sr" and start > 1 and plain[start - 1] == " " and r.surname_before(start - (2 if plain[start - 2] == "," else 1)) is not None
                if gap and not suffix and (plain[start].isupper() or "." in gap.group()):
                    cues_end.append(gap.end())
                    r.add("PERSON", r.named(gap.end(), True))
            elif kind == "cue":
                cues_end.append(end)
                found = r.named(end, False) if word not in _WEAK_CUES or plain[end : end + 1] == " " else None
                r.add("PERSON", found or (r.lower_name(end) if word in LOWER_CUES else r.lower_name(end, _LOWER_SUBJECT) if word in ROLE_CUES else None))
            elif kind == "verb":
                if start > 1 and plain[start - 1] == " ":
                    r.add("PERSON", r.name_before(start - (2 if plain[start - 2] in ",)" else 1)))
            elif kind == "given":
                givens.append((start, end))
    stops = set(cues_end)
    for start, end in givens:
        if not _whole(low, start, end):
            continue
        back = start
        while back > 0 and plain[back - 1] in " :(\"“«\n" and start - back < 4:
            back -= 1
        cued = back in stops or start in stops or (back > 0 and plain[back - 1] in ":(;|>")
        r.add("PERSON", r.given(start, end, cued))
    if re.search(r"[А-ЯЁ]", plain):
        for m in _CYR_NAME.finditer(plain):
            words = re.findall(r"[А-ЯЁа-яё-]{2,}", m.group())
            begins = m.start() == 0 or bool(re.search(r"[.!?]\s$|^$|\n$", plain[max(0, m.start() - 2) : m.start()]))
            if not begins or "." in m.group():
                if words and lower(words[0]) not in {"водитель", "пассажир", "пассажирка", "поездка"}:
                    r.add("PERSON", m.span())
    for m in _GREEK_NAME.finditer(plain) if _GREEK.search(plain) else ():
        r.add("PERSON", m.span())
    for pattern in (_HAN_NAME, _HANGUL_NAME) if _EAST.search(plain) else ():
        for m in pattern.finditer(plain):
            if m.group() not in NOT_EAST_NAMES:
                r.add("PERSON", m.span())
    for m in _TITLED.finditer(plain) if not plain.isascii() else ():
        r.add("PERSON", m.span(1))
    for m in _PO_BOX.finditer(plain) if "o" in low else ():
        r.add("LOCATION", m.span())
    for kind in ("EMAIL_ADDRESS", "PHONE_NUMBER"):
        for start, _ in r.spans[kind]:
            r.add("PERSON", r.owner(start))
    for kind in ("TLC_LICENSE", "ID_NUMBER", "NY_PLATE", "VEHICLE_VIN"):  # a record that an identifier heads
        for _, end in r.spans[kind]:
            if plain[end : end + 2] == ": ":
                r.add("PERSON", r.named(end + 2, False))
    seen, todo = set(), [e for _, e in r.spans["PERSON"]]
    while todo:  # names coordinated with a name
        end = todo.pop()
        joined = _JOINED.match(plain, end)
        if joined and end not in seen:
            seen.add(end)
            strong = joined.group() != ", "
            found = r.named(joined.end(), False) if strong else None
            found = found if found and r.is_name(*found) else r.lower_name(joined.end()) if strong else None
            if found:
                r.add("PERSON", found)
                todo.append(found[1])
    taken: list[tuple[int, int, str]] = []
    covered = bytearray(len(text))
    for kind in TYPES:
        longest = kind not in ("VEHICLE_VIN", "TLC_LICENSE", "NY_PLATE")
        for s, e in sorted(set(r.spans[kind]), key=lambda x: (x[0] - x[1], x[0]) if longest else x):
            if 1 not in covered[s:e]:
                covered[s:e] = b"\x01" * (e - s)
                taken.append((s, e, kind))
    return sorted(taken)


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span replaced by its type in brackets."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in spans:
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def personal_spans(df: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``start_char``, ``end_char``, ``entity_type``: a row per personal value of each row's whole text.

    Only ``keep`` and the text are read, and only rows with a non-empty text
    reach Python. Repeated rows give repeated results.
    """
    return text_rows(df, text, keep, find_spans, "start_char int, end_char int, entity_type string", [pa.int32(), pa.int32(), pa.string()])


def redact_column(df: DataFrame, text: str, name: str = "redacted") -> DataFrame:
    """``df`` with ``name``: the text with every personal value replaced by a placeholder of its type, all else unchanged; null for null."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([redact(t, find_spans(t)) for t in texts], dtype=object)

    return df.withColumn(name, F.when(F.length(text) > 0, clean(F.col(text))).otherwise(F.col(text)))


def note_detector(text: Column) -> Column:
    """The spans of a text column as ``SPANS``, each with score 1: a detector for :func:`quietfare.plans.export.export`, which finds names and whole cards too."""

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"entity_type": k, "start": a, "end": b, "score": 1.0} for a, b, k in find_spans(t)] for t in texts], dtype=object)

    return found(text)
