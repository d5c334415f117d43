"""Sentence boundaries across languages and scripts: a semi-Markov search over whole spans.

A text is first cut where layout leaves no choice (blank lines, headings, list
items, lines that were not merely wrapped). Inside such a block every place that
could end a sentence is a candidate: behind end marks of any script with their
closing quotes, brackets and emoji, and at spaces in scripts that write no end
marks. Dynamic programming then selects the sequence of spans with the best sum
of span scores. A span is scored as a whole:

* its closing words: the kind of end mark, abbreviations, initials, ordinals,
* the opening words of what follows: capitals, openers and continuers,
* quotations and brackets: each that it leaves open, or ends inside of, costs,
* its length in characters, weighed by how dense its script is: fragments cost,
  and so do spans longer than sentences are, the more the longer, so that long
  runs without clear ends are split at the best of their unclear ones.

No end but one inside a number or an address is ruled out before the search. The
search is exact: a span's score is never above 0, which lets it stop looking back
as soon as nothing older can win; of spans beyond ``FAR`` the length costs the
same for every further character, so that one best start per state of the
quotations stands for all of them. The cost is linear in the text.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quietfare.llm.flatmap import text_rows

#: Weighed characters: shorter and longer spans cost; beyond FAR each character costs SLOPE.
SHORT, LONG, FAR, SLOPE = 22.0, 170.0, 700.0, 0.004
SLACK = 12  # characters by which a wrapped line may fall short of its paragraph's width
PLAIN_END = 3.0
UNBALANCED = -3.2
NEVER = -8.5  # inside a number, a name or an address

# Abbreviations that don't end a sentence, by language.
NEVER_END = set(
    """
    p pp no nos art arts fig figs sec secs cf vs viz incl approx app dept mr mrs ms mx messrs dr prof sgt capt col lt gen hon rev mgr gov sen rep pres mt ft ste vol ch ed eds e.g i.e eg ie resp
    sra srta dra av avda núm pág págs depto ej aprox tel ee d.ª d excmo
    m mm mme mlle env ex sté no n réf éd
    dott dott.ssa sig sig.ra ing avv arch cfr pag exmo exma ilmo eng adv profa sr. tab eq eqs ex ref refs app
    hr fr fa nr abs s vgl ca z.b d.h z b h bzw evtl ggf str art bspw inkl exkl tel hrsg
    проф акад доц инж тов ред г ул д стр т п ст см им пр пер кв тел напр рис табл
    ul str godz tj np m.in al pl nr p pan red
    нр नं पृ डॉ श्री क्र কি নং পৃ ডা ص د م أ ج
    """.split()
)
# Abbreviations that may end one: they do where an opener or a capital follows.
MAY_END = set(
    """
    etc p.m a.m p. a. pm am u.s u.k e.u inc corp co ltd llc jr sr bros ave blvd rd mi min mins hr hrs pct al ft sq usw uhr u.a s.a cía cia ud uds km kg cm kl str sté
    руб коп дн мин ч час сек тыс млн гг др апр янв февр авг сент окт нояб дек км кг е
    o.o r w zł gr cd кв कि.मी मी কি.মি মি ม กม น st jan feb mar apr jun jul aug sept sep oct nov dec
    """.split()
)
TITLES_BEFORE_NAMES = {"mr", "mrs", "ms", "mx", "dr", "prof", "sgt", "capt", "gen", "mgr", "hr", "fr", "sra", "srta", "dra", "mme", "st", "ft", "mt", "fa", "hon", "rev", "col", "lt", "gov", "sen", "проф", "акад", "доц", "dott", "sig", "ing", "avv", "exmo", "exma", "ilmo", "profa"}
_ABBREVIATIONS = NEVER_END | MAY_END | TITLES_BEFORE_NAMES
_EITHER = {"sr", "jr"} | (TITLES_BEFORE_NAMES & MAY_END)
CLOCK_CONTINUERS = {"eastern", "pacific", "central", "mountain", "utc", "gmt", "est", "edt", "cet"}
GERMAN_BEFORE_ORDINAL = {"am", "dem", "der", "die", "das", "im", "den", "zum", "vom", "beim", "bis", "ab", "seit", "zur", "des", "ein", "jeder"}
ORDINAL_NOUNS = {"januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember", "anlauf", "antrag", "stock", "etage", "mal", "versuch", "klasse"}
#: Words that open a statement, in lower case.
OPENERS = set(
    """
    the a an our my your his her their we i you he she it they this that these those there here who what why when where how was is are did does do please thanks hello about according several under
    no. approx. after before if as in on at for with
    el la los las un una unos unas según faltan dijo nadie por qué la lo esto este esta nos se su mi yo él ella
    le la les un une des il elle on nous vous je ce cette quelle quel pourquoi merci bonjour selon
    der die das ein eine er sie es wir ich am im hr. fr. dr. warum einige niemand basis das dies diese laut vielen bitte
    он она они мы вы я это этот почему никто некоторые г-н г-жа в ооо спасибо
    pan pani dlaczego nikt dziękuję dr
    mr. mrs. ms. dr. prof. sgt. capt. gen. sr. sra. m. mme
    """.split()
)
#: Words that rarely end a line unless it was wrapped.
LINE_BREAKERS = set("see cf. e.g. i.e. no. not be had has have i we he she they the a an of in on at for by with to from and or was is were as that this no our my el la los las de del en un una y o con por para le les des du et à der die das den dem und im am zu mit von в на и с от по из за к w z do i na o od".split())
ARTICLES = set("el la los las un una le les une des il der die das ein eine".split())
PREPOSITIONS = {"an", "am", "as", "if", "in", "on", "at", "for", "with", "was", "is", "are", "im", "en", "des", "se"}
#: Words that carry a statement on after a quotation or an ellipsis.
CONTINUERS = set(
    """
    and or but then again at asked said replied is was were shouted wrote added says with without for despite on in near after before as to from of by despite
    y e o pero otra preguntó dijo respondió según sin con por en de
    et ou mais encore demanda dit a sans avec puis par selon
    und oder aber schon wieder sagte fragte rief bzw. d. z. ohne mit nach
    и или но опять снова ещё сказал спросил без с т. после
    i oraz ale znowu ponownie powiedział zapytał tj. m.in. bez z po
    ثم و مرة أو لكن أي قال और या फिर पर एवं এবং আবার কিন্তু ও اور پھر لیکن
    """.split()
)
CJK_CONTINUERS = ("然后", "又一次", "又", "一直", "并", "而", "但", "時間", "时间", "と", "って", "まで", "라고", "이라고", "고 ", "하고", "例如", "，", ",", "、", "；", ";", "は", "が", "を", "に", "で", "も", "の", "直到", "问道", "说道")
#: Pronouns, questions and the like that open a statement in scripts without capitals.
CJK_OPENERS = ("我", "你", "您", "他", "她", "它", "这", "那", "谁", "为什么", "请", "没有人", "真的", "根据", "第", "今天", "明天", "昨天", "私", "彼", "誰", "なぜ", "これ", "それ", "あれ", "今日", "明日", "昨日")
THAI_OPENERS = ("คุณ", "ฉัน", "ผม", "เขา", "เธอ", "เรา", "พวก", "กรุณา", "โปรด", "ทำไม", "ไม่มี", "เมื่อ", "วันนี้", "ขอ", "นาย", "นาง", "สวัสดี", "ตาม", "ใคร", "อะไร", "เหตุใด", "มี", "นี่", "ถ้า", "หาก")
THAI_CONTINUERS = ("และ", "แต่", "หรือ", "จำนวน", "นาน", "นาที", "จนถึง", "ครั้ง", "อีก", "กม", "น.", "ดอลลาร์", "บาท", "ที่", "ซึ่ง", "โดย", "เพราะ", "เพื่อ", "ว่า", "ถึง", "ตั้งแต่", "เวลา", "ค่ะ", "ครับ", "นะ")
THAI_ATTRIBUTIONS = ("กล่าว", "พูด", "ถาม", "ตอบ", "บอก", "เขากล่าว", "เธอกล่าว", "เขาพูด", "เธอพูด", "เขาถาม", "เธอถาม")
THAI_CLOSERS = ("ค่ะ", "ครับ", "คะ", "นะคะ", "นะครับ", "น.", "กม.", "ดอลลาร์", "นาที", "ครั้ง", ")", '"', "”")

_EMOJI = r"[\U0001F000-\U0001FAFF☀-➿⬀-⯿️‍\U0001F1E6-\U0001F1FF]"
_END = r".!?…。！？؟۔।॥|．｡‼⁇⁈⁉។။"
_CLOSE = r"\"'”’»›)\]}」』】》〉）］｝＂"
_CANDIDATE = re.compile(rf"(?<=[\u0370-\u03ff\u1f00-\u1fff])[;\u037e](?=\s|$)|[{_END}](?:[{_END}]|\s?[»›]|[{_CLOSE}](?=[^\w]|$|[{_CLOSE}]|[^\x00-\x7F])|[{_CLOSE}](?=[A-ZÀ-Þ])|“(?=\W|$))*(?:\s*{_EMOJI}+)*|{_EMOJI}+(?=\s)|[\"”»](?=\s)")
_THAI = re.compile(r"[฀-๿຀-໿ក-៿]")
_WIDE_GAP = re.compile(r"\t|[ \xa0]{2,}")
_HAN = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]")
_HAN_RUN = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]+")
_HAN_RUN_BEFORE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]+$")
_HAN_SPACE = re.compile(r"(?<=[\u3040-\u30ff\u3400-\u9fff])[ \u3000]+(?=[\u3040-\u30ff\u3400-\u9fff])")
#: Plural pronouns open a clause in a run of Han characters unless a word that governs them stands before.
_HAN_SUBJECT = re.compile(r"(?<=[\u4e00-\u9fff]{4})(?<![给和跟与对让请叫问帮被把的在从向于是有为找等说到比像替])(?:我们|你们|他们|她们|咱们|大家)(?=[\u4e00-\u9fff]{3})")
_HAN_MARK = re.compile(r"[。！？；，、!?,;]")
_WIDE = re.compile(r"[\u0e00-\u0eff\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_DENSE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_SPACE = re.compile(r"\s+")
_LIST = re.compile(r"\s*(?:[-*•–—·▪◦‣○●]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|#{1,6}|>+)(?:\s+|$)")
_INITIAL = re.compile(r"\s*[A-Z]\.\s")  # may begin a name as well as an item
_HEAD = re.compile(r"\s*#{1,6}\s")
_CLOCK = re.compile(r"\s*[ap]\.\s?m\b")
_BLANK = re.compile(r"(?:\r\n|[\n\r\x0b\x0c  ])[^\S\n]*(?:(?:\r\n|[\n\r\x0b\x0c  ])[^\S\n]*)+")
_NONBLANK = re.compile(r"\S+")
_LEAD = re.compile(r"\S+\s+(\S)")
_GLUED = re.compile(r"\w{2,}[)\]\"”»]*[.!?…]+([A-ZÀ-ÞА-ЯЁ][^\W\d_]*)$|[!?…؟۔।。！？]+[)\]\"”»]*([^\W\d_]+)$")
_IS_EMOJI = re.compile(_EMOJI)
_DOTS = re.compile(r"\s*[.…]")
_NUMBER = re.compile(r"[\d.:/-]*\d")
_LETTER = re.compile(r"[^\W\d_]")
_AN_INITIAL = re.compile(r"\s*[^\W\d_]\.")
_QUOTES = re.compile(r"[()（）\[\]【】「」『』«»„“”\"《》＂]")
_QUOTE_END = re.compile(r'["”»“」』]')
_LINE = re.compile(r"\r\n|[\n\r\x0b\x0c  \x85]")
_WORD = re.compile(r"\w[\w'’.-]*")
_PAIRS = {"(": 0, "（": 0, "[": 0, "【": 0, "「": 1, "『": 1, "«": 1, "„": 2, "《": 1, ")": 0, "）": 0, "]": 0, "】": 0, "」": 1, "』": 1, "»": 1, "》": 1}
_SPEECH = frozenset('"“«„「『')
_CLOSING = frozenset("\"”»」』’“＂")
_CLEAR_MARKS = frozenset("!?！？。।")
_STRONG = frozenset("!?！？。؟۔।॥｡។။‼⁇⁈⁉")
_OPENING = set("(（[【「『«„《")
_TERMINAL = set(_END)


def _blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans that no unit crosses: blank lines, list items, headings and deliberate line ends part them."""
    paragraphs, at = [], 0
    for m in _BLANK.finditer(text):
        paragraphs.append((at, m.start()))
        at = m.end()
    paragraphs.append((at, len(text)))
    lines_of = []
    for start, end in paragraphs:
        lines, at = [], start
        for m in _LINE.finditer(text, start, end):
            lines.append((at, m.start()))
            at = m.end()
        lines.append((at, end))
        lines_of.append([x for x in lines if text[x[0] : x[1]].strip()])
    inner_of = [[(a, b) for a, b in zip(lines, lines[1:], strict=False) if not _LIST.match(text, *b) and not _HEAD.match(text, *a)] for lines in lines_of]
    inner = [x for breaks in inner_of for x in breaks]
    width = _width(text, inner)
    wrapped = bool(inner) and 40 <= width <= 110 and sum(_full(text, a, b, width) for a, b in inner) >= 0.8 * len(inner)
    if wrapped and len(inner) < 3:
        wrapped = sum(_softness(text, a, b) for a, b in inner) >= 1
    for lines, breaks in zip(lines_of, inner_of, strict=True):
        if not lines:
            continue
        soft = _soft_breaks(text, breaks, wrapped, width)
        begin = lines[0][0]
        for a, b in zip(lines, lines[1:], strict=False):
            if b not in soft:
                yield begin, a[1]
                begin = b[0]
        yield begin, lines[-1][1]


def _width(text: str, breaks: list[tuple[tuple[int, int], tuple[int, int]]]) -> int:
    """The longest of the lines beside the breaks; list items only count where there is nothing else."""
    sizes = [(bool(_LIST.match(text, *x)) and not _INITIAL.match(text, *x), x[1] - x[0]) for pair in breaks for x in pair]
    return max((n for item, n in sizes if not item), default=max((n for _, n in sizes), default=0))


def _full(text: str, a: tuple[int, int], b: tuple[int, int], width: int) -> bool:
    """Whether the next line's first word had no room on this one."""
    word = re.match(r"[ \t]*([^ \t]+)", text[b[0] : b[1]])  # wrapping breaks at plain blanks only
    return a[1] - a[0] + 1 + len(word.group(1)) > width


def _soft_breaks(text: str, breaks: list[tuple[tuple[int, int], tuple[int, int]]], wrapped: bool, width: int) -> set[tuple[int, int]]:
    """The lines of a paragraph that only wrapping parts from the line before.

    In a wrapped text those are the full lines' successors. Elsewhere the
    paragraph is judged by its own width, and a break that neither settles by
    how much it looks like one inside a sentence.
    """
    if wrapped and all(_full(text, a, b, width) for a, b in breaks):
        return {b for _, b in breaks}
    own = _width(text, breaks)
    if not 40 <= own <= 110:
        return {b for a, b in breaks if wrapped and _full(text, a, b, width)}
    scores = [_softness(text, a, b) - (2 if _may_open_line(text, b) else 0) + bool(_CLOCK.match(text, *b)) for a, b in breaks]
    if len(breaks) > 1 and all(_full(text, a, b, own) for a, b in breaks) and sum(scores) > len(breaks):
        return {b for _, b in breaks}
    sure = [score >= 3 or (score == 2 and b[1] - b[0] <= 0.4 * own) for (_, b), score in zip(breaks, scores, strict=True)]
    return {b for (a, b), x in zip(breaks, sure, strict=True) if (wrapped and _full(text, a, b, width)) or (x and a[1] - a[0] >= 40 and _full(text, a, b, own - SLACK))}


def _may_open_line(text: str, b: tuple[int, int]) -> bool:
    """Whether a line seems to begin with a name, a title or an abbreviation that opens a statement, even in lower case."""
    words = text[b[0] : b[0] + 60].split()[:2]
    low = words[0].lower().rstrip(",.")
    return "_" in low or words[0].lower() in OPENERS or low in TITLES_BEFORE_NAMES or (len(words) > 1 and words[0].isalpha() and words[1][:1].isupper() and low not in LINE_BREAKERS)


def _softness(text: str, a: tuple[int, int], b: tuple[int, int]) -> int:
    """How much a line break, taken alone, looks like one inside a running sentence; 0 behind an end mark, which decides itself."""
    left, right = text[a[0] : a[1]].rstrip(), text[b[0] : b[1]].lstrip()
    if left[-1] in _TERMINAL or left[-1] in "\"”»)」』）":
        return 0
    size, last, first = len(left), left.split()[-1].lower(), right.split()[0]
    plain = first.lower().rstrip(",.")
    score = 1 if 52 <= size <= 82 else -1
    score += 2 if last.lstrip("(\"") in LINE_BREAKERS or last[-1] in ",;:-" or left.count("(") > left.count(")") or left.count('"') % 2 else 0
    score += 1 if first[:1].islower() and plain not in OPENERS else -1 if plain in OPENERS and len(plain) > 1 else 0
    score -= 1 if text[: a[0]].strip() == "" and left.lstrip()[:1].islower() else 0
    return score


def _prefix_quotes(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Places of quotes and brackets in a block, and the running (brackets, quotes, low quotes, straight quotes) after each."""
    places, states = [], []
    bracket = quote = low = straight = 0
    for m in _QUOTES.finditer(text, start, end):
        c, i = m.group(), m.start()
        if c in '"＂':
            straight ^= 1
        elif c == "“":
            if low > 0:
                low -= 1
            else:
                quote += 1
        elif c == "”":
            if low > 0 and quote == 0:
                low -= 1
            else:
                quote -= 1
        elif c == "„":
            low += 1
        elif c in _OPENING:
            if _PAIRS[c]:
                quote += 1
            else:
                bracket += 1
        elif _PAIRS[c]:
            quote -= 1
        else:
            bracket -= 1
        places.append(i)
        states.append((bracket, quote, low, straight))
    return places, states


def _next_word(text: str, at: int, end: int) -> tuple[str, str]:
    """The rest of the block's next word behind ``at`` and its lower-case form."""
    m = _NONBLANK.search(text, at, min(end, at + 80))
    if not m:
        return "", ""
    word = m.group()
    return word, word.lower()


def _is_cased(c: str) -> bool:
    return c.lower() != c.upper()


def _lower_may_open(word: str) -> bool:
    """Whether a quotation that opens with this word in lower case is likely a statement."""
    return "_" in word or word in OPENERS


def _end_score(text: str, start: int, end: int, mark: int, stop: int) -> float:
    """Score of a sentence end at ``stop``, whose end mark is at ``mark``; the block is start:end."""
    cluster = text[mark:stop]
    nxt, low = _next_word(text, stop, end)
    bare = nxt.lstrip("\"'“”«»„(（[¿¡「『‘")
    if nxt and not bare:  # an opening quote set apart
        bare, low = _next_word(text, text.index(nxt, stop) + len(nxt), end)
    opened = len(nxt) > len(bare)
    gap = stop < end and text[stop].isspace()
    first = bare[:1]
    word = low.lstrip("\"'“”«»„(（[¿¡「『‘").rstrip(",;:!?")
    opener = word in OPENERS or word.rstrip(".") in OPENERS or "_" in word
    if first.islower() and bare[1:2].isupper():
        first = first.upper()  # a name such as iCab
    elif first.islower() and nxt[0] in _SPEECH and gap and _lower_may_open(word):
        first = first.upper()  # speech that opens behind an end mark
    upper = first.isupper() or first.isdigit()
    cased = bool(first) and _is_cased(first)
    second = None
    lower_name = False
    if first.islower():
        rest = _NONBLANK.search(text, stop, end)
        second = _LEAD.match(text, rest.start(), end) if rest else None
        lower_name = second is not None and second.group(1).isupper() and word.isalpha() and word not in CONTINUERS
    before = text[max(start, mark - 40) : mark]
    token = before.split()[-1] if before and not before[-1].isspace() else ""
    stem = token.lower().lstrip("\"'“«„(（[¿¡")
    glued = _GLUED.search(token)
    if glued:
        stem = (glued.group(1) or glued.group(2)).lower()
    if len(stem) > 3 and stem.endswith(("str", "straße", "allee")):
        stem = "str"
    closes = not _CLOSING.isdisjoint(cluster.strip())
    if stop >= end:
        return 6.0
    if token and cluster[0] in ".?" and not gap and (("/" in token or "=" in token or "@" in token) and first.isascii() and first.isalnum()):
        return -9.0
    # an ellipsis carries on unless something clearly begins
    if "…" in cluster or "..." in cluster or text[max(start, mark - 1) : mark] == "…":
        if _DOTS.match(text, stop, end):
            return -9.0
        if not cased and first:
            if ord(first) >= 0x2E80:
                rest = text[stop : stop + 8].lstrip()
                return 1.6 if rest.startswith(CJK_OPENERS) and not rest.startswith(CJK_CONTINUERS) else -2.5 if not gap else 0.8
            return -4.0 if word.rstrip(".।۔!?)\"”") in CONTINUERS or word.startswith(("مرة", "फिर", "আবার")) else 1.2
        if first.islower():
            stripped = word.rstrip(".!?)…\"”")
            if stripped in CONTINUERS:
                return -5.0
            return 1.2 if (opener or lower_name) else -1.5
        return 2.0
    if closes and not (cluster.rstrip("".join(c for c in cluster if not (c in _TERMINAL)))[-1:] and cluster.strip()[-1] in _TERMINAL):
        return _after_quote(text, start, stop, end, nxt, word, first, cased, upper, opener, lower_name, gap)
    strong = not _STRONG.isdisjoint(cluster) or ("|" in cluster and re.search(r"[\u0900-\u0dff]", text[max(start, mark - 12) : mark]) is not None)
    if strong:
        if first and first in ",;，、；،؛":
            return -6.0
        if not gap and first.isascii() and first.islower() and cluster[-1] == "?":
            return -3.0
        if closes or cluster[-1] in ")）]":
            return 3.0 if not first.islower() or opener or lower_name else 1.5
        return 3.0 if not (first.islower() and word in CONTINUERS and not opener) else 0.8
    if "|" in cluster:
        return -6.0
    if cluster[0] in ";\u037e":  # the Greek question mark
        return 3.0 if first.isupper() else -6.0
    if cluster[0] not in ".．":
        # emoji or a bare closing quote without an end mark
        if _IS_EMOJI.match(cluster):
            return 1.0 if (upper or opener or lower_name or (first and not cased)) else -1.0
        return _thai_gap(text, start, stop, end, low) if _THAI.search(token[-3:] or "") or _THAI.search(first) else -6.0
    # a full stop
    if first and first in ",;:，、；،؛":
        return -6.0
    if token and (_THAI.match(token[-1]) or "ऀ" <= token[-1] <= "෿"):
        return -6.0
    closed = any(c in ")]）】" for c in cluster)
    if not gap and not closed and not _IS_EMOJI.search(cluster):
        if token[-1:].isdigit() or first.isdigit():
            return -9.0
        if first.isascii() and first.islower():
            return -9.0
        if "." in token and len(token) < 6:
            return -6.0
    if _NUMBER.fullmatch(stem):
        if start == _line_start(text, start, mark - len(token)) and len(stem) <= 3:
            return -9.0
        prior = re.search(r"(\S+)\s+$", text[max(start, mark - len(token) - 24) : mark - len(token)])
        if word in ORDINAL_NOUNS or (prior and prior.group(1).lower() in GERMAN_BEFORE_ORDINAL and first.isupper() and not opener and len(stem) <= 2):
            return -5.0
        if first.islower() and not opener and not lower_name:
            return -1.0 if len(stem) <= 2 else 1.0
        return 2.5
    if closed:
        return 2.6 if (not first.islower() or opener or lower_name) else 0.9
    dotted = stem.rstrip(".")
    if glued:
        token = token[-len(dotted) :]
    if dotted in TITLES_BEFORE_NAMES and word.rstrip(".") in TITLES_BEFORE_NAMES and word.endswith("."):
        return -6.0
    if _LETTER.fullmatch(dotted) and token[-1:].isalpha():
        if _AN_INITIAL.match(text, stop, end) and first.isupper():
            return -6.0
        # an initial, or a one-letter abbreviation
        if dotted in {"m", "a"} and re.search(r"\b[ap]\.\s?$|\b[ap]\.$", text[max(start, mark - 5) : mark - 1].lower() + "") and text[mark - 1].lower() == "m":
            return 1.6 if upper and word not in CLOCK_CONTINUERS and not first.isdigit() else -4.0
        if token[-1:].isupper() and re.search(r"\bS\.\s?A$", text[max(start, mark - 6) : mark]):
            return 1.0 if first.isupper() and opener else -3.0
        if dotted in {"д", "п"} and re.search(r"т\.\s?.$", text[max(start, mark - 5) : mark]):
            return 1.6 if first.isupper() else -5.0
        if dotted == "е" and re.search(r"т\.\s?е$", text[max(start, mark - 5) : mark]):
            return -5.0
        return 0.6 if opener and first.isupper() and token[-1:].isupper() and word not in TITLES_BEFORE_NAMES else -4.0
    if dotted in TITLES_BEFORE_NAMES and not opener:
        return -4.5
    if dotted in {"sr", "jr"}:
        prior = re.search(r"(\S+)\s+$", text[max(start, mark - len(token) - 16) : mark - len(token)])
        if not prior or prior.group(1).lower().rstrip(".") in TITLES_BEFORE_NAMES or prior.group(1).lower().rsplit(".", 1)[-1] in {"el", "al", "del", "un", "estimado", "señor", "querido"}:
            return -4.5
    if word in {"el", "le", "il"} and second is not None and second.group(1).isdigit():
        return -3.5  # a date
    in_never, in_may = dotted in NEVER_END or stem in NEVER_END, dotted in MAY_END or stem in MAY_END
    if in_may and not (dotted in TITLES_BEFORE_NAMES and not opener):
        if word in CLOCK_CONTINUERS or first.isdigit() or (opened and not first.isupper() and nxt[0] in "(（["):
            return -4.0
        if not cased and first:
            return 1.0 if ord(first) > 0x2E7F else -1.0
        if first.islower():
            return -3.5 if not (opener and word not in CONTINUERS and word not in PREPOSITIONS and (word not in ARTICLES or _lower_style(text, start, mark))) else 0.3
        if token[:1].isupper() and dotted in {"min", "str"} and not opener:
            return -2.0
        return 1.8 if opener else 1.0
    if in_never:
        return -4.5 if not (opener and first.isupper() and dotted not in TITLES_BEFORE_NAMES and dotted not in {"no", "p", "nr", "nr", "art", "sec", "e.g", "i.e", "cf", "vgl", "z.b", "d.h", "ca", "np", "tj", "m.in", "s"}) else -0.6
    if opened and nxt[0] in "(（[" and first.islower():
        return -1.0
    if first.islower():
        if word in CONTINUERS and not opener and len(stem) <= 4:
            return -1.0
        return 1.8
    return PLAIN_END


def _line_start(text: str, start: int, at: int) -> int:
    """``start`` where only blanks lie between it and ``at``."""
    return start if not text[start:at].strip() else at


def _lower_style(text: str, start: int, mark: int) -> bool:
    """Whether the block seems to begin its sentences in lower case."""
    first = re.search(r"[^\W\d_]", text[start : start + 40])
    return bool(first) and first.group().islower()


def _after_quote(text: str, start: int, stop: int, end: int, nxt: str, word: str, first: str, cased: bool, upper: bool, opener: bool, lower_name: bool, gap: bool) -> float:
    """Score of an end right behind closed speech."""
    if not first or nxt[0] in ",;:，、；،؛.":
        return -6.0
    if nxt[0] in "(（" and not first.isupper() and not re.match(r"\s*[(（][^()（）]*[.。！？!?][)）]", text[stop : min(end, stop + 200)]):
        return -4.0
    if not cased and not first.isdigit():
        rest = text[stop : stop + 12].lstrip()
        if ord(first) >= 0x2E80 or "가" <= first <= "힯":
            return -5.0 if rest.startswith(CJK_CONTINUERS) else 0.6
        if _THAI.match(first):
            return -2.5 if rest.startswith((*THAI_CONTINUERS, *THAI_ATTRIBUTIONS)) else 1.6
        return -4.0 if word in CONTINUERS else 1.2
    if nxt[0] in "(（[" and first.islower():
        return -4.0
    if first.islower():
        if word in CONTINUERS or word.rstrip(".") in CONTINUERS or word in {"i.e.", "e.g.", "is", "was"}:
            return -5.0
        return 1.0 if (opener or lower_name) else -2.0
    return 2.4


def _thai_gap(text: str, start: int, stop: int, end: int, low: str) -> float:
    """Score of a statement's end at a blank in a script without end marks.

    Such scripts write no blanks between words: one between two runs of letters
    parts statements, while those beside numbers and foreign words needn't.
    """
    rest = low.lstrip("\"“(")
    left = text[max(start, stop - 24) : stop].rstrip()
    if low[:1] in "(（" or rest.startswith(THAI_CONTINUERS):
        return -3.5
    if not rest or not _THAI.match(rest[0]):
        return -2.2 if rest[:1].isalpha() and left.endswith(THAI_CLOSERS) else -3.5
    if low[:1] in "\"“" and _THAI.match(left[-1:] or " "):
        return -2.5  # speech that the words before announce
    opens = rest.startswith(THAI_OPENERS)
    if _WIDE_GAP.match(text, stop):
        return 2.0
    if left.endswith(THAI_CLOSERS):
        return 2.2 if opens else 0.6
    if _THAI.match(left[-1:] or " "):
        run = len(left) - max((left.rfind(c) for c in " \n\t\"“("), default=-1) - 1
        return 2.0 if opens or (run >= 4 and len(rest) >= 4) else 0.4
    return (0.6 if opens else -1.6) - (0.8 if left[-1:].isascii() and left[-1:].isalnum() else 0.0)


def _han_gap(text: str, start: int, stop: int, at: int, end: int) -> float:
    """Score of a statement's end at a blank between Han or Kana characters, where the block writes no end marks."""
    left = _HAN_RUN_BEFORE.search(text, max(start, stop - 40), stop)
    right = _HAN_RUN.match(text, at, end)
    sizes = [len(m.group()) if m else 0 for m in (left, right)]
    return 1.4 if min(sizes) >= 4 and not text.startswith(CJK_CONTINUERS, at) else -2.0


def _plain_word(text: str, low: int, mark: int) -> bool:
    """Whether an ordinary word, no abbreviation, stands before ``mark``; :func:`_end_score` gives PLAIN_END then if a capital follows."""
    at = text.rfind(" ", low, mark)
    word = text[at + 1 : mark]
    if at < 0 or len(word) < 3 or not word.isalpha():
        return False
    word = word.lower()
    return word not in _ABBREVIATIONS and not word.endswith(("str", "straße", "allee"))


def _abbreviated(text: str, low: int, mark: int, stop: int) -> float:
    """The score of a stop behind a known abbreviation in plain cases, as :func:`_end_score` gives it; 0 where that must decide."""
    at = text.rfind(" ", low, mark)
    token = text[at + 1 : mark].lower()
    if at < 0 or not (token.isascii() and token.isalpha()) or token in _EITHER:
        return 0.0
    if len(token) == 1:  # an initial
        word = text[stop + 1 : stop + 16].split(" ", 1)[0]
        plain = token not in "mas" and word.isascii() and (word.isdigit() or (word.isalpha() and word.lower() not in OPENERS))
        return -4.0 if plain else 0.0
    never, may = token in NEVER_END or token in TITLES_BEFORE_NAMES, token in MAY_END
    if not (never or may):
        return 0.0
    first = text[stop + 1 : stop + 2]
    if "0" <= first <= "9":
        return -4.0 if may else -4.5
    space = text.find(" ", stop + 1, stop + 40)
    word = text[stop + 1 : space]
    if space < 0 or not (word.isascii() and word.isalpha()) or word[1:2].isupper():
        return 0.0
    bare = word.lower()
    if bare in OPENERS or bare in ("el", "le", "il") or (may and not first.islower()):
        return 0.0
    return -3.5 if may else -4.5


def _units_of_block(text: str, start: int, end: int, wide: bool = True) -> list[tuple[int, int]]:
    """The best sequence of spans of one block. ``wide`` tells that the text has letters of scripts without blanks or capitals."""
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    if start >= end:
        return []
    places, states = _prefix_quotes(text, start, end)

    def state(at: int) -> tuple[int, int, int, int]:
        i = bisect.bisect_left(places, at)
        return states[i - 1] if i else (0, 0, 0, 0)

    found: dict[int, tuple[int, float]] = {}
    mark_end = _LIST.match(text, start, end)
    first_at = mark_end.end() if mark_end else start
    for m in _CANDIDATE.finditer(text, first_at, end):
        mark, stop = m.span()
        cluster = m.group()
        if cluster == "." and stop < end:
            after = text[stop]
            if after.isascii() and (after.isdigit() or (after.islower() and not text[stop + 1 : stop + 2].isupper())):
                continue  # inside a number, file name or address
            if text[mark - 1] >= "\u0e00" and _THAI.match(text[mark - 1]):
                continue  # such a stop belongs to an abbreviation; the blank behind it decides
            if after == " " and text[stop + 1 : stop + 2].isupper() and _plain_word(text, max(start, mark - 24), mark):
                found[stop] = (mark, PLAIN_END)
                continue
            if after == " ":
                score = _abbreviated(text, max(start, mark - 12), mark, stop)
                if score:
                    found[stop] = (mark, score)
                    continue
        if cluster in _CLEAR_MARKS and stop < end:
            after = text[stop + 1 : stop + 2] if text[stop] == " " else text[stop]
            if ("A" <= after <= "Z" and text[stop] == " ") or ("\u0900" <= after and after.isalpha()):
                found[stop] = (mark, PLAIN_END)
                continue
        if '"' in cluster or "＂" in cluster:
            for i in range(mark, stop):  # a straight quote that opens belongs to what follows
                if text[i] in '"＂' and state(i)[3] == 0:
                    stop = i
                    break
        while stop > mark and text[stop - 1].isspace():
            stop -= 1
        if cluster[0] == "." and stop == mark + 1 and _THAI.match(text[mark - 1]):
            continue
        if start < stop < end and stop > mark:
            found[stop] = (mark, _end_score(text, start, end, mark, stop))
    if wide and _THAI.search(text, first_at, end):
        for m in _SPACE.finditer(text, first_at, end):
            if m.start() not in found and (_THAI.match(text[m.start() - 1]) or (m.end() < end and _THAI.match(text[m.end()]))):
                found[m.start()] = (m.start(), _thai_gap(text, start, m.start(), end, _next_word(text, m.start(), end)[1]))
    if wide and _HAN.search(text, first_at, end) and not _HAN_MARK.search(text, first_at, end):
        for m in _HAN_SPACE.finditer(text, first_at, end):
            found.setdefault(m.start(), (m.start(), _han_gap(text, start, m.start(), m.end(), end)))
        for m in _HAN_SUBJECT.finditer(text, first_at, end):
            found.setdefault(m.start(), (m.start(), 0.8))
    if not found:
        return [(start, end)]
    whole = state(end)
    weight = 1.0 + 1.6 * len(_DENSE.findall(text, start, end)) / (end - start) if wide else 1.0
    # an end spares at most the length score of the whole block and one missing attribution: one that costs more is in no best sequence
    least = max(NEVER, _length_score(max((end - start) * weight, SHORT)) - 2.5)
    candidates = sorted((at, score) for at, (_, score) in found.items() if score >= least)
    return _best_spans(text, start, end, first_at, candidates, state, whole, weight) if candidates else [(start, end)]


def _inside(mark: tuple[int, int, int, int], whole: tuple[int, int, int, int]) -> bool:
    """Whether a quotation is open at a place, in a block whose quotations all close."""
    return bool(mark[3] and not whole[3]) or (mark[1] > 0 and not whole[1]) or (mark[2] > 0 and not whole[2])


def _best_spans(text: str, start: int, end: int, first_at: int, candidates: list[tuple[int, float]], state, whole, weight: float = 1.0) -> list[tuple[int, int]]:
    """The spans with the best sum of scores. ``candidates`` are ends with the score of their closing and the following opening words."""
    ends = [start, *[c[0] for c in candidates], end]
    gains = [0.0, *[c[1] for c in candidates], 0.0]
    marks = [state(e) for e in ends]
    starts = [first_at, *ends[1:]]
    speaks = [text[i : i + 3].lstrip()[:1] in _SPEECH for i in starts]
    short, long = SHORT / weight, LONG / weight
    best, back, peak = [0.0] * len(ends), [0] * len(ends), [0.0] * len(ends)
    far = 0  # starts before it are beyond FAR; the best of them by the state of their quotations
    beyond: dict[tuple[int, int, int, int], tuple[float, int]] = {}
    for j in range(1, len(ends)):
        stop, mark = ends[j], marks[j]
        if _inside(mark, whole):
            gains[j] += UNBALANCED * 2  # the span ends inside a quotation
        while far < j and (stop - starts[far]) * weight > FAR:
            value = best[far] + SLOPE * weight * starts[far]
            if marks[far] not in beyond or value > beyond[marks[far]][0]:
                beyond[marks[far]] = value, far
            far += 1
        top, at = -1e18, j - 1
        for i in range(j - 1, far - 1, -1):
            if peak[i] <= top:
                break  # no score is above 0, so nothing older is better
            size = stop - starts[i]
            score = best[i]
            if marks[i] != mark or speaks[i] or not short <= size <= long:
                score += _span_score(text, starts[i], stop, marks[i], mark, weight)
            if score > top:
                top, at = score, i
        for before, (value, i) in beyond.items():
            score = value - SLOPE * weight * stop + SLOPE * FAR + _length_score(FAR) + _balance_score(before, mark)
            if score > top:
                top, at = score, i
        best[j], back[j] = top + gains[j], at
        peak[j] = max(peak[j - 1], best[j])
    cuts, j = [], len(ends) - 1
    while j > 0:
        cuts.append((ends[back[j]], ends[j]))
        j = back[j]
    return cuts[::-1]


def _length_score(size: float) -> float:
    """Cost of a span of so many weighed characters, never above 0."""
    if size < SHORT:
        return -0.3 * math.log(SHORT / max(size, 1.0)) ** 2
    if size <= LONG:
        return 0.0
    return -0.5 * math.log(min(size, FAR) / LONG) ** 2 - SLOPE * max(size - FAR, 0.0)


def _balance_score(before: tuple[int, int, int, int], after: tuple[int, int, int, int]) -> float:
    """Cost of the quotations and brackets that a span opens without closing or closes without opening."""
    score = 0.0
    if before[3] != after[3]:
        score += UNBALANCED
    if before[1] != after[1] or before[2] != after[2]:
        score += UNBALANCED
    if before[0] != after[0]:
        score += UNBALANCED / 2
    return score


def _span_score(text: str, start: int, end: int, before: tuple[int, int, int, int], after: tuple[int, int, int, int], weight: float = 1.0) -> float:
    """Length and balance of a span as a whole, never above 0."""
    score = _balance_score(before, after) if before != after else 0.0
    size = end - start
    if size < 12:
        inside = text[start:end]
        if not any(c.isalnum() for c in inside):
            return score - 6.0
        if sum(c.isalnum() for c in inside) < 3:
            score -= 1.5
    score += _length_score(size * weight)
    # speech alone, with an attribution to come
    head = text[start : start + 3].lstrip()
    if head[:1] in _SPEECH and text[end - 1] in '"”»“」』' and size * weight <= FAR and not _QUOTE_END.search(text, start + 3, end - 1):
        rest = text[end : end + 4].lstrip()
        if rest and not rest[0].isupper() and not rest[0].isdigit() and rest[0] not in '"“«„「『([-*•#':
            score -= 2.5
    return score


def sentence_units(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the sentence units, without white space at their ends. None, empty and blank texts have none."""
    if not text or text.isspace():
        return []
    out = []
    wide = not text.isascii() and _WIDE.search(text) is not None
    for start, end in _blocks(text):
        for a, b in _units_of_block(text, start, end, wide):
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if a < b:
                out.append((a, b))
    return out


def split_sentences(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``start_char``, ``end_char``: a row per sentence unit of each row's whole text.

    Offsets count code points. Only ``keep`` and the text are read. Repeated rows
    give repeated results; null, empty and blank texts give none.
    """

    return text_rows(df, text, keep, sentence_units, "start_char int, end_char int", [pa.int32(), pa.int32()])
