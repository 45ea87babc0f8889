"""Parts of a business name as typed by people: brand, given name, line of business.

Legal forms, branch notes, articles, list numbers and town notes carry no identity and are dropped; abbreviations and
nicknames are expanded by locale dictionaries; digits that stand for letters are read as letters; web addresses are split
by the same dictionaries.
"""

from __future__ import annotations

import re
import unicodedata

from .lookalike import visible_form

# Lines of business by locale (en, in, fr, de, bg, hi), one phrase a line of text.
LINES = """
furniture|bakery|brewery|electrical contractors|pharmacy|law office|international trading|international exports|equipment rental|auto repair
plumbing company|travel agency|dental clinic|hardware|brothers roofing|yoga studio|flower shop|printing|logistics services|consulting associates
insurance services|veterinary center|manufacturing|steel industries|tea company|fabrication works|medical stores|tours travels|textiles|motors|sweets
stationery|electronics|jewellers|engineering services|traders|enterprises|garage services|joinery|solicitors|property management|catering company
garden center|bookshop|conseil|fromagerie|cremerie|electricite generale|coiffure|librairie|transports|menuiserie|patisserie|etablissements
boulangerie|garage|metzgerei|spedition|backerei|apotheke|getrankehandel|schlosserei|kuchenstudio|gartnerei|mobelhaus|buchhandlung|maschinenbau
сервиз|мебели|строеж|пекарна|аптека|книжарница|транспорт
पुस्तक केंद्र|ज्वैलर्स|मिठाई भंडार|वस्त्रालय|औषधालय
restaurant|grocery|supermarket|optician|florist|butcher|construction|cleaning services|security services
"""
# Abbreviations of words in lines of business, by the word they stand for.
SHORT = {
    "furniture": "furn", "electrical": "elec elect", "contractors": "contr contrs", "pharmacy": "phcy pharm pharmacie phie", "international": "intl int'l int", "equipment": "eqpt equip",
    "company": "co cy", "brothers": "bros", "logistics": "logist lgstcs", "services": "serv svcs svc", "consulting": "cons consltg", "associates": "assoc assocs", "insurance": "ins",
    "veterinary": "vet", "center": "ctr centre cntr", "manufacturing": "mfg", "industries": "ind inds", "medical": "med", "electronics": "elex electr", "engineering": "eng engg",
    "enterprises": "ent entps", "property": "prop", "management": "mgt mgmt", "librairie": "libr", "transports": "transp tpts", "menuiserie": "menuis",
    "etablissements": "ets", "boulangerie": "boul blgie", "apotheke": "apoth", "spedition": "sped", "buchhandlung": "buchhdlg", "travel": "trvl", "fabrication": "fab",
    "книжарница": "книж", "транспорт": "трансп",
}
# Given names and their short forms.
GIVEN = {
    "margaret": "maggie peggy meg", "anthony": "tony", "henrietta": "hattie etta", "theodora": "dora thea", "alexander": "alec alex sandy", "william": "will bill billy",
    "richard": "rick dick", "elizabeth": "liz betty beth eliza", "robert": "rob bob bobby", "charlotte": "lottie", "edward": "ned ted ed eddie", "katherine": "kate kathy katie",
    "susannah": "sue susie", "frederick": "fred freddie fritz", "margarete": "grete gretel", "johannes": "hannes hans", "gunther": "gunni", "friedrich": "fritz", "guillaume": "guillou",
    "elisabeth": "babeth", "madeleine": "mado", "frederic": "fred",
}
KIN = {"sons", "son", "daughters", "daughter", "partners", "partner"}
# Legal forms, phrases before words.
_LEGAL_PHRASES = re.compile(
    r"\b(?:limited liability (?:company|co|corp|corporation|partnership)|public limited company|private limited|gesellschaft mbh|gesellschaft mit beschrankter haftung|eingetragene[rn]? kauf\w+|pvt ltd|p ltd|masch bau)\b"
)
LEGAL = set("ltd limited llp llc inc incorporated corp corporation pvt private plc sarl eurl sas sasu sa sci kg gmbh mbh gesellschaft kommanditgesellschaft ek ohg ag lp оод еоод оод ад еад".split())
_NOTE = re.compile(r"\(\s*(?:hq|head office|head|main branch|main|branch\s*\w*|formerly[^)]*|p|pvt)\s*\)?|#\s*\d+|\b(?:head office|main branch|branch \d+|formerly trading)\b")
_LETTERED = re.compile(r"\b(?:[^\W\d_]\.){2,}(?:[^\W\d_]\b)?|\b(?:[^\W\d_]\.){1,}[^\W\d_]{1,2}\.")
_START = re.compile(r"^(?:m\s*/\s*s\b\.?\s*|messrs\b\.?\s*|the\s+|la\s+|le\s+|les\s+|der\s+|die\s+|das\s+)")
_WEB = re.compile(r"^(?:https?://)?(?:www\s*\.)?([^\s/.]+(?:\.[^\s/.]+)*)\.(?:com|org|net|info|biz|edu|gov|io|co|eu|in|fr|de|uk|bg|example|test|invalid)/?$")
_LEET = str.maketrans("013457@$", "oieastas")
_LEET_AT = re.compile(r"(?<=[^\W\d_])[013457@$]+|[013457@$]+(?=[^\W\d_])")
_ACRONYM = re.compile(r"^\s*([^\W\d_]{2,7})\s*\(\s*([^)]{5,})\)?\s*(.*)$")
_WORD = re.compile(r"[^\s,;|/()\[\].&+\-–—]+")


_CYRILLIC = re.compile("[\u0400-\u04ff]")
_CYRILLIC_WORD = re.compile("[\u0400-\u04ffABCEHIJKMOPSTXYaceiopsxyjh]+")
_SMALL = str.maketrans("BHMKT", "внмкт")


def plain(text: str) -> str:
    """Case-folded visible form without accents (combining marks of other scripts stay)."""
    t = visible_form(text)
    if t.isascii():
        return t.casefold()
    if _CYRILLIC.search(t):
        # capitals that look Latin while their small letters don't: back to the small letters, in words of this script
        t = _CYRILLIC_WORD.sub(lambda m: m[0].translate(_SMALL), t)
    t = t.casefold()
    apart = unicodedata.normalize("NFD", t)
    return unicodedata.normalize("NFC", "".join(ch for ch in apart if not "̀" <= ch <= "ͯ"))


_PHRASES = [tuple(plain(p).split()) for row in LINES.split("\n") for p in row.split("|") if p.strip()]
_FULL = set(_PHRASES)
_LINE_WORD: dict[str, str] = {w: w for p in _PHRASES for w in p}
for _w, _short in SHORT.items():
    for _s in [_w, *_short.split()]:
        _LINE_WORD[plain(_s)] = plain(_w)
_LINE_WORD["roofing"] = "roofing"
_GIVEN: dict[str, str] = {}
for _g, _short in GIVEN.items():
    for _s in [_g, *_short.split()]:
        _GIVEN[plain(_s)] = plain(_g) if plain(_s) not in _GIVEN else _GIVEN[plain(_s)] + "/" + plain(_g)
_LEGAL = {plain(w) for w in LEGAL}
_DROPPED = {"and", "n", "und", "et", "и", "और"}
_COMPACT = sorted({"".join(p) for p in _FULL} | {"toursandtravels", "gardencentre"}, key=len, reverse=True)
_COMPACT_LINE = {"".join(p): p for p in _FULL} | {"toursandtravels": ("tours", "travels"), "gardencentre": ("garden", "center")}
_COMPACT_ONE = {w: (c,) for w, c in _LINE_WORD.items() if len(w) >= 5} | {p[0]: (p[0],) for p in _FULL if len(p) > 1 and len(p[0]) >= 3}


def _deletes(w: str) -> set[str]:
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


def _near_index(words) -> dict[str, str]:
    index: dict[str, str] = {}
    for w in sorted(words):
        if len(w) >= 5:
            for v in {w} | _deletes(w):
                index.setdefault(v, w)
    return index


_NEAR_LINE = _near_index([w for w, c in _LINE_WORD.items() if w == c or len(w) >= 7])
_NEAR_GIVEN = _near_index([w for w in _GIVEN if len(w) >= 6])


def _near(word: str, index: dict[str, str], least: int = 5) -> str | None:
    """The dictionary word one letter, swap or doubled letter away."""
    if len(word) < least:
        return None
    for v in (word, *sorted(_deletes(word))):
        found = index.get(v)
        if found and abs(len(found) - len(word)) <= 1:
            return found
    return None


def read_digits(t: str) -> str:
    """Digits and signs beside letters as the letters they stand for."""
    return _LEET_AT.sub(lambda m: m[0].translate(_LEET), t)


def _web_parts(host: str) -> tuple[str, str, tuple[str, ...]]:
    """Brand, given name and line of a compact web name."""
    rest, line, given = re.sub(r"[^\w]", "", host), (), ""
    for index in (_COMPACT, None):
        for c in index if index else sorted(_COMPACT_ONE, key=len, reverse=True):
            if len(rest) - len(c) >= (4 if index else 6) and (rest.endswith(c) or rest.startswith(c)):
                line = _COMPACT_LINE[c] if index else _COMPACT_ONE[c]
                rest = rest[: -len(c)] if rest.endswith(c) else rest[len(c) :]
                break
        if line:
            break
    for w, c in sorted(_LINE_WORD.items(), key=lambda x: (-len(x[0]), x[0])):  # a phrase of which one word is abbreviated
        if line and len(w) >= 3 and rest.endswith(w) and (c, *line) in _FULL and len(rest) - len(w) >= 6:
            line, rest = (c, *line), rest[: -len(w)]
            break
    for k in ("daughters", "partners", "sons"):
        if rest.endswith(k) and len(rest) - len(k) >= 6:
            rest = re.sub(r"(?:and|n)$", "", rest[: -len(k)]) if len(rest) - len(k) > 9 else rest[: -len(k)]
            break
    for g in sorted(_GIVEN, key=len, reverse=True):
        if len(g) >= 5 and rest.startswith(g) and len(rest) - len(g) >= 6:
            given, rest = _GIVEN[g], rest[len(g) :]
            break
    return rest, given, line


def _with_line(brand: str, given: str, line: tuple[str, ...]) -> tuple[str, str, tuple[str, ...]]:
    return brand, given, _whole_line(line)


def _whole_line(words: tuple[str, ...]) -> tuple[str, ...]:
    """The dictionary phrase for the words found: itself, or the only phrase that starts with them."""
    if words in _FULL or not words:
        return words
    for p in _FULL:
        if sorted(p) == sorted(words):
            return p
    longer = [p for p in _FULL if p[: len(words)] == words]
    return longer[0] if len(longer) == 1 else words


def parse_name(text: str, towns: frozenset[str] = frozenset()) -> tuple[str, str, str, str]:
    """``brand, given, line, folded``. ``given`` may be several names joined by "/", or a single letter; ``folded`` is the
    brand with letters that a digit may stand for made one (i, l). Empty strings where a part is missing."""
    t = plain(text)
    t = _START.sub("", t)
    if " " not in t and "." in t and (m := _WEB.match(t)):
        return _out(*_with_line(*_web_parts(read_digits(m[1]))))
    if (m := _ACRONYM.match(t)) and not _NOTE.match("(" + m[2] + ")"):
        t = m[2] + " " + m[3]
    t = _NOTE.sub(" ", t)
    t = re.sub(r"\([^)]*\)?", " ", t) if re.search(r"\w.*\(", t) else t
    t = _LETTERED.sub(lambda m: m[0].replace(".", "") + " ", t)
    words = [read_digits(w) if not w.isdigit() else w for w in _WORD.findall(t.replace("'", "'"))]
    t = _LEGAL_PHRASES.sub(lambda m: " maschinenbau " if m[0] == "masch bau" else " ", " ".join(words))
    words = [w for w in t.split() if w not in _LEGAL and w not in _DROPPED and not w.isdigit()]
    while len(words) > 1 and words[-1] in towns and words[-1] not in _LINE_WORD:
        words.pop()
    brand, line, given, kin = [], [], "", False
    for w in words:
        if w in KIN:
            kin = True
        elif w in _LINE_WORD:
            line.append(_LINE_WORD[w])
        elif w in _GIVEN and not given:
            given = _GIVEN[w]
        else:
            brand.append(w)
    if len(brand) > 1 and tuple(line) not in _FULL:
        for i, w in enumerate(brand):
            if len(brand) > 1 and (c := _near(w, _NEAR_LINE, 4 if line else 5)) and (not line or _joins(line, c)):
                brand[i] = ""
                at = sum(1 for x in words[: words.index(w)] if x in _LINE_WORD)
                line.insert(at, _LINE_WORD[c])
                if tuple(line) in _FULL:
                    break
        brand = [w for w in brand if w]
    if not given and len(brand) > 1:
        for w in brand:
            if len(w) == 1 and (kin or len(brand) == 2 and len("".join(brand)) > 7):
                given = w
                brand.remove(w)
                break
            if sum(map(len, brand)) - len(w) >= 8 and (g := _near(w, _NEAR_GIVEN)):
                given = _GIVEN[g]
                brand.remove(w)
                break
    # words of a town between brand and line of names whose line comes first
    while len(brand) > 1 and brand[-1] in towns:
        brand.pop()
    if not brand and words:
        brand = [w for w in words if w not in KIN]
        line = []
    return _out("".join(brand), given, _whole_line(tuple(line)))


def _joins(line: list[str], word: str) -> bool:
    return any(word in p and all(x in p for x in line) for p in _FULL)


def _out(brand: str, given: str, line: tuple[str, ...]) -> tuple[str, str, str, str]:
    return brand, given, " ".join(line), brand.replace("l", "i").replace("1", "i")
