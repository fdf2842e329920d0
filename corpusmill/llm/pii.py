"""Personal data in free text: emails, phone numbers, identity numbers, street addresses and names of persons.

A semi-Markov conditional random field over text segments: candidate spans of bounded length carry whole-span features (shape, words before,
neighbours, name statistics), everything between them is outside; the probability of a segmentation is the normalised
exponential of its spans' scores. Boundaries and kinds are chosen together by dynamic programming over the candidates.

The field is trained here on a bounded sample: spans with a telling context or form serve as labels, other candidates as
outside. Surname endings are counted in all documents. Prediction runs over the whole of every text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "name")
#: Bound of the training sample in documents, chosen by a hash of the id.
SAMPLE_DOCS = 5000
#: Bound of the surname endings that are held in the model; more are rejected, never cut.
MAX_ENDINGS = 500_000
#: Shares of surnames among the forms of an ending that features tell apart.
LEVELS = (0.3, 0.5, 0.7)
#: Share of its places that a form has to stand beside a listed given name to be a surname.
LEAST_BESIDE = 0.05

# Words before a number, titles, name particles and street words, by language where they differ.
PHONE_CUES = set("tel telefon telefono teléfono telefone téléphone tél phone ring call mobile fax unter ruft llama chiama bel appelez numerem telefonicznie le retard al il nummer mobil handy".split())
ID_CUES = set("ssn security social national identity passport tax id steuer lautet ausweisnummer personalausweis reisepass dni nie nif identidad documento fiscale codice identità identité sécurité sociale passeport burgerservicenummer bsn paspoort pesel dowodu paszportu number nr no n".split())
STRONG_ID = re.compile(
    r"(?i)(security number|identity number|identity card|passport|tax (?:id|number)|\bid no|steuer-id|steuernummer|ausweis|reisepass|\bdni\b|\bnie\b|\bnif\b|documento de identidad|pasaporte|codice fiscale|carta d.identità|passaporto|sécurité sociale|carte d.identité|passeport|burgerservicenummer|\bbsn\b|paspoort|pesel|dowodu|paszport|identiteitskaart|sofinummer)"
)
STRONG_PHONE = re.compile(r"(?i)(\btel\b|tel\.|telefon|teléfono|\btél|\bphone|\bring\b|\bcall\b|\bruft\b|anmeldung unter|llama al|chiama il|\bbel\b|appelez le|en cas de retard, le|pod numerem)\W*$")
TITLES = set("mr mrs ms miss dr prof sir madam herr frau mme mlle m monsieur madame sr sra srta don doña sig sigra dott signor signora dhr mevr mevrouw meneer pan pani".split())
PARTICLES = r"(?:(?:van der|van den|van de|van|de la|de|del|della|der|den|von|di|da|du|le|la|ter|ten|dos|zu|VAN DER|VAN DEN|VAN DE|VAN|DE LA|DE|DEL|VON|DI|DA|DU|TER|TEN)[  ]+)"
ARTICLES = r"(?:(?:de|del|la|las|los|el|dei|della|delle|degli|di|da|do|dos|das|san|santa)[  ]+){0,3}"
STREETS_AFTER = r"(?:Street|St\.?|Road|Rd\.?|Lane|Ln\.?|Close|Cl\.?|Drive|Dr\.?|Avenue|Ave\.?|Way|Court|Ct\.?|Place|Pl\.?|Crescent|Gardens|Square|Sq\.?|Terrace|Grove|Hill|Row|Walk|Boulevard|Blvd\.?)"
STREETS_JOINED = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|brücke|damm|markt|straat|laan|gracht|plein|kade|singel|steeg|pad|hof|ring|dijk|graben|steig|wall|tor)"
STREETS_BEFORE = r"(?:[Cc]alle|C/|[Aa]venida|[Aa]vda\.|[Aa]v\.|[Pp]laza|[Pp]za\.|[Pp]aseo|[Cc]amino|[Rr]onda|[Tt]ravesía|[Vv]ia|[Vv]iale|[Cc]orso|[Pp]iazza|[Vv]icolo|[Ll]argo|ul\.|[Uu]lica|al\.|[Aa]leja|os\.|pl\.|[Pp]lac|Rua|Travessa|Praça)"
STREETS_FR = r"(?:rue|avenue|av\.|boulevard|bd|chemin|place|impasse|allée|quai|route|cours|passage|square)"

SP = r"[  ]+"


def _upper() -> str:
    """Capital and title letters of the first plane as ranges of a character class."""
    at = [c for c in range(1 << 16) if unicodedata.category(chr(c)) in ("Lu", "Lt")]
    out, lo = [], None
    for i, c in enumerate(at):
        lo = c if lo is None else lo
        if i + 1 == len(at) or at[i + 1] != c + 1:
            out.append(f"\\u{lo:04x}-\\u{c:04x}")
            lo = None
    return "".join(out)


UPPER = _upper()
CAP = rf"[{UPPER}][\w'’\-]*"
HOUSE = r"\d{1,4}(?:[  ]?[a-zA-Z]\b)?(?:/\d{1,4}[a-z]?)?(?:[\-–]\d{1,4}[a-zA-Z]?(?!\w|[\-–.]\d))?"
ADDRESSES = [re.compile(p) for p in (
    rf"(?<![\w.])\d{{1,4}}[a-zA-Z]?{SP}(?:{CAP}{SP}){{1,3}}{STREETS_AFTER}(?!\w)",
    rf"(?<!\w)(?:(?:An der|An den|Am|Auf der|In der|Im|Zum|Zur|Unter den|Hinter der)\s)?{CAP}?{STREETS_JOINED}{SP}{HOUSE}(?!\w)",
    rf"(?<!\w)(?:{CAP}[ -])(?:Straße|Strasse|Str\.|Weg|Allee|Platz|Gasse|Straat|Laan|Ring|Damm|Ufer){SP}{HOUSE}(?!\w)",
    rf"(?<!\w){STREETS_BEFORE}{SP}{ARTICLES}{CAP}(?:{SP}{CAP}){{0,2}},?{SP}(?:(?:n\.|nº|n°|no\.|nr|núm\.|numero)(?:{SP})?)?{HOUSE}(?!\w)",
    rf"(?<![\w.])\d{{1,4}}(?:(?:{SP})?(?:bis|ter|quater)|[a-zA-Z])?,?{SP}{STREETS_FR}{SP}(?:(?:de|du|des|la|le|les){SP}|de{SP}la{SP}|de{SP}l['’]|d['’]|l['’])*{CAP}(?:{SP}{CAP})?(?!\w)",
)]
JOINED_ENDS = tuple("straße strasse str. weg gasse platz allee ufer brücke damm markt straat laan gracht plein kade singel steeg pad hof ring dijk graben steig wall tor".split())
NUMBER_AFTER_BLANK = re.compile(r"(?<=[  ])\d")
BEFORE_STEMS = tuple("alle C/ venida vda. v. laza za. aseo amino onda ravesía ia orso iazza icolo argo ul. lica al. leja os. pl. lac Rua Travessa Praça".split())  # what each of STREETS_BEFORE holds
BEFORE_STEM = re.compile("|".join(map(re.escape, BEFORE_STEMS)))
HAS_DIGIT = re.compile(r"[0-9]")
AT_SIGN = re.compile(r"@|[\[(][  ]?(?:at|AT|At|a)[  ]?[\])]")
AT_WORD = re.compile(r"(?<=[  ])(?:at|AT|arroba|chiocciola|małpa)(?=[  ][^\n]{1,60}[  ](?:dot|DOT|punto|point|kropka|punt|Punkt)[  ])")
DOT_WORDS = tuple(f" {w} " for w in "dot DOT punto point kropka punt Punkt".split())
LOCAL = re.compile(r"[\w](?:[\w.+\-]*[\w])?[  ]?$")
DOT = r"(?:\.|[  ]?[\[(][  ]?(?:dot|DOT|Dot)[  ]?[\])][  ]?|[  ](?:dot|DOT|Dot|punto|point|kropka|punt|Punkt)[  ])"
DOMAIN = re.compile(rf"[  ]?[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:{DOT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)+")
NUMBER = re.compile(r"(?:(?<!\w)[A-Z]{2,3}[  ](?:[A-Z]{2,3}[  ])?)?(?<!\w)(?:\+|\()?[A-Z0-9]*[0-9][A-Z0-9]*\)?(?:(?:[  ]?\(\d{1,4}\)[  ]?|[  .\-/])[A-Z0-9]+)*(?!\w)")
DATE_BEFORE = re.compile(r"(?:^|[^0-9])(?:\d{1,2}[./\-]\d{1,2}[./\-](?:\d{4}|\d{2})|\d{4}-\d{2}-\d{2})[  ]\(?$")
DATE_AFTER = re.compile(r"\)?[  ](?:\d{1,2}[./\-]\d{1,2}[./\-](?:\d{4}|\d{2})|\d{4}-\d{2}-\d{2})(?!\d)")
#: Cuts of a run of groups at its ends, words in capitals or dates.
WHOLE = tuple(a + b for a in "0wd" for b in "0wd")
WORDS_BEFORE = re.compile(r"[^\W\d_]+")
GIVEN_SIDE = re.compile(rf"({CAP})((?:{SP}[^\W\d_a-z]\.)?{SP}{PARTICLES}*)({CAP})")
FAMILY_FIRST = re.compile(rf"({PARTICLES}*{CAP}),{SP}({CAP})")
COMMA_CAPITAL = re.compile(rf",{SP}[{UPPER}]")
CAPITALISED = re.compile(CAP)
GAP_AFTER_GIVEN = re.compile(rf"(?:{SP}[^\W\d_]\.)?{SP}{PARTICLES}*")
GAP_AFTER_FAMILY = re.compile(rf",{SP}")
NO_APOSTROPHE = {ord(c): None for c in "'’"}
KNOWN = re.compile(r":known[01](?:hi|mid|lo)$")


@dataclass
class Span:
    start: int
    end: int
    kind: str
    feats: list[str]
    gold: bool = False


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    endings: dict[str, float] = field(default_factory=dict)
    given: frozenset = frozenset()
    #: The most that the word before a name can add.
    lead: float = 0.0
    #: Sums of the weights that form, list and ending decide, by (form, known, level), and the most that the features of the place add.
    base: dict[tuple, float] = field(default_factory=dict)
    most: float = 0.0
    seen: dict[str, tuple[bool, float]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def told(self, word: str) -> tuple[bool, float]:
        """Whether a word is a listed given name, and ``surname`` of it."""
        got = self.seen.get(word)
        if got is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            got = self.seen[word] = (_is_given(word, self), self.surname(word))
        return got

    def surname(self, word: str) -> float:
        """Share of the forms with this word's longest known ending that stand as surnames, down to the next of ``LEVELS``."""
        w = word.rsplit("-", 1)[-1].lower()
        for k in range(min(7, len(w)), 3, -1):
            p = self.endings.get(w[-k:])
            if p is not None:
                return p
        return 0.0


def _shape(s: str) -> str:
    s = re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s.replace(" ", " ")))
    return s


def _before(text: str, at: int) -> list[str]:
    line = text[max(text.rfind("\n", 0, at), at - 45, -1) + 1 : at]
    return [w.lower() for w in WORDS_BEFORE.findall(line)[-3:]]


def _word_before(text: str, at: int) -> str:
    """The last word within 45 characters of the line, or nothing."""
    i, lo = at - 1, max(0, at - 45)
    while i >= lo and not text[i].isalpha():
        if text[i] == "\n":
            return ""
        i -= 1
    end = i + 1
    while i >= lo and text[i].isalpha():
        i -= 1
    return text[i + 1 : end].lower()


def _around(text: str, s: int, e: int) -> list[str]:
    a = text[s - 1] if s else "\n"
    b = text[e] if e < len(text) else "\n"
    b2 = text[e + 1] if e + 1 < len(text) else "\n"
    left = "w" if a.isalnum() else "s" if a in "  " else a
    right = "w" if b.isalnum() else b + ("d" if b2.isdigit() else "") if b in ".,-/:  " else b
    return [f"<{left}", f">{right}"]


def _digits(s: str) -> int:
    return sum(map(s.count, "0123456789"))


def _numbers(text: str, lo: int, hi: int) -> Iterator[Span]:
    for m in NUMBER.finditer(text, lo, hi):
        raw = m.group()
        if _digits(raw) < 5:
            continue
        cuts = [(x.start(), x.end()) for x in re.finditer(r"[A-Z0-9]+", raw)]
        n = len(cuts)
        numeric = [HAS_DIGIT.search(raw, a, b) is not None for a, b in cuts]
        seen = set()
        for i in range(n):
            last = i + 1
            while last < n and sum(b - a for a, b in cuts[i : last + 1]) <= 17:
                last += 1
            for j in range(last, i, -1):
                s = cuts[i][0]
                e = cuts[j - 1][1]
                if i == 0 and raw[:s] in ("+", "("):
                    s = 0
                elif s and raw[s - 1] == "(":
                    s -= 1
                if e < len(raw) and raw[e] == ")" and raw[s:e].count("(") > raw[s:e].count(")"):
                    e += 1
                v = raw[s:e]
                if (s, e) in seen or not 7 <= sum(c.isalnum() for c in v) <= 17 or _digits(v) < 5:
                    continue
                seen.add((s, e))
                a, b = m.start() + s, m.start() + e
                words = _before(text, a)
                shape = _shape(v)
                left = "0" if i == 0 else "w" if numeric[i] and not numeric[i - 1] else "d" if numeric[i] and DATE_BEFORE.search(raw, max(0, s - 14), s) else "1"
                right = "0" if j == n else "w" if numeric[j - 1] and not numeric[j] else "d" if numeric[j - 1] and DATE_AFTER.match(raw, e) else "1"
                part = left + right
                around = _around(text, a, b)
                digits = _digits(v)
                for kind in ("phone", "id_number"):
                    k = "p" if kind == "phone" else "i"
                    f = [k, f"{k}:{shape}", f"{k}:cut{part}", f"{k}:n{digits}", f"{k}:alpha{int(any(c.isalpha() for c in v))}", f"{k}:+{int(v[0] == '+')}{v[:2] if v[0] == '0' else ''}"]
                    f += [f"{k}{x}" for x in around]
                    f += [f"{k}:w={w}" for w in words[-2:]] + [f"{k}:pc{int(any(w in PHONE_CUES for w in words))}", f"{k}:ic{int(any(w in ID_CUES for w in words))}", f"{k}:none{int(not words)}"]
                    yield Span(a, b, kind, f)


def _emails(text: str) -> Iterator[Span]:
    marks = list(AT_SIGN.finditer(text)) if "@" in text or "[" in text or "(" in text else []
    if any(w in text for w in DOT_WORDS):
        marks += AT_WORD.finditer(text)
    for m in marks:
        left = LOCAL.search(text, max(0, m.start() - 65), m.start())
        right = DOMAIN.match(text, m.end())
        if not left or not right:
            continue
        plain = m.group() == "@"
        if left.group()[-1] in "  " and plain and text[m.end() : m.end() + 1] not in "  ":
            continue  # "word @handle.name"
        tight = left.end() == m.start() and left.group()[-1] not in "  "
        tld = re.split(r"[^A-Za-z0-9\-]+", right.group().strip())[-1]
        yield Span(left.start(), right.end(), "email", ["e", f"e:at{m.group() if plain else 'w'}", f"e:tight{int(tight)}", f"e:tld{min(len(tld), 8)}{int(tld.isalpha())}"])


def _addresses(text: str, lo: int, hi: int) -> Iterator[Span]:
    """A form is tried on a line with a digit whenever what it can't do without is there."""
    found: dict[tuple[int, int], tuple[int, re.Match]] = {}
    line = text[lo:hi]
    joined = any(line[max(0, n.start() - 12) : n.start()].rstrip(" \u00a0").lower().endswith(JOINED_ENDS) for n in NUMBER_AFTER_BLANK.finditer(line))
    before = BEFORE_STEM.search(line) is not None
    for i, form in enumerate(ADDRESSES):
        if (i in (1, 2) and not joined) or (i == 3 and not before):
            continue
        for m in form.finditer(text, lo, hi):
            found.setdefault((m.start(), m.end()), (i, m))
    for i, m in found.values():
        words = _before(text, m.start())
        after = text[m.end() : m.end() + 2]
        yield Span(m.start(), m.end(), "address", ["a", f"a:form{i}", f"a:w={words[-1] if words else ''}", f"a:colon{int(after[:1] == ':')}", f"a:next{after[:1] if not after[:1].isalnum() else 'w'}", f"a:len{m.group().count(' ')}"])


def _is_given(word: str, model: Model) -> bool:
    return word in model.given or word.title() in model.given or word.capitalize() in model.given


def _names(text: str, model: Model) -> Iterator[Span]:
    """Pairs of capitalised words, whatever list and ending say of them. Where the field's weights keep a pair at zero or below, the best
    segmentation can't hold it, and it is not built."""
    told, weights = model.told, model.weights
    pos = 0
    while m := GIVEN_SIDE.search(text, pos):
        pos = m.start(3)
        a, b = m.group(1), m.group(3).rstrip("-'’")
        end = m.start(3) + len(b)
        if b.endswith("'s") or b.endswith("’s"):
            b, end = b[:-2], end - 2
        if a.lower() in TITLES or b.lower() in TITLES:
            continue
        middle = bool(m.group(2).strip())
        for form, g, f in (("gf", a, b), ("fg", b, a)):
            if form == "fg" and middle:
                continue
            if (x := _name_span(text, m.start(), end, form, told(g), told(f), model, middle, weights)) is not None:
                yield x
    if COMMA_CAPITAL.search(text) is None:
        return
    pos = 0
    while m := FAMILY_FIRST.search(text, pos):
        pos = m.start(2)
        f, g = m.group(1).split()[-1], m.group(2)
        if g.lower() in TITLES:
            continue
        if (x := _name_span(text, m.start(), m.start(2) + len(g), "f,g", told(g), told(f), model, " " in m.group(1), weights)) is not None:
            yield x


def _row(text: str, s: int, e: int) -> str:
    """Whether a span begins its line, and how the line goes on: far or not, with digits soon or not."""
    end = text.find("\n", e)
    rest = text[e : end if end >= 0 else len(text)]
    return f"n:row{int(s == 0 or text[s - 1] == '\n')}{'far' if len(rest) > 30 else ''}{int(HAS_DIGIT.search(rest[:24]) is not None)}"


def _name_span(text, s, e, form, given, family, model, middle, weights) -> Span | None:
    known, sur = given[0], family[1]
    level = "hi" if sur >= 0.7 else "mid" if sur >= 0.3 else "lo"
    base = model.base.get((form, known, level))
    if base is not None:  # a trained field
        if base + model.most <= 0:
            return None
        word = _word_before(text, s)
        if base + model.most - model.lead + weights.get(f"n:w={word}", 0.0) <= 0:
            return None
    else:
        word = _word_before(text, s)
    prev = text[max(0, s - 3) : s].rstrip(" \u00a0")[-1:]
    k = f"n:{form}"
    feats = ["n", k, f"n:known{int(known)}{level}", f"{k}:known{int(known)}{level}", f"n:given-sur{int(given[1] >= 0.5)}", f"n:fam-given{int(family[0])}", f"n:mid{int(middle)}"]
    feats += [_row(text, s, e), f"n:w={word}", f"n:prev{prev if not prev.isalnum() else 'w'}"] + [f"n{x}" for x in _around(text, s, e)[1:]]
    if base is not None and sum(weights.get(x, 0.0) for x in feats) <= 0:
        return None
    return Span(s, e, "name", feats)


def candidates(text: str, model: Model) -> list[Span]:
    out = []
    if HAS_DIGIT.search(text):
        at = 0
        for line in text.split("\n"):
            end = at + len(line)
            if HAS_DIGIT.search(line):
                if _digits(line) >= 5:
                    out += _numbers(text, at, end)
                out += _addresses(text, at, end)
            at = end + 1
    out += _emails(text)
    out += _names(text, model)
    return out


def clusters(spans: list[Span]) -> Iterator[list[Span]]:
    """Groups of candidates that overlap, in order of their ends within a group."""
    group, reach = [], -1
    for s in sorted(spans, key=lambda x: (x.start, x.end)):
        if group and s.start >= reach:
            yield sorted(group, key=lambda x: (x.end, x.start))
            group, reach = [], -1
        group.append(s)
        reach = max(reach, s.end)
    if group:
        yield sorted(group, key=lambda x: (x.end, x.start))


def _last_before(group: list[Span]) -> list[int]:
    """For each candidate, how many candidates end at or before its start."""
    ends = [x.end for x in group]
    return [bisect_right(ends, x.start) for x in group]


def best(group: list[Span], weights: dict[str, float]) -> list[Span]:
    """Segmentation of the highest score."""
    prev = _last_before(group)
    top = [(0.0, None)]
    for i, x in enumerate(group):
        sc = sum(weights.get(f, 0.0) for f in x.feats) + top[prev[i]][0]
        top.append((sc, i) if sc > top[i][0] else (top[i][0], None))
    out, i = [], len(group)
    while i:
        if top[i][1] is not None:
            out.append(group[i - 1])
            i = prev[i - 1]
        else:
            i -= 1
    return out


def _marginals(group: list[Span], score: list[float]) -> list[float]:
    """Probability of every candidate under the field, by forward and backward sums."""
    n, prev = len(group), _last_before(group)
    order = sorted(range(n), key=lambda i: (group[i].start, group[i].end))
    fw = [0.0]
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    for i in range(n):
        fw.append(add(fw[i], fw[prev[i]] + score[i]))
    starts = [group[i].start for i in order]
    bw = [0.0] * (n + 1)  # bw[r]: candidates from rank r on, by start
    rank = lambda at: bisect_left(starts, at)
    for r in range(n - 1, -1, -1):
        i = order[r]
        bw[r] = add(bw[r + 1], score[i] + bw[rank(group[i].end)])
    return [math.exp(fw[prev[i]] + score[i] + bw[rank(group[i].end)] - fw[n]) for i in range(n)]


def _label(text: str, spans: list[Span], model: Model) -> None:
    """Marks the spans that context or form gives away; where several overlap, the longest that qualifies."""
    ok = []
    for x in spans:
        v = text[x.start : x.end]
        line_start = text.rfind("\n", 0, x.start) + 1
        lead = text[max(line_start, x.start - 42) : x.start]
        tail = re.split(r"[.!?] ", lead)[-1] if not re.search(r"(?i)(\bno|\bnr|\btel|tél|\bn)\. ?$", lead) else lead
        if x.kind == "email" or (x.kind == "address" and "a:colon0" in x.feats and lead.strip()):
            x.gold = True
        elif x.kind == "id_number" and STRONG_ID.search(tail) and not any(c.isdigit() for c in tail[-3:]) and any(f"i:cut{c}" in x.feats for c in WHOLE):
            x.gold = not re.match(r"(?:DNI|BSN|NIE|NIF|PESEL|ID)\b", v)
        elif x.kind == "phone" and "p:alpha0" in x.feats and any(f"p:cut{c}" in x.feats for c in WHOLE) and (STRONG_PHONE.search(lead) or re.search(r"[^\W\d_]\s*[|;:\t]\s*$", lead) and line_start >= x.start - 45 and not STRONG_ID.search(lead) and "<w" not in x.feats):
            x.gold = STRONG_PHONE.search(lead) is not None or bool(re.match(rf"{CAP}", lead)) and 1 <= lead.count(" ") <= 4 and not re.search(r"(?i)order|isbn|item|version", lead)
        elif x.kind == "name" and ("n:known1hi" in x.feats or "n:known1mid" in x.feats or ("n:gf:known1lo" in x.feats and text[x.end : x.end + 2].strip(" ")[:1] in ("|", ";", ":", "\t"))):
            x.gold = True
        if x.gold:
            ok.append(x)
    ok.sort(key=lambda x: (x.start - x.end, x.kind == "phone"))
    taken: list[Span] = []
    for x in ok:
        if any(x.start < y.end and y.start < x.end for y in taken):
            x.gold = False
        else:
            taken.append(x)


def surname_forms(text: str, given: frozenset, forms: dict[str, list[int]], seen: dict[str, tuple[str, bool]] | None = None) -> None:
    """Counts the last parts of the capitalised words of a text: how often they stand there, and how often beside a listed given name as a family
    name does. Handles and numbers (words with underscores or digits, beside ``@`` or ``#``) are no forms: their variety grows with the corpus,
    and they would outnumber the family names that they end in. Nor are initials. ``seen`` keeps what was found out of words."""
    model, seen = Model(given=given), {} if seen is None else seen
    last_end, last, last_given = 0, "", False
    for m in CAPITALISED.finditer(text):
        w = m.group()
        told = seen.get(w)
        if told is None:
            key = w.rsplit("-", 1)[-1].lower()
            told = seen[w] = (key if key.translate(NO_APOSTROPHE).isalpha() else "", _is_given(w, model))
        key, is_given = told
        start, end = m.span()
        if not key or text[end : end + 1] == "@" or text[start - 1 : start] in ("@", "#"):
            last, last_given = "", False
            continue
        if len(w) == 1 and last_given and text[end : end + 1] == ".":
            continue  # an initial after a given name
        count = forms.setdefault(key, [0, 0])
        count[0] += 1
        if last_given and GAP_AFTER_GIVEN.fullmatch(text, last_end, start):
            count[1] += 1
        elif last and is_given and GAP_AFTER_FAMILY.fullmatch(text, last_end, start):
            forms[last][1] += 1
        last_end, last, last_given = end, key, is_given


def surname_endings(docs: DataFrame, given: set[str], text: str = "text", bound: int = MAX_ENDINGS) -> dict[str, float]:
    """Endings of 4 to 7 letters that two forms or more of all documents share, with the share of those that stand as surnames (``LEAST_BESIDE`` of
    the times, so that no chance meeting in a large corpus makes a surname), down to the next of ``LEVELS``. An ending that says the same as the
    next shorter one is left out, as ``Model.surname`` goes on to that."""
    bc = docs.sparkSession.sparkContext.broadcast(frozenset(given))

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms: dict[str, list[int]] = {}
        seen: dict[str, tuple[str, bool]] = {}
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(forms), pa.string()), *(pa.array([c[i] for c in forms.values()], pa.int64()) for i in (0, 1))], ["form", "n", "beside"])
        for rows in it:
            for t in rows.column("t").to_pylist():
                surname_forms(t, bc.value, forms, seen)
            if len(seen) > 500_000:
                seen.clear()
            if len(forms) > 200_000:
                yield out()
                forms.clear()
        yield out()

    forms = docs.select(F.col(text).alias("t")).filter("length(t) > 0").mapInArrow(part, "form string, n bigint, beside bigint").groupBy("form").agg(F.sum("n").alias("n"), F.sum("beside").alias("beside"))
    forms = forms.select("form", ((F.col("beside") > 0) & (F.col("beside") >= F.col("n") * LEAST_BESIDE)).alias("after"))
    ends = forms.filter("length(form) >= 4").select("after", F.explode(F.expr("transform(sequence(4, least(7, length(form))), k -> right(form, k))")).alias("ending"))
    share = ends.groupBy("ending").agg(F.count("*").alias("n"), F.sum(F.col("after").cast("int")).alias("hit")).filter("n >= 2")
    level = F.lit(0.0)
    for x in LEVELS:
        level = F.when(F.col("hit") / F.col("n") >= x, F.lit(x)).otherwise(level)
    share = share.select("ending", level.alias("level"))
    shorter = share.select(F.col("ending").alias("shorter"), F.col("level").alias("below"))
    rows = share.join(shorter, F.expr("substring(ending, 2)") == F.col("shorter"), "left").filter("level != coalesce(below, 0.0)").select("ending", "level").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} surname endings")
    return {r[0]: r[1] for r in rows}


def fit(texts: list[str], given: set[str], endings: dict[str, float], epochs: int = 5, rate: float = 0.3, decay: float = 1e-4) -> Model:
    model = Model(given=frozenset(given), endings=endings)
    data = []
    for t in texts:
        spans = candidates(t, model)
        _label(t, spans, model)
        for g in clusters(spans):
            unsure = [x for x in g if not x.gold and (x.kind == "name" and any(f in x.feats for f in ("n:known0hi", "n:known1mid", "n:known0mid")))]
            if unsure and not any(x.gold for x in g):
                continue  # perhaps a name whose given name is not listed
            data.append(g)
    w: dict[str, float] = defaultdict(float)
    for ep in range(epochs):
        step = rate / (1 + ep)
        for n, g in enumerate(data):
            feats = [x.feats for x in g]
            if (n + ep) % 3 == 0:  # hide the list of given names now and then, so unlisted ones can be learned
                feats = [[f.replace("known1", "known0") for f in x] for x in feats]
            if (n + ep) % 6 == 0:  # and the ending too, so that context alone can speak for a name
                feats = [[KNOWN.sub(":known0lo", f) for f in x] for x in feats]
            score = [sum(w[f] for f in fs) for fs in feats]
            for x, fs, p in zip(g, feats, _marginals(g, score)):
                d = step * ((1.0 if x.gold else 0.0) - p)
                if abs(d) > 1e-3:
                    for f in fs:
                        w[f] += d - step * decay * w[f]
    model.weights = {f: v for f, v in w.items() if abs(v) > 1e-3}
    model.lead = max([0.0] + [v for f, v in w.items() if f.startswith("n:w=")])
    model.most = sum(max([0.0] + [v for f, v in model.weights.items() if f.startswith(x)]) for x in ("n:given-sur", "n:fam-given", "n:mid", "n:row", "n:w=", "n:prev", "n>"))
    for form in ("gf", "fg", "f,g"):
        for known in (False, True):
            for level in ("lo", "mid", "hi"):
                model.base[form, known, level] = sum(model.weights.get(f, 0.0) for f in ("n", f"n:{form}", f"n:known{int(known)}{level}", f"n:{form}:known{int(known)}{level}"))
    return model


def find(text: str, model: Model) -> list[Span]:
    out: list[Span] = []
    for g in clusters(candidates(text, model)):
        out += best(g, model.weights)
    return sorted(out, key=lambda x: x.start)


def given_names(names: DataFrame, column: str = "given_name", bound: int = 200_000) -> set[str]:
    rows = names.select(column).filter(F.col(column).isNotNull()).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} given names")
    return {r[0] for r in rows}


def train(docs: DataFrame, names: DataFrame, doc: str = "doc_id", text: str = "text", bound: int = SAMPLE_DOCS) -> Model:
    d = docs.select(F.col(doc).alias("id"), F.col(text).alias("t")).filter("length(t) > 0")
    n = max(1, docs.select(doc).count())
    rows = d.filter(F.pmod(F.xxhash64("id", F.lit("pii")), F.lit(1 << 20)) < int(bound * (1 << 20) / n) + 1).select("t").distinct().collect()
    given = given_names(names)
    return fit(sorted(r[0] for r in rows), given, surname_endings(docs, given, text))


def _mapped(docs: DataFrame, model: Model, doc: str, text: str, fn, schema: str, names: list[str]) -> DataFrame:
    bc = docs.sparkSession.sparkContext.broadcast(model)  # bounded with the sample and the list of names
    d = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            cols: list[list] = [[] for _ in names]
            for i, t in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                for out in fn(i, t, bc.value):
                    for c, v in zip(cols, out):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], rows.column("doc_id").type), *(pa.array(c, pa.string()) for c in cols[1:])], names)

    kind = docs.schema[doc].dataType.simpleString()
    return d.mapInArrow(part, f"doc_id {kind}, {schema}")


def found(docs: DataFrame, names: DataFrame, doc: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """``doc_id, pii_kind, pii_value``: the different personal data of each document, as they stand in the text.
    Null and empty texts and an empty list of names are allowed; repeated rows give their values once."""
    model = model or train(docs, names, doc, text)

    def fn(i, t, m):
        return {(i, x.kind, t[x.start : x.end]) for x in find(t, m)} if t else ()

    return _mapped(docs, model, doc, text, fn, "pii_kind string, pii_value string", ["doc_id", "pii_kind", "pii_value"]).distinct()


def redact(docs: DataFrame, names: DataFrame, doc: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """``doc_id, text``: every row with its personal data replaced by ``[EMAIL]``, ``[PHONE]`` and so on; null stays null."""
    model = model or train(docs, names, doc, text)

    def fn(i, t, m):
        if not t:
            return [(i, t)]
        out, at = [], 0
        for x in find(t, m):
            out += [t[at : x.start], f"[{x.kind.upper()}]"]
            at = x.end
        return [(i, "".join(out) + t[at:])]

    return _mapped(docs, model, doc, text, fn, "text string", ["doc_id", "text"])
