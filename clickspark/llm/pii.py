"""Personal data by offset-preserving deobfuscation.

Base identifiers (e-mail, IP address, card and phone number) are matched in
the text as it stands.  Then transducers rewrite disguises: look-alike
characters, spelled digits, and "at" / "dot" in words or brackets.  Each
rewrite keeps a map from normalised to source positions; identifiers found in
the normalised text are mapped back, and those that touch no base span are
added.  Base spans always stay.

Offsets are code points, end exclusive.  Null texts count as empty and have
no spans; repeated rows each get their own row.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import map_text, pick, positional

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Patterns that begin with a run (of digits, of white space) start where the
# run does: a match from inside it would have been one from its start, and a
# search from every character of a long run would never end.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Matches of local part, ``@`` and dotted domain, found from each ``@``:
    the leftmost match through it starts at its run of local characters."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def detect(text: str) -> dict[str, list[Span]]:
    ips, cards, phones = [], [], []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            ips.append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = NOT_DIGIT.sub("", m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                cards.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                phones.append(m.span())
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKE = dict(zip("аеорсхуіјѕһԁӏАВЕКМНОРСТХІЈЅοανικρυτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                     "aeopcxyijshdlABEKMHOPCTXIJSoavikputABEZHIKMNOPTYX"))
# Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digit words of four languages, 0 to 9.
DIGIT_WORDS = [
    "zero one two three four five six seven eight nine".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
]
DIGIT_OF = {w: str(d) for words in DIGIT_WORDS for d, w in enumerate(words)} | {"oh": "0"}

#: Full-width, mathematical and circled forms and foreign digits follow the
#: compatibility decomposition; only characters above Latin are looked at.
SUSPECT = re.compile("[" + INVISIBLE + "".join(LOOKALIKE)
                     + "٠-٩۰-۹०-९⁰-ₜ①-ⓩ"
                     + "﹒﹫！-～\U0001d400-\U0001d7ff]")
START = r"(?<!\s)\s+"
AT = rf"(?:{START})?" r"[\[({<]\s*(?:at|arroba|@)\s*[\])}>]\s*"
DOT = rf"(?:{START})?" r"[\[({<]\s*(?:dot|punto|point|punkt|\.)\s*[\])}>]\s*" rf"|{START}dot\s+"
LABEL = r"[A-Za-z0-9-]+"
# Words without brackets: "point" is also English ("at this point in"), so it
# is a dot only after a word that is always an at sign.
DOT_WORDS = rf"{DOT}|{START}(?:punto|punkt)\s+"
BARE = re.compile(rf"(?:(?P<arroba>{AT}|{START}arroba\s+)|{START}at\s+)(?P<domain>{LABEL}"
                  rf"(?:(?:\.|{DOT_WORDS}|(?(arroba){START}point\s+|(?!)))(?:{LABEL}))+)", re.I)
BARE_HINT = ("arroba", "punto", "punkt")
BARE_DOT = re.compile(rf"{START}(?:punto|punkt|point)\s+", re.I)
DISGUISE = re.compile(
    rf"(?P<at>{AT}|{START}at\s+(?={LABEL}(?:\.{LABEL})*(?:{DOT}){LABEL})|(?:{START})?@\s+(?={LABEL}(?:\.|{DOT})"
    rf"{LABEL})|{START}@(?={LABEL}(?:\.|{DOT}){LABEL}))|(?P<dot>{DOT})", re.I)
HINT = re.compile(r"[\[({<]\s*(?:at|arroba|@|dot|punto|point|punkt|\.)\s*[\])}>]|\sdot\s|@\s|\s@", re.I)
_WORD = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_ITEM = rf"(?:{_WORD}|[0-9]+)"
_GAP = r"(?:[\s,-]+|\s+(?:dot|punto|point|punkt)\s+|\s*\.\s*)"
SPELLED = re.compile(rf"(?<!\w)(?:(?:plus|más|\+)\s*)?{_ITEM}(?:{_GAP}{_ITEM}){{3,}}(?!\w)", re.I)
SPELLED_HINT = re.compile(rf"(?<!\w)(?:{_WORD})[\s,.-]+(?:(?:dot|punto|point|punkt)\s+)?{_ITEM}(?!\w)", re.I)
_TOKEN = re.compile(rf"(?P<word>{_WORD})|(?P<num>[0-9]+)|(?P<plus>plus|más|\+)"
                    r"|(?P<dot>dot|punto|point|punkt|\.)|.", re.I | re.S)

Piece = tuple[str, int, int]  # text written, source start, source end


def _homoglyphs(text: str) -> list[Piece]:
    out = []
    for m in SUSPECT.finditer(text):
        c = m[0]
        new = "" if c in INVISIBLE else LOOKALIKE.get(c) or unicodedata.normalize("NFKC", c)
        if len(new) == 1 and not new.isascii() and new.isdigit():
            new = str(unicodedata.digit(new))
        if new != c:
            out.append((new, m.start(), m.end()))
    return out


def _spelled(text: str) -> list[Piece]:
    out = []
    if not SPELLED_HINT.search(text):
        return out
    for m in SPELLED.finditer(text):
        if not any(t.lastgroup == "word" for t in _TOKEN.finditer(m[0])):
            continue
        for t in _TOKEN.finditer(m[0]):
            a, b = m.start() + t.start(), m.start() + t.end()
            kind = t.lastgroup
            new = (DIGIT_OF[t[0].lower()] if kind == "word" else t[0] if kind == "num"
                   else "+" if kind == "plus" else "." if kind == "dot" else "")
            if new != t[0]:
                out.append((new, a, b))
    return out


def _disguises(text: str) -> list[Piece]:
    out, hinted = [], HINT.search(text)
    if hinted:
        out = [("@" if m.lastgroup == "at" else ".", m.start(), m.end())
               for m in DISGUISE.finditer(text)]
    low = text.lower()
    if hinted or any(w in low for w in BARE_HINT):
        taken = [(a, b) for _, a, b in out]
        out = sorted(out + [x for x in _bare(text) if not _touches(taken, x[1], x[2])],
                     key=lambda x: x[1])
    return out


def _bare(text: str) -> list[Piece]:
    """At and dot words of other languages, where a domain follows."""
    out = []
    for m in BARE.finditer(text):
        dots = [(".", d.start(), d.end()) for d in BARE_DOT.finditer(text, m.start("domain"), m.end())]
        if dots or m["arroba"]:
            out += [("@", m.start(), m.start("domain")), *dots]
    return out


class Rewritten:
    """A normalised text with its map to the source."""

    def __init__(self, text: str, pieces: list[Piece]):
        parts, self.at, self.src = [], [], []  # normalised start -> (source start, end)
        pos = done = 0
        for new, a, b in pieces:
            if a > done:
                parts.append(text[done:a])
                self.at.append(pos)
                self.src.append((done, a, False))
                pos += a - done
            if new:
                parts.append(new)
                self.at.append(pos)
                self.src.append((a, b, True))
                pos += len(new)
            done = b
        parts.append(text[done:])
        self.at.append(pos)
        self.src.append((done, len(text), False))
        self.text = "".join(parts)

    def source(self, start: int, end: int) -> Span:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a, _, whole = self.src[i]
        b, b_end, whole_end = self.src[j]
        return (a if whole else a + start - self.at[i],
                b_end if whole_end else b + end - self.at[j])


def spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans of a text, by kind."""
    base = detect(text)
    chain, now = [], text
    for transducer in (_homoglyphs, _spelled, _disguises):
        pieces = transducer(now)
        if pieces:
            chain.append(Rewritten(now, pieces))
            now = chain[-1].text
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if chain:
        taken = sorted(s for found in base.values() for s in found)
        for kind, found in detect(now).items():
            for a, b in found:
                for step in reversed(chain):
                    a, b = step.source(a, b)
                if not _touches(taken, a, b):
                    added[kind].append((a, b))
    return base, added


def _touches(taken: list[Span], a: int, b: int) -> bool:
    """``taken`` is sorted; spans of one kind are disjoint, so at most a few
    of the spans that start before ``b`` can reach past ``a``."""
    i = bisect_right(taken, (b - 1, 1 << 62))
    return any(y > a for _, y in taken[max(0, i - 2 * len(KINDS)):i])


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])


def _listed(found: dict[str, list[Span]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k in KINDS for a, b in sorted(found[k])]


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``added``: spans (kind, start, end) in the
    order of kinds, then start."""
    src = pick(df, doc_id=id_col, text=text_col)

    def row(_, text):
        base, added = spans(text)
        return _listed(base), _listed(added)
    return map_text(src, row, [T.StructField("base", T.ArrayType(SPAN)),
                               T.StructField("added", T.ArrayType(SPAN))])


def redact_text(text: str) -> str:
    """The text with every span, base or added, replaced by its kind; spans
    that overlap become one, named after the first."""
    base, added = spans(text)
    every = sorted((a, b, k) for found in (base, added) for k in KINDS for a, b in found[k])
    out, done = [], 0
    for a, b, k in every:
        if a >= done:
            out.append(text[done:a] + f"[{k.upper()}]")
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``df``, with personal data in ``text_col`` replaced;
    null texts stay null."""
    flat, names = positional(df)
    col = f"_p{names.index(text_col)}"
    done = map_text(flat.withColumn("_null", F.col(col).isNull()), lambda _, t: (redact_text(t),),
                    [T.StructField("_new", T.StringType())], text=col)
    new = F.when(~F.col("_null"), F.col("_new")).alias(col)
    return done.select(*[new if f"_p{i}" == col else F.col(f"_p{i}")
                         for i in range(len(names))]).toDF(*names)
