"""Personal data: identifiers found in texts as they are, and behind disguises that keep their offsets.

Three transducers normalise a text one after the other: look-alike characters, spelled digits, and
words or signs for at and dot. Each returns its text with the places that it rewrote, so that a
span of its output leads back to the characters that it came from. The identifiers of the
normalised text that touch a rewritten place, and do not lie within a plain one of their kind, are
added to the plain ones.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*$")
# a start within digits fails where the start of the digits fails, so only that one is tried
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
DIGITS = re.compile(r"[0-9]+")

# Letters of other scripts that look like Latin ones, with those.
LOOKALIKES = {
    "асеһіјӏорѕхуԁԛԝ": "acehijlopsxydqw",
    "АВСЕНІЈКМОРЅТХУ": "ABCEHIJKMOPSTXY",
    "αονριυκχ": "aovpiukx",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX",
    "\u2010\u2011\u2012\u2013\u2014\u2212": "------", "\u2024\u3002": "..", "\u00a0\u2002\u2003\u2009\u3000": "     ",
    "ıɡɑ": "iga",
}
# Characters without width.
WIDTHLESS = "\u00ad\u034f\u180e\u200b\u200c\u200d\u2060\ufeff"
# Words for the digits 0 to 9 in English, German, French and Spanish, and for plus, at and dot.
DIGIT_WORDS = (
    "zero oh null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf fuenf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
)
PLUS, AT, DOT = "plus|más", "at|ät|arobase|arroba|klammeraffe", "dot|punkt|point|punto"
#: A bare word for at, with plain dots behind it, counts behind a local part with one of these only.
MARKED_LOCAL = re.compile(r"[0-9._%+-]")


def _alphabet() -> dict[int, str]:
    """Characters whose compatible form is one ASCII character (wide, mathematical, circled and the like), digits of every script, and look-alikes."""
    ranges = (range(0x2070, 0x2200), range(0x2460, 0x2500), range(0xFE50, 0xFF5F), range(0x1D400, 0x1D800), range(0x1F100, 0x1F190))
    out = {}
    for code in (c for r in ranges for c in r):
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and "!" <= plain <= "~":
            out[code] = plain
    for code in range(0x0660, 0x1FBFA):
        digit = unicodedata.decimal(chr(code), None)
        if digit is not None:
            out[code] = str(digit)
    for strange, plain in LOOKALIKES.items():
        out |= {ord(s): p for s, p in zip(strange, plain)}
    return out | {ord(c): "" for c in WIDTHLESS}


ALPHABET = _alphabet()
STRANGE = frozenset(map(chr, ALPHABET))
VALUE = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words.split()}
_LETTER = r"[^\W\d_]"
FORMS = sorted({f for w in VALUE for f in (w, w.upper(), w.capitalize())}, key=lambda w: (-len(w), w))
BY_FIRST = "|".join(f"{c}(?:{'|'.join(f[1:] for f in FORMS if f[0] == c)})" for c in sorted({f[0] for f in FORMS}))
#: Digit words in the usual cases, behind a character that is no letter.
SPELLED = re.compile(rf"[\W\d_]({BY_FIRST})(?!{_LETTER})")
TIMES = re.compile(r"(?:double|triple)[ -]$", re.I)
PLUS_BEFORE = re.compile(rf"(?<!{_LETTER})(?:{PLUS}|\+)[ -]?$", re.I)
_BRACKETED_DOT = rf"[ \t]{{0,2}}[(\[{{<][ \t]?(?:{DOT}|\.)[ \t]?[)\]}}>][ \t]{{0,2}}"
_ANY_DOT = rf"(?:{_BRACKETED_DOT}|[ \t]{{1,2}}(?:{DOT})[ \t]{{1,2}}|[ \t]\.[ \t]|&#0{{0,4}}46;|&period;)"
DIGIT_DOT, DIGIT_GAP = re.compile(_ANY_DOT, re.I), re.compile(r"[ \t]{0,2}[-,.]?[ \t]{0,2}")
DOT_IN_DIGITS = re.compile(rf"(?<=[0-9]){_ANY_DOT}(?=[0-9])", re.I)
LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI]{1,4}(?=[0-9])")
_LABEL, _DOTS = r"[A-Za-z0-9-]++", rf"(?:\.|{_ANY_DOT})"
_SURE_AT = rf"(?:[ \t]{{0,2}}[(\[{{<][ \t]?(?:{AT}|@)[ \t]?[)\]}}>][ \t]{{0,2}}|[ \t]@[ \t]|&#0{{0,4}}64;|&#x0{{0,4}}40;|&commat;|%40|@)"
_BARE_AT = rf"[ \t]{{1,2}}(?:{AT})[ \t]{{1,2}}"
#: Where an at may be, and the at with what may be a host behind it; the local part before it is looked at afterwards.
AT_MARK, AT_WORD = re.compile(r"[@%&(\[{<]"), re.compile(rf"[ \t](?:{'|'.join(f for w in AT.split('|') for f in (w, w.upper(), w.capitalize()))})[ \t]")
AT_SIGN = re.compile(rf"(?:(?P<sure>{_SURE_AT})|(?P<bare>{_BARE_AT}))(?P<host>{_LABEL}(?:{_DOTS}{_LABEL})+)", re.I)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the identifiers of a text, leftmost and without overlap within a kind, in time linear in its length."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
            free = host.end()
        else:
            free = at + 1
        at = text.find("@", free)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    plus = text.find("+")
    while plus >= 0:
        m = PHONE.match(text, plus)
        if m:
            end = m.end()
            while not text[end - 1].isdigit():
                end -= 1
            # at least one character between the first digit and the last
            if end - plus >= 4 and 10 <= sum(map(len, DIGITS.findall(text, plus, end))) <= 15:
                out.append(("phone", plus, end))
        plus = text.find("+", m.end() if m else plus + 1)
    return out


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


class Rewritten:
    """A text with some places replaced, and the way back."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        """``edits`` are (start, end, replacement) in order and without overlap."""
        parts, self.starts, self.ends, self.sources = [], [], [], []
        done = size = 0
        for start, end, put in edits:
            size += start - done
            parts += [text[done:start], put]
            self.starts.append(size)
            self.sources.append((start, end))
            size += len(put)
            self.ends.append(size)
            done = end
        self.text = "".join([*parts, text[done:]])

    def touched(self, start: int, end: int) -> bool:
        """Whether a span of the new text holds a replacement or a place where something went."""
        k = bisect_left(self.ends, start + 1)
        if k and self.starts[k - 1] == self.ends[k - 1] > start:
            return True
        return k < len(self.starts) and self.starts[k] < end

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The span of the old text from which a span of the new one came."""
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, last: bool) -> int:
        k = bisect_right(self.starts, at) - 1
        while k >= 0 and self.starts[k] == self.ends[k] and not last and self.starts[k] == at and k + 1 < len(self.starts) and self.starts[k + 1] == at:
            k += 1
        if k < 0:
            return at + last
        (start, end), new = self.sources[k], self.ends[k]
        return (end if last else start) if at < new else end + at - new + last


def plain_characters(text: str) -> list[tuple[int, int, str]]:
    """Edits that put ASCII characters for those that look like them, and take those without width away."""
    if text.isascii():
        return []
    met = STRANGE.intersection(text)
    return [(m.start(), m.end(), ALPHABET[ord(m.group())]) for m in re.finditer(f"[{''.join(met)}]", text)] if met else []


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits that put digits for their words beside each other or beside digits, a dot for its word between them, a plus for its word before them, and digits for letters among digits."""
    words = [_spelled(text, m.start(), m.end() - 1, VALUE[m.group(1).lower()]) for m in SPELLED.finditer(" " + text)]
    edits = [(m.start(), m.end(), m.group().translate({79: "0", 111: "0", 108: "1", 73: "1"})) for m in LETTER_DIGIT.finditer(text)]
    for k, (start, end, put) in enumerate(words):
        before = _joined(text, words[k - 1][1], start) if k else None
        after = _joined(text, end, words[k + 1][0]) if k + 1 < len(words) else None
        digit_before = re.search(rf"[0-9](?:[ .,-]|{_ANY_DOT})?$", text[max(0, start - 14) : start], re.I)
        digit_after = re.match(rf"(?:[ .,-]|{_ANY_DOT})?[0-9]", text[end : end + 14], re.I)
        # a word alone counts between digits, or behind or before a disguised dot
        dotted = any(d and len(d.group()) > 2 for d in (digit_before, digit_after))
        if before is None and after is None and not dotted and not (digit_before and digit_after):
            continue
        if before is None:
            if sign := PLUS_BEFORE.search(text, max(0, start - 8), start):
                edits.append((sign.start(), start, "+"))
            elif digit_before and (dot := re.search(rf"{_ANY_DOT}$", text[max(0, start - 14) : start], re.I)):
                edits.append((start - len(dot.group()), start, "."))
        edits.append((start, end, put))
        if after is not None:
            edits.append((end, words[k + 1][0], after))
        elif digit_after and (dot := re.match(_ANY_DOT, text[end : end + 14], re.I)):
            edits.append((end, end + dot.end(), "."))
    taken = {e[0] for e in edits}
    edits += [(*m.span(), ".") for m in DOT_IN_DIGITS.finditer(text) if m.start() not in taken]
    return sorted(edits)


def _spelled(text: str, start: int, end: int, digit: str) -> tuple[int, int, str]:
    """Start, end and digits of a digit word, with a double or triple before it."""
    times = TIMES.search(text, max(0, start - 7), start)
    return (times.start(), end, digit * (2 if times.group()[0] in "dD" else 3)) if times else (start, end, digit)


def _joined(text: str, end: int, start: int) -> str | None:
    """What stands between two digits whose words have this gap; None if they do not belong together."""
    if start - end > 14:
        return None
    gap = text[end:start]
    return "." if DIGIT_DOT.fullmatch(gap) else "" if DIGIT_GAP.fullmatch(gap) else None


def at_and_dot(text: str) -> list[tuple[int, int, str]]:
    """Edits that put @ and dots for what stands for them between a local part and a host.

    A bare word for at needs a disguised dot behind it, or a local part that no plain word is.
    """
    edits = []
    places = sorted([m.start() for m in AT_MARK.finditer(text)] + [m.start() for m in AT_WORD.finditer(text)])
    done = 0
    for place in places:
        while place > done and text[place - 1] in " \t":
            place -= 1
        place = max(done, place)
        while place < len(text) and text[place] in " \t" and text[place + 1 : place + 3].isspace():
            place += 1  # no more than two blanks belong to a sign
        m = AT_SIGN.match(text, place)
        if not m:
            continue
        done = m.end()
        sign = "sure" if m.group("sure") else "bare"
        dots = [d for d in re.finditer(_ANY_DOT, m.group("host"), re.I)]
        if m.group(sign) == "@" and not dots:
            continue
        local = LOCAL.search(text[max(0, m.start() - 64) : m.start()]).group()
        if not local or not re.search(r"[A-Za-z]{2,}$", m.group("host")) or (sign == "bare" and not dots and not MARKED_LOCAL.search(local.strip(".-"))):
            continue
        edits.append((*m.span(sign), "@"))
        edits += [(m.start("host") + d.start(), m.start("host") + d.end(), ".") for d in dots]
    return edits


TRANSDUCERS = (plain_characters, spelled_digits, at_and_dot)


def spans(text: str | None) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, base, value) in order of start and kind; ``value`` is the identifier without its disguise."""
    if not text:
        return []
    plain = plain_spans(text)
    out = [(*s, True, text[s[1] : s[2]]) for s in plain]
    steps, now = [], text
    for transducer in TRANSDUCERS:
        if edits := transducer(now):
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if steps:
        held = {kind: [(a, b) for k, a, b in plain if k == kind] for kind in KINDS}
        for kind, start, end in plain_spans(now):
            a, b, touched = start, end, False
            for step in reversed(steps):
                touched = touched or step.touched(a, b)
                a, b = step.back(a, b)
            k = bisect_right(held[kind], (a, len(text) + 1)) - 1
            if touched and not (k >= 0 and b <= held[kind][k][1]):
                out.append((kind, a, b, False, now[start:end]))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), not s[3], s[2]))


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean, value: string>>"


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """The documents with their spans, in code points from 0 with the end exclusive; a null or empty text has none.

    Every row is judged by itself and whole, so repeated rows return each and other columns pass
    as they are; a column named like ``out`` is replaced.
    """

    @F.pandas_udf(SPANS)
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(("kind", "start", "end", "base", "value"), s)) for s in spans(t)])

    return docs.withColumn(out, found(F.col(text)))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest of the plain spans, the list of all spans."""
    got = with_spans(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return got.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"),
    )
