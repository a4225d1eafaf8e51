"""Personal data, plain or disguised, with offsets into the source text.

Plain data are found in the text as it stands. Disguised data are found in a
normalised copy: transducers turn look-alike letters, wide forms, spelled digits and
written-out "at" and "dot" into plain characters and note, for every character they
write, the source span it stands for. Characters that show nothing are left out.
Identifiers found there that rest on a replacement or on an omission map back to source spans. Plain findings stay as they are; a disguised
one inside a plain one of its kind is the same and is left out.

Spans count code points, end exclusive.

Cases: a null or empty text has no spans; ids and rows may repeat, each row is
searched alone; tables may be empty; other columns are left behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import prepare, slices

Span = tuple[int, int]

#: Kinds in the order they are listed.
KINDS = ("email", "ip", "card", "phone")

#: Characters of an address, and the forms of the other kinds.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number's digits are all taken or none, so a search never begins inside one.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

#: Letters of other scripts beside the Latin ones they look like.
LOOK_ALIKES = {
    "a": "аα", "b": "Ьβ", "c": "сϲ", "d": "ԁ", "e": "еε", "h": "һ", "i": "іι", "j": "ј",
    "k": "кκ", "m": "м", "n": "ո", "o": "оο", "p": "рρ", "s": "ѕ", "t": "тτ", "u": "υ",
    "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ",
    "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "Υ", "Z": "Ζ", ".": "․。｡", "-": "‐‑‒–−", "@": "﹫",
}
#: Digits as words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
#: Characters that show nothing.
UNSEEN = "­​‌‍⁠﻿"

# Wide forms of the ASCII characters lie at a fixed distance from them.
WIDE = {chr(code + 0xFEE0): chr(code) for code in range(0x21, 0x7F)}
PLAIN = {alike: plain for plain, all_ in LOOK_ALIKES.items() for alike in all_} | WIDE
PLAIN |= dict.fromkeys(UNSEEN, "")

_ODD = "[" + "".join(map(re.escape, PLAIN)) + "]"
_NUMBER = "(?:" + "|".join(DIGIT_WORDS) + ")"
# A run of white space is tried from its beginning only, and never a part of it.
_OPEN, _SHUT = r"(?:(?<!\s)\s++)?[\[({<]\s*+", r"\s*+[\])}>]\s*+"
_NAME = r"[A-Za-z0-9][A-Za-z0-9-]*"
#: Last names that make an address of words around a spoken "at".
TOP_NAMES = (
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs "
    "bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee "
    "eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm "
    "hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb "
    "lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz "
    "na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs "
    "ru rw sa sb sc sd se sg sh si sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl "
    "tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw "
    "com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat "
    "asia post academy agency app art bank bio blog build business cafe capital care center city "
    "cloud club codes community company computer consulting design dev digital doctor earth email "
    "energy engineer events exchange expert family finance fund fyi games global group guru health "
    "help host house ink institute insure international law legal life link live lol love ltd "
    "market marketing media money network news ninja one online page partners photo photography "
    "pub restaurant school science services shop site social software solutions space store studio "
    "support systems team tech technology today tools top training university vip website wiki "
    "work works world wtf xyz zone"
).split()
#: Last names that were always taken, and words of prose that name no domain: "at the dot to".
COMMON = "com org net edu gov info io eu uk de fr es it nl at ch pt br mx us ca au in jp cn ru".split()
PROSE = "a an another any each every her his its my no one our some that the their this which your".split()
#: What a transducer rewrites, one alternative each.
ODD = re.compile(_ODD)
BRACKETED = re.compile(f"{_OPEN}(?:(?P<at>at|@)|(?P<dot>dot|\\.)){_SHUT}", re.I)
#: An at between a local part and a domain, and a spoken dot between two names.
AT = re.compile(rf"(?<=[A-Za-z0-9._%+-])@(?={_NAME})|(?<=[A-Za-z0-9_])\s+at\s+(?={_NAME})", re.I)
DOT = re.compile(r"(?<!\s)\s++dot\s++", re.I)
LOCAL_DOT = re.compile(r"(?<=[A-Za-z0-9_])\s+dot\s+(?=[A-Za-z0-9_%+-])", re.I)
DOMAIN_NAME = re.compile(_NAME)
NUMBERS = re.compile(
    rf"(?:\bplus\s+)?\b{_NUMBER}(?:(?:[\s-]+dot\s+|[\s-]+){_NUMBER})+\b", re.I
)
#: Texts without any of these have nothing to rewrite: each transducer's own pattern, or a
#: part that all it rewrites has, so no identifier's result depends on text far from it.
HINTS = (
    ODD,
    re.compile(r"[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]", re.I),
    re.compile(r"\sdot\s", re.I),
    NUMBERS,
)
WORD = re.compile(rf"{_NUMBER}|dot|plus", re.I)

SPANS = "doc_id long, spans array<struct<kind: string, start: int, stop: int, base: boolean>>"


def emails(text: str) -> list[Span]:
    """Addresses: what stands before each at sign, back to where the last one ended."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return found


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(map(_at_most_255, m[0].split(".")))]


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        digits = "".join(DIGIT.findall(m[0])) if len(m[0]) < 64 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(DIGIT.findall(m[0])) <= 15]


def plain_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in a text as it stands."""
    digits = DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if digits else [],
        "card": cards(text) if digits else [],
        "phone": phones(text) if digits and "+" in text else [],
    }


class Normalised:
    """A text under rewriting, with the source span of every character."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start = np.arange(len(text))
        self.stop = self.start + 1
        self.new = np.zeros(len(text), bool)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Put strings in place of stretches, given in order.

        Each character written stands for the whole stretch.
        """
        if not changes:
            return
        text, start, stop, new, done = [], [], [], [], 0
        for a, b, put in changes:
            text += [self.text[done:a], put]
            first, last = self.start[a], self.stop[b - 1]
            start += [self.start[done:a], np.full(len(put), first)]
            stop += [self.stop[done:a], np.full(len(put), last)]
            new += [self.new[done:a], np.ones(len(put), bool)]
            done = b
        text.append(self.text[done:])
        self.text = "".join(text)
        self.start = np.concatenate([*start, self.start[done:]])
        self.stop = np.concatenate([*stop, self.stop[done:]])
        self.new = np.concatenate([*new, self.new[done:]])

    def source(self, span: Span) -> Span:
        return int(self.start[span[0]]), int(self.stop[span[1] - 1])

    def changed(self, span: Span) -> bool:
        """Whether anything in the span was written anew or left out."""
        a, b = self.source(span)
        return b - a != span[1] - span[0] or bool(self.new[span[0] : span[1]].any())


def _numbers(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words, with "dot" and "plus" in them, as digits and marks."""
    marks = DIGIT_WORDS | {"dot": ".", "plus": "+"}
    return [
        (m.start(), m.end(), "".join(marks[w.lower()] for w in WORD.findall(m[0])))
        for m in NUMBERS.finditer(text)
    ]


def _known(names: list[str]) -> bool:
    """Whether names after a spoken "at" are a domain and not prose."""
    first, last = names[0].lower(), names[-1].lower()
    return last in COMMON or (last in TOP_NAMES and first not in PROSE)


def _domain(held: Normalised, start: int, spoken: bool) -> tuple[int, list[Span], bool]:
    """The domain behind an at: its end, its spoken dots, and whether any dot is written out.

    Dots are plain or spoken. Behind a spoken at, it ends with a known last name.
    """
    text, names, dots, found = held.text, [], [], (start, [], False)
    at, written = start, False
    while name := DOMAIN_NAME.match(text, at):
        names.append(name[0])
        if len(names) > 1 and (not spoken or _known(names)):
            found = name.end(), list(dots), written
        at = name.end()
        dot = DOT.match(text, at)
        if dot:
            dots.append(dot.span())
            written, at = True, dot.end()
        elif text[at : at + 1] == ".":
            written |= bool(held.new[at])
            at += 1
        else:
            break
    return found


def _marks(held: Normalised) -> list[tuple[int, int, str]]:
    """Spoken marks of addresses, whose other marks may be plain by now, as "@" and ".".

    A spoken at with only plain dots around is prose ("look at example.com").
    """
    text, changes, done = held.text, [], 0
    before = [m.span() for m in LOCAL_DOT.finditer(text)]
    passed = 0
    for m in AT.finditer(text):
        if m.start() < done:
            continue
        spoken = m[0] != "@"
        end, dots, written = _domain(held, m.end(), spoken)
        # Spoken dots whose next name reaches to the at or to the next such dot.
        while passed < len(before) and before[passed][1] <= m.start():
            passed += 1
        own, place, first = [], passed - 1, m.start()
        while place >= 0 and before[place][0] >= done:
            a, b = before[place]
            if not LOCAL.fullmatch(text, b, first):
                break
            own.append((a, b))
            place, first = place - 1, a
        if spoken and not written and not own:
            begin = first
            while begin > done and LOCAL.match(text[begin - 1]):
                begin -= 1
            own_dots = [i for i in range(begin, first) if text[i] == "."]
            written = bool(held.new[own_dots].any()) if own_dots else False
        if end == m.end() or (spoken and not written and not own):
            continue
        changes += [(a, b, ".") for a, b in reversed(own)]
        if spoken:
            changes.append((*m.span(), "@"))
        changes += [(a, b, ".") for a, b in dots]
        done = end
    return changes


def normalised(text: str) -> Normalised:
    """The text after all transducers."""
    held = Normalised(text)
    held.rewrite([(*m.span(), PLAIN[m[0]]) for m in ODD.finditer(held.text)])
    held.rewrite(
        [(*m.span(), "@" if m["at"] else ".") for m in BRACKETED.finditer(held.text)]
    )
    held.rewrite(_numbers(held.text))
    held.rewrite(_marks(held))
    return held


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans of a text by kind and start; the last entry tells plain ones."""
    text = text or ""
    found = plain_spans(text)
    added: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if any(hint.search(text) for hint in HINTS):
        held = normalised(text)
        for kind, spans in plain_spans(held.text).items():
            for span in spans:
                if held.changed(span):
                    a, b = held.source(span)
                    if not any(c <= a and b <= d for c, d in found[kind]):
                        added[kind].append((a, b))
    return [
        (kind, a, b, base)
        for kind in KINDS
        for a, b, base in sorted(
            [(a, b, True) for a, b in found[kind]] + [(a, b, False) for a, b in added[kind]]
        )
    ]


def personal_data(docs: DataFrame) -> DataFrame:
    """Each document's spans, by kind and start; ``base`` tells plain from disguised."""
    prepare(docs.sparkSession)
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "stop", "base")
        for batch in slices(batches):
            found = [
                [dict(zip(names, span)) for span in spans_of(text)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "spans": pa.array(found, kind)}
            )

    return docs.select("doc_id", "text").mapInArrow(run, SPANS)
