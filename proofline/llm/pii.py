"""Personal data found from anchors.

One Aho-Corasick pass finds the signs that personal data cannot do without: at-signs, plus
signs, digits, schemes and identifier cues. A deterministic parser then expands each
anchor to its boundaries and validates what it finds; nothing else of the text is parsed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from proofline.llm import tables

# kinds that have an exact definition, in the order in which they are listed
BASE_KINDS = ("email", "ip", "card", "phone")
# kinds that the anchors add
MORE_KINDS = ("iban", "ssn", "account", "login")
KINDS = BASE_KINDS + MORE_KINDS
_RANK = {kind: i for i, kind in enumerate(KINDS)}

_CUES = {"iban": ("iban",), "ssn": ("ssn", "social security"), "account": ("account", "acct")}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"(?:\s(?:number|no\.?))?[\s:#]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?:\s(?:number|no\.?))?[\s:#]{0,4}([0-9]{6,17})(?![0-9])")
_USER_INFO = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")


def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for sign in "@+0123456789":
        made.add_word(sign, ("digit" if sign.isdigit() else sign, 1))
    made.add_word("://", ("scheme", 3))
    for kind, cues in _CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                made.add_word(form, (kind, len(form)))
    made.make_automaton()
    return made


_ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and _luhn(digits)


def _is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def _is_phone(text: str) -> bool:
    return 10 <= sum(c in "0123456789" for c in text) <= 15


def _is_iban(text: str) -> bool:
    code = text.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _is_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


_CUED = {"iban": (_IBAN, _is_iban), "ssn": (_SSN, _is_ssn), "account": (_ACCOUNT, lambda text: True)}


def find(text: str) -> list[tuple[int, int, str]]:
    """The spans (start, end, kind) of a text, by start and then by kind.

    Base kinds are the leftmost matches of their patterns that do not overlap; a match that
    fails its check is dropped but has used up its signs.
    """
    found: list[tuple[int, int, str]] = []
    # where the last match of each kind ended
    email_end = ip_end = card_end = phone_end = more_end = 0
    for last, (anchor, size) in _ANCHORS.iter(text):
        at = last - size + 1
        if anchor == "digit":
            # a match begins where its digits begin
            if at and text[at - 1] in "0123456789":
                continue
            if at >= ip_end and (m := _IP.match(text, at)):
                ip_end = m.end()
                if _is_ip(m.group()):
                    found.append((at, ip_end, "ip"))
            if at >= card_end and (m := _CARD.match(text, at)):
                card_end = m.end()
                if _is_card(m.group()):
                    found.append((at, card_end, "card"))
        elif anchor == "@":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email_end = m.end()
                found.append((start, email_end, "email"))
        elif anchor == "+":
            if at >= phone_end and (m := _PHONE.match(text, at)):
                phone_end = m.end()
                if _is_phone(m.group()):
                    found.append((at, phone_end, "phone"))
        elif anchor == "scheme":
            start = at
            while start > more_end and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _USER_INFO.match(text, last + 1)):
                more_end = m.end()
                found.append((start, more_end, "login"))
        elif not (at and text[at - 1].isalpha()):
            shape, valid = _CUED[anchor]
            m = shape.match(text, last + 1)
            if m and m.start(1) >= more_end and valid(m.group(1)):
                more_end = m.end(1)
                found.append((m.start(1), more_end, anchor))
    return sorted(found, key=lambda s: (s[0], _RANK[s[2]]))


_SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, value: string>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [
            [{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in find(text)]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end, value) of every row, without a shuffle.

    Positions are code points and ``end`` is exclusive. A null text is an empty one and has
    an empty list; null and repeated doc_ids give a row for each row; an empty table gives
    none. Other columns are not looked at. A task holds one Arrow batch of texts at a time.
    """
    return tables.texts(docs).mapInArrow(_scan, _SPANS)
