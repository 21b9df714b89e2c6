"""Personal data by anchor expansion.

Aho-Corasick finds anchors: at-signs, plus signs, digits, address schemes and
identifier cues. A parser per anchor widens it to the exact bounds of an
email, number, address or account and validates what it found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import arrow_map

#: Base kinds in the order of the digest, then the kinds that the anchors add.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "address")

# Patterns of the four base kinds, as parts to apply at an anchor.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IP_RUN, _CARD_RUN = re.compile(r"[0-9.]+"), re.compile(r"[0-9\x20-]+")

_URL_BODY = re.compile(r"[^\s<>\"'(){}\[\]|\\^`]+")
_IBAN = re.compile(r"[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\x20(?:no|nr|number|num|id))?[.:#\x20]{0,4}([A-Z]{0,3}[0-9][0-9-]{4,20}[0-9])(?![A-Za-z0-9])")
_STREET_AFTER = re.compile(r"(?<![\w.])[0-9]{1,5}[A-Za-z]?,?\x20(?:[A-Z][\w'.-]*\x20){0,3}[A-Z][\w'-]*$")
_NUMBER_AFTER = re.compile(r"\x20(?:[A-ZÄÖÜ][\w'-]*\x20?){0,4}[0-9]{1,5}[a-z]?\b")

SCHEMES = ("http", "https", "ftp")
IBAN_CUES = ("IBAN", "Iban", "iban")
ACCOUNT_CUES = ("account", "Account", "acct", "Acct", "SSN", "ssn", "passport", "Passport", "tax id", "Tax ID",
                "Kontonummer", "cuenta", "Cuenta", "compte", "Compte")
STREETS_AFTER = (" Street", " St.", " Avenue", " Ave.", " Road", " Rd.", " Lane", " Boulevard", " Blvd.", " Drive")
STREETS_BEFORE = ("rue", "Rue", "calle", "Calle", "avenida", "Avenida")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, anchors in (("@", "@"), ("+", "+"), ("0", "0123456789"), ("url", ["://"]), ("iban", IBAN_CUES),
                          ("account", ACCOUNT_CUES), ("after", STREETS_AFTER), ("before", STREETS_BEFORE)):
        for anchor in anchors:
            found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _iban_holds(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _run_around(text: str, at: int, signs: str) -> tuple[int, int]:
    start = end = at
    while start and text[start - 1] in signs:
        start -= 1
    while end < len(text) and text[end] in signs:
        end += 1
    return start, end


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive; by kind as listed in KINDS, then by start.

    Base matches are leftmost and do not overlap within their kind. No match
    reaches beyond the run of signs its kind allows, so it is enough to scan
    the run around an anchor.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    seen = dict.fromkeys(("email", "ip", "card", "url", "iban", "account", "address"), 0)
    for last, (kind, size) in automaton.iter(text):
        at = last + 1 - size
        if kind == "@":
            start = at
            while start > seen["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                found["email"].append((start, m.end()))
                seen["email"] = m.end()
        elif kind == "+":
            m = _PHONE.match(text, at)
            if m and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found["phone"].append(m.span())
        elif kind == "0":
            if at >= seen["ip"]:
                start, end = _run_around(text, at, "0123456789.")
                seen["ip"] = end
                for m in _IP.finditer(text, start, end):
                    # leading zeros do not count towards the 255
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        found["ip"].append(m.span())
            if at >= seen["card"]:
                start, end = _run_around(text, at, "0123456789 -")
                seen["card"] = end
                if end - start >= 13:
                    for m in _CARD.finditer(text, start, end):
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 13 <= len(digits) <= 19 and luhn(digits):
                            found["card"].append(m.span())
        elif kind == "url":
            start = at
            while start > seen["url"] and text[start - 1].isascii() and text[start - 1].isalpha() and at - start < 5:
                start -= 1
            if text[start:at].lower() in SCHEMES and (m := _URL_BODY.match(text, last + 1)):
                end = last + 1 + len(m[0].rstrip(".,;:!?"))
                if end > last + 1:
                    found["url"].append((start, end))
                    seen["url"] = end
        elif kind == "iban":
            if at >= seen["iban"] and (m := _IBAN.match(text, last + 1)) and _iban_holds(m[1]):
                found["iban"].append(m.span(1))
                seen["iban"] = m.end(1)
        elif kind == "account":
            if at >= seen["account"] and (m := _ACCOUNT.match(text, last + 1)):
                found["account"].append(m.span(1))
                seen["account"] = m.end(1)
        elif kind == "after":
            m = _STREET_AFTER.search(text, max(seen["address"], at - 80), at)
            if m and not text[last + 1 : last + 2].isalpha():
                found["address"].append((m.start(), last + 1))
                seen["address"] = last + 1
        elif at >= seen["address"] and not text[max(at - 1, 0) : at].isalpha():
            if m := _NUMBER_AFTER.match(text, last + 1):
                found["address"].append((at, m.end()))
                seen["address"] = m.end()
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end), for each row; the whole text is read.

    A null or empty text has no spans. Rows that repeat are read each; a null
    doc_id stays null. Other columns of the input are not read.
    """
    holder: list[ahocorasick.Automaton] = []
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not holder:
            holder.append(_automaton())
        spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t or "", holder[0])]
                 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(plain, work, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def masked(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with every span of the text replaced by its kind in angle brackets."""
    names = docs.columns
    holder: list[ahocorasick.Automaton] = []

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not holder:
            holder.append(_automaton())
        texts = []
        for text in batch.column("text").to_pylist():
            parts, done = [], 0
            for kind, start, end in sorted(find_spans(text or "", holder[0]), key=lambda s: (s[1], -s[2])):
                if end <= done:
                    continue
                parts += [text[done : max(start, done)], f"<{kind}>"]
                done = end
            texts.append(None if text is None else "".join([*parts, text[done:]]))
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).select(names)

    return arrow_map(docs, work, docs.schema)
