"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, dots before a digit,
digits, plus signs, schemes and identifier cues. From each anchor a local parser
expands to the boundaries and validates them. Nothing else of a text is looked at.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` follow the fixed rules below
(leftmost, not overlapping within a kind; a match that fails its check is
dropped and not retried). ``account`` is added by the method: an IBAN behind its
cue that passes the mod-97 check, and the user and password of a URL.

Defined cases: NULL counts as empty and has no spans. Ends are exclusive and
offsets count code points. Rows are independent, so repeats, ties, NULL ids and
extra columns need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches

KINDS = ("email", "ip", "card", "phone", "account")
BASE = KINDS[:4]
# The boundaries of each kind, applied at an anchor only.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[\x20:=#-]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_LENGTHS = {part[:2]: int(part[2:]) for part in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
    "MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 "
    "SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_HEAD = re.compile(r"[\x20:=#-]{0,3}([A-Z]{2})[0-9]{2}")
_BY_LENGTH = {n: re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (
    (n - 4) // 4, r"\x20?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "")) for n in set(_LENGTHS.values())}
_LOGIN = re.compile(r"([A-Za-z0-9._~%!$&*+,;=-]+:[A-Za-z0-9._~%!$&*+,;=-]+)@")
_DIGITS = frozenset("0123456789")
SPANS = "array<struct<kind:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    compact = value.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def iban_at(text: str, at: int) -> tuple[int, int] | None:
    """Bounds of the valid IBAN behind a cue that ends at ``at``: of its country's length, or else as far as it goes."""
    head = _HEAD.match(text, at)
    if head is None:
        return None
    if head[1] in _LENGTHS:
        exact = _BY_LENGTH[_LENGTHS[head[1]]].match(text, head.start(1))
        if exact is not None and iban_valid(exact[0]):
            return exact.span()
    match = _IBAN.match(text, at)
    return match.span(1) if match is not None and iban_valid(match[1]) else None


def automaton():
    """The anchors; each hit carries the anchor's length and kind."""
    import ahocorasick

    found = ahocorasick.Automaton()
    anchors = {"@": "email", "+": "phone", "://": "login",
               **{"".join(cue): "iban" for cue in product("iI", "bB", "aA", "nN")},
               **{d: "card" for d in "0123456789"}, **{f".{d}": "ip" for d in "0123456789"}}
    for anchor, kind in anchors.items():
        found.add_word(anchor, (len(anchor), kind))
    found.make_automaton()
    return found


def find(text: str | None, anchors) -> list[tuple[int, int, int]]:
    """Spans as (start, number of the kind, end), in that order."""
    if not text:
        return []
    spans: list[tuple[int, int, int]] = []
    email_end = ip_end = card_end = 0
    for last, (length, kind) in anchors.iter(text):
        at = last - length + 1
        if kind == "card":
            if at < card_end:
                continue
            match = _CARD.match(text, at)
            if match is None:
                continue
            card_end = match.end()
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((at, 2, card_end))
        elif kind == "ip":
            start = at
            while start > ip_end and text[start - 1] in _DIGITS:
                start -= 1
            match = _IP.match(text, start) if start < at and at >= ip_end else None
            if match is None:
                continue
            ip_end = match.end()
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                spans.append((start, 1, ip_end))
        elif kind == "email":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match is not None:
                email_end = match.end()
                spans.append((start, 0, email_end))
        elif kind == "phone":
            match = _PHONE.match(text, at)
            if match is not None and 10 <= sum(c in _DIGITS for c in match[0]) <= 15:
                spans.append((at, 3, match.end()))
        elif kind == "iban":
            bounds = iban_at(text, last + 1)
            if bounds is not None:
                spans.append((bounds[0], 4, bounds[1]))
        else:
            match = _LOGIN.match(text, last + 1)
            if match is not None:
                spans.append((match.start(1), 4, match.end(1)))
    return sorted(spans)


def find_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``spans`` of every row."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchors = automaton()
        spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find(t, anchors)]
                 for t in batch.column(batch.num_columns - 1).to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, kind)], names=[*batch.schema.names[:-1], "spans"])
    return by_batches(rows, f"{fields}, spans {SPANS}", run)


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with a mark in place of each span; overlapping spans become one mark."""
    if not text or not spans:
        return text
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with personal data in the text replaced by marks such as ``[EMAIL]``."""
    at, names = docs.columns.index(text), docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchors = automaton()
        texts = [masked(t, find(t, anchors)) for t in batch.column(at).to_pylist()]
        columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1:]]
        return pa.RecordBatch.from_arrays(columns, names=names)
    return by_batches(docs, fields, run)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
