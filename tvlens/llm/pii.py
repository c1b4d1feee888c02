"""Personal data in texts.

Regular expressions propose spans, validators (octet range, Luhn, mod-97,
digit counts) confirm them, and context words nearby adjust a score.

Base kinds (email, ip, card, phone) are kept whenever their validator holds.
Further kinds (iban, short_card, ssn, local_phone) are kept only when their
score reaches ``min_score`` and they do not overlap a base span or an earlier
added one.  An iban has the length of its country's; of a country without a
fixed one, the longest that ends at a word's end and passes the checksum.
Offsets count code points, the end is exclusive.

Defined cases: a NULL or empty text has no spans; NULL or repeated ids and
repeated rows give one result row each; an empty table gives an empty result;
other input columns are ignored, whatever their names.  Every scan is linear
in the text, so one very long text only takes its own time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "short_card", "ssn", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A chain of numbers joined by single dots; four at a time form an address.
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Start of an account number, and what may follow; its end is found by length or checksum.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
# Characters of an IBAN by country (the registry of ISO 13616).
_IBAN_SIZES = {
    country: int(size)
    for size, countries in (
        item.split(":")
        for item in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
            "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
            "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV "
            "29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_DIGIT = re.compile(r"[0-9]")

# Context words by kind (fixed values), matched as lower-case word starts.
_CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "carte", "karte", "tarjeta"),
    "short_card": ("card", "visa", "amex", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social", "security"),
}
_NEAR = {k: re.compile(r"\b(?:" + "|".join(v) + ")") for k, v in _CONTEXT.items()}
# Score of a confirmed span before context, by kind.
_PRIOR = {
    "email": 0.8,
    "ip": 0.7,
    "card": 0.8,
    "phone": 0.7,
    "iban": 0.75,
    "short_card": 0.4,
    "ssn": 0.4,
    "local_phone": 0.35,
}
CONTEXT_WEIGHT = 0.2
CONTEXT_REACH = 40

SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def luhn(digits: str) -> bool:
    """Luhn checksum of a digit string."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 mod-97-10 check of an account number without blanks."""
    moved = code[4:] + code[:4]
    rest = 0
    for c in moved:
        n = int(c, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each '@' with the run of local characters before it
    that is not part of the match before, and a dotted domain after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        nxt = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            nxt = free = m.end()
        else:
            free = at + 1
        at = text.find("@", nxt)
    return found


def _addresses(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _DOTTED.finditer(text):
        pos, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = pos + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append((pos, end))
            pos = end + 1
    return found


def _numbers(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    cards, short = [], []
    for m in _CHAIN.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            (cards if len(digits) >= 16 else short).append(m.span())
    return cards, short


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m.group())) <= 15]


def _ssns(text: str) -> list[tuple[int, int]]:
    bad = ("000", "666")
    return [
        m.span()
        for m in _SSN.finditer(text)
        if m.group()[:3] not in bad and m.group()[0] != "9" and m.group()[4:6] != "00" and m.group()[7:] != "0000"
    ]


def _ibans(text: str) -> list[tuple[int, int]]:
    found, m = [], _IBAN.search(text)
    while m:
        end = _iban_end(text, m)
        if end:
            found.append((m.start(), end))
        m = _IBAN.search(text, end or m.end())
    return found


def _iban_end(text: str, head: re.Match) -> int | None:
    """End of the account number that starts with ``head``, if there is one."""
    rest = _IBAN_REST.match(text, head.end())
    if not rest:
        return None
    size = _IBAN_SIZES.get(head.group()[:2])
    ends = [i + 1 for i in range(rest.start(), rest.end()) if text[i] != " "]  # of 5, 6, ... characters
    for n in [size] if size else range(len(ends) + 4, 14, -1):
        if n - 4 > len(ends):
            continue
        end = ends[n - 5]
        inside = text[end : end + 1]
        if not (inside.isascii() and inside.isalnum()) and mod97(text[head.start() : end].replace(" ", "")):
            return end
    return None


def score_span(kind: str, text: str, start: int, end: int) -> float:
    """Prior of a confirmed span, raised by a context word close to it."""
    near = text[max(0, start - CONTEXT_REACH) : start] + "\n" + text[end : end + CONTEXT_REACH // 2]
    return round(_PRIOR[kind] + CONTEXT_WEIGHT * bool(_NEAR[kind].search(near.lower())), 2)


def spans_of(text: str | None, min_score: float = 0.55) -> list[tuple[str, int, int, float]]:
    """Spans of one text, ordered by kind (as in KINDS), then start."""
    if not text:
        return []
    got: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        got["email"] = _emails(text)
    if _DIGIT.search(text):
        got["ip"] = _addresses(text)
        got["card"], got["short_card"] = _numbers(text)
        got["phone"] = _phones(text) if "+" in text else []
        got["iban"], got["ssn"], got["local_phone"] = _ibans(text), _ssns(text), [
            m.span() for m in _LOCAL_PHONE.finditer(text)
        ]
    out = [(k, s, e, score_span(k, text, s, e)) for k in BASE_KINDS for s, e in got[k]]
    if any(got[k] for k in ADDED_KINDS):
        taken = bytearray(len(text))
        for _, s, e, _ in out:
            taken[s:e] = b"x" * (e - s)
        for kind in ADDED_KINDS:
            for s, e in got[kind]:
                score = score_span(kind, text, s, e)
                if score >= min_score and not any(taken[s:e]):
                    taken[s:e] = b"x" * (e - s)
                    out.append((kind, s, e, score))
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.55) -> DataFrame:
    """One row per input row: id and its personal-data spans with scores."""
    span_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", 4096, 16 << 20):
            rows = [
                [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans_of(t.as_py(), min_score)]
                for t in b.column("text")
            ]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, span_type)], ["doc_id", "spans"])

    only = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return only.mapInArrow(scan, SCHEMA)


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, SHA-256 of the base spans, and all spans as text."""
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of_kind = lambda k: lambda s: s["kind"] == k
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", of_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, as_text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", as_text), ",").alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
