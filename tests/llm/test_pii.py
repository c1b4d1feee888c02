"""Personal data against the plain regular expressions of the contract."""

import hashlib
import re

from llm.support import ODD, docs, texts
from tvlens.llm import pii
from tvlens.llm.queries import op1_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    ds = [int(c) for c in s][::-1]
    return sum(sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(ds)) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


CASES = [
    "mail a@b.c_x@d.e.f, @@ x@y a.b+c@d-e.fr.",
    "1.2.3.4.5.6.7.8.9 999.1.1.1 0001.02.3.4 1.2.3 1..2.3.4 255.255.255.256.1.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111110 5500 0000 0000 0004 12",
    "+1 (415) 555-2671 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++33 1 23 45 67 89 +",
    "pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 not GB00WEST12345698765432",
    "ssn 123-45-6789 but 123-45-6789 alone is far away from any such word ........................ 987-65-4321",
    "é" * 5 + " visa 378282246310005 x" + " call 415 555 2671",
    "1" * 3000 + "." * 3000 + "a" * 3000 + "@" * 300,
    "unicode digits ١٢٣@١.٢ １.２.３.４",
]


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


def test_base_spans_equal_the_plain_patterns():
    for text in CASES + ODD + [t for _, t in texts()]:
        assert base(text) == brute(text), (text or "")[:80]


def test_added_spans_need_checksum_and_score():
    kinds = lambda t: [s[0] for s in pii.spans_of(t)]
    assert kinds(CASES[4]).count("iban") == 2
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789 of it") == []
    assert kinds("visa 378282246310005") == ["short_card"] and kinds("nr 378282246310005") == []
    assert kinds("call 415 555 2671") == ["local_phone"]
    near, far = pii.spans_of("mail me: a@b.c"), pii.spans_of("a@b.c")
    assert near[0][3] > far[0][3]


def test_query_digest(spark):
    rows = {r.doc_id: r for r in op1_pii(spark, "/root/testdata/sf0.01").collect()}
    for doc_id, text in texts("/root/testdata/sf0.01"):
        found = brute(text)
        r = rows.pop(doc_id)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(f[0] == k for f in found) for k in PATTERNS]
        assert set(joined.split(",")) <= set(r.spans.split(","))
    assert not rows


def test_defined_cases(spark):
    got = pii.find_pii(docs(spark, [*ODD, (None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c")])).collect()
    assert len(got) == len(ODD) + 3
    assert sum(len(r.spans) for r in got) == 3
    assert pii.find_pii(docs(spark, [])).count() == 0


def test_ibans_end_before_what_follows():
    ibans = lambda t: [t[s:e] for k, s, e, _ in pii.spans_of(t) if k == "iban"]
    de, gb, no = "DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947"
    for after in (" BIC COBADEFFXXX", " EUR 500", " 2024", "", ".", " Bank", f" {gb}"):
        assert ibans(f"IBAN {de}{after}")[0] == de and len(ibans(f"IBAN {de}{after}")) == 1 + (gb in after)
        assert ibans(f"IBAN {no}{after}")[0] == no
    assert ibans("DE89 3704 0044 0532 0130 00 EUR 500") == ["DE89 3704 0044 0532 0130 00"]
    assert ibans("GB82 WEST 1234 5698 7654 32 BIC WESTGB2L") == ["GB82 WEST 1234 5698 7654 32"]
    assert ibans(f"{de}BIC {de}x {de[:-1]}1 AB12 {gb}") == [gb]
    unlisted = next(f"ZZ{n:02d}12345678901ABC" for n in range(97) if pii.mod97(f"ZZ{n:02d}12345678901ABC"))
    assert ibans(f"{unlisted} EUR") == [unlisted]
    assert not set(pii._IBAN_SIZES.values()) - set(range(15, 35)) and all(len(k) == 2 for k in pii._IBAN_SIZES)
