"""Nothing of a span that is found may stay in the text."""

import random
import re

from tests.llm.test_pii import base_spans, passes_luhn, valid_iban
from trawl.llm import pii
from trawl.llm.queries import QUERIES


def union_masked(text, found):
    """The text with the union of the spans replaced, the longest naming it."""
    merged = []
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in found):
        if merged and start < merged[-1][1]:
            last = merged[-1]
            longer = end - start > last[3]
            merged[-1] = (last[0], max(last[1], end), kind if longer else last[2], max(last[3], end - start))
        else:
            merged.append((start, end, kind, end - start))
    out, at = "", 0
    for start, end, kind, _ in merged:
        out, at = out + text[at:start] + f"[{kind.upper()}]", end
    return out + text[at:]


def test_redaction_masks_the_reported_spans(spark, make_docs):
    texts = {1: "fax +33.1.42.68.53.00 now", 2: "+33.1.42.68.53.00", 3: "a.b@1.2.3.4 and +10.20.30.40.50.60.70 é\U0001f600 x@y.zz",
             4: "+4111 1111 1111 1111", 5: "é" * 500 + "k@l.mn" + "\U0001f600" * 130 + "1.2.3.4", 6: "mail q@r.st " * 300,
             7: "card 4111 1111 1111 1111 a@b.co\n\n+1 (242) 555-3475\r\n", 8: "x" * 64 + "a@b.co" + " " * 58, 9: "none +"}
    docs = make_docs(list(texts.items()))
    found = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[1] == "fax [PHONE] now" and out[2] == "[PHONE]" and out[9] == texts[9]
    assert out == {i: union_masked(t, found[i]) for i, t in texts.items()}


def test_account_numbers_before_upper_case_words(spark, make_docs):
    es, at, be = "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034"
    cases = [(f"IBAN: {es} BIC: CAIXESBB", [es]), (f"IBAN {at} BIC", [at]), (f"account {be} OR", [be]),
             ("IBAN ES9121000418450200051332 BIC", ["ES9121000418450200051332"]), (f"IBAN {es} BANK NAME", [es]),
             ("IBAN ES9121000418450200051332BIC", ["ES9121000418450200051332"]), (f"IBAN {es} Bank", [es]),
             (f"IBAN {es} CAIXESBBXXXXXXXX", [es]), (f"IBAN {es} {es} {at} {be}", [es, es, at, be]), (es, [es]),
             ("IBAN GB82 WEST 1234 5698 7654 32 BIC", ["GB82 WEST 1234 5698 7654 32"]), (f"IBAN {es[:-1]}3 BIC", []),
             (f"IBAN x{es}", []), ("IBAN DE89370400440532013000x", ["DE89370400440532013000"]), ("IBAN DE8937040044053201300x", []),
             ("IBAN MT84 MALT 0110 0001 2345 MTLC AST0 01S", ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"])]
    got = {r.doc_id: r.spans for r in pii.find_spans(make_docs([(i, t) for i, (t, _) in enumerate(cases)])).collect()}
    for i, (text, want) in enumerate(cases):
        found = [s for s in got[i] if s.kind == "iban"]
        assert [s.text for s in found] == want, text
        assert all(text[s.start:s.end] == s.text for s in found)


def test_context_reaches_across_neighbours(spark, make_docs):
    texts = ["Phones: 242-555-3475, 242-555-3476 and 242-555-3477.", "SSN: 123-45-6789, 123-45-6780, 123-45-6781",
             "cards 378282246310005, 378282246310005", "123-45-6789; 000-45-6789 ssn", "242-555-3475" + " " * 29 + "242-555-3475 tel",
             "tel" + "." * 37 + "242-555-3475", "tel" + "." * 38 + "242-555-3475"]
    found = {r.doc_id: [s.text for s in r.spans] for r in pii.find_spans(make_docs(list(enumerate(texts)))).collect()}
    assert found == {0: ["242-555-3475", "242-555-3476", "242-555-3477"], 1: ["123-45-6789", "123-45-6780", "123-45-6781"],
                     2: ["378282246310005"] * 2, 3: ["123-45-6789"], 4: ["242-555-3475"], 5: ["242-555-3475"], 6: []}


ADDED = (
    ("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+))", 0.8,
     ("iban", "account", "konto", "compte", "cuenta")),
    ("short_card", r"([0-9](?:[ -]?[0-9])+)", 0.4, ("card", "karte", "tarjeta", "carte", "visa", "amex", "credit")),
    ("ssn", r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])", 0.4, ("ssn", "social security")),
    ("local_phone", r"(?<![0-9+])(\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])", 0.4, ("phone", "tel", "call", "mobile", "fax")),
)


def taken(kind, text, start, hit):
    """How many characters of a match are taken; 0 if none."""
    digits = re.sub("[^0-9]", "", hit)
    if kind == "iban":
        for n in range(len(hit), 14, -1):
            compact = hit[:n].replace(" ", "")
            ended = hit[n - 1] != " " and not text[start + n:start + n + 1].isalnum()
            ended = ended or hit[n - 1] != " " and pii.IBAN_LENGTHS.get(hit[:2]) == len(compact)
            if ended and valid_iban(hit[:n]):
                return n
        return 0
    ok = {"short_card": 13 <= len(digits) <= 15 and passes_luhn(digits), "local_phone": True,
          "ssn": not (hit[:3] in ("000", "666") or hit[0] == "9" or hit[4:6] == "00" or hit[7:] == "0000")}
    return len(hit) if ok[kind] else 0


def whole_spans(text):
    """Base and added spans, a match's context being 40 characters on either side."""
    base = [x for spans in base_spans(text) for x in spans]
    out = list(base)
    for kind, pattern, score, words in ADDED:
        free = 0
        for m in re.finditer(pattern, text):
            start, n = m.start(), taken(kind, text, m.start(), m[1])
            end = start + n
            if n and start >= free:
                free = end
                near = f"{text[max(0, start - 40):start]} {text[end:end + 40]}".lower()
                total = score + (0.3 if any(w in near for w in words) else 0)
                if round(min(1.0, total), 2) >= 0.6 and not any(s < end and start < e for _, s, e in base):
                    out.append((kind, start, end))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def test_all_spans_with_whole_context(spark, make_dir):
    r = random.Random(12)
    pieces = ["a@b.co", "+1 (242) 555-3475", "(242) 555-3475", "242.555.3475", "4111 1111 1111 1111", "3782 822463 10005", "378282246310005",
              "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "DE89370400440532013001", "FR14 2004 1010 0505 0001 3M02 606",
              "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BIC", "OR", "CAIXESBB", "Bank", "x", "123-45-6789", "000-45-6789",
              "1.2.3.4", "IBAN", "my Account", "call", "Tel.", "visa card", "SSN", "word", "é", "\U0001f600", "12", "7", "-", "+", "y" * 25]
    rows = [(i, "".join(r.choice(pieces) + r.choice([" ", " ", "", ", ", "\n"]) for _ in range(r.randint(1, 30)))) for i in range(400)]
    got = {x.doc_id: x.spans for x in QUERIES["op9_pii_spans"](spark, make_dir(rows)).collect()}
    assert got == {i: whole_spans(t) for i, t in rows}
