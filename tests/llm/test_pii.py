import hashlib
import re

from pyspark.sql import functions as F

from trawl.llm import pii
from trawl.llm.queries import QUERIES


def passes_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    """The four base rules, with the patterns as they are stated."""
    t, digits = text or "", lambda s: re.sub("[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and passes_luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    )
    return [[(k, m.start(), m.end()) for m in re.finditer(p, t) if ok(m[0])] for k, p, ok in rules]


TEXTS = [
    None, "", " ", "a@b", "a@b.c", "x.y+z%q@d-e.f.g, next@h.i_j@k.l@m.n", "é a@b.c ü 𝒳 d@e.fg end", "a@b.c.d@e.f", "@a.b a@@b.c.d",
    "1.2.3.4 256.1.1.1 0001.02.3.255 1.2.3.4.5.6.7.8 1.2.3 999999999999999999999.1.1.1 00000000000000000000001.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 5500-0000 0000-0004 4111  1111 1111 1111",
    "+1 (242) 555-3475 +12 +1234567 ++12345678 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 +1 2345678)", "+4111 1111 1111 1111 a@b.co",
    "9" * 5000, "a" * 20_000, "1." * 3000, "a@" + "b." * 3000 + "c", "- " * 3000 + "+1" + " " * 3000, "é" * 500 + "k@l.mn" + "é" * 10,
    "1 " * 4000, "+1 2345678 " * 300, "mail me: q@r.st " * 200,
]


def test_base_spans_as_stated(spark, make_dir):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in QUERIES["op9_pii_spans"](spark, make_dir(rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        kinds = base_spans(t)
        text = ",".join(f"{k}:{s}:{e}" for spans in kinds for k, s, e in spans)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in kinds], i
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
        assert r.spans.startswith(text)


def spans(spark, make_docs, text):
    found = pii.find_spans(make_docs([(1, text)])).first().spans
    return [(s.kind, s.text, s.score) for s in found]


def test_checksums_and_context(spark, make_docs):
    assert spans(spark, make_docs, "IBAN GB82 WEST 1234 5698 7654 32.") == [("iban", "GB82 WEST 1234 5698 7654 32", 1.0)]
    assert spans(spark, make_docs, "number DE89370400440532013000 here") == [("iban", "DE89370400440532013000", 0.8)]
    assert spans(spark, make_docs, "number DE89370400440532013001 here") == []
    assert spans(spark, make_docs, "my card 3782 822463 10005") == [("short_card", "3782 822463 10005", 0.7)]
    assert spans(spark, make_docs, "order 3782 822463 10005") == []
    assert spans(spark, make_docs, "SSN: 123-45-6789") == [("ssn", "123-45-6789", 0.7)]
    assert spans(spark, make_docs, "part 123-45-6789") == []
    assert spans(spark, make_docs, "call (242) 555-3475") == [("local_phone", "(242) 555-3475", 0.7)]
    assert spans(spark, make_docs, "call +1 (242) 555-3475") == [("phone", "+1 (242) 555-3475", 1.0)]


def test_redaction(spark, make_docs):
    text = "é q@r.st, 1.2.3.4 and 300.1.1.1; +1 (242) 555-3475, 4111 1111 1111 1111 \U0001f600 IBAN DE89370400440532013000"
    docs = make_docs([(1, text), (2, "nothing 12"), (3, None), (4, "")]).withColumn("spans", F.lit(3)).withColumn("__cut", F.lit(4))
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert out[1].text == "é [EMAIL], [IP] and 300.1.1.1; [PHONE], [CARD] \U0001f600 IBAN [IBAN]"
    assert (out[2].text, out[3].text, out[4].text) == ("nothing 12", None, "")
    assert pii.redact(docs).columns == docs.columns and out[1]["__cut"] == 4
    assert pii.find_spans(docs.limit(0)).count() == 0
    assert pii.find_spans(docs).columns.count("spans") == 1


def valid_iban(s):
    s = s.replace(" ", "")
    number = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
    return 15 <= len(s) <= 34 and int(number) % 97 == 1
