"""Personal data: patterns propose spans, checksums confirm, context adjusts the score.

Each kind has a pattern, a validator and context words.  A text is cut once at the
pattern's matches: the pieces between them and the matches themselves give every
span's position by adding up lengths, in code points, without searching again.  The
context of a match is the ``CONTEXT_CHARS`` characters before and after it, across
neighbouring matches, so a heading counts for all entries close to it.  The four base kinds (email, ip, card, phone) are taken whenever their
validator holds; the kinds that the method adds must also reach ``MIN_SCORE``, and
must not overlap a base span.  Everything is a Column expression.

The patterns are written so that a search is linear in the text: a run of characters
is entered at its start only (a match inside a run could only end where the one from
its start ends) and repeated groups are possessive, which loops instead of recursing.

Defined results: null and empty texts have no spans and stay as they are; texts of
any length are read whole; equal rows get equal results; an empty table gives an
empty result; result columns replace input columns of their names, others stay.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import free_name

CONTEXT_CHARS = 40
CONTEXT_SCORE = 0.3
MIN_SCORE = 0.6
BLOCK = 64


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    def weight(x: Column, i: Column) -> Column:
        d = x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    figures = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "")
    return F.aggregate(F.transform(figures, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters A-Z, digits) leaves 1 modulo 97, first four moved last."""
    turned = F.concat(F.substring(account, 5, 1_000), F.substring(account, 1, 4))

    def step(acc: Column, x: Column) -> Column:
        v = F.ascii(x) - F.when(x >= "A", 55).otherwise(48)
        return (F.when(v > 9, acc * 100).otherwise(acc * 10) + v) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda x: x != ""), F.lit(0), step) == 1


#: Length of an account number by country, as its registry gives it.
IBAN_LENGTHS: dict[str, int] = {c: n for n, listed in (
    (15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"),
    (21, "CH HR LI LV"), (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"),
    (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "BI DJ FR GR IT MC MR SM"),
    (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"),
    (32, "LC"), (33, "RU")) for c in listed.split()}


def iban_prefix(hit: Column) -> Column:
    """The longest beginning of ``hit`` that ends before a blank, at its end (unless a
    small letter goes on there) or at the length of its country, and passes ``mod97``."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])

    def ends(n: Column) -> Column:
        compact = F.length(F.replace(F.left(hit, n), F.lit(" ")))
        stops = F.substring(hit, n + 1, F.lit(1)).isin("", " ") | F.coalesce(
            compact == lengths[F.left(hit, F.lit(2))], F.lit(False))
        return ((n <= F.length(hit)) & F.substring(hit, n, F.lit(1)).rlike("[A-Z0-9]") & stops
                & compact.between(15, 34) & mod97(F.replace(F.left(hit, n), F.lit(" "))))

    # A hit has at most 34 places, a blank before every group and a few places more.
    longest_first = F.sequence(F.lit(45), F.lit(15), F.lit(-1))
    return F.left(hit, F.get(F.filter(longest_first, ends), F.lit(0)))


def _card(least: int, most: int) -> Callable[[Column], Column]:
    return lambda s: F.length(_digits(s)).between(least, most) & luhn(_digits(s))


@dataclass(frozen=True)
class Kind:
    """``hint``: cheap necessary condition on the whole text, a regular expression
    or a plain string; ``score``: of a match that its validator confirmed.  Without
    ``valid``, ``prefix`` gives what to take of a match (null: nothing); the match is
    then group 1 of the pattern, read ahead, and ``step`` characters are passed by."""

    name: str
    pattern: str
    hint: str
    plain_hint: bool
    valid: Callable[[Column], Column] | None
    score: float
    context: tuple[str, ...]
    base: bool
    prefix: Callable[[Column], Column] | None = None
    step: int = 0


_MAIL = "[A-Za-z0-9._%+-]"
_CARD = "[0-9](?:[ -]?[0-9])++"
_CARD_WORDS = ("card", "karte", "tarjeta", "carte", "visa", "amex", "credit")

KINDS: tuple[Kind, ...] = (
    Kind("email", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True,
         lambda s: F.lit(True), 0.9, ("mail", "contact", "write"), True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", False,
         lambda s: F.forall(F.split(s, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
         0.6, ("ip", "host", "address", "server"), True),
    Kind("card", _CARD, r"[0-9](?:[ -]?[0-9]){15}", False, _card(16, 19), 0.8, _CARD_WORDS, True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", True,
         lambda s: F.length(_digits(s)).between(8, 15), 0.7, ("phone", "tel", "call", "mobile", "fax"), True),
    Kind("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+[a-z]?+))[A-Z]{2}[0-9]{2}",
         r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", False,
         None, 0.8, ("iban", "account", "konto", "compte", "cuenta"), False, iban_prefix, 4),
    Kind("short_card", _CARD, r"[0-9](?:[ -]?[0-9]){12}", False, _card(13, 15), 0.4, _CARD_WORDS, False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", False,
         lambda s: ~s.rlike("^(?:000|666|9)|-00-|-0000$"), 0.4, ("ssn", "social security"), False),
    Kind("local_phone", r"(?<![0-9+])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
         r"[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}", False,
         lambda s: F.lit(True), 0.4, ("phone", "tel", "call", "mobile", "fax"), False),
)
BASE = tuple(k.name for k in KINDS if k.base)
SPAN = "struct<kind:string,start:int,end:int,score:double,text:string>"


def _hinted(kind: Kind, text: Column) -> Column:
    return text.contains(kind.hint) if kind.plain_hint else text.rlike(kind.hint)


def _parts(kind: Kind, text: Column) -> Column:
    """The text cut at the kind's matches: ``array<struct<gaps, hits>>``, the last
    with a null hit; null if the text cannot have a match."""
    cut = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.prefix else 0))
    return F.when(_hinted(kind, text), F.arrays_zip(cut.alias("gaps"), hits.alias("hits")))


def _blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` characters, so that a piece of it is found by its
    place without counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to before ``end``, at most to its end."""
    first = F.floor(start / BLOCK).cast("int")
    n = F.floor((end - 1) / BLOCK).cast("int") - first + 1
    joined = F.array_join(F.slice(blocks, first + 1, n), "")
    return F.when(end > start, F.substring(joined, start % BLOCK + 1, end - start)).otherwise("")


def _placed(kind: Kind, parts: Column) -> Column:
    """The confirmed matches with their places, none over another: ``array<struct<start, end, text>>``."""
    spot = "struct<start:int,end:int,text:string>"
    taken = lambda s: kind.prefix(s) if kind.prefix else F.when(kind.valid(s), s)
    read = F.transform(parts, lambda x: F.struct(
        F.length(x["gaps"]).alias("gap"), taken(x["hits"]).alias("text"),
        F.when(x["hits"].isNull(), 0).otherwise(F.lit(kind.step) if kind.prefix else F.length(x["hits"])).alias("step")))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.array().cast(f"array<{spot}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["text"])
        new = x["text"].isNotNull() & (start >= acc["free"])
        span = F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text")).cast(spot)
        return F.struct((start + x["step"]).alias("at"), F.when(new, end).otherwise(acc["free"]).alias("free"),
                        F.when(new, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.coalesce(F.aggregate(read, zero, step, lambda acc: acc["out"]), F.array().cast(f"array<{spot}>"))


def _spans(kind: Kind, placed: Column, blocks: Column) -> Column:
    """``placed`` as scored spans; those of added kinds below ``MIN_SCORE`` are left out."""
    def scored(x: Column) -> Column:
        before = _piece(blocks, F.greatest(F.lit(0), x["start"] - CONTEXT_CHARS), x["start"])
        after = _piece(blocks, x["end"], x["end"] + CONTEXT_CHARS)
        bonus = F.when(F.lower(F.concat_ws(" ", before, after)).rlike("|".join(kind.context)), CONTEXT_SCORE).otherwise(0.0)
        score = F.round(F.least(F.lit(1.0), F.lit(kind.score) + bonus), 2)
        return F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                        score.alias("score"), x["text"].alias("text")).cast(SPAN)

    spans = F.transform(placed, scored)
    return spans if kind.base else F.filter(spans, lambda x: x["score"] >= MIN_SCORE)


def find_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: ``array<struct<kind, start, end, score, text>>``,
    by kind in the order of ``KINDS``, then start; ends are exclusive."""
    source = F.coalesce(F.col(text), F.lit(""))
    cut = [free_name(docs, f"__cut_{k.name}") for k in KINDS]
    placed = [free_name(docs, f"__placed_{k.name}") for k in KINDS]
    found = [free_name(docs, f"__spans_{k.name}") for k in KINDS]
    blocks = free_name(docs, "__text_blocks")
    out = docs.select("*", *[_parts(k, source).alias(c) for k, c in zip(KINDS, cut, strict=True)])
    out = out.select("*", *[_placed(k, F.col(c)).alias(p) for k, c, p in zip(KINDS, cut, placed, strict=True)]).drop(*cut)
    any_placed = F.greatest(*[F.size(p) for p in placed]) > 0
    out = out.withColumn(blocks, F.when(any_placed, _blocks(source)))
    out = out.select("*", *[_spans(k, F.col(p), F.col(blocks)).alias(s) for k, p, s in zip(KINDS, placed, found, strict=True)])
    out = out.drop(blocks, *placed)
    base = free_name(docs, "__base")
    n_base = len(BASE)
    out = out.withColumn(base, F.concat(*found[:n_base]))
    added = F.filter(F.concat(*found[n_base:]), lambda x: ~F.exists(
        F.col(base), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return out.withColumn(spans, F.concat(F.col(base), added)).drop(base, *found)


def _union(spans: Column) -> Column:
    """Spans by start, those that overlap merged into one of the longest's kind."""
    part = "struct<start:int,end:int,kind:string,len:int>"
    parts = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), (x["end"] - x["start"]).alias("len"))))

    def add(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        kind = F.when(x["len"] > last["len"], x["kind"]).otherwise(last["kind"])
        merged = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"),
                          kind.alias("kind"), F.greatest(last["len"], x["len"]).alias("len"))
        apart = (F.size(acc) == 0) | (last["end"] <= x["start"])
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged)))

    return F.aggregate(parts, F.array().cast(f"array<{part}>"), add)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``find_spans`` replaced by its kind, as ``[EMAIL]``;
    of spans that overlap the union is replaced, named by the longest (of equally long
    ones by that which starts first, then ends first, then by name)."""
    spans, blocks = free_name(docs, "__spans"), free_name(docs, "__blocks")
    out = find_spans(docs, text, spans).withColumn(spans, _union(F.col(spans)))
    out = out.withColumn(blocks, F.when(F.size(spans) > 0, _blocks(F.col(text))))
    kept_from = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col(spans), i - 1)["end"])
    pieces = F.transform(spans, lambda x, i: F.concat(
        _piece(F.col(blocks), kept_from(i), x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    rest = _piece(F.col(blocks), F.try_element_at(F.col(spans), F.lit(-1))["end"], F.size(blocks) * BLOCK)
    masked = F.concat(F.array_join(pieces, ""), rest)
    return out.withColumn(text, F.when(F.size(spans) > 0, masked).otherwise(F.col(text))).drop(spans, blocks)
