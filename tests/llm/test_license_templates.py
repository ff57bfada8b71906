import random
import re

import pytest
from pyspark.sql import functions as F

from trawl.llm import license_templates as lt
from trawl.llm.queries import QUERIES


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def as_regex(wording):
    """The template as a regular expression over blank-ended words."""
    out = ""
    for part in re.findall(r"\[\[|\]\]|<<\d+>>|\w+", wording):
        out += {"[[": "(?:", "]]": ")?"}.get(part) or (rf"(?:\S+ ){{0,{part[2:-2]}}}" if part[0] == "<" else part + " ")
    return re.compile(out)


def slow_labels(text):
    words = words_of(text)
    found = set()
    for label, wording in lt.TEMPLATES:
        rx = as_regex(wording)
        if any(rx.match(" ".join(words[i:]) + " ") for i in range(len(words))):
            found.add(label)
    return found


def slow_base(text):
    words, places = words_of(text), []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return places


def texts():
    r = random.Random(2)
    out = [None, "", "...", "Released under the MIT License.", "UNDER THE MIT LICENSE under the mit license", "cc by nc by nc cc by nc",
           "under the mit\n\tlicense", "under themit license", "Licensed under the Apache License, Version 2.0 (the License)",
           "This work is licensed under the GNU General Public License, version 3.", "this a b c d is licensed under cc by 4 0", "é cc by nc é"]
    vocab = sorted({w for _, t in lt.TEMPLATES for w in re.findall(r"\w+", t)})
    for _, wording in lt.TEMPLATES:
        for _ in range(6):
            words = []
            depth_skip = False
            for part in re.findall(r"\[\[|\]\]|<<\d+>>|\w+", wording):
                if part == "[[":
                    depth_skip = r.random() < 0.5
                elif part == "]]":
                    depth_skip = False
                elif not depth_skip:
                    words += [r.choice(["foo", "Bar"]) for _ in range(r.randint(0, int(part[2:-2]) + 1))] if part[0] == "<" else [part]
            if r.random() < 0.4:
                words[r.randrange(len(words))] = r.choice(vocab)
            out.append("some text. " + " ".join(words).title() + ", more text " + r.choice(vocab))
    out.append("licensed under " * 400 + "cc by 4 0")
    return out


def test_query_against_regular_expressions(spark, make_dir):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in QUERIES["op6_license_templates"](spark, make_dir(rows)).collect()}
    hits = 0
    for i, t in rows:
        base = slow_base(t)
        labels = {x for _, x in base}
        r = got[i]
        starts = [s for s, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(words_of(t)), len(base), min(starts, default=None), max(starts, default=None)), t
        assert r.base_labels == ",".join(sorted(labels))
        assert r.labels == ",".join(sorted(labels | slow_labels(t))), t
        assert 0 <= r.score <= 1 and (r.score == 1) == bool(r.labels)
        hits += bool(r.labels)
    assert hits > 40


def test_template_must_begin_with_a_word():
    with pytest.raises(ValueError):
        lt.Automaton("x", "<<3>> license")


def test_spans_extras_and_empty(spark, make_docs):
    docs = make_docs([(1, "x released under the MIT license y"), (1, "x released under the MIT license y"), (2, None)])
    docs = docs.withColumn("labels", F.lit(1)).withColumn("__scanned", F.lit(2)).drop("__scanned")
    out = lt.license_scan(docs)
    assert out.columns.count("labels") == 1
    got = sorted((r.doc_id, [(m.label, m.start, m.end) for m in r.matches]) for r in out.collect())
    assert got == [(1, [("mit", 1, 6)]), (1, [("mit", 1, 6)]), (2, [])]
    assert lt.license_scan(docs.limit(0)).count() == 0
