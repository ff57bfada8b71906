import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from trawl.llm import decontam as dc
from trawl.llm.queries import QUERIES


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def expected(rows, items, width=10):
    windows = set()
    for item, text in items:
        w = words_of(text)
        if w:
            windows |= {(item, tuple(w[i:i + width])) for i in range(max(1, len(w) - width + 1))}
    out = []
    for doc_id, text in rows:
        w, hit, found = words_of(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item)
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc_id if doc_id is not None else -1, len(w), len(hit), len(ids),
                    hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def sample():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["the"] * 30 + ["Äpfel", "äpfel", "of"] * 5
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randint(8, 30))) for i in range(12)]
    items += [(2, text(14)), (50, "of the of the"), (51, "the"), (52, ""), (53, None), (None, text(12)), (100, items[3][1])]
    rows = [(i, text(r.randint(0, 80))) for i in range(40)]
    for i, (_, t) in enumerate(items):
        w = (t or "").split()
        rows.append((200 + i, f"{text(9)}, {' -- '.join(w).upper()}. {text(5)}"))
        rows.append((300 + i, text(4) + " " + " ".join(w[:11]) + " zz " + " ".join(w[3:])))
    rows += [(400, None), (401, ""), (402, items[0][1]), (402, items[0][1]), (402, "of the"), (None, items[1][1]),
             (403, " ".join(["the"] * 500)), (404, " ".join([items[4][1]] * 20))]
    return rows, items


@pytest.mark.parametrize("bound", [dc.BROADCAST_ROWS, 0])
def test_query_against_all_windows(spark, make_dir, monkeypatch, bound):
    """Same rows whether side tables are broadcast or shuffled."""
    monkeypatch.setattr(dc, "BROADCAST_ROWS", bound)
    monkeypatch.setattr(dc, "BROADCAST_TEXTS", bound)
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = QUERIES["op2_positional_index"](spark, make_dir(rows, benchmark=bench)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in got) == expected(rows, items)


def test_near_matches(spark, make_docs):
    """The three rarest terms within the span, in any order; counts decide what is rare."""
    docs = make_docs([(1, "aa x x bb x cc"), (2, "cc bb aa"), (3, "aa " + "x " * 18 + "bb cc"), (4, "aa " + "x " * 17 + "bb cc"),
                      (5, "aa bb"), (6, "x x x x")])
    bench = spark.createDataFrame([(1, "x aa x bb cc x"), (2, "aa bb")], "item_id long, text string")
    items = dc.items_with_words(bench)
    index = dc.build_index(docs.select("doc_id", "text"), items)
    got = sorted((r.item, r.doc_id) for r in dc.near_matches(index, items).collect())
    assert got == [("aa bb", 1), ("aa bb", 2), ("aa bb", 3), ("aa bb", 4), ("aa bb", 5),
                   ("x aa x bb cc x", 1), ("x aa x bb cc x", 2), ("x aa x bb cc x", 4)]


def test_drop_and_empty_tables(spark, make_docs):
    passage = " ".join(f"p{i}" for i in range(15))
    docs = make_docs([(1, "clean text"), (2, f"before {passage} after"), (2, "also two"), (None, passage), (None, None)])
    docs = docs.withColumn("th", F.lit("mine")).withColumn("term", F.lit(1))
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "also two", "clean text"]
    assert dc.contamination(docs.limit(0).select("doc_id", "text"), bench).count() == 0
    none = dc.contamination(docs.select("doc_id", "text"), bench.limit(0)).collect()
    assert len(none) == 5 and not any(r.contaminated for r in none)


def test_an_unseen_word_does_not_hide_a_near_match(spark, make_docs):
    docs = make_docs([(1, "aa x x bb x cc x dd"), (2, "aa " + "x " * 30 + "bb cc dd"), (3, "aa cc")])
    bench = spark.createDataFrame([(1, "aa bb cc dd unseen"), (2, "aa never bb gone cc"), (3, "aa none of these occur"), (4, "no word")],
                                  "item_id long, text string")
    items = dc.items_with_words(bench)
    got = sorted((r.item, r.doc_id) for r in dc.near_matches(dc.build_index(docs.select("doc_id", "text"), items), items).collect())
    assert got == [("aa bb cc dd unseen", 1), ("aa never bb gone cc", 1)]  # in text 2 the rarer aa, bb, dd stand apart
