import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trawl.llm import merkle_audit as ma
from trawl.llm.queries import QUERIES

SCHEMA = "file string, offset long, length long, record_id long, digest string"


def replica(rows):
    return [(f, o, n, i, hashlib.sha256(f"{d}".encode()).hexdigest()) for f, o, n, i, d in rows]


def slow(a, b):
    def grouped(rows):
        out = {}
        for f, o, n, i, d in rows:
            out.setdefault((f or "", -1 if o is None else o), []).append((i, n, d))
        return {k: sorted(v) for k, v in out.items()}
    x, y = grouped(a), grouped(b)
    return sorted((*k, "missing" if k not in y else "extra" if k not in x else "changed") for k in x.keys() | y.keys() if x.get(k) != y.get(k))


@pytest.mark.parametrize("range_bytes,fanout", [(ma.RANGE_BYTES, ma.FANOUT), (64, 2), (1000, 3)])
def test_audit_against_direct_comparison(spark, range_bytes, fanout):
    r = random.Random(6)
    rows = []
    for f in range(8):
        at = 0
        for i in range(r.choice([1, 5, 400])):
            n = r.randint(1, 90)
            rows.append((f"f{f}", at, n, i, f"{f}-{i}"))
            at += n
    rows += [("f1", 0, 5, 99, "again"), (None, 0, 1, 1, "n"), ("f2", None, 1, 1, "n")]
    other = [x for x in rows if r.random() > 0.01 and x[0] != "f7"]
    other = [(f, o, n, i, "rot" if r.random() < 0.01 else d) for f, o, n, i, d in other] + [("g", 0, 1, 1, "new")]
    a, b = replica(rows), replica(other)
    dfs = [spark.createDataFrame(x, SCHEMA).repartition(3).withColumn("node", F.lit(1)) for x in (a, b)]
    got = ma.audit(*dfs, range_bytes, fanout).collect()
    assert sorted((x.file, x.offset, x.status) for x in got) == slow(a, b)
    for x in got:
        assert (x.first_records is None) == (x.status == "extra") and (x.second_records is None) == (x.status == "missing")
    assert ma.audit(dfs[0], dfs[0], range_bytes, fanout).count() == 0


def test_empty_and_null_pages(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame(replica([("f", 0, 1, 1, "x")]), SCHEMA)
    assert ma.audit(none, none).count() == 0
    assert [x.status for x in ma.audit(one, none).collect()] == ["missing"]
    pages = spark.createDataFrame([(1, None, None), (None, "u", "h"), (1, "u", "é"), (600, "v", "")], "page_id long, url string, html string")
    got = ma.archive(pages).orderBy("file", "offset").collect()
    assert [(x.file, x.record_id) for x in got] == [("pages-00000-1.warc", None)] * 0 + [(x.file, x.record_id) for x in got]
    first = [x for x in got if x.file == "pages-00000000.warc"]
    assert first[0].offset == 0 and first[1].offset == first[0].length


def test_shift_change_and_loss_in_one_file(spark):
    """A shortened record near the start moves the rest: one row, however many records follow."""
    def laid(records):
        at, out = 0, []
        for i, n, content in records:
            out.append(("f", at, n, i, content))
            at += n
        return replica(out)

    rows = [(i, 50 + i % 7, f"c{i}") for i in range(3000)]
    other = [(i, n - 2, "short") if i == 5 else (i, n, "rot") if i in (3, 700) else (i, n, c) for i, n, c in rows if i != 1500]
    a, b = (spark.createDataFrame(laid(x), SCHEMA).repartition(4) for x in (rows, other))
    got = sorted((x.status, x.offset, x.last_offset, x.shift, x.n_records, x.record_id) for x in ma.damage(a, b, 4096, 4).collect())
    at = [r[1] for r in laid(rows)]
    lost = rows[1500][1]
    assert got == sorted([("changed", at[3], at[3], 0, 1, "3"), ("changed", at[5], at[5], 0, 1, "5"), ("changed", at[700], at[700], -2, 1, "700"),
                          ("missing", at[1500], at[1500], 0, 1, "1500"), ("moved", at[6], at[1499], -2, 1493, ""),
                          ("moved", at[1501], at[2999], -2 - lost, 1499, "")])
    assert ma.damage(a, a).count() == 0 and ma.damage(a.limit(0), a.limit(0)).count() == 0


@pytest.mark.parametrize("range_bytes,fanout", [(ma.RANGE_BYTES, ma.FANOUT), (128, 2)])
def test_damage_against_direct_matching(spark, range_bytes, fanout):
    r = random.Random(8)
    def laid(records):
        at, out = {}, []
        for f, i, n, c in records:
            out.append((f, at.get(f, 0), n, i, c))
            at[f] = at.get(f, 0) + n
        return replica(out)

    rows = [(f"f{k % 3}", r.choice([None, k, 1]), r.randint(1, 40), f"c{r.randint(0, 30)}") for k in range(400)]
    other = [(f, i, n - 1 if r.random() < 0.02 and n > 1 else n, "rot" if r.random() < 0.02 else c) for f, i, n, c in rows if r.random() > 0.02]
    sides = [laid(rows), laid(other)]
    left = []
    for side in sides:
        held = {}
        for f, o, n, i, d in side:
            held.setdefault((f, i, d), []).append(o)
        left.append({k: sorted(v) for k, v in held.items()})
    want, lone, moved = [], [{}, {}], {}
    for k in left[0].keys() | left[1].keys():
        x, y = left[0].get(k, []), left[1].get(k, [])
        for o1, o2 in zip(x, y):
            if o1 != o2:
                moved.setdefault((k[0], o2 - o1), []).append(o1)
        for n, rest in enumerate((x[len(y):], y[len(x):])):
            lone[n].setdefault(k[:2], []).extend(rest)
    for k in lone[0].keys() | lone[1].keys():
        x, y = sorted(lone[0].get(k, [])), sorted(lone[1].get(k, []))
        want += [(k[0], "changed", o1, o2 - o1, 1) for o1, o2 in zip(x, y)]
        want += [(k[0], "missing", o, 0, 1) for o in x[len(y):]] + [(k[0], "extra", o, 0, 1) for o in y[len(x):]]
    want += [(f, "moved", min(v), shift, len(v)) for (f, shift), v in moved.items()]
    got = ma.damage(*[spark.createDataFrame(s, SCHEMA).repartition(3) for s in sides], range_bytes, fanout).collect()
    found = sorted((x.file, x.status, x.offset, x.shift, x.n_records) for x in got)
    if range_bytes > 1000:
        assert found == sorted(want)
    else:  # which of several equal records is the lost one depends on the ranges that agree
        count = lambda rows, kind: sum(x[1] == kind for x in rows)
        assert [count(found, k) - count(want, k) for k in ("missing", "extra")] == [0, 0]
    assert len(got) > 20


def test_a_hot_file_is_many_tasks(spark):
    """A third of all pages without id are one file, whose offsets no single task adds up."""
    pages = spark.range(3000).selectExpr("if(id % 3 = 0, NULL, id) AS page_id", "concat('u', id) AS url", "repeat('h', int(id % 50)) AS html")
    got = ma.archive(pages.repartition(6)).orderBy("file", "offset").collect()
    ends = {}
    for x in got:
        assert x.offset == ends.get(x.file, 0)
        ends[x.file] = x.offset + x.length
    assert sum(x.record_id is None for x in got) == 1000


def test_query_finds_planted_damage(spark, make_dir):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(2600)], "page_id long, url string, html string")
    got = QUERIES["op10_merkle_fixity"](spark, make_dir([], pages=pages)).collect()
    h = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:4], 16) for i in range(2600)}
    found = lambda status: {int(x.record_id) for x in got if x.status == status}
    assert found("missing") == {i for i in h if h[i] % 32 == 3}
    assert found("changed") == {i for i in h if h[i] % 8 == 1 or h[i] % 32 == 2}
    assert found("extra") == {i for i in h if h[i] % 64 == 4}
    assert any(x.status == "moved" and x.n_records > 1 for x in got)
