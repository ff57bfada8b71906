import math
import random

import pytest

from trawl.llm import mixing
from trawl.llm.queries import QUERIES


def edf(parts, slots):
    """Earliest deadline first, one slot at a time."""
    total, done, order = sum(parts), [0] * len(parts), []
    for t in range(slots):
        ready = [(math.ceil((d + 1) * total / q), i) for i, (d, q) in enumerate(zip(done, parts, strict=True)) if d * total // q <= t]
        i = min(ready)[1]
        order.append((i, done[i]))
        done[i] += 1
    return order


@pytest.mark.parametrize("parts", [[1], [1, 1], [7, 2, 1], [50, 1, 1, 1], [3, 5, 7, 11, 13]])
def test_period(spark, parts):
    got = mixing.period(spark, parts).orderBy("t").collect()
    assert [(r.g, r.k) for r in got] == edf(parts, sum(parts))
    done = [0] * len(parts)
    for r in got:
        assert list(r.before) == done
        done[r.g] += 1
        for d, q in zip(done, parts, strict=True):
            assert abs(d - q * (r.t + 1) / sum(parts)) < 1
    assert done == parts


def test_mix_is_whole_and_close(spark, make_docs):
    r = random.Random(0)
    rows = [(i, f"t{i}", "en", r.choice(["a"] * 6 + ["b", "c", None, "z"])) for i in range(3000)]
    docs = make_docs(rows)
    targets, rest, block = {"a": 4, "b": 2, "c": 3}, 1, 8
    got = mixing.mix(docs, targets, rest, block).orderBy("position").collect()
    assert [x.position for x in got] == list(range(3000))
    assert sorted(x.doc_id for x in got) == list(range(3000))
    assert [x.slot for x in got] == sorted(x.slot for x in got)
    kind = lambda s: s if s in targets else None
    seen, short = {}, None
    for x in got:  # blocks of a source in order, rows of a block together
        seen.setdefault(kind(x.source), []).append(x.block)
    for blocks in seen.values():
        assert blocks == [i // block for i in range(len(blocks))]
    weights = targets | {None: rest}
    n_blocks = {k: len(v) // block for k, v in seen.items()}
    short = min(n_blocks[k] * 10 // weights[k] for k in weights)
    for slot in range(1, short):
        for k, q in weights.items():
            done = len({x.block for x in got if kind(x.source) == k and x.slot < slot})
            assert abs(done - q * slot / 10) < 1


def test_ranks_over_many_buckets(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mixing, "GROUP_BUCKETS", 3)
    rows = [(i % 700 if i % 50 else None, "t", "en", "a") for i in range(1000)]
    got = mixing.mix(make_docs(rows).drop("text"), {"a": 1}).orderBy("position").collect()
    assert [x.position for x in got] == list(range(1000))
    from hashlib import md5
    digests = [md5(("" if x.doc_id is None else str(x.doc_id)).encode()).hexdigest() for x in got]
    assert digests == sorted(digests)


def test_edges(spark, make_docs, make_dir):
    docs = make_docs([(1, "a"), (1, "a"), (None, None)])
    out = mixing.mix(docs.withColumnRenamed("lang", "position"), {"src0": 1})
    assert out.columns == ["doc_id", "text", "source", "n_chars", "block", "slot", "position"] and out.count() == 3
    assert mixing.mix(docs.limit(0), {"src0": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"src0": 0})
    got = QUERIES["op4_pfair_mix"](spark, make_dir([(i, "x", "en", f"src{i % 25}") for i in range(200)]))
    assert sorted(r.position for r in got.collect()) == list(range(200))
