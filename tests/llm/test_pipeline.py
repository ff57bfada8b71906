import random

import corpus_pipeline as cp
from trawl.llm import quality_bands as qb

PASSAGE = " ".join(f"bench{i}" for i in range(14))


def rows():
    r = random.Random(12)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(2500)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    clean = [(i, text(r.randint(120, 400)), "en", f"src{i % 4}") for i in range(40)]
    copies = [(100 + i, clean[i][1], "en", "src9") for i in range(6)] + [(5, clean[5][1], "en", "src1")]
    near = [(200 + i, clean[i][1] + " tail", "en", "src0") for i in range(3)]
    leaks = [(300 + i, f"{text(100)} {PASSAGE} {text(80)}", "en", "src2") for i in range(4)]
    junk = [(400, None), (401, ""), (402, "too short"), (403, "spam spam spam " * 100)]
    private = [(500, text(90) + " mail jo@ex.org or +1 (242) 555-3475 now " + text(60), "en", None)]
    return clean, copies, near, leaks, junk, private


def test_stages_take_effect(spark, make_docs, make_dir):
    clean, copies, near, leaks, junk, private = rows()
    everything = clean + copies + near + leaks + junk + private
    bench = spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string")
    folder = make_dir(everything, benchmark=bench)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    out, kept = docs, {}
    for name, stage in cp.STAGES:
        out = stage(spark, out, folder)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        kept[name] = {x.doc_id for x in out.select("doc_id").collect()}
    assert {400, 401, 402, 403}.isdisjoint(kept["quality_rules"]) and {x[0] for x in clean + leaks + private} <= kept["quality_rules"]
    assert {x[0] for x in clean} <= kept["near_duplicates"] and {x[0] for x in copies if x[0] >= 100}.isdisjoint(kept["near_duplicates"])
    assert kept["decontamination"] == kept["near_duplicates"] - {x[0] for x in leaks}
    assert kept["source_mix"] == kept["decontamination"]

    final = {x.doc_id: x for x in cp.run(spark, folder).collect()}
    assert set(final) == kept["source_mix"]
    assert sorted(x.position for x in final.values()) == list(range(len(final)))
    for i, text, *_ in clean:
        assert final[i].text == text and final[i].n_chars == len(text)
    masked = final[500]
    assert "jo@ex.org" not in masked.text and "[EMAIL]" in masked.text and "[PHONE]" in masked.text
    assert masked.n_chars == len(masked.text)


def test_first_stage_agrees_with_its_rule(spark, make_docs):
    import zstandard

    data = [r for part in rows() for r in part]
    want = sorted(str(r[0]) + str(r[1]) for r in data if qb.measure(r[1], zstandard.ZstdCompressor(level=3))[-1])
    got = sorted(str(r.doc_id) + str(r.text) for r in cp.quality_rules(spark, make_docs(data), "").collect())
    assert got == want


def test_empty_table_and_extra_columns(spark, make_docs, make_dir):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    folder = make_dir([], benchmark=bench)
    assert cp.run(spark, folder).count() == 0
    clean = rows()[0][:5]
    docs = make_docs(clean).selectExpr("*", "1 AS kept", "2 AS fp", "3 AS th", "4 AS row", "5 AS g", "6 AS rank", "7 AS position")
    out = docs
    for name, stage in cp.STAGES:
        out = stage(spark, out, folder)
    assert out.count() == 5 and {"kept", "fp", "th", "row", "g", "rank"} <= set(out.columns)
