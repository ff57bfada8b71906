import zlib

from pyspark.sql import functions as F

from trawl.llm import language_id as li
from trawl.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op7_language_families"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.size(F.split("text", " ")).alias("n"))
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.n >= 20]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r.score <= 1 for r in rows)


TOY = {"en": "the cat and the dog with this house", "de": "der hund und die katze mit dem haus", "fr": "le chat et le chien avec une maison",
       "es": "el gato y el perro con una casa", "ja": "ねこといぬといえがあります"}


def toy_rows(langs):
    return [(10 * i + j, f"{TOY[x]} {'x' * (j % 3)}", x) for i, x in enumerate(langs) for j in range(10)]


def test_families_then_pairs(spark, make_docs):
    rows = toy_rows(TOY) + [(900, "no language here", None), (None, "der die das", "de"), (901, "12 34", "en")]
    model = li.train(make_docs(rows).select("doc_id", "text", "lang"))
    assert model.families == ["germanic", "ja", "romance"]
    assert {f: len(p) for f, p in model.pairs.items()} == {"germanic": 1, "ja": 0, "romance": 1}
    docs = make_docs([(i, t) for i, t in enumerate(TOY.values())] + [(50, None), (51, ""), (52, "12 !?"), (53, "é")])
    got = {r.doc_id: r for r in li.identify(docs.withColumn("score", F.lit("old")), model).collect()}
    assert [got[i].lang_pred for i in range(5)] == list(TOY)
    assert [(got[i].lang_pred, got[i].score) for i in (50, 51, 52)] == [("und", 0.0)] * 3
    assert got[53].lang_pred in TOY


def test_few_languages(spark, make_docs):
    one = li.train(make_docs(toy_rows(["fr"])).select("doc_id", "text", "lang"))
    assert one.predict("irgendein text") == ("fr", 1.0)
    none = li.train(make_docs(toy_rows(["fr"])).limit(0).select("doc_id", "text", "lang"))
    assert none.predict("un texte") == ("und", 0.0)
    assert li.identify(make_docs([]).limit(0), one).count() == 0


def test_sample_is_bounded(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "'t' AS text", "IF(id % 10 = 0, 'de', 'en') AS lang")
    got = {r.lang: r["count"] for r in li.training_sample(rows, 100).groupBy("lang").count().collect()}
    assert got == {"de": 100, "en": 100}


def test_features_do_not_depend_on_pieces(monkeypatch):
    for text in ("", "a", "é", "some words, others too; Ünd 12 " * 30):
        whole = li.features(text)
        for size in (1, 2, 3, 7, 64):
            monkeypatch.setattr(li, "PIECE_BYTES", size)
            assert (li.features(text) == whole).all()
        monkeypatch.undo()


def slow_features(text):
    """Letter pairs and triples counted one at a time."""
    import math

    raw = [32]
    for b in text.lower().encode():
        b = b if b >= 128 or 97 <= b <= 122 else 32
        if b != 32 or raw[-1] != 32:
            raw.append(b)
    raw = raw if raw[-1] == 32 else [*raw, 32]
    counts = [0] * (li.PAIR_SLOTS + li.TRIPLE_SLOTS)
    for i in range(len(raw) - 1):
        pair = ((raw[i] * 2654435761 + raw[i + 1] * 40503) % 2**32) >> 7
        counts[pair % li.PAIR_SLOTS] += 1
        if i + 2 < len(raw):
            triple = ((pair * 31 + raw[i + 2] * 2246822519) % 2**32) >> 9
            counts[li.PAIR_SLOTS + triple % li.TRIPLE_SLOTS] += 1
    norm = math.sqrt(sum(counts)) or 1.0
    return [math.sqrt(c) / norm for c in counts]


def slow_predict(model, text):
    import math

    dot = lambda w, x: sum(float(a) * b for a, b in zip(w, x))
    x = slow_features(text)
    z = [dot(w, x) + float(b) for w, b in zip(model.family_w, model.family_b)]
    family = model.families[z.index(max(z))]
    share = 1 / sum(math.exp(v - max(z)) for v in z)
    langs, wins = model.languages[family], {}
    for i, j, w, b in model.pairs[family]:
        second = 1 / (1 + math.exp(-2 * (dot(w, x) + b)))
        for k, won, part in ((j, second > 0.5, second), (i, second <= 0.5, 1 - second)):
            votes, belief = wins.get(k, (0, 0.0))
            wins[k] = votes + won, belief + part
    if not wins:
        return langs[0], share
    # Most duels won; of equals the larger sum of beliefs, then the earlier name.
    best = max(wins, key=lambda k: (wins[k][0], wins[k][1], -k))
    return langs[best], share * wins[best][1] / (len(langs) - 1)


def test_predictions_from_the_weights_by_plain_loops(spark, make_docs):
    toy = TOY | {"it": "il gatto e il cane con una casa", "nl": "de hond en de kat met het huis", "pt": "o gato e o cão com uma casa"}
    rows = [(10 * i + j, f"{t} {'x' * (j % 3)}", x) for i, (x, t) in enumerate(toy.items()) for j in range(10)]
    model = li.train(make_docs(rows).select("doc_id", "text", "lang"))
    assert {f: len(p) for f, p in model.pairs.items()} == {"germanic": 3, "ja": 0, "romance": 6}
    texts = [*toy.values(), "é", "le chat und der hund", "cat gato katze", "Haus HOUSE casa いえ", "x", "de " * 3000]
    got = {r.doc_id: r for r in li.identify(make_docs(list(enumerate(texts))), model).collect()}
    for i, t in enumerate(texts):
        lang, score = slow_predict(model, t)
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4, t
    assert sum(got[i].lang_pred == x for i, x in enumerate(toy)) == len(toy)


def test_pair_weights_are_a_minimum_of_the_hinge_loss(spark, make_docs):
    """No step from the fitted weights along either side's mean lowers the loss by much."""
    import numpy as np

    rows = [r for r in toy_rows({k: TOY[k] for k in ("en", "de")}) if r]
    model = li.train(make_docs(rows).select("doc_id", "text", "lang"))
    (_, _, w, b), = model.pairs["germanic"]
    x = np.array([li.features(t) for _, t, _ in rows])
    y = np.array([1.0 if lang == "en" else -1.0 for _, _, lang in rows])  # de comes first by name
    sd = x.std(axis=0, ddof=1)  # the penalty is on standardised weights

    def loss(w, b):
        return np.maximum(0, 1 - y * (x @ w + b)).mean() + li.REG / 2 * ((w * sd) ** 2).sum()

    base = loss(w, b)
    assert base < 0.05 and all(np.sign(x @ w + b) == y)
    r = np.random.default_rng(0)
    for step in (1e-2, 1e-1):
        for _ in range(50):
            move = r.normal(size=len(w)) * (sd > 0) / np.maximum(sd, 1e-3)
            assert loss(w + step * np.abs(w).mean() * move / np.abs(move).mean(), b) > base - 1e-3
