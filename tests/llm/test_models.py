"""Language, quality and toxicity models: held-out results and defined edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import languages, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def bucket(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def test_language_held_out_accuracy(tables):
    docs, held = tables[0], bucket(4) == 2
    model = languages.train(docs.where(~held))
    assert model.langs == ["de", "en", "es", "fr"]
    got = languages.predict(docs, model, keep=["doc_id", "lang"]).where(held).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_bundle_is_the_sum_of_bound_letters():
    e = languages.Encoder(64, 3, 1)
    v = lambda c: e._vector(ord(c)).astype(int) if c != " " else e._vector(0).astype(int)
    want = 0
    for a, b, c in (" ab", "ab ", " éx", "éxy", "xy "):
        want = want + np.roll(v(a), 2) * np.roll(v(b), 1) * v(c)
    got = e.bundles(["Ab 12!ÉXY", None, "12 !"])
    assert (got[0] == want).all() and not got[1:].any()


def test_language_edges(spark, hard_docs):
    model = languages.train(hard_docs)
    got = {(r.doc_id, r.lang_pred) for r in languages.predict(hard_docs, model).collect()}
    assert {(1, "und"), (2, "und"), (6, "und"), (7, "fr"), (3, "en")} <= got
    none = languages.train(hard_docs.where("lang = 'xx'"))
    assert none.langs == [] and {r.lang_pred for r in languages.predict(hard_docs, none).collect()} == {"und"}
    assert languages.predict(hard_docs.limit(0), model).count() == 0
    named = hard_docs.withColumn("Score", F.lit("old"))
    assert languages.predict(named, model).columns == [*hard_docs.columns, "lang_pred", "score"]


def test_quality_held_out(tables):
    docs, labels = tables
    held = bucket(4) == 2
    model = quality.train(docs, labels.where(~held))
    got = quality.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(held).toPandas()
    assert (got.predicted == got.quality).mean() > 0.95 and len(model.rules) < 200


def test_quality_expression_equals_the_rules(tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    stats = quality.with_statistics(docs, keep=["doc_id"]).toPandas()
    x = stats[[f"stat_{s}" for s in quality.STATS]].to_numpy()
    margin = model.bias + sum(w * quality._holds(r, x) for r, w in model.rules)
    want = dict(zip(stats.doc_id, 1 / (1 + np.exp(-margin))))
    got = dict(quality.score(docs, model, keep=["doc_id"]).select("doc_id", "score").collect())
    assert got == pytest.approx(want)


def test_quality_statistics():
    import pyarrow as pa

    row = dict(zip(quality.STATS, quality.statistics(pa.array(["a a b c.\nX1 #"]))[0]))
    assert row["words_log"] == pytest.approx(np.log(7)) and row["distinct"] == pytest.approx(5 / 6)
    assert row["echo"] == pytest.approx(1 / 6) and row["top_word"] == pytest.approx(2 / 6)
    assert row["digits"] == pytest.approx(1 / 13) and row["ends"] == pytest.approx(1 / 6)
    assert row["distinct_lines"] == 1 and row["distinct_grams"] == 1 and row["no_letters"] == pytest.approx(1 / 6)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edges(spark, frame, hard_docs, module):
    label = "quality" if module is quality else "toxic"
    labels = frame([(1, 0), (2, 1), (3, None), (None, 1), (4, 1), (4, 0), (5, 0), (99, 1)], f"doc_id long, {label} int")
    got = module.score(hard_docs, module.train(hard_docs, labels)).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    none = module.train(hard_docs, labels.limit(0))
    assert {round(r.score, 6) for r in module.score(hard_docs, none).collect()} == {0.5}
    assert module.score(hard_docs.limit(0), none).count() == 0
    named = hard_docs.withColumn("Predicted", F.lit("old"))
    assert module.score(named, none).columns == [*hard_docs.columns, "score", "predicted"]


def test_toxicity_held_out(tables):
    docs, labels = tables
    held = bucket(5) == 0
    model = toxicity.train(docs, labels.where(~held))
    assert len(model.index) < 5000
    got = toxicity.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(held).toPandas()
    assert (got.predicted == got.toxic).mean() > 0.95 and not ((got.predicted == 1) & (got.toxic == 0)).any()


def test_ftrl_matches_a_plain_loop():
    settings = toxicity.Settings(bits=6, l1=0.3, passes=2, least=1)
    rng = np.random.default_rng(0)
    xs = [np.unique(rng.integers(0, 64, 8)) for _ in range(60)]
    ys = np.array([float(5 in x) for x in xs])
    got = toxicity.ftrl(xs, ys, settings).dense()
    z, n, l1 = [0.0] * 65, [0.0] * 65, 0.3 * np.sqrt(60 / 3000)
    order, shuffle = np.arange(60), np.random.default_rng(settings.seed)

    def weight(i):
        pull = 0.0 if i == 64 else l1
        if abs(z[i]) <= pull and i != 64:
            return 0.0
        rate = (settings.beta + n[i] ** 0.5) / settings.alpha
        return -(z[i] - np.sign(z[i]) * pull) / (rate + (0 if i == 64 else settings.l2))

    for _ in range(2):
        shuffle.shuffle(order)
        for k in order:
            at = [*xs[k].tolist(), 64]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - ys[k]
            for i in at:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / settings.alpha * w[i]
                n[i] += g * g
    assert got == pytest.approx(np.array([weight(i) for i in range(64)]), abs=1e-5)


def test_drop_keeps_columns_and_clean_rows(tables):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    kept = toxicity.score(docs, model, drop=True)
    scored = toxicity.score(docs, model)
    assert kept.columns == docs.columns and kept.count() == scored.where("predicted = 0").count()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_a_repeated_labelled_id_is_one_row_of_the_sample(frame, monkeypatch, module):
    label = "quality" if module is quality else "toxic"
    rows = [(i, f"text {i % 5} of words {'good fine' if i % 2 else 'bad poor'} {i}") for i in range(60)]
    labels = frame([(i, i % 2) for i in range(60)], f"doc_id long, {label} int")
    often = rows + [(7, "zz " + "larger text " * (1 + k % 3)) for k in range(500)]
    sizes = []
    if module is quality:
        fit = quality.fit
        monkeypatch.setattr(quality, "fit", lambda x, y, s: sizes.append(len(y)) or fit(x, y, s))
    docs = frame(rows, "doc_id long, text string")
    models = [module.train(frame(r, "doc_id long, text string"), labels) for r in (rows, often)]
    got = [sorted(module.score(docs, m, keep=["doc_id"]).select("doc_id", "score").collect()) for m in models]
    assert got[0] == got[1] and sizes in ([], [60, 60])


@pytest.mark.parametrize("bound", [1, 30, 100])
def test_languages_whose_rows_share_an_id_are_learned(frame, bound):
    words = {"aa": "kalo mira tesu", "bb": "xyrg wlopt zzrk"}
    for shared in range(4):
        rows = [(shared, f"{words[lang]} {i} " * 3, lang) for i in range(150) for lang in words]
        learned = languages.train(frame(rows, "doc_id long, text string, lang string"), max_rows_per_lang=bound)
        assert learned.langs == ["aa", "bb"]
    same = frame([(1, words[lang], lang) for _ in range(50) for lang in words], "doc_id long, text string, lang string")
    assert languages.train(same, max_rows_per_lang=bound).langs == ["aa", "bb"]


def test_too_many_languages_are_an_error(frame, monkeypatch):
    monkeypatch.setattr(languages, "MAX_LANGS", 3)
    with pytest.raises(ValueError, match="4 different values"):
        languages.train(frame([(i, "text", f"l{i}") for i in range(4)], "doc_id long, text string, lang string"))


def test_toxicity_of_text_ids(frame):
    rows = [(f"doc-{i}", ("foul vile " if i % 2 else "kind fair ") * 4 + f"w{i % 7}") for i in range(80)]
    docs = frame(rows, "doc_id string, text string")
    labels = frame([(r[0], i % 2) for i, r in enumerate(rows)], "doc_id string, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert got == {r[0]: i % 2 for i, r in enumerate(rows)}


def test_toxicity_sample_is_bounded_in_bytes(frame):
    rows = [(i, ("foul vile " if i % 2 else "kind fair ") * 10) for i in range(200)] + [(999, "long " * 1000)]
    docs = frame(rows, "doc_id long, text string")
    labels = frame([(r[0], r[0] % 2) for r in rows], "doc_id long, toxic int")
    settings = toxicity.Settings(max_bytes=64 * 101)
    bounded = toxicity.train(docs, labels, settings)
    whole = toxicity.train(docs, labels)
    # of texts of 100 bytes 64 fit, and the long one is left out; both learn the same features
    assert 0 < len(bounded.index) <= len(whole.index)
    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, bounded).collect()}
    assert all(scored[i] == i % 2 for i in range(200))
