"""Language network, ordinal classifier, decontamination, packing and the pipeline."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldledger.llm import language, packing, quality, templates
from fieldledger.llm.queries import corpus_queries
from tests.llm.fixtures import DOCS, awkward, clashing, given, rows

LARGER = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    draw = np.random.default_rng(1)
    model = language.ByteTagger(["a", "b", "c"], hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    segments, lengths, labels = draw.integers(0, 256, (4, 6), dtype=np.uint8), np.array([6, 6, 3, 1]), np.array([0, 1, 2, 1])
    _, grads = model.gradients(segments, lengths, labels)
    for name, weights in model.weights.items():
        hot = np.argsort(-np.abs(grads[name]).reshape(-1))[:5]
        for at in hot:
            flat = weights.reshape(-1)
            old, step = flat[at], 1e-2
            flat[at] = old + step
            high, _ = model.gradients(segments, lengths, labels)
            flat[at] = old - step
            low, _ = model.gradients(segments, lengths, labels)
            flat[at] = old
            assert (high - low) / (2 * step) == pytest.approx(grads[name].reshape(-1)[at], rel=0.05, abs=2e-4)


def test_languages_of_held_out_documents(spark):
    found = {r.doc_id: r for r in corpus_queries()["op2_byte_language"](spark, LARGER).collect()}
    truth = {r[0]: r[2] for r in given("documents", LARGER)}
    assert set(found) == set(truth)
    held = [i for i, r in found.items() if r.held_out and truth[i]]
    assert 200 < len(held) < 500
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_edges(spark):
    docs = clashing(awkward(spark))
    out = language.predict(docs, language.train(docs, steps=5))
    assert out.count() == docs.count()
    found = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert all(found[i] == ("und", 0.0) for i in (9002, 9003, 9004, 9005))
    assert found[9007][0] != "und" and found[9001] == found[given("documents")[4][0]]
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), nothing).count() == 0


def test_pooling_over_blocks(monkeypatch):
    model = language.ByteTagger(["a", "b"])
    texts = [b"x" * 1000, b"", b"hello world" * 40, b"y"]
    whole = language.pooled(model, texts)
    monkeypatch.setattr(language, "HELD", 3)
    assert np.allclose(language.pooled(model, texts), whole, atol=1e-5)
    assert np.allclose(whole.sum(1), [1, 0, 1, 1], atol=1e-5)


def test_ordinal_gradients_and_order():
    draw = np.random.default_rng(0)
    rows_, grades = [], []
    for _ in range(600):
        grade = int(draw.integers(0, 3))
        rows_.append(np.unique(np.concatenate([draw.integers(0, 50, 8), [100 + grade] if draw.random() < 0.95 else []]).astype(np.int32)))
        grades.append(grade)
    model = quality.OrdinalModel()
    model.fit(rows_, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all()
    scores = model.scores(rows_)
    expected = model.above(scores).sum(1)
    assert [np.mean(expected[np.array(grades) == g]) for g in range(3)] == sorted(np.mean(expected[np.array(grades) == g]) for g in range(3))
    assert np.mean(np.round(expected) == np.array(grades)) > 0.85


def test_quality_on_held_out_ratings(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    train, test = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    out = {r.doc_id: r for r in quality.score(docs, quality.train(docs, train)).select("doc_id", *quality.RESULT).collect()}
    wanted = [(out[r.doc_id].keep, r.quality == 1 and r.toxic == 0) for r in test.collect()]
    assert np.mean([a == b for a, b in wanted]) > 0.9
    assert all(0 <= r.p_above_1 <= r.p_above_0 <= 1 and 0 <= r.expected_grade <= 2 for r in out.values())


def test_keep_is_the_same_on_a_thinned_sample(spark):
    draw = np.random.default_rng(4)
    made, labels = [], []
    for i in range(4000):
        grade = int(draw.choice(3, p=[0.14, 0.1, 0.76]))
        words = [f"c{draw.integers(40)}" if draw.random() < (0.55 if grade == 2 else 0.45) else f"p{draw.integers(40)}" for _ in range(30)]
        made.append((i, " ".join(words)))
        labels.append((i, int(grade > 0), int(grade == 1)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    rated = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole, thin = ([r.keep for r in quality.score(docs, quality.train(docs, rated, n)).orderBy("doc_id").collect()] for n in (4000, 300))
    assert abs(np.mean(whole) - np.mean(thin)) < 0.06
    stands_for = {r.grade: r.n for r in quality.sample(rated, 300).groupBy("grade").agg(F.sum("weight").alias("n")).collect()}
    counts = {r.grade: r["count"] for r in quality.graded(rated).groupBy("grade").count().collect()}
    assert all(stands_for[g] == pytest.approx(n, rel=0.2) for g, n in counts.items())


def test_rows_of_one_document_train_as_one(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(quality.OrdinalModel, "fit", lambda self, rows_, grades, weights, **_: sent.append((len(rows_), dict(zip(grades.tolist(), weights.tolist())), weights.sum())))
    texts = [(1, "a good text"), (2, "a bad text")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    for more in ([], [(1, "a good text")] * 50, [(1, f"text w{i}") for i in range(500)]):
        quality.train(spark.createDataFrame(texts + more, "doc_id long, text string"), labels, 4)
    assert [s[0] for s in sent] == [2, 2, 1 + 12] and all(s[2] == pytest.approx(3) and s[1][0] == pytest.approx(2) for s in sent)


def test_quality_edges(spark):
    docs = clashing(awkward(spark)).withColumn("keep", F.lit("clash"))
    ids = [r[0] for r in given("documents")[:6]]
    labels = spark.createDataFrame([*[(i, k % 2, 0) for k, i in enumerate(ids)], (ids[0], 0, None), (None, 1, 0), (9002, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    out = quality.score(docs, model)
    assert out.count() == docs.count() and dict(out.dtypes)["keep"] == "boolean"
    assert len({(r.p_above_0, r.p_above_1) for r in out.where("text is null or trim(text) = ''").collect()}) <= 2
    unfitted = quality.train(docs, labels.limit(0))
    assert {r.keep for r in quality.score(docs, unfitted).collect()} == {True}
    assert quality.score(docs.limit(0), model).count() == 0


ITEMS = [
    (1, "If Tom has 12 apples and Tom gives Mary 5 kg of flour, how many apples does Tom keep after 12 days of trading?"),
    (2, "The quick brown fox jumps over the lazy dog near the silent river bank today"),
    (3, "too short"),
    (4, None),
    (5, "The quick brown fox jumps over the lazy dog near the silent river bank tonight"),
    (2, "The quick brown fox jumps over the lazy dog near the silent river bank today"),
]


def swapped(text: str, **values: str) -> str:
    return re.sub(r"\w+", lambda m: values.get(m[0], values.get("_" + m[0], m[0])), text)


def test_templates(spark):
    one = ITEMS[0][1]
    texts = {
        1: "before it " + one + " and after",
        2: swapped(one, Tom="Ann", Mary="Bob", _12="30", _5="7"),
        3: swapped(one, Tom="Ann", Mary="Ann", _12="30", _5="7"),  # two people became one: other slots, another question
        4: "Here is a text about Tom with 12 apples and nothing else that would match it at all in the end.",
        5: ITEMS[1][1].upper().replace(" ", "!! "),
        6: None,
        7: "",
        8: "filler words here\n" * 2000 + one,
        9: one + "\n" + swapped(one, Tom="Ann", Mary="Bob", _12="30", _5="7"),
        10: "too short",
    }
    docs = spark.createDataFrame([*[(i, t, "x") for i, t in texts.items()], (1, texts[1], "x"), (None, one, "x")], "doc_id long, text string, h string")
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, n string")
    found = {r.doc_id: r for r in templates.contaminated(docs, items).collect()}
    assert set(found) == {1, 2, 5, 8, 9, 10, None}, "a copy without doc_id is found, and an item too short for a window as a whole text"
    assert {i: (found[i].item_id, found[i].kind) for i in found if i} == {1: (1, "exact"), 2: (1, "reparameterised"), 5: (2, "exact"), 8: (1, "exact"), 9: (1, "exact"), 10: (found[10].item_id, "exact")}
    assert found[5].n_items == 2
    assert rows(templates.contaminated(docs, items, bits=15).select("doc_id").orderBy("doc_id")) == [(None,), (1,), (2,), (5,), (8,), (9,), (10,)]
    left = templates.clean(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {3, 4, 6, 7}
    assert templates.contaminated(docs.limit(0), items).count() == templates.contaminated(docs, items.limit(0)).count() == 0


def test_templates_with_openers_number_words_and_other_case(spark):
    item = (
        "Natalia sold 48 clips to friends at the spring market. Natalia then sold half as many clips again in May. "
        "Natalia also paid McDonald three coins for a small box of clips. Natalia wants to know what is left for her."
    )
    twelve = "On the farm 12 hens lay 12 eggs before noon, and the farmer then packs all of the fresh eggs into small boxes and sells these boxes at the market"
    items = spark.createDataFrame([(1, item), (2, twelve)], "item_id long, text string")
    texts = {
        1: swapped(item, Natalia="Sabrina", _48="60"),
        2: swapped(item, Natalia="Sabrina", McDonald="DeVito", three="seventeen"),
        3: item.lower(),
        4: swapped(item, three="17"),
        5: twelve.replace("12 hens", "30 hens").replace("12 eggs", "25 eggs"),  # two numbers that were equal by chance
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.item_id for r in templates.contaminated(docs, items).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2}


def test_items_of_one_id_or_none(spark):
    texts = [" ".join(f"{w}{i}" for i in range(12)).translate(str.maketrans("0123456789", "abcdefghij")) for w in ("one", "two", "none", "zero")]
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (1, texts[0])], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.item_id, r.n_items) for r in templates.contaminated(docs, items).collect()}
    assert found == {0: (1, 1), 1: (1, 1), 2: (None, 1), 3: (None, 1)}


def test_planted_benchmark_passages(spark):
    items = [(i, t.split()) for i, t in given("benchmark", LARGER)]
    spaced = [(r[0], " " + " ".join((r[1] or "").split()) + " ") for r in given("documents", LARGER)]
    planted = {d for d, text in spaced for _, words in items if f" {' '.join(words)} " in text}
    found = {r.doc_id for r in corpus_queries()["op3_template_decontamination"](spark, LARGER).collect()}
    assert planted and planted <= found and len(found - planted) <= 0.1 * len(planted) + 3


def test_best_fit_decreasing_is_the_plain_one():
    draw = np.random.default_rng(2)
    for row in (1, 7, 100, 2048):
        lengths = [int(x) for x in draw.integers(1, row + 1, 300)]
        rows_: list[list[int]] = []
        free: list[int] = []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [(f, k) for k, f in enumerate(free) if f >= lengths[i]]
            if fits:
                k = min(fits)[1]
            else:
                k = len(rows_)
                rows_.append([])
                free.append(row)
            rows_[k].append(i)
            free[k] -= lengths[i]
        found = packing.best_fit_decreasing(lengths, row)
        assert sorted(i for r in found for i in r) == list(range(300)) and all(sum(lengths[i] for i in r) <= row for r in found)
        assert sorted(row - sum(lengths[i] for i in r) for r in found) == sorted(free)


@pytest.mark.parametrize("row, block", [(2048, 1 << 21), (16, 200)])
def test_packing_round_trip(spark, row, block):
    docs = clashing(awkward(spark)).where("doc_id is not null").dropDuplicates(["doc_id"])
    packs = packing.pack(docs, row=row, block=block).collect()
    encoder = packing.Tokenizer(open(packing.TOKENIZER, "rb").read())
    got: dict[int, dict[int, np.ndarray]] = {}
    for p in packs:
        ids = np.frombuffer(p.input_ids, "<i4")
        assert len(ids) == row and (ids[p.used :] == packing.END).all()
        assert p.cu_seqlens[0] == 0 and p.cu_seqlens[-1] == p.used <= row and p.position_resets == p.cu_seqlens[:-1]
        for s, a, b in zip(p.segments, p.cu_seqlens, p.cu_seqlens[1:], strict=False):
            assert s.length == b - a and s.offset == s.piece * row
            got.setdefault(s.doc_id, {})[s.piece] = ids[a:b]
    for r in docs.select("doc_id", "text").collect():
        ids = np.concatenate([got[r.doc_id][k] for k in range(len(got[r.doc_id]))])
        assert ids[-1] == packing.END
        assert encoder._encoding.decode(ids[:-1].tolist()) == (r.text or "")
        assert (ids[:-1] == encoder.whole(r.text or "")).all()
    assert len({p.pack_id for p in packs}) == len(packs)
    assert packing.pack(docs.limit(0)).count() == 0


def test_cached_ids_are_those_of_the_whole_text():
    encoder = packing.Tokenizer(open(packing.TOKENIZER, "rb").read())
    texts = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a\n\n b c\t d", "it's 12%!! été", "\n a", "x" * 200 + " y", "a\u00a0 b", "a \u2003b", "tab\t end\n"]
    for text in [*texts, *[r[1] for r in given("documents")[:50]]]:
        assert encoder.ids(text).tolist() == encoder.whole(text).tolist(), repr(text[:50])


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert [n for n, _ in p.STAGES] and p.ORACLE_SQL is None
    counts = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, LARGER)
        assert tuple(after.columns) == p.COLUMNS, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}
        counts.append(after.count())
        docs = spark.createDataFrame(after.collect(), after.schema)
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0 and counts[4] > counts[3]
    assert p.run(spark, LARGER).count() > 0


def test_packs_follow_the_written_order(spark, tmp_path):
    import corpus_pipeline as p

    made = [(i, f"word{i} " * (20 + i), "en", "src1", 1) for i in range(400)]  # later files are larger
    docs = spark.createDataFrame(made, DOCS).repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id")
    docs.write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        packs = p.packed(spark, read, LARGER).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    ids: dict[int, set] = {}
    for row in packs:
        ids.setdefault(row.pack_id >> 33, set()).update(s.doc_id for s in row.segments)
    parts = [ids[n] for n in sorted(ids)]
    assert len(parts) > 1 and set().union(*parts) == set(range(400))
    assert all(max(a) < min(b) for a, b in zip(parts, parts[1:], strict=False))


def test_pipeline_on_awkward_rows(spark):
    import corpus_pipeline as p

    docs = awkward(spark)
    for _, stage in p.STAGES:
        some, none = stage(spark, docs, LARGER), stage(spark, docs.limit(0), LARGER)
        assert some.count() > 0 and none.count() == 0


def test_no_document_schema_is_lost():
    assert [x.split()[0] for x in DOCS.split(", ")] == ["doc_id", "text", "lang", "source", "n_chars"]
