import random
import zlib

import pytest

from firmroll.llm import language
from firmroll.llm.language import Model


def test_query(same_as_sql):
    rows = same_as_sql("op11_language_id")
    assert sum(rows.values()) == 1000


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: r for r in language.identify(docs, fit_rows=200).collect()}
    rows = [r for r in docs.select("doc_id", "lang").collect() if found[r.doc_id].held_out]
    assert len(rows) > 200
    assert sum(found[r.doc_id].lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_words_before_grams_and_long_before_short():
    import numpy as np

    tables = [{"the": 0}, {"t": 0, "x": 1}, {"th": 0, " t": 1}, {"the": 0}, {}, {}]
    costs = [np.array(c, np.int64).reshape(-1, 2) for c in ([1, 9], [3, 4, 8, 2], [10, 20, 31, 40], [5, 6], [], [])]
    model = Model(["a", "b"], tables, costs)
    assert model.cost("the").tolist() == [1, 9]
    assert model.cost("then").tolist() == [5, 6]
    assert model.cost("th").tolist() == [20, 30]  # mean, rounded down
    assert model.cost("xy").tolist() == [8, 2]
    assert model.cost("q").tolist() == [0, 0]
    assert model.totals([{"the": 2, "q": 5}, {}]).tolist() == [[2, 18], [0, 0]]


def test_words_are_never_cut(monkeypatch):
    text = "Ärger mit Übermut, naïveté été 42 x² — " * 40 + "a" * 5000
    whole = [w for part in language.words_of(text) for w in part]
    monkeypatch.setattr(language, "_CHUNK", 7)
    assert [w for part in language.words_of(text) for w in part] == whole
    assert {"ärger", "x", "été", "a" * 5000} <= set(whole)


ODD = "doc_id long, text string, lang string, score double, held_out int"


def odd_table(spark):
    rng = random.Random(2)
    speech = {"aa": ["kala", "kuu", "talo", "vesi"], "bb": ["strong", "thing", "the", "wrong"]}
    rows = [(i, " ".join(rng.choices(speech[lang], k=30)), lang) for i in range(80) for lang in speech]
    rows += [(500, None, "aa"), (501, "", None), (502, "12 34 !?", "bb"), (503, "kalavesi taloon", None)]
    rows += [(None, "the strangest things", "cc"), (505, "日本語", None), (506, "kala " * 300_000, None)] + [(507, "thong", None)] * 3
    return rows, spark.createDataFrame([(*r, 0.5, 1) for r in rows], ODD).repartition(3)


def test_odd_rows(spark):
    rows, table = odd_table(spark)
    found = language.identify(table)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in ("aa", "bb", "und")  # cc has no doc_id and is not learned
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[500] == by_id[501] == by_id[502] == ("und", 0.0)
    assert by_id[503][0] == by_id[506][0] == "aa" and by_id[507][0] == by_id[None][0] == "bb"
    assert by_id[505] == ("aa", 0.5)  # letters, but none that is known: the first label


def test_labels_and_held_out_rows_do_not_leak(spark):
    """Labels of held-out rows teach nothing, and no prediction looks at the label of its row."""
    rows, table = odd_table(spark)
    before = {tuple(r) for r in language.identify(table).collect()}
    changed = [(d, t, "zz" if d is None or zlib.crc32(str(d).encode()) % 4 == 2 else g) for d, t, g in rows]
    after = {tuple(r) for r in language.identify(spark.createDataFrame([(*r, 0.5, 1) for r in changed], ODD)).collect()}
    assert after == before


@pytest.mark.parametrize("how", [{"entries": 30}, {"fit_rows": 10}, {"languages": 1}])
def test_bounds(spark, how):
    _, table = odd_table(spark)
    model = language.fit(table.select("doc_id", "text", "lang"), **how)
    assert sum(map(len, model.tables)) <= how.get("entries", language.MODEL_ENTRIES)
    assert len(model.languages) == how.get("languages", 2)


def test_nothing_to_learn(spark):
    table = spark.createDataFrame([(1, "some words", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in language.identify(table).collect()} == {("und", 0.0)}
    assert language.identify(table.limit(0)).count() == 0
