import zlib

import numpy as np
from pyspark.sql import functions as F

from lakework.llm import language
from lakework.llm.queries import op3_language
from tests.llm.conftest import EDGE_ROWS

MEDIUM = "/root/testdata/sf0.01"


def test_kernel_is_shared_ngrams_over_the_geometric_mean():
    sample = [("a", "abc abd"), ("b", "xyz")]
    model = language.fit(sample)
    scorer = language.Scorer(model)
    blocks = [scorer.alphabet[language.code_points(t)] for _, t in sample]
    sets = [set(language.spectrum(b).tolist()) for b in blocks]
    want = [[len(x & y) / np.sqrt(len(x) * len(y)) for y in sets] for x in sets]
    assert np.allclose(scorer.kernel(blocks), want)


def test_held_out_accuracy(spark):
    got = op3_language(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r["lang_pred"] == r["lang"] for r in got if r["held_out"]]
    assert len(held) > 100 and np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edge_rows(edge, nothing):
    model = language.train(edge)
    assert set(model.labels) <= {"en", "de", "ja"}
    found = language.identify(edge, model)
    assert found.columns == [c for c in edge.columns if c != "score"] + ["lang_pred", "score"]
    rows = found.select("text", "lang_pred", "score").collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters), r
        assert letters or r["score"] == 0
    assert language.identify(nothing, language.train(nothing)).collect() == []


def test_nothing_to_learn_from_gives_und(edge, nothing):
    found = language.identify(edge, language.train(nothing)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in found] == [("und", 0.0)]


def test_source_id_and_label_are_no_inputs(spark, documents):
    model = language.train(documents)
    plain = language.identify(documents.select("doc_id", "text"), model)
    other = language.identify(documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("zz").alias("lang")), model)
    key = lambda df: sorted((r["lang_pred"], r["score"]) for r in df.collect())
    assert key(plain) == key(other)


def test_texts_in_no_language_are_turned_down(spark):
    """Markup, code and text in other scripts go, texts in the learned languages and short ones stay."""
    import random

    rng = random.Random(1)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    junk = [
        "".join(rng.choice("0123456789abcdef") for _ in range(2000)),
        "<div class='x'><a href='/p?id=12'>x</a></div>\n" * 40,
        "for(int i=0;i<n;++i){a[i]=b[i]*c[i];} if(x!=NULL) return x->y;\n" * 20,
        "Это обычный русский текст о погоде и природе. " * 20,
        "これは日本語の文章です。今日は天気がいい。" * 20,
    ]
    planted = spark.createDataFrame([(-i, t) for i, t in enumerate(junk, 1)] + [(-10, "Ja."), (-11, "12 34")], "doc_id long, text string")
    model = language.train(docs)
    # Two languages in one text: no machine claims it, but it stays.
    en, de = ("".join(r["text"] for r in docs.filter(f"lang = '{x}' AND length(text) < 3000").orderBy("doc_id").limit(5).collect())[:900] for x in ("en", "de"))
    planted = planted.unionByName(spark.createDataFrame([(-12, f"{en}\n{de}")], "doc_id long, text string"))
    found = language.identify(docs.select("doc_id", "text").unionByName(planted), model, letters_out="letters", known_out="known")
    kept = found.filter(language.in_a_language(model, *(F.col(c) for c in ("lang_pred", "score", "letters", "known")))).select("doc_id")
    ids = {r["doc_id"] for r in kept.collect()}
    assert {i for i in ids if i < 0} == {-10, -12}
    assert len([i for i in ids if i >= 0]) == docs.filter(F.col("text").rlike(r"\p{L}")).count()


def test_sample_does_not_grow_with_tasks(spark):
    """The same sample from 4 and from 200 partitions, of which no task hands on more than its share."""
    from lakework.llm.common import smallest

    rows = spark.range(40_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 2).alias("y"), "id")
    want = {y: sorted((r["h"], r["id"]) for r in rows.filter(f"y = {y}").collect())[:300] for y in (0, 1)}
    for parts in (4, 200):
        dealt = rows.repartition(parts)
        got = smallest(dealt, ["h", "id"], {0: 300, 1: 300}, {0: 20_000, 1: 20_000}, by="y")
        assert {y: sorted((r["h"], r["id"]) for r in got if r["y"] == y) for y in (0, 1)} == want
    # Counts that promise more than there is: the bound is raised until it holds all.
    few = rows.filter("id < 1000")
    assert len(smallest(few, ["h", "id"], {0: 300, 1: 900}, {0: 20_000, 1: 20_000}, by="y")) == 300 + 500
    assert len(smallest(few, ["h"], {None: 50}, {None: 1000})) == 50
    assert smallest(few, ["h"], {}, {}) == []
