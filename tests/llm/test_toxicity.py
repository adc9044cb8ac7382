import os
import zlib

import pytest

from lakework.llm import toxicity
from lakework.llm.queries import op8_toxicity
from tests.llm.conftest import EDGE_ROWS

LARGER = "/root/testdata/sf0.1"
MANY = "/root/testdata/check_s"


def rates(spark, sf, langs):
    """(share of toxic, share of ordinary) held-out rows of some languages that are predicted toxic."""
    got = op8_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(labels, "doc_id").join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    toxic = [r["predicted"] for r in held if r["toxic"] == 1 and (langs is None or r["lang"] in langs)]
    ordinary = [r["predicted"] for r in held if r["toxic"] == 0]
    return sum(toxic) / len(toxic), sum(ordinary) / len(ordinary)


@pytest.mark.skipif(not os.path.isdir(MANY), reason="the larger table is not here")
def test_held_out_with_many_labels(spark):
    caught, false = rates(spark, MANY, None)
    assert caught > 0.97 and false < 0.01, (caught, false)


def test_held_out_with_few_labels(spark):
    """329 toxic rows to learn from, most of them English; the other languages have a test of their own."""
    caught, false = rates(spark, LARGER, ["en"])
    assert caught > 0.7 and false < 0.05, (caught, false)


def test_held_out_of_rare_languages():
    """German, French and Spanish toxic words are in few texts each."""
    import pandas

    docs, labels = (pandas.read_parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.merge(labels, on="doc_id").sort_values("doc_id")
    held = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    learn = rows[~held]
    sample = [(y, (t or "")[: toxicity.SAMPLE_CHARS]) for y in (0, 1) for t in learn[learn.toxic == y].text]
    scorer = toxicity.Scorer(toxicity.fit(sample, {y: int((learn.toxic == y).sum()) for y in (0, 1)}))
    for lang in ("de", "fr", "es"):
        own = rows[held & (rows.lang == lang)]
        hit = own.text.map(lambda t: scorer.score(t or "") >= toxicity.THRESHOLD)
        assert hit[own.toxic == 1].mean() > 0.5 and hit[own.toxic == 0].mean() < 0.1, lang


def test_distance_is_of_compressed_lengths():
    model = toxicity.ToxicityModel((b" friendly house garden".rjust(2048, b"\0"), b" horrible monster insult".rjust(2048, b"\0")), None, 0.5)
    scorer = toxicity.Scorer(model)
    assert scorer.gain("horrible") > 0 > scorer.gain("friendly")
    assert scorer.gain("garden") < 0 < scorer.gain("monster")


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None), (5, 0), (5, 1)], "doc_id long, toxic int")
    model = toxicity.train(edge, labels)
    got = toxicity.score(edge, model)
    assert got.columns == [*edge.columns, "toxicity"] and got.count() == len(EDGE_ROWS)
    assert got.filter("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    none = toxicity.train(edge, labels.limit(0))
    assert {r["score"] for r in toxicity.score(edge, none, out="score").collect()} == {0.0}
    assert toxicity.score(nothing, model).collect() == []
