import re

import pytest
from pyspark.sql import functions as F

from lakework.llm import licenses
from lakework.llm.queries import op6_licenses
from tests.llm.conftest import EDGE_ROWS, SF

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for x in licenses.BASE_PHRASES:
        phrase = x.text.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(x.label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def base(df, key):
    return sorted(((r[key], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=str)


def test_base_places_of_documents(spark, documents):
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in documents.collect()), key=str)
    got = op6_licenses(spark, SF)
    assert base(got, "doc_id") == want
    assert any(w[2] for w in want)
    for r in got.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


@pytest.fixture(scope="module")
def planted(spark):
    notice = next(x.text for x in licenses.NOTICES if x.label == "bsd").split()
    texts = [
        "Under the MIT License. under-the mit/license x under the mit license",
        "apache license, version 2.0 CC-BY-NC",
        "x " * 500 + "UNDER THE MIT LICENSE",
        " ".join(notice),
        " ".join(notice[:8] + ["gladly"] + notice[8:15] + notice[16:]),  # one word more, one less
        " ".join(notice[:6]),
        "under the mit licenses",
        "under the éd mit license cc by ncé",
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_planted(planted):
    got = licenses.scan(planted)
    assert base(got, "id") == sorted(((r["doc_id"], *brute(r["text"])) for r in planted.collect()), key=str)
    labels = {r["id"]: r["labels"] for r in got.collect()}
    assert labels[0] == "mit" and labels[1] == "apache-2,cc-by-nc" and labels[2] == "mit"
    assert labels[3] == labels[4] == "bsd"
    assert labels[5] == labels[6] == labels[7] == ""


def test_edge_rows(edge, nothing):
    got = licenses.scan(edge)
    assert base(got, "id") == sorted(((i, *brute(t)) for i, t, *_ in EDGE_ROWS), key=str)
    assert licenses.scan(nothing).collect() == []


def test_spans_give_places(planted):
    r = licenses.spans(planted).filter((F.col("id") == 4) & (F.col("template") >= 0)).collect()
    assert len(r) == 1 and r[0]["first"] == 0 and r[0]["last"] >= 16 and r[0]["cover"] < 1
