import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakework.llm import variants
from lakework.llm.queries import op12_variants
from tests.llm.conftest import EDGE_ROWS, SF

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(rows):
    seen = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if i is not None:
                h = zlib.crc32(f"{i}:{run}".encode())
                if h % 31 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """Whether a and b differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


def neighbours(words):
    """Near words of each word: those that share what is left when a code point is masked or taken out."""
    found = {w: set() for w in words}
    masked, shorter = {}, {}
    for w in words:
        for i in range(len(w)):
            masked.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for group in masked.values():
        for w in group:
            found[w] |= group - {w}
    for w in words:
        for x in shorter.get(w, ()):
            found[w].add(x)
            found[x].add(w)
    return found


def brute(rows):
    n = vocabulary(rows)
    near = neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents(spark, documents):
    want = brute([tuple(r) for r in documents.select("doc_id", "text").collect()])
    assert got(op12_variants(spark, SF)) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_halves_that_many_words_share(spark, documents):
    """Shards of a few rows: every half of some words is cut into blocks."""
    docs = documents.filter("doc_id < 40")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert got(variants.variants(docs, shard_rows=20)) == want


PLANTED = [
    (1, "Beautiful " * 400 + "beautifull beautifull beautifu beautifu beautyful beautyful bbeautiful bbeautiful " + "beautifuls " * 25),
    (2, "beautifulls beautifulls xbeautifulls Straße straßen STRASSEN straßen straßen Éclairs éclairs éclairs ÷×÷×÷×÷ ÷×÷×÷×÷"),
    (None, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaab aaaaaab baaaaaa baaaaaa aabaaaa aabaaaa"),
    (4, "abcdefg abcdefg bcdefgh bcdefgh " + "n" * 5000 + " " + "n" * 5000 + " " + "n" * 4999 + " " + "n" * 4999),
]


def test_planted_and_edge_rows(spark, edge, nothing):
    docs = edge.unionByName(spark.createDataFrame(PLANTED, "doc_id long, text string"), allowMissingColumns=True)
    want = brute([r[:2] for r in EDGE_ROWS] + PLANTED)
    assert got(variants.variants(docs)) == want
    roots = {r[0]: r[2] for r in want}
    assert roots["beautifulls"] in ("beautiful", "beautifuls") and variants.variants(nothing).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=3, max_size=9), min_size=1, max_size=40))
def test_index_equals_comparison(words):
    words = sorted(words)
    index = variants.Index(words)
    exact = [len(w) // 2 for w in words]
    q, w = index.near(words, exact)
    want = {(x, y) for x in words for y in words if one_edit(x, y) and y.startswith(x[: len(x) // 2])}
    found = [(words[a], words[b]) for a, b in zip(q, w)]
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("query", ["abcdxyz", "zzzzzzz", "abcdefgz"])
def test_symbols_that_no_word_has(query):
    words = ["abcdefg", "abcdxy", "abcdy"]
    index = variants.Index(words)
    _, w = index.near([query], [3])
    assert sorted(words[k] for k in np.unique(w)) == sorted(x for x in words if one_edit(query, x) and x.startswith(query[:3]))
