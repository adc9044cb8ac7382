import hashlib
import re

from lakework.llm import contamination
from lakework.llm.queries import op13_contamination
from tests.llm.conftest import EDGE_ROWS, SF

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            patterns.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(p) for p in patterns}
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                owners = patterns.get(tuple(w[at : at + k]))
                if owners:
                    hit |= set(range(at, at + k))
                    found |= owners
        found -= {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_documents(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute(pairs(documents, "doc_id", "text"), pairs(benchmark, "item_id", "text"))
    assert got(op13_contamination(spark, SF)) == want
    assert any(r[2] for r in want)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "one TWO three four five six seven eight nine ten"),
    (10, "Over the lazy"),
    (3, "dog"),
    (4, None),
    (5, "!!!"),
    (5, "é日本語"),
    (None, "text goes on"),
    (6, "the long text goes on and on the long text goes on and on the long"),
]


def test_items_of_all_lengths(spark, edge, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS n_hit")
    texts = [
        "x one two three four five six seven eight nine ten eleven twelve y one two three",
        "one two three four five six seven eight nine nine ten",
        "one two three one two three four five six seven eight nine ten one two three four five six seven eight nine ten",
        "DOG dog-dog lazy over the lazier over the-lazy",
        "dogs",
    ]
    docs = edge.unionByName(spark.createDataFrame(list(enumerate(texts, 20)), "doc_id long, text string"), allowMissingColumns=True)
    want = brute([r[:2] for r in EDGE_ROWS] + list(enumerate(texts, 20)), ITEMS)
    assert got(contamination.report(docs, items)) == want
    # The same from many small blocks of the benchmark.
    assert got(contamination.report(docs, items, block_windows=2)) == want
    assert contamination.report(nothing, items).collect() == []
    kept = contamination.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(pairs(kept, "doc_id"), key=str) == sorted(((r[0],) for r in want if not r[5]), key=str)


def test_no_benchmark(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(contamination.report(documents, none)) == brute(pairs(documents, "doc_id", "text"), [])


def test_blocks_hold_all_windows():
    items = [(i, [b"%d" % j for j in range(i, i + n)]) for i, n in enumerate((1, 9, 10, 11, 35, 100))]
    whole = {p for _, w in items for p in {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1))}}
    for size in (1, 7, 1000):
        parts = list(contamination.blocks(items, size))
        cut = {tuple(w[i : i + 10]) for part in parts for _, w in part for i in range(max(len(w) - 9, 1))}
        assert cut == whole
        assert all(sum(max(len(w) - 9, 1) for _, w in part) <= size for part in parts)


def test_shifts_skip_positions():
    m = contamination.Machine({tuple(b"a b c d e f g h i j".split()): {1}})
    assert m.far == 8 and m.shift[(b"h", b"i", b"j")] == 0 and m.shift[(b"a", b"b", b"c")] == 7
    assert [o[:2] for o in m.occurrences(b"x a b c d e f g h i j a b c d e f g h i j".split())] == [(1, 11), (11, 21)]
