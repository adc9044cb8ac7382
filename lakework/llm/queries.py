"""The operators' queries over the driver tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.llm import contamination, exact, language, licenses, merkle, nearest, neardup, packing, pieces, quotes, toxicity, urls, variants
from lakework.llm.common import id_remainder, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.piece_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return out.withColumnRenamed("id", "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), out="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", toxicity.toxic(F.col("score")).cast("int").alias("predicted"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


#: The site rules of the filter.
SITE_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.site_rule(name, verdict) for name, verdict in SITE_RULES]
    return urls.judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("sn", "rank")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_exact_dedup, op3_language, op4_packing, op5_neardup,
        op6_licenses, op7_quotation_links, op8_toxicity, op9_nearest, op10_urls,
        op11_merkle, op12_variants, op13_contamination,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, by the table of the reflected polynomial."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    octets = f"list_transform(range(0, CAST(length(hex({text})) / 2 AS BIGINT)), lambda i: CAST('0x' || hex({text})[2 * i + 1:2 * i + 2] AS BIGINT))"
    step = f"lambda a, b: xor(a >> 8, ({table})[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), 4294967295)"


def _merkle_sql(levels: int = 6, over: int = 4) -> str:
    """Trees of sources of up to 16**levels leaves, of up to 16**over sources."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    head = " || ".join(field(c) for c in merkle.LEAF_COLUMNS[:-1])
    ctes = [
        f"""docs AS (
  SELECT row_number() OVER () AS rid, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sn, sha256({head} || {field("text")}) AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({head} || {field(_lowered("text"))}) END AS tampered
  FROM documents)""",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY sn ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs)""",
        "n0 AS (SELECT sn, idx, leaf AS hash, count(*) OVER (PARTITION BY sn) AS cnt FROM placed)",
        "p0 AS (SELECT rid, sn, idx, coalesce(tampered, leaf) AS fold, '' AS sibs FROM placed)",
    ]
    for k in range(levels + over):
        if k == levels:  # the subroots become nodes of one more tree
            ctes += [
                f"s{k} AS (SELECT 0 AS sn, sn AS idx, hash, count(*) OVER () AS cnt FROM n{k})",
                f"q{k} AS (SELECT rid, 0 AS sn, sn AS idx, fold, sibs FROM p{k})",
            ]
        nodes, paths = (f"n{k}", f"p{k}") if k != levels else (f"s{k}", f"q{k}")
        nxt = k + 1
        ctes += [
            f"""g{k} AS (
  SELECT sn, idx // 16 AS idx, CASE WHEN min(cnt) > 1 THEN sha256(string_agg(hash, '' ORDER BY idx)) ELSE min(hash) END AS hash,
         list(hash ORDER BY idx) AS kids, min(cnt) > 1 AS split FROM {nodes} GROUP BY sn, idx // 16)""",
            f"n{nxt} AS (SELECT sn, idx, hash, count(*) OVER (PARTITION BY sn) AS cnt FROM g{k})",
            f"""p{nxt} AS (
  SELECT rid, sn, up AS idx, CASE WHEN split THEN sha256(before || fold || after) ELSE fold END AS fold, sibs || CASE WHEN split THEN before || after ELSE '' END AS sibs
  FROM (SELECT p.*, g.idx AS up, g.split, array_to_string(kids[1:p.idx % 16], '') AS before, array_to_string(kids[p.idx % 16 + 2:], '') AS after
        FROM {paths} p JOIN g{k} g ON g.sn = p.sn AND g.idx = p.idx // 16))""",
        ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT d.doc_id, d.leaf, s.hash AS subroot, r.hash AS root, sha256(p.sibs) AS proof_sha256, p.fold AS folded_root, p.fold = r.hash AS verified
FROM docs d JOIN p{levels + over} p ON p.rid = d.rid JOIN n{levels} s ON s.sn = d.sn CROSS JOIN n{levels + over} r
"""


_RUN = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

ORACLE_SQL = {
    "op2_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op10_urls": """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules(rule, site, prefix, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS n
  FROM parts p LEFT JOIN rules r ON (p.host = r.site OR ends_with(p.host, '.' || r.site)) AND starts_with(p.path, r.prefix)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
""",
    "op11_merkle": _merkle_sql(),
    "op12_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_lowered("text")}, '[A-Za-z\u00c0-\u00ff]+')) AS run FROM documents
), hashed AS (
  SELECT run, n, {_crc32("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run)
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), masked AS (
  SELECT word, n, i, word[1:i] AS l, word[i + 2:] AS r FROM words, unnest(range(0, length(word))) t(i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM masked a JOIN masked b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT w.word, m.word, m.n FROM words w JOIN masked m ON w.word = m.l || m.r
  UNION SELECT m.word, w.word, w.n FROM words w JOIN masked m ON w.word = m.l || m.r
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 10 * w.n THEN b.best END AS form, CASE WHEN b.best_n >= 10 * w.n THEN b.best_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS spot, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN formed f ON f.word = walk.spot WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(spot, steps) AS root FROM walk GROUP BY word) r ON r.word = f.word
""",
    "op13_contamination": f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lowered("coalesce(text, '')")}, {_RUN}) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_lowered("coalesce(text, '')")}, {_RUN}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS gram
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0
), grams AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM docs, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) t(i) WHERE len(w) >= k
), hits AS (
  SELECT g.rid, g.i, g.k, x.item_id FROM grams g JOIN windows x ON x.k = g.k AND x.gram = g.gram
), spots AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM hits)) GROUP BY rid
), found AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM hits GROUP BY rid
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(s.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.names, '')) AS items_sha256,
       coalesce(s.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN spots s ON s.rid = d.rid LEFT JOIN found f ON f.rid = d.rid
""",
}
