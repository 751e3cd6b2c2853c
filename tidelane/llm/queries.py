"""The registered queries of this package, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelane.llm import (
    decontaminate, fingerprints, line_runs, mixing, ngram_join, packing, periodic, pii, quality, topk, url_filter, warc, whitening,
)
from tidelane.llm.common import shared_path

#: Sources are told apart by their tokens, the 20 heaviest; BUDGET is the share of all tokens that a mixture draws.
CLASSES = {"source": 20, "lang": ["en", "de", "fr", "es"], "topic": list(mixing.TOPICS)}
BUDGET = 0.8
RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sampling probability, and whether it was drawn."""
    drawn = mixing.mix(_table(spark, sf_dir, "documents"), classes=CLASSES, budget=BUDGET)
    return drawn.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "weight", "sampled")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of each text, and its likeness to its edited text and to the next."""
    found = fingerprints.fingerprints(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.size("changed.found").cast("long").alias("n_changed"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document by links of 5-word shingle sets."""
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth, by inner product of whole numbers."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.whole_numbers(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    path = shared_path(spark, "warc")
    warc.write_pages(_table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read_pages(spark, path))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each text: counts of the base kinds, and digests of the places."""
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(pii.BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE], F.sha2(F.encode(pii.joined(base), "UTF-8"), 256).alias("base_sha256"),
        pii.joined(F.col("pii")).alias("spans"), count("iban"), F.array_max("pii.score").alias("top_score"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's URL by rules, else by two character models."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that 10 documents or more hold."""
    kept = line_runs.drop_frequent_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector along the 16 directions of most variance, scaled to variance one."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", whitening.grid(F.col("embedding")).alias("vector"))
    found = whitening.whiten(vectors).withColumn("c", F.explode(F.arrays_zip("whitened", "explained", F.sequence(F.lit(1), F.size("whitened")).alias("component"))))
    return found.select(
        "vec_id", F.col("c.component").cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error",
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that benchmark items hold in windows of 10, and those items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), drop="spans")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _with_periods(docs: DataFrame) -> DataFrame:
    """``docs``, words of every tenth or so text (by crc32 of the id) repeated from a word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    # Columns of their own, so that the words are split once and not for each of them.
    chosen = docs.withColumn("words", F.when(h % 10 == 0, split)).withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    text = F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return chosen.withColumn("text", text).drop("words", "a", "p")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in each document, every tenth or so of which is made periodic, and it without repeats."""
    found = periodic.find_runs(_with_periods(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    less = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    order = lambda x, y: (
        F.when(less(x, y) != 0, F.when(less(x, y) > 0, -1).otherwise(1))
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
        .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1)).otherwise(0)
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    best = F.get(F.array_sort("runs", order), F.lit(0))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"), sha(lines).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_mix_sources, op2_fingerprints, op3_ngram_join, op4_top_k, op5_warc, op6_pii, op7_url_filter, op8_line_dedup,
            op9_packing, op10_quality, op11_whitening, op12_decontaminate, op13_periodic_runs,
        )
    }


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to, TRUE AS intact
FROM k
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents
), k AS (
  SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

DECONTAMINATE = r"""
WITH b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), n AS (
  SELECT item, w, least(len(w), 10) AS width FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, width, array_to_string(w[k : k + width - 1], ' ') AS words
  FROM (SELECT item, w, width, unnest(range(1, len(w) - width + 2)) AS k FROM n)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), nexts AS (
  SELECT rid, i, list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM p
), spelled AS (
  SELECT rid, i, width, array_to_string(ws[1 : width], ' ') AS words
  FROM nexts, (SELECT DISTINCT width FROM windows) WHERE len(ws) >= width
), hits AS (
  SELECT rid, i, s.width, item FROM spelled s JOIN windows v ON s.words = v.words AND s.width = v.width
), h AS (
  SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + width)) AS place FROM hits) GROUP BY rid
), t AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


def statements() -> dict[str, str]:
    return {"op4_top_k": TOP_K, "op5_warc": WARC, "op8_line_dedup": LINES, "op12_decontaminate": DECONTAMINATE}
