"""The registered queries of the operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.llm import (
    licenses,
    merkle,
    minhash,
    mixing,
    neighbours,
    packing,
    periodic,
    quality,
    secrets,
    simhash,
    sql,
    toxicity,
    urls,
    warc,
)
from oreflow.llm.common import SPACE_CLASS, Workspace, lower_ascii


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op1")
    docs = table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    placed, pieces = mixing.mixed(work.keep(docs, "sizes"), work)
    of_pass = [F.when(F.col("pass") == p, F.col("slot")) for p in range(mixing.PASSES)]
    # The last block of a pass over a row may be the first one of the next pass.
    shared = [(F.max(a) == F.min(b)).cast("long") for a, b in zip(of_pass, of_pass[1:])]
    blocks = F.count(F.lit(1)) - sum((F.coalesce(x, F.lit(0)) for x in shared), F.lit(0))
    taken = pieces.groupBy("row").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("slot"), blocks.alias("blocks")
    )
    return placed.join(taken, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "source",
        "slot",
        F.coalesce("blocks", F.lit(0)).cast("long").alias("blocks"),
    )


def op2_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, Workspace(spark, "op2"), F.col("vec_id") % 20 == 0)


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), Workspace(spark, "op3"))
    return found.select("doc_id", "position", "candidate", "before", "score", "secret")


# The rules that the query is given.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op4_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return urls.url_filter(table(spark, sf_dir, "pages"), rules)


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"), Workspace(spark, "op5"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "chunks")


def op6_risk_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = Workspace(spark, "op6").keep(quality.measured(table(spark, sf_dir, "documents")), "stats")
    cuts = quality.fitted(stats, table(spark, sf_dir, "labels"))
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        quality.passes(cuts, F.col("lang")).alias("kept"),
    )


def op7_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "op7"))


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Workspace(spark, "op8"))
    return toxicity.scored(docs, model)


def op9_deficit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, Workspace(spark, "op9"), tokenizer_path())


def op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("passages")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    of = lambda text: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.unhex(F.when(chosen, of(lower_ascii(F.col("text")))))
    proofs = merkle.manifest(docs, Workspace(spark, "op11"), of(F.col("text")), extra={"tampered": tampered})
    folded = merkle.folded(F.coalesce(merkle.shown(F.col("tampered")), F.col("leaf")), F.col("path"))
    told = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of every tenth text, by a hash of its id, repeating from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")
    aimed = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    aimed = aimed.withColumn("a", F.when(n > 0, F.col("g") % n))
    aimed = aimed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    tail = F.transform(F.sequence("a", n - 1), lambda i: F.get("w", place(i)))
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a").cast("int")), tail)
    return aimed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(text).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mix,
        op2_balanced_postings,
        op3_secret_forest,
        op4_url_sweep,
        op5_warc_chunks,
        op6_risk_cutoffs,
        op7_super_minhash,
        op8_nnpu_toxicity,
        op9_deficit_packing,
        op10_license_diagonals,
        op11_merkle_manifest,
        op12_periodic_runs,
        op13_simhash_tiles,
    )
}

# ---- the same in SQL, where SQL can say it ---------------------------------------------
#
# The others rest on a schedule, learned cutoffs or weights, tokens, or an approximate search; the
# tests hold them against plain Python.

_RULES = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)

ORACLE: dict[str, str] = {
    "op4_url_sweep": f"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
parts AS (
  SELECT page_id, url, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1) AS raw,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
         row_number() OVER () AS n
  FROM parts),
fits AS (
  SELECT p.n, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM named p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM named p LEFT JOIN fits f ON p.n = f.n AND f.place = 1""",
    "op5_warc_chunks": """
WITH raw AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS page_id FROM raw WHERE payload_bytes >= 100 GROUP BY ALL),
told AS (
  SELECT r.*, CASE WHEN r.payload_bytes >= 100 AND f.page_id <> r.page_id THEN f.page_id END AS refers_to
  FROM raw r LEFT JOIN firsts f ON r.payload_digest = f.payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       refers_to, CASE WHEN refers_to IS NULL THEN cast(greatest(1, ceil(payload_bytes / 1048576)) AS integer) ELSE 1 END AS chunks
FROM told""",
    "op7_super_minhash": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
pairs AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x),
groups AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept
FROM documents d JOIN groups g ON d.doc_id = g.a LEFT JOIN sizes s ON d.doc_id = s.doc_id""",
    "op10_license_diagonals": sql.LICENSES,
    "op11_merkle_manifest": sql.MERKLE,
    "op12_periodic_runs": sql.PERIODIC,
}
