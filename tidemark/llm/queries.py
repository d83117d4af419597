"""One query per operator, over its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    centroids,
    conversations,
    decontaminate,
    html_text,
    language,
    merkle,
    oracle,
    packing,
    pii,
    repeats,
    simhash,
    toxicity,
    url_rules,
    warc,
)
from tidemark.llm.common import held_out, kept, table
from tidemark.llm.pii_spans import KINDS
from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("score", F.round("score", 6))


@query
def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.edited(table(spark, sf_dir, "documents"))
    changed = merkle.differing(*map(F.col, ("sections", "paragraphs", "edited_sections", "edited_paragraphs")))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        merkle.print_string(F.col("root"), F.col("sketch")).alias("fingerprint"),
        merkle.print_string(F.col("edited_root"), F.col("edited_sketch")).alias("edited_fingerprint"),
        merkle.likeness(*map(F.col, ("root", "sketch", "edited_root", "edited_sketch"))).alias("near_edited"),
        merkle.likeness(*map(F.col, ("root", "sketch", "next_root", "next_sketch"))).alias("near_next"),
        F.size(changed).alias("changed_paragraphs"),
        F.concat_ws("/", F.get(changed, F.lit(0))["section"], F.get(changed, F.lit(0))["paragraph"]).alias("first_change"),
    )


@query
def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), min_length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary() -> tuple[str, str]:
    """File and split pattern of the merge ranks that give the ids of ``byte_bpe_50k.json``."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added_tokens() -> packing.AddedTokens:
    return packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), *vocabulary(), added=added_tokens()))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    found = warc.read(archives, keep_payload=False)
    sound = F.when(F.col("problem").isNull(), F.col("payload_digest")).otherwise(F.raise_error("problem"))
    return found.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")


SQL["op7_warc"] = """WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload,
         CASE WHEN strlen(coalesce(html, '')) >= 100 THEN min(page_id) OVER (PARTITION BY coalesce(html, '')) END AS first
  FROM pages)
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads"""


TOXIC_FROM = 0.5


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


LISTED = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCKED_WORDS = ("ads", "ads-track", "adult", "adult-x", "casino", "cheap-pills", "free-bets", "pills", "spam")
URL_RULES = [
    *(url_rules.host_rule(name, verdict) for name, verdict in LISTED),
    *(url_rules.word_rule(word, "block") for word in BLOCKED_WORDS),
]


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def _url_sql() -> str:
    """Each listed rule by a suffix and a prefix test, longest first; words as parts of host labels."""
    cases, verdicts = [], []
    for name, verdict in sorted(LISTED, key=lambda rule: -len(rule[0])):
        host, _, path = name.partition("/")
        cases.append(f"WHEN ends_with('.' || host, '.{host}') AND starts_with(path, '/{path}') THEN '{name}'")
        verdicts.append(f"WHEN '{name}' THEN '{verdict}'")
    words = "|".join(BLOCKED_WORDS)
    return f"""WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages), ruled AS (SELECT *, CASE {' '.join(cases)} END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE rule {' '.join(verdicts)}
       ELSE CASE WHEN regexp_matches(host, '(^|[.-])({words})([.-]|$)') THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled"""


SQL["op10_url_rules"] = _url_sql()


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).drop("text")
    exact = F.filter("found", lambda s: s["exact"])
    counts = [_number(exact, kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(exact), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with planted faults, chosen by crc32 of ``conv_id:turn``; nulls count as one space."""
    present = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    damage = F.crc32(F.concat_ws(":", present["conv_id"], present["turn"]).cast("binary")) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(present["text"], "[.!?]", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(present["role"]).alias("role"),
        text.otherwise(present["text"]).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    rows = damaged(original)
    plans = kept(conversations.plans(rows))
    digests = conversations.digests(rows, plans).withColumnRenamed("conv_id", "of")
    found = plans.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    ids = original.select(F.col("conv_id").alias("of")).distinct()
    zeros = {c: 0 for c in ("gaps", *conversations.COUNTS, "cost")}
    filled = {c: F.coalesce(c, F.lit(z).cast("long")) for c, z in zeros.items()}
    filled |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    out = ids.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("of").alias("conv_id"), *[c.alias(name) for name, c in filled.items()])


SQL["op12_conversations"] = oracle.conversations_sql()


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(
        table(spark, sf_dir, "embeddings"), size=64, scale=256, centroids=40, rounds=5, seed=2
    )
    return centroids.with_inertia(found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


SQL["op13_centroids"] = oracle.centroids_sql(size=64, scale=256, centroids=40, rounds=5, seed=2)
