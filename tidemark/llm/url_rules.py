"""URL filters: rules indexed by their rarest literal token, run only where it occurs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 100_000
_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """A pattern over ``host + path``, and the whole tokens that any match contains.

    ``rank`` decides between fitting rules: the larger wins, then the longer name, then the
    first of the list. ``listed`` rules show their name in the result.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int = 0
    listed: bool = True


def host_rule(name: str, verdict: str) -> Rule:
    """From ``host/path``: fits the host and its subdomains, where the path starts with the rule's."""
    host, slash, rest = name.partition("/")
    whole = rest.split("/")[:-1]  # the last segment may go on in the url
    tokens = [*_TOKEN.findall(host), *(t for part in whole for t in _TOKEN.findall(part.lower()))]
    return Rule(name, rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + rest)}", tuple(tokens), verdict, 1)


def word_rule(word: str, verdict: str) -> Rule:
    """Fits hosts that have ``word`` (one or more tokens joined by hyphens) as a label or part of one."""
    pattern = rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)"
    return Rule(word, pattern, tuple(_TOKEN.findall(word)), verdict, 0, False)


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(after, F.lit("")), _ASCII_UPPER, _ASCII_LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many rows each token of the rules occurs; no more rows than the rules have tokens.

    Tokens are summed per task before any meet, so a token of every url costs no more than others.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    spark = urls.sparkSession
    found = (
        urls.select(F.explode(F.array_distinct(F.split(F.lower(F.concat("host", "path")), "[^a-z0-9]+"))).alias("token"))
        .groupBy("token")
        .count()
        .join(spark.createDataFrame([(t,) for t in wanted], "token string"), "token")
    )
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in found.collect()}


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", max_rules: int = MAX_RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages(page_id, url)``.

    A null url or one without ``://`` has an empty host and path, fits no rule and gets
    ``default``. Rules without a literal token are tried on every url. Rows that repeat stay.
    Other columns are ignored. More than ``max_rules`` rules are refused: the index is sent to
    every task.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules}")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counts = token_counts(urls, rules)
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for n, r in enumerate(rules):
        if r.tokens:
            index.setdefault(min(r.tokens, key=lambda t: (counts[t], t)), []).append(n)
        else:
            always.append(n)
    rules = list(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[int, re.Pattern[str]] = {}
        for batch in batches:
            names, verdicts = [], []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                whole, best = host + path, None
                for n in [*always, *(n for t in set(_TOKEN.findall(whole.lower())) for n in index.get(t, ()))]:
                    if n not in compiled:
                        compiled[n] = re.compile(rules[n].pattern)
                    if compiled[n].search(whole):
                        key = (rules[n].rank, len(rules[n].name), -n)
                        best = max(best, key) if best else key
                rule = rules[-best[2]] if best else None
                names.append(rule.name if rule and rule.listed else None)
                verdicts.append(rule.verdict if rule else default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
