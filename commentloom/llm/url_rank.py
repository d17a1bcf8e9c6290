"""Verdicts on urls: rules first, then trust and distrust carried along the links between hosts.

Trust is personalised PageRank from the hosts that the rules allow, along the links. Distrust is the same
walk against the links from the hosts that the rules block: whoever links to a blocked host is
suspected. A host is blocked when its distrust is above the threshold and above its trust.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions import quote
from commentloom.llm.html_text import host_of, page_links
from commentloom.llm.scratch import forget, numbered, stored

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DAMPING = 0.85
ROUNDS = 10
# A host is suspect above this part of the mean distrust of a host.
THRESHOLD = 0.5

# A page without any of these has no link to another host: a base, or an address that begins with a scheme, two slashes
# or a reference.
_MAY_LINK = "(?i)<base\\b|href\\s*=\\s*[\"']?\\s*([a-z][a-z0-9+.-]*:|//|&)"


def path_of(url: str) -> str:
    """SQL for the path of a url: after the host up to ?, # or the end."""
    return (
        f"CASE WHEN instr({url}, '://') > 0 THEN regexp_extract(substring({url}, instr({url}, '://') + 3), "
        f"'^[^/?#]*([^?#]*)', 1) ELSE '' END"
    )


def rule_for(host: str, path: str, rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """SQL for the longest rule that fits, as a struct of rule and verdict, or NULL."""
    cases = []
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = (
            f"({host} = {quote(rule_host)} OR endswith({host}, {quote('.' + rule_host)})) AND startswith({path}, {quote(rule_path)})"
        )
        cases.append(f"WHEN {fits} THEN named_struct('rule', {quote(rule_host + rule_path)}, 'verdict', {quote(verdict)})")
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS struct<rule: string, verdict: string>)"


def judge_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    source: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES,
    rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row.

    A NULL url or one without ``://`` has empty host and path, fits no rule and is allowed. Where no rule fits,
    the host's verdict counts; a host that no walk reaches is allowed. Hosts of whose pages the
    rules allow (block) half or more are the seeds. NULL html has no links, nor have comments and scripts. Urls may be of any length. Repeated rows
    count as often as they occur. An empty table gives an empty result, other columns are not looked at.
    """
    named = pages.select(
        F.col(page_id).alias("page_id"),
        F.coalesce(F.expr(host_of(f"`{url}`")), F.lit("")).alias("host"),
        F.coalesce(F.expr(path_of(f"`{url}`")), F.lit("")).alias("path"),
        F.col(source).alias("_html"),
    )
    ruled = named.withColumn("_rule", F.expr(rule_for("host", "path", rules)))
    edges = stored(host_edges(named), "edges")
    seeds = stored(host_seeds(ruled), "seeds")
    walk = dict(seeds=seeds, rounds=rounds)
    trust = propagated(edges.toDF("src", "dst"), seed="trusted", **walk)
    distrust = propagated(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), seed="blocked", **walk)
    scores = (
        trust.withColumnRenamed("score", "trust")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
        .fillna(0.0, ["trust", "distrust"])
    )
    scores = stored(scores, "scores")
    # Walks end at hosts without links, so scores count as shares of what is left.
    total = scores.agg(*[F.greatest(F.sum(c), F.lit(1e-300)).alias(c) for c in ("trust", "distrust")]).first()
    hosts = seeds.count()
    suspect = (F.col("distrust") * hosts > threshold * (total["distrust"] or 1.0)) & (
        F.col("distrust") * (total["trust"] or 1.0) > F.col("trust") * (total["distrust"] or 1.0)
    )
    verdict = F.coalesce(
        F.col("_rule.verdict"), F.when(F.coalesce(suspect, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    )
    return ruled.drop("_html").join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def host_edges(named: DataFrame) -> DataFrame:
    """(src, dst): the links between different hosts, each once. Links within a host move nothing."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [sorted(set(page_links(source))) for source in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(links, pa.list_(pa.string()))], names=["host", "links"]
            )

    linking = named.where(F.col("host") != "").where(F.rlike("_html", F.lit(_MAY_LINK)))
    links = linking.select("host", "_html").mapInArrow(read, "host string, links array<string>")
    return (
        links.select(F.col("host").alias("src"), F.explode("links").alias("_link"))
        .select("src", F.expr(host_of("_link")).alias("dst"))
        .where("dst <> '' AND src <> dst")
        .distinct()
    )


def host_seeds(ruled: DataFrame) -> DataFrame:
    """One row per host: whether the rules allow, or block, at least half of its pages.

    A host with as many allowed as blocked pages is a blocked one.
    """
    allowed, blocked = (F.count_if(F.col("_rule.verdict") == v) for v in ("allow", "block"))
    pages = F.count(F.lit(1))
    return ruled.where("host <> ''").groupBy("host").agg(
        ((2 * allowed >= pages) & (allowed > blocked)).alias("trusted"),
        ((2 * blocked >= pages) & (blocked >= allowed)).alias("blocked"),
    )


def propagated(
    edges: DataFrame, seeds: DataFrame, seed: str, rounds: int = ROUNDS, damping: float = DAMPING
) -> DataFrame:
    """(host, score) of personalised PageRank from the seeds; scores of all hosts sum to 1 at most.

    Shares that reach a host without links go back to no one. Each round sums the shares of a host's links ahead of
    the shuffle and is stored, so a host that everybody links to is one row per task.
    """
    chosen = seeds.where(F.col(seed))
    count = chosen.count()
    start = chosen.select("host", F.lit((1 - damping) / max(count, 1)).alias("_jump"))
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_degree"))
    weighted = stored(
        edges.join(degree, "src").select("src", "dst", (F.lit(damping) / F.col("_degree")).alias("_part")), "edges"
    )
    current = stored(start.select("host", (F.col("_jump") / (1 - damping)).alias("score")), "ranks")
    if weighted.isEmpty() or not count:
        rounds = 0
    for _ in range(rounds):
        flow = current.withColumnRenamed("host", "src").join(weighted, "src").select(
            F.col("dst").alias("host"), (F.col("score") * F.col("_part")).alias("score")
        )
        after = stored(
            flow.unionByName(start.withColumnRenamed("_jump", "score")).groupBy("host").agg(F.sum("score").alias("score")),
            "ranks",
        )
        forget(current)
        current = after
    return current
