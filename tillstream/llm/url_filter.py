"""URL filter: rules on host and path first, then logistic regression on hashed character n-grams.

The host is what stands between the first `://` and the next `/`, `?`, `#` or the end, with A-Z in lower case;
the path goes on to the next `?`, `#` or the end. A null url, or one without `://`, has an empty host and an empty path.
A rule is a host and a path prefix; it fits its host and all subdomains where the path starts with its own, and the longest
that fits decides. Other urls are judged by a model trained on a small labelled table: n-grams
of `NGRAM` characters of host and path are hashed to `PLACES` places each, a url's vector is scaled to length one, and
full-batch gradient descent runs as DataFrame aggregates. The labelled table is sampled to `LABELLED` urls, those
with the smallest hashes, so it and the weights are bounded.

Only DataFrame expressions are used. With no labelled url of one kind, every url without a rule takes the other
kind, and `allow` if there is none at all. Repeated urls get the same verdict; rows with a null id stay.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.rows import dropped, stored, with_results

ALLOW, BLOCK = "allow", "block"
NGRAM = 4
PLACES = 2048
LABELLED = 4000
ROUNDS = 25
STEP = 8.0
MOMENTUM = 0.8
SHRINK = 1e-4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and a path prefix, written like `example.org/es/`."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host):]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    # A `?` or `#` right after the host ends the path before it begins, and then the second pattern finds nothing.
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's pattern and verdict, or nulls."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pattern, verdict


def _ngrams(text: Column, salt: int) -> Column:
    """Places of the text's n-grams, with its ends marked."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    return F.transform(
        F.when(F.size(chars) >= NGRAM, F.sequence(F.lit(1), F.size(chars) - (NGRAM - 1))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.pmod(
            F.xxhash64(F.lit(salt), *(F.get(chars, i + (j - 1)) for j in range(NGRAM))), F.lit(PLACES)
        ).cast("int") + salt * PLACES,
    )


def features(host: Column, path: Column) -> Column:
    """Places of all n-grams of a url; those of host and path are kept apart. The last place is always there."""
    return F.concat(_ngrams(host, 0), _ngrams(path, 1), F.array(F.lit(2 * PLACES)))


def train(labelled: DataFrame, url_column: str = "url", label_column: str = "blocked") -> list[float]:
    """The weight of every place, from urls and whether they are blocked."""
    urls = labelled.where(F.col(label_column).isNotNull()).groupBy(F.col(url_column).alias("url")).agg(
        F.avg(F.col(label_column).cast("int")).alias("y")
    )
    chosen = urls.orderBy(F.xxhash64("url"), "url").limit(LABELLED)
    host, path = url_parts(F.col("url"))
    places = features(host, path)
    sample = stored(
        chosen.select(F.xxhash64("url").alias("u"), "y", places.alias("places"))
        .select("u", "y", (1 / F.sqrt(F.size("places"))).alias("x"), F.explode("places").alias("place"))
        .groupBy("u", "y", "place").agg(F.sum("x").alias("x")),
        "url-sample",
    )
    total = sample.select("u").distinct().count()
    weights = [0.0] * (2 * PLACES + 1)
    if total:
        kinds = sample.agg(F.min("y"), F.max("y")).first()
        if kinds[0] == kinds[1]:  # nothing to tell apart
            weights[-1] = 1e6 if kinds[0] > 0.5 else -1e6
        else:
            pace = [0.0] * len(weights)
            for _ in range(ROUNDS):
                slope = _slope(sample, weights, total)
                pace = [MOMENTUM * v - STEP * g for v, g in zip(pace, slope)]
                weights = [w + v for w, v in zip(weights, pace)]
    dropped(sample)
    return weights


def _literal(weights: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(weights)), "array<double>")


def _slope(sample: DataFrame, weights: list[float], total: int) -> list[float]:
    """The gradient of the mean loss at the weights."""
    known = _literal(weights)
    margin = sample.groupBy("u", "y").agg(F.sum(F.col("x") * F.get(known, F.col("place"))).alias("m"))
    error = margin.select("u", (1 / (1 + F.exp(-F.col("m"))) - F.col("y")).alias("e"))
    slope = sample.join(F.broadcast(error), "u").groupBy("place").agg(F.sum(F.col("x") * F.col("e")).alias("g"))
    found = {r["place"]: r["g"] / total for r in slope.collect()}  # as many as there are places
    return [found.get(place, 0.0) + SHRINK * w for place, w in enumerate(weights)]


def blocked_score(host: Column, path: Column, weights: list[float]) -> Column:
    """The probability that a url is to be blocked."""
    known, places = _literal(weights), features(host, path)
    total = F.aggregate(places, F.lit(0.0), lambda s, p: s + F.get(known, p))
    return 1 / (1 + F.exp(-total / F.sqrt(F.size(places))))


RESULTS = ["host", "path", "rule", "verdict", "score"]


def judge_urls(pages: DataFrame, rules: Sequence[Rule], weights: list[float], url_column: str = "url") -> DataFrame:
    """The table with host, path, rule, verdict and the model's score."""
    host, path = url_parts(F.col("url"))
    parted = pages.select(F.col(url_column).alias("url"), F.struct("*").alias("row")).select(
        "row", host.alias("host"), path.alias("path")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parted.select(
        "row", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
        blocked_score(F.col("host"), F.col("path"), weights).alias("score"),
    ).withColumn(
        "verdict", F.coalesce("ruled", F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW))
    )
    return with_results(judged, pages, RESULTS)


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule], url_column: str = "url") -> DataFrame:
    """(url, blocked): the urls that a rule decides, as a table to learn from."""
    host, path = url_parts(F.col(url_column))
    _, verdict = rule_of(host, path, rules)
    return pages.select(F.col(url_column).alias("url"), (verdict == BLOCK).alias("blocked")).where(
        F.col("blocked").isNotNull()
    )
