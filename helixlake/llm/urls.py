"""URL filters: longest-match rules, then gradient-boosted trees on lexical features.

Trees are histogram-based, fitted in numpy on about ``SAMPLE`` labelled URLs at most (by a hash), and scored in Arrow
batches. The verdict is ``block`` from a probability of one half. Suffix statistics are smoothed label means of the host's last two labels, and of its last one.

Edge cases: a null url, or one without ``://``, has an empty host and path and meets no rule; the model judges it too;
without labelled URLs, or with labels of one kind only, the model's verdict is ``allow`` or that kind; a
URL with both labels counts as their mean; repeated rows are judged alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host/path); the contract's rules.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SAMPLE = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # a longer one comes later and so goes first
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    p = np.unique(list(text), return_counts=True)[1] / len(text)
    return float(-(p * np.log2(p)).sum())


class Features:
    """Lexical features; suffix statistics are those of the labelled URLs."""

    def __init__(self, urls: list[str], labels: np.ndarray, weight: float = 20.0):
        self.mean = float(labels.mean()) if len(labels) else 0.0
        sums: dict[str, list[float]] = {}
        for u, y in zip(urls, labels):
            for s in self.suffixes(u):
                own = sums.setdefault(s, [0.0, 0.0])
                own[0] += y
                own[1] += 1
        self.stats = {s: (a + weight * self.mean) / (n + weight) for s, (a, n) in sums.items()}

    @staticmethod
    def suffixes(url: str) -> tuple[str, str]:
        host = url.partition("://")[2].split("/")[0].split("?")[0].split("#")[0].lower()
        labels = host.split(".")
        return "1:" + labels[-1], "2:" + ".".join(labels[-2:])

    def of(self, urls: list[str | None]) -> np.ndarray:
        rows = []
        for url in urls:
            url = url or ""
            rest = url.partition("://")[2]
            host = rest.split("/")[0].split("?")[0].split("#")[0]
            path, _, query = rest[len(host) :].partition("#")[0].partition("?")
            n = max(1, len(url))
            one, two = self.suffixes(url)
            rows.append(
                (
                    len(url),
                    len(host),
                    len(path),
                    path.strip("/").count("/") + (path.strip("/") != ""),
                    host.count("."),
                    sum(c.isdigit() for c in url) / n,
                    sum(c.isdigit() for c in host),
                    host.count("-"),
                    _entropy(host),
                    _entropy(path),
                    query.count("=") + query.count("&") if query else 0,
                    url.startswith("https"),
                    self.stats.get(one, self.mean),
                    self.stats.get(two, self.mean),
                )
            )
        return np.array(rows, float).reshape(len(rows), 14)


class Trees:
    """Boosted regression trees for log-odds, of ``depth`` levels over quantile bins."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 20):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) if len(c) else c for c in x.T]
        mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 1e-4
        self.base, self.trees = np.log(mean / (1 - mean)), []
        if not len(y) or y.min() == y.max():
            return self
        b = self._binned(x)
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, 1 << 30)
            node = np.zeros(len(y), int)
            for level in range(self.depth):
                for k in range(2**level - 1, 2 ** (level + 1) - 1):
                    own = np.flatnonzero(node == k)
                    if len(own) < 2 * self.least:
                        continue
                    best = (1e-6, 0, 1 << 30)
                    total, mass = g[own].sum(), h[own].sum()
                    for c in range(x.shape[1]):
                        size = len(self.cuts[c]) + 1
                        gs, hs = np.bincount(b[own, c], g[own], size).cumsum()[:-1], np.bincount(b[own, c], h[own], size).cumsum()[:-1]
                        ns = np.bincount(b[own, c], minlength=size).cumsum()[:-1]
                        gain = gs**2 / (hs + 1) + (total - gs) ** 2 / (mass - hs + 1) - total**2 / (mass + 1)
                        gain = np.where((ns >= self.least) & (len(own) - ns >= self.least), gain, -1)
                        if len(gain) and gain.max() > best[0]:
                            best = (float(gain.max()), c, int(gain.argmax()))
                    feature[k], cut[k] = best[1:]
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + 1)
            self.trees.append((feature, cut, value))
            f += value[leaf]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])

    def score(self, x: np.ndarray) -> np.ndarray:
        b, f, rows = self._binned(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            f += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-f))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[Features, Trees]:
    """From (url, block: 0 or 1). Rows of one URL are one, labelled with their mean; where there are more than ``sample``
    URLs, those with a hash below the bar that leaves about ``sample`` go to the driver."""
    own = labelled.where("url is not null and block is not null").groupBy("url").agg(F.avg("block").alias("block"))
    n = own.count()
    if n > sample:
        own = own.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    rows = sorted(own.collect())
    urls, y = [r.url for r in rows], np.array([r.block for r in rows], float)
    features = Features(urls, y)
    return features, Trees().fit(features.of(urls), y)


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and, where no rule fits, the model's probability of ``block``."""
    features, trees = fit(labelled)

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                p = trees.score(features.of(batch.column("url").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "p_block"])

    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    scored = base.mapInArrow(score, "page_id long, url string, host string, path string, rule string, by_rule string, p_block double")
    model = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", model).alias("verdict"), F.when(F.col("rule").isNull(), F.col("p_block")).alias("p_block"))
