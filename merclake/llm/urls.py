"""URL filters: gradient-boosted trees over lexical features, below a list of host and path rules.

A rule names a host and the beginning of a path. It fits the host and all its subdomains; of several that fit the
longest wins. What no rule decides, the trees decide: they see lengths, path depth, digit ratio, entropy, numbers of
parameters and how often URLs with the same last host label, or host ending of two labels, were labelled bad.

Labels. The trees are trained from labelled URLs, a table (url, bad). Where the corpus has none, ``weak_labels``
labels a URL bad if a word of its host is on a list of words. The words are no feature, so the trees learn from the
shape of such URLs and also judge hosts without them. They are fitted on a bounded sample (``sample`` labelled rows of
the smallest hash). Suffix statistics are counted over all labelled rows and stored as a table with a row for each
ending, which is joined to the URLs; an ending without labelled rows has the overall rate, and a row the trees are fitted
on is left out of its own rates. Every URL is judged.

Defined results: host and path of a null URL, or one without ``://``, are empty; no rule fits it and the trees judge
it like any other. Equal rules: the last one given holds. Repeated rows are judged each. Without
labels of both classes the trees allow everything. Without rows the result is empty. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm import trees
from merclake.llm.common import documents, sampled, small_batches, store
from merclake.llm.registry import query

#: The rules of the query: host with the beginning of a path, and the verdict. Fixed values.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Words of a host that mark a URL as bad where no labels are given.
BAD_WORDS = ("ads", "adult", "bets", "casino", "crack", "gamble", "loan", "loans", "pills", "poker", "porn", "sex", "slots", "spam", "track", "viagra", "warez", "xxx")
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "longest_label", "digit_ratio", "host_digits", "host_hyphens",
    "path_hyphens", "parameters", "query_length", "fragment_length", "entropy", "host_entropy", "vowel_ratio", "upper_ratio", "encoded",
    "top_rate", "ending_rate",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL."""
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def entropy(text: str) -> float:
    """Bits per character."""
    if not text:
        return 0.0
    _, n = np.unique(np.frombuffer(text.encode("utf-8"), np.uint8), return_counts=True)
    p = n / n.sum()
    return float(-(p * np.log2(p)).sum())


def endings(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and its last two."""
    labels = F.split(host, r"\.")
    return F.element_at(labels, -1), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def lexical(url: str, host: str, path: str, top_rate: float, ending_rate: float) -> list[float]:
    """The features of one URL, in the order of FEATURES."""
    labels = host.split(".")
    front, _, fragment = url.partition("#")
    params = front.partition("?")[2]
    letters = sum(c.isalpha() for c in host)
    return [
        len(url), len(host), len(path), path.rstrip("/").count("/"), len(labels), max(map(len, labels)), sum(c.isdigit() for c in url) / max(1, len(url)),
        sum(c.isdigit() for c in host), host.count("-"), path.count("-") + path.count("_"), params.count("=") if params else 0, len(params), len(fragment),
        entropy(url), entropy(host), sum(c in "aeiou" for c in host) / max(1, letters), sum(c.isupper() for c in url) / max(1, len(url)), url.count("%"),
        top_rate, ending_rate,
    ]


def features(rows: list[tuple[str, str, str, float, float]]) -> np.ndarray:
    return np.array([lexical(*r) for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))


def weak_labels(urls: DataFrame, words: tuple[str, ...] = BAD_WORDS) -> DataFrame:
    """(url, bad) for every URL with a host: bad if a word of the host is listed."""
    host, _ = parts(F.col("url"))
    bad = F.arrays_overlap(F.split(host, "[^a-z0-9]+"), F.array(*map(F.lit, words)))
    return urls.select("url", bad.alias("bad")).where(host != "")


class Filter:
    """Trained trees with the rates of host endings."""

    def __init__(self, labelled: DataFrame, sample: int = 20_000, smooth: float = 20.0):
        known = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull())
        host, path = parts(F.col("url"))
        known = known.select("url", F.col("bad").cast("boolean").cast("int").alias("bad"), host.alias("host"), path.alias("path"))
        known = store(known, "labelled")
        total = known.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first()
        self.rate = ((total["bad"] or 0) + 0.5) / (total["n"] + 1.0)
        ends = known.select("bad", F.explode(F.array_distinct(F.array(*endings(F.col("host"))))).alias("ending"))
        ends = ends.groupBy("ending").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
        self.smooth, self.ends = smooth, store(ends, "endings")
        order = F.shiftrightunsigned(F.xxhash64("url"), 11)
        rows = self.rated(sampled(known, "url", sample), own="bad").orderBy(order, *known.columns).collect()
        table = features([tuple(r[c] for c in ("url", "host", "path", "top_rate", "ending_rate")) for r in rows])
        self.forest = trees.fit(table, np.array([r["bad"] for r in rows], dtype=bool))

    def rated(self, urls: DataFrame, own: str | None = None) -> DataFrame:
        """Add ``top_rate`` and ``ending_rate``, the rates of the endings of the column ``host``. A frequent ending is
        left to Spark's skew join. ``own`` names the label of rows that were counted themselves: they are left out of
        their own rates, else a rare ending would tell its row's label."""
        top, ending = endings(F.col("host"))
        counts = lambda name: [F.col("ending").alias(f"_{name}"), F.col("n").alias(f"_{name}_n"), F.col("bad").alias(f"_{name}_bad")]
        tops = self.ends.where(~F.contains("ending", F.lit("."))).select(*counts("top"))
        both = urls.join(tops, top == F.col("_top"), "left").join(self.ends.select(*counts("ending")), ending == F.col("_ending"), "left")
        out, one, mine = dict(), (1 if own else 0), (F.col(own) if own else F.lit(0))
        for name in ("top", "ending"):
            rate = F.try_divide(F.col(f"_{name}_bad") - mine + F.lit(self.smooth * self.rate), F.col(f"_{name}_n") - one + F.lit(self.smooth))
            out[f"{name}_rate"] = F.coalesce(rate, F.lit(self.rate))
        return both.withColumns(out).select(*urls.columns, *out)


def _scores(forest: trees.Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path", "top_rate", "ending_rate"))))
            score = forest.probability(features([(u or "", *more) for u, *more in rows]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "rule")), pa.array(score)], ["page_id", "host", "path", "rule", "score"])

    return run


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] = RULES, threshold: float = 0.5, **how) -> DataFrame:
    """page_id, host, path, rule, verdict, and score, the trees' probability that the URL is bad. ``how`` goes to Filter."""
    small_batches(pages.sparkSession)
    urls = pages.select("page_id", "url")
    trained = Filter(labelled if labelled is not None else weak_labels(urls), **how)
    host, path = parts(F.col("url"))
    split = urls.withColumns({"host": host, "path": path}).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    kind = pages.schema["page_id"].dataType.simpleString()
    scored = trained.rated(split).mapInArrow(_scores(trained.forest), f"page_id {kind}, host string, path string, rule string, score double")
    verdict = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, what).otherwise(verdict)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


@query("op3_url_filters")
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir, "pages"))
