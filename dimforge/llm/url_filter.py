"""URL filter: rules, and gradient-boosted trees on lexical features for what no rule covers.

The trees learn from the URLs that a rule judges. All features are SQL expressions of the URL,
and statistics of its suffixes over the labelled URLs, joined in; nothing runs in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.tables import materialized

MAX_TRAIN_URLS = 50_000  # labelled URLs that the trees are grown on at most (a hash sample; suffix statistics cover all)
MAX_RULES = 1_000  # rules are a part of the plan
TREES, DEPTH, STEP, SEED = 20, 5, 0.3, 7
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


@dataclass(frozen=True)
class Rule:
    """``action`` (allow or block) for ``pattern``: a host, then a path from its slash on, like ``example.com/en/``."""

    action: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host):]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: then up to ?, # or the end. Else both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def matched(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(pattern, action) of the longest rule that fits, NULL if none. A rule fits its host and all subdomains, and paths that start with its own."""
    if len(rules) > MAX_RULES or any(r.action not in ("allow", "block") for r in rules):
        raise ValueError(f"at most {MAX_RULES} rules, each allow or block")
    pattern, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        pattern, action = F.when(fits, F.lit(r.pattern)).otherwise(pattern), F.when(fits, F.lit(r.action)).otherwise(action)
    return pattern, action


def _count(text: Column, piece: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda s, c: s + F.when(share(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    n = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    return {
        "f_length": F.length(url), "f_host_length": F.length(host), "f_path_length": F.length(path), "f_depth": _count(path, "/"),
        "f_labels": _count(host, "."), "f_hyphens": _count(url, "-"), "f_digit_ratio": (F.length(url) - F.length(F.translate(url, _DIGITS, ""))) / n,
        "f_entropy": _entropy(url), "f_parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0), "f_values": _count(query, "="),
        "f_fragment": F.instr(url, "#") > 0, "f_secure": url.startswith("https"), "f_slash_end": path.endswith("/"), "f_extension": path.rlike("\\.[A-Za-z0-9]{1,5}$"),
    }


def _sampled(urls: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct URLs of each label, the same however they are dealt: a hash sample of about twice as many, cut in hash order."""
    draw, out = F.pmod(F.xxhash64("url"), F.lit(1 << 30)), None
    for label, n in sorted((r.label, r.n) for r in urls.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()):
        own = urls.where(F.col("label") == label)
        if n > most:
            own = own.where(draw < int(min(1.0, max(2 * most, 1000) / n) * (1 << 30))).orderBy(draw, "url").limit(most)
        out = own if out is None else out.union(own)
    return out


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", max_train_urls: int = MAX_TRAIN_URLS) -> DataFrame:
    """One row per input row: id, host, path, rule (its pattern, else NULL), verdict (the rule's, else the trees').

    The trees learn from the URLs under a rule. Suffix statistics are the smoothed share of blocked URLs among those, for
    the host's last label and for it with the first path segment. Every URL is learned twice, once without them, so that the
    trees can tell suffixes that no rule covers by the other features; both kinds weigh the same, an URL as its rows. The trees are
    fitted on at most ``max_train_urls`` distinct URLs, half of either kind; statistics count all rows. Without labelled URLs of both kinds, the one kind there is
    (or allow) is the verdict. NULL and malformed URLs have an empty host and path, and a verdict like others; repeated rows
    are judged each, equal URLs alike; an empty table gives an empty one; other columns are ignored.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", "url", host.alias("host"), path.alias("path"))
    pattern, action = matched(rules, F.col("host"), F.col("path"))
    tld = F.regexp_extract("host", "[^.]*$", 0)
    rows = rows.select("*", pattern.alias("rule"), action.alias("action"), tld.alias("tld"), F.concat(tld, F.lit("/"), F.regexp_extract("path", "^/([^/]*)", 1)).alias("section"))
    labelled = rows.where("action IS NOT NULL").withColumn("label", (F.col("action") == "block").cast("double"))
    kinds = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        only = "block" if kinds and 1.0 in kinds else "allow"
        return rows.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit(only)).alias("verdict"))

    unknown = {f"f_{k}{x}": v for k in ("tld", "section") for x, v in (("", 0.5), ("_n", 0.0))}
    stats = {k: labelled.groupBy(k).agg(((F.sum("label") + 0.5) / (F.count(F.lit(1)) + 1.0)).alias(f"f_{k}"), F.log1p(F.count(F.lit(1)).cast("double")).alias(f"f_{k}_n")) for k in ("tld", "section")}
    lexical = lexical_features(F.col("url"), F.col("host"), F.col("path"))

    def featured(df: DataFrame) -> DataFrame:
        for k, s in stats.items():
            df = df.join(s, k, "left")
        return df.fillna(unknown).withColumns({k: v.cast("double") for k, v in lexical.items()})

    names = [*lexical, *unknown]
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    total = sum(kinds.values())
    distinct = materialized(labelled.groupBy("url", "host", "path", "tld", "section", "label").agg(F.count(F.lit(1)).alias("copies")), "url-labelled")
    sample = featured(_sampled(distinct, max(max_train_urls // 2, 1)))
    sample = sample.select(*names, "label", (F.col("copies") * F.when(F.col("label") == 1.0, total / kinds[1.0]).otherwise(total / kinds[0.0])).alias("weight"))
    sample = materialized(sample.union(sample.withColumns({k: F.lit(v) for k, v in unknown.items()})), "url-train").persist()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=64, seed=SEED, weightCol="weight").fit(vectors.transform(sample))
    sample.unpersist()
    out = model.transform(vectors.transform(featured(rows)))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.when(F.col("prediction") == 1.0, "block").otherwise("allow")).alias("verdict"))
