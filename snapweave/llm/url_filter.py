"""URL filter: allow and block rules first, gradient-boosted trees for the rest.

Rules name a host (with all its subdomains) and a path prefix; the longest rule
that fits decides. URLs that a rule decides are the labelled ones: Spark ML trains
gradient-boosted trees on their lexical features (lengths, depth, digit ratio,
character entropy, parameter counts, and suffix statistics), and the trees judge
the URLs that no rule fits. Everything is DataFrame functions; no Python runs on the
executors.

Suffix statistics are block rates of the labelled URLs by top-level domain, host
suffix of two labels, first path segment and file suffix, each hashed to
``STAT_BUCKETS`` buckets and drawn towards the overall rate.

The trees see at most ``SAMPLE_ROWS`` labelled URLs (smallest hashes, repeated URLs
once); the statistics see all.

Defined results: a null URL or one without ``://`` has empty host and path and is
judged by the trees like any other; if no URL or only one class is labelled, the
method's verdict is that class, or allow.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SAMPLE_ROWS = 20_000
STAT_BUCKETS = 4096
PRIOR_ROWS = 20.0
TREES, DEPTH, SEED = 15, 4, 17

FEATURES = ["f_url", "f_host", "f_path", "f_query", "f_depth", "f_labels", "f_digits", "f_hyphens", "f_entropy",
            "f_params", "f_secure", "f_fragment"]
STATS = {"s_tld": "k_tld", "s_domain": "k_domain", "s_segment": "k_segment", "s_file": "k_file"}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def fits(host: Column, path: Column, rule: str) -> Column:
    """Whether ``rule`` (host, then path from its first slash) fits."""
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & F.startswith(path, F.lit(slash + rest))


def ruled(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    return F.coalesce(*[F.when(fits(host, path, r), F.lit(r)) for r in ordered], F.lit(None).cast("string"))


def _entropy(text: Column) -> Column:
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), F.lit(0.0),
                                     lambda a, c: a - share(c) * F.log2(share(c)))).otherwise(0.0)


def lexical(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds the lexical features and the suffix keys."""
    u, h, p = F.coalesce(F.col(url), F.lit("")), F.col(host), F.col(path)
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    n = F.length(u)
    count = lambda x, pattern: F.regexp_count(x, F.lit(pattern)).cast("double")
    key = lambda kind, x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(STAT_BUCKETS)).cast("int")
    return df.withColumns({
        "f_url": n.cast("double"), "f_host": F.length(h).cast("double"), "f_path": F.length(p).cast("double"),
        "f_query": F.length(query).cast("double"), "f_depth": count(p, "/+[^/]"), "f_labels": count(h, r"\."),
        "f_digits": F.when(n > 0, count(u, "[0-9]") / n).otherwise(0.0), "f_hyphens": count(h, "-"),
        "f_entropy": _entropy(F.concat(h, p)), "f_params": count(query, "[^&=]+=?[^&]*"),
        "f_secure": u.startswith("https://").cast("double"), "f_fragment": F.contains(u, F.lit("#")).cast("double"),
        "k_tld": key("tld", F.substring_index(h, ".", -1)), "k_domain": key("domain", F.substring_index(h, ".", -2)),
        "k_segment": key("segment", F.regexp_extract(p, "^/([^/]*)", 1)),
        "k_file": key("file", F.regexp_extract(p, r"(\.[A-Za-z0-9]+)$", 1)),
    })


def judge(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: key, url, host, path, rule, verdict and block_probability (null where a rule decides)."""
    host, path = host_and_path(F.col("url"))
    base = (pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
            .withColumns({"host": host, "path": path}))
    base = base.withColumn("rule", ruled(F.col("host"), F.col("path"), rules))
    base = lexical(base)
    blocks = F.col("rule").isin([r for r, v in rules.items() if v == BLOCK])
    labelled = base.filter("rule is not null").withColumn("label", blocks.cast("double"))
    totals = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("b")).first()
    n, b = totals["n"], totals["b"] or 0.0
    decided = F.when(F.col("rule").isNull(), None).when(blocks, BLOCK).otherwise(ALLOW)
    if not 0 < b < n:
        verdict = BLOCK if n and b == n else ALLOW
        return base.select("key", "url", "host", "path", "rule", F.coalesce(decided, F.lit(verdict)).alias("verdict"),
                           F.when(F.col("rule").isNull(), F.lit(float(verdict == BLOCK))).alias("block_probability"))
    rate = b / n
    stats = (labelled.select("label", F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(k).alias("bucket")) for s, k in STATS.items()])).alias("x"))
        .groupBy("x.stat", "x.bucket").agg(
            ((F.sum("label") + PRIOR_ROWS * rate) / (F.count("*") + PRIOR_ROWS)).alias("rate")))

    def with_stats(df: DataFrame) -> DataFrame:
        for s, k in STATS.items():  # STAT_BUCKETS rows each at most
            side = stats.filter(F.col("stat") == s).select(F.col("bucket").alias(k), F.col("rate").alias(s))
            df = df.join(F.broadcast(side), k, "left").fillna({s: rate})
        return df

    assembler = VectorAssembler(inputCols=FEATURES + list(STATS), outputCol="features")
    sample = labelled.dropDuplicates(["url"]).orderBy(F.xxhash64("url"), "url").limit(sample_rows)
    train = assembler.transform(with_stats(sample)).select("features", "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3, maxBins=64,
                          subsamplingRate=1.0).fit(train)
    scored = model.transform(assembler.transform(with_stats(base)))
    p = vector_to_array("probability")[1]
    return scored.select("key", "url", "host", "path", "rule", F.coalesce(
        decided, F.when(p >= 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.when(F.col("rule").isNull(), p).alias("block_probability"))

