"""URL filters: rules first, then gradient-boosted trees on lexical features. Built-in functions and Spark ML only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import pinned

#: Fixed values: (verdict, host, path) as given.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labelled URLs that the trees are fitted on; a hash of the URL draws them, so the draw does not depend on partitions.
TRAIN_ROWS = 20_000
TREES = 12
DEPTH = 4
#: Weight of the overall block rate in the block rate of a suffix.
PRIOR_WEIGHT = 20.0
#: Suffixes whose statistics are joined by broadcast; more are joined by shuffle.
SUFFIX_BROADCAST = 50_000
FEATURES = [
    "length", "host_length", "path_length", "depth", "digits", "digit_share", "entropy", "parameters", "query_length",
    "host_labels", "hyphens", "upper_share", "punctuation", "secure", "fragment", "dotted_file", "number_tail",
    "longest_segment", "segment_1_length", "suffix_rate", "suffix_seen",
]


def host_and_path(url: str) -> tuple[F.Column, F.Column]:
    """Host: behind the first :// up to / ? # or the end, A-Z in lower case; path: from there up to ? # or the end."""
    at = F.expr(f"instr({url}, '://')")
    rest = F.expr(f"substr({url}, instr({url}, '://') + 3)")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    known = F.coalesce(at > 0, F.lit(False))
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: str, path: str, rules: tuple = RULES) -> F.Column:
    """The longest fitting rule as (rule, verdict), NULL when none fits; a rule fits its host and all subdomains."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fit = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(p)
        fits = F.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def _entropy(text: str) -> str:
    """Bits per character: lengths without each distinct character give the counts."""
    share = f"((length({text}) - length(replace({text}, c, ''))) / length({text}))"
    return f"""coalesce(aggregate(filter(array_distinct(split({text}, '')), c -> c <> ''), 0.0D,
        (a, c) -> a - {share} * log2({share})), 0.0D)"""


def with_features(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Adds the lexical features that need nothing but the URL itself."""
    u = f"coalesce({url}, '')"
    text = {
        "length": f"length({u})",
        "host_length": f"length({host})",
        "path_length": f"length({path})",
        "depth": f"length({path}) - length(replace({path}, '/', ''))",
        "digits": f"length({u}) - length(regexp_replace({u}, '[0-9]', ''))",
        "digit_share": f"(length({u}) - length(regexp_replace({u}, '[0-9]', ''))) / greatest(length({u}), 1)",
        "entropy": _entropy(u),
        "parameters": f"CASE WHEN instr({u}, '?') = 0 THEN 0 ELSE 1 + length({u}) - length(replace({u}, '&', '')) END",
        "query_length": f"length(regexp_extract({u}, '[?]([^#]*)', 1))",
        "host_labels": f"length({host}) - length(replace({host}, '.', ''))",
        "hyphens": f"length({u}) - length(replace({u}, '-', ''))",
        "upper_share": f"(length({u}) - length(regexp_replace({u}, '[A-Z]', ''))) / greatest(length({u}), 1)",
        "punctuation": f"length(regexp_replace({u}, '[A-Za-z0-9]', ''))",
        "secure": f"int({u} LIKE 'https:%')",
        "fragment": f"int(instr({u}, '#') > 0)",
        "dotted_file": rf"int({path} rlike '[.][A-Za-z0-9]+$')",
        "number_tail": rf"int({path} rlike '[0-9]+/?$')",
        "longest_segment": f"array_max(transform(split({path}, '/'), s -> length(s)))",
        "segment_1_length": f"length(regexp_extract({path}, '^/([^/]*)', 1))",
    }
    df = df.withColumns({name: F.expr(f"cast({sql} as double)") for name, sql in text.items()})
    return df.withColumn("suffix", F.element_at(F.split(F.col(host), r"\."), -1))


def suffix_statistics(labelled: DataFrame, prior: float) -> DataFrame:
    """Per suffix of the labelled URLs: how many there are and their block rate, smoothed towards `prior`."""
    rate = (F.sum("label") + PRIOR_WEIGHT * prior) / (F.count("*") + PRIOR_WEIGHT)
    return labelled.groupBy("suffix").agg(
        rate.alias("suffix_rate"), F.log1p(F.count("*").cast("double")).alias("suffix_seen")
    )


def _with_suffixes(df: DataFrame, statistics: DataFrame, few: bool, prior: float) -> DataFrame:
    side = F.broadcast(statistics) if few else statistics
    out = df.join(side, "suffix", "left")
    return out.fillna({"suffix_rate": prior, "suffix_seen": 0.0})


def judge_urls(df: DataFrame, id: str = "page_id", url: str = "url", rules: tuple = RULES, seed: int = 7) -> DataFrame:
    """Per row of `df`: `id`, host, path, rule (NULL where none fits), verdict, score.

    The rows that a rule judges are the labelled URLs: trees are fitted on at most TRAIN_ROWS distinct ones of them, half of
    either verdict, weighted by their rows (suffix counts are of all rows), and judge the rest: block when the score, the chance of block, is over 0.5. Where the rules label nothing
    or give one verdict only, that verdict (allow without any) holds for all. A null URL, or one without ://, has empty
    host and path and is judged by the trees. Null ids stay, repeated rows each give a row, an empty table gives none;
    other columns are not read.
    """
    host, path = host_and_path("_url")
    rows = df.select(F.col(id).alias("_id"), F.col(url).alias("_url"))
    rows = rows.withColumns({"_host": host, "_path": path}).withColumn("_rule", rule_of("_host", "_path", rules))
    rows = with_features(rows, "_url", "_host", "_path")
    labelled = rows.where(F.col("_rule").isNotNull()).withColumn("label", (F.col("_rule.verdict") == "block").cast("double"))
    seen = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked"), F.approx_count_distinct("suffix").alias("s")).first()
    n, blocked = seen["n"], seen["blocked"] or 0.0
    if blocked in (0.0, float(n)):
        verdict, score = ("block", 1.0) if n and blocked else ("allow", 0.0)
        return _verdicts(rows.withColumn("_score", F.lit(score)), id, F.lit(verdict))
    few = seen["s"] <= SUFFIX_BROADCAST // 2
    statistics = suffix_statistics(labelled, blocked / n)
    # One row for every distinct URL, with the number of its rows: however often a URL stands there, it is drawn once.
    distinct = labelled.groupBy(*[c for c in labelled.columns if c not in ("_id", "_rule")]).agg(F.count("*").cast("double").alias("weight"))
    order = F.xxhash64("_url", F.lit(seed))
    drawn = [distinct.where(F.col("label") == v).orderBy(order, "_url").limit(TRAIN_ROWS // 2) for v in (0.0, 1.0)]
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = _with_suffixes(drawn[0].unionByName(drawn[1]), statistics, few, blocked / n)
    # Fitting passes over its rows many times: the draw, of bounded size, is written to the shared folder once.
    model = fit_trees(pinned(assembler.transform(train).select("features", "label", "weight")), seed)
    scored = assembler.transform(_with_suffixes(rows, statistics, few, blocked / n))
    scored = model.transform(scored).withColumn("_score", vector_to_array("probability")[1])
    return _verdicts(scored, id, F.when(F.col("_score") > 0.5, "block").otherwise("allow"))


def fit_trees(train: DataFrame, seed: int) -> GBTClassificationModel:
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, stepSize=0.2, maxBins=32, weightCol="weight").fit(train)


def _verdicts(rows: DataFrame, id: str, judged: F.Column) -> DataFrame:
    return rows.select(
        F.col("_id").alias(id),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), judged).alias("verdict"),
        F.col("_score").alias("score"),
    )
