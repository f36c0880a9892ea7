"""URL filter: host and path rules, and character Markov models for what no rule decides.

DataFrame functions only. URLs that a rule accepts or rejects train two character models of
variable order: each order from none to ``ORDER`` characters of context is interpolated with the
next lower one by Witten-Bell weights, down to a uniform distribution. As counts of lower orders are
sums of those of higher ones, only the distinct (context, character) strings of all URLs are
worked on, however many URLs there are. A URL's score is the difference of its two
log-likelihoods by its length; the cut between accepted and rejected is calibrated on a
fifth of the ruled URLs that the models haven't seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import Scratch, bounded, pack, replace_columns

#: (rule, verdict); a rule is a host, with all its subdomains, and the beginning of a path.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
ORDER = 4
#: Size of the alphabet of the uniform distribution below the models.
ALPHABET = 256
HOLDOUT = 5
#: Scores are cut in steps of this size.
STEP = 0.02
MADE = ["host", "path", "rule", "verdict", "score"]
_PAD, _END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case and path; both empty for NULL and without ``://``."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(F.concat(url, F.lit("")), "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def longest_rule(rules: tuple[tuple[str, str], ...], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct (rule, verdict); NULL if none does."""
    found = F.lit(None).cast("struct<rule:string, verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        fits = fits & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(texts: DataFrame, *keep: str) -> DataFrame:
    """Each character of ``s`` and its end as ``g``: ORDER characters of context and itself."""
    padded = F.concat(F.lit(_PAD * ORDER), F.col("s"), F.lit(_END))
    places = texts.select(*keep, padded.alias("p"), F.explode(F.sequence(F.lit(1), F.length("s") + 1)).alias("i"))
    return places.select(*keep, F.col("p").substr(F.col("i"), F.lit(ORDER + 1)).alias("g"))


def _gram_scores(trained: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (g) with ``d``: log p(accepted) - log p(rejected) of its last character."""
    full = _grams(trained, "good").groupBy("g").agg(
        F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("r")
    )
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k")
    grams = (
        full.select("a", "r", "g", orders)
        .groupBy(F.expr(f"substring(g, {ORDER} - k + 1, k + 1)").alias("gram"))
        .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    )
    contexts = grams.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context")).agg(
        F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr")
    )
    asked = wanted.select("g", orders)
    asked = asked.withColumn("_gram", F.expr(f"substring(g, {ORDER} - k + 1, k + 1)"))
    asked = asked.withColumn("_context", F.expr(f"substring(g, {ORDER} - k + 1, k)"))
    told = asked.join(bounded(grams), F.col("_gram") == F.col("gram"), "left").join(
        bounded(contexts), F.col("_context") == F.col("context"), "left"
    )
    steps = told.groupBy("g").agg(
        F.sort_array(
            F.collect_list(
                F.struct("k", *[F.coalesce(F.col(x), F.lit(0)).cast("double").alias(x) for x in ("a", "na", "ta", "r", "nr", "tr")])
            )
        ).alias("steps")
    )

    def chance(c: str, n: str, t: str) -> str:
        return (
            f"aggregate(steps, 1D / {ALPHABET}, (p, x) -> "
            f"if(x.{n} > 0, (x.{c} + x.{t} * p) / (x.{n} + x.{t}), p))"
        )

    return steps.select("g", F.expr(f"ln({chance('a', 'na', 'ta')}) - ln({chance('r', 'nr', 'tr')})").alias("d"))


def _threshold(held: DataFrame) -> float | None:
    """The score from which on URLs are accepted: most held-out URLs on their right side.

    Accepted and rejected ones weigh the same altogether. The cut lies in the middle of the gap
    between the scores it parts; of equal cuts the lowest is taken.
    """
    step = F.floor(F.col("score") / STEP)
    bins = held.groupBy(F.greatest(F.least(step, F.lit(1000)), F.lit(-1000)).alias("bin")).agg(
        F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("r")
    )
    # at most 2001 rows
    order = Window.orderBy("bin")
    below, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    passed = F.sum("a").over(whole) - F.coalesce(F.sum("a").over(below), F.lit(0))
    stopped = F.coalesce(F.sum("r").over(below), F.lit(0))
    sides = passed / F.greatest(F.sum("a").over(whole), F.lit(1)) + stopped / F.greatest(F.sum("r").over(whole), F.lit(1))
    gap = F.coalesce(F.lag("bin").over(order) + 1, F.col("bin"))
    best = bins.select("bin", gap.alias("gap"), F.round(sides, 9).alias("right")).orderBy(F.desc("right"), "bin").first()
    return None if best is None else (best["bin"] + best["gap"]) / 2 * STEP


def filter_urls(
    pages: DataFrame,
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    carry: list[str] | None = None,
) -> DataFrame:
    """``pages`` with host, path, rule (NULL if none fits), verdict (allow, block) and score.

    A URL without host and path (NULL, empty, no ``://``) has no score and is blocked. If the rules
    accept nothing or reject nothing, there is nothing to tell apart: what no rule decides is allowed.
    Repeated rows and URLs each give a row. Columns named like a result column are
    replaced. Only the columns of ``carry`` (all by default) are written and returned.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col(f"`{url_col}`"))
    parsed = pages.select(
        pack(pages.select(*[f"`{x}`" for x in carry]) if carry else pages), host.alias("host"), path.alias("path")
    )
    found = parsed.withColumn("_rule", longest_rule(rules, F.col("host"), F.col("path")))
    table = scratch.save(
        found.select("_row", "host", "path", "_rule.rule", F.col("_rule.verdict").alias("_ruled"))
        .withColumn("s", F.concat("host", "path"))
        .withColumn("_at", F.monotonically_increasing_id()),
        "parsed",
    )
    ruled = table.where("_ruled IS NOT NULL").select("_at", "s", (F.col("_ruled") == "allow").alias("good"))
    held_out = F.pmod(F.xxhash64("s"), F.lit(HOLDOUT)) == 0
    classes = ruled.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()
    allowed = table.withColumn("score", F.lit(None).cast("double")).withColumn(
        "verdict", F.coalesce("_ruled", F.when(F.col("s") == "", "block").otherwise("allow"))
    )
    if len(classes) < 2:
        return replace_columns(allowed, "_row", MADE)

    trained = ruled.where(~held_out)
    asked = table.where("s <> '' AND _ruled IS NULL").select("_at", "s", F.lit(None).cast("boolean").alias("good"))
    asked = asked.unionByName(ruled.where(held_out))
    places = _grams(asked, "_at", "good")
    scores = scratch.save(_gram_scores(trained, places.select("g").distinct()), "grams")
    each = places.groupBy("_at", "good", "g").count().join(bounded(scores), "g")
    judged = scratch.save(
        each.groupBy("_at", "good").agg((F.sum(F.col("d") * F.col("count")) / F.sum("count")).alias("score")), "scores"
    )
    cut = _threshold(judged.where("good IS NOT NULL"))
    if cut is None:
        cut = 0.0
    own = judged.where("good IS NULL").select(F.col("_at").alias("_id"), "score")
    joined = table.join(own, F.col("_at") == F.col("_id"), "left")
    verdict = F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block")
    return replace_columns(joined.withColumn("verdict", F.coalesce("_ruled", verdict)), "_row", MADE)
