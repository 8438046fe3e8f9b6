"""URL filter: fixed rules first, else a tree of path templates judged by smoothed labelled purity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import stage
from forumlens.operators.skew import look_up

# Rule (host and path) and verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Labelled urls from which a segment is compared with its siblings.
MIN_LABELS = 5
#: Chance that any of a branch's segments is kept apart though all of them are alike.
ERROR = 0.05
#: Labels that the corpus-wide share of good ones counts for in a template's purity.
PRIOR = 10
MIN_PURITY = 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits a host, or a domain above it, and the beginning of the path."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


SUMS = ("urls", "good", "labelled")


def _split(live: DataFrame) -> DataFrame:
    """The segments that are told apart in their branch: (child, own), own being the segment's place in the template.

    `live` has branch, part, the sums of its own rows and the branch's as all_*. A segment of MIN_LABELS labels or more
    is compared with all its siblings together, and differs if chance would not set any of the branch's tested segments
    as far apart, but for ERROR. Those that differ alike, to the same side and with the same tenth of good labels, are
    merged: `{-0}` stands for all that are worse and have less than a tenth of good labels. One alone of its kind stays
    as it is. Siblings are compared through sums, so no pairs are formed.
    """
    children = live.groupBy("branch", "part").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.first(f"all_{c}").alias(f"all_{c}") for c in ("good", "labelled")]
    )
    others = F.col("all_labelled") - F.col("labelled")
    tested = stage(children.where((F.col("labelled") >= MIN_LABELS) & (others > 0)))
    tests = tested.groupBy("branch").agg(F.count(F.lit(1)).alias("tests"))
    pooled = F.col("all_good") / F.col("all_labelled")
    share = F.col("good") / F.col("labelled")
    gap = share - (F.col("all_good") - F.col("good")) / others
    variance = pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / others)
    # For a normal variable, P(|z| > c) is at most exp(-c * c / 2).
    differs = gap * gap > 2 * F.log(F.col("tests") / ERROR) * variance
    kind = F.concat(F.when(gap > 0, "+").otherwise("-"), F.least(F.floor(share * 10), F.lit(9)).cast("string"))
    apart = stage(look_up(tested, tests, "branch").where(differs).select("branch", "part", kind.alias("kind")))
    alike = apart.select(F.struct("branch", "kind").alias("group"), "branch", "part", "kind")
    sizes = alike.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") > 1, F.concat(F.lit("{"), F.col("kind"), F.lit("}"))).otherwise(F.col("part"))
    return look_up(alike, sizes, "group").select(F.struct("branch", "part").alias("child"), own.alias("own"))


def _grow(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Add the next segment to the templates of rows that have one: rows that are done, and rows to go on with.

    A branch without labels of both kinds, or with MIN_LABELS at most, cannot be split any more: what is left of its
    paths becomes wildcards at once, so only branches that labels speak about are grown to the end of their paths.
    """
    columns = rows.columns
    here = rows.select("*", F.struct("host", "template").alias("branch"), F.get("parts", F.lit(level)).alias("part"))
    sums = here.groupBy("branch").agg(*[F.sum(c).alias(f"all_{c}") for c in SUMS])
    known = stage(look_up(here, sums, "branch"))
    mixed = (F.col("all_good") > 0) & (F.col("all_good") < F.col("all_labelled")) & (F.col("all_labelled") > MIN_LABELS)
    rest = F.concat("template", F.repeat(F.lit("/*"), F.size("parts") - level))
    closed = known.where(~mixed).withColumn("template", rest).select(columns)
    live = known.where(mixed).withColumn("child", F.struct("branch", "part"))
    named = look_up(live, _split(live), "child", "left")
    template = F.concat("template", F.lit("/"), F.coalesce("own", F.lit("*")))
    grown = stage(named.withColumn("template", template).select(columns))
    more = F.size("parts") > level + 1
    return closed.unionByName(grown.where(~more)), grown.where(more)


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity.

    `pages` has page_id and url, `labels` has page_id and good (0 or 1); a page labelled twice counts twice,
    labels with nulls count for nothing. Where a rule fits, the longest one decides. Else the template does:
    per host, path segments are kept, merged with like ones or generalised level by level, to the end of the paths,
    and a template is rejected if its share of good labels, smoothed by the corpus-wide share, is below a half. A null url or one without :// has an empty
    host and path and the template of the empty path. Rows that repeat are judged alike; other columns are
    ignored; an empty table gives an empty result; without labels everything no rule blocks is allowed.

    Urls are first summed by host and path, so a hot host costs one row per different path, and every level is
    a grouped sum taken in map tasks first. Joins on hosts, branches and paths split hot keys.
    """
    placed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    placed = stage(placed)
    marks = (
        labels.where("page_id IS NOT NULL AND good IS NOT NULL")
        .groupBy(F.col("page_id").cast("long").alias("page_id"))
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.count("*").alias("labelled"))
    )
    paths = (
        placed.join(marks, "page_id", "left")
        .groupBy("host", "path")
        .agg(
            F.count("*").alias("urls"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"),
        )
    )
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    tree = paths.withColumn("parts", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts))
    tree = stage(tree.withColumn("template", F.lit("")))
    done, rows, level = tree.where(F.size("parts") == 0), tree.where(F.size("parts") > 0), 0
    while not rows.isEmpty():
        finished, rows = _grow(rows, level)
        done, level = done.unionByName(finished), level + 1
    done = stage(done.select("host", "path", "good", "labelled", F.struct("host", "template").alias("branch")))
    total = done.agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled")).first()
    share = (total.good / total.labelled) if total.labelled else 1.0
    purity = (F.sum("good") + F.lit(PRIOR * float(share))) / (F.sum("labelled") + PRIOR)
    pure = done.groupBy("branch").agg(F.round(purity, 9).alias("purity"))
    templates = look_up(done, pure, "branch").select(
        F.struct("host", "path").alias("place"), F.col("branch.template").alias("template"), "purity"
    )
    judged = look_up(placed.withColumn("place", F.struct("host", "path")), templates, "place").withColumn(
        "rule", matching_rule(F.col("host"), F.col("path"), rules)
    )
    learned = F.when(F.col("purity") < MIN_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    verdict = reduce(lambda out, r: F.when(F.col("rule") == r[0], F.lit(r[1])).otherwise(out), rules, learned)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
