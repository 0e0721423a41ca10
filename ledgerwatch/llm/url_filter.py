"""URL filter: host and path rules, and a character language-model ratio.

Two smoothed variable-order Markov models are counted from the URLs that the rules
accept and reject. A URL's score is the mean, per character, of the difference of the
two log-likelihoods. The cutoff is calibrated on held-out accepted URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small, staged

#: The models' alphabet is Unicode: place in this string is the code. Code 0 stands for
#: what comes before the first character. Digits 1-9 count as 0.
ALPHABET = "".join(map(chr, range(0x110000)))
SYMBOLS = len(ALPHABET)
#: Longest context is ORDER - 1 characters. A model has an entry for each gram that the
#: URLs have, so it grows with them.
ORDER = 6
#: Scores and log ratios are whole micro-units: sums do not depend on row order.
UNIT = 1_000_000
#: One URL in this many is held out for calibration, by a hash of the URL.
FOLDS = 5
#: At most this share of held-out accepted URLs may fall below the cutoff.
FALSE_REJECTS = 0.01

AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, AFTER, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct ``action``, ``rule``; null if none fits.

    ``rules`` are ``(action, host, path)``; a rule fits its host and all subdomains
    where the path starts with the rule's.
    """
    out = F.lit(None).cast("struct<action:string,rule:string>")
    for action, rule_host, rule_path in sorted(
            rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(rule_path))
        out = F.when(fits, F.struct(F.lit(action).alias("action"),
                                    F.lit(rule_host + rule_path).alias("rule"))).otherwise(out)
    return out


def grams(urls: DataFrame, key: str = "url") -> DataFrame:
    """One row for each character: the columns but ``key``, and ``gram``, the character
    and the ORDER - 1 before it."""
    plain = ascii_lower(F.regexp_replace(F.col(key), r"(?s)^.*?://", ""))
    plain = F.translate(plain, "123456789", "0" * 9)
    chars = F.filter(F.split(plain, ""), lambda c: c != "")
    padded = F.concat(F.array_repeat(F.lit("\0"), ORDER - 1), chars)
    kept = [c for c in urls.columns if c != key]
    coded = urls.select(*kept, padded.alias("__lw_chars"))
    last = F.size("__lw_chars") - ORDER
    placed = coded.filter(last >= 0).withColumn(
        "__lw_at", F.explode(F.sequence(F.lit(0), last)))
    return placed.select(*kept, F.concat(
        *[F.get("__lw_chars", F.col("__lw_at") + k) for k in range(ORDER)]).alias("gram"))


def ratio_model(labelled: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram``, ``ratio``: micro-units of log P(accepted) - log P(rejected) of the
    last character of each of the distinct grams of ``wanted``.

    ``labelled`` has ``gram``, ``accepted`` and ``n``. Contexts of every length are
    mixed: P_k = (count + types * P_(k-1)) / (total + types), where ``types`` is the
    number of different characters seen after the context, so an unseen context falls
    back to the shorter one. Both models start from a uniform distribution. Every length
    has its own tables of counts, which are joined; only those of contexts under two
    characters, which have at most one row for each character, are broadcast.
    """
    top = staged(labelled.groupBy("gram").agg(
        F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("no")), "grams")
    model = None
    for k in range(1, ORDER + 1):
        tail = F.substring("gram", ORDER - k + 1, k)
        counts = top if k == ORDER else (
            top.groupBy(tail.alias("gram"))
            .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
        totals = counts.groupBy(F.substring("gram", 1, k - 1).alias("before")).agg(
            F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"),
            F.sum((F.col("yes") > 0).cast("long")).alias("yes_types"),
            F.sum((F.col("no") > 0).cast("long")).alias("no_types"))
        full = wanted.select(tail.alias("gram")).distinct().select(
            "gram", F.substring("gram", 1, k - 1).alias("before"),
            F.substring("gram", 2, k).alias("shorter"))
        full = (full.join(counts, "gram", "left")
                .join(F.broadcast(totals) if k <= 2 else totals, "before", "left")
                .fillna(0, ["yes", "no", "yes_all", "no_all", "yes_types", "no_types"]))
        if model is None:
            full = full.withColumns({"p_yes": F.lit(1.0 / SYMBOLS),
                                     "p_no": F.lit(1.0 / SYMBOLS)})
        else:
            full = full.join(F.broadcast(model) if k <= 2 else model, "shorter")

        def mixed(c: str) -> Column:
            return F.when(F.col(f"{c}_all") == 0, F.col(f"p_{c}")).otherwise(
                (F.col(c) + F.col(f"{c}_types") * F.col(f"p_{c}"))
                / (F.col(f"{c}_all") + F.col(f"{c}_types")))

        model = staged(full.select("gram", mixed("yes").alias("p_yes"),
                                   mixed("no").alias("p_no")).withColumnRenamed(
            "gram", "gram" if k == ORDER else "shorter"), "model")
    return model.select("gram", F.round(
        (F.log("p_yes") - F.log("p_no")) * UNIT).cast("long").alias("ratio"))


def scores(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``url``, ``score`` (micro-units per character) of distinct URLs. Grams meet the
    model with two hashes in place of their URL; the model is broadcast while it is small,
    else both are shuffled."""
    named = urls.select("url", F.xxhash64("url").alias("h"),
                        F.xxhash64("url", F.lit(1)).alias("g"))
    found = (grams(named).join(small(model), "gram")
             .groupBy("h", "g").agg(F.sum("ratio").alias("sum"), F.count("*").alias("n"))
             .select("h", "g", F.floor(F.col("sum") / F.col("n")).cast("long").alias("score")))
    return named.join(found, ["h", "g"]).select("url", "score")


def cutoff(held: DataFrame, false_rejects: float = FALSE_REJECTS) -> int | None:
    """The greatest score ``t`` such that no more than ``false_rejects`` of the
    held-out accepted URLs (``score``, ``n``) score below it; never above 0. None
    without such URLs. Scores are counted in steps of a thousandth first: at most
    some ten thousand rows come to the driver, whatever the input.
    """
    steps = (held.groupBy(F.floor(F.col("score") / 1000).alias("step"))
             .agg(F.sum("n").alias("n")).orderBy("step").collect())
    allowed, below = false_rejects * sum(r["n"] for r in steps), 0
    for row in steps:
        if below + row["n"] > allowed:
            return min(int(row["step"]) * 1000, 0)
        below += row["n"]
    return None


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url",
          out: str = "url_filter", false_rejects: float = FALSE_REJECTS) -> DataFrame:
    """``pages`` with a struct column ``out``: ``host``, ``path``, ``rule``,
    ``verdict`` (``allow`` or ``block``), ``score`` (mean log ratio per character;
    null for null or empty URLs).

    The verdict is the fitting rule's; without one, ``block`` if the score is below the
    cutoff, else ``allow`` – also for null and empty URLs, and for all if the rules
    accept or reject nothing to learn from. Repeated rows are judged alike and all
    stay; other columns stay (names that begin with ``__lw_`` are reserved). Learning
    and scoring work on distinct URLs weighted by their number, so one URL or host
    with any share of the rows is one row for each task that meets it.
    """
    verdicts = "struct<action:string,rule:string>"
    marked = pages.withColumns({
        "__lw_host": host_of(F.col(url)), "__lw_path": path_of(F.col(url))})
    rule = rule_for(F.col("__lw_host"), F.col("__lw_path"), rules).cast(verdicts)
    distinct = staged(
        pages.filter(F.col(url).isNotNull()).groupBy(F.col(url).alias("url"))
        .agg(F.count("*").alias("n"))
        .withColumn("action", rule_for(host_of(F.col("url")), path_of(F.col("url")),
                                       rules)["action"])
        .withColumn("held", F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0), "urls")

    learned = (grams(distinct.filter("action is not null and not held"))
               .groupBy("gram", (F.col("action") == "allow").alias("accepted"))
               .agg(F.sum("n").alias("n")))
    wanted = staged(grams(distinct.select("url")).distinct(), "wanted")
    model = staged(ratio_model(learned, wanted), "model")
    scored = staged(scores(distinct.select("url"), model), "scores")
    both = distinct.agg(F.count_if(F.col("action") == "allow").alias("yes"),
                        F.count_if(F.col("action") == "block").alias("no")).first()
    limit = None
    if both["yes"] and both["no"]:
        limit = cutoff(distinct.filter("held and action = 'allow'").join(scored, "url"),
                       false_rejects)
    low = F.lit(False) if limit is None else F.col("__lw_score") < limit
    found = scored.select(F.col("url").alias("__lw_url"), F.col("score").alias("__lw_score"))
    kept = [c for c in pages.columns if c != out]
    return (marked.withColumn("__lw_rule", rule)
            .join(found, F.col(url) == F.col("__lw_url"), "left")
            .select(*kept, F.struct(
                F.col("__lw_host").alias("host"), F.col("__lw_path").alias("path"),
                F.col("__lw_rule.rule").alias("rule"),
                F.coalesce(F.col("__lw_rule.action"),
                           F.when(low, "block").otherwise("allow")).alias("verdict"),
                (F.col("__lw_score") / UNIT).alias("score")).alias(out)))


#: The rules of the registered query.
PAGE_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
              ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
              ("block", "net", "/fr/")]


def page_verdicts(pages: DataFrame) -> DataFrame:
    """The contract's row for each page."""
    return judge(pages.select("page_id", "url"), PAGE_RULES).select(
        "page_id", *[F.col(f"url_filter.{c}").alias(c)
                     for c in ("host", "path", "rule", "verdict", "score")])
