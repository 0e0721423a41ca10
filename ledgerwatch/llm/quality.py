"""Quality rules with risk-controlled thresholds.

Two fixed base rules (too few words, too many repeated words) and, for each stratum, a
cutoff for each of a few percentages. A cutoff is certified on held-out labelled
documents: with confidence 1 - delta over all strata and rules together, it rejects no
more than its share of the allowed false rejections.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import small, staged

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: What cutoffs are learned for: whole percents, or characters per word.
FEATURES = {
    "symbols": "100 * metrics.n_symbols div greatest(metrics.word_chars, 1)",
    "dup_lines": "100 * metrics.n_dup_lines div greatest(metrics.n_lines, 1)",
    "repeats": "100 * metrics.n_repeat_words div greatest(metrics.n_words, 1)",
    "long_words": "metrics.word_chars div greatest(metrics.n_words, 1)",
}
TOP = 100

#: Share of good documents that all learned rules together may reject, and the
#: probability that any certified cutoff breaks its bound.
FALSE_REJECTS = 0.04
DELTA = 0.05
#: A cutoff must reject this many times more bad labelled documents than good ones.
PENALTY = 20

#: Words handled at once in a task.
BATCH_WORDS = 500_000


def _repeated(words: list[list[bytes]]) -> np.ndarray:
    """For each text, the number of its words that lie in a window of REPEAT_WINDOW
    words that the text holds twice or more. Windows are compared exactly: words
    become numbers, and pairs of numbers again numbers, for lengths 2, 4 and 8."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    out = np.zeros(len(words), dtype=np.int64)
    if total < REPEAT_WINDOW:
        return out
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = np.fromiter((number(w, len(known)) for text in words for w in text),
                      dtype=np.int64, count=total)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
    step, distinct = 1, len(known)
    while step < REPEAT_WINDOW:
        ids, found = pd.factorize(ids[:-step] * distinct + ids[step:])
        distinct, step = len(found), step * 2
    whole = owner[: len(ids)] == owner[REPEAT_WINDOW - 1:]
    starts = np.flatnonzero(whole)
    codes, found = pd.factorize(ids[starts] * len(words) + owner[starts])
    again = starts[np.bincount(codes, minlength=len(found))[codes] > 1]
    edges = np.zeros(total + 1, dtype=np.int64)
    edges[again] += 1
    np.add.at(edges, again + REPEAT_WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(words)).astype(np.int64)


def text_metrics(texts: list[str | None]) -> pd.DataFrame:
    """METRICS of each text; a null text has the metrics of an empty one."""
    rows, pending, held, repeats = [], [], 0, []
    for text in texts:
        text = text or ""
        words = text.encode().split()  # bytes split at ASCII white space only
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        rows.append((len(words), len(text) - sum(map(text.count, SPACES)),
                     sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), len(lines)))
        pending.append(words)
        held += len(words)
        if held >= BATCH_WORDS:
            repeats.append(_repeated(pending))
            pending, held = [], 0
    repeats.append(_repeated(pending))
    out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_lines"], dtype="int64")
    out["n_repeat_words"] = np.concatenate(repeats)
    return out[list(METRICS)]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``metrics`` of METRICS. Only the text goes to Python, once:
    a function that counts as not deterministic is not copied below joins and filters."""
    @pandas_udf(", ".join(f"{m} long" for m in METRICS))
    def metrics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield text_metrics(batch.tolist())

    return docs.withColumn("metrics", metrics.asNondeterministic()(F.col(text)))


def base_failed() -> Column:
    return F.expr(f"metrics.n_words < {MIN_WORDS} or 100 * metrics.n_repeat_words "
                  f"> {MAX_REPEAT_PERCENT} * metrics.n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p)."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(good: np.ndarray, share: float, level: float) -> list[int]:
    """Cutoffs ``c`` (reject above ``c``) whose false rejections are at most ``share``,
    tested from the loosest on; ``good`` counts held-out good documents by value.

    The exact binomial tail is compared with ``level``. Testing in a fixed order and
    stopping at the first failure needs no further correction, and any of the
    certified cutoffs may be chosen afterwards.
    """
    n, found = int(good.sum()), []
    for c in range(TOP - 1, -1, -1):
        k = int(good[c + 1:].sum())
        if n == 0 or k > share * n or binomial_tail(k, n, share) > level:
            break
        found.append(c)
    return found


def thresholds(values: DataFrame, labels: DataFrame, stratum: str, doc: str = "doc_id",
               false_rejects: float = FALSE_REJECTS, delta: float = DELTA) -> DataFrame:
    """``stratum``, ``feature``, ``cutoff`` for each certified rule.

    ``values`` has ``doc``, ``stratum`` and the struct ``metrics``. Labels are good
    where every ``quality`` of the document is above 0; null labels do not count. Half
    of the labelled documents, by a hash of the id, certify; the other half chooses
    among the certified cutoffs. Base failures take no part, they are rejected anyway.
    Strata with too few labels get no rule. Only counts by value are shuffled: at most
    4 * 101 * features rows for a stratum.
    """
    known = (labels.filter("quality is not null")
             .groupBy(F.col(doc).alias("__lw_doc")).agg((F.min("quality") > 0).alias("good")))
    joined = (values.filter(~base_failed()).join(known, F.col(doc) == F.col("__lw_doc"))
              .withColumn("held", F.pmod(F.xxhash64(F.col(doc)), F.lit(2)) == 0))
    each = F.explode(F.array(*[F.struct(
        F.lit(name).alias("feature"),
        F.least(F.expr(e), F.lit(TOP)).cast("int").alias("value"))
        for name, e in FEATURES.items()]))
    counts = staged(
        joined.select(F.col(stratum).cast("string").alias("stratum"), "good", "held",
                      each.alias("x"))
        .groupBy("stratum", "x.feature", "x.value", "good", "held")
        .agg(F.count("*").alias("n")), "counts")
    tests = max(1, counts.select(F.coalesce("stratum", F.lit("\0"))).distinct().count()
                ) * len(FEATURES)
    share, level = false_rejects / len(FEATURES), delta / tests

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        def by_value(good: bool, held: bool) -> np.ndarray:
            part = rows[(rows.good == good) & (rows.held == held)]
            return np.bincount(part.value, weights=part.n, minlength=TOP + 1)

        held_good, good, bad = (by_value(*x) for x in ((True, True), (True, False),
                                                       (False, False)))
        best, chosen = 0.0, None
        for c in certified(held_good, share, level):
            worth = bad[c + 1:].sum() - PENALTY * good[c + 1:].sum()
            if worth > best:
                best, chosen = worth, c
        first = rows.iloc[0]
        return pd.DataFrame({"stratum": [first.stratum], "feature": [first.feature],
                             "cutoff": [chosen]}).dropna(subset=["cutoff"])

    return counts.groupBy("stratum", "feature").applyInPandas(
        choose, "stratum string, feature string, cutoff int")


def judged(values: DataFrame, rules: DataFrame, stratum: str, out: str = "quality") -> DataFrame:
    """``values`` (with ``metrics``) plus a struct ``out``: ``base_failed``, ``kept``
    and ``rejected_by`` (features whose value is above the stratum's cutoff)."""
    spread = staged(rules.groupBy(F.col("stratum").alias("__lw_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "cutoff"))).alias("__lw_cut")),
        "rules")
    joined = values.join(
        small(spread), F.col(stratum).cast("string").eqNullSafe(F.col("__lw_stratum")), "left")
    over = F.array_compact(F.array(*[
        F.when(F.expr(e) > F.element_at("__lw_cut", F.lit(name)), F.lit(name))
        for name, e in FEATURES.items()]))
    over = F.coalesce(over, F.array().cast("array<string>"))
    failed = base_failed()
    return joined.select(
        *[values[c] for c in values.columns if c != out],
        F.struct(failed.alias("base_failed"), (~failed & (F.size(over) == 0)).alias("kept"),
                 over.alias("rejected_by")).alias(out))


def learned_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Thresholds from the labelled documents among ``docs``, all of them."""
    wanted = staged(labels.filter("quality is not null").select(
        F.col("doc_id").alias("__lw_id")).distinct(), "labelled")
    labelled = docs.select("doc_id", stratum, "text").join(
        small(wanted), F.col("doc_id") == F.col("__lw_id"), "left_semi")
    values = staged(measured(labelled).drop("text"), "metrics")
    return staged(thresholds(values, labels, stratum), "thresholds")


def good_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass; columns as they were.

    Null and empty texts have no words and go. Repeated rows are judged alike. A null
    stratum is a stratum of its own. Without labels only the base rules apply. Texts
    are not shuffled: cutoffs come first, then each row is judged where it is read.
    """
    rules = learned_rules(docs, labels, stratum)
    own = docs.withColumnsRenamed({"metrics": "__lw_metrics"})
    marked = judged(measured(own), rules, stratum, "__lw_quality")
    return (marked.filter("__lw_quality.kept").drop("metrics")
            .withColumnsRenamed({"__lw_metrics": "metrics"}).select(*docs.columns))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row for each document: texts are read and measured once."""
    values = staged(measured(docs.select("doc_id", "lang", "text")).drop("text"), "metrics")
    rules = staged(thresholds(values, labels, "lang"), "thresholds")
    return judged(values, rules, "lang").select(
        "doc_id", *[F.col(f"metrics.{m}").alias(m) for m in METRICS[:5]],
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
        F.array_join("quality.rejected_by", ",").alias("rejected_by"))
