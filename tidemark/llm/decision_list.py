"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every text are native expressions, written once. From the labelled rows sequential
covering learns an ordered list of rules, each a conjunction of thresholds on statistics: a rule is
grown one condition at a time by FOIL gain on the growing fold, pruned back to the prefix that is
most precise on the pruning fold, and kept while it is precise enough there; the rows it covers
leave before the next rule is grown. One aggregate over the labelled rows gives the counts of all
conditions that a step may choose from, so the driver sees a few hundred counts and never rows.
The list is emitted as one Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_remainder, store

BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = ".,;:!?"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Statistics that conditions may be put on; those before them are counts of the contract.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "word_length", "symbol_share", "digit_share", "capital_share", "mark_share", "dup_line_share",
    "repeat_share", "distinct_share", "words_per_line",
)
STATISTICS = ("n_words", *SHARES)

# Thresholds offered per statistic: this many quantiles of the labelled rows, near the tails too.
LEVELS = (0.005, 0.01, 0.02, 0.05, *[k / 10 for k in range(1, 10)], 0.95, 0.98, 0.99, 0.995)
# A rule must be this precise on the pruning fold and cover this share of its bad rows (two at least).
PRECISION = 0.95
COVER = 0.01
FOLDS = 3


def _repeat_words(windows: str, starts: str) -> tuple[Column, Column]:
    """(start places of windows found twice or more, in order; words that those windows cover)."""
    places = F.sort_array(F.transform(
        F.filter(F.col(starts), lambda x, k: (
            (F.get(F.col(starts), k - 1)["h"] == x["h"]) | (F.get(F.col(starts), k + 1)["h"] == x["h"])
        )),
        lambda x: x["at"],
    ))
    covered = F.aggregate(
        F.transform("dl_places", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("dl_places"), k + 1) - p, F.lit(WINDOW))
        )),
        F.lit(0), lambda total, x: total + x,
    )
    return places, F.coalesce(covered, F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(`kept columns`, counts, shares): statistics of a whole text; null counts as empty.

    Empty and blank texts give zeros. Windows are compared by 64-bit hashes. Every step is a column
    that the next ones refer to several times, so that none is computed again per element.
    """
    kept = [c for c in df.columns if c != text_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = df.select(*kept, text.alias("dl_text"))
    out = out.select(
        *kept,
        F.filter(F.split("dl_text", f"[{BLANK}]+"), lambda w: w != "").alias("dl_words"),
        F.filter(F.split("dl_text", "\n", -1), lambda x: x.rlike(f"[^{BLANK}]")).alias("dl_lines"),
        # What is counted by character is a small part of a text.
        F.regexp_replace("dl_text", f"[^{SYMBOLS}{DIGITS}{CAPITALS}{MARKS}]+", "").alias("dl_marks"),
    )

    def number_of(characters: str) -> Column:
        return F.length("dl_marks") - F.length(F.translate("dl_marks", characters, ""))

    out = out.select(
        *kept, F.size("dl_words").alias("n_words"),
        F.length(F.array_join("dl_words", "")).alias("word_chars"),
        F.size("dl_lines").alias("dl_n_lines"),
        (F.size("dl_lines") - F.size(F.array_distinct("dl_lines"))).alias("n_dup_lines"),
        number_of(SYMBOLS).alias("n_symbols"), number_of(DIGITS).alias("dl_digits"),
        number_of(CAPITALS).alias("dl_capitals"), number_of(MARKS).alias("dl_marks"),
        F.transform("dl_words", lambda w: F.xxhash64(w)).alias("dl_hashes"),
    )
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    parts = ["dl_n_lines", "dl_digits", "dl_capitals", "dl_marks"]
    windows = F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("dl_hashes"), i + k) for k in range(WINDOW)]),
    ))
    out = out.select(
        *kept, *numbers, *parts, F.size(F.array_distinct("dl_hashes")).alias("dl_distinct"),
        windows.alias("dl_windows"),
    )
    parts.append("dl_distinct")
    starts = F.when(F.size(F.array_distinct("dl_windows")) < F.size("dl_windows"), F.sort_array(
        F.transform("dl_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    ))
    places, covered = _repeat_words("dl_windows", "dl_starts")
    out = out.select(*kept, *numbers, *parts, starts.alias("dl_starts"))
    out = out.select(*kept, *numbers, *parts, places.alias("dl_places"))
    out = out.select(*kept, *numbers, *parts, covered.alias("n_repeat_words"))
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("dl_n_lines")
    shares = {
        "word_length": (chars, n), "symbol_share": (F.col("n_symbols"), chars),
        "digit_share": (F.col("dl_digits"), chars), "capital_share": (F.col("dl_capitals"), chars),
        "mark_share": (F.col("dl_marks"), chars), "dup_line_share": (F.col("n_dup_lines"), lines),
        "repeat_share": (F.col("n_repeat_words"), n), "distinct_share": (F.col("dl_distinct"), n),
        "words_per_line": (n, lines),
    }
    return out.select(
        *kept, *[F.col(c).cast("bigint").alias(c) for c in COUNTS],
        *[_share(part, whole).alias(name) for name, (part, whole) in shares.items()],
    )


def base_failed() -> Column:
    """The fixed rule: too few words, or too many in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    """statistic > threshold, or at most it."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; a row that one of them covers is bad, others are good."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule_number(self) -> Column:
        """Number of the first rule that covers a row, from 1; null if none does."""
        found = F.lit(None).cast("int")
        for number in range(len(self.rules), 0, -1):
            found = F.when(covers(self.rules[number - 1]), F.lit(number)).otherwise(found)
        return found

    def __str__(self) -> str:
        lines = [f"{k}. if {' and '.join(map(str, rule))}: bad"
                 for k, rule in enumerate(self.rules, 1)]
        return "\n".join([*lines, "otherwise: good"])


def covers(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Per statistic the distinct quantiles that conditions may compare with."""
    found = rows.agg(*[
        F.percentile_approx(s, list(LEVELS), 10_000).alias(s) for s in STATISTICS
    ]).first()
    return {s: sorted({float(v) for v in found[s] or []}) for s in STATISTICS}


def _candidates(rows: DataFrame, thresholds: dict[str, list[float]]):
    """(condition, bad rows, good rows) it covers, for every condition, from one aggregate."""
    place = [sum(((F.col(s) > t).cast("int") for t in thresholds[s]), F.lit(0)) for s in STATISTICS]
    counted = rows.select("bad", F.posexplode(F.array(*place)).alias("s", "bin")).groupBy(
        "s", "bin"
    ).agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
    count = {(r.s, r.bin): (r.bad, r.n - r.bad) for r in counted}
    for s, name in enumerate(STATISTICS):
        cells = [count.get((s, b), (0, 0)) for b in range(len(thresholds[name]) + 1)]
        below = [0, 0]
        total = [sum(c[0] for c in cells), sum(c[1] for c in cells)]
        for cell, threshold in zip(cells, thresholds[name]):
            below = [below[0] + cell[0], below[1] + cell[1]]
            yield Condition(name, False, threshold), below[0], below[1]
            yield Condition(name, True, threshold), total[0] - below[0], total[1] - below[1]


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """FOIL gain: bad rows that stay, times the bits by which they stand out more."""
    if not after[0]:
        return 0.0
    return after[0] * (log2(after[0] / sum(after)) - log2(before[0] / sum(before)))


def _grow(rows: DataFrame, thresholds, total: tuple[int, int], least: int) -> list[Condition]:
    """Add the condition of most gain until no good row is covered or nothing helps."""
    rule: list[Condition] = []
    covered = total
    while covered[0] and covered[1]:
        options = [
            (_gain(covered, (bad, good)), bad, good, condition)
            for condition, bad, good in _candidates(rows.where(covers(rule)), thresholds)
            if bad >= least and (bad, good) != covered
        ]
        if not options:
            break
        gain, bad, good, condition = max(options, key=lambda o: (o[0], -o[2], str(o[3])))
        if gain <= 0:
            break
        rule.append(condition)
        covered = (bad, good)
    return rule


def _pruned(rows: DataFrame, rule: list[Condition]) -> tuple[list[Condition], int, int]:
    """The prefix most worth on the pruning fold, (bad - good) / covered, and what it covers."""
    prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
    counts = rows.agg(*[
        F.sum(F.when(covers(p), F.col("bad") if bad else 1 - F.col("bad")).otherwise(0)).alias(f"{kind}{k}")
        for k, p in enumerate(prefixes) for kind, bad in (("bad", True), ("good", False))
    ]).first()
    worth = []
    for k, prefix in enumerate(prefixes):
        bad, good = counts[f"bad{k}"] or 0, counts[f"good{k}"] or 0
        worth.append(((bad - good) / max(bad + good, 1), bad, -k, prefix, good))
    _, bad, _, prefix, good = max(worth, key=lambda w: w[:3])
    return prefix, bad, good


def _totals(rows: DataFrame) -> tuple[int, int]:
    found = rows.agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    return (found.bad or 0), found.n - (found.bad or 0)


def learn(statistics: DataFrame, labels: DataFrame, precision: float = PRECISION) -> DecisionList:
    """The list for rows that pass the fixed rule, from labels (doc_id, quality: 1 good, 0 bad).

    Every labelled row takes part. Null ids and labels do not; of labels that share an id the
    worst counts, and repeated rows count each. Folds are drawn by a hash of the id. Without
    labels, or with one kind of them, the list is empty.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg(F.max((F.col("quality") <= 0).cast("int")).alias("bad"))
    rows = store(
        statistics.where(~base_failed()).join(marked, "doc_id").select(
            "bad", *STATISTICS, (crc_remainder(F.col("doc_id"), FOLDS) == 0).alias("pruning"),
        ), "labelled-statistics",
    )
    thresholds = _thresholds(rows)
    growing, pruning = rows.where(~F.col("pruning")), rows.where("pruning")
    found = DecisionList()
    bad, good = _totals(pruning)
    least = max(2, int(COVER * bad))
    while True:
        left = found.rule_number().isNull()
        total = _totals(growing.where(left))
        if not (total[0] and total[1]):
            break
        rule = _grow(growing.where(left), thresholds, total, 2 * least)
        if not rule:
            break
        rule, bad, good = _pruned(pruning.where(left), rule)
        if bad < least or bad < precision * (bad + good):
            break
        found.rules.append(rule)
    return found


def judged(statistics: DataFrame, found: DecisionList) -> DataFrame:
    """Add base_failed, rule (the first that covers the row, null if none) and kept."""
    out = statistics.withColumn("base_failed", base_failed())
    out = out.withColumn("rule", F.when(~F.col("base_failed"), found.rule_number()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, counts, shares, base_failed, rule, kept) of every row, repeated and null ids too.

    Statistics of all rows are written once; the list is learnt from the labelled ones among them.
    An empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    statistics = store(with_statistics(own), "rule-statistics")
    return judged(statistics, learn(statistics, labels))
