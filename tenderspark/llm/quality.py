"""Quality rules whose cutoffs are chosen with a guaranteed bound on false rejections.

Each rule rejects a document whose measure lies above a cutoff. For each stratum and rule the cutoffs of a grid are
tested from the highest down on labelled holdouts: of n good documents the rule would reject k, and the cutoff is
admissible if the exact binomial tail P(Bin(n, risk / rules) <= k) is at most delta / (strata * rules) and all higher
cutoffs are admissible (fixed sequence within a rule, Bonferroni across rules and strata). A document is rejected if any
rule rejects it, so with probability 1 - delta all rules together falsely reject less than ``risk`` of every stratum. Of
the admissible cutoffs, the one with the largest share of bad documents rejected less ``COST`` times the share of good
ones is taken; a stratum without enough labels gets none. Strata are the values of a column of the data.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import as_bytes, bounded_batches, lean, written

# rule: measure, as numerator and denominator columns of the statistics table
RULES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "shout_share": ("n_shout_words", "n_words"),
}
GRID = [i / 20 for i in range(1, 20)]
RISK, DELTA, COST = 0.04, 0.05, 10
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOLS = bytes(set(range(256)) - set(b"#*$%&|<>"))
_CONTINUED = bytes(range(0x80, 0xC0))
STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_shout_words long"


def measures(raw: bytes | None) -> tuple[int, ...]:
    """The statistics named in ``STATS`` of one UTF-8 text; a null text counts as an empty one."""
    raw = raw or b""
    words = raw.split()
    n = len(words)
    chars = len(b"".join(words).translate(None, _CONTINUED))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:], strict=False))
        seen = Counter(grams)
        if len(seen) < len(grams):
            last = -1  # the last word already counted
            for i, g in enumerate(grams):
                if seen[g] > 1:
                    repeats += i + 2 - max(last, i - 1)
                    last = i + 2
    shout = sum(1 for w in words if len(w) > 2 and w.isupper())
    return n, chars, len(raw.translate(None, _SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeats, shout


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", carry: bool = False) -> DataFrame:
    """(doc_id, stratum, the columns of ``STATS``) of every row. A null stratum is 'other'.

    ``carry`` adds the whole input row as the struct ``_row``."""
    bounded_batches(docs.sparkSession)
    names = [x.split()[0] for x in STATS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [measures(t.as_py()) for t in b.column(2)]
            cols = list(zip(*found, strict=True)) or [()] * len(names)
            kept = [b.column(i) for i in range(b.num_columns) if i != 2]
            kept_names = [n for i, n in enumerate(b.schema.names) if i != 2]
            yield pa.record_batch([*kept, *[pa.array(c, pa.int64()) for c in cols]], names=[*kept_names, *names])

    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("other")).alias("stratum")
    cols = [F.col(id_col).cast("long").alias("doc_id"), stratum, as_bytes(text_col), *([F.struct("*").alias("_row")] if carry else [])]
    given = docs.select(*cols)
    row = f"_row {given.schema['_row'].dataType.simpleString()}, " if carry else ""
    return given.mapInArrow(lean(rows), f"doc_id long, stratum string, {row}{STATS}")


def share(rule: str):
    top, bottom = RULES[rule]
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly but for rounding. Summed away from k on the side that holds the smaller terms until they
    no longer count, so the work grows with the spread of the distribution and not with k."""
    if n == 0 or k >= n:
        return 1.0
    below = k <= n * p
    i = k if below else k + 1
    term = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    total, odds = 0.0, p / (1 - p)
    while 0 <= i <= n and term > 1e-18 * total:
        total += term
        term, i = (term * i / ((n - i + 1) * odds), i - 1) if below else (term * (n - i) * odds / (i + 1), i + 1)
    return min(1.0, total) if below else max(0.0, 1.0 - total)


def learned_cutoffs(stats: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, cost: float = COST) -> dict[str, dict[str, float]]:
    """Stratum -> rule -> cutoff, from all labelled rows of ``stats``.

    ``labels`` (doc_id, quality) is deduplicated to one row per id (good only if every label says 1); null ids and
    null labels are left out. What reaches the driver is the number of strata, and one row with
    2 * len(RULES) * len(GRID) counts for each stratum that has enough good rows for any cutoff to be admitted.
    """
    given = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    held = stats.join(given, "doc_id")
    above = lambda want, r, c: F.sum(((F.col("good") == want) & (share(r) > F.lit(c))).cast("long"))
    counts = [above(w, r, c).alias(f"{w}|{r}|{c}") for w in (True, False) for r in RULES for c in GRID]
    counted = written(held.groupBy("stratum").agg(F.sum(F.col("good").cast("long")).alias("n"), F.sum((~F.col("good")).cast("long")).alias("bad"), *counts), "quality-counts")
    level, each = delta / (max(1, counted.count()) * len(RULES)), risk / len(RULES)
    out: dict[str, dict[str, float]] = {}
    for row in counted.where(F.col("n") >= math.log(level) / math.log1p(-each)).collect():
        for r in RULES:
            best = None
            for c in reversed(GRID):
                k, caught = row[f"True|{r}|{c}"], row[f"False|{r}|{c}"]
                if binomial_tail(k, row["n"], each) > level:
                    break
                gain = caught / max(row["bad"], 1) - cost * (k / row["n"])
                if best is None or gain > best[0]:
                    best = (gain, c)
            if best:
                out.setdefault(row["stratum"], {})[r] = best[1]
    return out


def with_verdict(stats: DataFrame, cutoffs: dict[str, dict[str, float]]) -> DataFrame:
    failed = [F.when((F.col("stratum") == s) & (share(r) > F.lit(c)), F.lit(r)) for s, rules in cutoffs.items() for r, c in rules.items()]
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rules = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return stats.withColumn("base_failed", base).withColumn("failed_rules", rules).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: its statistics, ``base_failed``, ``failed_rules`` array<string> and ``kept``.

    The base rule fails a text of fewer than 50 words or with more than half of them in repeated three-word windows;
    null, empty and white-space texts have no words and fail. A null id is judged like any other but can't be
    labelled. No labels, or too few of a stratum: only the base rule rejects there. Ties (a measure equal to its
    cutoff) are kept. Other columns of ``docs`` are not read.
    """
    stats = written(statistics(docs, id_col, text_col, stratum_col), "quality")
    return with_verdict(stats, learned_cutoffs(stats, labels, risk, delta))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, each judged on its own (null ids too).

    Every text is counted once: rows go with their statistics to the shared folder, the cutoffs are learned from the
    statistics there, and the rows are filtered where they lie, without a shuffle. Columns may have any name."""
    stats = written(statistics(docs, id_col, text_col, stratum_col, carry=True), "quality-rows")
    return with_verdict(stats, learned_cutoffs(stats.drop("_row"), labels)).where("kept").select("_row.*")
