"""Quality rules with risk-controlled cutoffs.

Every text gets a few counts; each rule is a ratio of them (higher is
worse) and rejects a document whose ratio lies above the rule's cutoff. The
cutoffs come from labelled documents that pass the base rule, per stratum
(the language):

* one fold of the labels (:func:`hold_out` false) says which rules and
  cutoffs are useful: bad documents caught, minus ``GOOD_COST`` times good
  ones lost. Only useful rules are tested;
* the other fold, the hold-out, says which cutoffs are allowed. With ``k`` of
  ``n`` good hold-out documents above a cutoff, the cutoff is certified when
  ``P(Binomial(n, alpha_rule) <= k) <= delta_test``, i.e. when the exact
  (Clopper-Pearson) upper bound of its false rejection rate is at most
  ``alpha_rule``. Cutoffs are tested from the loosest to the strictest and
  testing stops at the first failure (fixed sequence: no further correction
  within a rule); ``delta_test`` is ``DELTA`` divided by the number of tested
  rules and of strata (Bonferroni), and ``alpha_rule`` is ``ALPHA`` divided by
  the number of tested rules. So with probability ``1 - DELTA`` no stratum
  loses more than ``ALPHA`` of its good documents to the rules.

A rule without a certified and useful cutoff rejects nothing in its stratum;
a stratum without enough labels keeps all that the base rule keeps.

Defined cases: a null text has no words and fails the base rule; a null
stratum is the stratum ''; several labels of one document count once, as bad
if any is bad; null labels are ignored; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cdclake.llm.common import map_texts, small_batches, stage

#: Most good documents of a stratum that the rules may reject, and the risk that they reject more.
ALPHA, DELTA = 0.10, 0.05
#: A lost good document costs as much as this many kept bad ones.
GOOD_COST = 5.0

#: Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim"]
_UPPER = bytes(range(ord("A"), ord("Z") + 1))

#: Rule -> (numerator, denominator, cutoffs from the loosest to the strictest).
RULES: dict[str, tuple[str, str, list[float]]] = {
    "symbols": ("n_symbols", "n_words", [2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05, 0.03]),
    "upper": ("n_upper", "word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "exclaim": ("n_exclaim", "n_words", [2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05]),
    "dup_lines": ("n_dup_lines", "n_lines", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    "repeats": ("n_repeat_words", "n_words", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    "long_words": ("word_chars", "n_words", [200.0, 100.0, 60.0, 40.0, 30.0, 24.0, 20.0, 17.0, 15.0, 13.0, 12.0]),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, inverse, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    twice = times[inverse] > 1
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``. Words are split at space and \\x09-\\x0D only."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8")
    words = data.split()  # bytes split at exactly these six characters
    lines = [line for line in data.split(b"\n") if line.strip()]
    white = sum(data.count(c) for c in b" \t\n\r\x0b\x0c")
    return (
        len(words),
        len(text) - white,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
        data.count(b"!"),
    )


def text_counts(docs: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``stratum`` and the counts of every whole text."""
    prepared = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        F.col(text_col).alias("text"),
    )
    schema = StructType([*prepared.schema.fields[:2], *(StructField(c, LongType()) for c in COUNTS)])

    def make():
        def work(ids, strata, texts):
            rows = list(zip(*map(count_text, texts), strict=True))
            return {"doc_id": ids, "stratum": strata} | dict(zip(COUNTS, map(list, rows), strict=True))

        return work

    return map_texts(prepared, make, schema, "doc_id", "stratum", "text")


def _ratio(rule: str):
    top, bottom, _ = RULES[rule]
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exact up to rounding.

    The terms of the tail on the near side of the mean fall from ``k`` on, so
    they are added up until they no longer count: some standard deviations of
    terms, and no array, whatever ``n``.
    """
    if k >= n:
        return 1.0
    upper = k > n * p
    i = k + 1 if upper else k
    first = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    term = total = 1.0
    while term > 1e-17 * total and (i < n if upper else i > 0):
        if upper:
            term *= (n - i) * p / ((i + 1) * (1 - p))
            i += 1
        else:
            term *= i * (1 - p) / ((n - i + 1) * p)
            i -= 1
        total += term
    tail = min(1.0, math.exp(first) * total)
    return 1.0 - tail if upper else tail


def certified(above: list[int], n: int, alpha: float, delta: float) -> int:
    """How many cutoffs, from the loosest on, are certified."""
    for i, k in enumerate(above):
        if n == 0 or binomial_cdf(int(k), n, alpha) > delta:
            return i
    return len(above)


def choose(counts: dict[tuple[bool, bool], dict], alpha: float, delta: float) -> dict[str, float | None]:
    """The cutoffs of one stratum; ``counts[(hold_out, good)]`` has ``n`` and the numbers above each cutoff."""

    def numbers(held: bool, good: bool, rule: str) -> tuple[int, list[int]]:
        row = counts.get((held, good))
        size = len(RULES[rule][2])
        return (int(row["n"]), [int(row[f"{rule}_{i}"]) for i in range(size)]) if row else (0, [0] * size)

    def gains(rule: str) -> list[float]:
        n_bad, bad = numbers(False, False, rule)
        n_good, good = numbers(False, True, rule)
        return [b / max(1, n_bad) - GOOD_COST * g / max(1, n_good) for b, g in zip(bad, good, strict=True)]

    useful = {rule: g for rule in RULES if max(g := gains(rule)) > 1e-12}
    cutoffs: dict[str, float | None] = dict.fromkeys(RULES)
    for rule, gain in useful.items():
        n, above = numbers(True, True, rule)
        allowed = certified(above, n, alpha / len(useful), delta / len(useful))
        best = max(range(allowed), key=lambda i: (gain[i], -i), default=None)
        if best is not None and gain[best] > 1e-12:
            cutoffs[rule] = RULES[rule][2][best]
    return cutoffs


def learn_cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff (or null) for each rule, from all labelled documents that pass the base rule."""
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
    )
    labelled = counts.where(~base_failed()).join(good, "doc_id").withColumn("held", hold_out(F.col("doc_id")))
    above = [
        F.sum(F.when(_ratio(rule) > cutoff, 1).otherwise(0)).alias(f"{rule}_{i}")
        for rule, (_, _, cutoffs) in RULES.items()
        for i, cutoff in enumerate(cutoffs)
    ]
    table = stage(labelled.groupBy("stratum", "held", "good").agg(F.count("*").alias("n"), *above), "rule-counts")
    # at most four rows a stratum, one task and a few kilobytes for each
    strata = max(1, table.select("stratum").distinct().count())
    schema = "stratum string, " + ", ".join(f"cut_{r} double" for r in RULES)

    def cutoffs_of(rows: pd.DataFrame) -> pd.DataFrame:
        by = {(bool(r["held"]), bool(r["good"])): r for r in rows.to_dict("records")}
        found = {f"cut_{r}": [c] for r, c in choose(by, alpha, delta / strata).items()}
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]]} | found).astype({c: "float64" for c in found})

    return table.groupBy("stratum").applyInPandas(cutoffs_of, schema)


def hold_out(doc_id):
    """The fold of a labelled document: a fixed arithmetic mix of its id, even for one half of the ids."""
    return (F.pmod(doc_id, F.lit(1_000_003)) * 7919 + 13) % 104_729 % 2 == 1


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The counts with ``base_failed`` and ``kept``."""
    rejected = F.lit(False)
    for rule in RULES:
        cut = F.col(f"cut_{rule}")
        rejected = rejected | (cut.isNotNull() & ~F.isnan(cut) & (_ratio(rule) > cut))
    return (
        counts.join(cutoffs, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False)))
        .drop(*cutoffs.columns)
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict and ``kept`` for every document (one row per row of ``docs``)."""
    counts = stage(text_counts(docs), "text-counts")
    return judge(counts, stage(learn_cutoffs(counts, labels), "rule-cutoffs"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.

    The texts are read a second time instead of being shuffled to their
    verdicts, so rows are judged one by one, also where ids repeat.
    """
    small_batches(docs.sparkSession)
    counts = stage(text_counts(docs, id_col, stratum_col, text_col), "text-counts")
    cutoffs = stage(learn_cutoffs(counts, labels), "rule-cutoffs")
    schema = StructType([StructField("doc", docs.schema), StructField("stratum", StringType()), *(StructField(c, LongType()) for c in COUNTS)])
    text_at, stratum_at = docs.columns.index(text_col), docs.columns.index(stratum_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                doc = b.column(0)
                found = np.array([count_text(t) for t in doc.field(text_at).to_pylist()], np.int64)
                stratum = doc.field(stratum_at).cast(pa.string()).fill_null("")
                yield pa.RecordBatch.from_arrays([doc, stratum, *(pa.array(c) for c in found.T)], names=["doc", "stratum", *COUNTS])

    counted = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).mapInArrow(run, schema)
    return judge(counted, cutoffs).where("kept").select("doc.*")


def oracle() -> str:
    """The verdicts in DuckDB SQL, over the views ``documents`` and ``labels``."""
    rules = ", ".join(
        f"('{rule}', {i}, CAST({cut!r} AS DOUBLE))" for rule, (_, _, cutoffs) in RULES.items() for i, cut in enumerate(cutoffs)
    )
    values = "\nUNION ALL ".join(
        f"SELECT rid, stratum, doc_id, base_failed, '{rule}' AS rule, coalesce(CAST({top} AS DOUBLE) / nullif({bottom}, 0), 0) AS value FROM judged"
        for rule, (top, bottom, _) in RULES.items()
    )
    word, symbols = r"[^\x20\x09-\x0D]", "[#*$%&|<>]"
    return rf"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{word}+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{word}')) AS lines
  FROM documents),
triples AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
repeats AS (SELECT rid, count(DISTINCT i + step) AS n FROM triples, range(3) steps(step) WHERE times > 1 GROUP BY rid),
counted AS (
  SELECT rid, doc_id, stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '{symbols}', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM docs LEFT JOIN repeats USING (rid)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
good AS (
  SELECT doc_id, min(quality) > 0 AS good, ((doc_id % 1000003 + 1000003) % 1000003 * 7919 + 13) % 104729 % 2 = 1 AS held
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
value AS ({values}),
rule AS (SELECT * FROM (VALUES {rules}) v(rule, i, cut)),
labelled AS (SELECT v.*, held, good FROM value v JOIN good USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT count(DISTINCT stratum) AS n FROM labelled),
above AS (
  SELECT stratum, rule, i, cut,
         count(*) FILTER (held AND good) AS n_held, count(*) FILTER (held AND good AND value > cut) AS k_held,
         count(*) FILTER (NOT held AND NOT good AND value > cut) / greatest(1, count(*) FILTER (NOT held AND NOT good))
           - {GOOD_COST} * count(*) FILTER (NOT held AND good AND value > cut) / greatest(1, count(*) FILTER (NOT held AND good)) AS gain
  FROM labelled JOIN rule USING (rule) GROUP BY ALL),
useful AS (SELECT stratum, rule, count(*) OVER (PARTITION BY stratum) AS m FROM above GROUP BY stratum, rule HAVING max(gain) > 1e-12),
tail AS (
  SELECT *, CASE WHEN n_held = 0 OR k_held >= n_held THEN 1 ELSE list_sum(list_transform(range(k_held + 1), lambda x: exp(
      lgamma(n_held + 1) - lgamma(x + 1) - lgamma(n_held - x + 1) + x * ln({ALPHA} / m) + (n_held - x) * ln(1 - {ALPHA} / m)))) END AS p
  FROM above JOIN useful USING (stratum, rule)),
certified AS (
  SELECT *, max(CAST(p > {DELTA} / (m * n) AS INTEGER)) OVER (PARTITION BY stratum, rule ORDER BY i) = 0 AS allowed FROM tail, strata),
chosen AS (
  SELECT stratum, rule, cut FROM certified WHERE allowed AND gain > 1e-12
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, i) = 1),
rejected AS (SELECT DISTINCT rid FROM value JOIN chosen USING (stratum, rule) WHERE value > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM rejected) AS kept
FROM judged"""
