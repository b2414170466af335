"""Quality rules with risk-controlled cutoffs.

Labelled documents choose, per stratum and signal, the cutoff over which a document is rejected. A cutoff
is certified if the exact binomial test rejects "good documents are over it with probability > risk". Cutoffs of one signal
are tested from the loosest on and testing ends at the first failure (fixed sequence, so no correction is needed along
it); strata and signals are corrected for by Bonferroni. With probability 1 - confidence_miss, no stratum loses more than
risk of its good documents by all signals together. Of the certified cutoffs the one with the best balance of rejected bad and good labels is
taken, none if no cutoff has a positive balance.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import read, small_side, staged, text_batches

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
#: Signals as a share of words, and the cutoffs that are tested.
SIGNALS = {"symbol_rate": "n_symbols", "dup_line_rate": "n_dup_lines", "repeat_rate": "n_repeat_words"}
CUTOFFS = (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
RISK, CONFIDENCE_MISS = 0.06, 0.1
#: Rejecting one good labelled document outweighs rejecting so many bad ones.
GOOD_COSTS = 5
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50
#: Most rows of a broadcast: of cutoffs, and of ids.
MOST_BROADCAST, MOST_IDS = 100_000, 1_000_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, duplicate lines, words in repeated 3-word windows) of a whole text; null is empty."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at exactly the ASCII white space
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeats = 0
    triples = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(triples)) < len(triples):
        found, end = Counter(triples), 0
        for i, t in enumerate(triples):
            if found[t] > 1:
                repeats += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def measure(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """docs(doc_id, text, stratum) -> doc_id, stratum (null: empty), the five counts, base_failed."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*map(measure_text, b.column("text").to_pylist()), strict=True)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("stratum"), *(pa.array(x, pa.int64()) for x in got)], ["doc_id", "stratum", *COUNTS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))
    return with_base(out)


def with_base(measured: DataFrame) -> DataFrame:
    return measured.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")))


def _rates() -> dict:
    return {s: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(0.0) for s, c in SIGNALS.items()}


@F.pandas_udf(DoubleType())
def _tail(x: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series([binomial_tail(int(a), int(b), float(c)) for a, b, c in zip(x, n, p, strict=True)], dtype=float)


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= x), which is the regularised incomplete beta function at 1 - p of n - x and x + 1. Its continued fraction takes some sqrt(n) steps, however many labels there are."""
    if x >= n:
        return 1.0
    if not 0.0 < p < 1.0:
        return 1.0 if p <= 0.0 else 0.0
    a, b, y = n - x, x + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(y) + b * math.log(p))
    return front * _beta_fraction(a, b, y) / a if y < (a + 1) / (a + b + 2) else 1.0 - front * _beta_fraction(b, a, p) / b


def _beta_fraction(a: float, b: float, y: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method; fast for y < (a + 1) / (a + b + 2)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * y / (a + 1.0)) or tiny)
    out, m = d, 1
    while True:
        for term in (m * (b - m) * y / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * y / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / ((1.0 + term * d) or tiny)
            c = (1.0 + term / c) or tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return out
        m += 1


def fit_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, confidence_miss: float = CONFIDENCE_MISS, cutoffs=CUTOFFS) -> DataFrame:
    """(stratum, one column per signal): the chosen cutoffs; null where none is certified or useful. One row per stratum with labels."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = measured.where(~F.col("base_failed")).join(truth, "doc_id").select("stratum", (F.col("quality") > 0).alias("good"), F.posexplode(F.array(*_rates().values())).alias("signal", "rate"))
    over = F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: F.col("rate") > c))  # so many of the cutoffs are exceeded
    bins = known.groupBy("stratum", "signal", over.alias("over")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    total = Window.partitionBy("stratum", "signal")
    sums = bins.withColumn("n", F.sum("good").over(total)).groupBy("stratum", "signal", "n").agg(F.collect_list(F.struct("over", "good", "bad")).alias("bins"))  # a bin per cutoff at most
    grid = sums.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(cutoffs) - 1))))
    beyond = lambda k: F.aggregate(F.filter("bins", lambda b: b["over"] > F.col("at")), F.lit(0).cast("long"), lambda s, b: s + b[k])
    grid = grid.select("stratum", "signal", "n", "at", beyond("good").alias("good"), beyond("bad").alias("bad"))
    strata = sums.select(F.countDistinct("stratum").alias("strata"))
    grid = grid.crossJoin(F.broadcast(strata))  # one row
    grid = grid.withColumn("p", _tail("good", "n", F.lit(risk / len(SIGNALS))))
    ok = F.min((F.col("p") <= F.lit(confidence_miss) / (F.col("strata") * len(SIGNALS))).cast("int")).over(total.orderBy(F.desc("at")))
    gain = F.col("bad") - GOOD_COSTS * F.col("good")
    best = grid.withColumn("ok", ok).where((F.col("ok") == 1) & (gain > 0)).groupBy("stratum", "signal").agg(F.max(F.struct(gain.alias("gain"), "at")).alias("best"))
    values = F.element_at(F.array(*map(F.lit, cutoffs)), F.col("best.at") + 1)
    chosen = best.groupBy("stratum").agg(*[F.max(F.when(F.col("signal") == i, values)).alias(f"cut_{s}") for i, s in enumerate(SIGNALS)])
    return chosen


def judge(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """measured with kept: false if the base rules fail or a signal is over its stratum's cutoff."""
    over = [F.coalesce(rate > F.col(f"cut_{s}"), F.lit(False)) for s, rate in _rates().items()]
    bad = over[0]
    for x in over[1:]:
        bad = bad | x
    return measured.join(small_side(chosen, MOST_BROADCAST), "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~bad)


def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, confidence_miss: float = CONFIDENCE_MISS, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts, base_failed, the stratum's cutoffs, kept; a row for each row of docs.

    Null text has no words and fails the base rules; a null stratum is one of its own. Repeated rows are judged alike, null ids too, but no
    label reaches those. Labels of one id that disagree count as good. Without labels only the base rules reject.
    """
    measured = staged(measure(docs, stratum), "quality-measured")
    return judge(measured, staged(fit_cutoffs(measured, labels, risk, confidence_miss), "quality-cutoffs"))


@F.pandas_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def _measured(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in text], columns=list(COUNTS), dtype="int64")


def filter_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK, confidence_miss: float = CONFIDENCE_MISS, stratum: str = "lang") -> DataFrame:
    """The rows of docs that quality_verdicts would keep, with all their columns, whatever these are called."""
    text_batches(docs.sparkSession)
    labelled = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("labelled_id")).distinct()
    # Only labelled documents set the cutoffs. Where their ids are too many for a broadcast, all are measured, so that no text is shuffled.
    judged = docs.join(F.broadcast(labelled), F.col("doc_id").cast("long") == F.col("labelled_id"), "left_semi") if labelled.count() <= MOST_IDS else docs
    chosen = staged(fit_cutoffs(measure(judged, stratum), labels, risk, confidence_miss), "quality-cutoffs")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), _measured(F.col("text").cast("string")).alias("m"))
    return judge(with_base(rows.select("doc", "stratum", "m.*")), chosen).where("kept").select("doc.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept")


#: Whole query in SQL; MEASURED_SQL ends in the table m, CHOSEN_SQL in k.
MEASURED_SQL = r"""
w as (select doc_id, coalesce(lang, '') stratum, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') words from docs),
win as (select doc_id, unnest(range(1, len(words) - 1)) i, words from w where len(words) >= 3),
tri as (select doc_id, i, count(*) over (partition by doc_id, words[i], words[i + 1], words[i + 2]) c from win),
rep as (select doc_id, count(distinct j) n from (select doc_id, unnest([i, i + 1, i + 2]) j from tri where c > 1) group by doc_id),
ln as (select doc_id, unnest(string_split(text, chr(10))) line from docs),
dup as (select doc_id, count(*) - count(distinct line) n from ln where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
m0 as (
  select w.doc_id, stratum, len(words)::bigint n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
    coalesce(dup.n, 0)::bigint n_dup_lines, coalesce(rep.n, 0)::bigint n_repeat_words
  from w left join dup using (doc_id) left join rep using (doc_id)),
m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m0)"""
CHOSEN_SQL = r"""
truth as (select doc_id, max(quality) quality from labels where doc_id is not null and quality is not null group by doc_id),
sig as (
  select stratum, quality > 0 good, s.signal, s.rate from m join truth using (doc_id),
    lateral (values (0, n_symbols / n_words::double), (1, n_dup_lines / n_words::double), (2, n_repeat_words / n_words::double)) s(signal, rate)
  where not base_failed),
cuts as (select unnest([0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]::double[]) cut),
grid as (
  select stratum, signal, cut, count_if(good) n, count_if(good and rate > cut) good, count_if(not good and rate > cut) bad from sig, cuts group by all),
tail as (
  select g.*, (select sum(exp(lgamma(g.n + 1) - lgamma(i + 1) - lgamma(g.n - i + 1) + i * ln(0.02) + (g.n - i) * ln(0.98))) from range(0, g.good::bigint + 1) r(i)) p,
    (select count(distinct stratum) from sig) strata from grid g),
ok as (select *, min(case when p <= 0.1 / (strata * 3) then 1 else 0 end) over (partition by stratum, signal order by cut desc) ok from tail),
best as (
  select stratum, signal, arg_max(cut, {'g': bad - 5 * good, 'c': cut}) cut from ok where ok = 1 and bad - 5 * good > 0 group by all),
k as (
  select m.*, not base_failed and not exists (
      select 1 from best b where b.stratum = m.stratum
        and case b.signal when 0 then n_symbols when 1 then n_dup_lines else n_repeat_words end / n_words::double > b.cut) kept from m)"""
ORACLE_SQL = f"""with docs as (select * from documents), {MEASURED_SQL}, {CHOSEN_SQL}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from k"""
