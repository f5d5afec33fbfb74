"""Quality rules with risk-controlled thresholds.

Fixed base rules reject some documents. Further rules (a ratio above a cutoff) are switched on only
where labelled holdouts show, by an exact binomial bound, that all rules of a stratum together reject
at most RISK of its good documents. The labelled rows fall into two halves by a hash of the id. One
half picks a cutoff for each rule and an order of the rules; the other half, which no choice has seen,
tests the union of the first rule, of the first two, and so on, and stops at the first that fails.
Such a chain is one hypothesis for each stratum; the level is divided by the number of strata, so that
all the guarantees hold together with CONFIDENCE.

Everything is DataFrame and SQL expressions.

Defined results: a null or empty text has no words and fails the base; rows that repeat are judged
alike; strata without enough labels have no further rules; an empty table gives an empty result; only
id, text and the stratum column are read. Where several rows label one id, the worst label counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.support import materialize

#: The share of good documents of a stratum that its rules may reject together, and the joint confidence.
RISK, CONFIDENCE = 0.02, 0.95
#: A rejected good document weighs as much as this many rejected bad ones when a cutoff is picked.
COST = 5
MIN_WORDS, REPEAT_SHARE = 50, 0.5
#: Cutoffs of each rule, laxest first: per cent of the words' characters, of lines, of words; the last one in characters.
CUTOFFS = {
    "symbols": [20.0, 10.0, 7.0, 5.0, 3.0],
    "capitals": [90.0, 75.0, 60.0, 45.0, 30.0],
    "dup_lines": [70.0, 50.0, 35.0, 25.0, 15.0],
    "repeats": [45.0, 40.0, 35.0, 30.0, 25.0],
    "word_length": [30.0, 20.0, 15.0, 12.0, 10.0],
}


def document_stats(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, the base statistics and the ratios of the rules, all within one row.

    Repeated 3-word windows are found without a shuffle: the 64-bit hashes of a text's windows are
    sorted with their places, and equal neighbours repeat.
    """
    body = F.coalesce("text", F.lit(""))
    has_word = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.regexp_extract_all(body, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
        has_word.alias("lines"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
    )
    second = first.select(
        "doc_id",
        "text_hash",
        "stratum",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        "n_capitals",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))))").cast("array<bigint>").alias("windows"),
    )
    third = second.withColumn(
        "placed",
        F.expr("if(size(array_distinct(windows)) = size(windows), array(), sort_array(transform(windows, (x, i) -> named_struct('h', x, 'at', cast(i as bigint)))))").cast("array<struct<h:bigint,at:bigint>>"),
    )
    places = "sort_array(transform(filter(placed, (x, k) -> x.h <=> get(placed, k - 1).h or x.h <=> get(placed, k + 1).h), x -> x.at))"
    covered = f"if(size(placed) = 0, 0L, aggregate({places}, named_struct('s', 0L, 'last', -3L), (a, x) -> named_struct('s', a.s + least(3L, x - a.last), 'last', x), a -> a.s))"
    return third.select("doc_id", "text_hash", "stratum", "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", F.expr(covered).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * REPEAT_SHARE))


def _share(part: str, whole: str) -> Column:
    return F.col(part) * 100.0 / F.greatest(F.col(whole), F.lit(1))


def rule_values() -> dict[str, Column]:
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "capitals": _share("n_capitals", "word_chars"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "word_length": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)).cast("double"),
    }


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(at most k of n) at rate p, summed in logarithms; 1 where k is at the mean or above (no test passes there)."""
    term = f"s.t + ln((cast({n} as double) - i) / (i + 1)) + ln({p} / (1 - {p}))"
    add = f"if(s.a > {term}, s.a + ln(1 + exp({term} - s.a)), {term} + ln(1 + exp(s.a - ({term}))))"
    start = f"named_struct('t', {n} * ln(1 - {p}), 'a', {n} * ln(1 - {p}))"
    total = f"aggregate(sequence(0, cast({k} as int) - 1), {start}, (s, i) -> named_struct('t', {term}, 'a', {add}), s -> s.a)"
    return F.expr(f"case when {k} >= {n} * {p} then 1D when {k} = 0 then exp({n} * ln(1 - {p})) else exp({total}) end")


def calibrate(stats: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE, cutoffs: dict[str, list[float]] | None = None) -> DataFrame:
    """The rules that stand: stratum, rule, cutoff, place; with the good documents of the testing half, the
    good and bad ones that the rules up to this place reject, and the p-value of their union.

    One row at most for each stratum and rule.
    """
    cutoffs = cutoffs or CUTOFFS
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = stats.where(~base_failed()).join(known, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)))
    good, bad = (F.col("quality") == 1).cast("bigint"), (F.col("quality") == 0).cast("bigint")

    tries = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(n).alias("nth"), F.lit(float(c)).alias("cutoff"), (rule_values()[r] > c).cast("bigint").alias("hit")) for r, cs in cutoffs.items() for n, c in enumerate(cs)])
    counts = (
        held.where("half = 0").select("stratum", "quality", F.explode(tries).alias("t")).select("stratum", "quality", "t.*")
        .groupBy("stratum", "rule", "nth", "cutoff")
        .agg(F.sum(good).alias("good"), F.sum(F.col("hit") * good).alias("hit_good"), F.sum(F.col("hit") * bad).alias("hit_bad"))
    )
    # from here on a table has strata x rules x cutoffs rows at most
    able = counts.where((F.col("hit_bad") > COST * F.col("hit_good")) & (F.col("hit_good") <= risk / 2 * F.col("good")))
    best = Window.partitionBy("stratum", "rule").orderBy((F.col("hit_bad") - COST * F.col("hit_good")).desc(), "nth")
    safest = Window.partitionBy("stratum").orderBy(F.col("hit_good") / F.col("hit_bad"), F.desc("hit_bad"), "rule")
    chosen = able.withColumn("n", F.row_number().over(best)).where("n = 1").select("stratum", "rule", "cutoff", F.row_number().over(safest).alias("place"))
    chosen = materialize(chosen, "quality-chosen")

    # rules in order, so that the union of the first k rejects what has its first hit at k or before
    listed = chosen.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("place", "rule", "cutoff"))).alias("rules"))
    value = F.create_map(*[x for r in cutoffs for x in (F.lit(r), rule_values()[r])])
    hit = F.array_min(F.transform(F.filter("rules", lambda x: F.element_at("value", x["rule"]) > x["cutoff"]), lambda x: x["place"]))
    tested = held.where("half = 1").withColumn("value", value).join(listed, "stratum")
    first = tested.groupBy("stratum", F.coalesce(hit, F.lit(0)).alias("place")).agg(F.sum(good).alias("g"), F.sum(bad).alias("b"))
    total = first.groupBy("stratum").agg(F.sum("g").alias("good"))
    chain = Window.partitionBy("stratum").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        chosen.join(total, "stratum").join(first, ["stratum", "place"], "left")
        .withColumn("hit_good", F.sum(F.coalesce("g", F.lit(0))).over(chain))
        .withColumn("hit_bad", F.sum(F.coalesce("b", F.lit(0))).over(chain))
    )
    level = F.lit((1 - confidence) / max(1, chosen.select("stratum").distinct().count()))
    stands = F.min((F.col("p_value") <= level).cast("int")).over(chain)
    passed = summed.withColumn("p_value", binomial_tail("good", "hit_good", risk)).withColumn("stands", stands).where("stands = 1")
    return passed.select("stratum", "rule", "cutoff", "place", "good", "hit_good", "hit_bad", "p_value")


def judge(stats: DataFrame, thresholds: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """stats with base_failed, failed_rules and kept. thresholds: five rows a stratum at most; Spark broadcasts them by their stored size."""
    rules = rules or list(CUTOFFS)
    one = thresholds.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    failed = F.filter(F.array(*[F.when(rule_values()[r] > F.element_at("cutoffs", F.lit(r)), F.lit(r)) for r in rules]), lambda x: x.isNotNull())
    out = stats.join(one, "stratum", "left").withColumn("base_failed", base_failed()).withColumn("failed_rules", F.coalesce(failed, F.array().cast("array<string>")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs")


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Statistics are computed once, over all documents, and kept as a narrow table."""
    stats = materialize(document_stats(docs, stratum), "quality-stats")
    return judge(stats, materialize(calibrate(stats, labels), "quality-thresholds"))


def keep_passing(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of docs that pass all rules, with all their columns. Rows of one id and text share a fate."""
    failed = judged(docs, labels, stratum).where(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash"))
    return docs.join(failed, same, "left_anti")
