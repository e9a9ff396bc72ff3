"""Ability labels by declared rules, compiled to one Column."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import bind, question_count

# The taxonomy (label, major, name, definition).
TAXONOMY = (
    ("PR", "perception", "pattern_recognition", "Recognize observed trend, cyclicity, stationarity, structural characteristics, or core statistics."),
    ("NU", "perception", "noise_understanding", "Quantify or characterize stochastic noise scale, magnitude, or profile."),
    ("AD", "perception", "anomaly_detection", "Identify, localize, or classify out-of-distribution observations or anomalous segments."),
    ("CA", "perception", "comparative_analysis", "Compare two or more series for shared patterns, distributions, statistics, noise, or trends."),
    ("ER", "reasoning", "etiological_reasoning", "Infer the generative source or underlying causal factors responsible for an observed series."),
    ("CD", "reasoning", "causal_discovery", "Determine existence and direction of causal relationships between multiple time series."),
    ("AR", "reasoning", "abductive_reasoning", "Infer the most plausible latent event explaining an observed change using before/after evidence."),
    ("TR", "reasoning", "temporal_relation_reasoning", "Localize events and establish their chronological order or temporal relationship."),
    ("NR", "reasoning", "numerical_reasoning", "Perform contextual quantitative calculations over time-series values."),
    ("DR", "reasoning", "deductive_reasoning", "Apply predefined rules, equations, or constraints to derive a logically necessary conclusion."),
    ("IR", "reasoning", "inductive_reasoning", "Infer a latent principle or rule from observations, then apply it to a new or future case."),
    ("TSF", "prediction", "time_series_forecasting", "Predict future numerical time-series values from history and optional context."),
    ("EP", "prediction", "event_prediction", "Predict a future discrete event from historical series and contextual/domain knowledge."),
    ("QualDM", "decision_making", "qualitative_decision_making", "Choose an action using time-series patterns and contextual knowledge without outcome simulation."),
    ("QuantDM", "decision_making", "quantitative_decision_making", "Choose an optimal action by quantitatively simulating/comparing outcomes under rules and constraints."),
)
LABELS = tuple(x[0] for x in TAXONOMY)
FITS = ("exact", "compatible", "closest", "mixed", "out_of_scope")

# Metadata priors (source, task, label, score, reason, forced fit).
PRIORS = (
    ("tsaqa", ("anomaly_detection",), "AD", 0.995, "TSAQA task=anomaly_detection", None),
    ("tsaqa", ("comparison",), "CA", 0.985, "TSAQA task=comparison", None),
    ("tsaqa", ("temporal_relationship",), "TR", 0.985, "TSAQA task=temporal_relationship", None),
    ("tsaqa", ("classification",), "PR", 0.84, "TSAQA generic classification is closest to perception/PR", "closest"),
    ("tsaqa", ("data_transformation",), "DR", 0.80, "TSAQA transformation usually applies a stated operation/rule", "compatible"),
    ("time_mqa", ("anomaly detection", "anomaly_detection"), "AD", 0.995, "Time-MQA task=anomaly detection", None),
    ("time_mqa", ("forecasting",), "TSF", 0.995, "Time-MQA task=forecasting", None),
    ("time_mqa", ("imputation",), "TSF", 0.65, "imputation is only adjacent to numerical forecasting", "out_of_scope"),
    ("time_mqa", ("classification",), "PR", 0.80, "generic classification is only adjacent to pattern recognition", "closest"),
)

# Keyword rules (label, score, reason, patterns).
KEYWORDS = (
    ("QuantDM", 0.96, "quantitatively compares operational strategies/outcomes", (r"backtest(?:ing|ed)?", r"maximum drawdown|best return|strategy return", r"optimal (?:strategy|procedure|policy|operation)", r"simulate.*(?:strategy|procedure|action).*(?:metric|outcome|return)")),
    ("QualDM", 0.94, "asks for an action/management decision", (r"most appropriate (?:clinical )?(?:management|treatment|action|intervention)", r"what should (?:the|a|we|you)", r"which (?:action|treatment|intervention|management plan)", r"recommend (?:an )?(?:action|treatment|intervention)")),
    ("CD", 0.97, "asks for directed causal relations between series", (r"causal (?:relationship|direction|graph)", r"cause nodes?", r"adjacency matrix", r"granger caus")),
    ("AR", 0.94, "asks for a latent event explaining an observed change", (r"what might have happened", r"most plausible (?:latent )?event", r"event.*(?:explain|responsible for).*(?:change|shift|spike)", r"what happened (?:between|during|around)")),
    ("ER", 0.92, "asks for the generative source or underlying cause", (r"underlying (?:cause|factor|source)", r"generative source", r"what (?:could have )?(?:caused|generated|produced) (?:this|the) (?:series|pattern)", r"which physical activity.*(?:pattern|series)")),
    ("TR", 0.95, "asks for chronology or temporal ordering", (r"chronological (?:order|sequence)", r"temporal relationship", r"order(?:ing)? of (?:the )?(?:events|segments|patches)", r"which .* (?:happened|occurred) first")),
    ("TSF", 0.97, "asks for future numerical values", (r"forecast(?:ing)? (?:the )?(?:next|future)", r"predict (?:the )?next \w* ?(?:points?|values?|time series)", r"future numerical (?:values?|series)", r"most plausible .* (?:price|series) over the next")),
    ("EP", 0.94, "asks whether a future discrete event will occur", (r"predict whether .* will", r"will .* (?:occur|happen|rain|fail) (?:in|within|during|over)", r"what event(?:s)? will happen", r"event prediction")),
    ("DR", 0.91, "requires applying an explicit rule/equation/threshold", (r"supposing that", r"given (?:the following )?rule", r"according to (?:the|this) .* equation", r"apply (?:the|this) (?:formula|rule|operation)", r"(?:above|below) (?:the )?threshold", r"if .* then .*")),
    ("IR", 0.91, "infers a rule/principle and applies it", (r"infer (?:the )?(?:underlying )?(?:rule|principle)", r"identify (?:the )?rule.*predict", r"learned pattern.*(?:next|future)")),
    ("NR", 0.89, "requires quantitative calculation", (r"(?:calculate|compute|estimate|determine) (?:the )?(?:mean|average|variance|standard deviation|amplitude|duration|distance|range|sum|value|rate)", r"what is (?:the )?(?:mean|average|variance|standard deviation|amplitude|duration|distance|range|sum)", r"how many (?:points|steps|times|events)", r"numerical reasoning")),
    ("CA", 0.94, "compares two or more series", (r"compar(?:e|ing|ison|ative)", r"similar(?:ity)? (?:between|to)", r"different from (?:each other|time series)", r"relationship between .* and .*", r"correlation (?:between|of)|correlated with", r"find other metric\(s\).*related")),
    ("AD", 0.95, "detects/localizes abnormal observations", (r"anomal(?:y|ies|ous)", r"outlier", r"abnormal (?:point|segment|pattern|event)", r"structural break|change point", r"(?:upward|downward) spike")),
    ("NU", 0.95, "characterizes stochastic noise", (r"noise (?:characteristics|level|scale|magnitude|profile|standard deviation)", r"noisy", r"signal.to.noise|\bsnr\b", r"stochastic noise")),
    ("PR", 0.91, "recognizes observed temporal patterns/properties", (r"trend|periodic|periodicity|seasonal|cyclic|stationar", r"pattern (?:recognition|identification)|identify .* pattern", r"local characteristic|frequency characteristic", r"describe (?:the )?(?:characteristics|behavior|series)", r"summari[sz]e (?:the )?(?:series|data|behavior)", r"classify the given time series")),
)
SECOND, GAP, ACCEPT, EVIDENCE = 0.90, 0.08, 0.94, 8


def taxonomy(spark: SparkSession) -> DataFrame:
    """The dimension table: 15 rows."""
    return spark.createDataFrame(TAXONOMY, "label string, major string, name string, definition string")


# Letters that fold to a plain one although they aren't its other case, and what they fold to.
FOLDED, PLAIN = "\u017f\u0131\u212a", "sik"


def needed(pattern: str) -> frozenset[str] | None:
    """Literals of which any text that the pattern is found in holds at least one (after folding); None if there are none."""
    return _needed(_parser.parse(pattern, re.IGNORECASE | re.DOTALL))


def _needed(parts: Iterable) -> frozenset[str] | None:
    found: list[frozenset[str]] = []
    run = ""
    for op, value in parts:
        if op is _parser.LITERAL:
            run += chr(value)
            continue
        if run:
            found.append(frozenset([run]))
            run = ""
        own = None
        if op is _parser.SUBPATTERN:
            own = _needed(value[3])
        elif op is _parser.BRANCH:
            each = [_needed(x) for x in value[1]]
            own = frozenset().union(*each) if all(each) else None
        elif op is _parser.MAX_REPEAT and value[0] >= 1:
            own = _needed(value[2])
        if own:
            found.append(own)
    if run:
        found.append(frozenset([run]))
    # The rarest choice is guessed by length; of a set the shortest literal decides.
    return max(found, key=lambda x: (min(map(len, x)), -len(x)), default=None)


def has_any(text: Column, patterns: tuple[str, ...], folded: Column | None = None) -> Column:
    """Whether any pattern is found. With folded (the lower-cased text without letters that fold to others) only patterns
    run of which the text holds a literal that they can't do without; literals are searched far faster than patterns."""
    if folded is None:
        return text.rlike("(?Uis)" + "|".join(f"(?:{p})" for p in patterns))
    out = F.lit(False)
    for p in patterns:
        there = reduce(Column.__or__, (F.contains(folded, F.lit(x)) for x in sorted(needed(p) or ())), F.lit(False)) if needed(p) else F.lit(True)
        out = out | (there & text.rlike(f"(?Uis){p}"))
    return out


def decide(source: Column, task: Column, prompt: Column) -> Column:
    """The rule decision of a prompt: a struct, with the major label and the name of the primary label.

    Null prompts match no rule. Rows of any number are decided independently of each other, in one projection.
    """
    said = F.lower(F.trim(F.coalesce(task, F.lit(""))))
    asked = F.coalesce(prompt, F.lit(""))
    # Texts are made once, however many patterns look at them.
    made = F.struct(asked.alias("asked"), F.lower(asked).alias("text"), F.translate(F.lower(asked), FOLDED, PLAIN).alias("folded"), said.alias("said"))
    return bind(made, lambda x: _decide(source, x["said"], x["asked"], x["text"], x["folded"]))


def decided(df: DataFrame, source: Column, task: Column, prompt: Column, name: str = "provisional") -> DataFrame:
    """df with the rule decision as a column: each different (source, task, prompt) is decided once and joined back, which pays
    where prompts are repeated often. The join is by a digest; a prompt of any number of rows is one row of its other side."""
    key = F.sha2(F.to_json(F.struct(source.alias("s"), task.alias("t"), prompt.alias("p")), {"ignoreNullFields": "false"}), 256)
    keyed = df.withColumn("_key", key)
    once = keyed.select("_key", source.alias("_s"), task.alias("_t"), prompt.alias("_p")).dropDuplicates(["_key"])
    told = once.select(F.col("_key").alias("_k"), decide(F.col("_s"), F.col("_t"), F.col("_p")).alias(name))
    return keyed.join(told, F.col("_key") == F.col("_k")).drop("_key", "_k")


def _decide(source: Column, said: Column, asked: Column, text: Column, folded: Column) -> Column:
    hits: list[Column] = []

    def hit(when: Column, order: int, label: str, score: float, reason: str) -> None:
        hits.append(F.when(when, F.struct(F.lit(label).alias("label"), F.lit(score).alias("score"), F.lit(order).alias("at"), F.lit(reason).alias("reason"))))

    forced = F.lit(None).cast("string")
    for i, (name, tasks, label, score, reason, fit) in enumerate(PRIORS):
        here = (source == name) & said.isin(*tasks)
        hit(here, i, label, score, reason)
        if fit:
            forced = F.when(here, fit).otherwise(forced)
    for i, (label, score, reason, patterns) in enumerate(KEYWORDS):
        hit(has_any(text, patterns, folded), len(PRIORS) + i, label, score, reason)
    best = lambda found: F.transform(F.array_distinct(F.transform(found, lambda h: h["label"])), lambda x: F.struct((-F.array_max(F.transform(F.filter(found, lambda h: h["label"] == x), lambda h: h["score"]))).alias("minus"), x.alias("label")))
    several = question_count(asked) > 1
    return bind(F.array_compact(F.array(*hits)), lambda found: bind(F.array_sort(best(found)), lambda ranked: _decision(found, ranked, forced, several, said)))


def _decision(found: Column, ranked: Column, forced: Column, several: Column, said: Column) -> Column:
    top = F.get(ranked, F.lit(0))
    score = -top["minus"]
    second = F.transform(F.filter(F.slice(ranked, F.lit(2), F.greatest(F.size(ranked), F.lit(1))), lambda r: (-r["minus"] >= SECOND) & (score + r["minus"] <= GAP)), lambda r: r["label"])
    compound = several & (F.size(second) > 0)
    fit = F.coalesce(forced, F.when(compound, "mixed").otherwise("exact"))
    reasons = lambda label: F.transform(F.array_sort(F.transform(F.filter(found, lambda h: h["label"] == label), lambda h: F.struct(h["at"], h["reason"]))), lambda h: F.concat(label, F.lit(": "), h["reason"]))
    told = F.slice(F.flatten(F.transform(F.concat(F.array(top["label"]), second), reasons)), 1, EVIDENCE)
    none = F.size(found) == 0
    empty = F.array().cast("array<string>")
    out_of_scope = fit == "out_of_scope"
    primary = F.when(~none & ~out_of_scope, top["label"])
    kinds = F.create_map(*(F.lit(x) for row in TAXONOMY for x in (row[0], row[1])))
    names = F.create_map(*(F.lit(x) for row in TAXONOMY for x in (row[0], row[2])))
    return F.struct(
        primary.alias("primary_label"),
        F.when(none, empty).otherwise(second).alias("secondary_labels"),
        F.when(~none, top["label"]).alias("closest_label"),
        F.when(none, "out_of_scope").otherwise(fit).alias("taxonomy_fit"),
        F.when(none, 0.0).otherwise(score).alias("confidence"),
        F.when(~none & ~out_of_scope & (fit == "exact") & (score >= ACCEPT) & ~compound, "auto_accept").otherwise("review").alias("status"),
        F.when(none | (said == ""), "rules").otherwise("metadata+rules").alias("method"),
        F.when(none, F.array(F.lit("no high-precision taxonomy rule matched"))).otherwise(told).alias("evidence"),
        F.when(primary.isNotNull(), kinds[primary]).alias("major_label"),
        F.when(primary.isNotNull(), names[primary]).alias("minor_name"),
    )
