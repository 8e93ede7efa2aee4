"""Quality rules as a short-circuit cascade of native expressions.

``measured`` adds what the rules look at. ``ordered_rules`` runs each rule alone over a
bounded sample, takes its rejections and its seconds beyond a run without a rule, and
puts the rule with most rejections per second first. ``cascade`` turns the order into
one CASE expression: a document that a rule rejects never reaches the later ones. The
order changes the cost and ``rejected_by`` (the first rule that rejected), never ``kept``.

Results: a null text has no words and fails the base checks. Lines are split at \\n and
count only if they hold a word. Windows are compared by 64-bit hashes within a text.
Columns of the added names are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import free_names, quoted, set_aside, without, written

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
SAMPLE_ROWS = 2000

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@dataclass(frozen=True)
class Rule:
    """A name and the condition on which a document is rejected (never null)."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class RuleCost:
    name: str
    rejected: int
    seconds: float


def split_words(text: Column) -> Column:
    """Runs of other characters than ASCII blanks; none in a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def measured(
    docs: DataFrame, *, text: str = "text", words: str = "words", lines: str = "lines"
) -> DataFrame:
    """The documents with the base measures and, under the given names, words and lines.

    Repeated windows: the windows' hashes are compared as a set first, and only a text
    that repeats one is sorted by (hash, position) to find the places of the repeats.
    """
    start = docs.select(*map(quoted, without(docs, words, lines, *MEASURES)))
    hashes, windows, ranked, places = free_names(start, "hashes", "windows", "ranked", "places")
    body = F.coalesce(quoted(text), F.lit(""))
    step = start.withColumn(words, split_words(quoted(text))).withColumn(
        lines, F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    step = step.withColumn(hashes, F.transform(quoted(words), lambda w: F.xxhash64(w)))
    n = F.size(hashes)
    step = step.withColumn(
        windows,
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    step = step.withColumn(
        ranked,
        F.when(
            repeats,
            F.sort_array(
                F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    )

    def twin(entry: Column, at: Column) -> Column:
        here = F.col(ranked)
        return F.coalesce(F.get(here, at - 1)["h"] == entry["h"], F.lit(False)) | F.coalesce(
            F.get(here, at + 1)["h"] == entry["h"], F.lit(False)
        )

    step = step.withColumn(
        places,
        F.sort_array(F.transform(F.filter(F.col(ranked), twin), lambda entry: entry["i"])),
    )
    covered = F.aggregate(
        F.col(places),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda state, place: F.struct(
            place.alias("last"),
            (state["total"] + F.least(F.lit(WINDOW), place - state["last"])).alias("total"),
        ),
        lambda state: state["total"],
    )
    n_words = F.size(words).cast("long")
    step = step.select(
        *map(quoted, start.columns),
        words,
        lines,
        n_words.alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return step.withColumn("base_failed", failed)


def standard_rules(*, text: str = "text", words: str = "words", lines: str = "lines") -> list[Rule]:
    """Rules on shape only, so that they hold for any language written in letters."""
    n = F.col("n_words")
    body = F.coalesce(quoted(text), F.lit(""))
    stutters = F.size(
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
            lambda i: F.get(quoted(words), i) == F.get(quoted(words), i - 1),
        )
    )
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.size(lines)),
        Rule("shouting", 5 * F.regexp_count(body, F.lit("!")) > n),
        Rule(
            "capitals",
            2 * F.regexp_count(body, F.lit(r"\p{Lu}")) > F.regexp_count(body, F.lit(r"\p{L}")),
        ),
        Rule("stutter", 5 * stutters > n),
    ]


def ordered_rules(sampled: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[RuleCost]]:
    """The rules by rejections per second of their own over a sample of features."""
    sample = written(sampled, "rule-sample")

    def run(rejects: Column) -> tuple[int, float]:
        began = time.perf_counter()
        found = sample.agg(F.count_if(rejects)).first()[0]
        return found, time.perf_counter() - began

    run(F.col("n_words") < 0)
    _, idle = run(F.col("n_words") < 0)
    costs = []
    for rule in rules:
        rejected, seconds = run(rule.rejects)
        costs.append(RuleCost(rule.name, rejected, max(seconds - idle, 1e-3)))
    place = {c.name: k for k, c in enumerate(costs)}
    order = sorted(rules, key=lambda r: -costs[place[r.name]].rejected / costs[place[r.name]].seconds)
    return order, costs


def cascade(features: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows with ``kept`` and ``rejected_by`` ('base', a rule's name, or null)."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    rest = features.select(*map(quoted, without(features, "kept", "rejected_by")))
    return rest.withColumn("rejected_by", verdict.otherwise(F.lit(None).cast("string"))).withColumn(
        "kept", F.col("rejected_by").isNull()
    )


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Every document with its measures, kept and rejected_by, as a written table.

    ``carry``: columns of the documents that come along (all, if not given). The rules
    are ordered by a Bernoulli sample of about ``sample_rows`` documents. The rows are
    written because a filter on a measure or the verdict would otherwise be moved below
    the measures and evaluate each of them many times over.
    """
    words, lines = free_names(docs, "doc_words", "doc_lines")
    share = min(1.0, sample_rows / max(1, docs.count()))
    names = {"text": text, "words": words, "lines": lines}
    sampled = measured(docs.select(quoted(text)).sample(share, seed=11), **names)
    rules, _ = ordered_rules(sampled, standard_rules(**names))
    judged = cascade(measured(docs, **names), rules).drop(words, lines)
    if carry is not None:
        judged = judged.select(*map(quoted, carry), *MEASURES, "kept", "rejected_by")
    return written(judged, "judged")


def keep(docs: DataFrame, **options) -> DataFrame:
    """The documents that no rule rejects, columns as they came."""
    renamed, back = set_aside(docs, *MEASURES, "kept", "rejected_by")
    return judge(renamed, **options).where("kept").select(*back)
