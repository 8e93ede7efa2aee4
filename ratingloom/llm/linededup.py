"""Line dedup by winnowing over line hashes, in native expressions.

Lines are split at \\n; those without a word are passed over. The window of a line is the
shortest run of lines with ``least_words`` words from it on.

1. Fingerprints: of each window the line with the least hash is selected, by content alone.
   So two equal runs of ``least_words`` words, wherever they lie, select equal lines.
2. Positions: only fingerprints with two places or more are kept, counted map side first;
   joined to them, the places give each document its anchors and the windows these serve.
3. Extension: from an anchored window a match goes on both ways through consecutive
   stretches. A stretch is a window, or the shortest run with ``least_words`` words back from
   a line, that begins at an anchored window. Stretches are named by 128 bits of hash; a
   match extends as long as they have an earlier place. Each line of a repeated run lies in a
   stretch inside that run: forwards where enough words follow, backwards where enough precede.
4. Of the places of a name the first (by id, then position) is the original, and the lines of
   every later place are deleted.

So a line goes if and only if it lies in a run of equal lines with ``least_words`` words that
has an earlier place: fingerprints propose, the stretches decide. A deleted line has an equal
line at an earlier place, so the first copy of a line always stays. Lines without a word go
where they lie between two deleted ones. A document is one row: the lines of a very long one
are looked at in one task, in time proportional to its lines.

Results: a null text stays null. A document without a deletion keeps its text byte for
byte; if all its lines with words go, the text is empty. Rows that share id and text
share their result; a null id comes first in the order. Columns named n_lines,
n_removed_lines or n_removed_words are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.common import all_salts, free_names, hot_keys, quoted, salted, without, written

LEAST_WORDS = 20
SALTS = 32
ADDED = ("n_lines", "n_removed_lines", "n_removed_words")


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(quoted(doc_id), quoted(text))


def line_units(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per distinct (id, text): place, two hashes and words of each line with a word."""
    lines = F.split(F.coalesce(quoted(text), F.lit("")), "\n")
    units = F.filter(
        F.transform(
            lines,
            lambda line, i: F.struct(
                i.alias("at"),
                F.xxhash64(line).alias("h"),
                F.xxhash64(F.lit(1), line).alias("g"),
                F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("w"),
            ),
        ),
        lambda unit: unit["w"] > 0,
    )
    return (
        docs.select(quoted(doc_id).alias("doc_id"), _key(doc_id, text).alias("doc_key"), units.alias("units"))
        .where(F.size("units") > 0)
        .dropDuplicates(["doc_key", "doc_id"])
    )


def _needed(lines: Column, least_words: int) -> Column:
    """How many of the lines, from the first on, hold ``least_words`` words (n), and their words (held)."""

    def add(run: Column, line: Column) -> Column:
        longer = F.struct((run["n"] + 1).alias("n"), (run["held"] + line["w"]).alias("held"))
        return F.when(run["held"] >= least_words, run).otherwise(longer)

    return F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(0).alias("held")), add)


def windows(units: Column, least_words: int) -> Column:
    """Of each line the window that starts there: n lines, held words. A line has a word at least."""
    return F.transform(units, lambda _, i: _needed(F.slice(units, i + 1, F.lit(least_words)), least_words))


def fingerprints(units: DataFrame, least_words: int) -> DataFrame:
    """doc_id, doc_key and marks: the selected lines, with hash h, position pos and the windows (first to last) that select them.

    Lambdas look into arrays of the row; each such array is a column of its own, as Spark
    would work out a nested expression anew for every element.
    """

    def selected(window: Column, i: Column) -> Column:
        lines = F.transform(
            F.slice("units", i + 1, window["n"]), lambda u, j: F.struct(u["h"].alias("h"), (i + j).alias("pos"))
        )
        return F.when(window["held"] >= least_words, F.array_min(lines))

    ahead = units.select("doc_id", "doc_key", "units", windows(F.col("units"), least_words).alias("ahead"))
    least = ahead.select("doc_id", "doc_key", F.transform("ahead", selected).alias("least"))
    # Windows that select one line follow one another.
    differs = lambda m, i: F.when((i == 0) | ~m.eqNullSafe(F.get("least", i - 1)), i)
    changes = F.filter(F.transform("least", differs), lambda i: i.isNotNull())
    changed = least.select("*", changes.alias("changes"))
    runs = F.transform(
        "changes",
        lambda i, k: F.struct(
            F.get("least", i)["h"].alias("h"),
            F.get("least", i)["pos"].alias("pos"),
            i.alias("first"),
            (F.coalesce(F.get("changes", k + 1), F.size("least")) - 1).alias("last"),
        ),
    )
    return changed.select("doc_id", "doc_key", F.filter(runs, lambda run: run["h"].isNotNull()).alias("marks"))


def anchors(units: DataFrame, least_words: int) -> DataFrame:
    """doc_id, doc_key and the windows (first to last, sorted) whose fingerprint has two places or more."""
    marked = written(fingerprints(units, least_words), "fingerprints")
    places = marked.select("doc_id", "doc_key", F.explode("marks").alias("mark")).select("doc_id", "doc_key", "mark.*")
    shared = places.groupBy("h").agg(F.count("*").alias("places")).where("places > 1")
    shared = written(shared, "shared-fingerprints")
    hot = hot_keys(shared, "h", "places")
    dealt = places.withColumn("salt", salted(F.col("h"), hot, F.struct("doc_key", "pos"), SALTS))
    known = shared.select("h", F.explode(all_salts(F.col("h"), hot, SALTS)).alias("salt"))
    return (
        dealt.join(known, ["h", "salt"])
        .groupBy("doc_key", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("anchored"))
    )


def stretches(units: DataFrame, least_words: int) -> DataFrame:
    """One row per stretch from an anchored window on: name (fp, fq), document, span by lines with words and by lines."""
    found = anchors(units, least_words).withColumnsRenamed({"doc_id": "a_id", "doc_key": "a_key"})
    same = (F.col("doc_key") == F.col("a_key")) & F.col("doc_id").eqNullSafe(F.col("a_id"))
    anchored = units.join(found, same).select("doc_id", "doc_key", "units", "anchored")
    lines = F.col("units")
    start = lambda i: F.greatest(F.lit(1), i + 2 - least_words)
    back = F.transform(
        lines, lambda _, i: _needed(F.reverse(F.slice(lines, start(i), i + 2 - start(i))), least_words)
    )
    ends = anchored.select("*", windows(lines, least_words).alias("ahead"), back.alias("back"))
    both = written(ends, "anchored")

    def from_window(s: Column) -> Column:
        end = s + F.get("ahead", s)["n"] - 1
        later = F.sequence(s, F.least(s + least_words - 1, F.size("units") - 1))

        def is_end(e: Column) -> Column:
            run = F.get("back", e)
            return (e == end) | ((run["held"] >= least_words) & (run["n"] == e - s + 1))

        return F.transform(F.filter(later, is_end), lambda e: F.struct(s.alias("s"), e.alias("e")))

    every = F.flatten(F.transform("anchored", lambda a: F.sequence(a["first"], a["last"])))
    # An outer explode, as the other one would work out the runs a second time to see whether there are any.
    found_runs = F.explode_outer(F.flatten(F.transform(every, from_window)))
    runs = both.select("doc_id", "doc_key", "units", found_runs.alias("run")).where("run IS NOT NULL")
    held = F.transform(
        F.slice(lines, F.col("run.s") + 1, F.col("run.e") - F.col("run.s") + 1), lambda u: F.struct(u["h"], u["g"])
    )
    return runs.select(
        F.xxhash64(held).alias("fp"),
        F.xxhash64(F.lit(1), held).alias("fq"),
        "doc_id",
        "doc_key",
        "run.s",
        "run.e",
        F.get("units", F.col("run.s"))["at"].alias("s_at"),
        F.get("units", F.col("run.e"))["at"].alias("e_at"),
    )


def _merged(spans: DataFrame) -> DataFrame:
    """Per document the sorted, disjoint spans (s, e) of lines that overlapping and adjoining ones make up."""
    by_start = Window.partitionBy("doc_key", "doc_id").orderBy("s")
    reached = F.max("e").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("s") <= reached + 1, 0).otherwise(1)
    islands = spans.withColumn("fresh", fresh).withColumn(
        "island", F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        islands.groupBy("doc_key", "doc_id", "island")
        .agg(F.struct(F.min("s_at").alias("s"), F.max("e_at").alias("e")).alias("span"))
        .groupBy("doc_key", "doc_id")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
        .select("doc_id", "doc_key", "spans")
    )


def repeated_spans(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """doc_id, doc_key and the sorted, disjoint spans (s, e) of lines that repeat earlier ones."""
    units = written(line_units(docs, doc_id, text), "line-units")
    found = written(stretches(units, least_words), "stretches")
    firsts = written(
        found.groupBy("fp", "fq")
        .agg(F.min(F.struct("doc_id", "doc_key", "s")).alias("first"), F.count("*").alias("places"))
        .where("places > 1"),
        "first-places",
    )
    hot = hot_keys(firsts, "fp", "places")
    dealt = found.withColumn("salt", salted(F.col("fp"), hot, F.struct("doc_key", "s"), SALTS))
    repeated = firsts.select("fp", "fq", "first", F.explode(all_salts(F.col("fp"), hot, SALTS)).alias("salt"))
    own = (
        (F.col("doc_key") == F.col("first.doc_key"))
        & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("s") == F.col("first.s"))
    )
    later = dealt.join(repeated, ["fp", "fq", "salt"]).where(~own)
    return _merged(later.select("doc_id", "doc_key", "s", "e", "s_at", "e_at"))


def _outside(lines: Column, spans: Column) -> Column:
    """The lines outside of sorted, disjoint spans, in one pass."""

    def gap(span: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["e"] + 1)
        return F.slice(lines, start + 1, span["s"] - start)

    end = F.element_at(spans, -1)["e"] + 1
    return F.concat(F.flatten(F.transform(spans, gap)), F.slice(lines, end + 1, F.size(lines) - end))


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with later repeated runs deleted from the text, and what went in numbers."""
    spans = repeated_spans(docs, doc_id=doc_id, text=text, **options)
    start = docs.select(*map(quoted, without(docs, *ADDED)))
    key, other_key, other_id, cuts, lines, left = free_names(
        start, "line_key", "cut_key", "cut_id", "cuts", "all_lines", "left_lines"
    )
    spans = spans.select(
        F.col("doc_key").alias(other_key), F.col("doc_id").alias(other_id), F.col("spans").alias(cuts)
    )
    same = (F.col(key) == F.col(other_key)) & quoted(doc_id).eqNullSafe(F.col(other_id))
    joined = (
        start.withColumn(key, _key(doc_id, text))
        .join(spans, same, "left")
        .withColumn(lines, F.split(quoted(text), "\n"))
        .withColumn(
            left,
            F.when(F.col(cuts).isNotNull(), _outside(F.col(lines), F.col(cuts))),
        )
    )
    whole = F.col(cuts).isNull()
    kept_text = F.array_join(left, "\n")
    words = r"[^\x20\x09-\x0D]+"
    new_text = F.when(whole, quoted(text)).when(kept_text.rlike(words), kept_text).otherwise(F.lit(""))
    zero = F.lit(0).cast("long")
    return joined.select(
        *[new_text.alias(c) if c.lower() == text.lower() else quoted(c) for c in start.columns],
        F.coalesce(F.size(lines).cast("long"), zero).alias("n_lines"),
        F.when(whole, zero).otherwise((F.size(lines) - F.size(left)).cast("long")).alias("n_removed_lines"),
        F.when(whole, zero)
        .otherwise(
            (F.regexp_count(quoted(text), F.lit(words)) - F.regexp_count(kept_text, F.lit(words))).cast("long")
        )
        .alias("n_removed_words"),
    )
