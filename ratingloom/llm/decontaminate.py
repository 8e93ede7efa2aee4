"""Benchmark decontamination by a prefix-filtered join, in native expressions.

An item's window is ``window`` consecutive words of it (all its words, if it has fewer).
Every word of a window must be found, so one of its shingles suffices as prefix: the one
that is rarest in all documents, counted in a first pass. The second pass keeps the
places of prefix shingles only, each with the words around it. Joined to the windows by
their prefix, a place is dropped if the window would begin before the text or end after
it, and else compared word by word.

The shingles that a pass looks for are constants of its expression, about ``block``
at a time: a benchmark with more is done in blocks, each over all documents. Blocks are
fetched one by one and their results written, so neither the driver nor a plan holds more
than one of them.

Results: a null text, or one without words, has no word and no hit. Repeated items hit
once; an item without id is named by an empty string. Rows that share id and text share
their result. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import free_names, lookup_join, lowered, quoted, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
BLOCK = 20_000


def item_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits and of all non-ASCII characters."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def document_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(quoted(doc_id), quoted(text))


def shingle_hashes(words: Column, size: int) -> Column:
    n = F.size(words)
    return F.when(
        n >= size,
        F.transform(
            F.sequence(F.lit(0), n - size),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """One line per distinct window: its words, the shingle size and the ids of its items."""
    items = benchmark.select(
        F.coalesce(quoted(item_id).cast("string"), F.lit("")).alias("item"),
        item_words(quoted(text)).alias("all_words"),
    ).where(F.size("all_words") > 0)
    length = F.least(F.lit(window), F.size("all_words"))
    starts = F.explode(F.sequence(F.lit(1), F.size("all_words") - length + 1))
    windows = items.select("item", "all_words", length.alias("n"), starts.alias("at"))
    return (
        windows.select("item", F.slice("all_words", F.col("at"), F.col("n")).alias("window_words"))
        .groupBy("window_words")
        .agg(F.collect_set("item").alias("window_items"))
        .withColumn("size", F.least(F.lit(SHINGLE), F.size("window_words")))
    )


def _blocks(frame: DataFrame, block: int) -> Iterator[list[int]]:
    """The distinct hashes in lists of about ``block``; the driver holds one of them at a time."""
    values = written(frame.select("hash").distinct(), "wanted-hashes")
    parts = -(-values.count() // block)
    for k in range(parts):
        yield [r[0] for r in values.where(F.pmod(F.col("hash"), F.lit(parts)) == k).collect()]


def _among(column: str, values: list[int]) -> str:
    return f"{column} IN ({', '.join(f'{v}L' if v > -(2**63) else 'bigint(-9223372036854775808)' for v in values)})"


def rarest_shingles(docs_words: DataFrame, windows: DataFrame, block: int) -> DataFrame:
    """The windows with hash and offset of the shingle that the documents hold least often."""
    sizes = [r[0] for r in windows.select("size").distinct().collect()]
    parts = []
    for size in sizes:
        of_size = windows.where(F.col("size") == size)
        placed = of_size.select(
            "*", F.posexplode(shingle_hashes(F.col("window_words"), size)).alias("offset", "hash")
        )
        hashed = docs_words.select(shingle_hashes(F.col("words"), size).alias("hashes"))
        # Each block's counts are written before the next block is asked for, so no plan holds two.
        counts = [
            written(
                hashed.select(F.explode(F.expr(f"filter(hashes, h -> {_among('h', values)})")).alias("hash"))
                .groupBy("hash")
                .agg(F.count("*").alias("seen")),
                "shingle-counts",
            )
            for values in _blocks(placed, block)
        ]
        total = counts[0]
        for more in counts[1:]:
            total = total.unionByName(more)
        parts.append(placed.join(total, "hash", "left"))
    ranked = parts[0]
    for more in parts[1:]:
        ranked = ranked.unionByName(more)
    return ranked.groupBy("window_words", "window_items", "size").agg(
        F.min_by(
            F.struct("hash", "offset"),
            F.struct(F.coalesce("seen", F.lit(0)), F.col("offset")),
        ).alias("prefix")
    )


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """One line per document: doc_id, doc_key, n_words, hits (start, length), items, n_hit.

    Nothing but the places of prefix shingles is shuffled, with ``2 * window`` words at
    most around each; texts stay where they are read.
    """
    docs_words = docs.select(
        quoted(doc_id).alias("doc_id"),
        document_key(doc_id, text).alias("doc_key"),
        item_words(quoted(text)).alias("words"),
    )
    windows = written(benchmark_windows(benchmark, item_text, item_id, window), "item-windows")
    if windows.isEmpty():
        none = F.array().cast("array<struct<start:int,length:int>>")
        return docs_words.select(
            "doc_id",
            "doc_key",
            F.size("words").cast("long").alias("n_words"),
            none.alias("hits"),
            F.array().cast("array<string>").alias("items"),
            F.lit(0).cast("long").alias("n_hit"),
        )
    prefixes = written(rarest_shingles(docs_words, windows, block), "window-prefixes").select(
        F.col("prefix.hash").alias("hash"),
        "size",
        F.struct(F.col("prefix.offset").alias("offset"), "window_words", "window_items").alias("window"),
    )
    sizes = sorted(r[0] for r in prefixes.select("size").distinct().collect())
    found = []
    for size in sizes:
        of_size = prefixes.where(F.col("size") == size)
        hashed = docs_words.withColumn("hashes", shingle_hashes(F.col("words"), size))
        for values in _blocks(of_size, block):
            places = F.expr(
                f"filter(sequence(0, size(hashes) - 1), i -> {_among('get(hashes, i)', values)})"
            )
            around = F.transform(
                F.when(F.size("hashes") > 0, places),
                lambda i: F.struct(
                    i.alias("at"),
                    F.get(F.col("hashes"), i).alias("hash"),
                    F.transform(
                        F.sequence(i - (window - 1), i + (window - 1)), lambda j: F.get(F.col("words"), j)
                    ).alias("around"),
                ),
            )
            one = written(
                hashed.select(
                    "doc_id", "doc_key", F.size("words").alias("n_words"), around.alias("places")
                ),
                "prefix-places",
            )
            found.append((one, of_size))
    lines = []
    for one, of_size in found:
        at = one.select("doc_id", "doc_key", "n_words", F.explode("places").alias("place")).select(
            "doc_id", "doc_key", "n_words", "place", F.col("place.hash").alias("hash")
        )
        by_hash = of_size.groupBy("hash").agg(F.collect_list("window").alias("windows"))
        lines.append(
            lookup_join(at, by_hash, "hash", "doc_key", how="inner")
            .select("doc_id", "doc_key", "n_words", "place", F.explode("windows").alias("window"))
            .select(
                "doc_id",
                "doc_key",
                "n_words",
                (F.col("place.at") - F.col("window.offset")).alias("start"),
                F.size("window.window_words").alias("length"),
                "place",
                "window",
            )
            .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
            .where(
                F.slice(F.col("place.around"), window - F.col("window.offset"), F.col("length"))
                == F.col("window.window_words")
            )
            .select("doc_id", "doc_key", "start", "length", F.col("window.window_items").alias("its"))
        )
    exact = lines[0]
    for more in lines[1:]:
        exact = exact.unionByName(more)
    exact = written(exact, "window-hits")
    spans = exact.groupBy("doc_id", "doc_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("hits")
    )
    items = (
        exact.select("doc_id", "doc_key", F.explode("its").alias("item"))
        .groupBy("doc_id", "doc_key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        F.col("hits"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda state, hit: F.struct(
            F.greatest(state["end"], hit["start"] + hit["length"]).alias("end"),
            (
                state["total"]
                + F.greatest(F.lit(0), hit["start"] + hit["length"] - F.greatest(state["end"], hit["start"]))
            ).alias("total"),
        ),
        lambda state: state["total"],
    )
    base = found[0][0].select("doc_id", "doc_key", F.col("n_words").cast("long").alias("n_words"))

    def same(left: str, right: str) -> Column:
        return (F.col(f"{left}.doc_key") == F.col(f"{right}.doc_key")) & F.col(
            f"{left}.doc_id"
        ).eqNullSafe(F.col(f"{right}.doc_id"))

    return (
        base.alias("d")
        .join(spans.alias("s"), same("d", "s"), "left")
        .join(items.alias("i"), same("d", "i"), "left")
        .select(
            "d.doc_id",
            "d.doc_key",
            "n_words",
            F.coalesce("hits", F.array()).alias("hits"),
            F.coalesce("items", F.array()).alias("items"),
            F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        )
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options
) -> DataFrame:
    """The documents without any hit word, columns as they came."""
    key, other, other_key = free_names(docs, "doc_key", "hit_id", "hit_key")
    hit = (
        find_hits(docs, benchmark, text=text, doc_id=doc_id, **options)
        .where("n_hit > 0")
        .select(F.col("doc_id").alias(other), F.col("doc_key").alias(other_key))
        .distinct()
    )
    keyed = docs.withColumn(key, document_key(doc_id, text))
    same = (F.col(key) == F.col(other_key)) & quoted(doc_id).eqNullSafe(F.col(other))
    return keyed.join(hit, same, "left_anti").drop(key)
