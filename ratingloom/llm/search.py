"""Ranked lexical search over bags: documents that score alike are scored once.

1. Items are dealt into blocks of about VOCABULARY distinct words, normally one. For a
   block, one pass over the texts counts each document's words and keeps of them only those
   that an item of the block has: its bag, the sorted word numbers with their counts. The
   number of documents with a word, of all words, and of documents per item word are exact.
2. Documents with equal bags and equal length norm get equal scores for every item. Classes
   are named by a hash and confirmed by the bag itself, since both are part of the grouping
   key. Of a class the ``k`` smallest ids can reach a result, so each map task sends at most
   ``k`` rows of it to the shuffle, however many documents are alike.
3. A task scores its classes against all items of the block through the words' postings, in
   slices of bounded size, and keeps per item the ``k`` best (score, doc_id). What all tasks
   kept is ranked once more by the same order.

Scores are 64-bit integers, as the formula in ``weight`` and ``scored`` states. Results: a
document without a word is no document of the collection; one without an item word scores 0
and is not listed, so an item may have fewer than ``k`` rows or none. Equal scores go by
ascending doc_id, a null id last. Rows that repeat are documents of their own, each with a
rank of its own; so are repeated items, each of them ranked by itself. Null texts have no
words. Texts are read whole. Other columns of either table are not looked at.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from ratingloom.llm.common import quoted, written

VOCABULARY = 200_000  # words of the items of one block, about
SLICE_CELLS = 2_000_000  # scores, and posting entries, that are held at once
SLICE_CLASSES = 512

#: Maps a byte to itself if it belongs to a word (A-Z lower-cased), else to a blank.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def words_of(body: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and bytes above 0x7F, A-Z lower-cased."""
    return (body or b"").translate(_FOLD).split()


def item_words(items: DataFrame) -> DataFrame:
    """item_row, word and how often, of a table with item_row and body."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words, times = [], [], []
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words_of(body)).items():
                    rows.append(row)
                    words.append(word)
                    times.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(words, pa.binary()), pa.array(times, pa.int64())],
                ["item_row", "word", "times"],
            )

    return items.select("item_row", "body").mapInArrow(count, "item_row long, word binary, times long")


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_words and the bag: 32-bit word numbers in order, then their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lengths, held = [], []
                for body in part.column(1):
                    words = words_of(body.as_py())
                    found = sorted((vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary)
                    lengths.append(len(words))
                    held.append(np.array(found, dtype=np.int32).T.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), pa.array(held, pa.binary())],
                    ["doc_id", "n_words", "bag"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "body").mapInArrow(count, f"doc_id {id_type}, n_words long, bag binary")


def _opened(bag: bytes) -> np.ndarray:
    """Two rows: word numbers and counts."""
    return np.frombuffer(bag, dtype=np.int32).reshape(2, -1)


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """For each word number the documents whose bag has it; a task sends each word once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for bag in batch.column(0):
                found[_opened(bag.as_buffer())[0]] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], ["word", "docs"])

    rows = held.select("bag").mapInArrow(count, "word long, docs long").groupBy("word").agg(F.sum("docs"))
    counts = np.zeros(size, dtype=np.int64)
    for word, docs in rows.collect():
        counts[word] = docs
    return counts


def weight(documents: int, with_word: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_word + 1)))


def classes_of(held: DataFrame, norm: str, k: int) -> DataFrame:
    """bag, m and the ``k`` smallest ids (null last) of each class of documents that score alike."""
    alike = ["bag_hash", "m", "bag"]
    named = held.where("length(bag) > 0").select("doc_id", "bag", F.expr(norm).alias("m"))
    named = named.withColumn("bag_hash", F.xxhash64("bag", "m"))
    in_order = Window.partitionBy(*alike).orderBy(F.col("doc_id").asc_nulls_last())
    firsts = named.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k)
    members = F.sort_array(F.collect_list(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")))
    return firsts.groupBy(*alike).agg(members.alias("members")).select("bag", "m", "members")


class Postings:
    """For each word number its weight, and the items (by number) that have it, with repeats counted."""

    def __init__(self, entries: list[tuple[int, int, int]], size: int, n_items: int) -> None:
        table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 3)
        self.items, self.times = table[:, 1], table[:, 2]
        self.starts = np.searchsorted(table[:, 0], np.arange(size + 1))
        self.n_items = n_items
        self.weights = np.zeros(size, dtype=np.int64)

    def scored(self, of: np.ndarray, words: np.ndarray, tf: np.ndarray, m: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` classes (rows) for all items; ``of``, ``words``, ``tf``, ``m`` run over bag entries."""
        value = self.weights[words] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        first = self.starts[words]
        counts = self.starts[words + 1] - first
        at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        scores = np.zeros(n * self.n_items, dtype=np.int64)
        cell = np.repeat(of, counts) * self.n_items + self.items[at]
        np.add.at(scores, cell, np.repeat(value, counts) * self.times[at])
        return scores.reshape(n, self.n_items)


def best_of(classes: DataFrame, postings: Postings, item_rows: list[int], k: int) -> DataFrame:
    """item_row, doc_id and score: per task and item the ``k`` best."""

    def slices(batches: Iterator[pa.RecordBatch]):
        held, entries = [], 0
        at_once = max(1, min(SLICE_CLASSES, SLICE_CELLS // postings.n_items))
        for batch in batches:
            for bag, m, members in zip(*(batch.column(i) for i in range(3))):
                held.append((_opened(bag.as_py()), m.as_py(), [(x["none"], x["doc_id"]) for x in members.as_py()]))
                words = held[-1][0][0]
                entries += int((postings.starts[words + 1] - postings.starts[words]).sum())
                if len(held) == at_once or entries > SLICE_CELLS:
                    yield held
                    held, entries = [], 0
        if held:
            yield held

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in range(postings.n_items)]
        least = np.ones(postings.n_items, dtype=np.int64)  # a score below this cannot enter
        for part in slices(batches):
            sizes = [bag.shape[1] for bag, _, _ in part]
            words, tf = np.concatenate([bag for bag, _, _ in part], axis=1).astype(np.int64)
            m = np.repeat(np.array([m for _, m, _ in part], dtype=np.int64), sizes)
            scores = postings.scored(np.repeat(np.arange(len(part)), sizes), words, tf, m, len(part))
            enough = least
            if len(part) > k:
                enough = np.maximum(least, np.partition(scores, len(part) - k, axis=0)[len(part) - k])
            for row, item in zip(*np.nonzero(scores >= enough)):
                for none, doc_id in part[row][2]:
                    entry, top = (-int(scores[row, item]), none, doc_id), best[item]
                    if len(top) == k and entry >= top[-1]:
                        break
                    insort(top, entry)
                    del top[k:]
                if len(best[item]) == k:
                    least[item] = max(1, -best[item][-1][0])
        rows = [(item_rows[item], doc_id, -score) for item, top in enumerate(best) for score, _, doc_id in top]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], id_arrow),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["item_row", "doc_id", "score"],
        )

    id_type = classes.schema["members"].dataType.elementType["doc_id"].dataType
    id_arrow = to_arrow_type(id_type)
    return classes.mapInArrow(rank, f"item_row long, doc_id {id_type.simpleString()}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 of each item."""
    corpus = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("binary").alias("body"))
    asked = items.select(quoted(item_id).alias("item_id"), quoted(item_text).cast("binary").alias("body"))
    asked = written(asked.withColumn("item_row", F.monotonically_increasing_id()), "items")
    counted = written(item_words(asked), "item-words")
    blocks = max(1, -(-counted.count() // vocabulary))
    block = F.pmod(F.xxhash64("item_row"), F.lit(blocks))
    parts, documents, length = [], 0, 0
    for b in range(blocks):
        entries = [tuple(r) for r in counted.where(block == b).collect()]
        number = {word: i for i, word in enumerate(sorted({word for _, word, _ in entries}))}
        rows = sorted({row for row, _, _ in entries})
        place = {row: i for i, row in enumerate(rows)}
        held = written(bags(corpus, number), "bags")
        if b == 0:
            documents, length = held.where("n_words > 0").agg(F.count("*"), F.sum("n_words")).first()
        if not documents or not rows:
            continue
        listed = [(number[word], place[row], times) for row, word, times in entries]
        postings = Postings(listed, len(number), len(rows))
        postings.weights[:] = [weight(documents, int(n)) for n in document_counts(held, len(number))]
        # In decimals, as the product may pass 64 bits where the quotient does not.
        norm = f"25 + cast(75 * cast(n_words AS decimal(19,0)) * {documents} AS decimal(38,0)) div {length}"
        parts.append(best_of(classes_of(held, norm, k), postings, rows, k))
    id_type = corpus.schema["doc_id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_row long, doc_id {id_type}, score long")
    for part in parts:
        found = found.unionByName(part)
    in_order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")
