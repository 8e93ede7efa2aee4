"""Near-duplicates by min-max hashing, with every link confirmed on full shingle sets.

A permutation gives both its minimum and its maximum over a set, so 75 hash evaluations
a shingle give 150 signature values: 30 bands of 5. Two sets with similarity 0.8 miss
each other in all bands with probability 7e-6, more similar ones far less.

1. One pass over the texts gives each document its set's size, identity and bands.
   Equal sets become one class; from here on a class counts once.
2. In each bucket with two classes or more, every class is compared with one hub, the
   class that meets most others over all its buckets. The links found make components.
3. Buckets that still hold different components beside the hub are compared in full, in
   cells of bounded size: every class outside the bucket's largest component against all
   classes of other components. A cell gives back at most one link per class and
   component, so a group of copies never becomes all its pairs.

Shingles are 64-bit hashes and sets are named by 128-bit digests. Results: a null text,
or one without words, has an empty set and is linked with nothing; a text of fewer words
than a shingle has one shingle, its whole sequence. A document without id is linked like
any other, but names no component; where a component has no id at all, all its rows are
kept. Rows that share id and text share their result. ``keep_one`` keeps one row of each
component, whatever the ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import free_names, lookup_join, quoted, written
from ratingloom.llm.components import components

BANDS, BAND_ROWS = 30, 5
PERMUTATIONS = BANDS * BAND_ROWS // 2
SLICE_BYTES = 1 << 21  # of text that one round of array work takes
CELL_HASHES = 200_000  # in one side of a cell
GROUP_HASHES = 1_000_000  # in one call of the cell function
LONG_WORD = 64  # bytes

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BAND_FACTORS = _random.integers(0, 2**63, (BANDS, BAND_ROWS), dtype=np.uint64) * _U(2) + _U(1)
_BAND_SEEDS = _random.integers(0, 2**63, BANDS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of non-blank bytes.

    A word is a polynomial modulo 2^64, mixed. For words of some hundred bytes and more,
    equal polynomials can be written down at will, so long words are digested one by one.
    """
    data = np.frombuffer(body, dtype=np.uint8)
    solid = np.empty(len(data) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_not(_BLANK[data], out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[0::2], edges[1::2]
    powers = np.full(len(data) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    inverse = np.full(len(data) + 1, _BASE_INVERSE, dtype=np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * powers[:-1], out=sums[1:])
    found = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        found[k] = int.from_bytes(blake2b(body[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return starts, found


def _document_words(text: str) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased; long texts go slice by slice, cut at blanks."""
    body = text.encode("utf-8", "surrogatepass").lower()
    if len(body) <= SLICE_BYTES:
        return word_hashes(body)[1]
    parts, at = [], 0
    while at < len(body):
        cut = min(at + SLICE_BYTES, len(body))
        while cut < len(body) and not _BLANK[body[cut]]:
            cut += 1
        parts.append(word_hashes(body[at:cut])[1])
        at = cut
    return np.concatenate(parts)


def _shingled(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    if not len(words):
        return words
    n = min(size, len(words))
    count = len(words) - n + 1
    value = np.full(count, n, dtype=np.uint64)
    for k in range(n):
        value = value * _BASE + words[k : k + count]
        value ^= value >> _U(29)
    return np.unique(_mixed(value))


def text_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order; short texts share the array work."""
    at = 0
    while at < len(texts):
        group, held = [], 0
        while at < len(texts) and (not group or held < SLICE_BYTES):
            group.append(texts[at] or "")
            held += len(group[-1])
            at += 1
        if len(group) == 1:
            yield _shingled(_document_words(group[0]), size)
            continue
        bodies = [t.encode("utf-8", "surrogatepass").lower() for t in group]
        ends = np.cumsum([len(b) + 1 for b in bodies])
        starts, hashes = word_hashes(b"\n".join(bodies))
        cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
        for k in range(len(group)):
            yield _shingled(hashes[cuts[k] : cuts[k + 1]], size)


def bands_of(hashes: np.ndarray) -> np.ndarray:
    """The bucket of a set in each band."""
    low = np.full(PERMUTATIONS, 2**64 - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        part = _FACTORS[:, None] * hashes[None, at : at + 2048] + _SHIFTS[:, None]
        part ^= part >> _U(32)
        np.minimum(low, part.min(axis=1), out=low)
        np.maximum(high, part.max(axis=1), out=high)
    values = np.concatenate([low, high]).reshape(BAND_ROWS, BANDS).T
    with np.errstate(over="ignore"):
        return _mixed((values * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SEEDS).view(np.int64)


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """doc_key, doc_id, n_shingles, set_id and buckets of every document."""
    id_type = docs.schema[doc_id].dataType
    rows = docs.select(
        F.xxhash64(quoted(doc_id), quoted(text)).alias("doc_key"),
        quoted(doc_id).alias("doc_id"),
        quoted(text).alias("text"),
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, names, buckets = [], [], []
                for hashes in text_sets(part.column(2).to_pylist(), size):
                    n.append(len(hashes))
                    names.append(_digest(hashes) if len(hashes) else None)
                    buckets.append(bands_of(hashes) if len(hashes) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(n, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(buckets, pa.list_(pa.int64())),
                    ],
                    ["doc_key", "doc_id", "n_shingles", "set_id", "buckets"],
                )

    return rows.mapInArrow(
        sign,
        f"doc_key long, doc_id {id_type.simpleString()}, n_shingles long, set_id binary, buckets array<long>",
    )


def full_sets(docs: DataFrame, wanted: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """set_id and hashes (little-endian 64-bit) of the documents whose doc_key is wanted."""
    rows = docs.select(
        F.xxhash64(quoted(doc_id), quoted(text)).alias("doc_key"), quoted(text).alias("text")
    ).join(wanted.select("doc_key"), "doc_key", "left_semi")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = list(text_sets(batch.slice(at, 256).column(1).to_pylist(), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["set_id", "hashes"],
                )

    return rows.mapInArrow(fill, "set_id binary, hashes binary")


def _similar(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (u, v) those whose full sets are similar enough."""
    by_v = lookup_join(
        pairs, sets.select(F.col("set_id").alias("v"), F.col("hashes").alias("v_hashes")), "v", "u", how="inner"
    )
    by_u = lookup_join(
        by_v, sets.select(F.col("set_id").alias("u"), F.col("hashes").alias("u_hashes")), "u", "v", how="inner"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(a.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(b.as_buffer(), dtype=np.uint64)
                if len(y) < len(x):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(_similar(common, len(x), len(y), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return by_u.select("u", "v", "u_hashes", "v_hashes").mapInArrow(test, "u binary, v binary")


def cell_links(rows: pd.DataFrame, percent: int) -> list[tuple[bytes, bytes]]:
    """One link at most from each minor class of a cell to each other component."""
    minor, other = rows[rows["minor"]], rows[~rows["minor"]]
    if not len(minor) or not len(other):
        return []
    sets = [np.frombuffer(h, dtype=np.uint64) for h in other["hashes"]]
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    names, groups = other["set_id"].tolist(), other["component"].tolist()
    links = []
    for name, group, held in zip(minor["set_id"], minor["component"], minor["hashes"]):
        mine = np.frombuffer(held, dtype=np.uint64)
        first, last = np.searchsorted(every, mine), np.searchsorted(every, mine, side="right")
        counts = last - first
        total = int(counts.sum())
        if not total:
            continue
        places = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total)
        common = np.bincount(owner[places], minlength=len(sets))
        found = np.flatnonzero(100 * common >= percent * (sizes + len(mine) - common))
        linked = {group}
        for k in found:
            if groups[k] not in linked:
                linked.add(groups[k])
                links.append((name, names[k]))
    return links


def remaining_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components that share a bucket.

    ``members``: bucket, set_id, n_shingles, component.
    """
    per = members.groupBy("bucket", "component").agg(
        F.count("*").alias("held"), F.sum("n_shingles").alias("weight")
    )
    buckets = written(
        per.groupBy("bucket")
        .agg(
            F.max_by("component", F.struct("held", "component")).alias("largest"),
            F.count("*").alias("groups"),
            F.sum("weight").alias("weight"),
            (F.sum("weight") - F.max_by("weight", F.struct("held", "component"))).alias("minor_weight"),
        )
        .where("groups > 1"),
        "mixed-buckets",
    )
    open_ = lookup_join(members, buckets, "bucket", "set_id", how="inner")
    cells = F.ceil(F.col("weight") / CELL_HASHES).cast("int")
    minor_cells = F.ceil(F.col("minor_weight") / CELL_HASHES).cast("int")
    own = F.xxhash64("set_id", F.lit(1))
    every = open_.select(
        "bucket",
        "set_id",
        "component",
        "n_shingles",
        F.lit(False).alias("minor"),
        F.explode(F.sequence(F.lit(0), minor_cells - 1)).alias("i"),
        F.pmod(own, cells.cast("long")).cast("int").alias("j"),
    )
    minors = open_.where("component != largest").select(
        "bucket",
        "set_id",
        "component",
        "n_shingles",
        F.lit(True).alias("minor"),
        F.pmod(own, minor_cells.cast("long")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), cells - 1)).alias("j"),
    )
    placed = written(every.unionByName(minors), "cell-members")
    total = placed.agg(F.sum("n_shingles")).first()[0]
    if not total:
        return placed.select(F.col("set_id").alias("u"), F.col("set_id").alias("v")).limit(0)
    groups = -(-total // GROUP_HASHES)
    placed = placed.withColumn("g", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(groups)))
    filled = lookup_join(placed, sets, "set_id", "g", how="inner")

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, cell in frame.groupby(["bucket", "i", "j"], sort=False):
            links += cell_links(cell, percent)
        return pd.DataFrame(links, columns=["u", "v"])

    return filled.groupBy("g").applyInPandas(link, "u binary, v binary")


def linked_classes(
    docs: DataFrame, shingle: int, percent: int, text: str, doc_id: str
) -> tuple[DataFrame, DataFrame]:
    """The signatures of all documents, and of each class (set_id) its least_id and its component."""
    signed = written(signatures(docs, shingle, text, doc_id), "signatures")
    usable = signed.where("set_id IS NOT NULL")
    classes = usable.groupBy("set_id").agg(
        F.min("doc_key").alias("doc_key"),
        F.min("doc_id").alias("least_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("buckets").alias("buckets"),
    )
    classes = written(classes, "classes")
    placed = classes.select("set_id", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    members = written(lookup_join(placed, shared, "bucket", "set_id", how="inner"), "members")
    met = written(members.groupBy("set_id").agg(F.sum("held").alias("met")), "met")
    hubs = (
        members.select("bucket", "set_id")
        .join(met, "set_id")
        .groupBy("bucket")
        .agg(F.max_by("set_id", F.struct("met", "set_id")).alias("hub"))
    )
    starred = written(lookup_join(members, hubs, "bucket", "set_id"), "starred")
    size = classes.select(F.col("set_id").alias("hub"), F.col("n_shingles").alias("hub_n"))
    pairs = starred.where("hub != set_id").select("set_id", "hub", "n_shingles").distinct()
    near = lookup_join(pairs, size, "hub", "set_id").where(
        (100 * F.least("n_shingles", "hub_n") >= percent * F.greatest("n_shingles", "hub_n"))
    )
    wanted = classes.join(met, "set_id", "left_semi").select("doc_key")
    sets = written(full_sets(docs, wanted, shingle, text, doc_id), "full-sets")
    links = written(
        confirmed(near.select(F.col("hub").alias("u"), F.col("set_id").alias("v")), sets, percent), "links"
    )
    first = written(components(links), "components")

    rest = starred.where("held > 2 AND set_id != hub")
    labelled = lookup_join(
        rest.select("bucket", "set_id", "n_shingles"),
        first.select(F.col("node").alias("set_id"), "component"),
        "set_id",
        "bucket",
    ).withColumn("component", F.coalesce("component", "set_id"))
    more = written(remaining_links(written(labelled, "labelled"), sets, percent), "more-links")
    final = first
    if not more.isEmpty():
        final = written(components(links.unionByName(more)), "components")

    labels = final.select(F.col("node").alias("set_id"), "component")
    classed = classes.select("set_id", "least_id").join(labels, "set_id", "left")
    return signed, written(classed.withColumn("component", F.coalesce("component", "set_id")), "labels")


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 4,
    percent: int = 80,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One line per document: doc_key, doc_id, n_shingles, component_id, kept.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of
    ``shingle`` consecutive words. component_id is the smallest id that links reach.
    """
    signed, classed = linked_classes(docs, shingle, percent, text, doc_id)
    ids = classed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = lookup_join(classed, ids, "component", "set_id").select("set_id", "component_id")
    result = lookup_join(signed.drop("buckets"), written(of_class, "class-ids"), "set_id", "doc_key")
    component_id = F.coalesce("component_id", "doc_id")
    return result.select(
        "doc_key",
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col("doc_id"), component_id.isNull()).alias("kept"),
    )


def keep_one(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The documents with one row of each component: of smallest id (null last), then smallest doc_key.

    Of rows that are equal in id and text one stays, whichever; rows without words all stay.
    """
    key, other, other_id = free_names(docs, "doc_key", "gone_key", "gone_id")
    signed, classed = linked_classes(docs, shingle, percent, text, doc_id)
    held = lookup_join(signed.select("set_id", "doc_id", "doc_key"), classed.select("set_id", "component"), "set_id", "doc_key", how="inner")
    units = written(held.groupBy("component", "doc_id", "doc_key").agg(F.count("*").alias("rows")), "units")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key")
    winners = units.groupBy("component").agg(F.min(place).alias("winner"))
    stays = F.col("winner").eqNullSafe(place)
    chosen = written(lookup_join(units, winners, "component", "doc_key").withColumn("stays", stays), "chosen")
    keyed = docs.withColumn(key, F.xxhash64(quoted(doc_id), quoted(text)))

    def matching(rows: DataFrame) -> tuple[DataFrame, Column]:
        named = rows.select(F.col("doc_key").alias(other), F.col("doc_id").alias(other_id))
        return named, (F.col(key) == F.col(other)) & quoted(doc_id).eqNullSafe(F.col(other_id))

    several = chosen.where("stays AND rows > 1")
    if several.isEmpty():
        return keyed.join(*matching(chosen.where("NOT stays")), "left_anti").drop(key)
    alone = keyed.join(*matching(chosen.where("NOT stays OR rows > 1")), "left_anti")
    # Hundreds of equal rows shrink to one per task before the shuffle.
    first = keyed.join(*matching(several), "left_semi").dropDuplicates([key, doc_id])
    return alone.unionByName(first).drop(key)
