"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts up to ``order`` bytes holds frozen counts. A
byte that a context has seen costs its share among the context's bytes and escapes
(method C: as many escapes as distinct bytes); otherwise an escape is paid and the next
shorter context asked, down to 8 bits for a byte never seen. A language with an unseen
context pays nothing to leave it. The language that codes the text in fewest bits wins.

For scoring, the cost of every (order + 1)-gram that any language has seen is worked out
once, for all languages; other places fall back order by order. Texts are handled in
slices, so memory does not follow their length.

``fit`` counts over a sample of about ``sample_bytes`` a language, in the order of a hash
of the text: the texts that come first, at least one, each of them once and up to that many
bytes of it. Nothing but counts reaches the driver, at most ``order + 1`` a sampled byte.

Results: a null text, or one without a letter, is ``und`` with score 0, as is every text
if no language was learned. Ties go to the first language by name. The score is the
winner's share of the probability that the languages give the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import quoted

ORDER = 3
SAMPLE_BYTES = 1_000_000
PLACES = 1_000_000_000  # of the order in which texts are sampled
SLICE_BYTES = 1 << 19
SLOTS = 20  # bits of the direct table in front of the highest order
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Grams ending at each byte from the ORDER-th on, as big-endian numbers."""
    n = len(data) - ORDER
    value = np.zeros(n, dtype=np.uint32)
    for k in range(size):
        at = ORDER - size + 1 + k
        value = (value << np.uint32(8)) | data[at : at + n].astype(np.uint32)
    return value


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


@dataclass
class Model:
    """Sorted grams and, per order, their cost in bits for each language."""

    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)  # by order: (order + 1)-grams
    costs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)  # by order: contexts seen
    escapes: list[np.ndarray] = field(default_factory=list)
    slots: np.ndarray | None = None

    def bits(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Cost of each gram's last byte after the ``order`` bytes before it."""
        if order < 0:
            return np.full((len(grams), len(self.languages)), 8.0, dtype=np.float32)
        mask = np.uint32(2 ** (8 * (order + 1)) - 1)
        grams = grams & mask
        keys = self.keys[order]
        if order == ORDER:
            at = self.slots[(grams * np.uint32(2654435761)) >> np.uint32(32 - SLOTS)]
            wrong = np.flatnonzero(keys[at] != grams)
            at[wrong] = np.searchsorted(keys, grams[wrong]).clip(max=len(keys) - 1)
            missing = wrong[keys[at[wrong]] != grams[wrong]]
        else:
            at = np.searchsorted(keys, grams).clip(max=len(keys) - 1)
            missing = np.flatnonzero(keys[at] != grams)
        costs = self.costs[order][at]
        if len(missing):
            lost = grams[missing]
            costs[missing] = self.bits(lost, order - 1) + self.leaving(lost >> np.uint32(8), order)
        return costs

    def leaving(self, contexts: np.ndarray, order: int) -> np.ndarray:
        """Cost of an escape from each context, 0 for a language that has not seen it."""
        known = self.contexts[order]
        at = np.searchsorted(known, contexts).clip(max=len(known) - 1)
        return np.where((known[at] == contexts)[:, None], self.escapes[order][at], np.float32(0))

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        total = np.zeros((len(texts), len(self.languages)))
        lead = b"\n" * ORDER
        held, owners, size = [], [], 0

        def flush() -> None:
            nonlocal held, owners, size
            if not held:
                return
            data = np.frombuffer(b"".join(held), dtype=np.uint8)
            costs = self.bits(_grams(data, ORDER + 1), ORDER).astype(np.float64)
            starts = np.cumsum([0] + [len(part) for part in held[:-1]])
            # The grams that end in the lead of the next part are nobody's.
            for owner, start, part in zip(owners, starts, held):
                total[owner] += costs[start : start + len(part) - ORDER].sum(axis=0)
            held, owners, size = [], [], 0

        for owner, body in enumerate(texts):
            for at in range(0, len(body), SLICE_BYTES):
                before = body[max(at - ORDER, 0) : at]
                held.append((lead + before)[-ORDER:] + body[at : at + SLICE_BYTES])
                owners.append(owner)
                size += len(held[-1])
                if size >= SLICE_BYTES:
                    flush()
        flush()
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        usable = [bool(t) and bool(self.languages) and _LETTER.search(t) is not None for t in texts]
        bits = self.text_bits([_bytes(t) if u else b"" for t, u in zip(texts, usable)])
        names, scores = [], []
        for u, row in zip(usable, bits):
            if not u:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(row.argmin())
            names.append(self.languages[best])
            scores.append(float(1 / np.exp2(np.maximum(row[best] - row, -1000.0)).sum()))
        return names, scores


def build(counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Model:
    """The model from each language's sorted grams and counts, by order."""
    model = Model(sorted(counts))
    n = len(model.languages)
    if not n:
        return model
    for order in range(ORDER + 1):
        keys = np.unique(np.concatenate([counts[name][order][0] for name in model.languages]))
        seen = np.zeros((len(keys), n))
        for k, name in enumerate(model.languages):
            grams, times = counts[name][order]
            seen[np.searchsorted(keys, grams), k] = times
        contexts, inverse = np.unique(keys >> np.uint32(8), return_inverse=True)
        totals, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
        np.add.at(totals, inverse, seen)
        np.add.at(kinds, inverse, (seen > 0).astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, np.log2((totals + kinds) / kinds), 0.0)
            own = np.log2((totals + kinds)[inverse] / seen)
        below = model.bits(keys, order - 1)
        model.keys.append(keys)
        model.costs.append(np.where(seen > 0, own, escape[inverse] + below).astype(np.float32))
        model.contexts.append(contexts)
        model.escapes.append(escape.astype(np.float32))
        if order == ORDER:
            model.slots = np.zeros(1 << SLOTS, dtype=np.int32)
            common = np.argsort(seen.sum(axis=1), kind="stable")  # the most frequent comes last
            model.slots[(keys[common] * np.uint32(2654435761)) >> np.uint32(32 - SLOTS)] = common
    return model


def fit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES
) -> Model:
    """Learn from documents with text and language."""
    labelled = docs.where(quoted(lang).isNotNull() & (F.octet_length(quoted(text)) > 0)).select(
        quoted(lang).alias("lang"), quoted(text).alias("text")
    )
    labelled = labelled.withColumn("place", F.pmod(F.xxhash64("text"), F.lit(PLACES)))
    # Long texts count as what is read of them, so that a few of them leave room for others.
    held = F.sum(F.least(F.octet_length("text"), F.lit(sample_bytes)).cast("long"))
    ends = {
        r["lang"]: max(r["first"] + 1, int(PLACES * min(1.0, sample_bytes / r["held"])))
        for r in labelled.groupBy("lang").agg(held.alias("held"), F.min("place").alias("first")).collect()
    }
    if not ends:
        return build({})
    end = F.lit(0).cast("long")
    for name, value in ends.items():
        end = F.when(F.col("lang") == name, F.lit(value)).otherwise(end)
    # A text that many rows hold is taken once; its copies meet before the texts travel.
    chosen = labelled.where(F.col("place") < end).dropDuplicates(["lang", "text"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(b"\n" * ORDER + _bytes(body)[:sample_bytes], dtype=np.uint8)
                for order in range(ORDER + 1):
                    grams, times = np.unique(_grams(data, order + 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(grams)),
                            pa.array(np.full(len(grams), order, dtype=np.int32)),
                            pa.array(grams.astype(np.int64)),
                            pa.array(times.astype(np.int64)),
                        ],
                        ["lang", "ord", "gram", "times"],
                    )

    found = (
        chosen.mapInArrow(count, "lang string, ord int, gram long, times long")
        .groupBy("lang", "ord", "gram")
        .agg(F.sum("times").alias("times"))
        .toPandas()
        .sort_values(["lang", "ord", "gram"])
    )
    counts: dict[str, list] = {}
    for (name, order), part in found.groupby(["lang", "ord"]):
        tables = counts.setdefault(name, [None] * (ORDER + 1))
        tables[order] = (part["gram"].to_numpy().astype(np.uint32), part["times"].to_numpy())
    return build(counts)


def predicted(docs: DataFrame, model: Model, *, text: str = "text") -> Column:
    """A struct of lang_pred and score; the model goes out as one broadcast, bounded by fit's sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = [], []
            for at in range(0, len(texts), 256):
                one = shared.value.predict(texts.slice(at, 256).to_pylist())
                names += one[0]
                scores += one[1]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return predict(quoted(text))
