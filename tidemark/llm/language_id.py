"""Language ID by language-bitmask n-gram filters.

Learning: in a bounded sample of labelled texts (about
``SAMPLE_PER_LANGUAGE`` documents of each language, chosen by a hash of
their id), the n-grams that at least ``MIN_SHARE`` of a language's
documents hold are put into that language's Bloom filter; of fewer than
``1 / MIN_SHARE`` documents, one is enough.  All filters
share their size and hash functions and lie bit-sliced side by side: slot
i holds one bit per language, so the conjunction of an n-gram's slots is
the mask of all languages that contain it.

Prediction reads nothing but the whole text: each n-gram's mask is looked
up, and the bits are counted per language.  A filter with a share f of
false positives shows ``true + f * (n - true)`` of n n-grams, so the
count is corrected to ``(shown - f * n) / (1 - f)``; a full filter (f = 1)
says nothing and counts as 0.  The language with
the highest corrected count wins, the first by name of equals; the score
is that count's share of all n-grams.

The model has a fixed size (``SLOTS`` words of 64 languages), whatever
the input, and is broadcast.  Null texts and texts without a letter are
``und`` with score 0, and so is everything when no language was learned.
The outcome tells the two apart: ``no letter``, ``unlearned``, or else
``predicted``.  Null labels and null ids are not learned from.  Repeated rows are
predicted each on its own.  An empty table gives an empty result.  Other
input columns come back inside ``row``.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import field, packed, quoted, result, share, texts, trim
from tidemark.llm.hashing import chunks, mix

GRAM = 4
SLOTS = 1 << 19
HASHES = 3
MIN_SHARE = 0.02
SAMPLE_PER_LANGUAGE = 3000
UNKNOWN = "und"
PREDICTED, UNLEARNED, NO_LETTER = "predicted", "unlearned", "no letter"  # outcomes


class Filters:
    """Bloom filters of all languages, bit-sliced: ``slots[w, i]`` holds bit b of language 64 * w + b."""

    def __init__(self, languages: list[str], slots: np.ndarray | None = None):
        self.languages = languages
        self.slots = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint64) if slots is None else slots
        full = np.array([np.mean(self.slots[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))])
        self.false_share = full ** HASHES

    @classmethod
    def of(cls, languages: list[str], language: np.ndarray, grams: np.ndarray) -> Filters:
        """Filters of n-grams, each of the language with that number."""
        slots = cls(languages).slots
        for place in places(grams):
            np.bitwise_or.at(slots, (language // 64, place), np.uint64(1) << (language % 64).astype(np.uint64))
        return cls(languages, slots)

    def without_empty(self) -> Filters:
        """The same without languages that have no n-gram."""
        some = np.flatnonzero(self.false_share > 0).tolist()
        if len(some) == len(self.languages):
            return self
        out = Filters([self.languages[k] for k in some])
        for new, k in enumerate(some):
            out.slots[new // 64] |= (self.slots[k // 64] >> np.uint64(k % 64) & np.uint64(1)) << np.uint64(new % 64)
        return Filters(out.languages, out.slots)

    def counts(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Corrected counts of the n-grams that each language contains: (documents, languages)."""
        n = np.diff(first)
        shown = np.zeros((len(n), len(self.languages)))
        some = np.flatnonzero(n)
        at = list(places(grams))
        for w in range(len(self.slots)):
            mask = self.slots[w][at[0]]
            for place in at[1:]:
                mask &= self.slots[w][place]
            for k in range(64 * w, min(64 * w + 64, len(self.languages))):
                if len(some):
                    shown[some, k] = np.add.reduceat(mask >> np.uint64(k % 64) & np.uint64(1), first[:-1][some])
        usable = self.false_share < 1  # a full filter holds everything: no evidence
        out = np.zeros(shown.shape)
        out[:, usable] = (shown[:, usable] - self.false_share[usable] * n[:, None]) / (1 - self.false_share[usable])
        return out


def places(grams: np.ndarray):
    """An n-gram's slots: disjoint bits of its hash."""
    bits = SLOTS.bit_length() - 1
    for k in range(HASHES):
        yield (grams >> np.uint64(k * bits) & np.uint64(SLOTS - 1)).astype(np.int64)


def letters() -> np.ndarray:
    """Which code points are letters; made once per Python worker."""
    kept = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if "letters" not in kept:
        kept["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return kept["letters"]


def ngrams(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the lower-cased letters of each text, with one space for whatever stands
    between words and at both ends; and the number of n-grams before each text."""
    points = np.frombuffer("\0".join(["", *[d.lower().replace("\0", " ") for d in docs], ""]).encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[points]
    ends = points == 0  # between texts
    stay = is_letter | ends
    stay[1:] |= is_letter[:-1]  # the first of what follows a word
    points, is_letter, ends = points[stay], is_letter[stay], ends[stay]
    stay = is_letter | ends
    stay[:-1] |= ~ends[1:]  # the end of a text stands for the space before it
    points, is_letter, ends = points[stay], is_letter[stay], ends[stay]
    values = np.where(is_letter, points, 32).astype(np.uint64)
    n = max(0, len(values) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out * np.uint64(0x9E3779B97F4A7C15) + values[k:k + n] + np.uint64(1)
    bounds = np.flatnonzero(ends)
    start, stop = bounds[:-1], np.maximum(bounds[1:] - GRAM + 2, bounds[:-1])
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, np.minimum(start, n), 1)
    np.add.at(inside, np.minimum(stop, n), -1)
    inside = np.cumsum(inside[:-1]) > 0
    before = np.concatenate([[0], np.cumsum(inside)])
    return mix(out[inside]), np.append(before[np.minimum(start, n)], before[-1])


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
          sample_per_language: int = SAMPLE_PER_LANGUAGE, min_share: float = MIN_SHARE) -> Filters:
    """Filters from the labelled documents outside the held-out fold."""
    labelled = docs.select(F.col(quoted(key)).cast("string").alias("id"), F.col(quoted(text)).cast("string").alias("text"),
                           F.col(quoted(label)).cast("string").alias("lang")).filter(
        "id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("id")))
    many = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}  # as many rows as languages
    if not many:
        return Filters([])
    rate = F.create_map(*[F.lit(x) for lang, n in many.items() for x in (lang, min(1.0, sample_per_language / n))])
    chance = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(chance < F.element_at(rate, F.col("lang"))).select("lang", F.struct("text").alias("doc"))
    held = sample.mapInArrow(document_counts, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    sizes = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    if not sizes:
        return Filters([])
    least = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min_share * n)])
    held = held.filter(F.col("docs") >= F.element_at(least, F.col("lang")))
    # bits of the slots are set in Spark: at most SLOTS rows for 64 languages come to the driver, whatever the n-grams
    languages = sorted(sizes)
    number = F.element_at(F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)]), F.col("lang"))
    bits = SLOTS.bit_length() - 1
    places_of = F.array(*[F.shiftright("gram", k * bits).bitwiseAND(SLOTS - 1) for k in range(HASHES)])
    found = held.select(number.alias("k"), F.explode(places_of).alias("slot")).groupBy(
        F.floor(F.col("k") / 64).cast("int").alias("w"), "slot").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("k") % 64).cast("int"))).alias("bits")).toArrow()
    slots = Filters(languages).slots
    slots[found.column("w").to_numpy(), found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Filters(languages, slots).without_empty()


def held_out(key):
    """The fold that is never learned from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_counts(batches):
    """In how many documents of a batch each n-gram occurs, by language."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist())
        docs = [t.decode() for t in texts(batch)]
        for lang in np.unique(langs):
            mine = [docs[i] for i in np.flatnonzero(langs == lang)]
            every = []
            for a, b in chunks(mine):
                grams, first = ngrams(mine[a:b])
                every += [np.unique(grams[x:y]) for x, y in zip(first[:-1], first[1:], strict=True)]
            gram, many = np.unique(np.concatenate(every), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(many)],
                                             ["lang", "gram", "docs"])


def identify(docs: DataFrame, filters: Filters, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``text``, ``lang_pred``, ``score`` (0 to 1) and ``outcome``."""
    shared = share(docs.sparkSession, filters)
    given = packed(docs, key, text, carry)
    return given.mapInArrow(lambda batches: predict(batches, shared()), result(given, "text string, lang_pred string, score double, outcome string"))


def predict(batches, filters: Filters):
    for batch in batches:
        docs = [t.decode() for t in texts(batch)]
        langs, scores, outcomes = [], [], []
        for a, b in chunks(docs):
            has_letter = letter_flags(docs[a:b])
            outcomes += [(PREDICTED if filters.languages else UNLEARNED) if some else NO_LETTER for some in has_letter]
            if not filters.languages:
                langs += [UNKNOWN] * (b - a)
                scores += [0.0] * (b - a)
                continue
            grams, first = ngrams(docs[a:b])
            counts = filters.counts(grams, first)
            best = counts.argmax(axis=1)
            share = np.clip(counts.max(axis=1) / np.maximum(1, np.diff(first)), 0, 1)
            langs += [filters.languages[k] if some else UNKNOWN for k, some in zip(best.tolist(), has_letter, strict=True)]
            scores += [s if some else 0.0 for s, some in zip(share.tolist(), has_letter, strict=True)]
        yield pa.RecordBatch.from_arrays([field(batch, "row"), field(batch, "text"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                          pa.array(outcomes, pa.string())], ["row", "text", "lang_pred", "score", "outcome"])
    trim()


def letter_flags(docs: list[str]) -> list[bool]:
    return [any(map(str.isalpha, d)) for d in docs]
