"""Language identification with language-bitmask n-gram filters.

Training counts byte n-grams per language over all labelled texts and keeps those with a minimum
share of their language's n-grams (so at most 1/share per language, whatever the corpus).  They go
into one bit-sliced Bloom filter: arrays of 64-bit masks, one array for every 64 languages, bit l of a slot set by language l.  The
AND of an n-gram's slots names every language that may contain it.

A text's n-grams are looked up whole; per language the set bits are counted, the count expected
from the filter's false positives is taken off, and the best corrected share wins (ties: the
language with more training n-grams).  The share is the score.

Texts that are null or hold no letter are ``und`` with score 0.  A text whose n-grams no language
knows gets the commonest language and score 0.  With nothing to learn from, every text is ``und``.
Existing columns with the names of the new ones are replaced; other columns pass through, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from velorank.llm import textcodes as X
from velorank.llm.common import private, remainder
from velorank.session import materialize

GRAM = 5                            # bytes in an n-gram
MIN_SHARE = 1e-5                    # of its language's n-grams: at most 100,000 n-grams a language
SLOT_BITS, HASHES = 20, 3
UNDETERMINED = "und"
_KEYS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_CLEAN = np.full(256, 0x20, np.uint8)
_CLEAN[65:91] = np.arange(97, 123)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the texts' n-grams and where each text's begin.  Letters only, lower-cased; all else
    is a blank, one is added at both ends, and n-grams over two blanks in a row are left out."""
    buf, at = X.padded(_CLEAN[data], offsets, 1, 1, 0x20)
    n = len(buf) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    code = np.zeros(n, np.uint64)
    for i in range(GRAM):
        code |= buf[i:n + i].astype(np.uint64) << np.uint64(8 * i)
    blank = buf == 0x20
    double = np.concatenate([np.zeros(1, np.int32), np.cumsum(blank[:-1] & blank[1:], dtype=np.int32)])
    ok = double[GRAM - 1:GRAM - 1 + n] == double[:n]
    kept = np.flatnonzero(ok)
    return code[kept], np.searchsorted(kept, at)


def _slots(codes: np.ndarray) -> list[np.ndarray]:
    h = X.mix(codes)
    return [((h * np.uint64(k)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for k in _KEYS[:HASHES]]


@dataclass
class LanguageModel:
    languages: list[str]            # the commonest first
    masks: np.ndarray               # the bit-sliced filter
    false_rate: np.ndarray          # per language: chance that an n-gram outside it shows its bit


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """Learn from all rows with a language and a text."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches):
        counters: dict[str, X.Counter] = {}

        def out(name, got):
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(got[0]), pa.string()), pa.array(got[0].astype(np.int64)), pa.array(got[1].astype(np.int64))],
                ["lang", "gram", "n"])

        for b in batches:
            order = pc.sort_indices(b.column("lang"))
            names = b.column("lang").take(order).to_pylist()
            texts = b.column("text").take(order)
            for i, j, data, offsets in X.chunks(texts):
                codes, at = _grams(data, offsets)
                k = i
                while k < j:
                    m = k
                    while m < j and names[m] == names[k]:
                        m += 1
                    counters.setdefault(names[k], X.Counter()).add(codes[at[k - i]:at[m - i]])
                    k = m
            for name, c in counters.items():
                if c.full() and (got := c.drain()):
                    yield out(name, got)
        for name, c in counters.items():
            if got := c.drain():
                yield out(name, got)

    counts = materialize(rows.mapInArrow(count, "lang string, gram long, n long")
                         .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), "lang").collect()
    names = [r["lang"] for r in totals]
    masks = np.zeros((max(1, -(-len(names) // 64)), 1 << SLOT_BITS), np.uint64)
    if names:
        known = F.broadcast(rows.sparkSession.createDataFrame(
            [(r["lang"], i, r["total"] * MIN_SHARE) for i, r in enumerate(totals)], "lang string, bit long, least double"))

        def slots(batches):
            for b in batches:
                codes = b.column("gram").to_numpy(zero_copy_only=False).astype(np.uint64)
                bit = b.column("bit").to_numpy(zero_copy_only=False)
                word, mask = pa.array(bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64)
                for s in _slots(codes):
                    yield pa.RecordBatch.from_arrays([word, pa.array(s), pa.array(mask.view(np.int64))], ["word", "slot", "mask"])

        kept = counts.join(known, "lang").where((F.col("n") >= F.col("least")) & (F.col("n") > 1)).select("gram", "bit")
        # at most 2**SLOT_BITS rows for 64 languages reach the driver
        found = kept.mapInArrow(slots, "word long, slot long, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        masks[found.column("word").to_numpy(), found.column("slot").to_numpy()] = found.column("mask").to_numpy().astype(np.int64).view(np.uint64)
    fill = np.array([np.count_nonzero(masks[i // 64] & (np.uint64(1) << np.uint64(i % 64))) for i in range(len(names))]) / masks.shape[1]
    return LanguageModel(names, masks, fill ** HASHES)


def _scores(model: LanguageModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(best language, score) per text."""
    n, k = len(column), len(model.languages)
    best, score = np.zeros(n, np.int64), np.zeros(n)
    for i, j, data, offsets in X.chunks(column):
        codes, at = _grams(data, offsets)
        hit = None
        for s in _slots(codes):
            hit = model.masks[:, s] if hit is None else hit & model.masks[:, s]
        counts = np.stack([X.segment_sums((hit[m // 64] >> np.uint64(m % 64)) & np.uint64(1), at) for m in range(k)])
        share = counts / np.maximum(np.diff(at), 1)
        fixed = np.maximum(share - model.false_rate[:, None], 0) / (1 - np.minimum(model.false_rate[:, None], 0.999))
        best[i:j] = fixed.argmax(0)
        score[i:j] = np.clip(fixed.max(0), 0, 1)
    return best, score


def classify(df: DataFrame, model: LanguageModel, text: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """``df`` with the predicted language and score."""
    src = df.drop(lang_out, score_out)
    flagged = src.withColumn(private(src, "_letter")[0], F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))
    schema = T.StructType([*src.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)
    width = len(src.columns)

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], object)
        for b in batches:
            letter = b.column(width).to_numpy(zero_copy_only=False)
            if m.languages:
                best, score = _scores(m, b.column(src_names.index(text)))
            else:
                best, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            best = np.where(letter, best, len(m.languages))
            score = np.where(letter, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], pa.array(names[best], pa.string()), pa.array(score)], [*b.schema.names[:width], lang_out, score_out])

    src_names = src.columns
    return flagged.mapInArrow(run, schema)


def training_rows(docs: DataFrame, mod: int = 3, held: int = 1, doc_id: str = "doc_id") -> DataFrame:
    """Rows whose crc32(doc_id) mod ``mod`` is not ``held``; a null id is never learned from."""
    return docs.where(remainder(F.col(doc_id), mod) != held)


def held_out(doc_id: Column, mod: int = 3, held: int = 1) -> Column:
    return F.coalesce(remainder(doc_id, mod) == held, F.lit(False))
