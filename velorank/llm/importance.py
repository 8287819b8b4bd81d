"""Resampling of documents towards a target distribution by hashed n-gram importance weights.

Features are runs of one and two words, counted in ``BUCKETS`` hash buckets, once over all documents
and once over the target texts.  The buckets' log ratios are an array of gains that every task holds; a
document's weight is the mean gain of its features.  With seeded Gumbel noise the highest scores are a
draw without replacement, in proportion to the weights.

The cutoff is found without sorting the documents: a quantile sketch proposes nested brackets of scores
around it, one exact count of the rows above and inside validates them, and the narrowest valid one
holds it.  The widest spans all scores, so a valid one exists however wrong the sketch is.  Only the
bracket's rows are sorted to find the last drawn one; then the drawn rows are numbered by a
distributed sort.

Null texts have no words; a text without features has weight 0.  A null id is hashed as the empty
string and comes after all others in ties; rows of the same id and score are drawn in the order of their
place in the table.  Repeated rows are documents of their own.  Other columns are ignored, whatever
their names.  An empty table gives no rows; without target texts all gains come from the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from velorank.llm.textcodes import LOWERED, chunks, segment_sums
from velorank.operators.rank import global_rank
from velorank.session import materialize

BUCKETS = 10_000
MIN_WORDS = 20
SHARE = (25, 100)                  # of the documents with MIN_WORDS words
SEED = 7
ACCURACY = 10_000                  # of the sketch: ranks are within 1 / ACCURACY of all rows

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_U32, _ONES = np.uint32, np.uint32(0xFFFFFFFF)
_STEP = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], _U32)   # crc32 is linear in its input
LONG = 64                          # bytes; longer words take the plain way


def _zeros(c: np.ndarray) -> np.ndarray:
    """The checksum's state after one more zero byte."""
    return _STEP[c & _U32(255)] ^ (c >> _U32(8))


def _shift_tables() -> np.ndarray:
    """[n, k, b]: what byte b at place k of a state becomes after n zero bytes."""
    out = np.empty((LONG + 1, 4, 256), _U32)
    out[0] = np.arange(256, dtype=_U32) << (_U32(8) * np.arange(4, dtype=_U32))[:, None]
    for n in range(LONG):
        out[n + 1] = _zeros(out[n])
    return out


_SHIFT = _shift_tables()


def _shifted(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = _SHIFT[n, 0, c & _U32(255)]
    for k in (1, 2, 3):
        out ^= _SHIFT[n, k, (c >> _U32(8 * k)) & _U32(255)]
    return out


def append(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings in a row from their own and the second's size."""
    out, left = first.copy(), size.copy()
    while (long := np.flatnonzero(left > LONG)).size:
        out[long] = _shifted(out[long], np.full(len(long), LONG))
        left[long] -= LONG
    return _shifted(out, left) ^ second


def word_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every word: all words together, byte by byte, longest first."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, left = starts[order], -size[order]
    state = np.full(len(starts), _ONES)
    for j in range(min(LONG, -int(left[0]) if len(left) else 0)):
        m = int(np.searchsorted(left, -j, "left"))           # words of more than j bytes
        state[:m] = _STEP[(state[:m] ^ data[at[:m] + j]) & _U32(255)] ^ (state[:m] >> _U32(8))
    out = np.empty_like(state)
    out[order] = state ^ _ONES
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return out


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, bucket of the pair it begins, is there a pair, where each text's words start)."""
    data = LOWERED[data]
    word = _IS_WORD[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    one = word_checksums(data, starts, ends)
    pair = np.ones(len(starts), bool)
    pair[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False   # a text's last word begins none
    i = np.flatnonzero(pair)
    spaced = append(one[i], np.full(len(i), zlib.crc32(b" "), _U32), np.ones(len(i), np.int64))
    two = np.zeros(len(starts), np.int64)
    two[i] = append(spaced, one[i + 1], (ends - starts)[i + 1]) % BUCKETS
    return (one % BUCKETS).astype(np.int64), two, pair, bounds


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of every bucket in all texts; a task hands out ``BUCKETS`` rows at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                one, two, pair, _ = text_features(data, offsets)
                total += np.bincount(one, minlength=BUCKETS) + np.bincount(two[pair], minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(hit, pa.int64()), "n": pa.array(total[hit], pa.int64())})

    counted = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of every bucket's smoothed shares, floored."""
    s, t = documents.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight), one row per document."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                one, two, pair, bounds = text_features(data, offsets)
                n_words = np.diff(bounds)
                n = n_words + np.maximum(n_words - 1, 0)
                total = segment_sums(gain[one] + np.where(pair, gain[two], 0), bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(np.where(n > 0, total // np.maximum(n, 1), 0), pa.int64())],
                    names=["doc_id", "n_words", "n_features", "weight"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate drawn from the id's hash, floored."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def bracket(rows: DataFrame, value: str, n: int, wanted: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, rows above high): the narrowest of the sketch's brackets that holds the ``wanted``-th
    highest of ``n`` values, by exact counts outside."""
    middle, widths = 1 - wanted / n, [2.0 ** k / accuracy for k in range(1, accuracy.bit_length())]
    sides = [*widths, 1.0]
    lows, highs = [max(0.0, middle - w) for w in sides], [min(1.0, middle + w) for w in sides]
    bounds = rows.agg(F.percentile_approx(value, [*lows, *highs], accuracy).alias("q"),
                      F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    pairs = [*zip(bounds["q"][:len(sides)], bounds["q"][len(sides):]), (bounds["lo"], bounds["hi"])]
    counts = rows.agg(*[F.count_if(F.col(value) > h).alias(f"above{i}") for i, (_, h) in enumerate(pairs)],
                      *[F.count_if(F.col(value) >= lo).alias(f"from{i}") for i, (lo, _) in enumerate(pairs)]).first()
    for i, (low, high) in enumerate(pairs):
        if counts[f"above{i}"] < wanted <= counts[f"from{i}"]:
            return low, high, counts[f"above{i}"]
    raise AssertionError("the widest bracket holds every row")


def draw(scored: DataFrame, share: tuple[int, int], min_words: int) -> DataFrame:
    """Add ``rank`` (1, 2, 3... by score, ties by id and place; null for rows not drawn) to a written table with
    ``_row``, ``doc_id``, ``n_words`` and ``score``."""
    able = scored.where(F.col("n_words") >= min_words)
    n = able.count()
    wanted = share[0] * n // share[1]
    if wanted == 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    low, high, above = bracket(able, "score", n, wanted)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    inside, _ = global_rank(able.where(F.col("score").between(low, high)).select("score", "doc_id", "_row"), order, "_place")
    last = inside.where(F.col("_place") == wanted - above).first()
    later_id = F.coalesce(F.col("doc_id") < F.lit(last["doc_id"]), F.col("doc_id").isNotNull() & F.lit(last["doc_id"] is None))
    tied = F.col("doc_id").eqNullSafe(F.lit(last["doc_id"])) & (F.col("_row") <= last["_row"])
    taken = (F.col("n_words") >= min_words) & (
        (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (later_id | tied)))
    ranked, _ = global_rank(scored.where(taken), order, "rank")
    return ranked.unionByName(scored.where(~taken).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    scored = weigh(docs, gain, doc_id, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    return draw(scored, share, min_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
