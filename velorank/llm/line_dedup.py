"""Line deduplication with a suffix array over line ids by distributed prefix doubling.

A text is the sequence of its lines that hold a word.  Lines that occur once in the corpus can't be
part of a repeated run, so only repeated lines are ordered.  Their suffixes are ranked by prefix
doubling: the first ranks order single lines, every round ranks (rank, rank 2**k lines on) by a
distributed sort, and after K rounds suffixes stand in the order of their first 2**K lines.  Equal
ranks at a level are the intervals of the suffix array whose longest common prefix has that length;
two overlapping ranks give the interval of any length.

A run counts when its lines hold at least ``MIN_WORDS`` words.  The smallest such runs that begin
or end at each line cover exactly the maximal repeated runs, so K is set by the longest of these.
Every run whose interval has an earlier occurrence (smaller doc_id, then place in the text; it may
overlap) is deleted: the first copy of a passage stays, later ones go, inside one text as well.

Null or blank texts are returned as they are.  Null ids come after all others.  Rows with the same
id and text are one document and get the same result.  Columns named like the new ones are replaced;
all others pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from velorank.llm import textcodes as X
from velorank.llm.common import private
from velorank.operators.rank import global_rank
from velorank.session import materialize

MIN_WORDS = 25
LAST_ID = (1 << 63) - 1
DOC = ["_d", "_h"]


def _keys(doc_id: str, text: str) -> dict:
    return {"_d": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)), "_h": F.xxhash64(F.col(text), F.lit(2))}


def _lines(batches):
    """(_d, _h, line, raw, c1, c2, words) of every line with a word, by numpy on chunks of texts."""
    for b in batches:
        for i, j, data, offsets in X.chunks(b.column("text")):
            n = len(data)
            if not n:
                continue
            breaks = np.flatnonzero(data == 10)
            # a break at the very end of a text starts its last line where the next text starts: it is empty, leave it out
            text_of_break = np.searchsorted(offsets, breaks, "right") - 1
            ends_text = breaks + 1 == offsets[text_of_break + 1]
            starts = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks[~ends_text] + 1]))
            doc = np.searchsorted(offsets, starts, "right") - 1
            stops = np.minimum(np.append(starts[1:], n), offsets[doc + 1])
            stops = stops - (data[stops - 1] == 10)                  # the break itself is not part of the line
            space = X.IS_SPACE[data]
            begins = ~space
            begins[1:] &= space[:-1]
            begins[offsets[:-1][offsets[:-1] < n]] = ~space[offsets[:-1][offsets[:-1] < n]]
            upto = np.concatenate([[0], np.cumsum(begins)])
            words = upto[stops] - upto[starts]
            first = np.searchsorted(doc, np.arange(j - i))           # each text's first line
            raw = np.arange(len(doc)) - first[doc]
            some = np.flatnonzero(words > 0)
            own = doc[some]
            line = np.arange(len(some)) - np.searchsorted(own, np.arange(j - i))[own]
            c1, c2 = X.segment_codes(data, starts[some], stops[some])
            yield pa.RecordBatch.from_arrays(
                [b.column(c).slice(i, j - i).take(pa.array(own)) for c in DOC]
                + [pa.array(line, pa.int32()), pa.array(raw[some], pa.int32()), pa.array(c1.view(np.int64)),
                   pa.array(c2.astype(np.uint32).view(np.int32)), pa.array(words[some], pa.int32())],
                names=[*DOC, "line", "raw", "c1", "c2", "words"])


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_d, _h, line, raw, c1, c2, words): every line with a word, its place among those and among all lines.
    Two codes name a line: 96 bits."""
    keyed = docs.select(*[v.alias(k) for k, v in _keys(doc_id, text).items()], F.col(text).cast("string").alias("text"))
    return keyed.mapInArrow(_lines, "_d long, _h long, line int, raw int, c1 long, c2 int, words int")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Lines that occur more than once, with the first ranks in ``r``: a written table."""
    again = materialize(lines.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2"), "line-repeated")
    ranked, _ = global_rank(again, ["c1", "c2"], "r")
    return materialize(lines.join(ranked, ["c1", "c2"]).drop("c1", "c2").dropDuplicates([*DOC, "line"]), "line-ranks")


def double(suffixes: DataFrame, k: int) -> DataFrame:
    """Ranks by the first 2**(k + 1) lines in ``r``, the former ones kept in ``ranks``."""
    ahead = W.partitionBy(*DOC).orderBy("line").rangeBetween(2 ** k, 2 ** k)
    pairs = materialize(suffixes.withColumn("r2", F.coalesce(F.max("r").over(ahead), F.lit(0))), "suffix-pairs")
    ranked, _ = global_rank(pairs.select("r", "r2").distinct(), ["r", "r2"], "_next")
    named = pairs.join(materialize(ranked, "suffix-names"), ["r", "r2"])
    return materialize(named.withColumn("ranks", F.array_append("ranks", F.col("_next"))).drop("r", "r2").withColumnRenamed("_next", "r"), "suffix-ranks")


def _runs(batches):
    """(document, start, lines): the smallest runs of consecutive lines with MIN_WORDS words from each line on
    and up to each line.  Rows come sorted by document and line; a batch's last document is carried over."""
    held = None

    def runs(t: pa.Table):
        d, h, line, n = (t.column(c).to_numpy() for c in ("_d", "_h", "line", "words"))
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (line[1:] != line[:-1] + 1)
        part = np.cumsum(new)
        upto = np.cumsum(n.astype(np.int64))
        before = upto - n
        rows = np.arange(len(d))
        last = np.searchsorted(upto, before + MIN_WORDS)             # first row that completes a run from each row
        ok = last < len(d)
        ok[ok] = part[last[ok]] == part[ok]
        a, b = [rows[ok]], [last[ok]]
        first = np.searchsorted(before, upto - MIN_WORDS, "right") - 1  # last row from which a run up to each row is complete
        ok = first >= 0
        ok[ok] = part[first[ok]] == part[ok]
        a, b = np.concatenate([*a, first[ok]]), np.concatenate([*b, rows[ok]])
        both = np.unique(np.stack([a, b]), axis=1) if len(a) else np.empty((2, 0), np.int64)
        a, b = both
        return pa.RecordBatch.from_arrays([pa.array(d[a]), pa.array(h[a]), pa.array(line[a]), pa.array((b - a + 1).astype(np.int32))],
                                          ["_d", "_h", "start", "n"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        d, h = t.column("_d").to_numpy(), t.column("_h").to_numpy()
        if not len(d):
            continue
        other = np.flatnonzero((d != d[-1]) | (h != h[-1]))
        end = int(other[-1]) + 1 if len(other) else 0
        held = t.slice(end)
        if end:
            yield runs(t.slice(0, end).combine_chunks())
    if held is not None:
        yield runs(held.combine_chunks())


def deleted_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_d, _h, deleted): numbers of the lines to delete, per document that has any."""
    lines = materialize(line_table(docs, doc_id, text), "lines")
    suffixes = repeated_lines(lines)
    runs = materialize(suffixes.select(*DOC, "line", "words").repartition(*DOC).sortWithinPartitions(*DOC, "line")
                       .mapInArrow(_runs, "_d long, _h long, start int, n int"), "line-runs")
    longest = runs.agg(F.max("n").alias("n")).first()["n"] or 1
    suffixes = materialize(suffixes.withColumn("ranks", F.array("r")), "suffix-ranks")
    for k in range(longest.bit_length() - 1):
        suffixes = double(suffixes, k)
    # the interval of a run's n lines: the ranks by 2**k lines at its start and 2**k lines before its end
    level = F.floor(F.log2(F.col("n").cast("double") + 0.5)).cast("int")
    at = lambda c: suffixes.select(*DOC, F.col("line").alias(c), F.col("ranks").alias(f"ranks_{c}"))
    named = runs.withColumn("k", level).withColumn("tail", (F.col("start") + F.col("n") - F.expr("shiftleft(1, k)")).cast("int")) \
        .join(at("start"), [*DOC, "start"]).join(at("tail"), [*DOC, "tail"]) \
        .select(*DOC, "start", "n", F.get("ranks_start", F.col("k")).alias("i1"), F.get("ranks_tail", F.col("k")).alias("i2"))
    named = materialize(named, "run-intervals")
    place = F.struct(*DOC, "start")
    firsts = materialize(named.groupBy("n", "i1", "i2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
                         .where("copies > 1").drop("copies"), "interval-firsts")
    later = named.join(firsts, ["n", "i1", "i2"]).where(place != F.col("first"))
    gone = later.select(*DOC, F.explode(F.expr("sequence(start, start + n - 1)")).alias("line")).distinct()
    return gone.join(lines.select(*DOC, "line", "raw").distinct(), [*DOC, "line"]).groupBy(*DOC).agg(F.array_sort(F.collect_list("raw")).alias("deleted"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the text without later copies, ``n_lines``, ``deleted_lines`` (numbers from 0) and ``n_deleted``."""
    d, h, deleted = private(docs, *DOC, "_deleted")
    gone = materialize(deleted_lines(docs, doc_id, text), "deleted-lines").toDF(d, h, deleted)
    rows = docs.drop("n_lines", "deleted_lines", "n_deleted").withColumns(dict(zip((d, h), _keys(doc_id, text).values(), strict=True)))
    # texts are dealt out at every size; the hash side is the line numbers
    joined = rows.join(gone.hint("shuffle_hash"), [d, h], "left")
    n_lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    parts = F.split(F.col(text), "\n")            # of the texts that lose lines only
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(deleted))
    # F.transform over the places left keeps the order and is linear in the lines
    kept = F.transform(F.array(parts), lambda p: F.array_join(F.transform(left, lambda i: F.get(p, i)), "\n"))[0]
    return joined.withColumns({
        "n_lines": F.coalesce(n_lines, F.lit(0)).cast("long"), "deleted_lines": F.coalesce(deleted, F.array().cast("array<int>")),
        text: F.when(F.col(deleted).isNull(), F.col(text)).otherwise(kept)}).withColumn(
        "n_deleted", F.size("deleted_lines").cast("long")).drop(d, h, deleted)
