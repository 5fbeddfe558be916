"""Importance resampling of documents towards a target collection.

Hashed n-gram counts of all documents and of the target give every bucket a gain, the scaled logarithm of how much likelier
the target is to draw it.  A document weighs the sum of the gains of its n-grams; noise seeded by its id is added, and the
documents with the highest sums are drawn, which is a draw without replacement in proportion to the weights.

Words come from bytes: a table of 256 entries lower-cases A-Z and blanks the separators (UTF-8 bytes above 0x7F belong to
words), ``bytes.split`` gives the words, and a longer n-gram continues the CRC-32 of the shorter one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.llm.common import store
from storeops.llm.rolling import text_chunks

SCALE = 1000  # gains and noise are whole multiples of 1 / SCALE
BINS = 4096  # of the score histogram that locates the cut
KNOWN_WORDS = 1 << 18  # words whose value a task remembers

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    """The defaults are the production parameters."""

    n: int = 1  # features are runs of 1 to n words
    buckets: int = 10_000
    seed: int = 2024
    min_words: int = 20
    percent: int = 10


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Memo(dict):
    """A function of a word, remembered for at most KNOWN_WORDS words."""

    def __init__(self, of: Callable[[bytes], int]):
        super().__init__()
        self.of = of

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = self.of(word)
        return value


def longer_runs(words: list[bytes], n: int) -> Iterator[list[int]]:
    """The CRC-32 of every run of 2, 3 … n words joined by a space, each continued from the run before."""
    spaced = [b" " + w for w in words]
    crc = [zlib.crc32(w) for w in words]
    for k in range(1, min(n, len(words))):
        crc = [zlib.crc32(w, c) for w, c in zip(spaced[k:], crc)]
        yield crc


def bucket_counts(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """bucket, count over all features of the column ``text`` (null: none); a task sends at most one row per bucket."""
    n, buckets = settings.n, settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        bucket = Memo(lambda w: zlib.crc32(w) % buckets)
        for batch in batches:
            for _, _, part in text_chunks(batch):
                seen: Counter[bytes] = Counter()
                for text in part:
                    words = words_of(text)
                    seen.update(words)
                    for crc in longer_runs(words, n) if n > 1 else ():
                        total += np.bincount(np.array(crc, np.int64) % buckets, minlength=buckets)
                at = np.fromiter(map(bucket.__getitem__, seen), np.int64, len(seen))
                np.add.at(total, at, np.fromiter(seen.values(), np.int64, len(seen)))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "count"])

    return texts.select("text").mapInArrow(run, "bucket int, count long").groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(source: DataFrame, target: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """The gain of every bucket; reads two tables of at most ``buckets`` rows."""
    counts = []
    for df in (source, target):
        got = df.toArrow()
        counts.append(np.zeros(settings.buckets))
        counts[-1][got["bucket"].to_numpy()] = got["count"].to_numpy()
    s, t = counts
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + settings.buckets) / ((s + 1) * (t.sum() + settings.buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    n, buckets = settings.n, settings.buckets
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = Memo(lambda w: int(gain[zlib.crc32(w) % buckets]))
        for batch in batches:
            for first, end, texts in text_chunks(batch):
                rows = np.zeros((3, len(texts)), np.int64)
                for i, text in enumerate(texts):
                    words = words_of(text)
                    count, weight = len(words), sum(map(gain_of.__getitem__, words))
                    for crc in longer_runs(words, n) if n > 1 else ():
                        count += len(crc)
                        weight += int(gain[np.array(crc, np.int64) % buckets].sum())
                    rows[:, i] = len(words), count, weight
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), *map(pa.array, rows)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Scaled Gumbel noise of an id, from the first 32 bits of SHA-256 of ``seed:id``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; only drawn rows have a rank.

    Only rows above a cut of the score histogram, which hold all drawn ones, are sorted, by ranges.
    """
    fit = F.col("n_words") >= settings.min_words
    scored = scored.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), settings.seed)).cast("long"))
    # the row number parts repeated rows; stored, as it depends on how the input was read
    rows = store(scored.withColumn("row", F.monotonically_increasing_id()), "resample_scores")
    able = rows.where(fit & F.col("score").isNotNull())
    n, low, high = able.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    wanted = settings.percent * n // 100
    if not wanted:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    width = (high - low) // BINS + 1
    histogram = able.groupBy(F.call_function("div", F.col("score") - low, F.lit(width)).alias("bin")).count().orderBy(F.desc("bin")).collect()  # at most BINS rows
    above, cut = 0, low
    for bin_, count in histogram:
        above += count
        if above >= wanted:
            cut = low + bin_ * width
            break
    likely = fit & F.coalesce(F.col("score") >= cut, F.lit(False))
    first = ranked(rows.where(likely), [], [-F.col("score"), F.col("doc_id"), F.col("n_features"), F.col("row")], "rank")
    out = first.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank").cast("long")))
    rest = rows.where(~likely).withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, weight, score, rank (1 for the highest score; null: not drawn) for every row of ``docs``.

    ``docs`` has doc_id and text, ``target`` has text.  Null, empty and wordless texts have no features and weigh 0; the
    whole of a long text counts.  Repeated rows are drawn each on its own and have equal scores and neighbouring ranks.
    Equal scores go to the smaller doc_id.  A row without doc_id has neither score nor rank and is not counted among those
    to draw from.  An empty table gives an empty result, an empty target only differs by the smoothing.  Other columns are
    not looked at.  Select the rows with a rank and join them by id for the drawn documents.
    """
    gain = gains(bucket_counts(docs, settings), bucket_counts(target, settings), settings)
    return draw(weights(docs, gain, settings), settings)


def oracle() -> str:
    """DuckDB SQL of the operator with its default settings; CRC-32 by a table that follows from its polynomial."""
    s = Settings()
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH RECURSIVE shifts(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shifts WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS l FROM shifts WHERE k = 8
), docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS ws FROM documents
), tokens AS (SELECT row, unnest(ws) AS w FROM docs
), per_doc AS (SELECT row, w, count(*) AS n FROM tokens GROUP BY 1, 2
), wanted AS (SELECT w, count(*) AS t FROM (SELECT unnest({words}) AS w FROM benchmark) GROUP BY 1
), held AS (SELECT w, sum(n) AS s FROM per_doc GROUP BY 1
), vocab AS (SELECT w, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM held FULL JOIN wanted USING (w)
), hashed AS (
  SELECT w, s, t, xor(list_reduce(
    list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
    lambda a, b: xor(crc_table.l[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) % {s.buckets} AS bucket
  FROM vocab, crc_table
), counts AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY 1
), gain AS (
  SELECT bucket, floor({SCALE} * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + {s.buckets})::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + {s.buckets})::DOUBLE)))::BIGINT AS gain FROM counts
), weighed AS (
  SELECT row, sum(n * gain)::BIGINT AS weight FROM per_doc JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1
), scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-{SCALE} * ln(-ln((('0x' || substr(sha256('{s.seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (row)
), placed AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= {s.min_words} AND score IS NOT NULL DESC, score DESC, doc_id, n_features) AS place,
    count(*) FILTER (n_features >= {s.min_words} AND score IS NOT NULL) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {s.percent} * able // 100 THEN place END AS rank FROM placed"""
