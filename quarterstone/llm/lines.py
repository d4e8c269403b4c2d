"""Line dedup: later copies of repeated line runs are deleted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import drop_stored, stored, tidied
from quarterstone.llm.runs import repeated_windows

LEAST_WORDS = 10  # words of a run from which on its repetition counts
TEXT_KEYS = ["text1", "text2"]  # 128 bits that tell texts apart


def _text_keys(names: list[str]) -> list[Column]:
    return [F.xxhash64("text").alias(names[0]), F.xxhash64(F.lit(29), "text").alias(names[1])]


def window_lengths(words: np.ndarray, least: int) -> list[list[int]]:
    """For each line, the lengths of the windows that begin there and hold at least ``least`` words
    but would not without their last (or their first) line. Every run of at least ``least`` words is
    the union of such windows inside it."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    lengths: list[set[int]] = [set() for _ in range(n)]
    stops = np.searchsorted(total, total[:-1] + least)  # the first end with enough words
    begins = np.searchsorted(total, total[1:] - least, side="right") - 1  # the last begin with enough
    for i in range(n):
        if stops[i] <= n:
            lengths[i].add(int(stops[i]) - i)
        if begins[i] >= 0:
            lengths[int(begins[i])].add(i + 1 - int(begins[i]))
    return [sorted(x) for x in lengths]


def _line_batches(least: int):
    names = ["uid", "doc_id", *TEXT_KEYS, "line", "pos", "key1", "key2", "lengths"]

    def run(batches):
        for batch in batches:
            out = [[] for _ in names]
            for *document, text in zip(*(batch.column(c).to_pylist() for c in (*names[:4], "text"))):
                lines = [(i, raw) for i, x in enumerate(text.split("\n"))
                         if (raw := x.encode("utf-8", "surrogatepass")).strip(b" \t\n\r\x0b\x0c")]
                if not lines:
                    continue
                words = np.fromiter((len(raw.split()) for _, raw in lines), np.int64, len(lines))
                digests = [xxhash.xxh3_128_intdigest(raw) for _, raw in lines]
                for column, value in zip(out, document):
                    column += [value] * len(lines)
                out[4] += [i for i, _ in lines]
                out[5] += range(len(lines))
                out[6] += [(d >> 64) - (1 << 63) for d in digests]
                out[7] += [(d & ((1 << 64) - 1)) - (1 << 63) for d in digests]
                out[8] += window_lengths(words, least)
            kinds = [*[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
    return run


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of every document with ``text`` freed of later copies of repeated line runs, and
    ``lines`` (its lines before) and ``removed`` (their 0-based numbers).

    Lines end at line feeds; two are equal if their bytes are. A run is a stretch of lines of one
    document, blank ones not counted; it is repeated if the same lines follow each other elsewhere,
    in the same document or another, and counts if it has ``least_words`` words or more. Of a
    repeated run the first stays, in the order of doc_id (null last), line number; a document that
    repeats a doc_id with another text follows in the order of two hashes of its text, and an exact
    repetition of a row loses all lines that are in a run. A null text stays null; blank lines stay,
    as do texts without repeated runs, as they are. Columns named lines or removed are replaced, all others stay
    whatever their names.
    """
    kept = [c for c in docs.columns if c not in ("lines", "removed")]
    # the given columns travel as one, so that no name meets one used here
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in kept if c != "text"]).alias("_row"))
    texts = (rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_text_keys(TEXT_KEYS), "text")
             .filter(F.col("text").isNotNull()).withColumn("uid", F.monotonically_increasing_id()))
    raw = stored(texts.mapInArrow(tidied(_line_batches(least_words)),
                                  "uid long, doc_id long, text1 long, text2 long, line int, pos long, key1 long, key2 long, lengths array<int>"), "raw-lines")
    # one row for each distinct document; ascending ids over range partitions number them in order
    numbered = stored(raw.filter("pos = 0").groupBy("doc_id", *TEXT_KEYS).agg(F.min("uid").alias("uid"))
                      .orderBy(F.col("doc_id").asc_nulls_last(), *TEXT_KEYS)
                      .select("uid", F.monotonically_increasing_id().alias("seq")), "documents")
    lines = stored(raw.join(numbered, "uid").drop("uid")
                   .withColumn("at", (F.col("seq").cast("decimal(19,0)") * F.lit(10 ** 10).cast("decimal(11,0)")
                                      + F.col("pos").cast("decimal(10,0)")).cast("decimal(38,0)")), "lines")
    drop_stored(raw)
    windows = repeated_windows(lines.select("seq", "pos", "at", "key1", "key2", "lengths"))
    covered = (windows.select("seq", F.explode(F.sequence("pos", F.col("pos") + F.col("length") - 1)).alias("pos")).distinct())
    gone = (lines.select("seq", "pos", "doc_id", *TEXT_KEYS, "line").join(covered, ["seq", "pos"])
            .groupBy("doc_id", *TEXT_KEYS).agg(F.sort_array(F.collect_set("line")).alias("_gone"))
            .select(F.col("doc_id").alias("_gone_id"), *(F.col(k).alias(f"_gone_{k}") for k in TEXT_KEYS), "_gone"))
    keys = [f"_{k}" for k in TEXT_KEYS]
    again = Window.partitionBy("_id", *keys).orderBy(F.lit(1))
    same = F.equal_null("_id", "_gone_id")
    for k in TEXT_KEYS:
        same &= F.col(f"_{k}") == F.col(f"_gone_{k}")
    marked = (rows.withColumn("_id", F.col("doc_id").cast("bigint")).select("*", *_text_keys(keys))
              .join(stored(gone, "gone"), same, "left")
              .withColumn("_copy", F.row_number().over(again)))
    split = F.split("text", "\n", -1)
    everything = F.expr("filter(transform(_lines, (x, i) -> if(x rlike '^[\\\\x20\\\\x09-\\\\x0D]*$', null, i)), i -> i is not null)")
    enough = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= least_words
    return (marked.withColumn("_lines", split)
            .withColumn("removed", F.when(F.col("text").isNull(), F.array().cast("array<int>"))
                        .when((F.col("_copy") > 1) & enough, everything)
                        .otherwise(F.coalesce("_gone", F.array().cast("array<int>"))))
            .withColumn("lines", F.coalesce(F.size("_lines"), F.lit(0)))
            .withColumn("text", F.when(F.size("removed") == 0, F.col("text"))
                        .otherwise(F.array_join(F.expr("filter(_lines, (x, i) -> not array_contains(removed, i))"), "\n")))
            .select(*[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in kept], "lines", "removed"))


# The same in SQL, for runs of up to {least} lines (a line has a word or more).
SQL = """
WITH lines AS (
  SELECT doc_id, k - 1 AS line, ls[k] AS x,
         len(regexp_extract_all(ls[k], '[^\\x20\\x09-\\x0D]+')) AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), unnest(range(1, len(ls) + 1)) u(k)),
full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
         sum(w) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM lines WHERE w > 0),
spans AS (
  SELECT a.doc_id, a.pos AS first, b.pos AS last
  FROM full_lines a JOIN full_lines b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + {least} - 1
  WHERE b.upto - a.upto + a.w >= {least}
    AND (b.upto - b.w - a.upto + a.w < {least} OR b.upto - a.upto < {least})),
runs AS (
  SELECT s.doc_id, s.first, s.last, string_agg(l.x, chr(10) ORDER BY l.pos) AS run
  FROM spans s JOIN full_lines l ON l.doc_id = s.doc_id AND l.pos BETWEEN s.first AND s.last GROUP BY ALL),
later AS (
  SELECT doc_id, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS n FROM runs) WHERE n > 1),
gone AS (
  SELECT DISTINCT l.doc_id, l.line FROM later r JOIN full_lines l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.first AND r.last)
SELECT d.doc_id, coalesce(n.lines, 0)::INT AS lines, coalesce(n.gone, 0)::INT AS n_removed,
       CASE WHEN coalesce(n.gone, 0) = 0 THEN d.text ELSE coalesce(n.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(*) AS lines, count(g.line) AS gone, string_agg(l.x, chr(10) ORDER BY l.line) FILTER (g.line IS NULL) AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line GROUP BY l.doc_id) n ON n.doc_id = d.doc_id
""".replace("{least}", str(LEAST_WORDS))
