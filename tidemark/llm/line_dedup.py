"""Line deduplication over documents: repeated lines stay only in the last document that holds them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.store import small_or_shuffled, stored
from tidemark.llm.text import slices, utf8

STRIPPED = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a stripped, ASCII-lower-cased line; None if it has fewer than ``min_chars`` code points."""
    line = line.strip(STRIPPED)
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line.lower())


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            rows, keys = [], []
            for i, text in enumerate(texts):
                own = {line_key(line, min_chars) for line in (text.as_py() or b"").split(b"\n")}
                own.discard(None)
                rows += [i] * len(own)
                keys += own
                if len(keys) > 100_000 or i + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())], ["doc", "key"])
                    rows, keys = [], []

    return run


def _drop(min_chars: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, j - i) for b in batches for i, j in slices(utf8(b.column("text"))[1])):
            texts = batch.column("text").cast(pa.binary())
            drops = batch.column("_drop")
            kept, lines, dropped = [], [], []
            for text, drop in zip(texts, drops):
                text = text.as_py() or b""
                n = text.count(b"\n") + 1
                if drop.is_valid:
                    away = set(drop.as_py())
                    stay = [line for line in text.split(b"\n") if line_key(line, min_chars) not in away]
                    text, n_left = b"\n".join(stay), len(stay)
                else:
                    n_left = n
                kept.append(text)
                lines.append(n)
                dropped.append(n - n_left)
            values = {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            columns = [values[f.name] if f.name in values else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return run


def dedup_lines(
    docs: DataFrame, keep: Sequence[str] = (), min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Drop every line found in ``min_docs`` documents or more, except from the document of the largest id.

    Lines end at ``\\n`` and are compared stripped of ``[\\x20\\x09-\\x0D]`` and with A-Z lower-cased; lines of fewer than
    ``min_chars`` code points always stay. Returns ``id_col``, the columns named in ``keep``, ``text`` (what is left,
    joined by ``\\n``), ``n_lines`` (before) and ``n_dropped``.

    Nulls and ties: a null or empty text is one empty line and comes back as an empty text. Rows that share an id count
    as one document and lose the same lines; rows without an id keep all lines and count for nothing. An empty table
    gives an empty one. Only the named columns are read, so others never clash; ``keep`` may not name an output column.

    Plan: one (line hash, document) row per distinct line of a document is spread by both columns, counted with partial
    sums, and only the hashes over the threshold are joined back. Texts are shuffled once, to meet their dropped lines.
    """
    keep = [c for c in keep if c not in (id_col, text_col)]
    if {"n_lines", "n_dropped", "text", "_drop"} & set(keep):
        raise ValueError("keep names an output column")
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    pairs = T.StructType([T.StructField("doc", kind), T.StructField("key", T.BinaryType())])
    keys = stored(lines.mapInArrow(_keys(min_chars), pairs).distinct(), "line-keys")
    counts = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("holder")).where(F.col("n") >= min_docs)
    common = stored(counts.select("key", "holder"), "common-lines")
    hits = stored(keys.join(small_or_shuffled(common), "key").where("doc <> holder").select("doc", "key"), "dropped-lines")
    drops = hits.groupBy("doc").agg(F.collect_list("key").alias("_drop")).withColumnRenamed("doc", "_doc")
    rows = docs.select(id_col, F.col(text_col).alias("text"), *keep)
    joined = rows.join(drops, F.col(id_col) == F.col("_doc"), "left").select(id_col, "text", *keep, "_drop")
    out = T.StructType(
        [docs.schema[id_col], T.StructField("text", T.StringType()), *(docs.schema[c] for c in keep)]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    names = pa.schema([(f.name, pa.null()) for f in out])
    return joined.mapInArrow(_drop(min_chars, names), out)
