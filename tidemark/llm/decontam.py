"""Benchmark decontamination over a stored positional inverted index.

The index is partitioned by document: each row is one block of a few megabytes of text with its own sorted term list
and the positions of every term. It is built without a shuffle, kept in the shared folder, and can be searched for any
number of benchmarks. A search reads the term columns once to learn how often each benchmark term occurs in the whole
corpus, then walks each block from the rarest term of every phrase: candidate starts are that term's positions less its
offset, and each further term, in order of rarity, keeps the candidates whose shifted position is in its own list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.store import stored
from tidemark.llm.text import ALNUM, slices, utf8, words

#: Text bytes in one block of the index.
BLOCK_BYTES = 4 << 20
#: Phrases sent to the executors at once; more of them are searched block by block, each over the whole index.
PHRASES_AT_ONCE = 50_000


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for i, j in slices(bounds, BLOCK_BYTES):
            hashes, counts = words(data, bounds[i : j + 1], ALNUM)
            # A document starts one position after the end of the one before, so that no phrase runs over.
            at = np.arange(len(hashes), dtype=np.int64) + np.repeat(np.arange(len(counts)), counts)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
            ids = batch.column(0).slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + seq]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([counts.tobytes()], pa.binary()),
                    pa.array([ranked[new].tobytes()], pa.binary()),
                    pa.array([np.append(new, len(ranked)).astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([at[order].astype(np.uint32).tobytes()], pa.binary()),
                ],
                ["block", "ids", "n_words", "terms", "bounds", "positions"],
            )
            seq += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional inverted index of all words of all texts, written to the shared folder.

    One row per block: ``block``, the documents' ``ids``, and as packed numbers their ``n_words``, the sorted hashes of
    the block's ``terms``, and the ``positions`` of term k at ``bounds[k]`` to ``bounds[k + 1]``.
    """
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType))]
        + [T.StructField(c, T.BinaryType()) for c in ("n_words", "terms", "bounds", "positions")]
    )
    return stored(docs.select(id_col, text_col).mapInArrow(_index, schema), "postings")


@dataclass
class Phrases:
    """Distinct phrases as rows of term hashes, by length, each with the items that hold it."""

    by_length: dict[int, np.ndarray]
    items: dict[int, list[tuple]]

    def terms(self) -> np.ndarray:
        return np.unique(np.concatenate([m.ravel() for m in self.by_length.values()])) if self.by_length else np.zeros(0, np.uint64)


def phrase_blocks(items: DataFrame, n: int, id_col: str, text_col: str, at_once: int = PHRASES_AT_ONCE) -> Iterator[Phrases]:
    """All windows of n words of the items (an item of fewer words is one window), a bounded number at a time."""
    found: dict[bytes, set] = {}
    for row in items.where(F.col(id_col).isNotNull()).select(id_col, text_col).toLocalIterator():
        hashes, _ = words(*utf8(pa.array([row[1]], pa.string())), ALNUM)
        for i in range(max(1, len(hashes) - n + 1) if len(hashes) else 0):
            found.setdefault(hashes[i : i + n].tobytes(), set()).add(row[0])
            if len(found) >= at_once:
                yield _phrases(found)
                found = {}
    if found:
        yield _phrases(found)


def _phrases(found: dict[bytes, set]) -> Phrases:
    lengths: dict[int, list[bytes]] = {}
    for phrase in found:
        lengths.setdefault(len(phrase) // 8, []).append(phrase)
    return Phrases(
        {k: np.frombuffer(b"".join(v), np.uint64).reshape(-1, k) for k, v in lengths.items()},
        {k: [tuple(found[p]) for p in v] for k, v in lengths.items()},
    )


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of the (sorted, bounded) terms occurs in the whole index."""

    def count(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, bounds in zip(batch.column(0), batch.column(1)):
                own, bounds = np.frombuffer(own.as_py(), np.uint64), np.frombuffer(bounds.as_py(), np.uint32)
                at, there = _find(own, terms)
                total[there] += (bounds[at[there] + 1] - bounds[at[there]]).astype(np.int64)
        rows = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(total[rows], pa.int64())], ["term", "n"])

    counts = np.zeros(len(terms), np.int64)
    for row in index.select("terms", "bounds").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["term"]] = row["n"]
    return counts


def _find(ranked: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value is in a sorted array, and whether it is there."""
    at = np.searchsorted(ranked, wanted)
    if not len(ranked):
        return at, np.zeros(wanted.shape, bool)
    at = np.minimum(at, len(ranked) - 1)
    return at, ranked[at] == wanted


class Block:
    """One row of the index, opened for search."""

    def __init__(self, n_words: bytes, terms: bytes, bounds: bytes, positions: bytes):
        self.n_words = np.frombuffer(n_words, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.bounds = np.frombuffer(bounds, np.uint32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.uint32)
        self.starts = np.cumsum(np.append(0, self.n_words[:-1] + 1)) if len(self.n_words) else self.n_words

    def exact(self, phrases: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first position) of every occurrence. ``order``: each phrase's offsets from the rarest term on."""
        at, there = _find(self.terms, phrases)
        row = np.flatnonzero(there.all(axis=1))
        if not len(row):
            return row, row
        at, order = at[row], order[row]
        keys = self._keys(np.unique(at))
        pick = np.arange(len(row))
        term = at[pick, order[:, 0]]
        lists = self.bounds[term + 1] - self.bounds[term]
        which = np.repeat(pick, lists)
        step = np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists)
        start = self.positions[np.repeat(self.bounds[term], lists) + step].astype(np.int64) - order[which, 0]
        for k in range(1, phrases.shape[1]):
            offset = order[which, k]
            _, hit = _find(keys, (at[which, offset] << 32) + start + offset)
            which, start = which[hit], start[hit]
            if not len(which):
                break
        return row[which], start

    def _keys(self, used: np.ndarray) -> np.ndarray:
        """(term, position) as sorted numbers, of the terms in use."""
        lists = self.bounds[used + 1] - self.bounds[used]
        step = np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists)
        return (np.repeat(used, lists) << 32) + self.positions[np.repeat(self.bounds[used], lists) + step]

    def near(self, phrase: np.ndarray, rarity: np.ndarray, span: int) -> np.ndarray:
        """First positions of the shortest-started spans of ``span`` words that hold all terms, in any order."""
        at, there = _find(self.terms, phrase)
        if not there.all():
            return np.zeros(0, np.int64)
        lists = [self.positions[self.bounds[t] : self.bounds[t + 1]].astype(np.int64) for t in dict.fromkeys(at[np.argsort(rarity, kind="stable")].tolist())]
        start = np.unique((lists[0][:, None] - np.arange(span)).ravel())
        start = start[start >= 0]
        for own in lists:
            nxt = np.searchsorted(own, start)
            start = start[(nxt < len(own)) & (own[np.minimum(nxt, len(own) - 1)] < start + span)]
        doc = np.searchsorted(self.starts, start, "right") - 1
        last = np.max([own[np.searchsorted(own, start)] for own in lists], axis=0) if len(start) else start
        return start[last < self.starts[doc] + self.n_words[doc]] if len(start) else start

    def spans(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Overlapping and touching runs of words merged; sorted."""
        order = np.argsort(start, kind="stable")
        start, end = start[order], (start + length)[order]
        reach = np.maximum.accumulate(end)
        new = np.append(True, start[1:] > reach[:-1]) if len(start) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        return start[first], reach[np.append(first[1:] - 1, len(start) - 1)] if len(first) else reach


def _search(phrases: Phrases, orders: dict[int, np.ndarray], item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(*(batch.column(c)[row].as_py() for c in range(1, 5)))
                starts, lengths, items = [], [], {}
                for n, table in phrases.by_length.items():
                    which, start = block.exact(table, orders[n])
                    starts.append(start)
                    lengths.append(np.full(len(start), n))
                    doc = np.searchsorted(block.starts, start, "right") - 1
                    for d, w in {*zip(doc.tolist(), which.tolist())}:
                        items.setdefault(d, set()).update(phrases.items[n][w])
                first, end = block.spans(np.concatenate(starts), np.concatenate(lengths))
                doc = np.searchsorted(block.starts, first, "right") - 1
                docs, at = np.unique(doc, return_index=True)
                runs = np.stack([first - block.starts[doc], end - block.starts[doc]], 1).astype(np.int64)
                at = np.append(at, len(doc))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[row].as_py()] * len(docs), pa.int64()),
                        pa.array(docs, pa.int64()),
                        pa.array([runs[at[k] : at[k + 1]].ravel().tolist() for k in range(len(docs))], pa.list_(pa.int64())),
                        pa.array([sorted(items[d]) for d in docs.tolist()], pa.list_(item_type)),
                    ],
                    ["block", "ordinal", "runs", "items"],
                )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that several blocks of phrases found in one document, merged."""
    for batch in batches:
        hit, spans = [], []
        for runs in batch.column("runs"):
            own = np.array(runs.as_py() or [], np.int64).reshape(-1, 2)
            first, end = Block.spans(None, own[:, 0], own[:, 1] - own[:, 0])
            hit.append(int((end - first).sum()))
            spans.append(np.stack([first, end], 1).tolist())
        at = batch.schema.get_field_index("runs")
        yield batch.set_column(at, "runs", pa.array(spans, pa.list_(pa.list_(pa.int64())))).append_column("n_hit", pa.array(hit, pa.int64()))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids, n in zip(batch.column(0), batch.column(1), batch.column(2)):
            n = np.frombuffer(n.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.as_py()] * len(n), pa.int64()), pa.array(np.arange(len(n)), pa.int64()), ids.values, pa.array(n, pa.int64())],
                ["block", "ordinal", "doc", "n_words"],
            )


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Exact matches of benchmark windows in whole documents.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; a window is n consecutive words of an
    item, or all words of an item of fewer. Returns one row per document: ``id_col``, ``n_words``, ``n_hit`` (words inside
    occurrences), ``runs`` (their first word and the word after the last, merged) and ``items`` (ids with occurrences).

    Nulls and ties: null and empty texts have no words and are never hit; items without words have no window; items
    without an id are left out. Rows are judged one by one, also where an id is repeated or null. Equal windows of several
    items hit for all of them; repeated items count once. Only the named columns are read, so others never clash.
    """
    index = build_index(docs, id_col, text_col)
    item_type = benchmark.schema[item_col].dataType
    arrow = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}[item_type]
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ordinal", T.LongType())]
        + [T.StructField("runs", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(item_type))]
    )
    parts = []
    for phrases in phrase_blocks(benchmark, n, item_col, item_text):
        terms = phrases.terms()
        counts = term_counts(index, terms)
        orders = {k: np.argsort(counts[np.searchsorted(terms, m)], axis=1, kind="stable") for k, m in phrases.by_length.items()}
        found = index.select("block", "n_words", "terms", "bounds", "positions").mapInArrow(_search(phrases, orders, arrow), schema)
        parts.append(stored(found, "hits"))
    hits = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        hits = hits.union(part)
    per_doc = hits.groupBy("block", "ordinal").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    merged = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ordinal", T.LongType()), T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType())))]
        + [T.StructField("items", T.ArrayType(item_type)), T.StructField("n_hit", T.LongType())]
    )
    per_doc = per_doc.mapInArrow(_merged, merged)
    rows = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ordinal", T.LongType()), T.StructField("doc", docs.schema[id_col].dataType)]
        + [T.StructField("n_words", T.LongType())]
    )
    all_docs = index.select("block", "ids", "n_words").mapInArrow(_documents, rows)
    return all_docs.join(per_doc, ["block", "ordinal"], "left").select(
        F.col("doc").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("runs", F.array().cast("array<array<bigint>>")).alias("runs"),
        F.coalesce("items", F.array().cast(T.ArrayType(item_type))).alias("items"),
    )


def _near(phrases: list[tuple], rarity: list[np.ndarray], slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(*(batch.column(c)[row].as_py() for c in range(2, 6)))
                ids = batch.column(1)[row].values
                for (item, phrase), rare in zip(phrases, rarity):
                    start = block.near(phrase, rare, len(phrase) + slop)
                    doc = np.searchsorted(block.starts, start, "right") - 1
                    one = np.append(True, (start[1:] > start[:-1] + 1) | (doc[1:] != doc[:-1])) if len(start) else np.zeros(0, bool)
                    start, doc = start[one], doc[one]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(doc)).cast(pa.int64()), ids.take(pa.array(doc, pa.int64())), pa.array(start - block.starts[doc], pa.int64())],
                        ["item", "doc", "start"],
                    )

    return run


def proximity(index: DataFrame, phrases: dict[int, str], slop: int) -> DataFrame:
    """``item, doc, start``: where all words of a phrase lie within its length plus ``slop`` words, in any order.

    Runs of starts that follow one another count once, by the first. Words of a phrase that repeat are looked for once.
    """
    hashed = [(item, words(*utf8(pa.array([text], pa.string())), ALNUM)[0]) for item, text in phrases.items()]
    hashed = [(item, own) for item, own in hashed if len(own)]
    terms = np.unique(np.concatenate([own for _, own in hashed])) if hashed else np.zeros(0, np.uint64)
    counts = term_counts(index, terms)
    rarity = [counts[np.searchsorted(terms, own)] for _, own in hashed]
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc", index.schema["ids"].dataType.elementType), T.StructField("start", T.LongType())])
    return index.select("block", "ids", "n_words", "terms", "bounds", "positions").mapInArrow(_near(hashed, rarity, slop), schema)
