"""Evaluation passages inside a training corpus: an FM-index per shard, searched for every phrase of the items.

Exact: every run of `least` consecutive words that a document shares with an item is found, in whole texts. The corpus is
never shuffled; each task indexes its own documents shard by shard and searches the items, a stated query set, in blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.fm_index import FMIndex
from harborline.llm.words import word_spans, words
from harborline.session import materialize, plan_bytes, spread

#: Words of an item that a document must repeat in a row.
LEAST_WORDS = 12
#: Words in the index of one shard; longer documents are cut into pieces that overlap by least - 1 words.
SHARD_WORDS = 300_000
#: Written size of the items that are sent to the executors at once.
BLOCK_BYTES = 16 << 20


def phrases(items: list[tuple[int, str]], least: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(vocabulary, phrases as rows of word numbers, item of each phrase) of all runs of `least` words."""
    number: dict[str, int] = {}
    rows, owners = [], []
    for item, text in items:
        ids = [number.setdefault(w, len(number)) for w in words(text)]
        for k in range(len(ids) - least + 1):
            rows.append(ids[k : k + least])
            owners.append(item)
    return list(number), np.array(rows, np.int64).reshape(len(rows), least), np.array(owners, np.int64)


def _search_shard(pieces: list[tuple[int, int, list[str]]], vocabulary: list[str], rows: np.ndarray, owners: np.ndarray):
    """(place in pieces, item, first word) of each phrase found in a shard."""
    number: dict[str, int] = {}
    ids, starts, n = [], [], 0
    for _, _, tokens in pieces:
        starts.append(n)
        ids.append(np.fromiter((number.setdefault(w, len(number) + 2) for w in tokens), np.int64, len(tokens)))
        ids.append(np.ones(1, np.int64))  # 1 parts the documents
        n += len(tokens) + 1
    known = np.array([number.get(w, 0) for w in vocabulary], np.int64)
    coded = known[rows] if len(rows) else rows
    possible = np.flatnonzero((coded > 0).all(axis=1))
    if not len(possible):
        return []
    index = FMIndex(np.concatenate(ids), len(number) + 2)
    owner, position = index.locate(*index.search(coded[possible]))
    starts = np.array(starts)
    place = np.searchsorted(starts, position, side="right") - 1
    return list(zip(place.tolist(), owners[possible[owner]].tolist(), (position - starts[place]).tolist()))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _searcher(found: tuple, least: int, shard_words: int):
    vocabulary, rows, owners = found

    def run(batches):
        def flush(shard, texts):
            hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for place, item, at in _search_shard(shard, vocabulary, rows, owners):
                row, offset, _ = shard[place]
                hits.setdefault((row, item), []).append((offset + at, offset + at + least))
            out = []
            for (row, item), spans in hits.items():
                places = word_spans(texts[row][1])
                for a, b in _merged(spans):
                    out.append((texts[row][0], item, a, b, places[a][1], places[b - 1][2]))
            return pd.DataFrame(out, columns=["doc_id", "item_id", "first_word", "end_word", "start_char", "end_char"])

        shard, texts, size, row = [], {}, 0, 0
        for pdf in batches:
            for doc, text in zip(pdf.doc_id, pdf.text):
                tokens = words(text)
                row += 1
                for k in range(0, max(1, len(tokens) - least + 1), shard_words):
                    piece = tokens[k : k + shard_words + least - 1]
                    if len(piece) < least:
                        continue
                    texts[row] = (doc, text)
                    shard.append((row, k, piece))
                    size += len(piece) + 1
                    if size >= shard_words:
                        yield flush(shard, texts)
                        shard, texts, size = [], {row: (doc, text)}, 0
        if shard:
            yield flush(shard, texts)

    return run


def found(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """What passages() merges: in a document longer than a shard, a passage across two pieces is two spans that overlap."""
    items = materialize(items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text"), "items")
    blocks = max(1, -(-plan_bytes(items) // BLOCK_BYTES))
    parts = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else items
        run = _searcher(phrases([(r.item_id, r.text) for r in block.collect()], least), least, shard_words)
        parts.append(spread(documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")).mapInPandas(run, "doc_id bigint, item_id bigint, first_word bigint, end_word bigint, start_char bigint, end_char bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _united(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans of each key that overlap or touch as one; ends of words and chars grow together, so that words tell."""
    spans = spans.groupBy(*keys, "first_word").agg(F.max("end_word").alias("end_word"), F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char"))
    order = Window.partitionBy(*keys).orderBy("first_word")
    reached = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = spans.withColumn("_new", F.coalesce(F.col("first_word") > reached, F.lit(True)).cast("int")).withColumn("_span", F.sum("_new").over(order))
    return parted.groupBy(*keys, "_span").agg(F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char")).drop("_span")


def passages(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Passages: (doc_id, item_id, first_word, end_word, start_char, end_char), overlapping ones merged per item.

    Ends are exclusive; words count in the text without markup, chars in the text as given. Null, blank and short texts
    and items give nothing, nor do rows without an id; a document that occurs twice gives its spans once. Items beyond
    BLOCK_BYTES are searched in blocks of that size.
    """
    return _united(found(documents, items, least, shard_words), ["doc_id", "item_id"])


def removal_spans(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """What to cut out of each document: (doc_id, first_word, end_word, start_char, end_char), merged over all items."""
    return _united(found(documents, items, least, shard_words), ["doc_id"])


def leaked(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id): each document with an item it repeats, once."""
    return found(documents, items, least).select("doc_id", "item_id").distinct()


def report(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(item_id, documents, passages): how far each item leaked."""
    return passages(documents, items, least).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("passages"))
