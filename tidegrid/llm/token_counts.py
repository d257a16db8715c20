"""Token counts by heap-and-linked-list byte-pair merging, with no ids emitted.

The symbols of a word form a linked list; a heap holds the adjacent pairs that can merge. The pair of
lowest rank, leftmost first, is popped and merged as long as there is one. A word has as many tokens as it had
symbols, less its merges. A text is read in pieces; of a word longer than a window, the symbols that nothing that
follows can change any more are counted and leave it, so memory is bounded for any text. Counts of words of up to
64 bytes are kept, within a bounded number of bytes, until a task ends.

Defined results: null and empty texts have no bytes and no tokens, and so has white space where the vocabulary
drops it. A special string inside a text counts as one token. Every row gives one row, repeated rows too; other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import vocabulary


def merges(symbols: list[int], ranks: dict[int, int], made: list[int]) -> tuple[int, list[int]]:
    """How many symbols are left when all merges are done, and the list of the first place after each."""
    n = len(symbols)
    after = list(range(1, n + 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get(symbols[i] << 20 | symbols[i + 1])) is not None]
    if not heap:
        return n, after
    heapify(heap)
    symbol = [*symbols, -1]
    before = list(range(-1, n - 1))
    left = n
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # a pair that an earlier merge has changed is out of date
        if symbol[i] < 0 or j >= n or ranks.get(symbol[i] << 20 | symbol[j]) != rank:
            continue
        symbol[i], symbol[j] = made[rank], -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (new := ranks.get(symbol[i] << 20 | symbol[k])) is not None:
                heappush(heap, (new, i))
        h = before[i]
        if h >= 0 and (new := ranks.get(symbol[h] << 20 | symbol[i])) is not None:
            heappush(heap, (new, h))
    return left, after


class Counter:
    """Tokens of texts that come in pieces."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab = vocab
        self.kept = vocabulary.Kept(lambda raw: sum(self.window().feed(raw, True)))

    def settle(self, symbols: list[int], stable: int | None) -> tuple[int, int]:
        """How many tokens end within the first ``stable`` bytes, and these bytes' number; all tokens where it is None."""
        left, after = merges(symbols, self.vocab.ranks, self.vocab.made)
        if stable is None:
            return left, len(symbols)
        n = end = 0
        while end < len(symbols) and after[end] <= stable:
            n, end = n + 1, after[end]
        return n, end

    def window(self) -> vocabulary.Window:
        return vocabulary.Window(self.vocab, self.settle)

    def of(self, chunks: Iterable[str]) -> int:
        total, window, kept = 0, None, self.kept.__getitem__
        for words, part, ended, special in self.vocab.words(chunks):
            if part:
                window = window or self.window()
                total += sum(window.feed(part.encode(), ended))
                if ended:
                    window = None
            total += sum(map(kept, words)) + (special >= 0)
        return total


_kept: dict[int, Counter] = {}


def _counts(vocab: vocabulary.Vocabulary) -> Counter:
    if id(vocab) not in _kept:
        _kept.clear()
        _kept[id(vocab)] = Counter(vocab)
    return _kept[id(vocab)]


def _counter(source) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary.load(source.value))
        for batch in batches:
            texts = batch.column("text").fill_null("")
            tokens = pa.array((counts.of(vocabulary.chunks_of(x)) for x in texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pc.binary_length(texts).cast(pa.int64()), tokens], names=["doc_id", "n_bytes", "n_tokens"]
            )
        counts.kept.forget()

    return run


def counted(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    session.workers_see(spark)
    with open(path, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_counter(source), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the whole of ``documents``."""
    import public_tokenizers

    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
