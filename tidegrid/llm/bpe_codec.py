"""Byte-pair encoding as a streaming transducer of bounded lookahead, and incremental decoding.

Encoding. How far to the left can bytes that follow change the tokens of what came before? A difference
that begins at a symbol moves left only by a merge of that symbol with its left neighbour, and each further move
needs a merge of higher rank. One pass over the merges, in order of rank, so bounds the distance: the
sufficient lookahead of the list. A text is read in pieces. Words pass through a window; the tokens that end before
the lookahead, or with the word, are stable, are emitted and leave the window. So what is held of a text is a piece and a window,
however long the text or a word of it is.

Decoding. Ids become bytes, bytes become text by a state machine that keeps an unfinished character
between pieces; bytes that are no UTF-8 become U+FFFD.

Words recur, so what the transducer emits for words of up to 64 bytes is kept, within a bounded number of bytes, until a task ends.

Defined results: null and empty texts have no tokens, and their decoded text is empty. A special string in a
text is its one id. Every row gives one row, repeated rows too; other columns are ignored by ``digests``
and kept by ``encoded``. An empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import vocabulary

NEVER = 1 << 30
#: Ids that are decoded at a time.
PIECE = 1 << 16


class Transducer:
    """Texts that come in pieces to ids, packed as little-endian 32-bit integers."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab = vocab
        self.kept = vocabulary.Kept(lambda raw: _packed(list(self.stream([raw]))))

    def merged(self, symbols: list[int]) -> list[int]:
        """All merges of the symbols in a window, lowest rank first, of one rank from left to right."""
        rank, made = self.vocab.ranks.get, self.vocab.made
        found = [rank(a << 20 | b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while found and (best := min(found)) < NEVER:
            i = found.index(best)
            symbols[i] = new = made[best]
            del symbols[i + 1], found[i]
            if i < len(found):
                found[i] = rank(new << 20 | symbols[i + 1], NEVER)
            if i:
                found[i - 1] = rank(symbols[i - 1] << 20 | new, NEVER)
        return symbols

    def settle(self, symbols: list[int], stable: int | None) -> tuple[list[int], int]:
        """Tokens that end within the first ``stable`` bytes and these bytes' number; all tokens where it is None."""
        size, end = len(symbols), 0
        tokens = self.merged(symbols)
        if stable is None:
            return tokens, size
        for k, token in enumerate(tokens):
            if end + len(self.vocab.bytes[token]) > stable:
                return tokens[:k], end
            end += len(self.vocab.bytes[token])
        return tokens, end

    def window(self) -> vocabulary.Window:
        return vocabulary.Window(self.vocab, self.settle)

    def stream(self, parts: Iterable[bytes]) -> Iterator[int]:
        """The ids of one word that comes in parts, each as soon as it is stable."""
        window = self.window()
        for part in parts:
            for ids in window.feed(part, False):
                yield from ids
        for ids in window.feed(b"", True):
            yield from ids

    def encode(self, chunks: Iterable[str]) -> Iterator[bytes]:
        """Packed ids of a text that comes in pieces."""
        window, kept = None, self.kept.__getitem__
        for words, part, ended, special in self.vocab.words(chunks):
            if part:
                window = window or self.window()
                for ids in window.feed(part.encode(), ended):
                    yield _packed(ids)
                if ended:
                    window = None
            if words:
                yield b"".join(map(kept, words))
            if special >= 0:
                yield _packed([special])


def _packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Decoder:
    """Packed ids to text, piece by piece; the state is at most one unfinished character."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.of = vocab.bytes.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, packed: bytes, final: bool = False) -> str:
        ids = array("I", packed)
        if sys.byteorder == "big":
            ids.byteswap()
        return self.state.decode(b"".join(map(self.of, ids)), final)


_kept: dict[int, Transducer] = {}


def transducer(source: str) -> Transducer:
    vocab = vocabulary.load(source)
    if id(vocab) not in _kept:
        _kept.clear()
        _kept[id(vocab)] = Transducer(vocab)
    return _kept[id(vocab)]


def _digester(source) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = transducer(source.value)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids, plain, n, decoder = hashlib.sha256(), hashlib.sha256(), 0, Decoder(coder.vocab)
                for packed in coder.encode(vocabulary.chunks_of(text)):
                    ids.update(packed)
                    n += len(packed) // 4
                    plain.update(decoder.feed(packed).encode())
                plain.update(decoder.feed(b"", True).encode())
                rows.append((n, ids.hexdigest(), plain.hexdigest()))
            n, ids, plain = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(plain, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        coder.kept.forget()

    return run


def _encoder(source, both: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds token_ids and, with ``both``, the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = transducer(source.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                packed = [b"".join(coder.encode(vocabulary.chunks_of(x))) for x in part.column("text")]
                cuts = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
                out = pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "token_ids"])
                yield _with_decoded(out, coder.vocab) if both else out
        coder.kept.forget()

    return run


def _with_decoded(batch: pa.RecordBatch, vocab: vocabulary.Vocabulary) -> pa.RecordBatch:
    texts = []
    for ids in batch.column("token_ids"):
        own, decoder = np.asarray(ids.values if ids.is_valid else [], np.uint32), Decoder(vocab)
        pieces = [decoder.feed(_packed(own[at : at + PIECE])) for at in range(0, len(own), PIECE)]
        texts.append("".join([*pieces, decoder.feed(b"", True)]))
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def _decoder(source) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.load(source.value)
        for batch in batches:
            yield _with_decoded(batch, vocab)

    return run


def _source(docs: DataFrame, path: str):
    session.workers_see(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digester(_source(docs, path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with the ids of its column text as token_ids; a column of that name is replaced."""
    docs = docs.drop("token_ids")
    schema = f"{docs._jdf.schema().toDDL()}, token_ids array<int>"
    return docs.mapInArrow(_encoder(_source(docs, path), False), schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with token_ids and the text that these decode to as decoded, by one worker; columns of these names are replaced."""
    docs = docs.drop("token_ids", "decoded")
    schema = f"{docs._jdf.schema().toDDL()}, token_ids array<int>, decoded string"
    return docs.mapInArrow(_encoder(_source(docs, path), True), schema)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with the text of its column token_ids as decoded; a column of that name is replaced."""
    rows = rows.drop("decoded")
    schema = f"{rows._jdf.schema().toDDL()}, decoded string"
    return rows.mapInArrow(_decoder(_source(rows, path)), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded texts over the whole of ``documents``."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
