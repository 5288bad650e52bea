"""Token ids in fixed-width bit packing (operator 1).

Every id takes the fewest bits that hold the vocabulary's largest id.  A shard is one
task's run of documents in ascending ``doc_id`` order, cut to blocks of whole documents;
a block is closed once it holds ``block_ids`` ids.  Blocks are rows of a Parquet folder,
so any file system Spark writes to will do and a repeated task replaces its own output.
A block carries its place in the shard and the offsets of its documents, so a range of
ids is read from the blocks that hold it, and a block is unpacked with numpy at once.

Defined cases: a null or empty text is the end id alone.  Rows are encoded as they come:
a repeated row is encoded again, a null ``doc_id`` sorts first.  An empty table makes an
empty folder and an empty index.  Other columns are ignored.  A text is held in memory
whole, with its ids, as Spark holds the row itself; nothing else grows with the texts.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.words import groups, in_batches, kept

CACHED_WORDS = 300_000
TOGETHER = 16_000

BLOCKS = (
    "shard int, block int, first long, width int, doc_ids array<long>, offsets array<long>, payload binary"
)
INDEX = "doc_id long, shard int, block int, at long, n_tokens long, ids_crc32 long"

Encoder = Callable[[list[str]], list[np.ndarray]]


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(),
        "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


class _Words:
    """Ids of words, as bytes; those of the words met first are kept, up to a fixed number."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[bytes, bytes] = {}
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def of(self, words: list[bytes]) -> list[bytes]:
        values = list(map(self.known.get, words))
        places = [i for i, value in enumerate(values) if value is None]
        if places:
            found = self._encode({words[i] for i in places})
            for i in places:
                values[i] = found[words[i]]
            if len(self.known) < CACHED_WORDS:
                self.known.update(found)
        return values

    def _encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of unknown words.

        ASCII marks after a letter are a token run of their own, so such words are put
        together from two.  Words of letters alone are encoded together, as one text:
        every id that ends a word ends one of them.
        """
        letters = [w for w in words if w.isalpha()]  # of bytes: ASCII letters alone
        others, marked = [], {}
        known, asked = self.known, set(letters)
        for word in words - asked:
            core = word.rstrip(_MARKS)
            pieces = (core, word[len(core) :]) if core != word and _ends_in_letter(core) else (word,)
            if len(pieces) == 2:
                marked[word] = pieces
            for piece in pieces:
                if piece not in asked and piece not in known:
                    asked.add(piece)
                    (letters if _latin(piece.decode()) else others).append(piece)
        found = self._together(letters) if letters else {}
        if len(found) < len(letters):
            others += [w for w in letters if w not in found]
        for word in others:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            found[word] = array("I", ids).tobytes()
        for word, (core, marks) in marked.items():
            found[word] = (found.get(core) or known[core]) + (found.get(marks) or known[marks])
        return found

    def _together(self, letters: list[bytes]) -> dict[bytes, bytes]:
        """Some thousand words at a time: the library holds a text many times over while it encodes it."""
        found = {}
        for lo in range(0, len(letters), TOGETHER):
            words = letters[lo : lo + TOGETHER]
            (encoding,) = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
            ids = np.array(encoding.ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(words):
                joined, at = ids.tobytes(), (4 * stops).tolist()
                found.update((w, joined[a:b]) for w, a, b in zip(words, [0, *at], at))
        return found


_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27)  # the apostrophe may begin a contraction


# Letters below U+0250; the dotted capital I is not one letter in lower case.
_latin = re.compile("[a-zªµºÀ-ÖØ-öø-įı-ɏ]+").fullmatch


def _ends_in_letter(word: bytes) -> bool:
    """Whether the last character is a letter that nothing behind it can change."""
    return word[-1:].isalpha() or (len(word) > 1 and 0xC3 <= word[-2] <= 0xC8 and _latin(word[-2:].decode()) is not None)


_CONTROL = bytes([*range(0x09), *range(0x0B, 0x20)])


def _by_words(data: bytes) -> bool:
    """Whether a text's words can be encoded one by one: no special tokens or control characters."""
    return b"<|" not in data and len(data.translate(None, _CONTROL)) == len(data)


@kept
def word_encoder(path: str, special_as_text: bool = False) -> Encoder:
    """An encoder for a vocabulary that lower-cases, drops white space and splits letters from marks.

    The tokenizers library encodes each word once and its ids are kept, as texts repeat
    words far more often than they bring new ones.  The ids are those of the whole text:
    such a vocabulary never joins characters across white space.  With ``special_as_text``
    no text can bring a special token's id into the stream.  A worker process keeps one
    encoder for all the operator's tasks.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    words = _Words(tokenizer)

    def encode(texts: list[str]) -> list[np.ndarray]:
        split = []
        for text in texts:
            data = text.encode("utf-8")
            split.append(data.lower().split() if _by_words(data) else None)
        values = words.of(list(chain.from_iterable(filter(None, split))))
        found, at = [], 0
        for text, mine in zip(texts, split):
            if mine is None:
                found.append(np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                found.append(np.frombuffer(b"".join(values[at : at + len(mine)]), np.uint32))
                at += len(mine)
        return found

    return encode


@kept
def text_encoder(path: str) -> Encoder:
    """An encoder for any file of the tokenizers library: whole texts, one by one."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [
        np.array(e.ids, np.uint32) for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


def bit_width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}  # the same bits in the same order, as whole bytes


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids one after another in ``width`` bits each, lowest bit first, filled up to a byte."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id does not fit in {width} bits")
    if width in _WHOLE:
        return ids.astype(_WHOLE[width]).tobytes()
    parts = []
    for lo in range(0, len(ids), 1 << 16):  # a multiple of eight ids ends on a byte
        cells = ids[lo : lo + (1 << 16)].astype("<u4").view(np.uint8).reshape(-1, 4)
        bits = np.unpackbits(cells, axis=1, bitorder="little", count=width)
        parts.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(parts)


def unpack(payload: bytes, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` one on, without touching the bytes before."""
    if width in _WHOLE:
        return np.frombuffer(payload, _WHOLE[width], count, first * width // 8).astype(np.uint32)
    at = first * width // 8
    skip = first * width - 8 * at
    end = -(-(first + count) * width // 8)
    data = np.frombuffer(payload, np.uint8, end - at, at)
    found = np.empty(count, np.uint32)
    step = 1 << 16
    for lo in range(0, count, step):
        n = min(step, count - lo)
        a = skip + lo * width
        piece = np.unpackbits(data[a // 8 : -(-(a + n * width) // 8)], bitorder="little")
        bits = piece[a % 8 : a % 8 + n * width].reshape(n, width)
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :width] = bits
        found[lo : lo + n] = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)
    return found


def encoded(batch: pa.RecordBatch, encode: Encoder) -> Iterator[tuple[int, np.ndarray]]:
    """Ids of the documents of a batch (doc_id, text), some texts at a time."""
    doc_ids = batch.column(0).to_pylist()
    for first, texts in groups(batch.column(1)):
        yield from zip(doc_ids[first:], encode([text or "" for text in texts]))


def write_shards(
    docs: DataFrame, path: str, encoder: Callable[[], Encoder], vocabulary: int, end_id: int,
    block_ids: int = 1 << 16,
) -> None:
    """Encode ``docs`` (doc_id, text) and write packed blocks to ``path``.

    Texts are dealt to shards by ranges of ``doc_id``; rows that share an id are told apart
    by a hash of the text.  ``encoder`` is called once per task.
    """
    width, schema = bit_width(vocabulary), arrow_schema(BLOCKS)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        block = first = size = 0
        doc_ids, lengths, parts = [], [], []

        def row() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(lengths)]).tolist()
            payload = pack(np.concatenate(parts), width)
            values = (shard, block, first, width, doc_ids, offsets, payload)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema
            )

        for batch in batches:
            for doc_id, ids in encoded(batch, encode):
                doc_ids.append(doc_id)
                lengths.append(len(ids) + 1)
                parts += (ids, end)
                size += len(ids) + 1
                if size >= block_ids:
                    yield row()
                    block, first, size = block + 1, first + size, 0
                    doc_ids, lengths, parts = [], [], []
        if doc_ids:
            yield row()

    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .transform(in_batches, packed, BLOCKS)
        .write.parquet(path)
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """Ids in all shards before each shard: (shard, base).  One row per shard."""
    totals = blocks.select("shard", F.element_at("offsets", -1).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def document_index(blocks: DataFrame) -> DataFrame:
    """Every document of the packed files: (doc_id, start, n_tokens, ids_crc32, shard, block).

    Ids are unpacked and summed block by block where the blocks are read.
    """
    schema = arrow_schema(INDEX)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, first, width, doc_ids, offsets, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack(payload, width, 0, offsets[-1]).astype("<u4")
                n = len(doc_ids)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets, offsets[1:])]
                at = first + np.array(offsets[:-1], np.int64)
                columns = (doc_ids, [shard] * n, [block] * n, at, np.diff(offsets), sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema
                )

    found = blocks.transform(in_batches, read, INDEX).join(block_starts(blocks), "shard")
    return found.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "block")


def read_ids(blocks: DataFrame, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole sequence, from the blocks that hold them.

    What is broadcast is one row per shard; only blocks in the range leave the scan.
    """
    end = F.lit(start + count)
    at = F.col("base") + F.col("first")
    held = (
        blocks.join(F.broadcast(block_starts(blocks)), "shard")
        .withColumn("at", at)
        .filter((at < end) & (at + F.element_at("offsets", -1) > start))
        .select("at", "width", F.element_at("offsets", -1).alias("n"), "payload")
        .orderBy("at")
    )
    parts = [np.empty(0, np.uint32)]
    for at, width, n, payload in held.toLocalIterator():
        lo, hi = max(0, start - at), min(n, start + count - at)
        parts.append(unpack(bytes(payload), width, lo, hi - lo))
    return np.concatenate(parts)
