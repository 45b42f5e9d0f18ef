"""Pack documents into training sequences by power-of-two decomposition.

A document of n tokens becomes whole sequences of LONGEST tokens and, for each one bit of the rest, a
piece of that length, longest first. Every piece is a sequence of its own, without padding and
without a second document; sequences of equal length form a bucket, from which batches are drawn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import slices, table, worker_state

LONGEST = 4096
END = 2
#: Words remembered by a worker before the older half is forgotten (some 100 MB).
REMEMBERED = 400_000
_SIMPLE = re.compile("[!-~¡-į]+").fullmatch
_OTHER_SPACE = re.compile("[\x1c-\x1f]").search
#: Fixed value: the tokenizer's own split of a text into words.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


class Encoder:
    """Ids of a text by a tokenizer that drops white space, as bytes (little-endian, 32 bits each).

    No token crosses white space, so a text's ids are those of its words, which are remembered. Words
    of simple Latin letters go to the tokenizer's model directly, split and in lower case as it does
    itself; all others go through the whole tokenizer. Names of the file's added tokens are ordinary
    text, or else (named) those tokens, as in the tokenizer's own encoding: texts that hold one go
    through the whole tokenizer.
    """

    def __init__(self, definition: str, named: bool = False):
        """definition: the content of the tokenizer's file."""
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not named
        added = self.tokenizer.get_added_tokens_decoder().values() if named else ()
        # A name that is looked for after normalization may hide in any text.
        names = "" if any(token.normalized for token in added) else "|".join(re.escape(token.content) for token in added)
        self.has_name = re.compile(names).search if added else lambda text: None
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x130)]]
        self.byte_names = str.maketrans({c: to_bytes.pre_tokenize_str(c)[0][0] for c in letters})
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _part(self, part: str) -> bytes:
        if len(self.parts) >= REMEMBERED:
            self.parts.clear()
        tokens = self.model.tokenize(part.translate(self.byte_names))
        ids = self.parts[part] = np.array([t.id for t in tokens], np.uint32).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if _SIMPLE(word):
                known = self.parts.get
                ids = b"".join([known(part) or self._part(part) for part in _SPLIT(word.lower())])
            else:
                ids = self.whole(word)
        if len(word) <= 64:
            if len(self.words) >= REMEMBERED:
                self.older, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if _OTHER_SPACE(text) or self.has_name(text):  # (white space to Python, but not to the tokenizer)
            return self.whole(text)
        known = self.words.get
        return b"".join([known(word) or self._word(word) for word in text.split()])


def binary_pieces(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n tokens: n in binary, with longest as the largest unit."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]


_PIECES = "id long, start long, length long, ids binary, doc_tokens long"


def _pieces(definition: Broadcast, name: str, end: int, longest: int):
    ending = int(end).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("encoders")
        encoder = state.get(name) or state.setdefault(name, Encoder(definition.value, named=True))
        for batch, texts in slices(batches, "text", most_bytes=500_000):
            of, starts, lengths, ids, sizes = [], [], [], [], []
            for id_, text in zip(batch.column("id").to_pylist(), texts):
                tokens = encoder.ids(text or "") + ending
                size, start = len(tokens) // 4, 0
                for length in binary_pieces(size, longest):
                    of.append(id_)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(tokens[4 * start:4 * (start + length)])
                    sizes.append(size)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(of, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(sizes, pa.int64())],
                ["id", "start", "length", "ids", "doc_tokens"])
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         longest: int = LONGEST, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, 32 bits each, little-endian), doc_tokens,
    sequence_id, offset.

    ids are those of the tokenizer's file without its added ends; a name of a special token in a text
    is that token. No text is an empty one: the end token alone. Repeated rows are packed each. Sequence ids are
    unique; their last four bits tell the bucket (length = 1 << bits). A piece is a sequence, so its
    offset is 0. An empty table gives an empty result; other columns are not read. Tasks need no
    shuffle, and memory for a few texts.
    """
    if longest & (longest - 1) or not 1 <= longest <= 1 << 15:
        raise ValueError("the longest sequence must be a power of two up to 32768")
    # The file is read here and sent along (some 2 MB): executors need not have it.
    definition = Path(tokenizer_path).read_text(encoding="utf-8")
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    name = hashlib.sha256(definition.encode()).hexdigest()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(_pieces(shared, name, end, longest), _PIECES)
    bucket = F.round(F.log2(F.col("length"))).cast("long")
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", "ids", "doc_tokens",
        (F.monotonically_increasing_id() * 16 + bucket).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as files, one folder per length."""
    pieces.write.partitionBy("length").parquet(path)


def op8_binary_packing(spark: SparkSession, folder: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents") if docs is None else docs
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
