"""Near duplicates by SimHash fingerprints, linked through a Golay-code fuzzy hash.

Fingerprints of at most three differing bits agree on some blocks: of B equal blocks, B - 3 have no
error. The bits of the three other blocks are dealt into two halves, and one half has at most one
error. That half, as a 23-bit word, is decoded by the perfect binary Golay code: words at most one
bit apart share the index of a nearby codeword. A word at distance up to 2 of its codeword has one
index; a word at distance 3 has six, its own codeword's and those of the five codewords at distance
4. A key is (which blocks, their bits, which half, codeword index); linked fingerprints share one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import cut, pick_rows, slices, table, text_key
from gridmart.llm.components import star_roots

#: Most differing bits of linked fingerprints; words in a shingle.
MOST_BITS = 3
SHINGLE = 3
#: Blocks of the first keys, and of the finer ones for the fingerprints in larger buckets. With 4
#: blocks a fingerprint has some 42 keys of 28 bits that tell; with 5 blocks some 100 of 37 bits, which
#: suits billions of distinct fingerprints better.
BLOCKS, FINER_BLOCKS = 4, 8
#: Members up to which a bucket of the first keys, and of the finer ones, is searched at once.
BUCKET, FINER_BUCKET = 1024, 16_384
#: Blocks of the last keys, which agree on all blocks but three: their buckets hold 2^12 members at most.
LAST_BLOCKS = 16
#: Fixed value: generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The syndrome of each 12-bit message part, and per syndrome up to six error patterns (the
    leader of the coset, and its five patterns of weight 4 if the leader has weight 3)."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    unit = [remainder(1 << bit) for bit in range(23)]
    high = np.zeros(4096, np.int64)
    for value in range(4096):
        for bit in range(12):
            if value >> bit & 1:
                high[value] ^= unit[bit + 11]
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            pattern = syndrome = 0
            for place in places:
                pattern |= 1 << place
                syndrome ^= unit[place]
            if weight < 4 or found[syndrome][0].bit_count() == 3:
                found[syndrome].append(pattern)
    patterns = np.array([x + [x[0]] * (6 - len(x)) for x in found], np.int64)
    return high, patterns, np.array([len(x) for x in found])


def codeword_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """23-bit words to (place in words, codeword index) pairs, one or six for each word."""
    high, patterns, counts = _golay()
    words = words.astype(np.int64)
    syndromes = high[words >> 11] ^ (words & 2047)
    indexes = (words[:, None] ^ patterns[syndromes]) >> 11
    used = np.arange(6)[None, :] < counts[syndromes][:, None]
    return np.nonzero(used)[0], indexes[used]


def _dealt(prints: np.ndarray, blocks: int) -> Iterator[tuple[int, tuple[np.ndarray, int], tuple[np.ndarray, int]]]:
    """For each choice of three erring blocks: its number, the other blocks' bits, the erring ones' bits,
    each with how many they are."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:])]
    parts = [(prints >> np.uint64(a)).astype(np.int64) & ((1 << w) - 1) for a, w in zip(cuts, widths)]

    def together(chosen: list[int]) -> tuple[np.ndarray, int]:
        value, bits = np.zeros(len(prints), np.int64), 0
        for i in chosen:
            value, bits = value << widths[i] | parts[i], bits + widths[i]
        return value, bits

    for number, erring in enumerate(combinations(range(blocks), MOST_BITS)):
        yield number, together([i for i in range(blocks) if i not in erring]), together(list(erring))


def bucket_keys(prints: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprints to (place, 64-bit key) pairs, for 4 to 8 blocks."""
    places, keys = [], []
    for number, (same, same_bits), (rest, rest_bits) in _dealt(prints, blocks):
        low = rest_bits // 2
        for half, word in enumerate((rest & ((1 << low) - 1), rest >> low)):
            # A half wider than 23 bits leaves one out: that can only lessen its errors.
            place, index = codeword_keys(word & 0x7FFFFF)
            places.append(place)
            keys.append((np.int64(number << same_bits) | same[place]) << 13 | half << 12 | index)
    return np.concatenate(places), np.concatenate(keys)


def last_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprints to (place, 64-bit key) pairs: all blocks of four bits but three, 560 keys each.
    Equal keys agree on 52 bits, so at most 4,096 distinct fingerprints share one."""
    keys = [np.int64(number << bits) | same for number, (same, bits), _ in _dealt(prints, LAST_BLOCKS)]
    return np.tile(np.arange(len(prints)), len(keys)), np.concatenate(keys)


def fingerprint(text: str | None) -> int:
    """SimHash of the text's word shingles; zero if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split(None)
    # bytes.split() splits at exactly the bytes 0x20 and 0x09 to 0x0D.
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    hash_of = xxhash.xxh64_digest
    votes, count = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    stops = (ends - 1).tolist()[SHINGLE - 1:]
    begins = starts.tolist()
    for at in range(0, count, 65_536):
        hashes = b"".join([hash_of(joined[a:b], 42) for a, b in zip(begins[at:at + 65_536], stops[at:at + 65_536])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        # Counts of ones are added up in groups that fit a byte first.
        votes += sum(bits[i:i + 255].sum(axis=0, dtype=np.uint8).astype(np.int64) for i in range(0, len(bits), 255))
    value = np.packbits(2 * votes > count)
    return int.from_bytes(value.tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        prints = np.array([fingerprint(text) for text in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(prints)], ["id", "key", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text key, fingerprint (as a signed long)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints, "id long, key long, print long")


Keys = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _expand(keys: Keys):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy(zero_copy_only=False)
            for start in range(0, len(prints), 2048):
                part = prints[start:start + 2048]
                place, key = keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[place])], ["bucket", "print"])
    return expand


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all members (distinct) that a chain of near pairs connects; one less than
    members at most. Reads one row of distances at a time."""
    left, links = members, []
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            node = reached.pop()
            near = np.bitwise_count(left ^ node) <= MOST_BITS
            for other in left[near]:
                links.append((node, other))
                reached.append(other)
            left = left[~near]
    return links


def _links(bucket_limit: int | None):
    """Links inside the buckets of a partition that is sorted by bucket. A bucket over the limit is
    passed on as rows (b = a) for finer keys."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: list) -> pa.RecordBatch:
            both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        last, carried, over = None, np.empty(0, np.uint64), False
        for batch in batches:
            buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
            prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(buckets):
                continue
            # The first bucket may go on from the batch before, the last one into the next.
            edges = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
            starts = np.concatenate([[0], edges])
            ends = np.concatenate([edges, [len(buckets)]])
            pairs: list = []
            if last is not None and buckets[0] != last:
                pairs += _forest(carried)
                carried, over = np.empty(0, np.uint64), False
            head = int(ends[0])
            if over:
                pairs += [(x, x) for x in prints[:head]]
            else:
                carried = np.concatenate([carried, prints[:head]])
            if len(starts) > 1:
                pairs += _forest(carried)
                over = False
                for i in np.flatnonzero(ends[1:-1] - starts[1:-1] > 1) + 1:
                    pairs += _members(prints[starts[i]:ends[i]])
                carried = prints[starts[-1]:ends[-1]].copy()
            last = buckets[-1]
            if bucket_limit and not over and len(carried) > bucket_limit:
                pairs += [(x, x) for x in carried]
                carried, over = np.empty(0, np.uint64), True
            if pairs:
                yield out(pairs)
        if len(carried) > 1 and (pairs := _forest(carried)):
            yield out(pairs)

    def _members(members: np.ndarray) -> list:
        if bucket_limit and len(members) > bucket_limit:
            return [(x, x) for x in members]
        return _forest(members)
    return links


def _bucket_links(prints: DataFrame, keys: Keys, bucket_limit: int | None) -> DataFrame:
    keyed = prints.mapInArrow(_expand(keys), "bucket long, print long")
    return keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _links(bucket_limit), "a long, b long")


def near_links(prints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Links (`a`, `b`) that connect the distinct fingerprints (`print`) as all pairs of at most
    three differing bits would. A bucket gives fewer links than it has members.

    Buckets of many fingerprints (dense clusters of near copies, or chance in a very large corpus)
    are not searched under the first keys: their members go through finer ones, which agree on 40
    bits, and those of buckets that are still large through the last ones, which agree on 52. So no
    task compares more than FINER_BUCKET members with each other, however large a cluster is.
    """
    found = cut(_bucket_links(prints, partial(bucket_keys, blocks=blocks), BUCKET).distinct())
    dense = found.where("a = b").select(F.col("a").alias("print"))
    finer = cut(_bucket_links(dense, partial(bucket_keys, blocks=FINER_BLOCKS), FINER_BUCKET).distinct())
    densest = finer.where("a = b").select(F.col("a").alias("print"))
    last = _bucket_links(densest, last_keys, None)
    return found.where("a <> b").union(finer.where("a <> b")).union(last)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """Per row: doc_id, key (text key), print, component_id, root.

    Equal fingerprints, and those of at most three differing bits, belong together, also by way of
    others. component_id is the smallest id of the component; it is null if no row of it has an id.
    No text and texts without a word have fingerprint zero and are linked like any other. Repeated
    rows each get their row. An empty table gives an empty result; other columns are not read.
    """
    rows = cut(fingerprints(docs, id_col, text_col))
    nodes = cut(rows.groupBy("print").agg(F.min("id").alias("first_id")))
    roots = star_roots(near_links(nodes.select("print"), blocks))
    rooted = cut(nodes.join(roots, F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("p"), "first_id", F.coalesce("root", "print").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    named = rooted.join(smallest, F.col("root") == F.col("r")).select("p", "root", "component_id")
    return rows.join(named, F.col("print") == F.col("p")).select(
        F.col("id").alias("doc_id"), "key", "print", "component_id", "root")


def keep_one_of_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every component the row with the smallest id, all columns as they are."""
    marked = near_duplicates(docs, id_col, text_col)
    first = marked.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key"))).alias("first"))
    return pick_rows(docs, first.select("first.id", "first.key"), id_col, text_col)


def op2_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
