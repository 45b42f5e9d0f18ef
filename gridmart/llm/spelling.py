"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The index of a set of words holds, for every (position, letter), the set of words with that letter
there, one bit a word. A query walks its letters and keeps four sets: words equal so far, and words
with one letter replaced, one letter more or one letter less so far. Each step is a few operations on
whole machine words; the two shifted sets look one position ahead or behind. All queries of a bucket
walk together.

Buckets make that less than all pairs. One edit leaves the letters before it and behind it alone, so
two near words agree on the first or on the second half of the shorter one. A bucket of more than
BUCKET words is dealt anew by the halves of the part that may differ, until it is small or that part
is a single letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import cut, slices, table

#: Fewest code points of a word, fewest occurrences, and how many times as frequent a form must be.
SHORTEST, FEWEST, TIMES = 5, 3, 2
#: One of so many (document, word) pairs loses a letter.
SLIP = 97
#: Words that are searched in one bucket, and words and letters that are indexed together.
BUCKET, TOGETHER, LETTERS = 8192, 1024, 2_000_000
#: Queries that walk together, in words of 64 bits of their sets.
WALK = 65_536
#: Counts that a task holds before it passes them on, in words and in bytes.
HELD, HELD_BYTES = 400_000, 32_000_000
#: Bytes of a text whose runs are all listed at once, and runs that are counted at once in a longer one.
LONG = 400_000

#: Runs of A-Z, a-z and U+00C0 to U+00FF after lower-casing, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")


def slipped(run: bytes, hashed: int) -> bytes:
    """The run without the letter that the hash points at."""
    letters = run.decode()
    at = hashed % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _long_enough(run: bytes) -> bool:
    return len(run) >= SHORTEST and (run.isascii() or len(run) - run.count(b"\xc3") >= SHORTEST)


def _runs(text: bytes) -> Iterator[Counter]:
    """The runs of a text with their counts; of a long text in several parts."""
    # bytes.lower() changes A-Z only.
    text = text.lower()
    if len(text) <= LONG:
        yield Counter(_RUN.findall(text))
        return
    matches = _RUN.finditer(text)
    while part := Counter(m[0] for m in islice(matches, LONG)):
        yield part


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch, texts in slices(batches, "text"):
        for id_, text in zip(batch.column("id").to_pylist(), texts):
            seed = zlib.crc32(b":" if id_ is None else b"%d:" % id_)
            for part in _runs(text or b""):
                for run, times in part.items():
                    hashed = zlib.crc32(run, seed)
                    if hashed % SLIP == 0:
                        run = slipped(run, hashed)
                    if _long_enough(run):
                        before = len(counts)
                        counts[run] += times
                        size += len(run) if len(counts) > before else 0
                if len(counts) > HELD or size > HELD_BYTES:
                    yield out()
                    counts.clear()
                    size = 0
    if counts:
        yield out()


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words (`word`) of whole texts that occur FEWEST times or more, with their count `n`.

    No text has no words; repeated rows count each time. A row without an id hashes as if its id were
    written as nothing. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= FEWEST)


def near_pairs(members: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i < j) of all distinct words one edit apart."""
    n, steps = len(members), max(map(len, members)) + 1
    codes = np.zeros((n, steps + 1), np.uint32)
    flat = np.frombuffer("".join(members).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(w) for w in members])
    rows = np.repeat(np.arange(n), sizes)
    codes[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # Letters are numbered; 0 is the end of a word, which stands at all later positions.
    alphabet, numbers = np.unique(np.append(codes.ravel(), 0), return_inverse=True)
    codes = numbers[:-1].reshape(codes.shape)
    wide = -(-n // 64)

    def sets(position: int) -> np.ndarray:
        has = np.zeros((len(alphabet), wide * 64), bool)
        has[codes[:, position], np.arange(n)] = True
        return np.packbits(has, axis=1, bitorder="little").view(np.uint64)

    block = max(1, WALK // wide)
    starts = range(0, n, block)
    state = []
    for start in starts:
        shape = (min(block, n - start), wide)
        none = np.zeros(shape, np.uint64)
        state.append([np.full(shape, ~np.uint64(0)), none, none, none])
    before, here = None, sets(0)
    for i in range(steps):
        ahead = sets(i + 1)
        for number, start in enumerate(starts):
            letters = codes[start:start + block, i]
            equal, replaced, more, less = state[number]
            same = here[letters]
            state[number] = [
                equal & same,
                (replaced & same) | (equal & ~same),
                (more | equal) & ahead[letters],
                (less & before[letters]) | equal if i else equal,
            ]
        before, here = here, ahead
    left, right = [], []
    for number, start in enumerate(starts):
        equal, replaced, more, less = state[number]
        near = (replaced | more | less) & ~equal
        some = np.flatnonzero(near.any(axis=1))
        bits = np.unpackbits(near[some].view(np.uint8), axis=1, count=n, bitorder="little")
        query, member = np.nonzero(bits)
        query = some[query] + start
        left.append(query[query < member])
        right.append(member[query < member])
    return np.concatenate(left), np.concatenate(right)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows sorted by (m, bucket). Whole buckets are indexed together while they are small."""
    def out(members: dict[str, int]) -> pa.RecordBatch:
        names = list(members)
        left, right = near_pairs(names)
        counts = np.array(list(members.values()), np.int64)
        array = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays([
            array.take(pa.array(left)), array.take(pa.array(right)), pa.array(counts[left]), pa.array(counts[right])],
            ["a", "b", "n_a", "n_b"])

    members: dict[str, int] = {}
    longest, last = 0, None
    for batch in batches:
        for bucket, word, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "word", "n"))):
            longest = max(longest, len(word))
            if bucket != last and (len(members) >= TOGETHER or (len(members) + 1) * longest > LETTERS):
                if len(members) > 1:
                    yield out(members)
                members, longest = {}, len(word)
            members[word], last = n, bucket
    if len(members) > 1:
        yield out(members)


def _bucket(word: Column, m: Column, start: Column, end: Column) -> Column:
    """A hash of what two near words share if they differ between start and end only: the letters before
    and, counted from the end of a shorter word of m letters, those behind."""
    behind = m - end
    return F.xxhash64(m, start, end, F.substring(word, 1, start), F.substring(word, F.length(word) - behind + 1, behind))


def _dealt(regions: DataFrame) -> DataFrame:
    """Every word to the two halves of its region."""
    middle = F.expr("start + (end - start) div 2")
    halves = regions.withColumn("middle", middle).select("word", "n", "m", F.explode(F.array(
        F.struct("start", F.col("middle").alias("end")), F.struct(F.col("middle").alias("start"), "end"))).alias("half"))
    parts = halves.select("word", "n", "m", "half.start", "half.end")
    return parts.withColumn("bucket", _bucket(F.col("word"), F.col("m"), F.col("start"), F.col("end")))


def near_words(vocabulary: DataFrame, bucket_limit: int = BUCKET) -> DataFrame:
    """All pairs (`a`, `b`, `n_a`, `n_b`) of words that differ by exactly one letter inserted, deleted or
    replaced, each pair once. No bucket and no number of partners is cut short."""
    length = F.length("word")
    regions = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where(
        F.col("m") >= SHORTEST).withColumns({"start": F.lit(0), "end": F.col("m")})
    found = None
    while True:
        dealt = cut(_dealt(regions))
        large = dealt.where("end - start > 1").groupBy("bucket").agg(F.count("*").alias("members")).where(
            F.col("members") > bucket_limit).select("bucket")
        large = cut(large)
        is_split = not large.isEmpty()
        small = dealt.join(large, "bucket", "left_anti") if is_split else dealt
        pairs = small.select("m", "bucket", "word", "n").repartition("bucket").sortWithinPartitions("m", "bucket").mapInArrow(
            _found, "a string, b string, n_a long, n_b long")
        found = pairs if found is None else found.unionByName(pairs)
        if not is_split:
            break
        regions = dealt.join(large, "bucket", "left_semi")
    turned = F.when(F.col("a") < F.col("b"), F.struct("a", "b", "n_a", "n_b")).otherwise(F.struct(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b")))
    return found.select(turned.alias("pair")).select("pair.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """`word`, `root` from `word`, `form`: forms are followed two steps at a time. A form is at least twice
    as frequent as its word, so there is no circle and some six rounds reach any end."""
    ways = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut(ways.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ways = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return ways


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      bucket_limit: int = BUCKET) -> DataFrame:
    """Per word of the texts: word, n, n_near, form, form_n, root.

    form is the near word of largest n (of equal ones the least in code-point order) if that is at least
    TIMES the word's n, else null; root is where the forms lead. A table without words gives an empty result.
    """
    vocabulary = cut(words(docs, id_col, text_col))
    pairs = near_words(vocabulary, bucket_limit)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), (-F.col("n_b")).alias("order"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), (-F.col("n_a")).alias("order"), F.col("a").alias("near")))).alias("x"))
    best = both.groupBy("x.word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("x.order", "x.near")).alias("best"))
    top = -F.col("best.order")
    enough = top >= F.col("n") * TIMES
    known = cut(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, top).alias("form_n")))
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


# The CRC-32 remainders of the sixteen half bytes.
_HALF_BYTES = ("0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
               "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108")
_CRC = f"""xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(hex(key)) + 1, 2),
    lambda i: [CAST(instr('0123456789ABCDEF', hex(key)[i + 1]) - 1 AS BIGINT), CAST(instr('0123456789ABCDEF', hex(key)[i]) - 1 AS BIGINT)]))),
    lambda a, x: xor(a >> 4, [{_HALF_BYTES}][CAST(xor(a, x) & 15 AS INTEGER) + 1])), 4294967295)"""

OP12_SQL = rf"""
WITH RECURSIVE run AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, times, {_CRC} AS h FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM run)),
slip AS (
  SELECT times, CASE WHEN h % {SLIP} = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word FROM hashed),
vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slip WHERE len(word) >= {SHORTEST} GROUP BY word HAVING sum(times) >= {FEWEST}),
less AS (
  SELECT word, n, p, word[1:p - 1] || word[p + 1:] AS rest FROM (SELECT *, unnest(range(1, len(word) + 1)) AS p FROM vocabulary)),
pair AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN vocabulary b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top, arg_min(near, (-near_n, near)) AS near FROM pair GROUP BY word),
known AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {TIMES} * n THEN near END AS form,
         CASE WHEN top >= {TIMES} * n THEN top END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS final FROM known
  UNION ALL SELECT way.word, known.form FROM way JOIN known ON way.final = known.word WHERE known.form IS NOT NULL)
SELECT word, form, final AS root, n, n_near, form_n FROM known JOIN way USING (word)
WHERE final IN (SELECT word FROM known WHERE form IS NULL)
"""
