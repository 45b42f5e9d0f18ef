"""Merkle manifest of a table: a root, and for every row the proof that leads from it to the root.

Rows are placed in the order of their group and dealt into aligned blocks of FANOUT ** LEVELS leaves.
A block hashes its own subtree. Then the blocks exchange subtree roots, butterfly fashion: in round r
a block asks the blocks whose number differs from its own in the r-th digit (base FANOUT), each of
which knows the root of the subtree that it shares with its neighbours of lower digits. All blocks
hash the same ancestors on their own, so after the last round each knows the group's root and the
upper part of its proofs, and nothing has to come down the tree again. The group roots are the leaves
of a last tree, which is built the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.llm.common import cut, table

FANOUT = 16
#: Levels of the tree inside one block.
LEVELS = 3
#: Every so many rows are tampered with, to see that their proofs fail.
TAMPERED = 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def leaf(*columns: Column) -> Column:
    """Digest of a row: its values with their lengths in bytes, so that no two rows read alike."""
    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest leads to: the last hash along its proof."""
    return F.aggregate(proof, digest, lambda d, step: F.sha2(F.concat(step["before"], d, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """The other digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Adds `place` (from 0, in the order of the columns given) within `tree`, and `size` of the tree.

    Rows are sorted by ranges, so a tree may lie in many partitions; only one line per tree and
    partition is counted up. The last column of the order must tell rows apart, so that no range
    holds more rows than others.
    """
    whole = cut(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    parts = whole.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    ahead = F.coalesce(F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "_part", (ahead - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("size"))
    return whole.join(parts, ["tree", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _tree_levels(leaves: list[str], size: int, fanout: int, levels: int) -> list[list[str]]:
    """The levels of a block's subtree, the leaves first; all `levels` if the tree has other blocks."""
    found, nodes = [leaves], size
    while nodes > 1 and len(found) <= levels:
        below = found[-1]
        found.append([_hash(below[i:i + fanout]) for i in range(0, len(below), fanout)])
        nodes = -(-nodes // fanout)
    return found


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (tree, block) at a time, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column("tree").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((trees[1:] != trees[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            part = batch.slice(start, end - start)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("tree", "block")):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _roots(fanout: int, levels: int):
    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []
        for part in _by_block(batches):
            size = part.column("size")[0].as_py()
            top = _tree_levels(part.column("leaf").to_pylist(), size, fanout, levels)[-1]
            lines.append((part.column("tree")[0].as_py(), part.column("block")[0].as_py(), size, top[0]))
            if len(lines) == 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(("tree", "block", "size", "digest"), map(list, zip(*lines)))))
                lines = []
        if lines:
            yield pa.RecordBatch.from_pydict(dict(zip(("tree", "block", "size", "digest"), map(list, zip(*lines)))))
    return roots


def exchange(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Blocks (`tree`, `block`, `size`, `digest`) to blocks with the root of their tree as digest, and
    with `path`: for each round the digests before and after the block's own.

    A block asks one block of each neighbouring subtree, the one whose lower digits are its own. The
    subtree at a tree's end may lack it; then those that are there are asked in turn.
    """
    nodes = cut(nodes.withColumn("path", F.array().cast(_PATH)))
    most = nodes.agg(F.max("size")).first()[0] or 0
    leaves, step = fanout ** levels, 1
    while most > leaves * step:
        active = nodes.where(F.col("size") > leaves * step)
        spot = F.expr(f"cast((block div {step}) % {fanout} as int)")
        first = F.expr(f"block - block % {step * fanout} + other * {step}")
        end = F.least(F.expr(f"(size - 1) div {leaves} + 1"), F.col("first") + step)
        asking = active.select("tree", "block", "size", spot.alias("spot"), F.explode(
            F.sequence(F.lit(0), F.lit(fanout - 1))).alias("other")).withColumn("first", first).withColumn("end", end)
        asking = asking.where("first < end").withColumn("asked", F.expr(f"first + (block % {step}) % (end - first)"))
        asked = active.select("tree", F.col("block").alias("asked"), F.col("digest").alias("answer"))
        runs = asking.join(asked, ["tree", "asked"]).groupBy("tree", "block", "spot").agg(
            F.array_sort(F.collect_list(F.struct("other", "answer"))).alias("run")).select(
            "tree", "block", "spot", F.col("run.answer").alias("run"))

        def joined(begin: Column, length: Column) -> Column:
            return F.array_join(F.slice("run", begin, length), "")

        around = F.struct(joined(F.lit(1), F.col("spot")).alias("before"),
                          joined(F.col("spot") + 2, F.lit(fanout)).alias("after"))
        climbed = active.join(runs, ["tree", "block"]).select(
            "tree", "block", "size", F.sha2(F.array_join("run", ""), 256).alias("digest"),
            F.concat("path", F.array(around)).alias("path"))
        nodes = cut(climbed.unionByName(nodes.where(F.col("size") <= leaves * step)))
        step *= fanout
    return nodes


def _proofs(fanout: int, levels: int):
    """The rows of each block with their proofs; the block's first row holds the upper part of them."""
    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_block(batches):
            head, rows = part.slice(0, 1).to_pylist()[0], part.slice(1)
            tree = _tree_levels(rows.column("leaf").to_pylist(), rows.column("size")[0].as_py(), fanout, levels)
            around = []
            for nodes in tree[:-1]:
                runs = [i - i % fanout for i in range(len(nodes))]
                around.append((["".join(nodes[s:i]) for i, s in enumerate(runs)],
                               ["".join(nodes[i + 1:s + fanout]) for i, s in enumerate(runs)]))
            upper = [[step[side] for step in head["path"]] for side in ("before", "after")]
            deep, names = len(around) + len(head["path"]), rows.schema.names
            for start in range(0, rows.num_rows, 1024):
                some = rows.slice(start, 1024).combine_chunks()
                flat = [[x for k in range(start, start + some.num_rows) for x in (
                    *(level[side][k // fanout ** up] for up, level in enumerate(around)), *upper[side])] for side in (0, 1)]
                steps = pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in flat], ["before", "after"])
                path = pa.ListArray.from_arrays(pa.array(np.arange(some.num_rows + 1) * deep, pa.int32()), steps)
                new = {"path": path, **{c: pa.array([head[c]] * some.num_rows, pa.string()) for c in ("subroot", "root")}}
                yield pa.RecordBatch.from_arrays(
                    [new[c] if c in new else some.column(c).combine_chunks() for c in names], names)
    return proofs


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _blocks(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Blocks of placed leaves with the root and the upper path of their tree."""
    short = _in_blocks(rows.select("tree", "block", "place", "size", "leaf"))
    return exchange(short.mapInArrow(
        _roots(fanout, levels), "tree string, block long, size long, digest string"), fanout, levels)


def _proved(rows: DataFrame, blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Leaves with path, subroot and root, which their blocks know."""
    both = rows.unionByName(blocks.withColumn("place", F.lit(-1).cast("long")), allowMissingColumns=True)
    return _in_blocks(both).mapInArrow(_proofs(fanout, levels), both.schema)


def manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             id_col: str = "doc_id", group_col: str = "source", keep: dict[str, Column] | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row of docs: id, leaf, subroot, root, proof (for each level the digests before and after the
    row's own, joined) and the columns of `keep`, which are computed from docs.

    The groups are the trees below the root, NULL first, then bytewise; the id orders a group's leaves,
    NULL first. Rows of one id follow the order of their digests, so that equal rows have different places
    and proofs that belong to them in any order. An empty table gives an empty result. A table of one row
    has its leaf as root and an empty proof. Columns that are not named are not read.
    """
    name = F.col(group_col).cast("string")
    tree = F.when(name.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), name))
    kept = {f"_keep_{c}": column for c, column in (keep or {}).items()}
    leaves = cut(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf(*[F.col(c) for c in columns]).alias("leaf"),
                             *[column.alias(c) for c, column in kept.items()],
                             F.monotonically_increasing_id().alias("row")))

    def placed(rows: DataFrame, *order: str) -> DataFrame:
        return ranked(rows, *order).withColumn("block", F.expr(f"place div {fanout ** levels}"))

    rows = cut(placed(leaves, "id", "leaf", "row").drop("row"))
    blocks = _blocks(rows, fanout, levels)
    subroots = blocks.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("digest").alias("leaf"))
    tops = cut(placed(subroots, "id"))
    top_blocks = _blocks(tops, fanout, levels).select(
        "tree", "block", "path", F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    above = _proved(tops, top_blocks, fanout, levels).select(F.col("id").alias("tree"), "root", F.col("path").alias("above"))
    known = blocks.join(above, "tree").select(
        "tree", "block", F.concat("path", "above").alias("path"), F.col("digest").alias("subroot"), "root")
    return _proved(rows, known, fanout, levels).select(
        "id", "leaf", "subroot", "root", F.col("path").alias("proof"),
        *[F.col(c).alias(c.removeprefix("_keep_")) for c in kept])


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without an id are not tampered with."""
    docs = table(spark, folder, "documents")
    lowered = leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.translate("text", UPPER, LOWER))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, lowered)
    rows = manifest(docs, keep={"tampered": tampered})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(most_levels: int = 6, top_levels: int = 4) -> str:
    """The same level by level, for up to FANOUT ** most_levels rows of a source."""
    def part(column: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({column} AS VARCHAR))) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"

    def digest(text: str) -> str:
        return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    # The CRC-32 remainders of the sixteen half bytes.
    half_bytes = ("0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
                  "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108")
    nibbles = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) & 15 AS BIGINT), CAST(ord(c) >> 4 AS BIGINT)]))"
    crc = (f"xor(list_reduce(list_concat([4294967295], {nibbles}), "
           f"lambda a, x: xor(a >> 4, [{half_bytes}][CAST(xor(a, x) & 15 AS INTEGER) + 1])), 4294967295)")
    steps = []
    for prefix, levels, keys in (("s", most_levels, "tree"), ("t", top_levels, "one")):
        for i in range(levels):
            steps.append(f"""{prefix}r{i} AS (
  SELECT {keys}, i // {FANOUT} AS run, n, list(d ORDER BY i) AS ds FROM {prefix}{i} GROUP BY ALL),
{prefix}{i + 1} AS (
  SELECT {keys}, run AS i, (n + {FANOUT - 1}) // {FANOUT} AS n, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d
  FROM {prefix}r{i}),
{prefix}p{i + 1} AS (
  SELECT p.* EXCLUDE (i, proof, folded), i // {FANOUT} AS i,
         CASE WHEN n > 1 THEN proof || array_to_string(list_concat(ds[1:i % {FANOUT}], ds[i % {FANOUT} + 2:]), '') ELSE proof END AS proof,
         CASE WHEN n > 1 THEN sha256(array_to_string(list_concat(ds[1:i % {FANOUT}], [folded], ds[i % {FANOUT} + 2:]), '')) ELSE folded END AS folded
  FROM {prefix}p{i} p JOIN {prefix}r{i} r ON r.{keys} = p.{keys} AND r.run = p.i // {FANOUT})""")
        if prefix == "s":
            steps.append(f"""t0 AS (
  SELECT 1 AS one, tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, d FROM s{levels}),
tp0 AS (SELECT p.* EXCLUDE (i), 1 AS one, t0.i, t0.d AS subroot FROM sp{levels} p JOIN t0 USING (tree))""")
    return f"""
WITH docs AS (
  SELECT *, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree, {digest('text')} AS leaf,
         CASE WHEN {crc} % {TAMPERED} = 0 THEN {digest(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered
  FROM documents),
s0 AS (
  SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n,
         leaf AS d, doc_id, tampered FROM docs),
sp0 AS (SELECT tree, i, doc_id, d AS leaf, coalesce(tampered, d) AS folded, '' AS proof FROM s0),
{",".join(steps)}
SELECT doc_id, leaf, subroot, (SELECT d FROM t{top_levels}) AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = (SELECT d FROM t{top_levels}) AS verified
FROM tp{top_levels}
"""


OP13_SQL = _sql()
