"""The manifest against a tree built in plain Python: several exchanges, ragged ends, odd rows."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridmart.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, fanout):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i:i + fanout])) for i in range(0, len(found[-1]), fanout)])
    return found


def proof_of(levels, place, fanout):
    others = []
    for nodes in levels[:-1]:
        start = place - place % fanout
        others.append(("".join(nodes[start:place]), "".join(nodes[place + 1:start + fanout])))
        place //= fanout
    return others


def plain(rows, fanout):
    """Rows (doc_id, source, lang, n_chars, text) to (id, leaf, subroot, root, proof)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0], leaf_of(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees[name] = levels_of([x[2] for x in groups[name]], fanout)
    top = levels_of([trees[name][-1][0] for name in names], fanout) if names else [[]]
    return sorted(
        (str(id_), leaf, trees[name][-1][0], top[-1][0],
         proof_of(trees[name], place, fanout) + proof_of(top, i, fanout))
        for i, name in enumerate(names) for place, (_, id_, leaf) in enumerate(groups[name]))


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def built(docs, fanout, levels):
    return sorted((str(r.id), r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.proof])
                  for r in merkle.manifest(docs, fanout=fanout, levels=levels).collect())


@pytest.mark.parametrize("fanout,levels,sizes", [
    (2, 1, (1, 2, 3, 17, 33)), (3, 1, (82, 27, 28, 1)), (2, 2, (65,)), (4, 1, (64, 65, 5, 4, 3, 16, 17, 1, 1)),
    (16, 3, (1, 16, 17, 257)), (2, 1, (1,) * 9)])
def test_same_as_plain_trees(spark, fanout, levels, sizes):
    rows = [(100 * i + k, f"s{i}" if i else None, "en", k, f"Text {k} ü") for i, n in enumerate(sizes) for k in range(n)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert built(docs, fanout, levels) == plain(rows, fanout)


ROWS = [(1, None, None, None, None), (None, None, "", 0, ""), (2, "a", "en", 5, "Same"), (2, "a", "en", 5, "Same"),
        (2, "a", "en", 5, "other"), (2, "a", "en", 5, "Same"), (None, "a", "en", 5, "x"), (None, "a", "en", 5, "a"),
        (3, "", "en", 5, "e"), (4, "é", "en", -5, "E\x00Z" * 100_000), (5, "z", "-", 1, "1:-"), (-7, "a", "en", 5, "n")]


def test_cases(spark):
    clash = ("tree", "id", "leaf", "row", "block", "place", "size", "path", "root", "proof", "_part", "tampered")
    docs = spark.createDataFrame([(*r, *[0] * len(clash)) for r in ROWS], COLUMNS + "".join(f", {c} int" for c in clash))
    assert built(docs.repartition(3), 2, 1) == plain(ROWS, 2) == built(docs.coalesce(1), 2, 1)
    assert built(docs, 16, 3) == plain(ROWS, 16)
    assert built(docs.limit(0), 16, 3) == []


def test_one_row_and_one_group(spark):
    one = spark.createDataFrame(ROWS[2:3], COLUMNS)
    assert built(one, 16, 3) == [("2", leaf_of(ROWS[2]), leaf_of(ROWS[2]), leaf_of(ROWS[2]), [])]
    same = spark.createDataFrame([ROWS[2]] * 40, COLUMNS)
    assert built(same, 16, 1) == plain([ROWS[2]] * 40, 16)


def test_every_proof_leads_to_the_root_and_no_other_leaf_does(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}") for k in range(200)]
    kept = merkle.manifest(spark.createDataFrame(rows, COLUMNS), fanout=4, levels=2, keep={"wrong": F.sha2("text", 256)})
    checked = kept.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("good"),
                          (merkle.fold(F.col("wrong"), F.col("proof")) == F.col("root")).alias("bad")).collect()
    assert all(r.good for r in checked) and not any(r.bad for r in checked)


def test_a_third_of_the_rows_are_one_row(spark):
    """Copies of one row spread over ranges, and equal leaves have places of their own."""
    rows = [(k, "s", "en", k, "t") for k in range(600)] + [(7, "s", "en", 7, "t")] * 300
    docs = spark.createDataFrame(rows, COLUMNS).repartition(8)
    assert built(docs, 16, 1) == plain(rows, 16)
    leaves = docs.select(F.lit("s").alias("tree"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))
    ranked = merkle.ranked(leaves, "id", "row").select("place", "size").collect()
    assert sorted(r.place for r in ranked) == list(range(900)) and {r["size"] for r in ranked} == {900}
