"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import os
import random
import subprocess
import sys
import textwrap
import zlib
from collections import Counter
from pathlib import Path

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridmart.llm import common, exact_dedup, html_text, langid, mixing, packing, pii, quality, secrets, simhash, winnow

from gridmart.llm.common import text_key

ROOT = Path(__file__).resolve().parent.parent.parent
#: Columns with the names that the operators use inside.
CLASH = ("id", "key", "row", "score", "print", "component_id", "root", "rate", "copies", "copy", "place", "range",
         "lent", "base", "added", "quality_score", "digest", "length", "kept", "hits_hex", "size", "label")
LONG = "The quick brown fox 4111 1111 1111 1111 jumps. " * 6000
ROWS = [
    (1, "Hello WORLD again, dear reader", "en", "a", 5), (2, "hello world again, dear reader", "en", "a", 5),
    (3, None, None, None, None), (4, "", "en", None, 0), (None, "hello world again, dear reader", "de", "b", 1),
    (None, None, None, "b", None), (5, "...", "de", "b", 3), (6, LONG, "en", "a", len(LONG)), (7, LONG + "x", "en", "a", 1),
    (8, "Guten Tag lieber Leser", "de", "b", 2), (8, "Guten Tag lieber Leser", "de", "b", 2), (8, "Guten Tag!", "de", "b", 2),
    (9, "a\x00b \x1c c", "xx", "c", 1), (10, "x" * 300_000, "en", "c", 1), (11, " \t\n", "en", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(*row, *[-1] * len(CLASH)) for row in ROWS]
    return spark.createDataFrame(rows, schema + "".join(f", `{c}` int" for c in CLASH)).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 0, 0), (8, 0, 1), (9, None, None), (None, 1, 1), (77, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def _ids(rows):
    return Counter(r.doc_id for r in rows)


EVERY = Counter(r[0] for r in ROWS)


def test_language(docs, empty):
    model = langid.learn(docs)
    rows = langid.identify(docs, model).collect()
    assert Counter(r.id for r in rows) == EVERY
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.id in (3, 4, 5, 11)} == {"und"}
    assert next(r for r in rows if r.id == 6).lang_pred == "en"
    assert langid.learn(empty) is None and langid.identify(empty, None).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.classify(model, []) == ([], [])


def test_near_duplicates(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert _ids(rows) == EVERY
    of = {r.doc_id: r.component_id for r in rows}
    assert of[1] == of[2] == of[None] == 1 or of[None] == 3  # one of the rows without an id has no text
    assert of[3] == of[4] == of[11] == 3 and of[6] == of[7] == 6
    kept = simhash.keep_one_of_near(docs)
    assert kept.columns == docs.columns
    roots = {r.root for r in rows}
    assert kept.count() == len(roots)
    assert {1, 3, 6} <= {r.doc_id for r in kept.collect()}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_near(empty).count() == 0


def test_near_duplicates_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "A B c")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(docs).collect()] == [None] * 3
    assert simhash.keep_one_of_near(docs).count() == 1


def test_exact_duplicates(docs, empty):
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert _ids(rows) == EVERY
    groups = Counter(hashlib.sha256((r[1] or "").encode().lower()).hexdigest() for r in ROWS)
    assert Counter({r.text_sha256: r.group_size for r in rows}) == groups
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(dict.fromkeys(groups, 1))
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert {r.keep_id for r in rows if r.doc_id in (1, 2)} == {2} and {r.keep_id for r in rows if r.doc_id in (3, 4)} == {4}
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_personal_data(docs, empty):
    model = pii.learn(docs)
    rows = pii.find_personal_data(docs, model).collect()
    assert Counter(r.id for r in rows) == EVERY
    assert len(next(r for r in rows if r.id == 6).base) == 6000
    assert all(not r.base and not r.added for r in rows if r.id in (3, 4, 5, 11, 10))
    assert pii.find_personal_data(empty, pii.learn(empty)).count() == 0
    spans, dropped = pii.base_spans("a@b..c x@y.z@w.v 1.2.3.4.5 300.1.1.1 @q.r +1 2 +12345678")
    assert spans == [(0, 7, 12), (1, 17, 24), (3, 47, 56)] and dropped == [(27, 36), (42, 46)]


def test_addresses_with_many_zeros(spark):
    zeros = "0" * 5000
    texts = [f"at 1.2.3.{zeros} now", f"{zeros}7.2.3.4", f"1.2.3.{zeros}256", "0.0.0.0 1.2.3.4", "1.2².3.4 m"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find_personal_data(docs, pii.learn(docs)).collect()}
    assert rows == {0: [(1, 3, 5009)], 1: [(1, 0, 5007)], 2: [], 3: [(1, 0, 7), (1, 8, 15)], 4: []}


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>Hello</p>", 1), (2, None, None, 2), (None, "v", "", 3), (1, "u", "<p>Hello</p>", 4),
         (5, "w", "<p>" + "word " * 100_000, 5)], "page_id long, url string, html string, text int")
    rows = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 0), (1, 5), (1, 5), (2, 0), (5, 499_999)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_secrets(docs, empty, spark):
    rows = secrets.find_secrets(docs).collect()
    assert _ids(rows) == EVERY and all(not r.base and not r.added for r in rows)
    some = spark.createDataFrame([(1, 'é𝔘 password="abcdefgh" Token: xy AKIA' + "Q" * 16 + " " + "0f" * 12, 0)],
                                 "doc_id long, text string, text_key int")
    row = secrets.find_secrets(some).first()
    assert [(s.kind, s.start, s.end) for s in row.base] == [("assign", 3, 21), ("access", 33, 53), ("hex", 54, 78)]
    assert secrets.find_secrets(empty).count() == 0


def test_quality(docs, empty, labels, spark):
    model = quality.learn(docs, labels)
    rows = quality.scored(docs, model).collect()
    assert Counter(r.row.doc_id for r in rows) == EVERY and all(0 <= r.quality_score <= 1 for r in rows)
    assert quality.keep_good(docs, model).columns == docs.columns
    none = quality.learn(empty, labels.limit(0))
    assert none.network is None and quality.scored(empty, none).count() == 0
    one = quality.learn(docs, labels.where("quality = 1"))
    assert {r.quality_score for r in quality.scored(docs, one).collect()} == {1.0}


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(docs, path).collect()
    assert set(_ids(pieces)) == set(EVERY)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.length & (p.length - 1) == 0 and p.length == 1 << p.sequence_id % 16 and len(p.ids) == 4 * p.length for p in pieces)
    assert [(p.start, p.length, p.ids) for p in pieces if p.doc_id == 4] == [(0, 1, (2).to_bytes(4, "little"))]
    assert sum(p.length for p in pieces if p.doc_id == 8) > 2 and packing.pack(empty, path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, path, longest=100)


def test_buckets_of_sequences(docs, tmp_path):
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    packing.write_buckets(pieces, str(tmp_path / "s"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.where("length = 1").count() == pieces.where("length = 1").count() > 0


def test_winnowing(docs, empty, spark):
    rows = winnow.compare_with_next(docs).collect()
    assert _ids(rows) == EVERY and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    ordered = [(i, text or "") for i, text in sorted(((r[0], r[1]) for r in ROWS if r[0] is not None and r[0] != 8),
                                                    key=lambda x: -x[0])]
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 8)}
    for (a, text), (_, following) in zip(ordered, ordered[1:]):
        if a not in (9, ):
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            assert by_id[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    single = winnow.compare_with_next(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in single] == [(2, 1.0)]
    assert single[0].edited_sha256 == hashlib.sha256(b"aa").hexdigest()
    assert winnow.compare_with_next(empty).count() == 0


@pytest.mark.parametrize("hot", [5, None])
def test_winnowing_of_one_hot_id(spark, hot):
    """Most rows have one id, or none: they are cut by text key, and the order is that of one list."""
    rows = [(i, f"text number {i} of all") for i in range(40)] + [(hot, f"another text {i} under one id") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text").collect()
    order = sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.key), reverse=True)
    expected = Counter()
    for row, following in zip(order, [*order[1:], order[0]]):
        half = len(row.text) // 2
        edited = row.text[:len(row.text) - half] + following.text[:half]
        expected[row.doc_id, hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = winnow.compare_with_next(docs)
    assert Counter((r.doc_id, r.edited_sha256) for r in got.collect()) == expected


def test_ranges_are_few_and_in_order():
    rng = random.Random(0)
    ids = sorted([7] * 40 + rng.choices(range(1000), k=60))
    ranges = winnow.Ranges(ids, 0.25, 100)
    rows = sorted(((i, k) for i in [*range(-5, 1005), 7, 7, 7] for k in (rng.randrange(-(1 << 63), 1 << 63) for _ in range(3))), reverse=True)
    numbers = ranges.of(pd.Series([i for i, _ in rows]), pd.Series([k for _, k in rows])).tolist()
    assert numbers == sorted(numbers)
    hot = {n for (i, _), n in zip(rows, numbers) if i == 7}
    assert len(hot) > 5 and not hot & {n for (i, _), n in zip(rows, numbers) if i != 7}
    missing = ranges.of(pd.Series([None] * 50, dtype="float64"), pd.Series([rng.randrange(-(1 << 63), 1 << 63) for _ in range(50)]))
    assert min(missing) > max(numbers) and len(set(missing)) > 10


@pytest.mark.parametrize("most", [1, 5])
def test_full_indexes_are_passed_on(spark, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "MOST_LIVE", most)
    rows = [(i, f"Text {i % 40}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup.exact_duplicates(docs).collect()
    assert all(r.keep_id == max(i for i in range(300) if i % 40 == r.doc_id % 40) and r.kept == (r.keep_id == r.doc_id)
               and r.group_size == len(range(r.doc_id % 40, 300, 40)) for r in got) and len(got) == 300


def test_a_repeated_row_is_the_least_one(spark):
    """Rows that repeat id and text but differ elsewhere: the same one stays at any partitioning."""
    rows = [(1, "same", lang) for lang in ("de", "aa", None, "en")] + [(2, "other", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {tuple(sorted(map(str, exact_dedup.drop_exact_duplicates(docs.repartition(n)).collect()))) for n in (1, 2, 5)}
    assert len(found) == 1 and "lang=None" in next(iter(found))[0]
    maps = docs.withColumn("more", F.create_map(F.lit("k"), F.col("lang")))
    assert {r.doc_id for r in exact_dedup.drop_exact_duplicates(maps).collect()} == {1, 2}


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())


def test_models_travel_without_the_package(tmp_path):
    """Workers that cannot import this package still run what learns a model and applies it."""
    script = textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
            "spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        sys.path.insert(0, {str(ROOT)!r})
        from gridmart.llm import decontam, langid, pii, quality
        def importable(batches):
            import importlib.util, pyarrow as pa
            for batch in batches:
                yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("gridmart") is not None]}})
        print("importable", spark.range(1).mapInArrow(importable, "found boolean").first()[0])
        docs = spark.createDataFrame([(i, f"hello world number {{i}} mail a@b.org" if i % 2 else f"guten tag nummer {{i}}",
                                       "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
        print("op1", len(langid.identify(docs, langid.learn(docs)).collect()))
        print("op4", len(pii.find_personal_data(docs, pii.learn(docs)).collect()))
        labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
        print("op7", len(quality.scored(docs, quality.learn(docs, labels)).collect()))
        items = docs.selectExpr("doc_id as item_id", "text").limit(3)
        print("op11", len(decontam.find_passages(docs, items).collect()))
    """)
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=400, cwd=tmp_path, env=environment)
    assert done.stdout.split("\n")[:-1] == ["importable False", "op1 40", "op4 40", "op7 40", "op11 40"], done.stderr[-3000:]


def test_mixing(docs, empty):
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    counted = mixing.mix_sources(docs, copy_col="copy_no").groupBy("doc_id", "copy_no", "text", "lang").count().collect()
    per_id = {}
    for r in counted:
        per_id.setdefault((r.doc_id, r.text, r.copy_no), r["count"])
    assert {n for (i, _, _), n in per_id.items() if i not in (8, None)} <= {1}
    only = mixing.mix_sources(docs, {"b": 2.0})
    assert {r.source for r in only.collect()} <= {"b"}
    assert mixing.mix_sources(docs, {}).count() == 0 and mixing.mix_sources(empty).count() == 0


def test_pipeline_stages(docs, spark, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for rows in (read, read.limit(0)):
            out = stage(spark, rows, str(tmp_path))
            out.count()
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns


def test_held_out_folds(spark):
    got = spark.range(200).select("id", langid.remainder(__import__("pyspark.sql.functions").sql.functions.col("id"), 3).alias("r"))
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 3 for r in got.collect())
