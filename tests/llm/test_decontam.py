"""Benchmark passages: the search against plain Python, in classes, parts and pieces, and odd inputs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridmart.llm import decontam, wumanber

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, size=10):
    """Words, hit words and items of a text, window by window."""
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items:
        own = words_of(item_text)
        k = min(size, len(own))
        for start in range(max(len(own) - size, 0) + 1 if own else 0):
            for at in range(len(words) - k + 1):
                if words[at:at + k] == own[start:start + k]:
                    hit.update(range(at, at + k))
                    found.add(item)
    return len(words), hit, found - {None}


def in_spans(spans):
    return {i for a, b in spans for i in range(a, b)}


@pytest.mark.parametrize("seed", range(6))
def test_strings_are_found_wherever_they_are(seed):
    draw = random.Random(seed)
    text = "".join(draw.choice("ab ") for _ in range(5000)).encode()
    strings = sorted({text[at:at + n] for n in (1, 2, 7, 8, 9, 16, 40, 300) for at in draw.sample(range(4700), 4)})
    strings += [b"nowhere in the text", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaab"]
    found = wumanber.Searcher(strings).search(text + bytes(8), lambda at: at >= 0)
    expected = [(at, at + len(s), i) for i, s in enumerate(strings)
                for at in range(len(text)) if text[at:at + len(s)] == s]
    assert sorted(zip(*(x.tolist() for x in found))) == sorted(expected)


def test_windows_move_by_more_than_one():
    """A text without any block of the strings is passed in steps of a whole window."""
    length = wumanber.Length([b"benchmark question number seven ", b"another question of the set "], None)
    assert length.m == 28 and length.block == 8
    assert (length.shifts == 21).mean() > 0.9 and length.shifts.min() == 0
    assert len(length.candidates(__import__("numpy").frombuffer(b"z" * 4096, "u1"), 4088)) == 0


def test_pieces_give_the_same_stream(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choice("aB9é \n.-") for _ in range(draw.choice((0, 1, 5, 60, 200)))).encode() for _ in range(300)]
    whole = decontam.stream(texts)
    for piece in (1, 2, 7, 50):
        monkeypatch.setattr(decontam, "PIECE", piece)
        assert decontam.stream(texts) == whole
    lines = bytes(whole[:-8]).decode().split("\n")[:-1]
    assert lines == ["".join(f"{w} " for w in words_of(t.decode())) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_same_as_word_by_word(seed):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "ab", "Ünder", "X1", "no"]
    line = lambda n: "".join(draw.choice(vocabulary) + draw.choice((" ", ", ", "\n", "--")) for _ in range(n))
    items = [(str(i), line(draw.choice((0, 1, 2, 5, 9, 10, 11, 25)))) for i in range(12)]
    texts = [line(draw.choice((0, 3, 40, 200))) + draw.choice(items)[1] + line(5) for _ in range(30)]
    strings: dict[bytes, set] = {}
    for item, text in items:
        own = words_of(text)
        for start in range(max(len(own) - 10, 0) + 1 if own else 0):
            strings.setdefault("".join(f"{w} " for w in own[start:start + 10]).encode(), set()).add(item)
    searcher = wumanber.Searcher(list(strings))
    rows = decontam.find(searcher, [sorted(x) for x in strings.values()], [t.encode() for t in texts])
    for text, (n, spans, found) in zip(texts, rows):
        words, hit, expected = plain(text, items)
        assert (n, in_spans(spans), found) == (words, hit, expected)
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (10, "short item"), (2, "Größe"),
         (None, "nameless words here"), (3, None), (4, "..."), (10, "second text of ten"), (5, "one two three four five six seven eight nine ten")]
DOCS = [(1, "intro: ONE two, three four five six seven eight nine ten! outro"), (2, None), (3, ""), (4, "a short  item, größe Größe"),
        (None, "these nameless words here"), (1, "nothing"), (1, "nothing"), (6, "short " * 50_000 + "item"),
        (7, "-" * 300_000 + "second text" + " " * 70_000 + "of ten"), (8, "two three four five six seven eight nine ten eleven")]


@pytest.mark.parametrize("part_bytes", [decontam.PART_BYTES, 60])
def test_cases(spark, part_bytes, monkeypatch):
    clash = "".join(f", {c} int" for c in ("id", "words", "items", "spans", "string"))
    docs = spark.createDataFrame([(*d, *[0] * 5) for d in DOCS], "doc_id long, text string" + clash).repartition(2)
    benchmark = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, item int")
    rows = decontam.find_passages(docs, benchmark, part_bytes=part_bytes).withColumn("n_hit", decontam.n_hit()).collect()
    items = [(None if i is None else str(i), text) for i, text in ITEMS]
    expected = []
    for doc_id, text in DOCS:
        if len(text or "") < 1000:
            n, hit, found = plain(text, items)
            expected.append((doc_id, n, len(hit), sorted(found)))
    expected += [(6, 50_001, 2, ["10"]), (7, 4, 4, ["10"])]
    assert sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in rows), key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.find_passages(docs.limit(0), benchmark).count() == 0
    rows = decontam.find_passages(docs, benchmark.limit(0)).collect()
    assert len(rows) == len(DOCS) and all(not r.spans and not r["items"] for r in rows)
    assert decontam.find_passages(docs, benchmark.where(F.col("text").isNull())).where("size(spans) > 0").isEmpty()
