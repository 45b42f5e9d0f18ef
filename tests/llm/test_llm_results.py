"""The registered queries over the small tables: against SQL, or against plain Python on every row."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from gridmart.llm import pii, secrets
from gridmart.llm.registered import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark"):
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return found


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_language(spark, con):
    langs = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op1_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def fingerprint(text: str) -> int:
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0D]+", plain)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: dict[int, int]) -> dict[int, int]:
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, docs):
    rows = QUERIES["op2_simhash_dedup"](spark, FOLDER).collect()
    prints = {i: fingerprint(text) for i, text in docs.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == near_components(prints) and len(rows) == len(docs)


def plain_base(text: str) -> list[tuple[int, int, int]]:
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def test_personal_data(spark, docs):
    for r in QUERIES["op4_personal_data"](spark, FOLDER).collect():
        base = plain_base(docs[r.doc_id])
        assert r.base_sha256 == pii.digest_of(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(spans)


def test_numbers_side_by_side_are_told_apart(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    model = pii.learn(docs)
    line = "call +1 (269) 555-3296 4532015112830366 now, or 10.20.30.40 +1 (269) 555-3296 me.to@mail6.example.com"
    base, _ = pii.base_spans(line)
    found = sorted([(pii.KINDS[k], line[a:b]) for k, a, b in base + pii.added_spans(model, line, base)])
    assert found == [("card", "4532015112830366"), ("email", "me.to@mail6.example.com"), ("ip", "10.20.30.40"),
                     ("phone", "+1 (269) 555-3296"), ("phone", "+1 (269) 555-3296")]
    assert pii.added_spans(model, "version 2.0 of 2024, 3 of 17", []) == []


def test_main_text(spark, con):
    import html

    for r in QUERIES["op5_main_text"](spark, FOLDER).collect():
        page = con.execute("SELECT html FROM pages WHERE page_id = ?", [r.page_id]).fetchall()[0][0]
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_secrets(spark, docs):
    word = secrets.PATTERNS["assign"]
    for r in QUERIES["op6_secret_scan"](spark, FOLDER).collect():
        text = docs[r.doc_id]
        base = [(m.start(), 0, "assign", m.end()) for m in re.finditer(word, text, re.A) if len(m[2]) >= 6]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        written = [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(base)]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",") if r.spans else [])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[1] == i for b in base) for i in range(3)]


def test_quality(spark, con):
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op7_quality"](spark, FOLDER.replace("0.001", "0.01")).collect()
    labels = dict(con.execute(f"SELECT doc_id, quality FROM '{FOLDER.replace('0.001', '0.01')}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.93 * len(held)


def check_pieces(rows, docs) -> None:
    """The pieces of every document rebuild its ids; of repeated documents, each copy's."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(docs)
    for id_, text in docs.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        spans = Counter((r.start, r.length) for r in pieces[id_])
        assert len(set(spans.values())) == 1
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
                   and r.offset == 0 for r in pieces[id_])
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_packing(spark, docs):
    check_pieces(QUERIES["op8_binary_packing"](spark, FOLDER).collect(), docs)


def test_winnowing(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op9_winnowing"](spark, FOLDER).collect()}
    order = sorted(docs, reverse=True)
    assert set(rows) == set(docs)
    for at, id_ in enumerate(order):
        text, following = docs[id_], docs[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = rows[id_]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.near_edited == 1.0) or r.fingerprint != r.edited_fingerprint
        if len(text) > 1000 and len(following) > 1000:
            assert 0.2 < r.near_edited < 0.8
    same = {}
    for id_, text in docs.items():
        assert same.setdefault(text, rows[id_].fingerprint) == rows[id_].fingerprint


def test_pipeline_against_plain_python(spark, tmp_path):
    """Every stage on what the stage before kept."""
    read = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = read.collect()
        out = stage(spark, read, FOLDER)
        if name == "binary_packing":
            rows, texts = out.collect(), {r.doc_id: r.text or "" for r in before}
            copies = Counter(r.doc_id for r in before)
            assert Counter(r.doc_id for r in rows if r.start == 0) == copies
            check_pieces(rows, texts)
            break
        path = str(tmp_path / name)
        out.write.parquet(path)
        read = spark.read.parquet(path)
        after = read.collect()
        assert read.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert not Counter(set(after)) - Counter(set(before))
        if name == "quality":
            assert 0.7 * len(before) < len(after) < len(before)
        elif name == "exact_dedup":
            wanted = {}
            for r in sorted(before, key=lambda r: r.doc_id):
                wanted["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")] = r
            assert Counter(after) == Counter(wanted.values())
        elif name == "simhash_dedup":
            found = near_components({r.doc_id: fingerprint(r.text or "") for r in before})
            assert {r.doc_id for r in after} == set(found.values()) and len(after) == len(set(found.values()))
        elif name == "mix_sources":
            sizes, mixed = Counter(), Counter()
            for r in before:
                sizes[r.source] += len(r.text or "")
            rate = {s: sum(sizes.values()) / len(sizes) / n for s, n in sizes.items()}
            expected = sum(rate[r.source] for r in before)
            mixed.update(r.doc_id for r in after)
            assert abs(len(after) - expected) < 5 * expected ** 0.5
            assert [r.doc_id for r in after] != sorted(r.doc_id for r in after)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(rows)
