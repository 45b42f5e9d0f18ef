"""The parts of the operators against plain computations."""

import itertools
import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridmart.llm import html_text, langid, letters, mixing, packing, pii, quality, secrets, simhash, winnow
from gridmart.llm.components import star_roots
from gridmart.llm.cuckoo import SLOTS, CuckooIndex


def _key(i: int) -> tuple:
    return random.Random(i).randbytes(32), i % 7, i


@given(st.lists(st.tuples(st.sampled_from(["put", "drop", "get"]), st.integers(0, 300)), max_size=600))
@settings(max_examples=40, deadline=None)
def test_cuckoo_index_is_a_dictionary(steps):
    index, plain = CuckooIndex(buckets=2), {}
    for what, i in steps:
        key = _key(i)
        if what == "put":
            if index.get(key) is not None:
                assert index.delete(key)
            index.insert(key, (i, len(plain)))
            plain[key] = (i, len(plain))
        elif what == "drop":
            assert index.delete(key) == (plain.pop(key, None) is not None)
        assert index.get(key) == plain.get(key)
    assert dict(index.entries()) == plain and index.live == len(plain)


def test_cuckoo_index_resizes_from_its_stored_keys_and_verifies_hits():
    index = CuckooIndex(buckets=1)
    for i in range(3000):
        index.insert(_key(i), i)
    assert index.resizes > 5 and (index.mask + 1) * SLOTS >= 3000
    assert all(index.get(_key(i)) == i for i in range(3000))
    digest, size, check = _key(5)
    hits = index.false_hits
    assert index.get((digest, size + 1, check)) is None  # the same fingerprint, another key
    assert index.false_hits > hits


def test_codeword_keys_meet_within_one_bit():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 400)
    for bit in [None, *range(23)]:
        others = words if bit is None else words ^ (1 << bit)
        mine, theirs = ([set() for _ in words] for _ in range(2))
        for keys, sets in ((simhash.codeword_keys(words), mine), (simhash.codeword_keys(others), theirs)):
            for place, key in zip(*keys):
                sets[place].add(int(key))
        assert all(a & b for a, b in zip(mine, theirs))
        assert {len(a) for a in mine} <= {1, 6}


@pytest.mark.parametrize("blocks", [simhash.BLOCKS, 5, 6, 7, simhash.FINER_BLOCKS])
def test_bucket_keys_meet_within_three_bits(blocks):
    rng = random.Random(blocks)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        place, key = simhash.bucket_keys(np.array([a, b], np.uint64), blocks)
        assert set(key[place == 0].tolist()) & set(key[place == 1].tolist())


def test_last_keys_meet_within_three_bits_and_bound_a_bucket():
    rng = random.Random(8)
    for _ in range(20):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        place, key = simhash.last_keys(np.array([a, b], np.uint64))
        assert set(key[place == 0].tolist()) & set(key[place == 1].tolist())
    # Keys tell apart whatever differs outside of three blocks: all values of 16 bits, four blocks of them.
    prints = np.arange(1 << 16, dtype=np.uint64)[::16] << np.uint64(7)
    place, key = simhash.last_keys(prints)
    assert len(place) == 560 * len(prints) and np.unique(key, return_counts=True)[1].max() <= 4096


def _components(prints: list[int]) -> dict[int, int]:
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


@pytest.mark.parametrize(("bucket", "finer"), [(1024, 16_384), (4, 16_384), (4, 3)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, bucket, finer):
    """Chains, a dense cluster around one fingerprint, and strangers; also with buckets over the limits."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "FINER_BUCKET", finer)
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(100)} | {0}
    center = rng.getrandbits(64)
    for _ in range(150):
        near = center
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            near ^= 1 << bit
        prints.add(near)
    x = rng.getrandbits(64)
    for _ in range(60):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        prints.add(x)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "print long")).collect()
    assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 3 for r in links)
    found = {r.node & (2 ** 64 - 1): r.root for r in star_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = Counter(found.values())
    wanted = Counter(Counter(_components(list(prints)).values()).values())
    wanted[1] -= len(prints) - len(found) - len(groups)
    sizes = Counter(n + 1 for n in groups.values())
    assert sizes == +(wanted - Counter({1: wanted[1]})) and wanted[1] == 0


def test_star_roots_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rows = star_roots(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    assert star_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    first = np.array([True, False, False, True, False, False])
    weight, total, pairs = np.zeros((6, 3)), 0.0, np.zeros((3, 3))
    for labels in itertools.product(range(3), repeat=6):
        value = sum(scores[t, y] for t, y in enumerate(labels))
        value += sum(moves[labels[t - 1], labels[t]] for t in range(1, 6) if not first[t])
        total += math.exp(value)
        for t, y in enumerate(labels):
            weight[t, y] += math.exp(value)
            if not first[t]:
                pairs[labels[t - 1], y] += math.exp(value)
    got, expected = langid.marginals(scores, moves, first, pairs=True)
    assert np.allclose(got, weight / total) and np.allclose(expected, pairs / total)
    long_scores, long_first = rng.normal(size=(1500, 3)), np.arange(1500) % 700 == 0
    a = langid.marginals(long_scores, moves, long_first)
    parts = [langid.marginals(long_scores[i:i + 700], moves, long_first[i:i + 700]) for i in (0, 700, 1400)]
    assert np.allclose(a, np.concatenate(parts))


def test_semi_markov_sums_and_best_cut_are_those_of_all_cuts():
    text = "+1 (20) 33 45 a@b.c"
    model = pii.Model()
    rng = np.random.default_rng(4)
    stretch = pii.Stretch(text, 0, len(text))
    for _, _, key in stretch.candidates:
        for feature in pii.features(key):
            model.weights.setdefault(feature, rng.normal(size=4) * 0.3)
    model.moves = rng.normal(size=(5, 5))
    n, by_start = len(stretch.tokens), {}
    for c, (i, j, key) in enumerate(stretch.candidates):
        by_start.setdefault(i, []).append((c, j, model.score(key)))
    total, chances, best = 0.0, np.zeros((len(stretch.candidates), 4)), (-math.inf, None)

    def cuts(at, last, value, used):
        nonlocal total, best
        if at == n:
            total += math.exp(value)
            for c, kind in used:
                chances[c, kind] += math.exp(value)
            best = max(best, (value, used), key=lambda x: x[0])
            return
        cuts(at + 1, pii.OUTSIDE, value + model.moves[last, pii.OUTSIDE], used)
        for c, j, score in by_start.get(at, []):
            for kind in range(4):
                cuts(j, kind, value + score[kind] + model.moves[last, kind], [*used, (c, kind)])

    cuts(0, pii.OUTSIDE, 0.0, [])
    got, moves = model.expected(stretch)
    assert np.allclose(got, chances / total)
    assert [(k, *stretch.candidates[c][:2]) for c, k in best[1]] == model.best(text, pii.Tokens(text, 0, len(text)))


def test_poisson_quantile(spark):
    rows = [(u / 97, m) for u in range(1, 97) for m in (0.01, 0.3, 1.0, 4.5, 30.0, 64.0)]
    got = spark.createDataFrame(rows, "u double, m double").select(
        "u", "m", mixing.poisson_quantile(F.col("u"), mixing.poisson_levels(F.col("m"))).alias("n")).collect()
    for r in got:
        n, p = 0, math.exp(-r.m)
        cdf = p
        while cdf < r.u:
            n += 1
            p *= r.m / n
            cdf += p
        assert r.n == n


def test_large_means_are_drawn_as_sums(spark):
    docs = spark.createDataFrame([(i, "x" * 2, "a") for i in range(4)] + [(9, "y" * 8000, "b")], "doc_id long, text string, source string")
    counts = Counter(r.doc_id for r in mixing.mix_sources(docs).collect())
    rate = 8008 / 2 / 8
    assert all(abs(counts[i] - rate) < 6 * math.sqrt(rate) for i in range(4)) and counts[9] <= 6


@given(st.text(st.sampled_from("ab \n"), max_size=400))
@settings(max_examples=60, deadline=None)
def test_winnow_keeps_the_rightmost_minimum_of_every_window(text):
    hashes, places = winnow.winnow(text)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(codes) < winnow.K:
        assert len(hashes) == (1 if text else 0)
        return
    grams = (winnow.kgram_hashes(codes) >> np.uint64(24)).tolist()
    wanted = set()
    for at in range(max(1, len(grams) - winnow.W + 1)):
        window = grams[at:at + winnow.W]
        wanted.add(at + max(i for i, h in enumerate(window) if h == min(window)))
    assert places.tolist() == sorted(wanted)
    assert hashes.tolist() == [grams[p] for p in places]


def test_winnow_in_stretches(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choices("abcd ", k=3000)) + "ab" * 400
    whole = winnow.winnow(text)
    shared = text[1000:1000 + winnow.K + winnow.W - 1]
    assert set(winnow.winnow("zz" + shared + "yy")[0].tolist()) & set(whole[0].tolist())
    for stretch in (100, 257, 1000):
        monkeypatch.setattr(winnow, "STRETCH", stretch)
        parts = winnow.winnow(text)
        assert parts[0].tolist() == whole[0].tolist() and parts[1].tolist() == whole[1].tolist()


def test_short_texts_are_like_their_half_copies():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(500)]
    prose = [" ".join(rng.choices(words, k=60)) for _ in range(801)]
    near = {}
    for i, n in enumerate([*range(20, 200)] * 4):
        text = prose[i][:n]
        edited = winnow.winnow(winnow._edited(text, prose[i + 1]))[0]
        near.setdefault(n, []).append(winnow.likeness(winnow.winnow(text)[0], edited))
    assert all(min(near[n]) > 0 for n in range(22, 200))
    assert sum(x == 0 for n in (20, 21) for x in near[n]) <= 4  # of 8
    assert all(0.3 < sum(near[n]) / 4 < 0.7 for n in range(95, 200))


def test_written_marks_and_likeness_are_those_of_plain_python():
    rng = random.Random(6)
    for n in (0, 1, 9, 40, 1000, 120_000):
        text = "".join(rng.choices("ab é𝔘", k=n))
        a, b = winnow.winnow(text), winnow.winnow(text[n // 2:])
        assert winnow.written(a) == ",".join(f"{h:010x}:{p}" for h, p in zip(*(x.tolist() for x in a)))
        common = sum((Counter(a[0].tolist()) & Counter(b[0].tolist())).values())
        assert winnow.likeness(a[0], b[0]) == (2 * common / (len(a[0]) + len(b[0])) if n else 1.0)


def test_texts_are_grouped_and_long_ones_cut_between_runs():
    rng = random.Random(2)
    texts = ["", "one two", " ".join(rng.choices(["alpha", "be ta", "gamma\n", "12,,,x"], k=300)), "x" * 500, None, "last one"]
    groups = list(letters.grouped(texts, 100))
    assert [t for _, group in groups for t in group] == [t or "" for t in texts]
    assert all(len(group) == 1 or sum(map(len, group)) <= 100 for _, group in groups)
    assert [at for at, _ in groups] == [sum(len(g) for _, g in groups[:i]) for i in range(len(groups))]
    kinds = letters.code_tables()[1]
    for text in texts:
        parts = list(letters.pieces(text or "", 7))
        assert "".join(parts) == (text or "")
        for left, right in zip(parts, parts[1:]):
            assert kinds[ord(left[-1])] != kinds[ord(right[0])] or kinds[ord(left[-1])] == letters.SPACE


LONG_TEXTS = ["a b c a b", None, " ".join("abcdefgh"[i % 8] * (i % 3 + 1) for i in range(600)), "z", "", "-" * 700,
              "".join(f"{i}x, " for i in range(400)), "y" * 300 + " zz " + "1" * 200]


@pytest.mark.parametrize("size", [1, 64, 150])
def test_quality_in_pieces_is_that_of_whole_texts(monkeypatch, size):
    vectors = np.random.default_rng(0).normal(size=(quality.SLOTS, quality.SIZE)).astype(np.float32)
    fixed = quality.fixed_vectors()

    def contexts():
        sums = np.zeros(quality.SLOTS * quality.SIZE)
        for _, slots, text_of, seen in quality.in_pieces(LONG_TEXTS, quality.REACH):
            quality.add_contexts(sums, slots, text_of, fixed, seen)
        return sums

    whole, whole_sums = quality.pooled(vectors, LONG_TEXTS), contexts()
    monkeypatch.setattr(quality, "GROUP", size)
    parts = quality.pooled(vectors, LONG_TEXTS)
    assert np.allclose(whole, parts, rtol=1e-12, atol=1e-9) and np.array_equal(whole_sums, contexts())
    assert (whole[1] == 0).all()


@pytest.mark.parametrize("size", [1, 40, 333])
def test_language_in_pieces_is_that_of_whole_texts(monkeypatch, size):
    """Also where a cut falls between words of different languages, at a border of columns, or in a word
    that is longer than a piece."""
    rng = random.Random(6)
    words = {"aa": ["the", "and", "of", "house"], "bb": ["der", "und", "von", "haus"], "cc": ["el", "y", "de", "casa"]}
    sample = [(label, " ".join(rng.choices(words[label], k=60))) for label in words for _ in range(12)]
    model = langid.train(sample)
    texts = [" ".join(rng.choices(words[label], k=n)) for label in words for n in (3, 255, 256, 257, 700)]
    texts += ["the und der von haus el de " * 90, "x" * 400 + " und der", " .. ", None, "1 2 3 " * 50 + "casa"]
    names, scores = langid.classify(model, texts)
    monkeypatch.setattr(langid, "GROUP", size)
    in_pieces, piece_scores = langid.classify(model, texts)
    assert in_pieces == names and np.allclose(scores, piece_scores, rtol=1e-9, atol=1e-12)
    assert len(set(names)) == 4


def test_a_long_stretch_of_numbers_needs_little_memory():
    import tracemalloc
    rng = random.Random(1)
    text = " ".join(str(rng.randint(0, 99_999)) for _ in range(20_000))
    tokens = pii.Tokens(text, 0, len(text))
    model = pii.train(["call +1 (269) 555-3296 or 4111 1111 1111 1111 now", "mail a@b.org or 10.0.0.1 now"])
    tracemalloc.start()
    model.best(text, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The cached scores of up to 100,000 shapes are most of it; the stretch itself takes some ten bytes a token.
    assert peak < 120e6


def test_large_means_are_inverted(spark):
    """Against cumulative probabilities added up in logarithms."""
    rows = [(u, float(m)) for u in (1e-6, 0.01, 0.3, 0.5, 0.77, 0.999, 1 - 1e-6) for m in (4097, 50_000, 1_000_000)]
    got = spark.createDataFrame(rows, "u double, m double").select(
        "u", "m", mixing.large_poisson_quantile(F.col("u"), F.col("m")).alias("k")).collect()
    for r in got:
        mid = int(r.m)
        k = np.arange(max(0, mid - 12 * int(mid ** 0.5)), mid + 12 * int(mid ** 0.5))
        logs = np.concatenate([[0.0], np.cumsum(np.log(r.m) - np.log(k[1:]))])
        chances = np.exp(logs - logs.max())
        exact = int(k[np.searchsorted(np.cumsum(chances) / chances.sum(), r.u)])
        assert abs(r.k - exact) <= 1, (r.u, r.m)


def test_a_row_of_very_many_copies_is_dealt_out(spark):
    """One short text beside long ones: its copies come in chunks, in more than one task."""
    docs = spark.createDataFrame([(1, "x", "tiny")] + [(i, "y" * 1000, "big") for i in range(2, 202)],
                                 "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs, copy_col="copy").where("source = 'tiny'")
    found = mixed.agg(F.count("*").alias("n"), F.count_distinct("copy").alias("copies"), F.max("copy").alias("most")).first()
    assert found.n == found.copies == found.most and abs(found.n - 100_000) < 2_000
    # A mean of 5e10: the number of copies alone.
    counts = spark.range(1).select(mixing.large_poisson_quantile(mixing.uniform("s", F.lit("1")), F.lit(5e10)).alias("n")).first()
    assert abs(counts.n - 5e10) < 2e6


@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZé'sÀſİΣ<|>09 \t\x1c\x85 ́")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoder_gives_the_tokenizers_ids(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    state = test_encoder_gives_the_tokenizers_ids.__dict__
    if "whole" not in state:
        state["whole"], state["own"] = Tokenizer.from_file(path), packing.Encoder(Path(path).read_text(encoding="utf-8"))
        state["whole"].encode_special_tokens = True
    text += " <|endoftext|> It's"
    assert np.frombuffer(state["own"].ids(text), np.uint32).tolist() == state["whole"].encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "It's", "À 1", "\x1c", "\n", "end"]), max_size=12))
@settings(max_examples=200, deadline=None)
def test_packed_ids_are_those_of_the_unchanged_tokenizer(parts):
    path = public_tokenizers.path("word_bpe_49k.json")
    state = test_packed_ids_are_those_of_the_unchanged_tokenizer.__dict__
    if "whole" not in state:
        state["whole"], state["own"] = Tokenizer.from_file(path), packing.Encoder(Path(path).read_text(encoding="utf-8"), named=True)
    for text in ("".join(parts), "read <|endoftext|> more" + " ".join(parts)):
        assert np.frombuffer(state["own"].ids(text), np.uint32).tolist() == state["whole"].encode(text, add_special_tokens=False).ids


def test_pieces_hold_the_ids_of_named_tokens(spark):
    docs = spark.createDataFrame([(1, "read <|endoftext|> more")], "doc_id long, text string")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).orderBy("start").collect()
    assert np.frombuffer(b"".join(p.ids for p in pieces), np.uint32).tolist() == [1199, 49407, 750, packing.END]


@given(st.integers(1, 40_000))
def test_binary_pieces(n):
    pieces = packing.binary_pieces(n)
    assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
    assert all(p & (p - 1) == 0 and p <= 4096 for p in pieces)
    small = [p for p in pieces if p < 4096]
    assert len(small) == len(set(small))


def _entropy_part(value: str) -> tuple[int, int] | None:
    hits = []
    for at in range(len(value) - secrets.WINDOW + 1):
        window = value[at:at + secrets.WINDOW]
        bits = -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())
        one_case = re.fullmatch("[0-9a-z]*|[0-9A-Z]*", window)
        limit = (secrets.HEX_BITS if set(window) <= set("0123456789abcdefABCDEF") else
                 secrets.CASE_BITS if one_case else secrets.KEY_BITS)
        if not window.isdigit() and bits >= limit - 1e-9:
            hits.append(at)
    return (hits[0], hits[-1]) if hits else None


def test_incremental_entropy(spark):
    rng = random.Random(8)
    alphabets = ["0123456789", "0123456789abcdef", "ABCDEF01", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/", "ab1"]
    values = ["".join(rng.choices(rng.choice(alphabets), k=rng.choice([24, 25, 40]))) for _ in range(150)]
    values += ["".join(rng.choices(letters_ + "0123456789", k=rng.choice([24, 40]))) for _ in range(120)
               for letters_ in ("abcdefghijklmn", "ABCDEFGHIJKLMNOP", "Abcdefghijklmn")]
    # A window of 3.25 bits is above the limit of one case and below that of both.
    between = ["aabbccddeeffg1hi", "AABBCCDDEEFFG1HI", "AAbbccddeeffg1hi"]
    assert [_entropy_part(v) for v in between] == [(0, 0), (0, 0), None]
    values += between
    values += ["".join(rng.choices(alphabets[3], k=30)) + "a" * 700 + "".join(rng.choices(alphabets[3], k=600)) + "b" * 40]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", secrets.suspect_part(F.col("v")).alias("p")).collect()
    for r in got:
        assert ((r.p.first, r.p.last) if r.p.first is not None else None) == _entropy_part(r.v)


def test_places_of_many_matches(spark):
    """More matches than a block: the places are those of plain Python, and overlaps too."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab1 ", "é", "77", " x9y8 ", "-"]) for _ in range(n)) for n in (0, 1, 255, 256, 257, 513, 3000)]
    hits = F.regexp_extract_all("t", F.lit("[0-9]+"), F.lit(0))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", secrets.located(F.col("t"), "[0-9]+", hits, hits).alias("found")).collect()
    for r in got:
        assert [(x.start, x.end, x.value) for x in r.found] == [(*m.span(), m[0]) for m in re.finditer("[0-9]+", r.t)]
    spans = [sorted((a, a + rng.randint(1, 9)) for a in rng.sample(range(9000), n)) for n in (700, 900)]
    kind = "array<struct<start:long,end:long>>"
    kept = spark.createDataFrame([tuple(spans)], f"a {kind}, b {kind}").select(
        secrets._apart(F.col("a"), F.col("b")).alias("kept")).first().kept
    assert [tuple(x) for x in kept] == [x for x in spans[0] if not any(x[0] < e and s < x[1] for s, e in spans[1])]


def test_a_text_of_digests_takes_little_time(spark):
    """A megabyte of hex digests: base spans, and keys beside them."""
    rng = random.Random(4)
    lines = ["".join(rng.choices("0123456789abcdef", k=64)) for _ in range(16_000)]
    lines[100] = lines[8000] = "Zq9LkP3xT7vW1mN8bR5cY2dF6h"
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    start = time.time()
    row = secrets.find_secrets(docs).select(F.size("base").alias("base"), F.size("added").alias("added")).first()
    assert (row.base, row.added) == (15_998, 2) and time.time() - start < 90


@pytest.mark.parametrize("value, allowed", [
    ("some-long-path/with_words/inside", True), ("123e4567-e89b-12d3-a456-426614174000", True),
    ("myEXAMPLEkey1234567890abcd", True), ("Zq9LkP3xT7vW1mN8bR5cY2dF6h", False), ("deadbeef0123deadbeef45670a", False)])
def test_allow_list(spark, value, allowed):
    assert spark.range(1).select(secrets.allowed(F.lit(value))).first()[0] is allowed


def test_random_keys_of_every_alphabet_are_found(spark):
    rng, lower, upper = random.Random(12), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = {"HEX": "0123456789ABCDEF", "BASE32": upper + "234567", "base32": lower + "234567",
                 "BASE36": upper + "0123456789", "base36": lower + "0123456789", "base62": lower + upper + "0123456789",
                 "base64": lower + upper + "0123456789+/"}
    rows = [(f"{name}:{n}:{i}", "key is " + "".join(rng.choices(letters, k=n)) + " there")
            for name, letters in alphabets.items() for n in (16, 20, 24, 32, 40) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = Counter(r.doc_id.rsplit(":", 1)[0] for r in secrets.find_secrets(docs).collect() if r.base or r.added)
    assert len(found) == 35 and min(found.values()) >= 54, found
    assert sum(found.values()) >= 0.98 * len(rows)


def test_placeholders_count_in_the_key_only(spark):
    key = "Zq9LkP3xT7vW1mN8bR5cY2dF6h"
    texts = [f"/home/example/{key}", f"dummy={key}", f"/srv/example1/my-dummy-dir/{key}",
             "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "myEXAMPLEkey1234567890abcd", "getElementByIdAndClassName",
             "some-long-path/with_words/inside", "4111111111111111", "123e4567-e89b-12d3-a456-426614174000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.added for r in secrets.find_secrets(docs).collect()}
    assert [len(rows[i]) for i in range(len(texts))] == [1, 1, 1, 0, 0, 0, 0, 0, 0]
    assert all(rows[i][0].end == len(texts[i]) for i in range(3))


def test_line_blocks():
    assert html_text.regions([]) == []
    assert html_text.regions([5, 0, 0, 0, 200, 0, 30, 0, 0, 0, 10]) == [(2, 7)]
    page = ("<body><div id=top-menu><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div><script>if (a<b) '</p>'</script>"
            "<div><h1>Title &amp; more</h1><p>First  line\n of it</p><p>Short.<p>" + "Long text. " * 20 +
            "</div><div class='user comments'><p>" + "I disagree. " * 30 + "</div><form><p>" + "Your name " * 30 + "</form>")
    assert html_text.main_text(page) == "Title & more\n\nFirst line of it\n\nShort.\n\n" + ("Long text. " * 20).strip()
    assert html_text.main_text("<p class='x") == "" and html_text.main_text("1 < 2") == "1 < 2"
    assert html_text.main_text("<p>only") == "only" and html_text.main_text("<!-- no end <p>x") == ""


@pytest.mark.parametrize("icon", ["<svg class=i width='9'/>", "<svg/>", "<math />", "<SVG viewBox='0 0 1 1' />"])
@pytest.mark.parametrize("later", ["", "<svg><path d='M0'/></svg>", "<p>x <svg/> y</p><math><mi>z</mi></math>"])
def test_self_closed_icons_are_empty(icon, later):
    page = f"<article><p>{icon} First part, here.</p><p>Second part.</p>{later}<p>Last part.</p></article>"
    wanted = ["First part, here.", "Second part.", *(["x y"] if "<p>" in later else []), "Last part."]
    assert html_text.main_text(page) == "\n\n".join(wanted)


def test_short_parts_between_containers_stay():
    long = "Long text of the article. " * 20
    parts = ["<header><h1>Short title</h1></header>", f"<p>{long}</p>", "<aside>See also</aside>", "<p>One line.</p>",
             "<form>Your name <input></form>", "<div class='ad'>Buy this</div>", "<p>The end.</p>"]
    wanted = "\n\n".join(["Short title", long.strip(), "One line.", "The end."])
    for name in ("article", "main"):
        page = f"<body><p>Up here</p><nav>Home</nav><{name}>{''.join(parts)}</{name}><footer>Left</footer><p>Down here</p>"
        assert html_text.main_text(page) == wanted
    linked = f"<article><header><h1><a href=x>Linked title</a></h1></header><p>{long}</p></article>"
    assert html_text.main_text(linked) == "Linked title\n\n" + long.strip()
    page = f"<body><p>Up here</p><nav>Home</nav><p>{long}</p>{''.join(parts[2:])}<form>x</form><p>{long}</p><nav>Next</nav><p>Down here</p>"
    assert html_text.main_text(page) == "\n\n".join([long.strip(), "One line.", "The end.", long.strip()])


@pytest.mark.parametrize("page, text", [
    ("<article><p>Lead text here.</p><p><a href=x>Only a link paragraph</a></p></article>", ["Lead text here.", "Only a link paragraph"]),
    ("<main><p>Lead.</p><ul><li><a href=a>First source</a><li><a href=b>Second source</a></ul></main>",
     ["Lead.", "First source", "Second source"]),
    ("<body><div><h1>Short title</h1></div><div><p>" + "Long text of the page. " * 20 + "</p></div><div><p>The end.</p></div></body>",
     ["Short title", ("Long text of the page. " * 20).strip(), "The end."]),
    ("<body><nav><a href=x>Home</a></nav><div><p>" + "Long text of the page. " * 20 + "</p></div><aside>Advert</aside><div>(c) 2024 Company</div></body>",
     [("Long text of the page. " * 20).strip()]),
    ("<article><p>The text goes on <button>Share</button> in one line.</p></article>", ["The text goes on in one line."]),
])
def test_blocks_of_the_article_stay(page, text):
    assert html_text.main_text(page).split("\n\n") == text


@pytest.mark.parametrize("comment", [
    "<section class='comments-area'><p>{}</p></section>", "<div class='comment-list'><p>{}</p></div>",
    "<article class='comment'><p>{}</p></article>", "<ol class='comments'><li>{}</ol>", "<div id='comments'><article><p>{}</p></article></div>"])
def test_reader_comments_go(comment):
    said = "What a very good article this is, I read it with great pleasure, thank you so much for it. " * 2
    page = "<body><article><p>" + "The article itself. " * 20 + "</p></article>" + comment.format(said) + "</body>"
    assert html_text.main_text(page) == ("The article itself. " * 20).strip()


def test_a_wrapper_named_after_comments_is_read():
    page = "<body><article class='post has-comments no-replies'><p>" + "The article itself. " * 20 + "</p></article></body>"
    assert html_text.main_text(page) == ("The article itself. " * 20).strip()


def test_names_skip_no_article():
    long = "Long text of the article. " * 20
    page = f"<h1>Title</h1><p>{long}</p><p>The end.</p>"
    whole = "\n\n".join(["Title", long.strip(), "The end."])
    for name in ("no-sidebar", "has-banner", "with-sidebar", "page with-sidebar", "widget", "overlay"):
        assert html_text.main_text(f"<body><div class='{name}'>{page}</div><p>Copyright</p></body>").startswith(whole)
        assert html_text.main_text(f"<div id='{name}'><div class=popup><article>{page}</article></div></div>") == whole
    inner = (f"<div class='entry-header'><h1>Title</h1></div><p>{long}</p><h2 id='related-work'>Related work</h2><p>Some.</p>"
             "<h2 class=social>Social</h2><section id='search'><p>Search it</p></section><div class=header><p>By me</p></div>"
             "<p>One <a class='share' href=x>linked</a> and <span id='social'>social</span> tail</p>")
    wanted = ["Title", long.strip(), "Related work", "Some.", "Social", "Search it", "By me", "One linked and social tail"]
    assert html_text.main_text(f"<article>{inner}</article>") == "\n\n".join(wanted)


def test_names_still_skip_what_is_no_article():
    long, other = "Long text of the article. " * 20, "<p>" + "Other things on this site. " * 40 + "</p>"
    for name in ("class=ad", "class='x Comments'", "id=sidebar", "role=navigation", "class='cookie-banner'", "id=social_share"):
        for page in (f"<article><p>{long}</p><div {name}>{other}</div></article>", f"<p>{long}</p><div {name}>{other}</div>",
                     f"<div {name}>{other}<div>{other}</div></div><h1>{long}</h1>"):
            assert html_text.main_text(page) == long.strip()
    short = "<p>A short article.</p><div class=comments><p>" + "I disagree. " * 30 + "</p></div>"
    assert html_text.main_text(short).startswith("A short article.")
    tiny = "<div class=ad>Some words of an advert, more than the article's.</div><article><h1>Reo. Nd.</h1><p>Reo. Nd.</article>"
    assert html_text.main_text(tiny) == "Reo. Nd.\n\nReo. Nd."
    deep = "<div class=ad>" * 3000 + "<p>" + long
    assert html_text.main_text(deep) == long.strip()


def test_long_and_broken_pages_take_little_time():
    assert html_text.main_text("<b>" * 50_000 + "x" + "</i>" * 50_000) == "x"
    html_text.main_text("<a href='" * 20_000)
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 999_999


def test_network_learns_and_its_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 6))
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] * x[:, 1] + x[:, 2])))
    y = (rng.random(1500) < chance).astype(float)
    network = quality.Network(6)
    network.fit(x[:1000], y[:1000], np.ones(1000))
    before = network.probabilities(x[1000:])
    network.calibrate(x[1000:], y[1000:], np.ones(500))
    after = network.probabilities(x[1000:])

    def loss(p):
        return -np.mean(y[1000:] * np.log(p) + (1 - y[1000:]) * np.log(1 - p))

    assert loss(after) <= loss(before) and np.mean((after > 0.5) == y[1000:]) > 0.68
    assert ((after > 0.5) == (before > 0.5)).all()


def test_context_vectors_are_sums_over_neighbours(spark):
    texts = ["a b c a", "b a", None, "", "x"]
    vectors = quality.context_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    places, signs = quality.fixed_vectors()
    fixed = np.zeros((quality.SLOTS, quality.SIZE))
    np.put_along_axis(fixed, places, signs, axis=1)
    sums = np.zeros((quality.SLOTS, quality.SIZE))
    for text in texts:
        slots, _ = quality.word_slots([text])
        for i, j in itertools.permutations(range(len(slots)), 2):
            if abs(i - j) <= quality.REACH:
                sums[slots[i]] += fixed[slots[j]]
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    assert np.allclose(vectors, sums / np.maximum(norms, 1e-9), atol=1e-5)
