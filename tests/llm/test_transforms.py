"""Fill-in-the-middle, importance resampling and the token files against brute force: nulls, empty and long texts,
repeated rows and ids, ties, empty tables, columns with clashing names."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchlake.llm import fim, importance, registry, token_file

RNG = random.Random(5)
VOCABULARY = ["Alpha", "beta", "GAMMA's", "x", "12345", "Élan", "naïve", "日本語", "İSTANBUL", "ΣΑΣ", "don't", "a-b_c", "🙂🙂", "é", "́", "<|endoftext|>", "x<|startoftext|>y", " ", " ", "\x1c", "\x0b", "ﬁ"]


def prose(n):
    return "".join(RNG.choice(VOCABULARY) + RNG.choice([" ", " ", "\n", " \n\n", "\t", ". ", "\r\n", "\x0c"]) for _ in range(n))


LONG = prose(3000)
ROWS = [
    (0, None), (1, ""), (2, "\n"), (3, "one line"), (4, "a\nb\nc\n"), (5, "a\nb\nc"), (6, "x <P> y\nz"), (7, "\n\n\n"), (8, "<S>"), (9, LONG), (10, LONG), (11, prose(40)), (11, prose(41)), (11, ROWS_11 := prose(60)), (11, ROWS_11),
    (None, prose(30)), (None, prose(31)), (None, None), (-4, "w" * 5000), (12, "<P\n<P\nS>\n>"), (13, "<\nM\n>\n<\nP>"), (14, "日\n本\n語"), (15, "one  two \n three"), (16, "a\r\nb\rc d"), *((k, prose(RNG.randint(15, 60))) for k in range(20, 60)),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("clash") for c in ("n", "form", "h1", "row", "at", "own", "first", "carry", "part", "segment", "rank", "before", "copies", "gain", "crc", "output", "start", "col", "bucket")}
    return df.withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate([None, "", "beta x x", LONG[:3000], prose(50)])], "item_id long, text string, copies int")


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def drawn(k, n):
    h = hashlib.sha256(f"7:{'null' if k is None else k}".encode()).hexdigest()
    return [int(h[8 * i : 8 * i + 8], 16) for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Fill in the middle


def slow_fim(k, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(lines), drawn(k, 4)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return k, n, "plain", None, None, sha(text), sha(text)
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return k, n, form, len(p), len(m), sha(out), sha(text)


def test_fim_equals_brute_force(docs):
    got = fim.digests(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    rows = got.collect()
    assert sorted_rows(rows) == sorted_rows(slow_fim(k, t) for k, t in ROWS)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.digests(docs.filter("false")).count() == 0


@pytest.mark.parametrize(("unit", "pattern"), [("line", r"[^\n]*\n|[^\n]+"), ("word", r"[^\s]+[ \t\n\r\f\v]*|^[ \t\n\r\f\v]+"), ("char", r"(?s).")])
def test_borders_of_units(unit, pattern):
    texts = [t for _, t in ROWS if t and not re.search("[\x1c   ]", t)] + ["  lead", "tail  ", " "]
    for t in texts:
        pieces = re.findall(pattern, t)
        assert "".join(pieces) == t
        points = np.frombuffer(t.encode("utf-32-le"), "<u4")
        assert fim.borders(points, unit).tolist() == np.cumsum([0, *map(len, pieces)]).tolist()


def test_fim_rates_units_and_restoration(docs):
    assert {r.form for r in fim.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(docs, spm_rate=100).collect()} == {"plain", "spm"}
    for unit in fim.UNITS:
        out = fim.transform(docs, unit=unit, seed=11).select("doc_id", fim.restored().alias("t")).collect()
        assert sorted_rows(out) == sorted_rows((k, t or "") for k, t in ROWS)


# Importance resampling


def slow_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow_resample(rows, target, n=2, buckets=10_000, percent=25, least=20):
    def features(text):
        w = slow_words(text)
        return Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1))

    own = [features(t) for _, t in rows]
    s, t = sum(own, Counter()), sum(map(features, target), Counter())
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for (k, text), f in zip(rows, own, strict=True):
        weight = sum(c * gain[b] for b, c in f.items()) // f.total() if f else 0
        noise = math.floor(-1000 * math.log(-math.log((drawn(k, 1)[0] + 0.5) / 4294967296)))
        out.append([k, f.total(), weight, weight + noise, None, len(slow_words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[1], r[2]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize(("chunk", "n", "percent"), [(1 << 16, 2, 25), (64, 2, 25), (50, 3, 60), (1, 2, 100), (200, 1, 0)])
def test_resampling_equals_brute_force_with_any_chunks(docs, target, monkeypatch, chunk, n, percent):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    got = importance.resample(docs, target, n=n, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted_rows(got.collect()) == sorted_rows(slow_resample(ROWS, [r.text for r in target.collect()], n=n, percent=percent))


def test_resampling_of_ties_and_empty_tables(spark, docs, target):
    rows = [(k, "same words here " * 10) for k in (5, 3, 9, 3, 3)] + [(k, "few") for k in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(importance.resample(df, target, percent=60).collect()) == sorted_rows(slow_resample(rows, [r.text for r in target.collect()], percent=60))
    assert sorted_rows(importance.resample(df, target.filter("false")).collect()) == sorted_rows(slow_resample(rows, []))
    assert importance.resample(docs.filter("false"), target).count() == 0


@given(st.text(alphabet="ab \n.é日", max_size=60), st.integers(1, 20), st.integers(1, 4))
def test_chunks_own_every_feature_once(text, size, n):
    w = slow_words(text)
    want = Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % 997 for k in range(1, n + 1) for i in range(len(w) - k + 1))
    got, owned = Counter(), 0
    for own, carry in importance.chunks(text.encode(), size, n):
        assert len(importance.words(carry)) <= n - 1
        mine, at = importance.features(own, carry, n, 997)
        got.update(at.tolist())
        owned += mine
    assert (got, owned) == (want, len(w))


# Token files


def slow_tokens(rows):
    """doc_id, start, n_tokens, crc of each, with documents in the order of the files."""
    library = Tokenizer.from_file(public_tokenizers.path(token_file.TOKENIZER))
    out, start = [], 0
    for k, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def file_order(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = [(r.doc_id, r.text, r.h) for r in df.collect()]
    return [r[:2] for r in sorted(rows, key=lambda r: (-math.inf if r[0] is None else r[0], r[2]))]


@pytest.mark.parametrize(("segment", "window"), [(1 << 18, 1 << 20), (1, 1 << 20), (64, 16), (97, 1 << 20), (1000, 50)])
def test_files_hold_the_librarys_ids_in_order(spark, docs, tmp_path, monkeypatch, segment, window):
    monkeypatch.setattr(token_file, "WINDOW", window)
    want = slow_tokens(file_order(spark))
    path = str(tmp_path / "tokens")
    token_file.write(docs, path, segment=segment)
    got = token_file.documents(spark, path)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted_rows(got.collect()) == sorted_rows(want)
    if segment in (64, 97):
        ids = []
        library = Tokenizer.from_file(public_tokenizers.path(token_file.TOKENIZER))
        for _, t in file_order(spark):
            ids += [*library.encode(t or "", add_special_tokens=False).ids, 2]
        places = RNG.sample(range(len(ids)), 300) + [0, len(ids) - 1, 63, 64, 64]
        found = token_file.lookup(spark, path, spark.createDataFrame([(p,) for p in [*places, None]], "pos long"))
        assert sorted_rows(found.collect()) == sorted_rows((p, ids[p]) for p in set(places))
        with pytest.raises(Exception, match="places reach"):
            token_file.lookup(spark, path, spark.createDataFrame([(len(ids),)], "pos long")).collect()


def test_token_files_of_an_empty_table(spark, docs, tmp_path):
    assert token_file.written_and_read(docs.filter("false")).collect() == []
    token_file.write(docs.filter("false"), str(tmp_path / "none"))
    assert token_file.lookup(spark, str(tmp_path / "none"), spark.createDataFrame([], "pos long")).collect() == []


def test_stretches_equal_whole_texts(spark):
    """Cutting at white space changes no id, whatever stands beside it."""
    library = Tokenizer.from_file(public_tokenizers.path(token_file.TOKENIZER))
    own = token_file.Ids(public_tokenizers.path(token_file.TOKENIZER))
    rng = random.Random(3)
    letters = [*"abAB12 '\t\n\r\x0b\x0c.-", "́", "̈", "é", "İ", "Σ", "ς", "ᄀ", "ᅡ", "각", "<|endoftext|>", "'ll", " ", " ", "ﬁ", "\U0001f600", "ำ", "<|", "|>"]
    for _ in range(4000):
        t = "".join(rng.choices(letters, k=rng.randint(0, 25)))
        assert np.frombuffer(b"".join(own.encode(t)), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_merges_equal_the_library():
    """Every token of the list spells itself by the listed pairs, and stretches get the library's ids."""
    path = public_tokenizers.path(token_file.TOKENIZER)
    model = json.load(open(path, encoding="utf-8"))["model"]
    rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): k for k, m in enumerate(model["merges"])}

    def by_pairs(parts):
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best : best + 2] = ["".join(parts[best : best + 2])]
        return parts

    for t in model["vocab"]:
        if not t.startswith("<|"):
            body = t.removesuffix("</w>") or t
            assert by_pairs([*body[:-1], body[-1] + ("</w>" if t != body else "")]) == [t]
    own = token_file.Ids(path)
    assert own.merges
    rng = random.Random(8)
    syllables = ["the", "ing", "tion", "an", "é", "ü", "S", "qu", "x", "ß", "Ÿ", "ſ", "'s", "'LL", "!!", "12", "-", "_", "€", "ñ", "ŉ", "'", "\x01", "\x7f"]
    for _ in range(20000):
        t = "".join(rng.choices(syllables, k=rng.randint(1, 7)))
        assert np.frombuffer(own._ids(t.encode()), "<u4").tolist() == own.library.encode(t, add_special_tokens=False).ids, repr(t)


def test_plain_words_are_run_by_windows():
    """One call of the merges for a window of many texts, however many words; nothing is looked up word by word."""
    own = token_file.Ids(public_tokenizers.path(token_file.TOKENIZER))
    rng, calls, run = random.Random(4), [], own.merges.encode
    own.merges.encode = lambda text: calls.append(len(text)) or run(text)
    texts = [" ".join("".join(rng.choices("abcdefghijé,'S1", k=rng.randint(1, 9))) for _ in range(200)) for _ in range(50)]
    got = [ids.tolist() for _, ids, _ in own.encode_all(texts, 2)]
    assert got == [[*own.library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert len(calls) == 1 and not own.known


@pytest.mark.parametrize("by_merges", [True, False])
def test_texts_side_by_side_equal_texts_alone(monkeypatch, by_merges):
    """Neither neighbours nor borders of windows nor what is left to the library move an id or the end of a text."""
    own = token_file.Ids(public_tokenizers.path(token_file.TOKENIZER))
    own.merges = own.merges if by_merges else None
    rng = random.Random(6)
    letters = [*"aAsStTdDmMlLrReEvV''''\".,09 \t\n\r\x0b\x0c\x00\x01\x02\x1c\x7f<|>", *"ÿŸé×÷İıſßĀŉþ中’Σ", "\u0301", "\x85", "\xa0", "\u212a", "\U0001f600", "<|endoftext|>", "'ll", "'Re"]
    for k in range(1500):
        texts = ["".join(rng.choices(letters if k % 2 else letters[:26], k=rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        monkeypatch.setattr(token_file, "WINDOW", rng.choice([1, 3, 10, 50, 1 << 20]))
        got, done = [[] for _ in texts], []
        for which, ids, ends in own.encode_all(texts, 2):
            got[which] += ids.tolist()
            done += [which] * ends
        assert (got, done) == ([[*own.library.encode(t, add_special_tokens=False).ids, 2] for t in texts], [*range(len(texts))]), repr(texts)


def test_files_of_another_make_are_run_by_the_library(tmp_path):
    known = json.load(open(public_tokenizers.path(token_file.TOKENIZER), encoding="utf-8"))
    known["normalizer"]["normalizers"].pop()  # keeps case
    (tmp_path / "t.json").write_text(json.dumps(known), encoding="utf-8")
    own = token_file.Ids(str(tmp_path / "t.json"))
    assert own.merges is None
    t = "Two Words"
    assert np.frombuffer(b"".join(own.encode(t)), "<u4").tolist() == Tokenizer.from_file(str(tmp_path / "t.json")).encode(t, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 1 << 17), st.integers(0, (1 << 32) - 1)), max_size=300))
def test_codes_give_any_token(ids):
    codes = token_file.Codes(token_file.pack_codes(np.array(ids, "<u4")))
    assert codes.n == len(ids)
    assert codes.slice(0, len(ids)).tolist() == ids
    for i in range(0, len(ids), 7):
        assert codes.take(np.array([i])).tolist() == [ids[i]]
        assert codes.slice(i, min(i + 70, len(ids))).tolist() == ids[i : i + 70]
    with pytest.raises(IndexError):
        codes.take(np.array([len(ids)]))


@given(st.binary(max_size=80), st.binary(max_size=80))
def test_crc_joined(a, b):
    assert token_file.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# The registered queries


def test_queries_over_whole_tables(spark, tmp_path, docs, target):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    target.write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    assert sorted_rows(registry.op11_fim(spark, sf).collect()) == sorted_rows(slow_fim(k, t) for k, t in ROWS)
    assert sorted_rows(registry.op12_importance(spark, sf).collect()) == sorted_rows(slow_resample(ROWS, [r.text for r in target.collect()]))
    assert sorted_rows(registry.op13_token_file(spark, sf).collect()) == sorted_rows(slow_tokens(file_order(spark)))
