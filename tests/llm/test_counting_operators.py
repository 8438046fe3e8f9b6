"""Importance resampling, periodic runs and token counts against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_operators import docs_of, edges, prose, with_clashes

from forumlens.llm import periods, resampling, token_counts
from forumlens.llm.queries import QUERIES

# --- importance resampling -----------------------------------------------------------------------------------


def brute_features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute_resample(docs, target, longest=2, buckets=10_000, percent=25, min_words=20):
    def buckets_of(text):
        return [zlib.crc32(f.encode()) % buckets for f in brute_features(text, longest)[1]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    n_s, n_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        found = buckets_of(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, len(brute_features(text)[0]) >= min_words))
    pool = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(pool) // 100
    ranked = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(pool, 1)]
    return Counter(ranked + [(*r[:4], None) for r in rows if not r[4]])


def test_byte_table_is_the_word_rule():
    chars = [chr(b) for b in range(128)]
    want = [c.lower() if re.match("[A-Za-z0-9]", c) else " " for c in chars]
    assert [chr(resampling.TABLE[b]) for b in range(128)] == want
    assert all(resampling.TABLE[b] == b for b in range(128, 256))


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_chained_hashes_match_whole_features_whatever_the_pieces(monkeypatch, longest):
    rng = random.Random(longest)
    for size in (1, 2, 7, 40, 1 << 20):
        monkeypatch.setattr(resampling, "PIECE", size)
        for n in (0, 1, 2, 3, 4, 5, 6, 30, 200):
            text = "".join(rng.choices(["a", "Bc", "é漢", " ", "-", "\n\n", "x1 "], k=n))
            words, features = brute_features(text, longest)
            n_words, found = resampling.count_features(text.encode(), longest, 97)
            assert n_words == len(words)
            assert found == Counter(zlib.crc32(f.encode()) % 97 for f in features)


@pytest.mark.parametrize("buckets", [10_000, 50])
def test_resampling_matches_brute_force(spark, buckets):
    rng = random.Random(4)
    docs = edges() + [(100 + k, prose(rng, rng.randint(0, 60))) for k in range(150)] + [(200, prose(random.Random(5), 30))] * 3
    target = [prose(rng, 40) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(None, t) for t in target], "item_id long, text string")
    got = resampling.resample(with_clashes(docs_of(spark, docs)).withColumn("rank", F.lit("x")), frame, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(docs, target, buckets=buckets)


def test_resampling_without_rows(spark):
    docs, empty = docs_of(spark, edges()), spark.createDataFrame([], "text string")
    assert Counter(map(tuple, resampling.resample(docs, empty).collect())) == brute_resample(edges(), [])
    assert resampling.resample(docs_of(spark, []), docs).count() == 0
    assert resampling.resample(docs_of(spark, [(1, None), (2, "few words")]), docs).where("rank IS NOT NULL").count() == 0


def test_resampling_draws_what_is_like_the_target(spark):
    rng = random.Random(8)
    like, other = [f"l{k}" for k in range(60)], [f"o{k}" for k in range(60)]
    docs = [(k, " ".join(rng.choices(like if k % 4 == 0 else other, k=60))) for k in range(400)]
    target = spark.createDataFrame([(" ".join(rng.choices(like, k=200)),) for _ in range(20)], "text string")
    drawn = [r.doc_id for r in resampling.resample(docs_of(spark, docs), target).where("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and sum(d % 4 == 0 for d in drawn) >= 80


def test_resampling_query_on_the_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert Counter(map(tuple, QUERIES["op11_resampling"](spark, sf_dir).collect())) == brute_resample(docs, target)


# --- periodic runs -------------------------------------------------------------------------------------------


def brute_runs(words):
    """All stretches of each period, from the least, so that a stretch is named by its smallest period."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_collapse(words, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(rng):
    kind = rng.randint(0, 5)
    if kind == 0:
        return rng.choices("ab", k=rng.randint(0, 200))
    if kind == 1:
        out = rng.choices("abc", k=rng.randint(1, 40)) * rng.randint(1, 8)
        for _ in range(rng.randint(0, 3)):
            out[rng.randrange(len(out))] = "a"
        return out
    if kind == 2:
        a, b = "a", "ab"
        while len(b) < 300:
            a, b = b, b + a
        return list(b[rng.randint(0, 50) : rng.randint(60, 400)]) * rng.randint(1, 3)
    if kind == 3:
        out = []
        while len(out) < 300:
            unit = rng.choices("ab", k=rng.randint(1, 12)) * rng.randint(1, 9)
            out += unit if rng.random() < 0.6 or not out else out[-rng.randint(1, 100) :]
        return out * rng.choice([1, 1, 3])
    if kind == 4:
        unit = ["a"] * rng.randint(1, 30) + ["b"]
        return ["c"] * rng.randint(0, 9) + unit * rng.randint(1, 9) + ["a"] * rng.randint(0, 40) + unit * 3
    word = "a"
    for _ in range(rng.randint(3, 7)):
        word = word.translate({97: "ab", 98: "ba"})
    return list(word) * rng.randint(1, 5)


def test_runs_match_brute_force():
    rng = random.Random(21)
    for _ in range(600):
        words = repetitive(rng)
        codes = np.array([ord(w) for w in words], dtype=np.int64)
        assert [tuple(r) for r in periods.runs_of(codes).tolist()] == brute_runs(words)


def test_wavelet_matrix_matches_sorting():
    rng = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 500):
        values = rng.integers(0, 40, n)
        tree = periods.WaveletMatrix(values, 7)
        lo = rng.integers(0, n, 300)
        hi = lo + rng.integers(0, n - lo + 1)
        at = rng.integers(0, 64, 300)
        assert tree.count_less(lo, hi, at).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, at)]
        full = hi > lo
        k = rng.integers(0, (hi - lo)[full])
        want = [int(np.sort(values[a:b])[x]) for a, b, x in zip(lo[full], hi[full], k)]
        assert tree.smallest(lo[full], hi[full], k).tolist() == want


def test_runs_of_texts_match_brute_force(spark):
    rng = random.Random(3)
    rows = edges() + [(100 + k, rng.choice([" ", "\n", "\x0b ", "\t\t"]).join(repetitive(rng))) for k in range(120)]
    rows += [(500, "same same " * 20)] * 3 + [(501, " a b" * 30), (502, ("w " * 30).strip() + "\x1cw")]
    got = periods.periodic_runs(with_clashes(docs_of(spark, rows))).collect()
    want = Counter()
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        # Long texts of the edge cases are prose, one word over and over, or one word.
        runs = brute_runs(words) if len(words) < 3000 else [(0, len(words), 1)] if len(set(words)) == 1 else []
        want[(doc, tuple(runs), brute_collapse(words, runs))] += 1
    assert Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want
    assert periods.periodic_runs(docs_of(spark, [])).count() == 0


def brute_periods(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n and doc is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc, len(runs), *best, milli, *[hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_collapse(words, runs))])


def test_period_digests_match_brute_force(spark):
    rng = random.Random(12)
    rows = [(k, prose(rng, rng.randint(0, 120)) if k % 3 else " ".join(repetitive(rng))) for k in range(300)]
    rows += [(k, None) for k in range(300, 330)] + [(k, " \n") for k in range(330, 360)] + [(None, "a b " * 20), (None, None)]
    got = periods.digests(periods.periodic_runs(periods.plant_periods(with_clashes(docs_of(spark, rows)))))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == names
    assert Counter(map(tuple, got.collect())) == Counter(brute_periods(*r) for r in rows)


def test_periods_query_on_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len((r.text or "").split()) < 2000}
    got = [tuple(r) for r in QUERIES["op12_periods"](spark, sf_dir).collect()]
    assert len(got) == len(docs)
    assert sum(r[1] > 0 for r in got) > len(docs) // 20
    assert {r for r in got if r[0] in short} == {brute_periods(d, t) for d, t in short.items()}


# --- token counts --------------------------------------------------------------------------------------------


def test_token_counts_match_the_library():
    counter = token_counts.PieceCounter(token_counts.model_path())
    assert len(counter.whole) > 10_000
    rng = random.Random(6)
    parts = list("ab  \t\n▁é漢e theTHE<s>01") + ["the ", "<s>", " hello", "\0", "　", "▁▁", "    ", "ing", "</s>", "<0x41>", "ﬁ①", "́"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "  ", " " * 1000, "x" * 5000, "▁", "<unk>", "a ", " a", None]
    want = [len(ids) for ids in counter.model.encode([t or "" for t in texts], num_threads=1)]
    assert counter.counts(pa.array(texts)).tolist() == want
    assert counter.counts(pa.array(texts)[37:]).tolist() == want[37:]
    assert counter.counts(pa.array([], pa.string())).tolist() == []


def test_whole_words_are_one_token():
    counter = token_counts.PieceCounter(token_counts.model_path())
    for word in counter.whole.to_pylist()[::50]:
        assert len(counter.model.encode(word)) == 1


def test_token_counts_of_documents(spark, sf_dir):
    model = token_counts.PieceCounter(token_counts.model_path()).model
    rows = edges() + [(400, "word " * 5000)]

    def want(doc, text):
        n = len(model.encode(text or ""))
        return doc, len((text or "").encode()), n, n > 4096

    got = token_counts.count_tokens(with_clashes(docs_of(spark, rows)).withColumn("n_tokens", F.lit("x")))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == Counter(want(*r) for r in rows)
    assert token_counts.count_tokens(docs_of(spark, [])).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in QUERIES["op13_tokens"](spark, sf_dir).collect()} == {want(r.doc_id, r.text) for r in docs}
