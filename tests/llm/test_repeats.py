import hashlib
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import repeats, suffix_radix, superkmer
from tests.llm.helpers import ODD, no_rows, odd_rows


def brute(texts, unit, length):
    units = [(t or "").encode().split() if unit == "word" else (t or "").encode() for t in texts]
    seen = Counter(tuple(u[i : i + length]) for u in units for i in range(len(u) - length + 1))
    out = []
    for u in units:
        gone = np.zeros(len(u), bool)
        for i in range(len(u) - length + 1):
            if seen[tuple(u[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = [x for x, g in zip(u, gone, strict=True) if not g]
        data = b" ".join(kept) if unit == "word" else bytes(kept)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(u), int(gone.sum()), runs, hashlib.sha256(data).hexdigest()))
    return out


def sample_texts(seed=3):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 6))) for _ in range(60)]
    base = [" ".join(rng.choice(words, 200)) for _ in range(6)]
    passage = " ".join(rng.choice(words, 50))
    texts = list(base)
    texts += [base[0], base[0]]
    texts.append(base[1][:300] + " changed " + base[1][310:])
    texts += [f"{' '.join(rng.choice(words, 40))} {passage} {' '.join(rng.choice(words, 40))}" for _ in range(4)]
    texts.append(f"{passage} {passage}")
    texts += [None, "", "a", "ab " * 150, "ab " * 150 + "x"]
    return texts


@pytest.mark.parametrize("bucket", [4096, 2])
def test_both_operators_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET", bucket)  # 2: buckets are dealt again, several times
    texts = sample_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for unit, length, gram, run in (
        ("word", 10, 4, superkmer.remove_repeated_windows),
        ("byte", 60, 12, suffix_radix.remove_repeated_bytes),
    ):
        got = {r["doc_id"]: (r["n_units"], r["n_removed"], r["n_spans"], r["sha"]) for r in run(df, length=length, gram=gram).collect()}
        assert got == dict(enumerate(brute(texts, unit, length)))


def test_odd_rows_and_no_rows(spark):
    texts = [r[1] for r in ODD]
    for unit, length, run in (("word", 35, superkmer.remove_repeated_windows), ("byte", 200, suffix_radix.remove_repeated_bytes)):
        got = sorted((r["n_units"], r["n_removed"], r["n_spans"], r["sha"]) for r in run(odd_rows(spark)).collect())
        assert got == sorted(brute(texts, unit, length))
        assert run(no_rows(spark)).count() == 0


def run_texts():
    words = " ".join(f"w{i}" for i in range(40))
    return ["a" * 7000, f"x{words}{'a' * 300}", "abc " * 900 + words, f"{'ab ' * 400}y {words} {'ab ' * 400}", "z" * 61, "q" * 60, "0" * 159 + "1"]


@pytest.mark.parametrize("bucket", [4096, 2])
def test_runs_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    texts = run_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for unit, length, gram, run in (
        ("word", 10, 4, superkmer.remove_repeated_windows),
        ("byte", 60, 12, suffix_radix.remove_repeated_bytes),
    ):
        got = {r["doc_id"]: (r["n_units"], r["n_removed"], r["n_spans"], r["sha"]) for r in run(df, length=length, gram=gram).collect()}
        assert got == dict(enumerate(brute(texts, unit, length)))


def test_a_run_is_few_segments_and_travels_in_steps():
    size = 3_000_000
    w = repeats.Windows("byte", 200, 40)
    text, first, count, _, anchor = repeats.segments_of(np.full(size, 32, np.uint8), np.array([0, size]), w)
    assert len(text) <= 12 and count.sum() == size - 199
    out = repeats.Strings(w, True)
    parts = [p for f, c, a in zip(first.tolist(), count.tolist(), anchor.view(np.int64).tolist(), strict=True) for p in out.cut(b" " * size, a, b"t", f, c, 0)]
    parts.append(out.batch())
    assert max(p.nbytes for p in parts) < 400_000
    assert sum(len(b.as_py()) - 199 for p in parts for b in p.column(5)) == size - 199


def test_a_passage_in_many_near_copies(spark, monkeypatch):
    """One passage between different words: its inner strings are one row each, the buckets of
    its edges are larger than a task takes and are dealt again."""
    monkeypatch.setattr(repeats, "BUCKET", 50)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words, 30))
    texts = [f"{' '.join(rng.choice(words, 20))} {passage} {' '.join(rng.choice(words, 20))}" for _ in range(1500)]
    texts += [f"{passage[:80]} {' '.join(rng.choice(words, 20))}" for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for unit, length, gram, run in (
        ("word", 10, 4, superkmer.remove_repeated_windows),
        ("byte", 60, 12, suffix_radix.remove_repeated_bytes),
    ):
        got = {r["doc_id"]: (r["n_units"], r["n_removed"], r["n_spans"], r["sha"]) for r in run(df, length=length, gram=gram).collect()}
        assert got == dict(enumerate(brute(texts, unit, length)))


def test_grams_grow_to_the_whole_window():
    w, grams = repeats.Windows("byte", 200, 40), []
    while w.gram < w.length:
        w = w.next
        grams.append(w.gram)
    assert grams == [120, 160, 180, 190, 195, 198, 199, 200]


def test_anchor_depends_on_the_window_alone():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 2**63, 500).astype(np.uint64)
    at = repeats.sliding_anchor(hashes, 37)
    assert at.tolist() == [i + int(hashes[i : i + 37].argmin()) for i in range(len(hashes) - 36)]


def test_long_texts_are_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 50)
    rng = np.random.default_rng(1)
    values = rng.integers(0, 4, 400).astype(np.uint8)
    w = repeats.Windows("byte", 20, 5)
    text, first, count, at, _ = repeats.segments_of(values, np.array([0, 150, 150, 400]), w)
    windows = sorted((t, f + i) for t, f, c in zip(text, first, count, strict=True) for i in range(c))
    assert windows == [(0, i) for i in range(131)] + [(2, i) for i in range(231)]
    assert ((first <= at) & (at + 5 <= first + count - 1 + 20)).all()


def test_radix_and_sort_find_equal_windows():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 3, 3000).astype(np.uint8)
    starts = rng.permutation(2900)[:800]
    group = rng.integers(0, 3, 800)
    for length in (1, 7, 8, 12, 45, 90):
        key = [(g, values[s : s + length].tobytes()) for s, g in zip(starts, group, strict=True)]
        seen = Counter(key)
        want = [seen[k] > 1 for k in key]
        assert suffix_radix.radix_groups(values, starts, group, length).tolist() == want
        assert superkmer.sorted_windows(values.astype(np.uint64), starts, group, length).tolist() == want
