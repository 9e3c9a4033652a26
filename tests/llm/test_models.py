import numpy as np
import pytest

from siltstone.llm import language_ecoc, quality_cnn
from tests.llm.helpers import no_rows, odd_rows

SYLLABLES = {"aa": "ka ri to mu se".split(), "bb": "sch pfe ung ter ie".split(), "cc": "éau eux oi què lle".split()}


def prose(rng, lang, n):
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def test_languages_held_out(spark):
    rng = np.random.default_rng(0)
    rows = [(i, prose(rng, lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language_ecoc.fit(df.where("doc_id % 4 <> 2"), rows=90)
    assert codes.languages == ["aa", "bb", "cc"] and codes.words.shape == (3, 3)
    got = {r["doc_id"]: r for r in language_ecoc.predict(df, codes, ["doc_id"]).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows if i % 4 == 2]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = language_ecoc.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2
        np.fill_diagonal(apart, code.shape[1])
        assert apart.min() >= max(1, code.shape[1] // 5)


def test_unsure_bits_count_little_and_ties_are_ambiguous():
    code = language_ecoc.codewords(4)
    codes = language_ecoc.Codes(list("wxyz"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]))
    noisy = code[2] * 3
    noisy[0] = -noisy[0] * 0.1
    best, score, ambiguous = language_ecoc.decode(codes, np.stack([noisy, np.zeros(code.shape[1])]))
    assert best[0] == 2 and not ambiguous[0] and ambiguous[1] and score[1] == pytest.approx(0.25)


def test_language_odd_rows_and_no_rows(spark):
    codes = language_ecoc.fit(odd_rows(spark))
    rows = language_ecoc.predict(odd_rows(spark), codes, ["doc_id"]).collect()
    assert len(rows) == 9 and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    nothing = language_ecoc.fit(no_rows(spark))
    assert {r["lang_pred"] for r in language_ecoc.predict(odd_rows(spark), nothing, ["doc_id"]).collect()} == {"und"}
    assert language_ecoc.predict(no_rows(spark), codes, ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        text = prose(rng, "aa", int(rng.integers(20, 300)))
        rows.append((i, text.replace(" ", "$$ ") if i % 4 == 0 else text, int(i % 4 != 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    network = quality_cnn.fit(df, df.select("doc_id", "quality").where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r["score"] for r in quality_cnn.score(df, network, ["doc_id"]).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(q) for i, _, q in rows if i % 3 == 1]) > 0.95


def test_gradients_are_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    texts, labels = [b"hello world " * 60, b"", b"#$%" * 300], np.array([1.0, 0.0, 1.0])
    network = quality_cnn.train(texts, labels, epochs=1)
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def loss():
        p = quality_cnn.probability(w, quality_cnn.pooled(w, raw, offsets))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    grads = quality_cnn.gradients(w, texts, labels, np.ones(3))
    for k in ("filters", "inner", "outer", "bias", "embed"):
        flat = int(np.abs(grads[k]).argmax())
        at = np.unravel_index(flat, w[k].shape)
        before = w[k][at]
        w[k][at] = before + 1e-5
        up = loss()
        w[k][at] = before - 1e-5
        down = loss()
        w[k][at] = before
        assert grads[k][at] == pytest.approx((up - down) / 2e-5, rel=0.05, abs=1e-6)


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        _, start = quality_cnn.chunk_index(np.array([n]))
        assert start[0] == 0 and start[-1] + quality_cnn.CHUNK >= n
        assert (np.diff(start) == quality_cnn.CHUNK - quality_cnn.OVERLAP).all()


def test_quality_odd_rows_and_no_rows(spark):
    df = odd_rows(spark)
    network = quality_cnn.fit(df, df.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    rows = quality_cnn.score(df, network, ["doc_id"]).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality_cnn.score(no_rows(spark), network, ["doc_id"]).count() == 0
    assert quality_cnn.fit(no_rows(spark), no_rows(spark).selectExpr("doc_id", "1 as quality")).constant == 0.5


def plain_language(codes, text):
    """One text, one n-gram and one bit at a time."""
    folded = [b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    counts = {}
    for size in (1, 2, 3):
        for at in range(len(folded) - size + 1):
            value = 0
            # a shorter gram's value is built up by the longer ones
            for k in range(size):
                value = (value * 0x01000193 + folded[at + k] + k + 1) % 2**32
            slot = (value * 0x9E3779B1) % 2**32 >> 20
            counts[slot] = counts.get(slot, 0) + 1
    norm = max(sum(counts.values()) ** 0.5, 1e-9)
    costs = []
    for word in codes.words:
        cost = 0.0
        for bit, sign in enumerate(word):
            z = codes.bias[bit] + sum(n**0.5 / norm * float(codes.weights[s, bit]) for s, n in counts.items())
            cost += np.log1p(np.exp(-z * sign)) if z * sign > -30 else -z * sign
        costs.append(cost)
    near = [np.exp(-(c - min(costs)) / max(1.0, codes.words.shape[1] / 2)) for c in costs]
    return codes.languages[int(np.argmin(costs))], max(near) / sum(near)


def test_languages_against_one_text_at_a_time(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, lang, int(rng.integers(1, 60))), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(900, "Ü", None), (901, "ka " * 5000, "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language_ecoc.fit(df)
    for r in language_ecoc.predict(df.join(df.select("doc_id"), "doc_id"), codes, ["doc_id", "text"]).collect():
        lang, p = plain_language(codes, r["text"])
        assert r["score"] == pytest.approx(p, abs=1e-4)
        assert r["lang_pred"] == lang or abs(p - 0.5) < 1e-3


def test_a_language_of_one_hot_text_or_of_long_texts_is_learned(spark):
    rng = np.random.default_rng(5)
    hot = [("aa", prose(rng, "aa", 30))] * 3000
    many = [("bb", prose(rng, "bb", 30)) for _ in range(400)]
    long = [("cc", "1 " * 40_000 + prose(rng, "cc", 20_000)) for _ in range(3)]
    rows = [(i, t, lang) for i, (lang, t) in enumerate([*hot, *many, *long])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for seed in range(3):
        codes = language_ecoc.fit(df, rows=30, seed=seed)
        assert codes.languages == ["aa", "bb", "cc"]
    new = spark.createDataFrame([(k, prose(rng, lang, 40)) for k, lang in enumerate(["aa", "bb", "cc"])], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_ecoc.predict(new, codes, ["doc_id"]).collect()}
    assert got == {0: "aa", 1: "bb", 2: "cc"}


def plain_score(w, raw):
    """One chunk, one window and one filter at a time."""
    step = quality_cnn.CHUNK - quality_cnn.OVERLAP
    starts = [0]
    while starts[-1] + quality_cnn.CHUNK < len(raw):
        starts.append(starts[-1] + step)
    tops = []
    for start in starts:
        chunk = [*raw[start : start + quality_cnn.CHUNK]]
        chunk += [quality_cnn.PAD] * (quality_cnn.CHUNK - len(chunk))
        windows = range(0, quality_cnn.CHUNK - quality_cnn.KERNEL + 1, quality_cnn.STRIDE)
        tops.append(
            [
                max(0.0, w["bias"][f] + max(sum(w["embed"][chunk[at + k]] @ w["filters"][k * quality_cnn.DEPTH : (k + 1) * quality_cnn.DEPTH, f] for k in range(quality_cnn.KERNEL)) for at in windows))
                for f in range(3)
            ]
        )
    return np.array(tops).mean(axis=0), np.array(tops).max(axis=0)


def test_scores_against_one_window_at_a_time(spark):
    rng = np.random.default_rng(6)
    texts = ["", "x", prose(rng, "aa", 30), prose(rng, "cc", 90), "é" * 700]
    network = quality_cnn.train([t.encode() for t in texts], np.array([0, 1, 0, 1, 1], np.float32), epochs=2)
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["score"] for r in quality_cnn.score(df, network, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        raw = text.encode()
        pool = quality_cnn.pooled(network.weights, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        mean, most = plain_score(w, raw)
        assert pool[:3] == pytest.approx(mean, abs=1e-4) and pool[32:35] == pytest.approx(most, abs=1e-4)
        hidden = [np.tanh(sum(pool[k] * w["inner"][k, h] for k in range(64)) + w["inner_bias"][h]) for h in range(16)]
        z = sum(hidden[h] * w["outer"][h, 0] for h in range(16)) + w["outer_bias"][0]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_labels_without_document_and_hot_or_long_documents(spark):
    rng = np.random.default_rng(7)
    docs = [(i, prose(rng, "aa", 40), 1) for i in range(20)] + [(100 + i, "$" * 70_000, 0) for i in range(20)]
    hot = [(500, "hot text", 1)] * 2000
    df = spark.createDataFrame(docs + hot, "doc_id long, text string, quality int").repartition(3)
    gone = spark.createDataFrame([(10_000 + i, i % 2) for i in range(5000)], "doc_id long, quality int")
    labels = df.select("doc_id", "quality").unionByName(gone)
    network = quality_cnn.fit(df, labels, rows=41)
    assert network.constant is None
    got = {r["doc_id"]: r["score"] for r in quality_cnn.score(df, network, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == bool(q) for i, _, q in docs)
