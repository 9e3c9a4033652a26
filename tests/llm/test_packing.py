import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from siltstone.llm import packing
from tests.llm.helpers import no_rows, odd_rows


def pieces_of(rows):
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault(r["row_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    return by_row, by_sequence


def check_sequences(by_sequence, tokens, segments, loss):
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens and len(rows) <= segments and sum(r["loss_tokens"] for r in rows) <= loss


def test_texts_come_back_and_nothing_is_padded(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["apple", "tree", "été", "x9"], rng.integers(0, 400))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    rows = packing.pack_texts(df, max_tokens=128, pool=32).collect()
    by_row, by_sequence = pieces_of(rows)
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = np.array([*exact.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(by_row[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == ids.tobytes()
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
        assert mine[0]["start"] == 0 and zlib.crc32(bytes(mine[0]["ids"])) >= 0
    check_sequences(by_sequence, 128, packing.MAX_SEGMENTS, 128)
    for rows in by_sequence.values():
        total = sum(r["length"] for r in rows)
        assert total & (total - 1) == 0


def test_limits_bind_together():
    rng = np.random.default_rng(1)
    packer = packing.Packer(100, 4, 40, 50, 7 << 40)
    sequences, given = [], {}
    for row in range(300):
        n = int(rng.integers(1, 260))
        bears = rng.random(n) < rng.choice([0.05, 0.9])
        given[row] = bears
        sequences += packer.rows(packer.add(row, np.arange(n, dtype=np.uint32), bears))
    sequences += packer.rows(packer.finish())
    by_row, by_sequence = {}, {}
    for row, start, length, ids, total, sequence, offset, loss in sequences:
        by_row.setdefault(row, []).append((start, length, ids))
        by_sequence.setdefault(sequence, []).append((offset, length, loss))
        assert loss == given[row][start : start + length].sum() and total == len(given[row])
    for row, bears in given.items():
        ids = b"".join(i for _, _, i in sorted(by_row[row]))
        assert ids == np.arange(len(bears), dtype="<u4").tobytes()
    for pieces in by_sequence.values():
        assert sum(p[1] for p in pieces) <= 100 and len(pieces) <= 4 and sum(p[2] for p in pieces) <= 40
    # mixing loss-heavy and loss-free pieces fills more than taking them as they come
    assert len(by_sequence) < 1.2 * max(sum(map(len, given.values())) / 100, sum(b.sum() for b in given.values()) / 40)


def test_examples_with_masks(spark):
    rows = [(1, [5, 6, 7], [True, None, True]), (2, None, None), (3, [1] * 30, [True]), (3, [1] * 30, [True])]
    df = spark.createDataFrame(rows, "k long, ids array<int>, bears array<boolean>")
    out = packing.pack_examples(df, "k", "ids", "bears", max_tokens=16, max_loss=2).collect()
    by_row, by_sequence = pieces_of(out)
    assert set(by_row) == {1, 3} and sum(r["length"] for r in by_row[3]) == 60
    assert sum(r["loss_tokens"] for r in by_row[1]) == 2
    check_sequences(by_sequence, 16, packing.MAX_SEGMENTS, 2)


def test_very_long_run_is_encoded(spark):
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
    text = " " * 60_000 + "x"
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_odd_rows_and_no_rows(spark):
    by_row, by_sequence = pieces_of(packing.pack_texts(odd_rows(spark)).collect())
    assert sum(r["length"] for r in by_row[1]) == 1 and len(by_row[4]) >= 2 and None in by_row
    check_sequences(by_sequence, 1024, packing.MAX_SEGMENTS, 1024)
    assert packing.pack_texts(no_rows(spark)).count() == 0


def test_ids_of_special_strings_are_the_tokenizer_s_own(spark):
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "été <|endoftext|>\n" * 40, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    by_row, by_sequence = pieces_of(packing.pack_texts(df, max_tokens=64).collect())
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert b"".join(bytes(r["ids"]) for r in sorted(by_row[i], key=lambda r: r["start"])) == ids.tobytes()
    assert np.frombuffer(by_row[0][0]["ids"], "<u4").tolist() == [50256, 0]
    check_sequences(by_sequence, 64, packing.MAX_SEGMENTS, 64)
