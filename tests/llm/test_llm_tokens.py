"""Token ids, the compressed blocks and the packing, against the tokenizers library."""

import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import FOLDER, ODD
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from tidemark.llm import packing, rans
from tidemark.llm.queries import registered
from tidemark.llm.tokens import TextEncoder, default_vocabulary, encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@drawn(st.lists(st.text(alphabet=st.sampled_from("aB.,'s tİΣ\n\x0b é́ﬁ<|endoftext|>12!")), max_size=6))
def test_encoder_equals_the_library(texts):
    own = encoder(default_vocabulary())
    flat, ends = own.encode(pa.array(texts, pa.large_string()))
    found = [flat[s:e].tolist() for s, e in zip(ends, ends[1:])]
    assert found == [e.ids for e in own._tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded(own, texts):
    flat, ends = own.encode(pa.array(texts, pa.large_string()))
    return [flat[s:e].tolist() for s, e in zip(ends, ends[1:])]


def test_encoder_equals_the_library_for_every_sign_and_letter(tokenizer):
    chars = [chr(c) for c in range(33, 0x260)]
    texts = [t for c in chars for t in (c, f"a{c}b", f"Z{c}", f"{c}9", f"{c}s", f"12{c}{c}x")]
    texts += [f"x{a}{b}s" for a in chars[:94] for b in chars[:94]]
    assert encoded(encoder(default_vocabulary()), texts) == [ids_of(tokenizer, t) for t in texts]


def test_words_with_digits_and_signs_are_sent_in_pieces_and_once(monkeypatch):
    own, sent = TextEncoder(default_vocabulary()), []
    library = TextEncoder._encoded

    def noted(tokenizer, texts):
        sent.extend(texts)
        return library(tokenizer, texts)

    monkeypatch.setattr(TextEncoder, "_encoded", staticmethod(noted))
    own.encode(pa.array(["Word### (word) word-2024 WORD, 20.24 mail9@word.example"], pa.large_string()))
    assert sorted(sent[0].split()) == sorted(["word", "mail", "example", *"0249", "###", *"(),-.@"])
    assert len(sent) == 1
    own.encode(pa.array(["(word) 4### it's"], pa.large_string()))
    assert sent[1:] == ["it's"]


@pytest.mark.parametrize("part", ["normalizer", "pre_tokenizer"])
def test_files_with_other_rules_get_whole_words(part, tmp_path):
    with open(default_vocabulary(), encoding="utf-8") as file:
        rules = json.load(file)
    rules[part] = {
        "normalizer": {"type": "NFC"},
        "pre_tokenizer": {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    }[part]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(rules), encoding="utf-8")
    texts = ["Some Words, of 1234 (and) more...", "Café-bar ABC", "", "it's"]
    assert encoded(TextEncoder(str(path)), texts) == [ids_of(Tokenizer.from_file(str(path)), t) for t in texts]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000, rans.BLOCK])
def test_blocks_are_decoded_exactly_and_in_parts(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, size=(3, n)), 700)
    tokens, counts = np.unique(ids, return_counts=True)
    freq = rans.Model.frequencies(counts.astype(float))
    assert freq.sum() == 1 << rans.SCALE_BITS and freq.min() > 0
    model = rans.Model(tokens, freq)
    coded = rans.encode(ids, model)
    assert (rans.decode(model, n, [c[0] for c in coded], [c[2] for c in coded]) == ids).all()
    parts = [rans.sections(*c) for c in coded]
    assert len(parts[0]) == -(-n // (rans.CHECKPOINT * rans.LANES))
    assert (rans.decode_sections(model, n, parts) == ids).all()
    for start, end in ((0, 1), (n // 2, n), (n - 1, n), (n // 3, n // 3 + 1)):
        assert (rans.decode_range(model, n, *coded[1], start, end) == ids[1, start:end]).all()


def test_checksums_of_parts():
    parts = [b"abc", b"", b"\0" * 9, b"xyz"]
    assert rans.checksum_of_parts([zlib.crc32(p) for p in parts], [len(p) for p in parts]) == zlib.crc32(b"".join(parts))


def expected_tokens(tokenizer, rows, end_id):
    start, found = 0, []
    for doc_id, text in rows:
        ids = [*ids_of(tokenizer, text), end_id]
        found.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return found


def test_token_blocks_of_given_documents(spark, tokenizer, given):
    found = registered()["op2_rans_tokens"](spark, FOLDER).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected_tokens(tokenizer, [g[:2] for g in given], 2)


def test_token_blocks_of_odd_documents(documents, nothing, tokenizer, monkeypatch):
    monkeypatch.setattr(rans, "PART", 20_000)  # several parts, documents over several blocks
    found = rans.write_and_read(documents, keep_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()
    ids = Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found)
    assert ids == Counter((i, (*ids_of(tokenizer, t), 2)) for i, t in ODD)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in found)
    assert rans.write_and_read(nothing).count() == 0


def test_damaged_blocks_are_noticed(spark, documents, tmp_path):
    rans.write(documents.where("doc_id = 3"), f"{tmp_path}/a")
    blocks = spark.read.parquet(f"{tmp_path}/a/blocks")
    spark.read.parquet(f"{tmp_path}/a/model").write.parquet(f"{tmp_path}/b/model")
    blocks.withColumn("crc32", blocks["crc32"] + 1).write.parquet(f"{tmp_path}/b/blocks")
    with pytest.raises(Exception, match="damaged"):
        rans.read_documents(spark, f"{tmp_path}/b").collect()


def test_damaged_checkpoints_are_noticed(spark, documents, tmp_path):
    rans.write(documents.where("doc_id = 5"), f"{tmp_path}/a")
    blocks = spark.read.parquet(f"{tmp_path}/a/blocks")
    assert blocks.where("length(checkpoints) > 0").count()
    spark.read.parquet(f"{tmp_path}/a/model").write.parquet(f"{tmp_path}/b/model")
    # The first state of a block's first checkpoint, one bit changed.
    other = "overlay(checkpoints PLACING x'%02x' FROM 9 FOR 1)"
    changed = "CASE WHEN substring(checkpoints, 9, 1) = x'00' THEN %s ELSE %s END" % (other % 1, other % 0)
    blocks.withColumn("checkpoints", F.expr(changed)).write.parquet(f"{tmp_path}/b/blocks")
    with pytest.raises(Exception, match="damaged"):
        rans.read_documents(spark, f"{tmp_path}/b").collect()


def check_packing(rows, expected, capacity):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def expected_pieces(tokenizer, rows, end_id, capacity):
    found = Counter()
    for doc_id, text in rows:
        ids = [*ids_of(tokenizer, text), end_id]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            found[doc_id, piece, start, len(part), crc(part)] += 1
    return found


def test_packing_of_given_documents(spark, tokenizer, given):
    rows = registered()["op4_best_fit_packing"](spark, FOLDER).collect()
    expected = expected_pieces(tokenizer, [g[:2] for g in given], 1, 4096)
    total = sum(k[3] * n for k, n in expected.items())
    assert check_packing(rows, expected, 4096) <= -(-total // 4096) + 2


def test_packing_of_odd_documents(documents, nothing, tokenizer):
    packed = packing.pack(documents, capacity=512)
    rows = packed.placements.collect()
    expected = expected_pieces(tokenizer, ODD, 1, 512)
    assert check_packing(rows, expected, 512) == packed.sequences
    sequences = {r["sequence_id"]: r for r in packed.tokens().collect()}
    for r in rows:
        own = sequences[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        assert crc(own) == r["ids_crc32"]
    empty = packing.pack(nothing)
    assert empty.placements.count() == 0 and empty.sequences == 0


@settings(max_examples=60, deadline=None)
@drawn(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_plans_place_every_piece_once(lengths):
    plan = packing.plan(lengths, 64)
    filled = Counter()
    taken = set()
    for length, count in lengths.items():
        sequence, offset = plan.place(np.full(count, length), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            places = {(s, o + i) for i in range(length)}
            assert not places & taken and o + length <= 64
            taken |= places
            filled[s] += length
    assert len(filled) == plan.sequences
    # No two sequences that would fit into one.
    assert plan.sequences <= 2 * sum(n * c for n, c in lengths.items()) / 64 + 1


def test_least_squares_are_not_negative():
    a, b = np.array([[1.0, 2, 0], [1, 0, 3]]), np.array([4.0, 1])
    x = packing.non_negative_least_squares(a, b)
    assert (x >= 0).all() and np.allclose(a @ x, b)
    assert np.allclose(packing.non_negative_least_squares(np.array([[1.0, -1]]), np.array([-2.0])), [0, 2])
