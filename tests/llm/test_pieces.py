import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from clickloom.llm.common import texts
from clickloom.llm.pieces import MARK, MODEL, Memo, Model, build, built, check, decode, encode, encode_and_check, encode_distinct, encode_words, model_bytes, parts_of, spells
from clickloom.llm.queries import op6_sentencepiece

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "  a  b \n c ", "\x00a", f"{MARK}a", f"x{MARK} b{MARK}{MARK}c", "<s> a </s> <unk>", "<0x41>", "日本語 テスト 🙂", "\n\n x", " " * 130 + "x", "word " * 3000, "a", "a"]


def field(number, kind, value):
    head = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 0x7F | 0x80, number >> 4])
    if kind == 2:
        size, out = len(value), b""
        while size > 0x7F:
            out, size = out + bytes([size & 0x7F | 0x80]), size >> 7
        return head + out + bytes([size]) + value
    return head + (bytes([value]) if kind == 0 else struct.pack("<f", value))


def unigram_model(squeeze):
    """A small unigram model, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), *((f"<0x{i:02X}>", 0.0, 6) for i in range(256))]
    words = {MARK: -3, f"{MARK}a": -2.5, "a": -4, "b": -4.2, "ab": -4.9, f"{MARK}ab": -3.1, "ba": -5, "c": -6, "abc": -5.5, MARK + MARK: -4}
    pieces += [(w, float(s), 1) for w, s in words.items()]
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, s) + field(3, 0, k)) for p, s, k in pieces)
    trainer = field(3, 0, 1) + field(35, 0, 1) + field(40, 0, 0)
    normal = field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, int(squeeze)) + field(5, 0, 1)
    return body + field(2, 2, trainer) + field(3, 2, normal)


@pytest.fixture(scope="module")
def other():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_query_matches_the_reference_library(spark, other):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op6_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.token_ids == other.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids)
        assert r.parity and r.round_trip


def test_odd_rows_encode_and_decode(spark, other):
    docs = spark.createDataFrame([(t, i, "old", "x") for i, t in enumerate(TEXTS)], "text string, doc_id long, token_ids string, decoded string")
    rows = decode(encode(docs, checks=("parity", "round_trip"))).collect()
    for r in rows:
        expected = other.encode(r.text or "")
        assert (r.token_ids, r.decoded) == (expected, other.decode(expected))
        assert r.decoded == (r.text or "").replace(MARK, " ")
        assert r.parity and r.round_trip
    assert sorted(r.doc_id for r in rows) == list(range(len(TEXTS)))
    assert decode(encode(docs.limit(0))).collect() == []
    no_ids = docs.select("doc_id", F.lit(None).cast("array<int>").alias("token_ids"))
    assert {r.decoded for r in decode(no_ids).collect()} == {""}


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_model(squeeze):
    content = unigram_model(squeeze)
    mine, other = build(Model.parse(content)), sentencepiece.SentencePieceProcessor(model_proto=content)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("aabbc zé ", k=rng.randint(0, 14)))
        ids = mine.encode(text, add_special_tokens=False).ids
        assert ids == other.encode(text)
        assert mine.decode(ids, skip_special_tokens=False) == other.decode(ids)


def test_large_model_is_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "model").write_bytes(b"x" * 100)
    monkeypatch.setattr("clickloom.llm.pieces.MODEL_BYTES", 99)
    with pytest.raises(ValueError, match="100 bytes"):
        model_bytes(spark, str(tmp_path / "model"))


def test_whole_texts_are_decoded_and_compared(other):
    """Words that are right one by one but in another order fail both checks."""
    own = built(open(MODEL, "rb").read(), 1)
    rows = ["first one then another", "", "a", f"x{MARK} y"]
    ids, sizes = encode_words(own, *texts(pa.array(rows, pa.large_string())))
    assert check(own, other, rows, ids, sizes).all()
    turned = np.concatenate([x[::-1] for x in np.split(ids, np.cumsum(sizes)[:-1])])
    assert check(own, other, rows, turned, sizes).tolist() == [[False, False], [True, True], [len(other.encode("a")) == 1] * 2, [False, False]]
    fewer = sizes - np.array([1, 0, 0, 0])
    assert not check(own, other, rows[:1], ids[: fewer[0]], fewer[:1]).any()


def test_words_are_told_apart_by_their_bytes(other):
    """A Thue-Morse word and its mirror, which polynomial hashes modulo 2**64 take for one."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    rows = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    own = built(open(MODEL, "rb").read(), 1)
    ids, sizes = encode_words(own, *texts(pa.array(rows, pa.large_string())))
    assert ids[: sizes[0]].tolist() == other.encode(rows[0]) != other.encode(rows[1]) == ids[sizes[0] :].tolist()


@pytest.mark.parametrize("limit", [1, 3, 40])
def test_parts_encode_to_the_ids_of_the_whole(other, limit):
    rng = random.Random(2)
    for text in [t or "" for t in TEXTS[:12]] + ["".join(rng.choices(f"ab  {MARK}\né", k=60)) for _ in range(200)]:
        parts = parts_of(text, limit)
        assert [i for part in parts for i in other.encode(part)] == other.encode(text), text
        assert " ".join(parts) == text


def test_a_memo_that_is_full_starts_anew():
    memo, made = Memo(np.int32, 600), []

    def make(new):
        made.append(new)
        return np.array([int(w) for w in new for _ in range(2)], np.int32), np.full(len(new), 2)

    for words in ([b"1", b"2"], [b"2", b"3"], [b"1"], [b"4"], [b"1"]):
        data, ends = memo.spread(memo.get(words, make))
        assert data.tolist() == [int(w) for w in words for _ in range(2)] and ends.tolist() == list(range(0, 2 * len(words) + 1, 2))
    assert made == [[b"1", b"2"], [b"3"], [b"4"], [b"1"]]


def test_words_encoded_together_have_the_ids_of_each(other):
    own = built(open(MODEL, "rb").read(), 1)
    rng = random.Random(3)
    plain = [" " + "".join(rng.choices("abeht\n\x00é日🙂.<", k=rng.randint(0, 9))) for _ in range(700)]
    odd = ["  a", f" x{MARK}", f" {MARK}{MARK}y", "   "]
    for words in (plain, plain[:300] + odd + plain[300:], odd):
        ids, sizes = encode_distinct(own, [w.encode() for w in words])
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [own.words.encode(w.replace(" ", MARK)).ids for w in words]


def test_texts_that_come_back_are_not_decoded_again(other, monkeypatch):
    """The library is asked only for rows whose ids do not spell the text."""
    own = built(open(MODEL, "rb").read(), 1)
    rows = [t or "" for t in TEXTS]
    ids, sizes = encode_words(own, *texts(pa.array(rows, pa.large_string())))
    assert spells(own, rows, ids, sizes).all()
    ends = np.concatenate(([0], np.cumsum(sizes)))
    back = own.texts.decode_batch([ids[a:b].tolist() for a, b in zip(ends, ends[1:])], skip_special_tokens=False)
    assert back == [t.replace(MARK, " ") for t in rows]
    monkeypatch.setattr(own, "texts", None)
    assert check(own, other, rows, ids, sizes).all()


def test_odd_rows_of_the_checked_operator(spark, other):
    docs = spark.createDataFrame([(t, 1, False) for t in [*TEXTS, "long " * 500_000 + "end"]], "text string, token_ids int, Parity boolean")
    for r in encode_and_check(docs).collect():
        assert r.token_ids == other.encode(r.text or "") and r.parity and r.round_trip
    assert encode_and_check(docs).columns == ["text", "token_ids", "parity", "round_trip"]
    assert encode_and_check(docs.limit(0)).collect() == []
