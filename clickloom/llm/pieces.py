"""Encoding and decoding with a SentencePiece model, by the tokenizers library.

The model file is parsed here (it is a small protobuf message) and rebuilt: its
normaliser, the metaspace marker, scores (as merge ranks for a BPE model, as
they are for a unigram model) and byte fallback.  When no piece holds a marker
after another character, no merge can cross the place before a run of markers,
so the text is cut there into words first and each distinct word is encoded
once for as long as a worker remembers it; else whole texts are encoded.  Words
are told apart by their bytes.  Where checks are asked for, the reference library
encodes the whole text, and the ids of the whole text are decoded and compared
with it, in the same pass: by the bytes that the library decodes each id to, and by
the library itself where these are not the text.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from .common import binaries, blocks, texts, with_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A larger model file is refused: it is sent to every executor.
MODEL_BYTES = 64 << 20
#: Text taken at once, words and documents given to the library at once, and its threads in a task.
BATCH_BYTES = 1 << 20
BATCH_ROWS = 10_000
DECODE_ROWS = 1000
JOINED_WORDS = 256
THREADS = 2
#: Bytes of distinct words and their ids that a worker remembers; when full it starts anew.
MEMO_BYTES = 32 << 20
#: What a remembered word takes beside its bytes and ids.
_ENTRY_BYTES = 150
MARK = "▁"
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_WORD_START = re.compile(f"(?<![ {MARK}]) ")


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            if kind == 2:
                size, at = varint(at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = message[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, content: bytes) -> Model:
        model = cls()
        for number, value in fields(content):
            if number == 1:
                own = dict(fields(value))
                model.pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, NORMAL)))
            elif number == 2:
                own = dict(fields(value))
                model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
                if own.get(24):
                    raise ValueError("markers at the end of words are not supported")
            elif number == 3:
                own = dict(fields(value))
                model.charsmap = own.get(2, b"")
                model.dummy_prefix, model.squeeze, model.escape = (bool(own.get(i, 1)) for i in (3, 4, 5))
        if model.kind not in (UNIGRAM, BPE) or any(p[2] == USER_DEFINED for p in model.pieces):
            raise ValueError("only unigram and BPE models without pieces of the user are supported")
        return model

    @property
    def space(self) -> str:
        return MARK if self.escape else " "

    @cached_property
    def splits(self) -> bool:
        """Whether every piece has its markers at its start only."""
        return not any(self.space in p.lstrip(self.space) for p, _, kind in self.pieces if kind == NORMAL)

    @cached_property
    def by_word(self) -> bool:
        """Whether a text can be cut before its runs of spaces and each cut encoded alone."""
        return self.splits and self.escape and self.dummy_prefix and not self.squeeze and not self.charsmap


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best score of the result first."""
    known = {p: (-score, i) for i, (p, score, kind) in enumerate(pieces) if kind == NORMAL}
    found = []
    for piece, rank in known.items():
        for cut in range(1, len(piece)):
            if piece[:cut] in known and piece[cut:] in known:
                found.append((rank, known[piece[:cut]], piece[:cut], piece[cut:]))
    return [(left, right) for _, _, left, right in sorted(found)]


def build(model: Model, words: bool = False) -> Tokenizer:
    """A tokenizer of the library that encodes and decodes as the model says; ``words``: it gets words with their markers."""
    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    # Control and unused pieces have ids but never match text.
    names = [p if kind in (NORMAL, BYTE, UNKNOWN) else f"\ufdd0{i}\ufdd0" for i, (p, _, kind) in enumerate(model.pieces)]
    if model.kind == BPE:
        core = models.BPE(
            {name: i for i, name in enumerate(names)}, merges(model.pieces), byte_fallback=model.byte_fallback,
            unk_token=None if unknown is None else names[unknown], fuse_unk=True,
        )
    else:
        core = models.Unigram([(name, p[1]) for name, p in zip(names, model.pieces, strict=True)], unknown, model.byte_fallback)
    out = Tokenizer(core)
    if words:
        return out
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(model.space))
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    if model.splits:
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{model.space}+[^{model.space}]*"), "isolated")
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(model.space, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
    return out


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, through Spark's reader; refused above ``MODEL_BYTES``."""
    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.sum("length")).head()[0]
    if size is None or size > MODEL_BYTES:
        raise ValueError(f"{path} has {size} bytes; a model of at most {MODEL_BYTES} is expected")
    return bytes(files.select("content").head()[0])


class Memo:
    """What distinct words were turned into, one after the other in one array that grows in place."""

    def __init__(self, kind, limit: int = MEMO_BYTES):
        self.kind, self.limit = kind, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ends = np.zeros(1 << 10, np.int64)
        self.data = np.zeros(1 << 12, self.kind)
        self.held = 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        grown = np.zeros(max(size, 2 * len(array)), array.dtype)
        grown[: len(array)] = array
        return grown

    def get(self, words: list[bytes], make) -> np.ndarray:
        """The place of each of the distinct ``words``; ``make(new)`` gives the data and sizes of new ones."""
        if self.held > self.limit:
            self.clear()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            data, sizes = make(fresh)
            n, end = len(self.place), int(self.ends[len(self.place)])
            self.data = self._room(self.data, end + len(data))
            self.data[end : end + len(data)] = data
            self.ends = self._room(self.ends, n + len(fresh) + 1)
            self.ends[n + 1 : n + len(fresh) + 1] = end + np.cumsum(sizes)
            at[new] = np.arange(n, n + len(fresh))
            self.place.update(zip(fresh, range(n, n + len(fresh))))
            self.held += sum(map(len, fresh)) + data.nbytes + _ENTRY_BYTES * len(fresh)
        return at

    def spread(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The data at places ``at`` one after the other, and where each ends (from 0)."""
        low = self.ends[at]
        size = self.ends[at + 1] - low
        ends = np.concatenate(([0], np.cumsum(size)))
        return self.data[np.arange(ends[-1]) + np.repeat(low - ends[:-1], size)], ends


@dataclass
class Built:
    """A model and what a worker keeps for it."""

    model: Model
    texts: Tokenizer
    words: Tokenizer
    joined: Tokenizer
    ids: Memo
    bytes: Memo
    opens: np.ndarray
    marks: np.ndarray
    content: bytes

    @cached_property
    def spelled(self) -> Memo:
        """The bytes that the library decodes each id to, behind a word; those of a byte piece are its byte."""
        ahead = self.words.encode(f"{MARK}a").ids
        found = self.texts.decode_batch([[*ahead, i] for i in range(len(self.model.pieces))], skip_special_tokens=False)
        rows = [bytes([int(p[3:-1], 16)]) if kind == BYTE else x.encode()[1:] for x, (p, _, kind) in zip(found, self.model.pieces, strict=True)]
        out = Memo(np.uint8)
        out.get(list(map(str.encode, map(str, range(len(rows))))), lambda new: (np.frombuffer(b"".join(rows), np.uint8), np.fromiter(map(len, rows), np.int64, len(rows))))
        return out

    @cached_property
    def reference(self):
        """The reference library's own reading of the model."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.content)


_built: dict[bytes, Built] = {}


def built(content: bytes, threads: int) -> Built:
    """The model's tokenizers of texts and of words, built once a worker."""
    if content not in _built:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        model = Model.parse(content)
        opens = np.array([p.startswith(model.space) for p, _, _ in model.pieces])
        marks = np.array([bool(p) and not p.strip(model.space) for p, _, _ in model.pieces])
        _built.clear()
        joined = build(model, words=True)
        joined.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        _built[content] = Built(model, build(model), build(model, words=True), joined, Memo(np.int32), Memo(np.uint8), opens, marks, content)
    return _built[content]


def encode_all(tokenizer: Tokenizer, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows, one after the other, and how many each row has."""
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(rows), BATCH_ROWS):
        found = [x.ids for x in tokenizer.encode_batch_fast(rows[i : i + BATCH_ROWS], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(sizes[-1].sum())))
    return np.concatenate(ids), np.concatenate(sizes)


def encode_distinct(own: Built, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_all``, of words that start with a space.

    Those with no other space or marker are joined and the library cuts them
    apart again; where a piece opens with a marker, a word starts.  Others are
    given to it one by one.
    """
    mark = MARK.encode()
    parts = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
    texts = [b"".join(part) for part in parts]
    plain = [text.count(b" ") == len(part) and mark not in text for text, part in zip(texts, parts, strict=True)]
    joined = iter(own.joined.encode_batch_fast([x.replace(b" ", mark).decode() for x, fits in zip(texts, plain, strict=True) if fits], add_special_tokens=False))
    ids, sizes = [], []
    for part, fits in zip(parts, plain, strict=True):
        found = np.array(next(joined).ids if fits else [], np.int32)
        starts = np.flatnonzero(own.opens[found])
        # Without a piece for the marker a word may not open with one.
        if fits and len(starts) == len(part) and starts[0] == 0:
            n = np.diff(np.append(starts, len(found)))
        else:
            found, n = encode_all(own.words, [w.decode().replace(" ", MARK) for w in part])
        ids.append(found)
        sizes.append(n)
    return np.concatenate(ids), np.concatenate(sizes)


def agree(other, rows: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the reference library gives each row these ids."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = np.ones(len(rows), bool)
    for i in range(0, len(rows), BATCH_ROWS):
        found = other.encode(rows[i : i + BATCH_ROWS], num_threads=1, return_type="numpy")
        flat = np.concatenate(found)
        length = np.fromiter(map(len, found), np.int64, len(found))
        own = ids[ends[i] : ends[i + len(found)]]
        if not np.array_equal(length, sizes[i : i + len(found)]) or not np.array_equal(flat, own):
            out[i : i + len(found)] = [np.array_equal(x, ids[a:b]) for x, a, b in zip(found, ends[i:], ends[i + 1 :])]
    return out


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with the dummy prefix put in, where their words start, and each row's first word.

    A word starts at a row's start and at the first of some spaces, unless a
    literal marker, which counts as a space too, stands before it.
    """
    full = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][full], 32)
    offsets = offsets + np.concatenate(([0], np.cumsum(full)))
    space = data == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    mark = MARK.encode()
    cut[3:] &= ~((data[:-3] == mark[0]) & (data[1:-2] == mark[1]) & (data[2:-1] == mark[2]))
    cut[offsets[:-1][full]] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.searchsorted(starts, offsets)


def back_to_text(own: Built, rows: list[list[int]]) -> list[str]:
    """The texts of words given as ids."""
    # With a word in front, the library leaves each word's own marker alone.
    ahead = own.words.encode(f"{MARK}a").ids
    rows = [ahead + x for x in rows]
    return [x[1:] for i in range(0, len(rows), BATCH_ROWS) for x in own.texts.decode_batch(rows[i : i + BATCH_ROWS], skip_special_tokens=False)]


def distinct(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, compared byte by byte, and for each word its place among them."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def encode_words(own: Built, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ids per row; each distinct word is encoded once."""
    data, starts, first = cut_words(data, offsets)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    words, inverse = distinct(binaries(data, starts, ends))
    at = own.ids.get(words, lambda new: encode_distinct(own, new))
    ids, ends = own.ids.spread(at[inverse])
    return ids, np.diff(ends[first])


def parts_of(text: str, limit: int) -> list[str]:
    """A text in parts of about ``limit`` characters that are encoded, one after the other, to its ids.

    A cut takes the first space of a run away, as every part gets the prefix.
    """
    out, low = [], 0
    while len(text) - low > limit and (cut := _WORD_START.search(text, low + limit)) and cut.start() < len(text) - 1:
        out.append(text[low : cut.start()])
        low = cut.end()
    return [*out, text[low:]] if low else [text]


def spells(own: Built, rows: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes of each row's ids, less the dummy prefix, are the row's text (a literal marker a space).

    The library decodes such ids to just that text: the bytes are its own of each
    id, and those of byte pieces are valid UTF-8 together.
    """
    data, ends = own.spelled.spread(ids)
    bounds = ends[np.concatenate(([0], np.cumsum(sizes)))]
    data = data.tobytes()
    texts = (b" " + x.replace(MARK, " ").encode() if x else b"" for x in rows)
    return np.fromiter((data[a:b] == x for a, b, x in zip(bounds[:-1].tolist(), bounds[1:].tolist(), texts, strict=True)), bool, len(rows))


def check(own: Built, other, rows: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per row, whether the reference library gives these ids for the whole text, and whether they decode to it.

    A literal marker decodes to the space that it stands for; a model that
    normalises gives the text as the reference library gives it back.
    """
    same, back = agree(other, rows, ids, sizes), np.zeros(len(rows), bool)
    if own.model.by_word:
        back = spells(own, rows, ids, sizes)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    left = np.flatnonzero(~back).tolist()
    for i in range(0, len(left), DECODE_ROWS):
        some = left[i : i + DECODE_ROWS]
        found = own.texts.decode_batch([ids[ends[j] : ends[j + 1]].tolist() for j in some], skip_special_tokens=False)
        for j, text in zip(some, found, strict=True):
            back[j] = text == (rows[j].replace(MARK, " ") if own.model.by_word else other.decode(other.encode(rows[j])))
    return np.stack([same, back], axis=1)


def decode_words(own: Built, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The texts of rows of ids: each distinct word, from marker to marker, is decoded once."""
    cut = own.opens[ids]
    cut[1:] &= ~own.marks[ids[:-1]]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(ids))[: len(starts)]
    words, inverse = distinct(binaries(ids.astype("<i4").view(np.uint8), 4 * starts, 4 * ends))

    def make(new):
        found = [x.encode() for x in back_to_text(own, [np.frombuffer(w, "<i4").tolist() for w in new])]
        return np.frombuffer(b"".join(found), np.uint8), np.fromiter(map(len, found), np.int64, len(found))

    at = own.bytes.get(words, make)[inverse]
    data, ends = own.bytes.spread(at)
    bounds = ends[np.searchsorted(starts, offsets)]
    # The dummy prefix goes.
    first = (bounds[:-1] < bounds[1:]) & (data[np.minimum(bounds[:-1], max(0, len(data) - 1))] == 32) if len(data) else np.zeros(len(bounds) - 1, bool)
    return binaries(data, bounds[:-1] + first, bounds[1:]).cast(pa.large_string())


def encode(docs: DataFrame, path: str = MODEL, text_col: str = "text", out: str = "token_ids", checks: tuple[str, str] | None = None, threads: int = THREADS) -> DataFrame:
    """``docs`` with the array column ``out``: the ids of the whole text.

    ``checks`` names two boolean columns to add: whether the reference library
    gives the same ids for the whole text, and whether the ids decode to it (a
    literal marker to the space that it stands for; the text as the model
    normalises it).  With a model by words a very long text is taken in parts,
    each as if it were a text.  A null text is the empty text; an empty text has
    no ids.  Text that looks like a control piece is ordinary text.  Columns
    already called ``out`` or as ``checks`` say are replaced; all other columns
    and rows stay, also of an empty table.
    """
    content = model_bytes(docs.sparkSession, path)

    def work(column):
        own = built(content, threads)
        other = own.reference if checks else None
        _, offsets = texts(column)
        ids, sizes, fine = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros((0, 2), bool)]
        for low, high in blocks(offsets, BATCH_BYTES):
            whole = [x or "" for x in column[low:high].to_pylist()]
            cut = [parts_of(x, BATCH_BYTES) if own.model.by_word else [x] for x in whole]
            first = np.concatenate(([0], np.cumsum([len(x) for x in cut])))
            length = np.zeros(first[-1], np.int64)
            good = np.ones((first[-1], 2), bool)
            # A long text is a block alone: its parts are taken one by one.
            steps = [(0, first[-1])] if len(whole) > 1 else [(i, i + 1) for i in range(first[-1])]
            rows = [x for some in cut for x in some]
            for a, b in steps:
                found, n = encode_words(own, *texts(pa.array(rows[a:b], pa.large_string()))) if own.model.by_word else encode_all(own.texts, rows[a:b])
                length[a:b] = n
                if other:
                    good[a:b] = check(own, other, rows[a:b], found, n)
                ids.append(found)
            sizes.append(np.add.reduceat(length, first[:-1]))
            fine.append(np.logical_and.reduceat(good, first[:-1], axis=0))
        flat = np.concatenate(ids)
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        fine = np.concatenate(fine)
        return [lists, pa.array(fine[:, 0]), pa.array(fine[:, 1])] if checks else [lists]

    return with_columns(docs, [text_col], work, f"`{out}` array<int>" + "".join(f", `{name}` boolean" for name in checks or ()))


def decode(docs: DataFrame, path: str = MODEL, ids_col: str = "token_ids", out: str = "decoded", threads: int = THREADS) -> DataFrame:
    """``docs`` with the string column ``out``: the text of the ids; null ids give the empty text."""
    content = model_bytes(docs.sparkSession, path)

    def work(column):
        own = built(content, threads)
        rows = []
        for i in range(0, len(column), DECODE_ROWS):
            part = column[i : i + DECODE_ROWS]
            if own.model.by_word:
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                rows.append(decode_words(own, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)))))
            else:
                rows.append(pa.array(own.texts.decode_batch([x or [] for x in part.to_pylist()], skip_special_tokens=False), pa.large_string()))
        return [pa.concat_arrays(rows).cast(pa.string()) if rows else pa.array([], pa.string())]

    return with_columns(docs, [ids_col], work, f"`{out}` string")


def encode_and_check(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` of the standard model, ``parity`` and ``round_trip`` of whole texts, in one pass.

    Odd rows are as ``encode`` says: a null or empty text has no ids and both
    flags true; columns of these three names are replaced, all others stay.
    """
    return encode(docs, text_col=text_col, checks=("parity", "round_trip"))
