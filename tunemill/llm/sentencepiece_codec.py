"""SentencePiece models run by the tokenizers library: encode, decode, compare.

The model file (a protobuf message) is read field by field. From it come the normaliser (character
map, extra blanks, dummy prefix), the blank marker, the pieces with their scores (unigram) or the merges
that the scores order (BPE), and the byte pieces for what no piece covers.

A text is cut before each run of blank markers if no piece has a marker behind another character:
no piece crosses such a cut, so the tokens stay the same. Each different word of a batch is then
encoded once, all of them in one multithreaded call, and kept for the batches after it.

A null text has null tokens; an empty one has none. A token list that is null decodes to null. Rows
are coded one by one, so nulls in other columns, ties and repeated rows change nothing.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import eq
from struct import unpack
from typing import NamedTuple

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tunemill.llm.common import in_slices

MARKER = "▁"
#: Words whose tokens a worker keeps in each of two generations.
CACHE = 200_000
#: Bytes of text in one call of the library.
CALL_BYTES = 1_000_000
DECODED_AT_A_TIME = 256

# Numbers of message fields, kinds of models and of pieces in the model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK = 3, 35
CHARSMAP, DUMMY_PREFIX, FEWER_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    fewer_blanks: bool


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire} in a model file")
        yield tag >> 3, value


def read_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == PIECES:
            piece = dict(fields(value))
            score = unpack("<f", piece[PIECE_SCORE])[0] if PIECE_SCORE in piece else 0.0
            pieces.append((piece[PIECE_TEXT].decode(), score, piece.get(PIECE_KIND, NORMAL)))
        elif number == TRAINER:
            trainer = dict(fields(value))
        elif number == NORMALIZER:
            normalizer = dict(fields(value))
    if not normalizer.get(ESCAPE_BLANKS, 1):
        raise ValueError("models that keep blanks as they are have no marker to decode by")
    return Model(
        pieces,
        trainer.get(MODEL_TYPE, UNIGRAM),
        bool(trainer.get(BYTE_FALLBACK, 0)),
        normalizer.get(CHARSMAP, b""),
        bool(normalizer.get(DUMMY_PREFIX, 1)),
        bool(normalizer.get(FEWER_BLANKS, 1)),
    )


def merges(model: Model) -> list[tuple[str, str]]:
    """Each way to put a piece together from two others, best score first."""
    ids = {text: number for number, (text, _, _) in enumerate(model.pieces)}
    found = []
    for number, (text, score, kind) in enumerate(model.pieces):
        if kind in (NORMAL, USER_DEFINED):
            splits = ((text[:k], text[k:]) for k in range(1, len(text)))
            found += [(-score, number, ids[a], ids[b], a, b) for a, b in splits if a in ids and b in ids]
    return [(a, b) for *_, a, b in sorted(found)]


def build_tokenizer(model: Model):
    """The tokenizers-library counterpart of a model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    texts = [text for text, _, _ in model.pieces]
    unknown = next((number for number, piece in enumerate(model.pieces) if piece[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        scored = [(text, score) for text, score, _ in model.pieces]
        tokenizer = Tokenizer(models.Unigram(scored, unk_id=unknown, byte_fallback=model.byte_fallback))
    elif model.kind == BPE:
        vocabulary = {text: number for number, text in enumerate(texts)}
        name = texts[unknown] if unknown is not None else None
        tokenizer = Tokenizer(
            models.BPE(vocabulary, merges(model), unk_token=name, fuse_unk=True, byte_fallback=model.byte_fallback)
        )
    else:
        raise ValueError(f"model type {model.kind}: only unigram and BPE are known")
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.fewer_blanks:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    # Markers are put back in the whole text at once, not token by token.
    back = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARKER, " ")]
    tokenizer.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    defined = [AddedToken(text, normalized=False) for text, _, kind in model.pieces if kind == USER_DEFINED]
    if defined:
        tokenizer.add_tokens(defined)
    return tokenizer


class Coder:
    """A tokenizer with the words it has seen."""

    def __init__(self, model: Model):
        from tokenizers import Tokenizer

        self.tokenizer = build_tokenizer(model)
        self.by_word = not any(MARKER in text.lstrip(MARKER) for text, _, _ in model.pieces)
        self.by_word &= all(kind != USER_DEFINED for _, _, kind in model.pieces)
        # A line end that is in no piece is coded as bytes and ends a word as well.
        if not model.byte_fallback or any("\n" in text for text, _, _ in model.pieces):
            self.word = re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")
        else:
            self.word = re.compile(f"\n+|{MARKER}+[^{MARKER}\n]*|[^{MARKER}\n]+")
        self.plain = not model.charsmap and not model.fewer_blanks
        self.prefix = MARKER if model.dummy_prefix else ""
        # The words come normalised.
        self.words = Tokenizer(self.tokenizer.model)
        # Words of two generations: what the older one holds and is met again moves on.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def normalized(self, text: str) -> str:
        if self.plain:
            return self.prefix + text.replace(" ", MARKER) if text else text
        return self.tokenizer.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.by_word:
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [one.ids for one in coded]
        cut = [self.word.findall(self.normalized(text)) for text in texts]
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        new = set(chain.from_iterable(cut)).difference(self.known)
        met = new.intersection(self.older)
        self.known.update(zip(met, map(self.older.__getitem__, met)))
        new = list(new.difference(met))
        coded = self.words.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, [tuple(one.ids) for one in coded]))
        return [list(chain.from_iterable(map(self.known.__getitem__, words))) for words in cut]


@lru_cache(maxsize=4)
def _loaded(name: str, threads: int) -> Coder:
    """One coder per worker process and model."""
    # Read by the library when it is first used in a process.
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    with open(SparkFiles.get(name), "rb") as file:
        return Coder(read_model(file.read()))


@lru_cache(maxsize=4)
def _reference(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))


def _calls(texts: list[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > CALL_BYTES:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def encode_texts(coder: Coder, texts: list[str]) -> list[list[int]]:
    return [ids for some in _calls(texts) for ids in coder.encode(some)]


def decode_ids(coder: Coder, ids: list[list[int]]) -> list[str]:
    return [
        text
        for at in range(0, len(ids), DECODED_AT_A_TIME)
        for text in coder.tokenizer.decode_batch(ids[at : at + DECODED_AT_A_TIME], skip_special_tokens=False)
    ]


def ship(docs: DataFrame, model_path: str) -> str:
    """Hands the model file to the executors; returns its name there."""
    docs.sparkSession.sparkContext.addFile(model_path)
    return os.path.basename(model_path)


def task_threads(docs: DataFrame) -> int:
    """As many threads as Spark gives a task CPUs; more would run on those of other tasks."""
    return int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))


def encode(
    docs: DataFrame, model_path: str, threads: int | None = None, round_trip: bool = False, parity: bool = False
) -> DataFrame:
    """The columns of `docs` and `ids` (array of int); columns of the new names are replaced.

    On demand also `round_trip` (decoding gives back the text) and `parity` (the sentencepiece library
    gives the same ids); both null for a null text.
    """
    name, threads = ship(docs, model_path), threads or task_threads(docs)
    wanted = (("ids", "array<int>", True), ("round_trip", "boolean", round_trip), ("parity", "boolean", parity))
    new = {column: kind for column, kind, asked in wanted if asked}
    kept = [column for column in docs.columns if column not in new]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _loaded(name, threads)
        column = batch["text"]
        there = column.is_valid()
        texts = column.filter(there).to_pylist()
        ids = encode_texts(coder, texts)
        found = [_spread(ids, there, pa.list_(pa.int32()))]
        if round_trip:
            back = decode_ids(coder, ids)
            found.append(_spread([a == b for a, b in zip(back, texts)], there, pa.bool_()))
        if parity:
            reference = _reference(name)
            theirs = (coded for some in _calls(texts) for coded in reference.encode(some, num_threads=1))
            found.append(_spread(list(map(eq, theirs, ids)), there, pa.bool_()))
        return pa.record_batch([*(batch[c] for c in kept), *found], [*kept, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in in_slices(batches):
                yield rows(part)
        finally:
            # The process goes on to other tasks and keeps the tokenizer, but not the words.
            _loaded(name, threads).forget()

    kinds = {field.name: field.dataType.simpleString() for field in docs.schema} | new
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*kept, *new])
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def _spread(values: list, there: pa.Array, kind: pa.DataType) -> pa.Array:
    rest = iter(values)
    return pa.array([next(rest) if valid else None for valid in there.to_pylist()], kind)


def decode(coded: DataFrame, model_path: str, threads: int | None = None) -> DataFrame:
    """The columns of `coded` and `decoded`, the text of its `ids`; a column of that name is replaced."""
    name, threads = ship(coded, model_path), threads or task_threads(coded)
    kept = [column for column in coded.columns if column != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            texts = decode_ids(_loaded(name, threads), ids.drop_null().to_pylist())
            columns = [*(batch[c] for c in kept), _spread(texts, ids.is_valid(), pa.string())]
            yield pa.record_batch(columns, [*kept, "decoded"])

    kinds = {field.name: field.dataType.simpleString() for field in coded.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + ["decoded string"])
    return coded.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)
