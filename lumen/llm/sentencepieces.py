"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf file is parsed here (fields named below) and rebuilt as a
``tokenizers.Tokenizer``: the normaliser (dummy prefix, extra spaces), the
metaspace marker, unigram scores or the merge order that BPE scores imply, byte
fallback and the decoder.  Texts are encoded in batches, multithreaded within a
task (``threads``; by default the cores that ``spark.task.cpus`` gives a task, 1
unless it is set).
Where no piece has the marker after another character, no merge crosses a word's
start; such models encode a text as parts of about ``PART_CHARS`` cut there, with
the same ids and shorter merge queues.  Texts with single spaces between their words
give their ids by word: the different words of up to ``GROUP_CHARS`` of texts are
joined to such parts, encoded once and put in the places of their occurrences.

Every row is encoded, decoded and compared with its text (``round_trip``), and
``parity`` says for every row whether the SentencePiece library itself gives the
same ids for the whole text and decodes them to the same text.

Supported: models with the identity normaliser, BPE or unigram.  Any other
normaliser raises ``ValueError`` instead of giving different ids.  The path of
the model is a parameter; its file must be present on every executor, or
``model_bytes`` be given.

Defined results: null text is empty and has no ids; repeated rows give repeated
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.llm.common import schema_of, texts_of

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
PART_CHARS = 1500
PARTS_AT_ONCE = 400
GROUP_CHARS = 8_000_000
MARK = "▁"
CUT = re.compile(f"[^{MARK}](?={MARK})")
# Fixed values of the model file format: field numbers and piece types.
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
TRAINER_MODEL_TYPE, TRAINER_BYTE_FALLBACK, TRAINER_MARK_AS_SUFFIX = 3, 35, 24
UNIGRAM, BPE = 1, 2
NORM_NAME, NORM_CHARSMAP, NORM_DUMMY_PREFIX, NORM_REMOVE_SPACES, NORM_ESCAPE = 1, 2, 3, 4, 5


def fields(message: bytes) -> list[tuple[int, int | bytes]]:
    """(field number, value) of every field of a protobuf message, in order."""
    out, at = [], 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}[wire] if wire != 2 else varint()
            value = message[at:at + size]
            at += size
        out.append((tag >> 3, value))
    return out


class Model:
    """What the protobuf says: pieces (text, score, type), flags, normaliser."""

    def __init__(self, data: bytes):
        top = fields(data)
        self.pieces = []
        for number, value in top:
            if number == MODEL_PIECES:
                p = dict(fields(value))
                self.pieces.append((p[PIECE_TEXT].decode("utf-8"),
                                    struct.unpack("<f", p.get(PIECE_SCORE, b"\0\0\0\0"))[0], p.get(PIECE_TYPE, NORMAL)))
        trainer = dict(fields(dict(top).get(MODEL_TRAINER, b"")))
        norm = dict(fields(dict(top).get(MODEL_NORMALIZER, b"")))
        self.kind = trainer.get(TRAINER_MODEL_TYPE, UNIGRAM)
        self.byte_fallback = bool(trainer.get(TRAINER_BYTE_FALLBACK, 0))
        self.dummy_prefix = bool(norm.get(NORM_DUMMY_PREFIX, 1))
        self.remove_spaces = bool(norm.get(NORM_REMOVE_SPACES, 1))
        if norm.get(NORM_CHARSMAP) or not norm.get(NORM_ESCAPE, 1) or trainer.get(TRAINER_MARK_AS_SUFFIX, 0):
            raise ValueError(f"normaliser {norm.get(NORM_NAME)} is not supported")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is not supported")

    def merges(self) -> list[tuple[str, str]]:
        """Every way to join two pieces to a third, best score of the result first."""
        whole = {t for t, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
        found = [(-score, n, t[:k], t[k:]) for n, (t, score, kind) in enumerate(self.pieces) if kind == NORMAL
                 for k in range(1, len(t)) if t[:k] in whole and t[k:] in whole]
        return [(a, b) for _, _, a, b in sorted(found, key=lambda m: m[:2])]

    def tokenizer(self):
        """The model as a ``tokenizers.Tokenizer``."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers
        unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        if self.kind == BPE:
            core = models.BPE({p[0]: i for i, p in enumerate(self.pieces)}, self.merges(), fuse_unk=True,
                              unk_token=self.pieces[unknown][0], byte_fallback=self.byte_fallback,
                              cache_capacity=0)  # texts and parts rarely repeat
        else:
            core = models.Unigram([(t, s) for t, s, _ in self.pieces], unknown, self.byte_fallback)
        out = Tokenizer(core)
        steps = [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex(r"\A | \z"), "")] if self.remove_spaces else []
        steps += [normalizers.Prepend(MARK)] if self.dummy_prefix else []
        out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        users = [AddedToken(t, normalized=False, special=False) for t, _, kind in self.pieces if kind == USER_DEFINED]
        if users:
            out.add_tokens(users)
        # fused before the marks are replaced: one replacement a text, not one a token
        out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " "),
                                         *([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else [])])
        return out

    def normalise(self, text: str) -> str:
        """What the tokenizer's normaliser does, for a whole text."""
        if self.remove_spaces:
            text = re.sub(" {2,}", " ", text).strip(" ")
        return (MARK if self.dummy_prefix and text else "") + text.replace(" ", MARK)

    def divisible(self) -> bool:
        """Whether a text may be cut before a marker that follows another character."""
        covered = self.byte_fallback and sum(kind == BYTE for _, _, kind in self.pieces) == 256  # no unknowns to fuse
        return self.kind == BPE and covered and not any(
            kind == USER_DEFINED or (kind in (NORMAL, UNUSED) and MARK in t.lstrip(MARK)) for t, _, kind in self.pieces)


class Backend:
    """Batched encoding and decoding with the model's tokenizer."""

    def __init__(self, model: Model):
        from tokenizers import decoders
        self.model, self.tokenizer, self.divisible = model, model.tokenizer(), model.divisible()
        if self.divisible:  # whole texts are normalised and decoded marks replaced here, not part by part
            self.tokenizer.normalizer = None
            self.tokenizer.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
        self.marked = np.array([t.startswith(MARK) for t, _, _ in model.pieces])
        self.by_word = self.divisible and model.dummy_prefix and any(
            t == MARK and kind == NORMAL for t, _, kind in model.pieces)  # so each word's first piece, and no other, is marked

    @staticmethod
    def parts(text: str) -> list[str]:
        """A normalised text cut before markers, at the first place after every ``PART_CHARS``."""
        out, at = [], 0
        while len(text) - at > PART_CHARS and (m := CUT.search(text, at + PART_CHARS)):
            out.append(text[at:m.end()])
            at = m.end()
        return [*out, text[at:]] if text else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        flat, ends = self.flat_ids(texts)
        return [x.tolist() for x in np.split(flat, ends[:-1])] if texts else []

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end."""
        plain = [self.by_word and bool(t) and "  " not in (c := t.replace(MARK, " ")) and c[0] != " " != c[-1] for t in texts]
        found, sizes = self.ids_by_word([t for t, p in zip(texts, plain) if p])
        if all(plain):
            return found, np.cumsum(sizes)
        words = iter(np.split(found, np.cumsum(sizes)))
        others = iter(self.ids_by_part([t for t, p in zip(texts, plain) if not p]))
        out = [next(words) if p else next(others) for p in plain]
        return np.concatenate(out), np.cumsum([a.size for a in out])

    def ids_by_word(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts whose words stand between single spaces, and their number by text."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        words = pc.split_pattern(pa.array([t.replace(MARK, " ") for t in texts], pa.large_string()), pattern=" ")
        coded = words.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        parts = self.parts(MARK + MARK.join(coded.dictionary.to_pylist()))
        ids = np.concatenate([np.array(e.ids, np.int32) for at in range(0, len(parts), PARTS_AT_ONCE) for e in
                              self.tokenizer.encode_batch_fast(parts[at:at + PARTS_AT_ONCE], add_special_tokens=False)])
        start = np.flatnonzero(self.marked[ids])
        taken = np.diff(np.append(start, ids.size))[which]
        ends = np.append(0, np.cumsum(taken))
        flat = ids[np.repeat(start[which] - ends[:-1], taken) + np.arange(ends[-1])]
        return flat, np.diff(ends[words.offsets.to_numpy()])

    def ids_by_part(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, encoded whole or as its parts."""
        if not self.divisible:
            return [np.array(e.ids if t else [], np.int32) for t, e in
                    zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))]
        parts = [self.parts(self.model.normalise(t)) for t in texts]
        found = iter(self.tokenizer.encode_batch_fast([x for p in parts for x in p], add_special_tokens=False))
        return [np.concatenate([np.zeros(0, np.int32), *[np.array(next(found).ids, np.int32) for _ in p]]) for p in parts]

    def decode(self, ids: list[list[int]]) -> list[str]:
        texts = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        if not self.divisible:
            return texts
        texts = [t.replace(MARK, " ") for t in texts]
        return [t[1:] if t.startswith(" ") else t for t in texts] if self.model.dummy_prefix else texts


_LOADED: dict = {}


def _backends(path: str | None, data: bytes | None):
    """Both backends, built once a Python worker."""
    key = path or hash(data)
    if key not in _LOADED:
        import sentencepiece
        raw = data if data is not None else open(path, "rb").read()
        _LOADED[key] = (Backend(Model(raw)), sentencepiece.SentencePieceProcessor(model_proto=raw))
    return _LOADED[key]


OUT = "n_tokens int, ids array<int>, ids_crc long, decoded_n_chars int, round_trip boolean, parity boolean"


def spans(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold together at most ``most``, or one row."""
    at = 0
    while at < len(sizes):
        end, size = at, 0
        while end < len(sizes) and (end == at or size + sizes[end] <= most):
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def task_threads(spark: SparkSession) -> int:
    """The cores of a task in this session."""
    return int(spark.conf.get("spark.task.cpus", "1"))


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = MODEL_PATH,
                  model_bytes: bytes | None = None, threads: int | None = None,
                  batch_chars: int = 500_000) -> DataFrame:
    """Per row: the id, the token ids and their count, a CRC of the ids, the length
    of the decoded text, whether it is the text again, and ``parity``."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = schema_of(f"`{id_col}` {kind}, {OUT}")
    threads = threads or task_threads(docs.sparkSession)

    def batch(ids_in, part, flat, ends, own, reference, want):
        arrays = np.split(flat, ends[:-1])
        ids = [a.tolist() for a in arrays]
        back = own.decode(ids)
        parity = [same == i and reference.decode(i) == b
                  for same, i, b in zip(reference.encode(part, num_threads=threads), ids, back)]
        sizes = np.diff(ends, prepend=0).astype(np.int32)
        cols = [ids_in, pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat)),
                pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64()),
                pa.array([len(b) for b in back], pa.int32()),
                pa.array([b == t for b, t in zip(back, part)], pa.bool_()),
                pa.array(parity, pa.bool_())]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, want)], schema=want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        want = to_arrow_schema(schema)
        own, reference = _backends(model_path, model_bytes)
        for rows in batches:
            sizes = pc.fill_null(pc.utf8_length(rows.column(1)), 0).to_pylist()
            for start, stop in spans(sizes, GROUP_CHARS):
                texts = texts_of(rows.column(1).slice(start, stop - start))
                flat, ends = own.flat_ids(texts)
                for at, end in spans(sizes[start:stop], batch_chars):  # memory is bounded by the group and one text
                    first = ends[at - 1] if at else 0
                    yield batch(rows.column(0).slice(start + at, end - at), texts[at:end], flat[first:ends[end - 1]],
                                ends[at:end] - first, own, reference, want)
        gc.collect()  # a reused worker else keeps the helpers of earlier tasks for long

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
