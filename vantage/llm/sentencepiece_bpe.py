"""SentencePiece models on the tokenizers library.

The model file (a protobuf) is read with a small wire-format reader, and normaliser, metaspace
marker, scores and byte fallback are rebuilt as a ``tokenizers`` pipeline, for unigram and for BPE
models. Batches are encoded with the library's threads. Every distinct unit is also encoded with
the sentencepiece library; on a difference its ids are taken and the document is marked. BPE units
that no piece leaves are given to both libraries joined, many at a time.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vantage.llm.base import release, ship

MARK = "▁"
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

_AT_ONCE = 2048  # units given to the libraries at once
_JOINED = 256  # units in one text given to them
_SLICE = 1 << 19  # bytes of text encoded at once


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at:at + n]
            at += n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            yield tag >> 3, struct.unpack("<d" if kind == 1 else "<f", data[at:at + n])[0]
            at += n
        else:
            raise ValueError(f"unknown wire type {kind}")


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            model.pieces.append((own.get(1, b"").decode(), own.get(2, 0.0), own.get(3, NORMAL)))
        elif number == 2:
            own = dict(_fields(value))
            model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
        elif number == 3:
            own = dict(_fields(value))
            model.charsmap = own.get(2, b"")
            model.add_dummy_prefix = bool(own.get(3, 1))
            model.remove_extra_whitespaces = bool(own.get(4, 1))
            model.escape_whitespaces = bool(own.get(5, 1))
    return model


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best score of the result first."""
    score = {p: s for p, s, kind in pieces if kind in (NORMAL, USER_DEFINED)}
    rank = {p: i for i, (p, _, _) in enumerate(pieces)}
    found = [(-score[p], rank[p[:i]], rank[p[i:]], p[:i], p[i:])
             for p in score for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
    return [(a, b) for *_, a, b in sorted(found)]


def rebuild(model: PieceModel):
    """The model as a ``tokenizers.Tokenizer`` (normaliser, model, decoder)."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model.pieces),
                          unk_token=None if unknown is None else model.pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []))
    return tokenizer


def unit_safe(model: PieceModel) -> bool:
    """No piece goes on after a mark that follows another character: units are then independent."""
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


class Codec:
    """Encoder and decoder of one worker. A unit is a run of marks with what follows up to the next mark.

    Units of a plain model are written without their first mark, which both libraries put in front of any
    text, and with spaces for the others: as words stand in a text with single spaces.
    """

    def __init__(self, path: str, threads: int = 2, verify: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import numpy as np
        import sentencepiece

        from vantage.llm.unit_cache import UnitCache

        with open(path, "rb") as file:
            self.model = parse_model(file.read())
        self.tokenizer = rebuild(self.model)
        self.normalizer, self.tokenizer.normalizer = self.tokenizer.normalizer, None
        self.plain = not self.model.charsmap and not self.model.remove_extra_whitespaces \
            and self.model.add_dummy_prefix and self.model.escape_whitespaces
        self.by_unit = self.plain and unit_safe(self.model)
        self.judge = sentencepiece.SentencePieceProcessor(model_file=path) if verify else None
        self.threads = threads
        self.differing: set[str] = set()
        self.cache = UnitCache(self._encode)
        pieces = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                  else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces]
        self.leads = np.array([kind in (NORMAL, USER_DEFINED) and p.startswith(MARK) for p, _, kind in self.model.pieces], bool)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_lens = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_lens) - self.piece_lens

    def _encode(self, units: list[str]):
        """The ids of distinct units and how many each has, ``_AT_ONCE`` at a time: what the libraries return is
        many times the ids' size."""
        import numpy as np

        # units with spaces and the empty one cannot be joined: they go last, by themselves
        odd = np.array([not u or " " in u for u in units], bool)
        order = np.flatnonzero(~odd), np.flatnonzero(odd)
        found = [self._encode_some([units[i] for i in group[a:a + _AT_ONCE].tolist()])
                 for group in order for a in range(0, len(group), _AT_ONCE)]
        ids, lens = (np.concatenate(x) for x in zip(*found))
        places = np.argsort(np.concatenate(order))
        starts, lens = (np.cumsum(lens) - lens)[places], lens[places]
        return ids[np.arange(len(ids)) + np.repeat(starts - (np.cumsum(lens) - lens), lens)], lens

    def _encode_some(self, units: list[str]):
        import numpy as np

        if not self.by_unit or self.model.kind != BPE or "" in units or " " in "".join(units):
            return self._encode_apart(units)
        # a piece that starts with a mark starts a unit
        parts = [units[a:a + _JOINED] for a in range(0, len(units), _JOINED)]
        joined = [" ".join(part) for part in parts]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(
            [MARK + text.replace(" ", MARK) for text in joined], add_special_tokens=False)]
        right = found if self.judge is None else self.judge.encode(joined, num_threads=self.threads)
        ids, lens = [], []
        for part, own, want in zip(parts, found, right):
            flat = np.array(own, np.uint32)
            starts = np.flatnonzero(self.leads[flat])
            if own != want or len(starts) != len(part) or starts[0]:
                flat, size = self._encode_apart(part)
            else:
                size = np.diff(starts, append=len(flat))
            ids.append(flat)
            lens.append(size)
        return np.concatenate(ids), np.concatenate(lens)

    def _encode_apart(self, units: list[str]):
        """Each unit as a text of its own."""
        import numpy as np

        texts = [MARK + u.replace(" ", MARK) for u in units] if self.plain else units
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.judge is not None and self.plain:
            # the library adds one mark in front itself, but none to a text without any other character
            bare = [not u.strip(" ") for u in units]
            lead = self.judge.encode("x")
            right = self.judge.encode(["x " + u if b else u for u, b in zip(units, bare)], num_threads=self.threads)
            for i, (unit, own, want) in enumerate(zip(units, found, right)):
                if bare[i]:
                    want = want[len(lead):]
                if own != want:
                    self.differing.add(unit)
                    found[i] = want
        return (np.fromiter(chain.from_iterable(found), np.uint32),
                np.fromiter(map(len, found), np.int64, len(found)))

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.plain:
            text = self.normalizer.normalize_str(text)
            return [text] if text else []
        text = text.replace(MARK, " ")
        return [u[1:] for u in re.findall(" *[^ ]+| +", " " + text)] if self.by_unit else [text]

    def _distinct_units(self, texts: list[str]):
        """The distinct units of the texts, the number among them of each unit, and where each text's units end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.list_(pa.string())
        if self.by_unit:
            lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), MARK, " "), " ").cast(kind)
            # spaces at an end or several together leave empty words: these texts are cut by the pattern
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            blank = np.flatnonzero(pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False) == 0)
            odd = np.unique(np.searchsorted(ends, blank, "right"))
            if len(odd):
                order = np.arange(len(texts))
                order[odd] = len(texts) + np.arange(len(odd))
                cut = pa.array([self.units(texts[i]) for i in odd.tolist()], kind)
                lists = pa.concat_arrays([lists, cut]).take(pa.array(order))
        else:
            lists = pa.array([self.units(t) for t in texts], kind)
        every = lists.flatten().dictionary_encode()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        units = every.dictionary.to_numpy(zero_copy_only=False).tolist()
        return units, every.indices.to_numpy(zero_copy_only=False), ends

    def encode(self, texts: list[str]):
        """(flat ids, ids per text, whether the two libraries agreed) of the texts."""
        import numpy as np

        units, places, ends = self._distinct_units(texts)
        ids, lens = self.cache(units, places)
        counts = np.diff(np.concatenate(([0], np.cumsum(lens)))[ends], prepend=0)
        if self.judge is not None and not self.plain:
            return self._judged(texts, ids, counts)
        agreed = np.ones(len(texts), bool)
        if self.differing:
            wrong = np.fromiter(map(self.differing.__contains__, units), bool, len(units))[places]
            agreed = np.diff(np.concatenate(([0], np.cumsum(wrong)))[ends], prepend=0) == 0
        return ids, counts, agreed

    def _judged(self, texts: list[str], ids, lens):
        """Whole texts compared with the sentencepiece library, whose ids count where they differ: its
        normaliser looks at the whole text, so units cannot be judged alone."""
        import numpy as np

        ends = np.cumsum(lens)
        right = self.judge.encode(texts, num_threads=self.threads)
        agreed = np.array([ids[a:b].tolist() == w for a, b, w in zip(ends - lens, ends, right)], bool)
        return np.array([i for own in right for i in own], np.int64), np.array([len(w) for w in right], np.int64), agreed

    def decode(self, ids) -> str:
        """The text of the ids: pieces joined, marks as spaces, byte pieces as bytes, the added space dropped."""
        import numpy as np

        ids = np.asarray(ids, np.int64)
        lens = self.piece_lens[ids]
        ends = np.cumsum(lens)
        gather = np.arange(int(lens.sum())) + np.repeat(self.piece_starts[ids] - (ends - lens), lens)
        text = self.piece_bytes[gather].tobytes().decode("utf-8", "replace")
        return text[1:] if self.model.add_dummy_prefix and text[:1] == " " else text


_kept: dict[tuple, Codec] = {}


def worker_codec(path: str, threads: int, verify: bool) -> Codec:
    """The codec of this Python worker; Spark uses a worker for many tasks."""
    key = (path, threads, verify)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Codec(path, threads, verify)
    return _kept[key]


def encode_documents(docs: DataFrame, model_path: str, threads: int = 2, verify: bool = True,
                     with_ids: bool = True) -> DataFrame:
    """Encode every text and decode it again.

    Returns the columns of ``docs`` without ``text``, then ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers), ``parity`` (both libraries gave the same ids; null without ``verify``),
    ``decoded_ok`` (decoding gives the text, a mark character standing for a space) and, with
    ``with_ids``, ``ids``. These replace input columns of the same name. A null or empty text has no
    ids. Rows keep their other columns whatever they hold; an empty table gives an empty result.
    """
    made = ["n_tokens", "ids_crc32", "parity", "decoded_ok"] + (["ids"] if with_ids else [])
    kept = [c for c in docs.columns if c.lower() not in ("text", *made)]
    schema = ", ".join(["n_tokens long", "ids_crc32 long", "parity boolean", "decoded_ok boolean"]
                       + (["ids array<int>"] if with_ids else []))

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from vantage.llm.sentencepiece_bpe import worker_codec
        from vantage.llm.unit_cache import text_slices

        codec = worker_codec(model_path, threads, verify)
        for part in text_slices(batches, "text", _SLICE):
            texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
            ids, counts, agreed = codec.encode(texts)
            ends = np.concatenate(([0], np.cumsum(counts)))
            own = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
            same = [codec.decode(x) == t.replace(MARK, " ") for x, t in zip(own, texts)]
            columns = [pa.array(counts), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
                       pa.array(agreed) if verify else pa.nulls(len(agreed), pa.bool_()), pa.array(same, pa.bool_())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + columns, kept + made)
        release()

    ship(docs.sparkSession)
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text"))
    fields = source.drop("text").schema.fields + StructType.fromDDL(schema).fields
    return source.mapInArrow(encode, StructType(fields))
