"""SentencePiece encoding and decoding with source offsets.

A text is normalised by the longest prefixes that the model's compiled character map knows,
and every normalised byte keeps the place of the source bytes it came from. The normalised text
is cut where no piece can reach across, each cut-out unit is merged by piece scores, and every
piece is projected to its span of source bytes.

Covered are BPE models with byte fallback; the vocabulary file is a parameter.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.memo import Memo
from fieldpulse.llm.tables import pieces, table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECE = 1 << 20
DECODED = 1 << 18  # ids decoded together
SEGMENT = 1 << 20
_NEVER = float("-inf")  # the score of a pair that makes no piece
_EACH = "fieldpulse-each-byte"

codecs.register_error(_EACH, lambda bad: ("\ufffd", bad.start + 1))


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint():
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
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class CharacterMap:
    """The compiled character map: a double-array trie of prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]
        self.first = {b for b in range(256) if self._child(self._base(), b) is not None}

    def _base(self) -> int:
        return self._offset(self.units[0]) if self.units else 0

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _child(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        if at < len(self.units) and self.units[at] & 0x800000FF == byte:
            return at
        return None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, matched bytes) of the longest known prefix of ``data[at:]``."""
        base, found = self._base(), None
        for end in range(at, len(data)):
            node = self._child(base, data[end])
            if node is None:
                break
            unit = self.units[node]
            base = node ^ self._offset(unit)
            if unit >> 8 & 1:
                found = (self.units[base] & 0x7FFFFFFF, end + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.replacements[start : self.replacements.index(b"\0", start)], found[1]


class PieceModel:
    def __init__(self, model: bytes):
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.texts: list[str] = []
        self.kinds: list[int] = []
        trainer: dict[int, object] = {}
        spec: dict[int, object] = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                if kind in (NORMAL, USER):
                    self.ids[text] = len(self.texts)
                    self.scores[text] = struct.unpack("<f", piece.get(2, b"\0" * 4))[0]
                self.texts.append(text)
                self.kinds.append(kind)
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or {USER, UNUSED} & set(self.kinds):
            raise ValueError("needs a BPE model with byte fallback and no user-defined or unused pieces")
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix = bool(spec.get(3, 1)) and not trainer.get(24)
        self.squeeze = bool(spec.get(4, 1))
        self.space = SPACE if spec.get(5, 1) else " "
        bytes_of = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == BYTE}
        self.byte_ids = [bytes_of[f"<0x{b:02X}>"] for b in range(256)]
        joins = any(self.space in t.lstrip(self.space) for t in self.ids)
        s = re.escape(self.space)
        self.units = re.compile("(?s).+" if joins else f"{s}*[^{s}]+|{s}+")
        self.splits = not joins
        self.memo = Memo(self._merged)
        self.sizes = np.array([1 if k == BYTE else len(t.encode()) for t, k in zip(self.texts, self.kinds, strict=True)])
        surface = {CONTROL: lambda t: "", UNKNOWN: lambda t: " ⁇ "}
        plain = lambda t: t.replace(SPACE, " ")
        self.surfaces = [surface.get(k, plain)(t).encode() for t, k in zip(self.texts, self.kinds, strict=True)]
        for b, i in enumerate(self.byte_ids):
            self.surfaces[i] = bytes([b])

    # ---- normalisation

    def normalised(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the source offset."""
        space = self.space.encode()
        if not self.map.units and not self.squeeze:
            body = data.replace(b" ", space)
            source = np.frombuffer(data, np.uint8)
            origin = np.repeat(np.arange(len(data)), np.where(source == 32, len(space), 1))
            lead = space if self.prefix and data else b""
            origin = np.concatenate((np.zeros(len(lead), np.int64), origin, [len(data)]))
            return lead + body, origin
        out, origin = bytearray(), []
        at, end = 0, len(data)

        def step(i: int) -> tuple[bytes, int]:
            if data[i] in self.map.first and (hit := self.map.longest(data, i)):
                return hit
            size = 1 if data[i] < 0xC0 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
            return data[i : i + size], size

        if self.squeeze:
            while at < end and step(at)[0] == b" ":
                at += step(at)[1]
        if self.prefix and at < end:
            out += space
            origin += [at] * len(space)
        spaced = self.squeeze
        while at < end:
            part, size = step(at)
            while spaced and part.startswith(b" "):
                part = part[1:]
            if part:
                done = part.replace(b" ", space)
                out += done
                origin += [at] * len(done)
                spaced = self.squeeze and part.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                end = origin[-len(space)]
                del origin[-len(space) :]
        return bytes(out), np.array([*origin, end], np.int64)

    # ---- encoding

    def _merged(self, unit: str) -> bytes:
        """Ids of a unit as packed 32-bit numbers: best score first, then leftmost."""
        parts, get = list(unit), self.scores.get
        if len(parts) <= 48:
            found = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            while found and (best := max(found)) > _NEVER:
                i = found.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del found[i]
                if i < len(found):
                    found[i] = get(parts[i] + parts[i + 1], _NEVER)
                if i:
                    found[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
        else:
            parts = self._merged_long(parts)
        ids: list[int] = []
        for part in parts:
            known = self.ids.get(part)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.byte_ids[b] for b in part.encode())
        return struct.pack(f"<{len(ids)}i", *ids)

    def _merged_long(self, parts: list[str]) -> list[str]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                score = self.scores.get(both := parts[i] + parts[j])
                if score is not None:
                    heapq.heappush(heap, (-score, i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p]

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends) of a text; spans are source bytes and follow each other."""
        body, origin = self.normalised(data)
        text = body.decode("utf-8", "replace")
        found, start = [], 0
        while start < len(text):
            stop = len(text)
            if self.splits and stop - start > SEGMENT:  # before a run of spaces
                cut = text.find(self.space, start + SEGMENT)
                while cut > 0 and text[cut - 1] == self.space:
                    cut = text.find(self.space, cut + 1)
                stop = cut if cut > 0 else stop
            part = text[start:stop]
            found.append(b"".join(map(self.memo.__getitem__, self.units.findall(part))))
            start = stop
        ids = np.frombuffer(b"".join(found), np.int32)
        edges = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        places = origin[edges]
        return ids, places[:-1], places[1:]

    # ---- decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids; bytes that form no character become U+FFFD each."""
        order = ids.tolist()
        parts = list(map(self.surfaces.__getitem__, order))
        i = 0
        while i < len(order) and self.kinds[order[i]] == CONTROL:
            i += 1
        if i < len(order) and self.kinds[order[i]] == NORMAL and (self.prefix or self.squeeze):
            if self.squeeze:
                while i < len(order) and self.kinds[order[i]] in (NORMAL, CONTROL):
                    parts[i] = parts[i].lstrip(b" ")
                    if parts[i]:
                        break
                    i += 1
            elif parts[i].startswith(b" "):
                parts[i] = parts[i][1:]
        return b"".join(parts).decode("utf-8", _EACH)


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return PieceModel(file.read())


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    edges = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values).cast(kind))


def encoded(
    docs: DataFrame, model_path: str, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One row per row: doc_id, ids, starts, ends (spans of UTF-8 bytes of the source).

    A null or empty text has no ids. The model file must lie at ``model_path`` on each executor.
    """

    def run(batches):
        own = model(model_path)
        for batch in pieces(batches, PIECE):
            done = [own.encode(t.as_py() or b"") for t in batch.column(1)]
            ids, starts, ends = (list(x) for x in zip(*done, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(ids, pa.int32()), _lists(starts, pa.int64()), _lists(ends, pa.int64())],
                names=["doc_id", "ids", "starts", "ends"],
            )

    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return plain.mapInArrow(run, "doc_id long, ids array<int>, starts array<long>, ends array<long>")


def decoded(tokens: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with the texts of its ids in the column ``decoded``; null ids give an empty text."""
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    at = tokens.columns.index(ids)

    def run(batches):
        own = model(model_path)
        for batch in pieces(batches, DECODED, at):
            rows = batch.column(at)
            texts = [
                own.decode(row.values.to_numpy(zero_copy_only=False)) if row.is_valid else "" for row in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return tokens.mapInArrow(run, schema)


def op1_sentence_pieces(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Digests of ids and decoded texts; ``spans_tile``: the spans cover the source in order."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    tokens = encoded(table(spark, sf_dir, "documents"), model_path)
    tokens = tokens.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("source_bytes"),
        (F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))) == F.slice("starts", 2, F.size("starts"))).alias(
            "spans_tile"
        ),
    )
    return decoded(tokens, model_path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "source_bytes", "spans_tile"
    )
