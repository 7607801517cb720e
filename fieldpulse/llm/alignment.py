"""Tokens of two tokenizers over the same text, aligned by their bytes.

``space + text`` is encoded by A, a byte-level BPE, and ``text`` by B, a piece model that puts the
space in front itself. Both tile the same bytes, so with A and B as incidence matrices (tokens by
bytes, in compressed rows) the entries of A·Bᵀ are the bytes that a pair of tokens shares: its
links. Byte offsets where tokens of both end cut the tokens into groups; the product of the two
group incidence matrices holds the pairs that share a group.

Neither tokenizer joins what stands left and right of a blank or a line feed after a visible
character, so texts are cut there into units, each distinct unit of a chunk of texts is encoded and
multiplied once while in memory, and the matrices of a text are the blocks of its units.

1. A task takes chunks of about ``CHUNK`` bytes of text. A chunk becomes one row: its documents'
   counts and digests, their units by number, the matrix of units by pairs of ids, and how often
   the chunk has each pair.
2. Spark adds up the pairs of all chunks, finds the highest count of each B id and hands each
   chunk the counts of its own pairs.
3. The matrix of a chunk times these counts gives sums by unit, and sums over units by document.

Rows. Texts that are null, empty, not valid UTF-8 or whose bytes the tokens do not give back
(U+2581 in the text, which the piece model reads as a blank) have no tokens. A text longer than a
chunk makes a chunk of its own, so memory follows the longest text. Repeated rows and rows with a
null id are rows of their own. An empty table gives no rows. Other columns are not looked at.
Strings of special tokens are plain text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.csr import Csr
from fieldpulse.llm.sentence_pieces import BYTE, PieceModel, model
from fieldpulse.llm.tables import matched, pieces, table, written

CHUNK = 1 << 20
KEPT_UNITS, KEPT_BYTES = 200_000, 1 << 23
TOGETHER = 1 << 17

_DOCUMENTS = "doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_shared array<long>, digests array<string>"
_CHUNK = f"chunk long, {_DOCUMENTS}, sizes array<int>, units binary, starts binary, columns binary, amounts binary, a array<int>, b array<int>, times array<long>"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"


def _byte_letters() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: a byte's own character, or for bytes without
    one the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Units:
    """What is known of units of text, by their number."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.bytes = self.size = 0
        self._groups: list[tuple[np.ndarray, np.ndarray]] = []  # bytes of all units' groups; where each unit's start and end
        self._counts: list[np.ndarray] = []  # n_a, n_b, n_groups, n_shared by unit
        self._links: list[Csr] = []  # units by pairs (a << 32 | b)

    def add(self, names: list[str], groups: tuple[np.ndarray, np.ndarray], counts: np.ndarray, links: Csr) -> None:
        first = self.size
        self.number.update(zip(names, range(first, first + len(names)), strict=True))
        self.bytes += sum(map(len, names))
        self.size += len(names)
        self._groups.append(groups)
        self._counts.append(counts)
        self._links.append(Csr(links.starts, links.columns, links.values.astype(np.int32), links.width))

    @property
    def counts(self) -> np.ndarray:
        if len(self._counts) > 1:
            self._counts = [np.concatenate(self._counts)]
        return self._counts[0]

    @property
    def groups(self) -> np.ndarray:
        """How many bytes each unit's groups take."""
        return np.concatenate([np.diff(edges) for _, edges in self._groups]) if self._groups else np.empty(0, np.int64)

    def digest(self, units: np.ndarray) -> str:
        """Digest of the groups of these units, one after the other."""
        if len(self._groups) > 1:
            before = np.cumsum([0, *(edges[-1] for _, edges in self._groups)])
            edges = [e[:-1] + b for (_, e), b in zip(self._groups, before, strict=False)]
            self._groups = [(np.concatenate([t for t, _ in self._groups]), np.concatenate((*edges, before[-1:])))]
        text, edges = self._groups[0]
        found = sha256()
        for i in range(0, len(units), TOGETHER):
            own = units[i : i + TOGETHER]
            sizes = edges[own + 1] - edges[own]
            ends = np.cumsum(sizes)
            part = text[np.repeat(edges[own] - ends + sizes, sizes) + np.arange(ends[-1])]
            found.update(part if i + TOGETHER < len(units) else part[:-1])  # no semicolon at the end
        return found.hexdigest()

    @property
    def links(self) -> Csr:
        if len(self._links) > 1:
            edges = np.cumsum([0, *(x.starts[-1] for x in self._links)])
            starts = [x.starts[:-1] + e for x, e in zip(self._links, edges, strict=False)]
            columns, values = (np.concatenate([getattr(x, k) for x in self._links]) for k in ("columns", "values"))
            self._links = [Csr(np.concatenate((*starts, edges[-1:])), columns, values, 1 << 62)]
        return self._links[0]


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import sentencepiece
        from tokenizers import Tokenizer

        self.bytewise = Tokenizer.from_file(byte_path)
        self.bytewise.encode_special_tokens = True
        self.pieces: PieceModel = model(piece_path)
        own = self.pieces
        if own.map.units or own.squeeze or not own.prefix or not own.splits:
            raise ValueError("needs a piece model that only puts a space in front")
        letters = _byte_letters()
        vocabulary = self.bytewise.get_vocab()
        # Only characters of the byte alphabet stand for bytes; special tokens never come up.
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            if all(c in letters for c in name):
                self.a_bytes[i] = bytes(letters[c] for c in name)
        self.b_bytes = list(own.surfaces)
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Ids as they stand in a digest, inside a group's side and at the end of A's and of B's.
        shown = np.arange(max(len(self.a_bytes), len(self.b_bytes))).astype(bytes)
        shown = shown.astype(f"S{len(str(len(shown)))}")
        self.inside, self.last_a, self.last_b = (np.char.add(shown, mark) for mark in (b",", b"|", b";"))
        # A line feed only cuts where no piece and no run of the other tokenizer holds one inside.
        feed = not any("\n" in t for t, k in zip(own.texts, own.kinds, strict=True) if k != BYTE)
        self.cuts = " \n" if feed else " "
        self.unit = re.compile(f"(?s).(?:[^{self.cuts}]+|(?<=\\s)[{self.cuts}])*")
        self.library = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.units = Units()

    def learn(self, names: list[str]) -> None:
        """Encodes new units and multiplies their incidence matrices, many at a time."""
        start = size = 0
        for i, name in enumerate(names):
            size += len(name)
            if size > TOGETHER:
                self._learn(names[start : i + 1])
                start, size = i + 1, 0
        if start < len(names):
            self._learn(names[start:])

    def _in_a_row(self, names: list[str]) -> tuple | None:
        """(ids of A, ids of B, tokens of A and B by unit) of units that follow each other in one
        text, or None where the units' edges are not the tokens'."""
        whole = "".join(names)
        given = whole.encode()
        edges = np.cumsum([len(n.encode()) for n in names])
        found = []
        a = self.bytewise.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        for ids, known, sizes in (
            (a, self.a_bytes, self.a_sizes),
            (self.library.encode(whole[1:]), self.b_bytes, self.b_sizes),
        ):
            if b"".join(map(known.__getitem__, ids)) != given:
                return None
            ids = np.array(ids, np.int64)
            ends = np.cumsum(sizes[ids])
            last = np.searchsorted(ends, edges)
            if (ends[last] != edges).any():
                return None
            found.append((ids, np.diff(last, prepend=-1)))
        (a, n_a), (b, n_b) = found
        return a, b, n_a, n_b, np.ones(len(names), bool)

    def _one_by_one(self, names: list[str]) -> tuple:
        a_ids = [e.ids for e in self.bytewise.encode_batch_fast(names, add_special_tokens=False)]
        merged, space = self.pieces._merged, self.pieces.space
        b_ids = [
            np.frombuffer(b"".join(map(merged, self.pieces.units.findall(n.replace(" ", space)))), np.int32).tolist()
            for n in names
        ]
        fits = np.ones(len(names), bool)
        for i, name in enumerate(names):
            given = name.encode()
            for ids, known in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)):
                fits[i] &= b"".join(map(known.__getitem__, ids[i])) == given
            if not fits[i]:
                a_ids[i] = b_ids[i] = []
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.array([x for own in ids for x in own], np.int64) for ids in (a_ids, b_ids))
        return a, b, n_a, n_b, fits

    def _learn(self, names: list[str]) -> None:
        """Units that may stand in a row are encoded as one text."""
        space = self.pieces.space
        row = [n for n in names if n[0] in self.cuts and not n[-1].isspace() and space not in n]
        if row and (row[0][0] == " " or (row := sorted(row, key=lambda n: n[0] != " "))[0][0] == " "):
            done = self._in_a_row(row)
            if done:
                self._multiply(row, *done)
                names = sorted(set(names) - set(row))
        if names:
            self._multiply(names, *self._one_by_one(names))

    def _multiply(self, names: list[str], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, fits: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(names)), n_a)
        # Tokens by bytes; the units' bytes follow each other.
        in_a, in_b = Csr.tiles(self.a_sizes[a]), Csr.tiles(self.b_sizes[b])
        shared = in_a.times(in_b.transposed())
        links = self._by_unit(owner[shared.rows()], a[shared.rows()] << 32 | b[shared.columns], len(names))
        # Tokens by groups: a group ends where a token of each side ends.
        ends = np.intersect1d(in_a.starts[1:], in_b.starts[1:], assume_unique=True)
        group_a, group_b = (np.searchsorted(ends, x.starts[1:]) for x in (in_a, in_b))
        to_group = [Csr.of(g, np.arange(len(g)), np.ones(len(g), np.int64), (len(ends), len(g))) for g in (group_a, group_b)]
        together = to_group[0].transposed().times(to_group[1])
        n_shared = np.bincount(owner[together.rows()], minlength=len(names))
        first_a = np.searchsorted(group_a, np.arange(len(ends)))  # each group has tokens of both
        first_b = np.searchsorted(group_b, np.arange(len(ends)))
        n_groups = np.bincount(owner[first_a], minlength=len(names)) if len(ends) else np.zeros(len(names), np.int64)
        groups = self._shown(a, b, group_a, group_b, first_a, first_b, n_a + n_b)
        counts = np.stack([n_a, n_b, n_groups, n_shared], axis=1).astype(np.int32)
        counts[~fits] = -1
        self.units.add(names, groups, counts, links)

    def _shown(self, a, b, group_a, group_b, first_a, first_b, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all groups, each with a semicolon behind it, and where each unit's start and end;
        ``sizes`` are the units' tokens."""
        ids = np.empty(len(a) + len(b), self.inside.dtype)
        # Before a token stand those of its side and, of the other side, the groups before it.
        place_a = np.arange(len(a)) + first_b[group_a]
        place_b = np.arange(len(b)) + np.append(first_a[1:], len(a))[group_b]
        ids[place_a] = np.where(np.diff(group_a, append=-1) != 0, self.last_a[a], self.inside[a])
        ids[place_b] = np.where(np.diff(group_b, append=-1) != 0, self.last_b[b], self.inside[b])
        text = ids.view(np.uint8).reshape(len(ids), ids.itemsize)
        filled = text != 0
        edges = np.concatenate(([0], np.cumsum(filled.sum(axis=1))))
        return text[filled], edges[np.concatenate(([0], np.cumsum(sizes)))]

    @staticmethod
    def _by_unit(units: np.ndarray, pairs: np.ndarray, n: int) -> Csr:
        """Units by pairs of ids, with the number of links."""
        names, place = np.unique(pairs, return_inverse=True)
        found = Csr.of(units, place, np.ones(len(units), np.int64), (n, max(len(names), 1)))
        return Csr(found.starts, names[found.columns], found.values, 1 << 62)

    def split(self, text: str | None) -> list[str]:
        return self.unit.findall(" " + text) if text else []

    def chunk(self, texts: list[str | None]) -> dict:
        """The columns of ``_CHUNK`` for these texts, but for the number and the ids."""
        if self.units.size > KEPT_UNITS or self.units.bytes > KEPT_BYTES:
            self.units = Units()
        split = list(map(self.split, texts))
        flat = [u for own in split for u in own]
        new = set(flat) - self.units.number.keys()
        if new or not self.units.size:
            self.learn(sorted(new) or [" "])
        known = np.array(list(map(self.units.number.__getitem__, flat)), np.int64)
        sizes = np.array([len(own) for own in split], np.int64)
        counts = self.units.counts[known]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        bad = _sums((counts[:, :1] < 0).astype(np.int64), edges)[:, 0] > 0
        if bad.any():
            keep = np.repeat(~bad, sizes)
            known, counts = known[keep], counts[keep]
            sizes[bad] = 0
            edges = np.concatenate(([0], np.cumsum(sizes)))
        total = _sums(counts, edges)
        cuts = edges.tolist()
        digests = [self.units.digest(known[p:q]) if q > p else "" for p, q in zip(cuts, cuts[1:], strict=False)]
        used = np.flatnonzero(np.bincount(known, minlength=1))
        local = np.zeros(self.units.size, np.int64)
        local[used] = np.arange(len(used))
        units = local[known]
        matrix = self.units.links.picked(used)
        pairs, columns = np.unique(matrix.columns, return_inverse=True)
        often = np.bincount(units, minlength=len(used))
        times = np.bincount(columns, matrix.values * often[matrix.rows()], len(pairs)).astype(np.int64)
        by_unit = np.bincount(matrix.rows(), matrix.values, len(used)).astype(np.int64)
        n_links = _sums(by_unit[units][:, None], edges)[:, 0]
        return {
            "n_a": total[:, 0], "n_b": total[:, 1], "n_groups": total[:, 2], "n_links": n_links,
            "n_shared": total[:, 3], "digests": digests, "sizes": sizes.astype(np.int32),
            "units": _narrow(units), "starts": _narrow(np.diff(matrix.starts)),
            "columns": _narrow(columns), "amounts": _narrow(matrix.values),
            "a": (pairs >> 32).astype(np.int32), "b": (pairs & 0xFFFFFFFF).astype(np.int32), "times": times,
        }


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs, after their size."""
    size = next(s for s in (1, 2, 4, 8) if values.max(initial=0) < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _sums(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the rows between the edges."""
    running = np.concatenate((np.zeros((1, rows.shape[1]), np.int64), np.cumsum(rows, axis=0, dtype=np.int64)))
    return running[edges[1:]] - running[edges[:-1]]


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def _text(value: bytes | None) -> str | None:
    """A text as it is, or None where it is not UTF-8."""
    try:
        return None if value is None else value.decode()
    except UnicodeDecodeError:
        return None


def _chunked(byte_path: str, piece_path: str, size: int):
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "n_shared": pa.int64(),
             "digests": pa.string(), "sizes": pa.int32(), "a": pa.int32(), "b": pa.int32(), "times": pa.int64()}

    def run(batches):
        own = aligner(byte_path, piece_path)
        first = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list = []
        total = number = 0

        def row():
            found = own.chunk(texts)
            columns = [pa.array([first + number], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            for name, value in found.items():
                columns.append(pa.array([value], pa.list_(kinds[name]) if name in kinds else pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", *found])

        for batch in batches:
            for part in pieces([batch], size):
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if texts and total + len(text or b"") > size:
                        yield row()
                        ids, texts, total, number = [], [], 0, number + 1
                    ids.append(i)
                    texts.append(_text(text))
                    total += len(text or b"")
        if texts:
            yield row()

    return run


def _scored(batches):
    """Chunks with the counts of their pairs: a row per document."""
    aligner.cache_clear()  # a worker that cut chunks before needs its units no more
    model.cache_clear()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i] for k in batch.schema.names}
            ids = row["doc_ids"].values
            array = lambda k, row=row: row[k].values.to_numpy(zero_copy_only=False)
            packed = lambda k, row=row: _wide(row[k].as_py())
            sizes = array("sizes").astype(np.int64)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            counts = np.zeros((0, 2), np.int64)
            if row["found"].is_valid:  # a chunk without tokens has no pairs
                found = row["found"].values
                counts = np.zeros((len(found), 2), np.int64)
                place, count, best = (found.field(k).to_numpy(zero_copy_only=False) for k in ("place", "count", "best"))
                counts[place] = np.stack([count, best.astype(np.int64)], axis=1)
            starts = np.concatenate(([0], np.cumsum(packed("starts"))))
            matrix = Csr(starts, packed("columns"), packed("amounts"), len(counts))
            # Unit by unit, whole numbers: running sums over the entries of the matrix.
            by_unit = _sums(matrix.values[:, None] * counts[matrix.columns], matrix.starts)
            total = _sums(by_unit[packed("units")], edges)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(row[k].values for k in ("n_a", "n_b", "n_groups", "n_links")),
                    pa.array(total[:, 1]),
                    pa.array(total[:, 0]),
                    row["digests"].values,
                    row["n_shared"].values,
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"],
            )


def chunks(
    docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", id_column: str = "doc_id", size: int = CHUNK
) -> DataFrame:
    """The table of step 1, written."""
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return written(plain.mapInArrow(_chunked(byte_path, piece_path, size), _CHUNK), "chunks")


def pair_counts(chunked: DataFrame) -> DataFrame:
    """(a, b, count, best, chunks): links of each pair of ids in all texts, whether no other A id
    has more with this B id, and the number of chunks that have the pair."""
    pairs = chunked.select(F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("times").alias("count"), F.count("*").alias("chunks"))
    counts = written(counts, "pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # no more rows than B has ids
    found = counts.join(highest, "b")
    return found.select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"), "chunks")


def aligned(
    docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", id_column: str = "doc_id", size: int = CHUNK
) -> DataFrame:
    """One row per row of ``docs``, as ``_RESULT`` names them."""
    chunked = chunks(docs, byte_path, piece_path, text, id_column, size)
    counts = written(
        pair_counts(chunked).select(F.struct("a", "b").alias("pair"), "count", "best", "chunks"), "pair-counts"
    )
    asked = chunked.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("place", "pair"))
    asked = asked.select("chunk", "place", F.struct(F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).alias("pair"))
    told = matched(asked, counts, "pair", "chunks").groupBy("chunk")
    told = told.agg(F.collect_list(F.struct("place", "count", "best")).alias("found"))  # a chunk's pairs
    rows = chunked.drop("a", "b", "times").join(told, "chunk", "left")
    return rows.mapInArrow(_scored, _RESULT)


def op11_token_alignment(
    spark: SparkSession, sf_dir: str, byte_path: str | None = None, piece_path: str | None = None
) -> DataFrame:
    if byte_path is None or piece_path is None:
        import public_tokenizers

        byte_path = byte_path or public_tokenizers.path("byte_bpe_50k.json")
        piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")
    return aligned(table(spark, sf_dir, "documents"), byte_path, piece_path)
