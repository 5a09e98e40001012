"""Offset-preserving SentencePiece encoding.

Texts are normalised by the model's compiled character map: at every position the longest key of the map's double-array
trie is replaced, and each output byte records the source byte that it came from. The normalised text is cut into segments
that no piece reaches across (spaces and the word behind them), and each segment's characters are merged, best piece
first; what no piece covers becomes byte pieces. A piece covers a run of normalised bytes, so its span in the original
text follows from the recorded alignment. Segments recur, so their ids are remembered within a task. The tests hold the
ids against the sentencepiece library, which does the decoding. Models of another kind (no merges, no byte pieces, pieces
across words, pieces defined by the user) are encoded by the library, and their spans come from the widths of its pieces.

A null text is an empty text. Texts are encoded whole, however long. Ids and spans belong to one row each, so ties and
repeated rows need no rule; no rows give no rows. A text whose pieces don't cover its normalised bytes, which no model we
know brings about, has null spans and keeps its ids. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ionloom.llm.common import bounded_batches, chunks

_SPACE = "▁".encode()  # stands for a space in pieces
_SEGMENT = re.compile("▁*[^▁]+|▁+")
#: Segments whose ids a task remembers; it forgets all when there are more, and longer ones at once.
REMEMBERED, REMEMBERED_CHARS = 1 << 19, 64
#: Characters of a segment up to which no queue is kept.
SHORT_CHARS = 48


class Normaliser:
    """The model's normaliser with source alignment, as its specification in the model file describes it."""

    def __init__(self, spec) -> None:
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        blob = spec.precompiled_charsmap
        self.units: tuple[int, ...] = ()
        self.values = b""
        if blob:  # little-endian length of the trie, its units, then zero-ended replacements
            (size,) = struct.unpack_from("<I", blob)
            self.units, self.values = struct.unpack_from(f"<{size // 4}I", blob, 4), bytes(blob[4 + size :])

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key of the map that starts at ``at``, and its replacement."""
        units, found = self.units, None
        offset = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node = offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.values[value : self.values.index(b"\0", value)]
        return found

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and for the end the source byte it came from."""
        if not self.units and not self.squeeze:
            return self._plain(text)
        out, source = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        gap, at = _SPACE if self.escape else b" ", 0
        parts = []
        while at < len(text):
            found = self.longest(text, at) if self.units else None
            if found is None:
                width = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                found = width, text[at : at + width]
            parts.append((at, found[1]))
            at += found[0]
        end = len(text)
        if self.squeeze:
            while parts and parts[0][1] in (b" ", b""):
                parts.pop(0)
        if not parts:
            return b"", np.array([0], np.int64)
        if self.dummy:
            put(gap, parts[0][0])
        spaced = self.squeeze
        for begin, piece in parts:
            if self.squeeze and spaced:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", gap), begin)
                spaced = self.squeeze and piece.endswith(b" ")
        if self.squeeze:
            while out.endswith(gap):
                del out[-len(gap) :]
                end = source[-1]
                del source[-len(gap) :]
        return bytes(out), np.array([*source, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map only spaces change: each becomes three bytes, and one more may lead the text."""
        raw = np.frombuffer(text, np.uint8)
        width = np.where(raw == 0x20, len(_SPACE), 1) if self.escape else np.ones(len(raw), np.int64)
        lead = (len(_SPACE) if self.escape else 1) if self.dummy and text else 0
        source = np.concatenate([np.zeros(lead, np.int64), np.repeat(np.arange(len(raw)), width), [len(raw)]])
        gap = _SPACE if self.escape else b" "
        return (gap if lead else b"") + (text.replace(b" ", gap) if self.escape else text), source


class Encoder:
    """One loaded model with the byte width of every piece in normalised text."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        self.normaliser = Normaliser(proto.normalizer_spec)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        none = (kinds.CONTROL, kinds.UNKNOWN)
        self.width = np.array([1 if p.type == kinds.BYTE else 0 if p.type in none else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = self.model.unk_id()
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.costs = {p.piece: -p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.bytes = [i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE]
        self.frame = [self.model.bos_id()], [self.model.eos_id()]
        odd = any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) or re.search("[^▁]▁", p.piece) for p in proto.pieces)
        self.merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE and len(self.bytes) == 256 and not odd and min(*self.frame[0], *self.frame[1]) >= 0
        self.known: dict[str, list[int]] = {}

    def segment(self, text: str) -> list[int]:
        """Ids of one segment: of all neighbours that make a piece, the best first, ties to the left."""
        parts = self._merged_long(text) if len(text) > SHORT_CHARS else self._merged(text)
        out: list[int] = []
        for piece in parts:
            found = self.pieces.get(piece)
            if found is None:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(found)
        return out

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short segment; the best neighbours are sought anew each time."""
        cost, never = self.costs.get, math.inf
        parts = list(text)
        costs = [cost(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while costs and (least := min(costs)) < never:
            i = costs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = cost(parts[i - 1] + parts[i], never)
            if i < len(costs):
                costs[i] = cost(parts[i] + parts[i + 1], never)
        return parts

    def _merged_long(self, text: str) -> list[str]:
        """The pieces of a long segment; the neighbours wait in a queue."""
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        part: list[str | None] = list(text)
        queue: list[tuple[float, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (cost := self.costs.get(part[i] + part[j])) is not None:
                heapq.heappush(queue, (cost, i, j, len(part[i]) + len(part[j])))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, size = heapq.heappop(queue)
            if part[i] is None or part[j] is None or right[i] != j or len(part[i]) + len(part[j]) != size:
                continue
            part[i], part[j] = part[i] + part[j], None
            right[i] = right[j]
            if right[i] < len(part):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [piece for piece in part if piece is not None]

    def ids(self, text: bytes, normal: bytes) -> list[int]:
        """Ids of a text with begin and end; ``normal`` is what the normaliser made of it."""
        if not self.merges:
            return self.model.encode(text.decode("utf-8", "replace"), add_bos=True, add_eos=True)
        out, known = list(self.frame[0]), self.known
        for part in _SEGMENT.findall(normal.decode("utf-8", "replace")):
            ids = known.get(part)
            if ids is None:
                ids = self.segment(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = ids
            out += ids
        return out + self.frame[1]

    def spans(self, text: bytes, ids: np.ndarray, normal: bytes, source: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Byte spans in ``text`` of the pieces ``ids``, begin and end ids included with empty spans."""
        width = self.width[ids]
        if not self.merges and (ids == self.unknown).any():  # unknown runs, whose width is in the library's answer
            pieces = self.model.encode(text.decode("utf-8", "replace"), return_type="proto").pieces
            width[1:-1] = [len(p.piece.encode()) for p in pieces]
        ends = np.cumsum(width)
        if ends.size and ends[-1] != len(normal):
            return None
        return source[ends - width], source[ends]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(path: str, arrays: tuple[str, ...], digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for start, stop, raw in chunks(batch, "text"):
                texts = [t or b"" for t in raw]
                normals = [coder.normaliser(t) for t in texts]
                lists = [coder.ids(t, normal) for t, (normal, _) in zip(texts, normals, strict=True)]
                decoded = coder.model.decode(lists, num_threads=1)
                ids = [np.array(x, np.int64) for x in lists]
                spans = [coder.spans(t, x, *normal) for t, x, normal in zip(texts, ids, normals, strict=True)]
                out = {
                    "doc_id": batch.column("doc_id").slice(start, stop - start),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "n_bytes_spanned": pa.array([int((s[1] - s[0]).sum()) if s else None for s in spans], pa.int64()),
                    "spans_sha256": pa.array([hashlib.sha256(b"".join(x.astype("<u8").tobytes() for x in s)).hexdigest() if s else None for s in spans], pa.string()),
                    "ids_le": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    "decoded": pa.array(decoded, pa.string()),
                }
                for name, values in (("ids", ids), ("begins", [s and s[0] for s in spans]), ("ends", [s and s[1] for s in spans])):
                    if name in arrays:
                        out[name] = pa.array(values, pa.list_(pa.int64()))
                if digests:  # the digests leave the task, not the bytes
                    out["ids_le"] = pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in out["ids_le"]], pa.string())
                    out["decoded"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())
                yield pa.record_batch(out)

    return run


def encode(df: DataFrame, model_path: str, digests: bool = False, with_ids: bool = False) -> DataFrame:
    """Encode every whole text with begin and end ids and decode it again.

    Returns doc_id, n_tokens, n_bytes_spanned (source bytes under all pieces), spans_sha256 (of all begins and then all
    ends as little-endian 64-bit integers), ids, begins and ends (byte spans in the original text, one for each id), ids_le
    (the ids as little-endian 32-bit integers) and decoded. With ``digests`` the last two are the SHA-256 of their bytes
    (ids_sha256, decoded_sha256) and the arrays stay out, but for the ids if ``with_ids``, so that nothing else that is
    long leaves the tasks. Executors read the model from ``model_path``.
    """
    bounded_batches(df.sparkSession)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    head = "doc_id long, n_tokens long, n_bytes_spanned long, spans_sha256 string"
    if digests:
        ids = ("ids",) if with_ids else ()
        out = docs.mapInArrow(_encode(model_path, ids, True), f"{head}, ids_le string, decoded string" + ", ids array<long>" * with_ids)
        return out.withColumnsRenamed({"ids_le": "ids_sha256", "decoded": "decoded_sha256"})
    return docs.mapInArrow(_encode(model_path, ("ids", "begins", "ends"), False), f"{head}, ids_le binary, decoded string, ids array<long>, begins array<long>, ends array<long>")
