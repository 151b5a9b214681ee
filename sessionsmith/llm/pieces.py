"""SentencePiece encoding with source alignment, and decoding.

A text is normalised by the model's own rules: at each position the longest key of the compiled character map is replaced,
white space is escaped, and every byte of the normalised text remembers the byte range of the source that it came from.
The normalised text is then cut into pieces, and each piece is projected back to a byte span of the source.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_batches

MARK = "▁"
MARK_UTF8 = MARK.encode()


class CharacterMap:
    """The compiled character map of a model: a double-array trie over UTF-8 keys, then zero-terminated replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.values = blob[4 + size :]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that ``text`` has at ``at``, and its replacement."""
        units, found = self.units, None
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.values[start : self.values.index(b"\0", start)]


def char_length(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Aligner:
    """Normalisation that records where each normalised byte comes from."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.map, self.dummy_prefix, self.squeeze = CharacterMap(charsmap), dummy_prefix, squeeze
        self.space = MARK_UTF8 if escape else b" "

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The normalised text, and for each of its bytes the start and the end of its source range."""
        if not self.map and not self.squeeze:
            return self._plain(raw)
        out: list[bytes] = []
        start: list[int] = []
        end: list[int] = []

        def put(piece: bytes, a: int, b: int) -> None:
            out.append(piece)
            start.extend([a] * len(piece))
            end.extend([b] * len(piece))

        parts, at = [], 0
        while at < len(raw):
            hit = self.map.longest(raw, at) if self.map else None
            n, to = hit or (char_length(raw[at]), raw[at : at + char_length(raw[at])])
            parts.append((to, at, at + n))
            at += n
        if self.squeeze:  # spaces at either end go, runs become one
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
            while parts and not parts[-1][0].strip(b" "):
                parts.pop()
        if parts and self.dummy_prefix:
            put(self.space, parts[0][1], parts[0][1])
        spaced = self.squeeze and bool(parts)
        for k, (to, a, b) in enumerate(parts):
            if self.squeeze:
                if spaced:
                    to = to.lstrip(b" ")
                if k == len(parts) - 1:
                    to = to.rstrip(b" ")
                if to:
                    spaced = to.endswith(b" ")
            put(to.replace(b" ", self.space), a, b)
        return b"".join(out), np.array(start, np.int64), np.array(end, np.int64)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """No map and no squeezing: only the prefix and the escaped spaces change lengths."""
        head = bool(self.dummy_prefix and raw)
        text = (self.space if head else b"") + raw.replace(b" ", self.space)
        width = np.where(np.frombuffer(raw, np.uint8) == 32, len(self.space), 1)
        at = np.arange(len(raw), dtype=np.int64)
        start, end = np.repeat(at, width), np.repeat(at + 1, width)
        if head:
            zero = np.zeros(len(self.space), np.int64)
            start, end = np.concatenate([zero, start]), np.concatenate([zero, end])
        return text, start, end


class Encoder:
    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto.FromString(model)
        rules = proto.normalizer_spec
        self.align = Aligner(rules.precompiled_charsmap, rules.add_dummy_prefix and not proto.trainer_spec.treat_whitespace_as_suffix, rules.remove_extra_whitespaces, rules.escape_whitespaces)
        self.full = sentencepiece.SentencePieceProcessor(model_proto=model)
        # the same vocabulary for text that is normalised already
        rules.name, rules.precompiled_charsmap = "identity", b""
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = rules.escape_whitespaces = False
        self.cut = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.end, self.unknown = self.full.eos_id(), self.full.unk_id()
        self.width = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.decimal = [b"%d " % i for i in range(len(proto.pieces))]

    def ids(self, normal: bytes) -> tuple[np.ndarray, bytes]:
        """Ids without the end id, and in decimal, each followed by a space."""
        ids = self.cut.encode(normal.decode())
        return np.array(ids, "<i4"), b"".join([self.decimal[i] for i in ids])

    def spans(self, normal: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The normalised bytes of every piece. A byte piece has its own byte."""
        if self.unknown in ids:  # no byte pieces: an unknown piece can be of any width
            from sentencepiece import sentencepiece_pb2 as pb

            got = pb.SentencePieceText.FromString(self.cut.encode(normal.decode(), out_type="serialized_proto"))
            return np.array([p.begin for p in got.pieces], np.int64), np.array([p.end for p in got.pieces], np.int64)
        stop = np.cumsum(self.width[ids])
        return stop - self.width[ids], stop

    def encode(self, raw: bytes) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
        """Ids (without the end id), the same in decimal, and the source bytes [start, stop) of each piece."""
        normal, source_start, source_end = self.align(raw)
        ids, decimal = self.ids(normal)
        if not len(ids):
            return ids, decimal, np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin, stop = self.spans(normal, ids)
        return ids, decimal, source_start[begin], np.maximum(source_end[stop - 1], source_start[begin])


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def encode_documents(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``ids`` (end id included), ``starts`` and ``stops`` (byte span in the UTF-8 source of each piece; the end id has an empty one at the end) and ``decoded``.

    A null text counts as empty: the end id alone. Repeated rows, null keys and very long texts are encoded row by row like
    any other; columns other than ``key`` and ``text`` are not read. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(model)
        for batch in batches:
            for k, raw in enumerate(_texts(batch.column(1))):
                ids, _, starts, stops = coder.encode(raw)
                ids = np.append(ids, coder.end).astype(np.int32)
                one = [batch.column(0).slice(k, 1)]
                one += [pa.array([v], pa.list_(t)) for v, t in ((ids, pa.int32()), (np.append(starts, len(raw)), pa.int64()), (np.append(stops, len(raw)), pa.int64()))]
                yield pa.record_batch([*one, pa.array([coder.full.decode(ids.tolist())])], names=[key, "ids", "starts", "stops", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return in_batches(docs.select(key, text), run, f"`{key}` {kind}, ids array<int>, starts array<bigint>, stops array<bigint>, decoded string")


def encoding_digests(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same encoding, with digests in place of the arrays: number of ids, SHA-256 of the decimal ids and of the decoded text, bytes that the spans cover and how many pieces have a non-empty span.

    Nulls, repeats and empty tables as in ``encode_documents``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(model)
        tail, last = [coder.end], b"%d" % coder.end
        for batch in batches:
            rows = []
            for raw in _texts(batch.column(1)):
                ids, decimal, starts, stops = coder.encode(raw)
                text = coder.full.decode(ids.tolist() + tail)
                rows.append((len(ids) + 1, hashlib.sha256(decimal + last).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), int((stops - starts).sum()), int(np.count_nonzero(stops > starts))))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes", "span_pieces"])

    kind = docs.schema[key].dataType.simpleString()
    return in_batches(docs.select(key, text), run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint, span_pieces bigint")
