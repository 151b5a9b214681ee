from __future__ import annotations

import hashlib
import struct

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from sessionsmith.llm import pieces  # noqa: E402
from sessionsmith.llm.queries import piece_model  # noqa: E402

ODD = [None, "", " ", "  ", "   ", " a", "a ", "a  b", "\n", "a\nb", "▁", "▁▁ a", "a▁b", "é́ ß", "日本語 テスト", "\u0000x", "😀 😀😀", "﻿a", "a b", "\t\t x", "<s> </s> <unk>", "<0x41>", "x" * 200_000]


@pytest.fixture(scope="module")
def model():
    return piece_model()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def texts(rng):
    return ODD + ["".join(rng.choice(" ab▁\n\té日😀<>0xs/") for _ in range(rng.randint(0, 40))) for _ in range(500)]


def test_as_the_library(spark, docs_of, model, library, rng):
    rows = list(enumerate(texts(rng))) + [(None, "no id"), (1, "again"), (1, "again")]
    digests = sorted((tuple(r)[:4] for r in pieces.encoding_digests(docs_of(rows, "doc_id bigint, text string"), model).collect()), key=str)
    want = []
    for k, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert digests == sorted(want, key=str)
    assert pieces.encoding_digests(spark.createDataFrame([], "doc_id bigint, text string"), model).collect() == []


def test_spans(docs_of, model, library, rng):
    """Spans follow each other, cover every byte, and show the piece's own characters."""
    rows = list(enumerate(texts(rng)))
    for r in pieces.encode_documents(docs_of(rows, "doc_id bigint, text string"), model).collect():
        raw = (rows[r.doc_id][1] or "").encode()
        assert r.ids == library.encode(raw.decode(), add_eos=True)
        assert (r.starts[-1], r.stops[-1]) == (len(raw), len(raw))
        assert r.starts[1:] == r.stops[:-1] and r.starts[0] == 0
        for i, a, b in zip(r.ids[:-1], r.starts, r.stops, strict=False):
            if not library.is_byte(i) and "▁" not in raw.decode():
                assert library.id_to_piece(i).replace("▁", " ").strip(" ") == raw[a:b].decode().strip(" ")


def darts(entries: dict[bytes, int]) -> list[int]:
    """A small double-array trie, in the layout of compiled character maps."""
    tree: dict = {}
    for key, value in entries.items():
        node = tree
        for c in key:
            node = node.setdefault(c, {})
        node[-1] = value
    units = [0] * 65_536
    free = [256]

    def place(node: dict, at: int, label: int) -> None:
        base = free[0]
        free[0] += 256
        offset = at ^ base
        units[at] = label | (256 if -1 in node else 0) | ((offset << 10) if offset < 1 << 21 else 0)
        if -1 in node:
            units[base] = node[-1] | 0x80000000
        for c, child in node.items():
            if c != -1:
                place(child, base ^ c, c)

    place(tree, 0, 0)
    return units


def compiled(rules: dict[str, str]) -> bytes:
    values, entries = b"", {}
    for key, to in rules.items():
        entries[key.encode()] = len(values)
        values += to.encode() + b"\0"
    units = darts(entries)
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + values


def test_longest_prefix_with_alignment():
    blob = compiled({"ﬁ": "fi", "a": "A", "ab": "X", "abc": "long ", "　": " ", "z": ""})
    align = pieces.Aligner(blob, dummy_prefix=True, squeeze=False, escape=True)
    raw = "abcabﬁ　za!".encode()
    normal, start, end = align(raw)
    assert normal.decode() == "▁long▁Xfi▁A!"
    back = [raw[a:b].decode() for a, b in dict.fromkeys(zip(start.tolist(), end.tolist(), strict=True))]
    assert back == ["", "abc", "ab", "ﬁ", "　", "a", "!"]
    squeezed = pieces.Aligner(blob, dummy_prefix=True, squeeze=True, escape=True)
    normal, start, end = squeezed("  a  　 b ".encode())
    assert normal.decode() == "▁A▁b" and len(start) == len(end) == len(normal)
    assert squeezed(b"")[0] == b"" and squeezed(b"   ")[0] == b""


def test_fast_alignment_is_the_general_one():
    plain = pieces.Aligner(b"", dummy_prefix=True, squeeze=False, escape=True)
    general = pieces.Aligner(compiled({"\u0001": "\u0001"}), dummy_prefix=True, squeeze=False, escape=True)
    for t in ODD:
        raw = (t or "").encode()[:5000]
        a, b = plain(raw), general(raw)
        assert a[0] == b[0]
        # within a character the plain one knows single bytes
        chars = np.array([c & 0xC0 != 0x80 for c in raw], bool)
        assert len(a[1]) == len(b[1]) and (not len(raw) or chars[np.minimum(b[1], len(raw) - 1)].all())
