"""Byte-level BPE: exact encoding by longest token matches with backtracking, and decoding by an offset table.

A text is cut at special tokens, then by the pre-tokenizer's pattern. Each piece is
encoded left to right: an Aho-Corasick automaton over the reversed vocabulary names the
longest token that starts at every byte; a token may follow another only if the pair is
compatible, that is, if merging the two byte strings together would never join across
their border. A dead end takes the next shorter token or steps back. Every byte offset
dies at most once, so a piece takes linear time, and the result equals the rank-ordered merges.

Null text counts as empty: no tokens, and the hashes of no bytes. Repeated rows give
repeated results; other columns are ignored. Texts and pieces may have any length.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from meetloom.llm.common import each_text, held_one, small_batches, text_slices

#: Fixed values of the public byte-level pre-tokenizer: its pattern, and the printable bytes that stand for themselves.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Bounds of what a worker keeps: pieces (about 200 bytes each) up to a length, and judged pairs.
CACHED_PIECES, CACHED_LENGTH, CACHED_PAIRS = 250_000, 64, 500_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _byte_of_char() -> dict[int, str]:
    """The vocabulary's alphabet back to bytes, as Latin-1 characters: printable bytes as they are, others counted from U+0100."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {**{b: chr(b) for b in PRINTABLE}, **{256 + i: chr(b) for i, b in enumerate(rest)}}


def located(tokenizer: str) -> str:
    """The file of a tokenizer given by path, or by its name among the public ones where this process runs."""
    if os.path.exists(tokenizer):
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


class Bpe:
    """Tables of one tokenizer file. Build with Bpe.load(path or public name), which keeps the last one per process."""

    @classmethod
    def load(cls, tokenizer: str) -> Bpe:
        return held_one(("bpe", tokenizer), lambda: cls(located(tokenizer)))

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t.translate(back) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.id_of = {t: i for i, t in texts.items()}
        self.special = special
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.pieces = regex.compile(PIECES).findall

        self.born = {i: -1 for i in texts}  # rank of the merge that makes a token; -1 for a byte
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (self.id_of[x.translate(back)] for x in (m.split(" ") if isinstance(m, str) else m))
            self.rank[a, b] = r
            made = self.id_of[texts[a] + texts[b]]
            self.born[made], self.parts[made] = r, (a, b)
        self.size = [len(texts.get(i, "")) for i in range(max(texts) + 1)]
        self.shorter = [next((self.id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id_of), None) for t in (texts.get(i, "") for i in range(max(texts) + 1))]
        self.starts = ahocorasick.Automaton()
        for i, t in texts.items():
            self.starts.add_word(t[::-1], i)
        self.starts.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

        blobs = {**{i: t.encode("latin-1") for i, t in texts.items()}, **{i: s.encode() for s, i in special.items()}}
        lengths = np.zeros(max(blobs) + 1, np.int64)
        for i, b in blobs.items():
            lengths[i] = len(b)
        self.offset = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(blobs.get(i, b"") for i in range(len(lengths))), np.uint8)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token that touch one of its ends over time, each with the rank at which a larger part takes it up."""
        out, until = [(token, 1 << 60)], 0
        while token in self.parts:
            until, token = self.born[token], self.parts[token][side]
            out.append((token, until))
        return out

    def _fits(self, a: int, b: int) -> bool:
        """No merge ever joins a and b across their border. Of equal ranks the left pair merges first."""
        for x, x_until in self._edge(a, 1):
            for y, y_until in self._edge(b, 0):
                r = self.rank.get((x, y))
                if r is not None and self.born[x] < r < x_until and self.born[y] < r <= y_until:
                    return False
        return True

    def encode_piece(self, s: str) -> list[int]:
        """Tokens of one piece, given as Latin-1 characters for its bytes."""
        n, size, shorter, compatible = len(s), self.size, self.shorter, self.compatible
        longest, last = [0] * n, -1
        for end, token in self.starts.iter(s[::-1]):
            if end != last:  # the automaton names the longest match of each place first
                longest[n - 1 - end] = token
                last = end
        out: list[int] = []
        dead: set[int] = set()
        at, before, token = 0, -1, longest[0]
        while True:
            end = at + size[token]
            fits = end not in dead
            if fits and at:
                pair = before << 32 | token
                fits = compatible.get(pair)
                if fits is None:
                    if len(compatible) > CACHED_PAIRS:
                        compatible.clear()
                    fits = compatible[pair] = self._fits(before, token)
            if fits:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            elif (less := shorter[token]) is not None:
                token = less
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                before = out[-1] if out else -1

    def _encode_plain(self, text: str, out: list[bytes]) -> None:
        cache, id_of = self.cache, self.id_of
        for piece in self.pieces(text):
            ids = cache.get(piece)
            if ids is None:
                s = piece.encode("utf-8").decode("latin-1")
                whole = id_of.get(s)
                ids = np.array(self.encode_piece(s) if whole is None else [whole], "<u4").tobytes()
                if len(piece) <= CACHED_LENGTH:
                    if len(cache) >= CACHED_PIECES:
                        cache.clear()
                    cache[piece] = ids
            out.append(ids)

    def encode(self, text: str) -> np.ndarray:
        """The text's ids, little-endian unsigned 32-bit."""
        out: list[bytes] = []
        if not self.cut:
            self._encode_plain(text, out)
        else:
            for i, part in enumerate(self.cut.split(text)):
                if i % 2:
                    out.append(self.special[part].to_bytes(4, "little"))
                elif part:
                    self._encode_plain(part, out)
        return np.frombuffer(b"".join(out), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """All tokens' bytes, special ones included, gathered at once from the table of offsets."""
        if not len(ids):
            return b""
        start = self.offset[ids]
        length = self.offset[1:][ids] - start
        before = np.cumsum(length) - length
        return self.blob[np.repeat(start - before, length) + np.arange(int(length.sum()))].tobytes()


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text; one row per row of docs, in one pass without a shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(tokenizer)
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for text in each_text(batch.column(1)):
                ids = bpe.encode(text or "")
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(bpe.decode_bytes(ids).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: the operator's full output, for writing token files."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(tokenizer)
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids = [bpe.encode(t or "") for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_texts(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text: the inverse of encode_texts. Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(tokenizer)
        for batch in batches:
            texts = [bpe.decode_bytes(np.array(ids or [], np.uint32)).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
