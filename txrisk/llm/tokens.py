"""Token ids of whole texts by a public byte-level BPE, and documents cut into pieces."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import releasing, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as merge ranks.
RANKS = "byte_bpe_50k.tiktoken"
#: The id that closes every document.
END_ID = 1
#: Words whose ids one worker remembers; a memory bound, it changes no id.
CACHE_WORDS = 600_000

_ODD_SPACE = re.compile(r"[^\S \n]|\s\s")


class Encoder:
    """``tokenizer.encode(text, add_special_tokens=False).ids`` as little-endian 32-bit ids, words remembered.

    The pre-tokenizer never joins what stands before a single space or line break with what follows, so a text
    whose white space is only that is the concatenation of its words' ids. The words met for the first time
    are encoded together, as lines; any other text is encoded as it is. ``fast`` names the same vocabulary as
    merge ranks, which a quicker library reads; without it the tokenizer itself encodes the new words.
    """

    def __init__(self, path: str, fast: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_break = self._encode("\n")[0]
        self.words_at_once = self._encode
        if fast and os.path.exists(fast):
            import public_tokenizers
            import tiktoken

            with open(fast, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.words_at_once = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.forget()

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def forget(self):
        """Drop the words learnt so far; a worker that goes on with other work shouldn't hold them."""
        # Keys: a word stands after a space, or, with a leading line break, at the start of a line.
        self.known = {"": self._bytes(" "), "\n": self._bytes("\n")}

    def _learn(self, words: set[str]):
        odd = [w for w in words if any(s in w for s in self.special)]
        for w in odd:
            self.known[w] = self._bytes(w if w[0] == "\n" else " " + w)
        words = sorted(words.difference(odd))
        if not words:
            return
        # One text, each word on a line of its own: the line breaks part the ids again.
        after = [w for w in words if w[0] != "\n"]
        ids = np.array(self.words_at_once("\n".join([" " + w for w in after] + [w[1:] for w in words if w[0] == "\n"])), "<u4")
        raw = ids.tobytes()
        cuts = (np.flatnonzero(ids == self.line_break) * 4).tolist() + [len(raw)]
        start, known, lead = 0, self.known, self.known["\n"]
        for k, w in enumerate(after + [w for w in words if w[0] == "\n"]):
            known[w] = raw[start:cuts[k]] if k < len(after) else lead + raw[start:cuts[k]]
            start = cuts[k] + 4

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.forget()
        split = [None if _ODD_SPACE.search(t) else t.replace("\n", " \n").split(" ") for t in texts]
        known = self.known
        # The first word of a text stands at the start of a line, without the line break.
        words = set()
        for parts in split:
            if parts:
                parts[0] = "\n" + parts[0]
                words.update(parts)
        self._learn(words.difference(known))
        get = known.__getitem__
        for text, parts in zip(texts, split):
            if parts is None:
                yield self._bytes(text)
            else:
                yield b"".join(map(get, parts))[4:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, fast: str | None = None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, fast)
    return _ENCODERS[path]


#: Characters of text that a worker holds split into words at a time.
GROUP_CHARS = 2_000_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def piece_cutter(max_len: int, tokenizer: str | None = None):
    """A function from batches of (doc_id, text) to batches of PIECES."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    fast = None if tokenizer else tokenizer_path(RANKS)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, fast)

        def pieces(doc_ids, texts):
            rows = []
            for doc, raw in zip(doc_ids, enc.encode_all(texts)):
                raw += end
                n = len(raw) // 4
                rows += [(doc, s, min(max_len, n - s), n, raw[4 * s:4 * (s + max_len)]) for s in range(0, n, max_len)]
            columns = zip(*rows)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["doc_id", "start", "length", "doc_tokens", "ids"])

        try:
            for batch in batches:
                ids, texts, chars = [], [], 0
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = text.as_py() or ""
                    ids.append(doc)
                    texts.append(text)
                    chars += len(text)
                    if chars >= GROUP_CHARS:
                        yield pieces(ids, texts)
                        ids, texts, chars = [], [], 0
                if ids:
                    yield pieces(ids, texts)
        finally:
            enc.forget()

    return releasing(cut)


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def document_pieces(docs: DataFrame, max_len: int, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids: every document's ids, then END_ID, cut every ``max_len``.

    ``ids`` holds little-endian unsigned 32-bit ids. A null or empty text is one piece with END_ID alone.
    """
    return id_and_text(docs).mapInArrow(piece_cutter(max_len, tokenizer), PIECES)
