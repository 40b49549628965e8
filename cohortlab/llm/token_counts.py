"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of at most ``chunk_chars`` characters is encoded at once. A longer one
is encoded in chunks that overlap. Two neighbouring encodings are spliced at a
position of their overlap where both start a token and where the tokenizer's
pattern proves a cut: a white-space character after a character that is none.
No match of the byte-level pattern holds such a pair, so every tokenization of
the text has a boundary there and what follows does not depend on what came
before. If the overlap holds no such position, it is doubled, up to the whole
of both chunks; the count is the count of the whole text in every case.

Engine: the ``tokenizers`` library and its .json file. With ``ranks_path``
(the same vocabulary as ranks), texts made of characters that both libraries
are known to classify alike (printable ASCII, tab, line ends, U+00A1-U+024F)
and without special strings are counted with ``tiktoken``, which is about five
times as fast; all other texts go to ``tokenizers``.

Defined results: a null text counts as empty (0 bytes, 0 tokens, not over the
limit); a null key stays null; repeated rows give repeated results; other
columns of the input are not read, so their names cannot clash; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
#: A chunk's last characters: a match there can change with what follows (a
#: contraction, a white-space run, a special string cut in two).
EDGE_CHARS = 32
BATCH_CHARS = 1 << 18

_ALIKE = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")
_COUNTERS: dict[tuple, TokenCounter] = {}


class TokenCounter:
    """Counts tokens as ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, model: bytes, ranks: bytes | None = None, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS):
        from tokenizers import Tokenizer
        spec = json.loads(model)
        self.tok = Tokenizer.from_str(model.decode("utf-8"))
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.byte_level = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                           and not pre.get("add_prefix_space") and spec.get("normalizer") is None)
        self.chunk, self.overlap = max(chunk_chars, 4 * EDGE_CHARS), max(overlap_chars, 2 * EDGE_CHARS)
        self.fast = None
        if ranks is not None and self.byte_level:
            import tiktoken
            from public_tokenizers import PATTERN
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def count(self, texts: list[str | None]) -> list[int]:
        out, slow, chars = [0] * len(texts), [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.byte_level and len(t) > self.chunk:
                out[i] = self.count_long(t)
            elif self.fast is not None and not _ALIKE.search(t) and not any(s in t for s in self.special):
                out[i] = len(self.fast.encode_ordinary(t))
            else:
                slow.append(i)
                chars += len(t)
                if chars >= BATCH_CHARS:
                    self._batch(texts, slow, out)
                    slow, chars = [], 0
        self._batch(texts, slow, out)
        return out

    def _batch(self, texts, rows, out) -> None:
        if rows:
            for i, e in zip(rows, self.tok.encode_batch_fast([texts[i] for i in rows], add_special_tokens=False),
                            strict=True):
                out[i] = len(e)

    def _starts(self, text: str, a: int, b: int) -> np.ndarray:
        """Start positions, in ``text``, of the tokens of text[a:b]."""
        e = self.tok.encode(text[a:b], add_special_tokens=False)
        return np.fromiter((s for s, _ in e.offsets), dtype=np.int64, count=len(e)) + a

    def count_long(self, text: str) -> int:
        n, total, begin = len(text), 0, 0
        right = min(n, self.chunk)
        left = self._starts(text, 0, right)
        while right < n:
            overlap, size = self.overlap, self.chunk
            while True:
                start = max(begin, right - overlap)
                stop = min(n, start + max(size, 2 * overlap))
                following = self._starts(text, start, stop)
                cut = self._splice(text, left, following, start, right)
                if cut is not None:
                    total += int(np.searchsorted(left, cut) - np.searchsorted(left, begin))
                    left, begin, right = following, cut, stop
                    break
                if start == begin:
                    # the overlap is all of the left chunk: it ends further right now
                    left, right = following, stop
                    if right == n:
                        break
                overlap *= 2
        return total + int(len(left) - np.searchsorted(left, begin))

    @staticmethod
    def _splice(text: str, left: np.ndarray, right: np.ndarray, start: int, end: int) -> int | None:
        """The last position where both encodings start a token and the
        pattern proves a boundary; None if the overlap has none."""
        both = np.intersect1d(left, right)
        for p in both[(both > start) & (both < end - EDGE_CHARS)][::-1].tolist():
            if text[p] in " \t\n\r" and not text[p - 1].isspace():
                return p
        return None


def counter(model: bytes, ranks: bytes | None, chunk_chars: int, overlap_chars: int) -> TokenCounter:
    """One counter per worker process and setting."""
    key = (hash(model), hash(ranks), chunk_chars, overlap_chars)
    if key not in _COUNTERS:
        _COUNTERS[key] = TokenCounter(model, ranks, chunk_chars, overlap_chars)
    return _COUNTERS[key]


def read_bytes(path: str | None) -> bytes | None:
    if path is None:
        return None
    with open(path, "rb") as f:
        return f.read()


def token_counts(docs: DataFrame, model_path: str, ranks_path: str | None = None, *, key: str = "doc_id",
                 text: str = "text", limit: int = 512, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit.

    The vocabulary files are read on the driver and broadcast (a file has a
    fixed size of a few MB, whatever the data). No shuffle.
    """
    files = docs.sparkSession.sparkContext.broadcast((read_bytes(model_path), read_bytes(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(*files.value, chunk_chars, overlap_chars)
        for b in batches:
            col = b.column(1)
            size = pc.fill_null(pc.binary_length(col), 0).cast(pa.int64())
            n = np.zeros(len(col), dtype=np.int64)
            for a in range(0, len(col), 256):
                n[a: a + 256] = c.count(col.slice(a, 256).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)],
                                             names=[key, "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(key, text)
    schema = T.StructType([src.schema[0], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return src.mapInArrow(run, schema)
