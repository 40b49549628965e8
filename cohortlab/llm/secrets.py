"""Secret scan: three base patterns and a token-efficiency test.

Base kinds, leftmost and non-overlapping per kind: ``assign`` (a key word, an
assignment and a value of 6 or more characters), ``access`` (AKIA..., 20 or
more characters), ``hex`` (24 or more lower-case hex digits).

The method adds the kind ``token``: every maximal run of 16 or more
characters of A-Za-z0-9+/_.- is a candidate. Known shapes are excluded: hex
strings as long as a digest (32, 40, 56, 64, 96 or 128), UUIDs, numbers, and
identifiers (parts joined by / _ . - + that are each a number or a word in one
case style; a word of 16 or more letters must take few tokens, too). Of the
rest, a run with few characters per token under a byte-level BPE vocabulary is
a random string: words that a vocabulary knows take few tokens, random
characters take many. In a run that is not, the same is asked of each part of
16 or more characters, so that a path does not hide a key in it.

Defined results: a null text is scanned as the empty text; positions are code
points with an exclusive end; spans are joined as kind:start:end by start,
then kind in the order assign, access, hex, token. Repeated rows repeat;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import kernels as K
from .token_counts import read_bytes

MIN_RUN = 16
MIN_HEX = 24
MAX_CHARS_PER_TOKEN = 2.2
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
KINDS = ("assign", "access", "hex", "token")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ANY_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PART = re.compile(r"[a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]+|[a-z]+(?:[A-Z][a-z]+)+|(?:[A-Z][a-z]+)+|")
_JOIN = re.compile(r"[/_.+-]")
_RUN_BYTES = np.zeros(256, dtype=bool)
_RUN_BYTES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-"]] = True
_ENCODINGS: dict[int, object] = {}


def encoding(ranks: bytes):
    """One tiktoken encoding per worker process and vocabulary."""
    key = hash(ranks)
    if key not in _ENCODINGS:
        import tiktoken
        from public_tokenizers import PATTERN
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[key]


def few_tokens(s: str, enc, ratio: float) -> bool:
    return len(s) >= ratio * len(enc.encode_ordinary(s))


def known_shape(s: str, enc, min_run: int, ratio: float) -> bool:
    """Digests, UUIDs, numbers and identifiers: not random strings."""
    if len(s) in DIGEST_LENGTHS and _ANY_HEX.fullmatch(s):
        return True
    if s.isdigit() or _UUID.fullmatch(s):
        return True
    return all(_PART.fullmatch(p) and (len(p) < min_run or p.isdigit() or few_tokens(p, enc, ratio)) for p in _JOIN.split(s))


def random_strings(s: str, enc, min_run: int, ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the random strings in a run: the whole, or its parts."""
    def is_random(x: str) -> bool:
        return len(x) >= min_run and not known_shape(x, enc, min_run, ratio) and not few_tokens(x, enc, ratio)

    if is_random(s):
        return [(0, len(s))]
    out, at = [], 0
    for p in _JOIN.split(s) if len(s) > min_run else ():
        if is_random(p):
            out.append((at, at + len(p)))
        at += len(p) + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base kinds."""
    out, low = [], text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out


def runs(raw: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) in bytes of the row, of every run of candidate
    characters with at least ``least`` of them."""
    base = int(offsets[0])
    off = offsets - base
    mask = _RUN_BYTES[raw[base: int(offsets[-1])]]
    if not len(mask):
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[off] = True
    start = np.flatnonzero(mask & (np.concatenate([[True], ~mask[:-1]]) | edge[:-1]))
    end = np.flatnonzero(mask & (np.concatenate([~mask[1:], [True]]) | edge[1:])) + 1
    long = end - start >= least
    start, end = start[long], end[long]
    row = np.searchsorted(off, start, side="right") - 1
    return row, start - off[row], end - off[row]


def scan(col, enc, min_run: int = MIN_RUN, ratio: float = MAX_CHARS_PER_TOKEN) -> list[list[tuple[int, int, str]]]:
    """All spans of every text of an Arrow string column, in output order."""
    raw, offsets = K.utf8_buffers(col)
    texts = col.to_pylist()
    order = {k: i for i, k in enumerate(KINDS)}
    out: list[list[tuple[int, int, str]]] = []
    for lo, hi in K.slices(offsets):
        rows, starts, ends = runs(raw, offsets[lo: hi + 1], min(min_run, MIN_HEX))
        by_row: dict[int, list[tuple[int, int]]] = {}
        for r, s, e in zip(rows.tolist(), starts.tolist(), ends.tolist(), strict=True):
            by_row.setdefault(r, []).append((s, e))
        for r in range(lo, hi):
            t = texts[r] or ""
            spans = base_spans(t) if t else []
            if cand := by_row.get(r - lo):
                spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(t)]
                own = raw[offsets[r]: offsets[r + 1]]
                chars = None if t.isascii() else K.char_positions(own)
                for s, e in cand:
                    a = s if chars is None else int(chars[s])
                    found = random_strings(own[s:e].tobytes().decode("ascii"), enc, min_run, ratio)
                    spans += [(a + x, a + y, "token") for x, y in found]
            spans.sort(key=lambda x: (x[0], order[x[2]]))
            out.append(spans)
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def secret_scan(docs: DataFrame, ranks_path: str, *, key: str = "doc_id", text: str = "text",
                min_run: int = MIN_RUN, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per row of ``docs``: key, n_assign, n_access, n_hex, n_token,
    base_sha256, spans. One pass, no shuffle; the vocabulary (a file of fixed
    size) is broadcast."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_bytes(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value)
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                found = scan(part.column(1), enc, min_run, max_chars_per_token)
                counts = {k: [sum(s[2] == k for s in f) for f in found] for k in KINDS}
                digest = [hashlib.sha256(joined(s for s in f if s[2] != "token").encode()).hexdigest() for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS),
                     pa.array(digest, pa.string()), pa.array([joined(f) for f in found], pa.string())],
                    names=[key, "n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans"])

    src = docs.select(key, text)
    schema = T.StructType([src.schema[0], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return src.mapInArrow(run, schema)
