"""Secret scan: credential patterns, and a token-efficiency test for random strings.

Base patterns find assignments, access keys and long hexadecimal runs.  Beyond them,
runs of key characters are split by a byte-pair vocabulary: language and code take few
tokens, random strings many, so a run with few characters per token is reported as
``random``, unless it is a known digest, or all its parts are numbers or words of the
vocabulary.  In a run that is none as a whole, or that overlaps a base finding, what
lies between / or =, and each stretch of parts that are no words, is judged on its own.
Spans are in code points, end exclusive, ordered by start, then kind as listed in KINDS.

Null text is empty and has no spans.  Every row is scanned on its own: repeated rows,
null ids and ties need no rule.  `redact` keeps all columns and rows; a text without
findings stays as it is.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsflow.llm import caches

KINDS = ("assign", "access", "hex", "random")
CHARS_PER_TOKEN = 2.3   # below: random
WORD_CHARS_PER_TOKEN = 2.1   # letters with as many are a word, if of an invented language
MARK = "[SECRET]"

# Fixed patterns of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs
_KEYWORDS = ("password", "passwd", "secret", "token", "api")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")  # RUN_LEAST characters
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)  # hexadecimal digits of md5, sha1, tiger, sha224, sha256, sha384, sha512
_DIGEST = re.compile(r"[0-9A-Fa-f]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PART = re.compile(r"[A-Za-z0-9]+")
_CHUNK = re.compile(r"[^/=]+")
_NAMED = re.compile(r"([A-Za-z]+)[0-9]{0,4}")
RUN_LEAST = 16

_encodings: dict = {}


def encoding(path: str, pattern: str):
    """The byte-pair vocabulary of a rank file."""
    if (path, pattern) not in caches.only("secrets", _encodings):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _encodings[path, pattern] = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path, pattern]


def is_word(part: str, vocabulary, limit: float = WORD_CHARS_PER_TOKEN) -> bool:
    """A number, or letters that the vocabulary has in one token or in long ones, with up to 4 digits behind them."""
    if part.isdigit():
        return True
    named = _NAMED.fullmatch(part)
    return named is not None and ((n := len(vocabulary.encode_ordinary(named[1]))) == 1 or len(named[1]) >= limit * n)


def is_random(run: str, vocabulary, limit: float = CHARS_PER_TOKEN) -> bool:
    """The token-efficiency test."""
    if _DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or _UUID.fullmatch(run):
        return False
    return len(run) < limit * len(vocabulary.encode_ordinary(run)) and not all(is_word(p, vocabulary) for p in _PART.findall(run))


def random_spans(run: str, vocabulary, at: int = 0, taken: tuple[list[int], list[int]] = ([], [])) -> list[tuple[int, int]]:
    """The random strings in a run that begins at `at`: all of it, or else those of its chunks and stretches.
    None overlaps a span taken; those are disjoint, in order, as their begins and ends."""

    def clear(a: int, b: int) -> bool:
        k = bisect_right(taken[1], at + a)
        return k == len(taken[1]) or taken[0][k] >= at + b

    if clear(0, len(run)) and is_random(run, vocabulary):
        return [(at, at + len(run))]
    judged = [m.span() for m in _CHUNK.finditer(run)]
    begin = end = None
    for m in _PART.finditer(run):
        hit = not clear(*m.span())
        if not hit and not is_word(m[0], vocabulary):
            begin, end = m.start() if begin is None else begin, m.end()
        elif begin is not None and (hit or len(m[0]) > 3):  # a short word may be part of a random string
            judged.append((begin, end))
            begin = None
    if begin is not None:
        judged.append((begin, end))
    out = []
    for a, b in sorted(set(judged)):
        if b - a >= RUN_LEAST and clear(a, b) and is_random(run[a:b], vocabulary):
            if out and at + a < out[-1][1]:
                out[-1] = out[-1][0], max(at + b, out[-1][1])
            else:
                out.append((at + a, at + b))
    return out


def find(text: str, vocabulary) -> list[tuple[str, int, int]]:
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    begins, ends = [], []
    for _, a, b in sorted(found, key=lambda s: s[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    for m in RUN.finditer(text):
        found += [("random", a, b) for a, b in random_spans(m[0], vocabulary, m.start(), (begins, ends))]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def hide(text: str, spans: list[tuple[str, int, int]], mark: str = MARK) -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for k, (_, begin, end) in enumerate(spans):
        if k == 0 or begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    vocabulary = encoding(path, pattern)
    for batch in batches:
        found = [[dict(zip(("kind", "start", "end"), s)) for s in find(t or "", vocabulary)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPANS)], ["doc_id", "spans"])


def scan(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) for every row; path and pattern name the vocabulary."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = T.StructType([base.schema["doc_id"], *T._parse_datatype_string("spans array<struct<kind: string, start: int, end: int>>")])
    return base.mapInArrow(lambda it: _scan(it, path, pattern), kind)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _redact(batches, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    vocabulary = encoding(path, pattern)
    for batch in batches:
        texts = [t and hide(t, find(t, vocabulary)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def redact(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows of docs, in its columns, with every finding in the text replaced by MARK."""
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row"), F.col(text_col).alias("text"))
    out = base.mapInArrow(lambda it: _redact(it, path, pattern), T.StructType([base.schema["row"], base.schema["text"]]))
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))
