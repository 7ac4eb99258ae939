"""Tokens of whole texts from the tokens of their distinct chunks and words.

A chunk is what stands between runs of ASCII white space.  Arrow splits and
dictionary-encodes a whole run of texts at once, so Python only sees each distinct chunk
of a run, and the tokens of all texts are gathered by numpy from those of the chunks.
Chunks not known yet are cut into words, all at once, and only words not known yet are
given to an encoder.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 200_000   # chunks a worker remembers (about 150 bytes each)
WORDS = 300_000   # words a worker remembers (about 200 bytes each)
LONGEST = 48      # bytes of a chunk or word worth remembering
AT_ONCE = 1 << 15  # unseen chunks encoded, or chunks of texts gathered, at once: what this takes does not grow with the run
MARK = b"\xff\xff\xff\xff"  # between the ids of two chunks while they are one array


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(codes, row bounds, distinct chunks) of a string column; nulls are empty.
    Row r holds the chunks codes[bounds[r]:bounds[r + 1]]; a chunk may be empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lists = pc.ascii_split_whitespace(column.fill_null(""))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(), bounds - bounds[0], coded.dictionary.cast(pa.binary()).to_pylist()


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[starts[c]:starts[c] + lengths[c]] of all codes c one after another, and each run's end."""
    long = lengths[codes]
    ends = np.cumsum(long)
    at = np.repeat(starts[codes] - (ends - long), long)
    at += np.arange(len(at))
    return values[at], ends


class ChunkCache:
    """Token ids of whole texts, by `encode` of their distinct chunks; the first chunks seen are kept."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self.encode, self.known = encode, {}

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row bounds): the ids of row r are ids[bounds[r]:bounds[r + 1]]."""
        codes, rows, chunks = split(column)
        parts = list(map(self.known.get, chunks))
        unseen = [i for i, p in enumerate(parts) if p is None]
        room = CACHE - len(self.known)
        for k in range(0, len(unseen), AT_ONCE):
            some = unseen[k:k + AT_ONCE]
            for i, part in zip(some, self.encode([chunks[i] for i in some])):
                parts[i] = part
                if room > 0 and len(chunks[i]) <= LONGEST:
                    self.known[chunks[i]] = part
                    room -= 1
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        values = np.frombuffer(b"".join(parts), "<u4")
        del chunks, parts, unseen
        starts = np.cumsum(lengths) - lengths
        ends = np.concatenate([[0], np.cumsum(lengths.astype(np.int32)[codes], dtype=np.int64)])
        ids = np.empty(ends[-1], "<u4")
        for k in range(0, len(codes), AT_ONCE):
            some = codes[k:k + AT_ONCE]
            ids[ends[k]:ends[k + len(some)]] = gather(values, starts, lengths, some)[0]
        return ids, ends[rows]


def symbols(text: str) -> str:
    """The UTF-8 bytes of a text as byte symbols: printable bytes as they are, the others from 256 on."""
    if text.isascii() and text.isprintable() and " " not in text:
        return text
    return text.encode().decode("latin-1").translate(_SYMBOLS)


_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SYMBOLS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class WordCache:
    """Ids of chunks by their words, for tokenizers that lower-case, cut by a pattern and drop white space.

    Chunks of printable ASCII and of the Latin letters that the library is seen to handle
    as this does are cut by the file's own pattern, all at once; a chunk with any other
    character or with a control string goes to `encode_text` as it is.  ValueError if the
    tokenizer is of another kind.
    """

    def __init__(self, library, spec: dict, encode_words: Callable[[list[str]], list[bytes]], encode_text: Callable[[str], bytes]):
        self.library, self.encode_words, self.encode_text, self.known = library, encode_words, encode_text, {}
        cutter = spec.get("pre_tokenizer") or {}
        cutter = next((p for p in cutter.get("pretokenizers", [cutter]) if p.get("type") == "Split" and "Regex" in p["pattern"]), None)
        if not cutter or not library.normalizer:
            raise ValueError("no pattern that cuts words")
        letters = [c for c in map(chr, range(0xC0, 0x250)) if self._letter(c)]
        low = "".join(sorted({c.lower() for c in letters}))
        # the file's pattern with its classes written out, as they are among the characters of `easy`
        self.pattern = re.compile(cutter["pattern"]["Regex"].replace("\\p{L}", "a-z" + low).replace("\\p{N}", "0-9") + "|\n")
        self.easy = re.compile("[!-~" + "".join(letters) + "]*")
        names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.control = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        probe = "It's A'LL 12,34 'tis we'd!?'re _x1\tz\n Été'S ÄÖÜß-Ñandú " + "".join(map(chr, range(33, 127)))
        if self.library_words(probe) != [symbols(w) for c in probe.split() for w in self.pattern.findall(c.lower())]:
            raise ValueError("words are not cut at white space by the pattern")

    def library_words(self, text: str) -> list[str]:
        """The words of a text as byte symbols, by the library."""
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def _letter(self, c: str) -> bool:
        """Whether the library takes this character for a letter, and its lower case for Python's."""
        return self.library_words(f"a{c}1{c}") == [symbols(f"a{c.lower()}"), "1", symbols(c.lower())]

    def __call__(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of texts without white space, as little-endian unsigned 32-bit integers."""
        texts = b"\n".join(chunks).decode().split("\n") if chunks else []
        easy = [bool(self.easy.fullmatch(t)) and not (self.control and self.control.search(t)) for t in texts]
        words = self.pattern.findall("\n".join(t for t, e in zip(texts, easy) if e).lower())
        distinct = set(words) - {"\n"}
        ids = {w: self.known[w] for w in distinct if w in self.known}
        unseen = [w for w in distinct if w not in ids]
        for w, part in zip(unseen, self.encode_words(unseen)):
            ids[w] = part
            if len(self.known) < WORDS and len(w) <= LONGEST:
                self.known[w] = part
        ids["\n"] = MARK
        flat = b"".join(map(ids.__getitem__, words))
        cuts = (np.flatnonzero(np.frombuffer(flat, "<u4") == 0xFFFFFFFF) * 4).tolist()
        parts = iter([flat[a:b] for a, b in zip([0] + [c + 4 for c in cuts], cuts + [len(flat)])])
        return [next(parts) if e else self.encode_text(t) for t, e in zip(texts, easy)]
