"""BPE encoding and decoding by dynamic programming over prefixes.

A merge-list BPE gives every prefix of a word exactly one last token, and a
token ``t`` ending at position ``i`` is that token if and only if the last
token of the prefix before it and ``t`` stay apart when their characters
are merged together. So one pass over a word needs, per position, the
vocabulary tokens that end there (found by an automaton whose state is the
longest suffix of the prefix that begins a token, with suffix links to the
shorter ones: Aho-Corasick over the vocabulary) and one compatibility test
per candidate. Following the stored tokens back from the end gives the ids
that running the merges one by one would give, in time linear in the word
times the few tokens that end at a position.

The operators run as Arrow map stages: no shuffle, no state between tasks
but a bounded word memo per Python worker. The vocabulary file (1.7 MB, a
parameter) is read on the driver and broadcast as text, so executors need
no copy of it.

Defined results: null text is an empty text; an empty text gives no ids and
an empty decoded text; repeated rows are encoded each for itself; an empty
table gives an empty result; texts of any length are processed whole (a
word longer than ``MEMO_CHARS`` is not memoised).
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

#: Words kept per Python worker before the memo is emptied, and the longest kept.
MEMO_WORDS = 400_000
MEMO_CHARS = 64
_END = 0x1000    # shift that marks the last character of a word
_NEVER = 1 << 30

# White space of the tokenizer's own regular expressions (Unicode White_Space).
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CLITICS = "'s|'t|'re|'ve|'m|'ll|'d"
_ANY = regex.compile(rf"{_CLITICS}|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


def _latin_pattern() -> re.Pattern:
    """The word pattern for texts below U+0250, where ``re`` with spelled-out
    classes is several times faster than property classes."""
    def cls(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)
    letters, numbers = cls("L"), cls("N")
    return re.compile(rf"{_CLITICS}|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+")


_LATIN = _latin_pattern()
_BEYOND = re.compile("[^\\x00-\\u024f]")


def _byte_chars() -> dict[int, int]:
    """Byte -> printable character of byte-level vocabularies: printable
    Latin-1 stands for itself, the others follow from U+0100."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = b
        else:
            out[b] = 256 + extra
            extra += 1
    return out


_BYTES = _byte_chars()


class WordBpe:
    """A word-level BPE with an end-of-word mark, from its JSON description."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        mark = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t.encode()
        symbols: dict[str, str] = {}
        for c in _BYTES.values():
            symbols[chr(c)], symbols[chr(c) + mark] = chr(c), chr(c + _END)
        self._left, self._right = list(range(size)), list(range(size))
        self._born = [-1] * size
        self._merge: dict[tuple[int, int], int] = {}
        valid = set()
        chars: dict[int, str] = {vocab[t]: s for t, s in symbols.items() if t in vocab}
        valid.update(chars)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            chars[z] = chars[x] + chars[y]
            # a token counts only if its own characters merge into it
            if x in valid and y in valid and z not in valid and self._apart(x, y):
                valid.add(z)
            self._left[z], self._right[z], self._born[z] = x, y, rank
            self._merge[x, y] = rank
        self._automaton = ahocorasick.Automaton()
        for i in valid:
            self._automaton.add_word(chars[i], (i, len(chars[i])))
        self._automaton.make_automaton()
        self._fits: dict[int, bool] = {}
        self._memo: dict[str, bytes] = {}

    def _apart(self, x: int, y: int) -> bool:
        """Do adjacent tokens ``x`` and ``y`` stay apart when their characters
        are merged from scratch? Walk both back in time: undo the later of
        the two merges next to the border; at each point the pair that met
        there must not have had a merge due before one side was taken up by
        its own. (Of equal merges the left one goes first.)"""
        gone_x = gone_y = _NEVER
        while True:
            due = self._merge.get((x, y), _NEVER)
            if due < gone_x and due <= gone_y and due != _NEVER:
                return False
            if self._born[x] > self._born[y]:
                gone_x, x = self._born[x], self._right[x]
            elif self._born[y] >= 0:
                gone_y, y = self._born[y], self._left[y]
            else:
                return True

    def word(self, w: str) -> list[int]:
        """Ids of one pre-tokenised word."""
        s = w.encode().decode("latin-1").translate(_BYTES)
        s = s[:-1] + chr(ord(s[-1]) + _END)
        n = len(s)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        last[0] = _NEVER
        fits = self._fits
        for end, (token, k) in self._automaton.iter(s):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - k]
            if before < 0:
                continue
            if before != _NEVER:
                pair = before << 20 | token
                if pair not in fits:
                    if len(fits) > MEMO_WORDS:
                        fits.clear()
                    fits[pair] = self._apart(before, token)
                if not fits[pair]:
                    continue
            last[end], size[end] = token, k
        out = []
        while n:
            if size[n] <= 0:
                raise ValueError(f"the vocabulary has no tokens for {s[:40]!r}")
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _word_bytes(self, w: str) -> bytes:
        ids = self.word(w)
        b = struct.pack(f"<{len(ids)}I", *ids)
        if len(w) <= MEMO_CHARS:
            if len(self._memo) >= MEMO_WORDS:
                # frequent words are met again at once; the rest goes
                self._memo.clear()
            self._memo[w] = b
        return b

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self._cut.split(text) if self._cut and "<|" in text else [text]
        out: list[bytes] = []
        memo, fresh = self._memo.get, self._word_bytes
        for part in parts:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
                continue
            # lower-casing by character: a final sigma is no special case
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            found = (_ANY if _BEYOND.search(part) else _LATIN).findall(part)
            out += [memo(w) or fresh(w) for w in found]
        return b"".join(out)

    def forget(self) -> None:
        """Empty the memos: a worker kept for later stages holds only the tables."""
        self._memo.clear()
        self._fits.clear()

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by blanks (the file names no decoder)."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode()


_LOADED: dict[int, WordBpe] = {}


def _loaded(shared: Broadcast) -> WordBpe:
    """One tokenizer per Python worker and vocabulary."""
    text = shared.value
    key = hash(text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(text)
    return _LOADED[key]


def share(spark: SparkSession, path: str) -> Broadcast:
    """Broadcast the vocabulary file at ``path`` (a local file of the driver,
    of fixed size)."""
    with open(path, encoding="utf-8") as fh:
        return spark.sparkContext.broadcast(fh.read())


def _replaced(batch: pa.RecordBatch, name: str, column: str, values: pa.Array) -> pa.RecordBatch:
    keep = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], values],
                                      names=[*keep, column])


def _added(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, column])


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``ids_col``: the ids of the
    whole text as binary, little-endian unsigned 32-bit each. With
    ``decoded_col`` the ids are also decoded in the same pass, into that
    column: one worker and one copy of the tables a task instead of two."""
    shared = share(docs.sparkSession, vocabulary)

    def run(batches):
        bpe = _loaded(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [bpe.encode(t) for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                out = _replaced(part, text_col, ids_col, pa.array(ids, pa.binary()))
                yield _added(out, decoded_col, pa.array([bpe.decode(b) for b in ids], pa.string())) if decoded_col else out
        bpe.forget()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col]
                       + [f"`{ids_col}` binary"] + ([f"`{decoded_col}` string"] if decoded_col else []))
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text in ``text_col`` added after the ids."""
    shared = share(encoded.sparkSession, vocabulary)

    def run(batches):
        bpe = _loaded(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = part.column(part.schema.get_field_index(ids_col)).to_pylist()
                texts = pa.array([bpe.decode(b or b"") for b in ids], pa.string())
                yield _added(part, text_col, texts)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema] + [f"`{text_col}` string"])
    return encoded.mapInArrow(run, schema)
