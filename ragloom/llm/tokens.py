"""Token ids of whole texts by the tokenizers library, with a bounded memo per task.

The byte-level BPE splits a text at every single space that stands between two other characters: the
space opens the next piece and nothing before it can reach across. So a text's ids are the ids of
its space-separated parts, and repeated parts are looked up: of many texts at a time, each different part
once. The ASCII signs at the end of a part are a piece of their own behind a letter or digit, so the
memo holds parts without them. Parts that the memo lacks go
through the library's model; texts with other runs of white space around a space, and parts
that are not plain letters, go through the library's whole encoder.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 1 << 23  # characters whose parts are looked up at a time
MEMO_PARTS = 1 << 20  # entries, then the memo starts anew
_AMBIGUOUS = re.compile(r"\s \s|\s $|^ \s|^ ?$")
_RARE = re.compile(r"[^\S \n]")  # white space other than spaces and newlines
_LINES = re.compile(r"\s\n|\n\s|^ ?\n|\n$")
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")  # letters, and one piece of signs
_SIGNS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
_SIGNLESS = r"^(?s:.*)[^!-/:-@\[-`{-~]"  # all up to the last character that is no such sign
_STEM = r"[A-Za-z0-9À-ÖØ-öø-ÿ]$"  # a letter or digit last: signs behind it are a piece of their own


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(other)}}


def tokenizer_path(path: str | None, name: str) -> str:
    """``path``, or the installed file of that name (looked up where the task runs)."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteEncoder:
    """ids(text): the ids that encode(text, add_special_tokens=False) gives, as unsigned integers."""

    def __init__(self, path: str | None = None, memo_parts: int = MEMO_PARTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path, "byte_bpe_50k.json"))
        size = self.tokenizer.get_vocab_size()
        self.code, self.dtype = ("H", "<u2") if size <= 1 << 16 else ("I", "<u4")
        self.coded = [i.tobytes() for i in np.arange(size, dtype=self.dtype)]  # each id's bytes
        self.tokenize = self.tokenizer.model.tokenize
        self.alphabet = dict(byte_characters())
        self.newline, self.space = self._whole("\n"), self.alphabet[32]
        self.tails: dict[str, bytes] = {"": b""}
        self.firsts: dict[str, bytes] = {}
        self.memo: dict[str, bytes] = {}
        self.lines: dict[str, bytes] = {}
        self.limit = memo_parts

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.alphabet))]

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 4096:
                self.tails = {"": b""}
            self.tails[tail] = array(self.code, self._piece(tail)).tobytes()
        return self.tails[tail]

    def _spaced(self, part: str) -> bytes:
        """A part that follows a space; kept under the part alone."""
        if part.isascii() and part.isalpha():  # plain letters stand for themselves in the byte alphabet
            sign = part
        else:
            sign = part.encode("utf-8").decode("latin-1").translate(self.alphabet) if _LETTERS.fullmatch(part) else None
        if sign:
            code = self.coded  # the space before a part is its own sign
            got = self.memo[part] = b"".join([code[t.id] for t in self.tokenize(self.space + sign)])
            return got
        plain = _PLAIN.fullmatch(part)
        if not plain or part[0] == " ":
            got = self._part(" " + part)
        else:
            word, tail = plain.groups()
            got = (self.memo.get(word) or self._spaced(word)) + self._tail(tail)
        self.memo[part] = got
        return got

    def _part(self, part: str) -> bytes:
        plain = _PLAIN.fullmatch(part)
        if plain:
            word, tail = plain.groups()
            return array(self.code, self._piece(word)).tobytes() + self._tail(tail)
        if "\n" in part and not _LINES.search(part):  # a single newline is a piece of its own
            head, *rest = part.split("\n")
            head = (self.memo.get(head[1:]) or self._spaced(head[1:])) if head[0] == " " else self._first(head)
            return self.newline.join([head, *map(self._first, rest)])
        return self._whole(part)

    def _first(self, part: str) -> bytes:
        """A part without a space before it."""
        got = self.firsts.get(part)
        if got is None:
            if len(self.firsts) > 1 << 17:
                self.firsts.clear()
            got = self.firsts[part] = self._part(part)
        return got

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=self.dtype)
        if self._doubtful(text) and _AMBIGUOUS.search(text):
            return np.frombuffer(self._whole(text), dtype=self.dtype)
        if len(self.memo) > self.limit:
            self.memo.clear()
        parts = text.split(" ")
        got = list(map(self.memo.get, parts))
        got[0] = self._first(parts[0]) if parts[0] else b""
        if None in got:
            known, spaced = self.memo.get, self._spaced
            got = [(known(p) or spaced(p)) if g is None else g for p, g in zip(parts, got)]
        return np.frombuffer(b"".join(got), dtype=self.dtype)

    def _line(self, part: str) -> bytes:
        """A newline and the part that follows it."""
        got = self.lines.get(part)
        if got is None:
            if len(self.lines) > 1 << 17:
                self.lines.clear()
            got = self.lines[part] = self.newline + self._first(part[1:])
        return got

    def _looked_up(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without doubtful white space: each different part is looked up once."""
        if len(self.memo) > self.limit:
            self.memo.clear()
        # a newline between two other characters is a piece of its own: it opens a part of its own here
        apart = [t.replace("\n", " \n") if "\n" in t and "\n\n" not in t and t[0] != "\n" and t[-1] != "\n" else t for t in texts]
        split = pc.split_pattern(pa.array(apart, pa.string()), " ")
        parts, bounds = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        stems = pc.ascii_rtrim(parts.dictionary, characters=_SIGNS)
        signed = pc.match_substring_regex(stems, _STEM)
        tails = pc.replace_substring_regex(pc.if_else(signed, parts.dictionary, ""), _SIGNLESS, "").dictionary_encode()
        stems = pc.if_else(signed, stems, parts.dictionary).dictionary_encode()
        different = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, spaced, line = list(map(self.memo.get, different)), self._spaced, self._line
        ids = [(line(p) if p[0] == "\n" else spaced(p)) if g is None else g for g, p in zip(ids, different)]
        tail_ids = pa.array([self._tail(t) for t in tails.dictionary.to_pylist()], pa.binary())
        ids = pc.binary_join_element_wise(pa.array(ids, pa.binary()).take(stems.indices), tail_ids.take(tails.indices), b"")
        codes = parts.indices.to_numpy().copy()
        codes[bounds[:-1]] = np.arange(len(ids), len(ids) + len(texts))  # no space stands before a text's first part
        firsts = pa.array([self._first(t.split(" ", 1)[0]) for t in apart], pa.binary())
        got = pa.concat_arrays([ids, firsts]).take(pa.array(codes))
        ends = np.frombuffer(got.buffers()[1], dtype=np.int32)[bounds] // np.dtype(self.dtype).itemsize
        flat = np.frombuffer(got.buffers()[2], dtype=self.dtype, count=int(ends[-1]))
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def ids_of(self, texts: list[str | None]):
        """``ids`` of each text in order, some ``SLICE_CHARS`` at a time."""
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and size < SLICE_CHARS:
                size += len(texts[hi] or "")
                hi += 1
            some = texts[lo:hi]
            plain = [bool(t) and len(t) <= SLICE_CHARS and not self._doubtful(t) for t in some]
            found = iter(self._looked_up([t for t, p in zip(some, plain) if p]) if any(plain) else ())
            for t, p in zip(some, plain):
                yield next(found) if p else self.ids(t)
            lo = hi

    @staticmethod
    def _doubtful(text: str) -> bool:
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            return True
        return not text.replace("\n", " ").isprintable() and bool(_RARE.search(text))  # no rare white space is printable


@lru_cache(maxsize=2)
def byte_encoder(path: str | None = None) -> ByteEncoder:
    """The encoder of this worker process: its memo serves all tasks that the worker runs."""
    return ByteEncoder(path)
