"""Byte-level BPE by prefix dynamic programming.

A word's encoding is determined from left to right: the encoding of a prefix is that of a shorter
prefix and one more token, and exactly one token of the vocabulary that ends there stands the test
that no merge crosses the seam to the token before it. A table of the last token and of the number
of tokens at each prefix is therefore filled in one pass, and nothing is ever encoded again.

The seam between two tokens holds if, while both are built up from bytes, no pair of a part that
touches the seam from the left and one that touches it from the right is merged before its own
token takes in either part (of equal merges the left one goes first).
"""

from __future__ import annotations

import json
import os
from array import array

import ahocorasick
import regex

_NEVER = 1 << 60

#: how byte-level BPE cuts a text into words, for a text that does not end in white space, but
#: that a run of white space stays with the word behind it, on which its cut depends
_PARTS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s(?!\s)"
    r"|\s{2,}(?:(?<! )(?:'s|'t|'re|'ve|'m|'ll|'d)|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)"
)
#: the characters of \s
_SPACES = "".join(c for c in map(chr, range(0x3001)) if regex.match(r"\s", c))
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
#: characters whose class is the same in every Unicode version a tokenizer may have been built with
_SETTLED = regex.compile(
    "[\u0000-ԯא-תء-ي٠-ۓअ-हก-ะḀ-ᾼ"
    " -⁰₠-₿℀-⅏←-➿　-〿ぁ-ゖァ-ヺ"
    "一-鿕가-힣︰-﹏！-ﾟ�\U0001f300-\U0001f64f"
    "\U0001f900-\U0001f9ff]*"
)


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_file(path: str) -> tuple[dict, dict[str, int], dict[int, bytes]]:
    """A byte-level BPE file of the tokenizers library: all of it, the ids of its special tokens,
    and the bytes of its other tokens by id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = spec["model"]["vocab"].items()
    return spec, special, {
        i: bytes(letters[c] for c in name) for name, i in names if name not in special
    }


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        spec, self.special, self.bytes = read_file(path)
        names = spec["model"]["vocab"]
        self.size = max([*names.values(), *self.special.values()]) + 1
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = names[left], names[right]
            self.rank[pair] = rank
            parts.setdefault(names[left + right], pair)
        self.parts = parts
        self.length = {i: len(b) for i, b in self.bytes.items()}
        self.found = ahocorasick.Automaton()
        for i, b in self.bytes.items():
            self.found.add_word(b.decode("latin-1"), (i, len(b)))
        self.found.make_automaton()
        self._seams: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token that touch its left (0) or right (1) end, and the rank of the
        merge that takes each in."""
        found = self._edges[side].get(token)
        if found is None:
            found, part, taken = [], token, _NEVER
            while True:
                found.append((part, taken))
                if part not in self.parts:
                    break
                pair = self.parts[part]
                part, taken = pair[side], self.rank[pair]
            self._edges[side][token] = found
        return found

    def seam_holds(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens ``a`` and ``b`` on end are encoded as just these two."""
        key = a * self.size + b
        known = self._seams.get(key)
        if known is None:
            known = not any(
                rank < taken_a and rank <= taken_b
                for x, taken_a in self._edge(a, 1)
                for y, taken_b in self._edge(b, 0)
                if (rank := self.rank.get((x, y))) is not None
            )
            if len(self._seams) > 2_000_000:
                self._seams.clear()
            self._seams[key] = known
        return known

    def prefixes(self, word: bytes) -> tuple[list[int], list[int]]:
        """Number of tokens and last token of each prefix of one word's bytes, from the empty
        one on."""
        counts, last = [0] * (len(word) + 1), [-1] * (len(word) + 1)
        seams, size = self._seams.get, self.size
        for end, (token, length) in self.found.iter(word.decode("latin-1")):
            end += 1
            if counts[end]:
                continue
            begin = end - length
            if begin:
                holds = seams(last[begin] * size + token)
                if not (self.seam_holds(last[begin], token) if holds is None else holds):
                    continue
            counts[end] = counts[begin] + 1
            last[end] = token
        return counts, last

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word, read back from the table."""
        _, last = self.prefixes(word)
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= self.length[last[at]]
        return ids[::-1]


class PrefixCounter:
    """Number of tokens of every prefix of a text, in code points.

    A text is given as one signed byte per code point: how many tokens its prefix has more than
    the one before. Words, and what lies between two spaces, are looked up in tables.
    """

    #: entries of each table
    entries = 400_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.parts: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def steps(self, text: str) -> bytes:
        """The steps of a text, special tokens included."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            # up to its last character the special token is ordinary text
            size = found.start() - at
            steps = self._plain(text[at : found.end() - 1])
            counts = array("b", steps)
            out += [steps, array("b", [1 - sum(counts[size:])]).tobytes()]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        if not _SETTLED.fullmatch(text):
            return self._by_library(text)
        body = text.rstrip(_SPACES)
        tail = text[len(body) :]
        if regex.search(r"\s ", body):
            out = [self._part(p) for p in _PARTS.findall(body)]
        else:
            first, *chunks = body.split(" ")
            chunk = self.chunks
            missing = set(chunks).difference(chunk)
            if len(chunk) + len(missing) > self.entries:  # short ones are the common ones
                self.chunks = chunk = {c: s for c, s in chunk.items() if len(c) <= 7}
                missing = set(chunks).difference(chunk)
            for c in missing:
                chunk[c] = b"".join([self._part(p) for p in _PARTS.findall(" " + c)])
            out = [*[self._part(p) for p in _PARTS.findall(first)], *[chunk[c] for c in chunks]]
            for c in missing:
                if len(c) > 100:
                    del chunk[c]
        if tail:
            out.append(_steps(tail, self.vocabulary.prefixes(tail.encode())[0]))
        return b"".join(out)

    def _by_library(self, text: str) -> bytes:
        """Texts with characters whose class may have changed: cut into words by the library.

        The cut of a run of white space at its end, and the seam inside a contraction, are those
        of :meth:`_part`; only the classes come from the library.
        """
        spans = [span for _, span in self.cutter.pre_tokenize_str(text)]
        out, at = [], 0
        while at < len(spans):
            last = at
            # a run of white space is cut before its last character: take the pieces together
            while not text[slice(*spans[last])].strip(_SPACES) and last + 1 < len(spans):
                last += 1
            out.append(self._part(text[spans[at][0] : spans[last][1]]))
            at = last + 1
        return b"".join(out)

    def _part(self, part: str) -> bytes:
        known = self.parts.get(part)
        if known is None:
            known = _steps(part, self._counts(part))
            if len(part) <= 64:
                if len(self.parts) >= self.entries:
                    self.parts = {p: s for p, s in self.parts.items() if len(p) <= 7}
                self.parts[part] = known
        return known

    def _counts(self, part: str) -> list[int]:
        """Number of tokens at each byte of a word, or of a run of white space and a word."""
        prefixes = self.vocabulary.prefixes
        run = part[: len(part) - len(part.lstrip(_SPACES))]
        if len(run) > 1 and len(run) < len(part):
            counts = prefixes(run.encode())[0]
            base = counts[len(run[:-1].encode())]
            word = part[len(run) :]
            if run[-1] == " ":
                return counts + [base + n for n in prefixes((" " + word).encode())[0][2:]]
            base += prefixes(run[-1].encode())[0][-1]
            return counts + [base + n for n in self._counts(word)[1:]]
        counts = prefixes(part.encode())[0]
        if part in _LONG_CONTRACTIONS:
            counts[2] = 2  # before its last letter it is an apostrophe and a word
        return counts


def _steps(text: str, counts: list[int]) -> bytes:
    """Differences of the counts from one code point to the next, as signed bytes."""
    if len(counts) > len(text) + 1:
        ends, at = [0], 0
        for c in text:
            at += 1 if c < "\x80" else 2 if c < "ࠀ" else 3 if c < "\U00010000" else 4
            ends.append(at)
        counts = [counts[k] for k in ends]
    return array("b", [b - a for a, b in zip(counts, counts[1:])]).tobytes()
