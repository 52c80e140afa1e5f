"""Subword ids of whole texts by the files of public tokenizers, by way of their distinct chunks.

A tokenizer spends its time on merging, so a text is cut at blanks where that changes no id, Arrow
finds the distinct chunks of many texts, only those are encoded, and numpy puts the ids together.
Nothing is kept between calls, so memory depends on the texts of one call alone.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from auricle.llm.common import per_worker, slices

#: Chunks that are encoded as one text.
TOGETHER = 2000
#: Chunks whose ids are put together at a time.
GATHERED = 1 << 17
#: A blank between two characters that are not white space starts a new pre-token of the byte-level
#: BPE pattern, so a text may be cut there and its parts encoded apart. U+180E was white space in
#: old Unicode versions, so no cut is made beside it.
_WHITE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_UNSAFE = rf" {_WHITE}|{_WHITE} |^ | $"
_LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
#: Letters and the marks after them are pre-tokens of their own in either vocabulary. The
#: apostrophe is left out, as it may begin a contraction, and so are the brackets of special tokens.
_WORD = rf"^[{_LETTERS}]+$"
_MARKED = rf"^([{_LETTERS}]+)([!-&(-;=?@\[-`{{}}~]+)$"


class _Texts:
    """Encodes whole texts exactly as a tokenizer file does.

    Marks of special tokens in a text become their ids, as the library does by default.
    """

    #: What stands before each chunk of a text.
    before = ""

    def __init__(self, path: str):
        # one thread: the tasks of an executor share its cores already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._edge[[number for token, number in vocabulary.items() if self._at_edge(token)]] = True

    def _at_edge(self, token: str) -> bool:
        """Whether just the first, or just the last, id of a chunk can look like this."""
        raise NotImplementedError

    def _bounds(self, edges: np.ndarray, size: int) -> np.ndarray:
        """Where chunks begin and end, from the places of such ids."""
        raise NotImplementedError

    def alone(self, texts: list[str]) -> list[np.ndarray]:
        made = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4") for one in made]

    def _together(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks encoded as one text; one by one where its ids cannot be told apart."""
        (ids,) = self.alone([self.before + " ".join(chunks)])
        at = self._bounds(np.flatnonzero(self._edge[ids]), len(ids))
        if len(at) != len(chunks) + 1:
            return self.alone([self.before + chunk for chunk in chunks])
        return np.split(ids, at[1:-1])

    def _encode_distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one after another, and the place of each chunk's first."""
        raise NotImplementedError

    def _flat(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.concatenate(found) if found else np.zeros(0, dtype="<u4")
        return ids, np.append(0, np.cumsum(sizes))

    def _joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        listed = chunks.to_pylist()
        found: list[np.ndarray] = []
        for low in range(0, len(listed), TOGETHER):
            found += self._together(listed[low : low + TOGETHER])
        return self._flat(found)

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As _encode_distinct: letters and the marks after them are encoded once each."""
        marked = pc.match_substring_regex(chunks, _MARKED)
        stems = pc.replace_substring_regex(chunks, _MARKED, r"\1")
        marks = pc.if_else(marked, pc.replace_substring_regex(chunks, _MARKED, r"\2"), "")
        stems, marks = self._folded(stems).dictionary_encode(), marks.dictionary_encode()
        ids, at = self._encode_distinct(stems.dictionary)
        more, more_at = self._flat(self.alone(marks.dictionary.to_pylist()))
        stem, mark = stems.indices.to_numpy(), marks.indices.to_numpy()
        return _gather(
            np.concatenate([ids, more]),
            np.stack([at[stem], len(ids) + more_at[mark]], axis=1).ravel(),
            np.stack([np.diff(at)[stem], np.diff(more_at)[mark]], axis=1).ravel(),
            2 * np.arange(len(chunks) + 1),
        )

    def _folded(self, chunks: pa.Array) -> pa.Array:
        return chunks

    def _chunked(self, chunks: pa.Array, bounds: np.ndarray) -> list[bytes]:
        """Ids of texts as bytes; text k has the chunks from bounds[k] to bounds[k + 1]."""
        coded = chunks.dictionary_encode()
        ids, at = self._distinct(coded.dictionary)
        which, size = coded.indices.to_numpy(), np.diff(at)
        out: list[bytes] = []
        # what puts ids together takes many times their room, so it has some of the texts at a time
        for low, high in slices(np.diff(bounds).tolist(), GATHERED):
            part = which[bounds[low] : bounds[high]]
            made, ends = _gather(ids, at[part], size[part], bounds[low : high + 1] - bounds[low])
            raw = made.tobytes()
            ends = (4 * ends).tolist()
            out += [raw[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as bytes. A null text has none."""
        raise NotImplementedError


def _gather(
    ids: np.ndarray, begin: np.ndarray, size: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs ids[begin : begin + size] one after another, and where run number bounds[k] starts."""
    ends = np.append(0, np.cumsum(size))
    shift = np.repeat(begin - ends[:-1], size)
    return ids[shift + np.arange(ends[-1])], ends[bounds]


class Chunked(_Texts):
    """A byte-level BPE file. A chunk is what follows a blank, up to the next one; what stands before
    the first is encoded by itself, and so are texts in which a blank is beside other white space."""

    before = " "

    def _at_edge(self, token: str) -> bool:
        return token.startswith("Ġ")  # how these vocabularies write a blank, the start of a chunk

    def _bounds(self, edges: np.ndarray, size: int) -> np.ndarray:
        return np.append(edges, size)

    def _encode_distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._joined(chunks)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        unsafe = pc.match_substring_regex(texts, _UNSAFE)
        out = np.empty(len(texts), dtype=object)
        whole = np.flatnonzero(unsafe.to_numpy(zero_copy_only=False))
        for row in whole:  # one at a time: such texts may be long
            out[row] = self.alone([texts[row].as_py()])[0].tobytes()
        rows = np.setdiff1d(np.arange(len(texts)), whole)
        lists = pc.split_pattern(texts.filter(pc.invert(unsafe)), " ")
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        chunks = lists.flatten()
        first = np.zeros(len(chunks), dtype=bool)
        first[at[:-1]] = True
        begin = self.alone(chunks.filter(pa.array(first)).to_pylist())
        rest = chunks.filter(pa.array(~first))
        for row, head, tail in zip(rows, begin, self._chunked(rest, at - np.arange(len(at)))):
            out[row] = head.tobytes() + tail
        return out.tolist()


class Spaced(_Texts):
    """A BPE file with word ends that drops white space and case.

    No pre-token holds white space and nothing is normalised across it, so a text may be cut at
    every blank, tab and line feed.
    """

    def _at_edge(self, token: str) -> bool:
        return token.endswith("</w>")

    def _bounds(self, edges: np.ndarray, size: int) -> np.ndarray:
        return np.append(0, edges + 1)

    def _folded(self, chunks: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(chunks, "^[A-Za-z]+$")
        return pc.if_else(plain, pc.ascii_lower(chunks), chunks)

    def _encode_distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # a word of letters has one end, and so can be told apart from others beside it
        word = pc.match_substring_regex(chunks, _WORD).to_numpy(zero_copy_only=False)
        ids, at = self._joined(chunks.filter(pa.array(word)))
        other, other_at = self._flat(self.alone(chunks.filter(pa.array(~word)).to_pylist()))
        begin = np.zeros(len(chunks), dtype=np.int64)
        size = np.zeros(len(chunks), dtype=np.int64)
        begin[word], size[word] = at[:-1], np.diff(at)
        begin[~word], size[~word] = len(ids) + other_at[:-1], np.diff(other_at)
        return _gather(np.concatenate([ids, other]), begin, size, np.arange(len(chunks) + 1))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        for mark in "\n\t":
            texts = pc.replace_substring(texts, mark, " ")
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return self._chunked(lists.flatten(), at)


def encoder(path: str) -> Chunked:
    """One encoder of byte-level BPE per Python worker and file."""
    return per_worker(("chunked", path), lambda: Chunked(path))


def spaced_encoder(path: str) -> Spaced:
    """One encoder of BPE with word ends per Python worker and file."""
    return per_worker(("spaced", path), lambda: Spaced(path))
