"""Token ids of whole texts by a word tokenizer, with the parts of words encoded once.

For tokenizers that split at white space before anything else and drop it, the ids of a text
are the ids of its words in a row. Arrow splits a batch of texts into words and finds the
distinct ones; a worker keeps the ids of what it has met and asks the library for new parts
only, many in one call. The ids are exactly those the library gives for the whole text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import give_back

#: Parts of words that a worker keeps, at some 200 bytes each.
KEPT = 1 << 19
#: Bytes of text that are worked on at once, and of new parts in one text for the library.
AT_ONCE, CHUNK = 1 << 20, 1 << 10
#: A word that only separates others; parts that contain it are encoded by themselves.
MARK = "\x00"
#: Latin letters, then ASCII marks other than the apostrophe: the tokenizer cuts between the two.
TWO_PARTS = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


@dataclass
class Encoded:
    """Ids of several texts: those of text i are ``ids[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray | None


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.parts: dict[str, bytes] = {}
        (self.mark,) = self.library.encode(MARK, add_special_tokens=False).ids

    def encode(self, texts: pa.Array, with_ids: bool = True) -> Encoded:
        """The ids of each text, or only how many; a null counts as empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends = words.offsets.to_numpy()
        ends = ends - ends[0]
        distinct = words.flatten().dictionary_encode()
        which = distinct.indices.to_numpy(zero_copy_only=False)
        cut = pc.extract_regex(distinct.dictionary, pattern=TWO_PARTS)
        whole = pc.is_null(cut)
        core = pc.if_else(whole, distinct.dictionary, pc.ascii_lower(pc.struct_field(cut, "core")))
        marks = pc.if_else(whole, "", pc.struct_field(cut, "marks"))
        parts = pa.concat_arrays([core, marks.cast(core.type)]).dictionary_encode()
        held = self._ids_of(parts.dictionary.to_pylist())
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // self.dtype.itemsize
        pair = parts.indices.to_numpy(zero_copy_only=False).reshape(2, -1)

        # Two parts per word of a text, in order; then the ids of each part.
        used = pair[:, which].T.reshape(-1) if len(which) else np.empty(0, np.int32)
        length = sizes[used]
        until = np.concatenate([[0], np.cumsum(length)])
        starts = until[2 * ends]
        ids = None
        if with_ids:
            pool = np.frombuffer(b"".join(held), dtype=self.dtype)
            at = np.concatenate([[0], np.cumsum(sizes)])[used]
            ids = pool[np.repeat(at - until[:-1], length) + np.arange(until[-1])]
        return Encoded(starts, np.diff(starts), ids)

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        if len(self.parts) > KEPT:
            self.parts.clear()
        known = self.parts
        known[""] = b""
        together: list[list[str]] = [[]]
        size = 0
        for part in parts:
            if part in known:
                continue
            if MARK in part or "<|" in part:
                known[part] = self._one(part)
                continue
            together[-1].append(part)
            size += len(part)
            if size > CHUNK:
                together.append([])
                size = 0
        self._learn([group for group in together if group])
        return [known[part] for part in parts]

    def _one(self, part: str) -> bytes:
        return np.array(self.library.encode(part, add_special_tokens=False).ids, self.dtype).tobytes()

    def _learn(self, groups: list[list[str]]) -> None:
        """Encode each group as one text with the mark between its parts."""
        for first in range(0, len(groups), 64):
            some = groups[first : first + 64]
            texts = [f" {MARK} ".join(group) for group in some]
            for group, found in zip(some, self.library.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(found.ids, dtype=self.dtype)
                ends = [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
                if len(ends) != len(group):
                    raise ValueError("the tokenizer does not keep words apart")
                start = 0
                for part, end in zip(group, ends):
                    self.parts[part] = ids[start:end].tobytes()
                    start = end + 1


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this file, one per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of some ``AT_ONCE`` bytes; a longer text is a slice of its own."""
    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    block = np.cumsum(sizes) // AT_ONCE
    firsts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    for first, end in zip(firsts, firsts[1:]):
        yield texts.slice(first, end - first)


def encode_batch(texts: pa.Array, path: str, with_ids: bool = True) -> Iterator[Encoded]:
    own = encoder(path)
    for piece in pieces(texts):
        yield own.encode(piece, with_ids)
    give_back()


def token_counts(path: str):
    """A function of a text column: the number of its ids."""

    def count(texts: pa.Array) -> pa.Array:
        lengths = [found.lengths for found in encode_batch(texts, path, with_ids=False)]
        return pa.array(np.concatenate([*lengths, np.empty(0, np.int64)]), pa.int64())

    return count
