"""Token ids of whole texts by the ``tokenizers`` library, in Spark tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a Python worker remembers at most, besides those of the texts at hand.
REMEMBERED = 500_000
#: Bytes of texts that are taken apart at a time.
TOGETHER = 4 << 20

#: Texts that are encoded whole: white space next to white space or at an end, or other than a space and a line feed, or the mark itself.
ODD = r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\x01\t\r\v\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Stands where a text is cut: before a space or line feed, and between a letter and the punctuation that ends a word.
MARK = "\x01"
AFTER_WORD = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids as ``encode(text, add_special_tokens=False)`` gives them.

    A byte-level tokenizer with the usual pattern always cuts before a single space or line feed between two characters that
    are no white space, and between a letter and a full stop or the like. So such pieces have ids of their own, whatever stands
    around them. The pieces of many texts are told apart at once, the library sees each distinct one once, and its ids are put in
    all its places. Pieces are remembered until they are too many; then only those met last stay. Texts that hold an added token's string, or that are ``ODD``, are encoded by the library as they are.
    """

    def __init__(self, path: str):
        self.library = _tokenizer(path)
        # In a byte-level vocabulary each character of an entry stands for one byte.
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for entry, number in vocabulary.items():
            self.widths[number] = len(entry)
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.whole = "|".join([ODD, *added])
        self.known = pa.array([], pa.large_string())
        self.known_ids = pa.LargeListArray.from_arrays([0], pa.array([], pa.uint32()))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learned(self, pieces: pa.Array) -> pa.LargeListArray:
        """Ids of distinct pieces. Those that start with a space or line feed are one text for the library: they keep their ids side by
        side, and the bytes of the ids tell where each ends."""
        led = pc.match_substring_regex(pieces, r"\A[ \n]").to_numpy(zero_copy_only=False)
        joined = self._ids("".join(pieces.filter(pa.array(led)).to_pylist())) if led.any() else np.empty(0, np.uint32)
        alone = [e.ids for e in self.library.encode_batch_fast(pieces.filter(pa.array(~led)).to_pylist(), add_special_tokens=False)]
        sizes = np.zeros(len(pieces), np.int64)
        sizes[~led] = [len(ids) for ids in alone]
        ends = np.searchsorted(np.cumsum(self.widths[joined]), np.cumsum(pc.binary_length(pieces).to_numpy()[led])) + 1
        sizes[led] = np.diff(ends, prepend=0)
        of_led = np.repeat(led, sizes)
        values = np.empty(len(of_led), np.uint32)
        values[of_led] = joined
        values[~of_led] = [i for ids in alone for i in ids]
        return pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))), pa.array(values))

    def _looked_up(self, pieces: pa.Array) -> pa.LargeListArray:
        """Ids of distinct pieces."""
        place = pc.index_in(pieces, value_set=self.known)
        missing = pieces.filter(place.is_null())
        if len(missing):
            everything = pa.concat_arrays([self.known, missing])
            ids = pa.concat_arrays([self.known_ids, self._learned(missing)])
            place = pc.replace_with_mask(place, place.is_null(), pa.array(np.arange(len(self.known), len(everything), dtype=np.int32)))
        else:
            everything, ids = self.known, self.known_ids
        found = ids.take(place)
        self.known, self.known_ids = (everything, ids) if len(everything) <= REMEMBERED else (pieces, found)
        return found

    def _even(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Texts that are not empty and may be cut."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", MARK + " "), "\n", MARK + "\n")
        words = pc.split_pattern(marked, MARK)
        distinct = words.values.dictionary_encode()
        parts = pc.split_pattern(pc.replace_substring_regex(distinct.dictionary, AFTER_WORD, r"\1" + MARK + r"\2"), MARK)
        pieces = parts.values.dictionary_encode()
        of_part = self._looked_up(pieces.dictionary).take(pieces.indices)
        of_word = pa.LargeListArray.from_arrays(of_part.offsets.take(parts.offsets), of_part.values)
        placed = of_word.take(distinct.indices)
        values, bounds = placed.values.to_numpy(), placed.offsets.to_numpy()[words.offsets.to_numpy()]
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield values[begin:end]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; none for an empty or a null one."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole, size = pc.match_substring_regex(texts, self.whole), pc.binary_length(texts).to_numpy()
        whole = whole.to_numpy(zero_copy_only=False)
        groups = np.cumsum(size) // TOGETHER
        for group in np.unique(groups).tolist():
            first, stop = np.searchsorted(groups, [group, group + 1]).tolist()
            part = texts.slice(first, stop - first)
            cut = ~whole[first:stop] & (size[first:stop] > 0)
            even = self._even(part.filter(pa.array(cut))) if cut.any() else iter(())
            for i in range(stop - first):
                yield next(even) if cut[i] else self._ids(part[i].as_py()) if size[first + i] else np.empty(0, np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(texts: pa.Array, path: str, end: int) -> Iterator[np.ndarray]:
    """The ids of each text and the end id."""
    last = np.array([end], np.uint32)
    for ids in encoder(path).encode(texts):
        yield np.concatenate((ids, last))
