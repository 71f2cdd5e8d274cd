"""Ids of whole texts by the tokenizers library, for batches of texts.

The BPE model merges inside a pre-token only, so a pre-token has the same ids
wherever it stands. A text is cut where pre-tokens surely end, the distinct
pieces of a batch are looked up in a table of bounded size, and only new pieces
go through the library, all in one text, with separators where a piece does not
begin a pre-token by itself. Texts with unusual white space are encoded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Pieces and bytes of them that a worker's table holds, about; of a full one the rare pieces go. New pieces are learned so many at a time.
MOST_PIECES, MOST_BYTES, AT_ONCE = 700_000, 32 << 20, 16_384

_MARK = "\x01"
#: Stands between pieces where white space is dropped.
_STOP = "\x02"
#: Texts that are cut nowhere: doubled, leading or trailing white space, white space other than blank and line feed, or a mark.
_ODD = r"[ \n][ \n]|^[ \n]|[ \n]$|[\t\x0b\x0c\r\x01\x02\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _joined(texts: pa.Array, between: str) -> str:
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(texts)], texts), pa.scalar(between, pa.large_string()))[0].as_py()


class Encoder:
    """Encodes batches with one vocabulary file; byte-level pre-tokens keep the blank before a word, others drop white space."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.lowers = self.whole.normalizer is not None
        # a lone line feed is a pre-token of its own between pieces, and so is the stop between blanks
        self.between = f" {_STOP} " if self.lowers else "\n"
        (self.stop,) = self.whole.encode(self.between, add_special_tokens=False).ids
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        #: Bytes of each id's text, where every byte has an id: these tell the pieces of a text apart without separators.
        self.width = None
        if not self.lowers and vocabulary.keys() >= set(ByteLevel.alphabet()):
            added = {i: len(t.content.encode()) for i, t in self.whole.get_added_tokens_decoder().items()}
            width = added | {i: len(t) for t, i in vocabulary.items()}
            self.width = np.zeros(max(width) + 1, np.int64)
            self.width[list(width)] = list(width.values())
        # the empty piece and a lone line feed are always in the table
        alone = [np.empty(0, np.uint32), self.text_ids("\n")]
        self.pieces, self.seen = pa.array(["", "\n"], pa.large_string()), np.zeros(2, np.int64)
        self.flat, self.bounds = np.concatenate(alone), np.cumsum([0, *map(len, alone)])

    def text_ids(self, text: str) -> np.ndarray:
        # the batch call keeps no offsets, which takes half as long
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces end to end, and the number of each one's ids; none is empty or holds a separator."""
        if self.width is None:
            ids = self.text_ids(_joined(pieces, self.between))
            ends = np.append(np.flatnonzero(ids == self.stop), len(ids))
            if len(ends) != len(pieces):
                raise ValueError("a piece holds a separator")
            return ids[ids != self.stop], np.diff(ends, prepend=-1) - 1
        # a blank before a word starts a pre-token anyway, so only other pieces need the separator
        led = pc.starts_with(pieces, " ")
        text = pc.if_else(led, pieces, pc.replace_substring_regex(pieces, "^", self.between))
        ids = self.text_ids(_joined(text, ""))
        ends, places = np.cumsum(pc.binary_length(text).to_numpy()), np.cumsum(self.width[ids])
        last = np.searchsorted(places, ends)
        if len(places) != last[-1] + 1 or not np.array_equal(places[last], ends):
            raise ValueError("an id crosses the end of a piece")
        bare = ~led.to_numpy(zero_copy_only=False)
        first = np.append(0, last[:-1] + 1)
        if (ids[first[bare]] != self.stop).any():
            raise ValueError("a separator is not an id of its own")
        return np.delete(ids, first[bare]), last + 1 - first - bare

    def _shrink(self) -> None:
        """Once the table is full, keep the pieces of most batches, half of what it holds at most."""
        size = pc.binary_length(self.pieces).to_numpy()
        if len(size) <= MOST_PIECES and size.sum() <= MOST_BYTES:
            return
        least, kept = 2, self.seen >= 2
        while 2 * kept.sum() > MOST_PIECES or 2 * size[kept].sum() > MOST_BYTES:
            least *= 2
            kept = self.seen >= least
        kept[:2] = True
        count = np.diff(self.bounds)
        self.flat = self.flat[np.repeat(kept, count)]
        self.bounds = np.append(0, np.cumsum(count[kept]))
        self.pieces, self.seen = self.pieces.filter(pa.array(kept)), np.ones(int(kept.sum()), np.int64)

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each of these distinct pieces in the table."""
        self._shrink()
        # looked up the other way round, as Arrow makes a hash table of its second argument, which is smaller
        places = pc.fill_null(pc.index_in(self.pieces, pieces), -1).to_numpy()
        known, numbers = np.flatnonzero(places >= 0), np.full(len(pieces), -1)
        numbers[places[known]] = known
        new = numbers < 0
        fresh = pieces.filter(pa.array(new))
        numbers[new] = np.arange(len(self.pieces), len(self.pieces) + len(fresh))
        if len(fresh):
            got = [self._ids_of(fresh.slice(at, AT_ONCE)) for at in range(0, len(fresh), AT_ONCE)]
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in got)])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate([n for _, n in got]))])
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.seen = np.append(self.seen, np.zeros(len(fresh), np.int64))
        self.seen[numbers] += 1
        return numbers

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Texts with a mark between pieces: before a blank, around a line feed, and before a lone . or , after a letter."""
        texts = pc.replace_substring_regex(texts, r"(\pL)([.,])([ \n])", r"\1" + _MARK + r"\2\3")
        texts = pc.replace_substring_regex(texts, r"(\pL)([.,])$", r"\1" + _MARK + r"\2")
        if self.lowers:
            texts = pc.ascii_lower(texts)
            return pc.replace_substring(pc.replace_substring(texts, " ", _MARK), "\n", _MARK)
        return pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", f"{_MARK}\n{_MARK}")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and each text's offsets in them; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        clean = pc.if_else(pa.array(odd), "", texts)
        lists = pc.split_pattern(self._cut(clean), _MARK)
        coded = lists.flatten().dictionary_encode()
        known = self._numbers(coded.dictionary)
        codes = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, np.int64)
        start, size = self.bounds[codes], self.bounds[codes + 1] - self.bounds[codes]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = lists.offsets.to_numpy().astype(np.int64)
        offsets = np.concatenate([[0], ends])[bounds - bounds[0]]
        if odd.any():
            parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for i in np.flatnonzero(odd):
                parts[i] = self.text_ids(texts[int(i)].as_py())
            ids, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary file, with its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text."""
    return np.insert(ids, offsets[1:], np.uint32(end)), offsets + np.arange(len(offsets))
