"""Token ids of whole columns of text, through the installed tokenizer library.

Neither vocabulary joins text across certain places: before a single blank between visible
characters, around a single line feed between them, and between an ASCII letter and ASCII
punctuation other than an apostrophe. Texts are cut there and each distinct unit is encoded
once; units met before are remembered, up to a number of them. The ids are those of the
uncut text (``tests/llm`` compares them); only repeated work is saved.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken at a time; bounds the memory of a task, whatever a batch holds.
CHUNK_BYTES = 1 << 22
#: Units remembered by a worker, and units encoded at a time. Past the number, the half that
#: came up most often stays: words of a language recur, most others do not.
REMEMBERED, AT_ONCE = 600_000, 1_000

_ENCODERS: dict[str, Encoder] = {}
_LETTER, _MARK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = _MARK
#: First bytes of characters that may be wider white space.
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """A tokenizer that leaves threads to Spark and remembers units."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark_id, self.mark = _mark(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)
        self.seen = np.empty(0, np.int32)

    def make_room(self) -> None:
        """Keeps the half of the units that came up in most chunks."""
        order = np.sort(np.argsort(-self.seen, kind="stable")[: REMEMBERED // 2])
        starts = np.cumsum(self.sizes) - self.sizes
        self.known = self.known.take(pa.array(order))
        self.ids = _gather(self.ids, starts[order], self.sizes[order])
        # Halved, so that what came up long ago gives way.
        self.sizes, self.seen = self.sizes[order], self.seen[order] // 2

    def encode(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each unit has, and the ids one after the other.

        Units are encoded as one text with a special token between them, where the library
        cuts as between texts; one by one if a unit holds that token itself.
        """
        if self.mark is not None and not pc.any(pc.match_substring(units, self.mark)).as_py():
            whole = pa.ListArray.from_arrays([0, len(units)], units.cast(pa.string()))
            text = pc.binary_join(whole, self.mark)[0].as_py()
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = np.fromiter(found, np.uint32, len(found))
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) == len(units) - 1:
                return np.diff(marks, prepend=-1, append=len(ids)) - 1, np.delete(ids, marks)
        encoded = [
            e.ids for e in self.tokenizer.encode_batch_fast(units.to_pylist(), add_special_tokens=False)
        ]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return sizes, np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))

    def numbers(self, units: pa.LargeStringArray) -> np.ndarray:
        """The number under which each of these units is remembered."""
        # Remembered units come first, so that they keep their numbers.
        coded = pa.concat_arrays([self.known, units]).dictionary_encode()
        if len(coded.dictionary) > REMEMBERED:
            self.make_room()
            coded = pa.concat_arrays([self.known, units]).dictionary_encode()
        first, self.known = len(self.known), coded.dictionary
        numbers = coded.indices.slice(first).to_numpy().astype(np.int64)
        new = self.known.slice(first)
        if len(new):
            sizes, ids = [self.sizes], [self.ids]
            for at in range(0, len(new), AT_ONCE):
                own_sizes, own_ids = self.encode(new.slice(at, AT_ONCE))
                sizes.append(own_sizes)
                ids.append(own_ids)
            self.sizes, self.ids = np.concatenate(sizes), np.concatenate(ids)
            self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int32)])
        came = np.zeros(len(self.known), bool)
        came[numbers] = True
        self.seen += came
        return numbers


def _mark(tokenizer) -> tuple[int | None, str | None]:
    """A special token that is found wherever it stands and takes nothing beside it."""
    added = tokenizer.get_added_tokens_decoder()
    texts = [token.content for token in added.values()]

    def meet(left: str, right: str) -> bool:
        return any(left.endswith(right[:n]) for n in range(1, min(len(left), len(right))))

    for number, token in added.items():
        own, others = token.content, [x for x in texts if x != token.content]
        taken = token.lstrip or token.rstrip or token.single_word or token.normalized
        overlaps = any(meet(own, x) or meet(x, own) for x in texts)
        if token.special and not taken and not overlaps and not any(own in x for x in others):
            return number, own
    return None, None


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces of ``values`` one after the other."""
    stops = np.cumsum(lengths)
    if not len(stops):
        return values[:0]
    return values[np.repeat(starts - (stops - lengths), lengths) + np.arange(int(stops[-1]))]


def tokenizer(path: str) -> Encoder:
    """The encoder of a vocabulary file, one per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _give_back() -> None:
    """Returns freed memory to the system: a worker waits for its next task beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places where the bytes of a text can be cut."""
    if len(data) < 4:
        return np.empty(0, np.int64)
    space = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
    before, after = data[space - 1], data[space + 1]
    safe = (before > 0x20) & (after > 0x20) & ~_WIDE[after]
    # The last bytes of a wider white space character come 1 or 2 behind its first.
    safe &= ~((before >= 0x80) & (data[np.maximum(space - 2, 0)] == 0xC2))
    safe &= ~((before >= 0x80) & _WIDE[data[np.maximum(space - 3, 0)]])
    space = space[safe]
    cuts = [space, space[data[space] == 0x0A] + 1]
    # Special tokens are marked by <|; where they may stand, only white space is cut.
    if b"<|" not in data.tobytes():
        kind = _KIND[data]
        cuts.append(np.flatnonzero(kind[:-1] + kind[1:] == _LETTER + _MARK) + 1)
    return np.concatenate(cuts)


def encode_column(encoder: Encoder, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, ids, ends): ``ids`` of the rows one after the other,
    ``ends`` the place in ``ids`` where each row's ids end. NULL counts as empty text."""
    if len(texts) == 0:
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    all_bounds = np.frombuffer(texts.buffers()[1], np.int64)
    all_bounds = all_bounds[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(all_bounds, all_bounds[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        data = raw[all_bounds[first] : all_bounds[end]]
        bounds = all_bounds[first : end + 1] - all_bounds[first]
        if len(data):
            is_edge = np.zeros(len(data) + 1, bool)
            is_edge[bounds] = is_edge[_cuts(data)] = True
            edges = np.flatnonzero(is_edge)
            units = pa.LargeStringArray.from_buffers(
                len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))
            )
            numbers = encoder.numbers(units)
            lengths = encoder.sizes[numbers]
            stops = np.cumsum(lengths)
            places = (np.cumsum(encoder.sizes) - encoder.sizes)[numbers]
            ends = np.concatenate([[0], stops])[np.searchsorted(edges, bounds[1:])]
            yield first, end, _gather(encoder.ids, places, lengths), ends
        else:
            yield first, end, np.empty(0, np.uint32), np.zeros(end - first, np.int64)
        first = end
    # Nothing of the last chunk is held while memory is given back.
    data = raw = is_edge = edges = units = numbers = lengths = stops = places = ends = None
    _give_back()
