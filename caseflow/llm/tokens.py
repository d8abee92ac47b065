"""Token ids of whole texts by the public tokenizers, for the operators that need them.

The byte-level vocabulary cuts a text before every blank that follows a
non-blank, so a single blank between two other characters is always a cut.
The ids of such a unit depend on the unit alone; each Python worker remembers
those it has seen, up to a bound, and asks the tokenizers library for the rest,
many units in one text: their ids are told apart by the tokens that begin with
a blank.  The vocabulary also cuts between a letter and the marks that close a
unit, so these are looked up apart: a word with and without a comma is one.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units one worker remembers in each of two generations: when the young one is
#: full it becomes the old one, and units found there move on to the next.
REMEMBERED = 600_000
#: Texts cut into units at a time.
TEXTS = 1000
#: Units asked for at a time.
ASKED = 1000
_ODD = re.compile(r"^\s|\s$|[\x1c-\x1f]")
#: How the vocabulary writes a blank.
_BLANK = "\u0120"
#: Stands for the ids of a unit that can't stand alone; no ids have its length.
STRANGE = b"\0"
#: Marks that close a unit: neither letters, digits nor blanks; without the apostrophe, which can begin a token of letters.
CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_WORKER: dict[tuple, "Encoder"] = {}


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file, as this machine has it."""
    import public_tokenizers
    return public_tokenizers.path(name) if not os.path.isabs(name) else name


class Encoder:
    """ids of texts as bytes, four little-endian bytes an id."""

    def __init__(self, name: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(tokenizer_file(name))
        self.lib.encode_special_tokens = True
        vocab = self.lib.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)  # ids of tokens that begin with a blank
        self.opens[[i for t, i in vocab.items() if t.startswith(_BLANK)]] = True
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.remembered = remembered

    def _bulk(self, units: list[str]) -> list[bytes]:
        """ids of units that stand alone, asked for many at a time: each begins with its blank."""
        out = []
        for i in range(0, len(units), ASKED):
            some = units[i:i + ASKED]
            ids = np.frombuffer(self._ask([" " + " ".join(some)])[0], "<u4")
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) != len(some):
                out += self._ask([" " + u for u in some])
                continue
            data, edges = ids.tobytes(), (4 * np.r_[begin, len(ids)]).tolist()
            out += [data[x:y] for x, y in zip(edges, edges[1:])]
        return out

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object for each text; an empty text has no ids."""
        ids, edges = self.encode_flat(pa.array(texts, pa.large_string()))
        data, edges = ids.tobytes(), (4 * edges).tolist()
        return [data[i:j] for i, j in zip(edges, edges[1:])]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and the last ones end); null as empty.

        A bounded number of texts is cut at a time, by Arrow; only their
        distinct units are looked up, and the ids are gathered by NumPy.  A
        text is held whole, as some five numbers a unit.
        """
        texts = texts.cast(pa.large_string())
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(texts), TEXTS):
            flat, n = self._gather(pc.fill_null(texts.slice(i, TEXTS), ""))
            ids.append(flat)
            counts.append(n)
        return np.concatenate(ids), np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int64)

    def _gather(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        begin = lists.offsets.to_numpy().astype(np.int64)
        begin, n_units = begin[:-1] - begin[0], int(begin[-1] - begin[0])
        coded = pc.dictionary_encode(lists.flatten())
        code = coded.indices.to_numpy().astype(np.int64)
        piece, first, last = _pieces(coded.dictionary)
        # the first unit has no blank before it: "\0" marks it; a text that holds "\0" is asked for whole
        heads, place = np.unique(code[begin], return_inverse=True)
        code[begin] = len(first) + place
        first, last = np.r_[first, len(piece) + np.arange(len(heads))], np.r_[last, np.full(len(heads), -1)]
        piece += ["\0" + u for u in coded.dictionary.take(pa.array(heads)).to_pylist()]
        # from units to pieces: one, or two where marks close the unit
        two = last[code] >= 0
        end = np.cumsum(1 + two)
        begin, marks, n_units = (end - 1 - two)[begin], last[code[two]], n_units + int(two.sum())
        code = np.repeat(first[code], 1 + two)
        code[end[two] - 1] = marks
        found = self._look_up(piece)
        size = np.array(list(map(len, found)), np.int64)
        whole = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        whole |= np.logical_or.reduceat((size == len(STRANGE))[code], begin)
        rows = np.flatnonzero(whole)
        if len(rows):  # a unit that can't stand alone: the text's units give nothing, its first one all ids
            of = np.repeat(np.arange(len(texts)), np.diff(np.r_[begin, n_units]))
            code[whole[of]] = len(found)
            code[begin[rows]] = len(found) + 1 + np.arange(len(rows))
            found = [b"" if x is STRANGE else x for x in found]
            found += [b"", *self._ask(texts.take(pa.array(rows)).to_pylist())]
            size = np.array(list(map(len, found)), np.int64)
        elif (size == len(STRANGE)).any():  # a first unit's other form, which no text has
            found = [b"" if x is STRANGE else x for x in found]
        size //= 4
        pool, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        n = size[code]
        place = np.repeat(start[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return pool[place], np.add.reduceat(n, begin)

    def _look_up(self, units: list[str]) -> list[bytes]:
        """ids of each of the distinct units, remembered or asked for; ``STRANGE`` where a unit can't stand alone."""
        if len(self.known) > self.remembered:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        found = list(map(known.get, units))
        heads, inner = [], []
        for i, x in enumerate(found):
            if x is None:
                u = units[i]
                found[i] = x = old.get(u)
                if x is not None:
                    known[u] = x
                elif not u or "\0" in u[1:] or (u.split() != [u] and _ODD.search(u)):
                    found[i] = known[u] = STRANGE
                else:
                    (heads if u[0] == "\0" else inner).append(i)
        asked = self._ask([units[i][1:] for i in heads]) + self._bulk([units[i] for i in inner])
        for i, x in zip(heads + inner, asked):
            found[i] = known[units[i]] = x
        return found


def _pieces(units: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, each unit's first piece, its last or -1): marks that follow a letter are a piece of their own.

    Such marks have no blank before them and begin with "\\0".  Letters are
    those of ASCII and Latin-1; other units are left whole.
    """
    edge = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)
    stems = pc.ascii_rtrim(units, characters=CLOSING)
    size = pc.binary_length(stems).to_numpy().astype(np.int64)
    end = edge[:-1] + size
    cut = np.flatnonzero((end < edge[1:]) & (size > 0))
    at, before = data[end[cut] - 1], data[np.maximum(end[cut] - 2, 0)]
    plain = ((at | 32) >= ord("a")) & ((at | 32) <= ord("z"))
    latin = (at >= 128) & (before == 0xC3) & (at != 0x97) & (at != 0xB7)  # all but the signs of times and division
    cut = cut[plain | latin]
    mask = np.zeros(len(units), bool)
    mask[cut] = True
    firsts = pc.dictionary_encode(pc.if_else(pa.array(mask), stems, units))
    n = edge[1:][cut] - end[cut]
    marks = data[np.repeat(end[cut] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    marks = pc.dictionary_encode(pa.LargeStringArray.from_buffers(
        len(cut), pa.py_buffer(np.r_[0, np.cumsum(n)].astype(np.int64)), pa.py_buffer(marks)))
    last = np.full(len(units), -1, np.int64)
    last[cut] = len(firsts.dictionary) + marks.indices.to_numpy()
    return (firsts.dictionary.to_pylist() + ["\0" + m for m in marks.dictionary.to_pylist()],
            firsts.indices.to_numpy().astype(np.int64), last)


def encoder(name: str) -> Encoder:
    """The encoder of this worker process."""
    if (name,) not in _WORKER:
        _WORKER[name,] = Encoder(name)
    return _WORKER[name,]
