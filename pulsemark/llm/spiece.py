"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

Spaces become the marker U+2581, with one before the text. A piece with a marker starts with it, so that a
text falls into independent spans, each a run of markers and what follows up to the next marker. In a span the
automaton reports, at each position, all pieces that end there (its output links), and each relaxes the best
score of that position. Characters that no piece covers cost the lowest score less UNKNOWN and are spelt
in byte pieces. The marker character itself in a text is spelt in bytes too, which makes decoding exact.

The words of a part of the texts that are not remembered are encoded together: numpy leads them through the
automaton's tables side by side, a character of each at a time, and relaxes along their output links at once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pulsemark.llm import vocab
from pulsemark.llm.columns import add_columns
from pulsemark.llm.vocab import SPACE

UNKNOWN = 10.0
#: Bytes of spans and pieces that a task remembers, and of a span that is worth it.
REMEMBERED, LONGEST = 24_000_000, 100
#: Words at least that are worth encoding together.
TOGETHER = 64
#: Bytes of texts that are encoded at once. Their ids are Python numbers for a while, which take many times as much.
PART_BYTES = 1 << 19
#: What a remembered span takes beside its text and pieces.
_ENTRY = 190
_SPANS = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class _Memory(dict):
    """Encoded spans by their text, as bytes of 32-bit ids; forgets all when full. Long spans are not remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.held = encode, 0

    def __missing__(self, text: str) -> bytes:
        found = array("i", self.encode(text)).tobytes()
        if len(text) <= LONGEST:
            self.keep(text, found)
        return found

    def keep(self, text: str, found: bytes):
        if self.held >= REMEMBERED:
            self.forget()
        self.held += _ENTRY + 2 * len(text) + len(found)
        self[text] = found

    def forget(self):
        self.clear()
        self.held = 0


class Tables:
    """The automaton over pieces in arrays, for many states at once.

    State 0 is the start. ``first`` and ``after`` are chains of states, the longest piece first and 0 at the end, at
    which a piece (``number``) ends; children are found in a hash table of (state, character).
    """

    def __init__(self, ids: dict[str, int]):
        children, parents, letters, number = {}, [0], [0], [-1]
        for text, k in ids.items():
            state = 0
            for c in map(ord, text):
                key = (state << 21 | c) + 1
                state = children.setdefault(key, len(parents))
                if state == len(parents):
                    parents.append(key - 1 >> 21)
                    letters.append(c)
                    number.append(-1)
            number[state] = k
        depth = [0] * len(parents)
        for state in range(1, len(parents)):
            depth[state] = depth[parents[state]] + 1
        fail, after = [0] * len(parents), [0] * len(parents)
        for state in sorted(range(1, len(parents)), key=depth.__getitem__):
            c, back = letters[state], parents[state]
            while back:
                back = fail[back]
                if found := children.get((back << 21 | c) + 1):
                    fail[state] = found
                    break
            after[state] = fail[state] if number[fail[state]] >= 0 else after[fail[state]]
        self.number, self.fail, self.after = (np.array(x, np.int64) for x in (number, fail, after))
        self.first = np.where(self.number >= 0, np.arange(len(number)), self.after)
        bits = (4 * len(children)).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.children = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        keys, states = (np.fromiter(x, np.int64, len(children)) for x in (children, children.values()))
        places = self._places(keys)
        while len(keys):  # of keys that want one place the last has it, the others go on to the next
            free = self.keys[places] == 0
            self.keys[places[free]] = keys[free]
            there = self.keys[places] == keys
            self.children[places[there]] = states[there]
            keys, states, places = keys[~there], states[~there], (places[~there] + 1) & self.last

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _child(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The states' children by a character, or 0."""
        keys = (states << 21 | letters) + 1
        places = self._places(keys)
        found = self.keys[places]
        taken = np.flatnonzero((found != keys) & (found != 0))
        while len(taken):
            places[taken] = there = (places[taken] + 1) & self.last
            found[taken] = there = self.keys[there]
            taken = taken[(there != keys[taken]) & (there != 0)]
        return self.children[places]  # 0 where no key is

    def follow(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The states after one more character."""
        new = self._child(states, letters)
        lost = np.flatnonzero((new == 0) & (states > 0))
        states = states[lost]
        while len(lost):
            states = self.fail[states]
            new[lost] = got = self._child(states, letters[lost])
            more = (got == 0) & (states > 0)
            lost, states = lost[more], states[more]
        return new


class Encoder:
    """Encodes texts to piece ids and back."""

    def __init__(self, pieces: vocab.Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for text, number in pieces.ids.items():
            self.automaton.add_word(text, number)
        self.automaton.make_automaton()
        self.known = {number: (len(text), pieces.scores[text]) for text, number in pieces.ids.items()}
        self.lengths, self.scores = np.zeros(pieces.size, np.int64), np.zeros(pieces.size)
        for number, (length, score) in self.known.items():
            self.lengths[number], self.scores[number] = length, score
        self.tables = Tables(pieces.ids)
        self.floor = min(pieces.scores.values()) - UNKNOWN
        self.texts = {number: text for text, number in pieces.ids.items()}
        self.single = {number: byte for byte, number in enumerate(pieces.bytes)}
        self.spelt = {number: text.replace(SPACE, " ").encode() for number, text in self.texts.items()}
        self.spelt.update({number: bytes([byte]) for number, byte in self.single.items()})
        self.marker = np.array([pieces.bytes[x] for x in SPACE.encode()], np.int32).tobytes()
        self.spans = _Memory(self.span)
        self.words = _Memory(self.word)

    def word(self, text: str) -> list[int]:
        """The best pieces of a word after one marker."""
        return self.span(SPACE + text)

    def span(self, text: str) -> list[int]:
        """The best pieces of one span; of equal scores the one found with the shortest last piece wins."""
        size = len(text)
        best, back = [0.0] + [None] * size, [None] * (size + 1)
        done = 0  # positions up to here are final
        for end, number in self.automaton.iter(text):
            length, score = self.known[number]
            end += 1
            while done < end - 1:
                done += 1
                self._unknown(best, back, done)
            start = end - length
            value = best[start] + score
            if best[end] is None or value > best[end] or (value == best[end] and length < back[end][0]):
                best[end], back[end] = value, (length, number)
        while done < size:
            done += 1
            self._unknown(best, back, done)
        out, at = [], size
        while at:
            length, number = back[at]
            if number is None:
                out.extend(self.pieces.bytes[x] for x in reversed(text[at - 1].encode()))
            else:
                out.append(number)
            at -= length
        out.reverse()
        return out

    def learn(self, texts: list[str]):
        """Remember the words of texts, those that are new encoded together."""
        wanted = set()
        for text in texts:
            if SPACE not in text and text[:1] != " " and "  " not in text:
                wanted.update(text.split(" "))
        new = wanted.difference(self.words)
        if self.words.held + sum(_ENTRY + 10 * len(w) for w in new) > REMEMBERED:
            self.words.forget()
            new = wanted
        new = [w for w in new if 0 < len(w) <= LONGEST]
        if len(new) >= TOGETHER:
            for word, found in zip(*self.words_together(new)):
                self.words.keep(word, found)

    def words_together(self, words: list[str]) -> tuple[list[str], list[bytes]]:
        """Words, none of them empty or with a marker, by descending length, and the ids that ``word`` finds for each."""
        words = sorted(words, key=len, reverse=True)
        text = SPACE + SPACE.join(words)
        letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        firsts = np.cumsum(sizes) - sizes
        starts = firsts + np.arange(len(words))  # a word has a cell for its start and one for the end of each character
        best, back, piece = (np.full(len(text) + len(words), x) for x in (-np.inf, 1, -1))
        best[starts] = 0.0
        states = np.zeros(len(words), np.int64)
        for step, n in enumerate(np.searchsorted(-sizes, -np.arange(sizes[0]), "left").tolist()):
            at = starts[:n] + step + 1
            states = self.tables.follow(states[:n], letters[firsts[:n] + step])
            top, length, number = np.full(n, -np.inf), np.ones(n, np.int64), np.full(n, -1)
            ends = self.tables.first[states]
            some = np.flatnonzero(ends)
            ends = ends[some]
            while len(some):  # the longest piece first, so that of equal scores the shortest wins
                found = self.tables.number[ends]
                size = self.lengths[found]
                value = best[at[some] - size] + self.scores[found]
                better = value >= top[some]
                to = some[better]
                top[to], length[to], number[to] = value[better], size[better], found[better]
                ends = self.tables.after[ends]
                some, ends = some[ends > 0], ends[ends > 0]
            value = best[at - 1] + self.floor
            single = value > top
            best[at] = np.where(single, value, top)
            back[at], piece[at] = np.where(single, 1, length), np.where(single, -1, number)
        is_start, used = np.zeros(len(best), bool), np.zeros(len(best), bool)
        is_start[starts] = True
        at = starts + sizes
        while len(at):
            used[at] = True
            at = at - back[at]
            at = at[~is_start[at]]
        at = np.flatnonzero(used)
        found, owners = piece[at], np.searchsorted(starts, at, "right") - 1
        unknown = found < 0
        singles = [[self.pieces.bytes[x] for x in text[k].encode()] for k in (at - owners - 1)[unknown].tolist()]
        counts = np.ones(len(at), np.int64)
        counts[unknown] = list(map(len, singles))
        ids = np.repeat(found, counts).astype(np.int32)
        ids[ids < 0] = list(chain.from_iterable(singles))
        data, ends = ids.tobytes(), (4 * np.cumsum(np.bincount(owners, counts))).astype(np.int64).tolist()
        return words, [data[a:b] for a, b in zip([0, *ends], ends)]

    def _unknown(self, best, back, at):
        """Cover one character by bytes where that is better; at most positions a piece of one character is."""
        value = best[at - 1] + self.floor
        if best[at] is None or value > best[at]:
            best[at], back[at] = value, (1, None)

    def encode(self, text: str) -> list[int]:
        """Piece ids of a text; an empty text has none."""
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def encode_bytes(self, text: str) -> bytes:
        """The piece ids as 32-bit numbers in the machine's order."""
        if not text:
            return b""
        if SPACE not in text:
            return self._plain(" " + text)
        first, *rest = text.split(SPACE)  # marker characters of the text itself stand between the parts
        return self._plain(" " + first) + b"".join(self.marker + self._plain(part) for part in rest)

    def _plain(self, text: str) -> bytes:
        if text[:1] == " " and "  " not in text:  # one marker before every word
            return b"".join(map(self.words.__getitem__, text[1:].split(" ")))
        return b"".join(map(self.spans.__getitem__, _SPANS.findall(text.replace(" ", SPACE))))

    def decode(self, ids) -> str:
        """The text of piece ids; broken UTF-8 of byte pieces becomes the replacement character."""
        text = b"".join(map(self.spelt.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Split texts into parts of PART_BYTES at most; a longer text is one of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART_BYTES, "right")))
        yield lo, hi
        lo = hi


def _start(shared):
    encoder = shared.value  # one per Python worker, with what it remembers

    def make(texts: pa.Array) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for lo, hi in _parts(texts):
            part = texts.slice(lo, hi - lo).to_pylist()
            encoder.learn(part)
            rows = [encoder.encode_bytes(x) for x in part]
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in rows], out=offsets[1:])
            flat = np.frombuffer(b"".join(rows), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            numbers, at = flat.tolist(), offsets.tolist()
            decoded = pa.array([encoder.decode(numbers[a:b]) for a, b in zip(at, at[1:])], pa.string())
            yield lo, hi, [ids, decoded]
    return make


def encode(docs: DataFrame, keep: list[str], text_column: str = "text", path: str = vocab.PIECES) -> DataFrame:
    """The columns ``keep`` with ``piece_ids`` and ``decoded``, the text read back from the ids.

    A null or empty text has no ids and is decoded to an empty text. Each row stands alone: repeated rows
    and null ids are kept, an empty table gives an empty result. A kept column with a new name is refused.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(vocab.load(path)))
    return add_columns(docs, keep, "piece_ids array<int>, decoded string", lambda: _start(shared), text_column)
