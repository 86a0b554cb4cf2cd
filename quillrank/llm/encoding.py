"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

import json
import os
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillrank.llm.worker import per_worker

KNOWN_PIECES = 300_000  # words and other pieces, with and without a space before, that a worker remembers of each
TOGETHER_BYTES = 4 << 20  # of texts that are cut together, unless one text alone has more
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary; any path of a file may be given instead."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return per_worker(f"tokenizer {path}", lambda: Tokenizer.from_file(path))


def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write every byte as one printable letter: byte -> code point."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class ByteEncoder:
    """Ids of a byte-level vocabulary, packed little-endian, for texts of any length.

    A text is cut before every space that a visible character follows: the library's own split
    always cuts there, so the parts can be encoded apart. So can the lines of a part, and the marks after a word. Arrow
    cuts many texts at a time and lays their ids; each distinct piece of theirs is looked up once, and words are encoded
    many in a call. Texts with longer white space next to a space, or with a special token, go to the library whole.
    """

    def __init__(self, path: str, width: int):
        self._tokenizer = load_tokenizer(path)
        self._tokenize = self._tokenizer.model.tokenize
        self._letters = byte_letters()
        self._dtype, self._width = f"<u{width}", width
        self._specials = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._known = {" ": _Known(), "": _Known()}
        self._between, self._between_id = self._separator()

    def _separator(self) -> tuple[str, int | None]:
        """A control character that no longer token holds, and its id: the model merges nothing across it."""
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        joined = set().union(*(token for token in vocabulary if len(token) > 1))
        for byte in range(32):
            letter = chr(self._letters[byte])
            if letter in vocabulary and letter not in joined:
                return chr(byte), vocabulary[letter]
        return "", None

    def __call__(self, text: str | None) -> bytes:
        return self._together(pa.array([text], pa.string()))[0]

    def batches(self, texts: pa.Array) -> Iterator[list[bytes]]:
        """The packed ids of each text, in order, those of some texts at a time; null is empty."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(texts):
            room = TOGETHER_BYTES + (ends[start - 1] if start else 0)
            stop = max(start + 1, int(np.searchsorted(ends, room, side="right")))
            yield self._together(texts[start:stop])
            start = stop

    def _together(self, texts: pa.Array) -> list[bytes]:
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), dtype=bool)
        for token in self._specials:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, " ")
        offsets, coded = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        del cut
        parts, codes = coded.dictionary, coded.indices.to_numpy()

        # No space is before the first part of a text; each other one must begin with a visible character.
        starts = offsets[:-1]
        follows = np.ones(len(codes), dtype=bool)
        follows[starts] = False
        white = _white(parts)
        whole[np.searchsorted(offsets, np.flatnonzero(white[codes] & follows), side="right") - 1] = True
        asked = np.zeros(len(parts), dtype=bool)
        asked[codes[follows]] = True
        asked = np.flatnonzero(asked & ~white)
        place = np.zeros(len(parts), dtype=np.int64)
        place[asked] = np.arange(len(asked))
        places = place[codes]
        places[starts] = len(asked) + np.arange(len(starts))
        del white, follows, place
        ids = self._parts(parts.take(pa.array(np.concatenate((asked, codes[starts])))), len(asked)).take(pa.array(places))
        _, ends, data = ids.buffers()
        edges = np.frombuffer(ends, dtype=np.int64)[offsets].tolist()
        data = memoryview(data or b"")
        return [
            self._by_library(texts[at].as_py()) if alone else bytes(data[a:b])
            for at, (alone, (a, b)) in enumerate(zip(whole.tolist(), pairwise(edges), strict=True))
        ]

    def _parts(self, parts: pa.Array, spaced: int) -> pa.Array:
        """The ids of each part; a space stands before so many of the first."""
        cut = pc.split_pattern(parts, "\n")
        starts, lines = cut.offsets.to_numpy(), cut.values
        part_of = np.repeat(np.arange(len(parts)), np.diff(starts))
        first = np.zeros(len(lines), dtype=bool)
        first[starts[:-1]] = True

        # A line is a word with marks or without, or else a piece of its own.
        words = pc.ascii_rtrim(lines, characters=_MARKS)
        n_marks = (pc.binary_length(lines).to_numpy() - pc.binary_length(words).to_numpy()).astype(np.int64)
        coded = words.dictionary_encode()
        pieces, codes = _strings(coded.dictionary), coded.indices.to_numpy().astype(np.int64)
        odd = ~np.fromiter(map(str.isalpha, pieces), bool, len(pieces))[codes]
        coded = lines.filter(pa.array(odd)).dictionary_encode()
        codes[odd] = len(pieces) + coded.indices.to_numpy()
        n_marks[odd] = 0
        others = _strings(coded.dictionary)
        pieces += others
        del words, coded

        # A part with empty lines, or with white space next to a line end, is one piece.
        edged = np.zeros(len(pieces), dtype=bool)
        edged[len(pieces) - len(others) :] = [not o or o[0].isspace() or o[-1].isspace() for o in others]
        uncut = np.zeros(len(parts), dtype=bool)
        uncut[part_of[edged[codes]]] = True
        uncut = np.flatnonzero(uncut & (np.diff(starts) > 1))
        left_out = np.zeros(len(parts), dtype=bool)
        left_out[uncut] = True
        left_out = left_out[part_of]
        n_marks[left_out] = 0
        codes[starts[uncut]] = len(pieces) + np.arange(len(uncut))
        pieces += _strings(parts.take(pa.array(uncut)))

        ids = [b"", *self._pieces(["\n"], "")]
        laid = np.zeros((len(lines), 3), dtype=np.int64)  # line end, word, marks
        laid[~first & ~left_out, 0] = 1
        begins = first & (part_of < spaced)
        for space, now in ((" ", begins), ("", ~begins & (first | ~left_out))):
            asked = np.zeros(len(pieces), dtype=bool)
            asked[codes[now]] = True
            asked = np.flatnonzero(asked)
            place = np.zeros(len(pieces), dtype=np.int64)
            place[asked] = len(ids) + np.arange(len(asked))
            laid[now, 1] = place[codes[now]]
            ids += self._pieces([pieces[code] for code in asked.tolist()], space)
        marked = np.flatnonzero(n_marks)
        coded = _ends(lines.take(pa.array(marked)), n_marks[marked]).dictionary_encode()
        laid[marked, 2] = len(ids) + coded.indices.to_numpy()
        ids += self._pieces(_strings(coded.dictionary), "")

        joined = pa.array(ids, pa.large_binary()).take(pa.array(laid.ravel()))
        _, ends, data = joined.buffers()
        ends = np.ascontiguousarray(np.frombuffer(ends, dtype=np.int64)[: 3 * len(lines) + 1][3 * starts])
        return pa.Array.from_buffers(joined.type, len(parts), [None, pa.py_buffer(ends), data or pa.py_buffer(b"")])

    def _pieces(self, pieces: list[str], space: str) -> list[bytes]:
        """The ids of distinct pieces, with the space before each, if any."""
        known = self._known[space]
        ids = known.get_all(pieces)
        missing = [at for at, found in enumerate(ids) if found is None]
        words = [at for at in missing if pieces[at].isalpha()]
        for at, found in zip(words, self._words([pieces[at] for at in words], space), strict=True):
            ids[at] = found
        if len(words) < len(missing):
            for at in missing:
                if ids[at] is None:
                    ids[at] = self._by_library(space + pieces[at])
        known.add({pieces[at]: ids[at] for at in missing if len(pieces[at]) < 64})
        return ids

    def _by_library(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype=self._dtype).tobytes()

    def _words(self, words: list[str], space: str) -> list[bytes]:
        """Each word of letters is one piece for the model; it gets many in a row."""
        if self._between_id is None:
            return [self._by_library(space + word) for word in words]
        ids = array("I")
        for at in range(0, len(words), 64):
            row = space + (self._between + space).join(words[at : at + 64]) + self._between
            row = row.encode().decode("latin-1").translate(self._letters)
            ids.extend([token.id for token in self._tokenize(row)])
        ids = np.frombuffer(ids, dtype=np.uintc)
        ends = (np.flatnonzero(ids == self._between_id) * self._width).tolist()
        packed = ids.astype(self._dtype).tobytes()
        return [packed[a + self._width : b] for a, b in pairwise([-self._width, *ends])]


_MARKS = "!#$%&()*+,-./:;=?@[]^_{}~"  # after a word they are one piece; what follows an apostrophe may not be


def _strings(texts: pa.Array) -> list[str]:
    """The same as ``to_pylist``, without an object of Arrow's for each text."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts begin and end, and their bytes."""
    _, ends, data = texts.buffers()
    return (
        np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1],
        np.frombuffer(data or b"", dtype=np.uint8),
    )


def _white(parts: pa.Array) -> np.ndarray:
    """Which parts are empty or begin with white space."""
    edges, data = _flat(parts)
    white = np.diff(edges) == 0
    some = np.flatnonzero(~white)
    lead = data[edges[some]]
    some = some[(lead <= 0x20) | np.isin(lead, (0xC2, 0xE1, 0xE2, 0xE3))]  # bytes that white space begins with
    white[some] = [part[0].isspace() for part in _strings(parts.take(pa.array(some)))]
    return white


def _ends(texts: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The last bytes of each text, as many as ``lengths`` says."""
    edges, data = _flat(texts)
    own = np.concatenate(([0], np.cumsum(lengths)))
    at = np.repeat(edges[1:] - own[1:], lengths) + np.arange(own[-1])
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(own), pa.py_buffer(data[at])])


class _Known:
    """Packed ids by piece, for about KNOWN_PIECES of them.

    There are two generations: when the young one is half of that, it becomes the old one, and what is asked for again moves
    up from there, so frequent pieces stay. Long pieces are not remembered.
    """

    def __init__(self):
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def get_all(self, pieces: list[str]) -> list[bytes | None]:
        found = list(map(self._young.get, pieces))
        if self._old:
            old, again = self._old.get, {}
            for at in [at for at, ids in enumerate(found) if ids is None]:
                if (ids := old(pieces[at])) is not None:
                    found[at] = again[pieces[at]] = ids
            self.add(again)
        return found

    def add(self, new: dict[str, bytes]) -> None:
        if len(self._young) >= KNOWN_PIECES // 2:
            self._old, self._young = self._young, {}
        self._young.update(new)


def byte_encoder(name: str, width: int) -> ByteEncoder:
    path = vocabulary_path(name)
    return per_worker(f"encoder {path} {width}", lambda: ByteEncoder(path, width))
