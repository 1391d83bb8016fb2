"""Token ids of whole texts, with a memory of the words met before.

The tokenizer splits a text at white space before anything else, so a blank that stands before a
visible character always begins a new piece, and the ids of a text are those of its blank-led
words in a row. A line break between two visible characters is a piece by itself, and so are marks
behind letters. Words repeat; each worker asks the tokenizer for a word once and keeps its ids, or
Arrow finds the different words of many texts.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers: two generations of this size, unless told otherwise; the older
#: is dropped as a whole. A million words take about 200 MB.
GENERATION = 600_000

#: Longer words are tokenized anew each time.
LONGEST_KEPT = 64

#: Ends every document.
END_ID = 2

#: Marks that often end a word, one by one with any tokenizer, or several as one piece.
END_MARKS = ".,;:!?"
END_RUNS = END_MARKS + "\"#$%&()*+-/<=>@[\\]^_`{|}~"

#: Different runs of marks that a worker remembers.
RUNS_KEPT = 10_000

INVISIBLE = "\u180e\u200b\ufeff"
BEFORE_VISIBLE = re.compile(rf" (?=[^\s{INVISIBLE}])")


class _NotAWord(Exception):
    pass


class _Runs(dict):
    """Ids of marks that end a word, as bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, marks: str) -> bytes:
        if len(self) >= RUNS_KEPT:
            self.clear()
        ids = self[marks] = self.encode(marks)
        return ids


class _Memory(dict):
    """Ids, as bytes of unsigned 32-bit numbers, of ``lead`` and a word."""

    def __init__(self, encode, lead: str, generation: int, runs: bool):
        super().__init__()
        self.encode, self.lead, self.generation, self.old = encode, lead, generation, {}
        self.runs, self.marks = runs, _Runs(encode)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(self.lead + word) if word.isalpha() else self._mixed(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.generation:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _mixed(self, word: str) -> bytes:
        if self.lead and (not word or word[0].isspace() or word[0] in INVISIBLE):
            raise _NotAWord
        # letters and the marks that follow them are separate pieces
        stem = word.rstrip(END_RUNS) if self.runs else word[:-1]
        marks = word[len(stem) :]
        if marks and stem.isalpha() and (self.runs or marks in END_MARKS):
            return self[stem] + self.marks[marks]
        return self.encode(self.lead + word)


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 characters stand
    for themselves, the other bytes, in order, for those from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()
BYTE_TABLE = "".join(BYTE_LETTERS.get(b, chr(b)) for b in range(256))


class Encoder:
    """Ids of texts by a tokenizer file, equal to those of encoding each text as a whole."""

    def __init__(self, path: str, generation: int = GENERATION):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # words of letters alone are one piece, which the model can be given without the search
        # for pieces, if nothing else happens to the text before
        splitter = type(self.tokenizer.pre_tokenizer).__name__
        self.direct = self.tokenizer.normalizer is None and splitter == "ByteLevel"
        self.first = _Memory(self._ids, "", generation, self.direct)
        self.later = _Memory(self._ids, " ", generation, self.direct)
        self.marks, self.line_break = _Runs(self._ids), self._ids("\n")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] == BYTE_LETTERS[32]]] = True

    def _ids(self, text: str) -> bytes:
        if self.direct and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            letters = codecs.charmap_decode(text.encode(), "strict", BYTE_TABLE)[0]
            ids = [token.id for token in self.tokenizer.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def document(self, text: str | None) -> bytes:
        """The ids of a text and ``END_ID``, as little-endian unsigned 32-bit numbers; a null
        text is empty."""
        text = text or ""
        pieces = text.split(" ")
        try:
            body = b"".join(map(self.later.__getitem__, pieces[1:]))
            head = self.first[pieces[0]] if pieces[0] else b""
        except _NotAWord:
            pieces = BEFORE_VISIBLE.split(text)
            body = b"".join(map(self.later.__getitem__, pieces[1:]))
            head = self.first[pieces[0]] if pieces[0] else b""
        return head + body + END_BYTES

    def documents(self, texts: pa.Array) -> list[np.ndarray]:
        """What ``document`` gives for each text. Arrow finds the different words of all texts, so
        that each is looked up once, and those of letters without a memory."""
        texts = texts.fill_null("")
        if not self.direct:
            return [as_ids(self.document(t)) for t in texts.to_pylist()]
        # a line break leads the word behind it, and one leads each text
        led = pc.replace_substring(texts, "\n", " \n")
        led = pc.binary_join_element_wise("\n", led, "")
        split = pc.split_pattern(led, " ")
        places = np.asarray(split.offsets) - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        del led, split
        # letters and the marks that follow them are separate pieces
        trimmed = pc.ascii_rtrim(words.dictionary, END_RUNS)
        stems = trimmed.dictionary_encode()
        names = stems.dictionary.to_pylist()
        plain = np.fromiter(map(str.isalpha, names), bool, len(names))
        stem_ids = _binary(*self._letters(list(compress(names, plain))), plain)
        marks = np.asarray(pc.subtract(pc.binary_length(words.dictionary), pc.binary_length(trimmed)))
        simple = plain.take(np.asarray(stems.indices))
        rest, odd = [], []
        more = np.flatnonzero((marks > 0) | ~simple)
        for number, word, length, is_simple in zip(
            more.tolist(),
            words.dictionary.take(pa.array(more)).to_pylist(),
            marks[more].tolist(),
            simple[more].tolist(),
        ):
            try:
                rest.append(self.marks[word[-length:]] if is_simple else self._led(word))
            except _NotAWord:
                rest.append(b"")
                odd.append(number)
        has_more = np.zeros(len(marks), dtype=bool)
        has_more[more] = True
        rest_ids = _binary(b"".join(rest), np.fromiter(map(len, rest), "i8", len(rest)), has_more)
        del names, rest
        nothing = pa.scalar(b"", pa.large_binary())
        ids = pc.binary_join_element_wise(stem_ids.take(stems.indices), rest_ids, nothing)
        joined = ids.take(words.indices)
        ends = np.frombuffer(joined.buffers()[1], "<i8", len(joined) + 1)
        stream = np.frombuffer(joined.buffers()[2] or b"", "<u4")
        bounds = (ends[places] >> 2).tolist()
        # the line break that leads a text gives its place to the end of the text before
        stream = np.append(stream, np.uint32(END_ID))
        del joined, ends
        stream[bounds[:-1]] = END_ID
        out = [stream[a + 1 : b + 1] for a, b in zip(bounds, bounds[1:])]
        if odd:
            is_odd = np.zeros(len(ids), dtype="i8")
            is_odd[odd] = 1
            counts = np.add.reduceat(is_odd.take(np.asarray(words.indices)), places[:-1])
            for number in np.flatnonzero(counts).tolist():
                out[number] = as_ids(self.document(texts[number].as_py()))
        del words
        pa.default_memory_pool().release_unused()
        return out

    def _letters(self, words: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of blank-led words of letters in a row, and how many bytes each takes."""
        blank = BYTE_LETTERS[32]
        letters = codecs.charmap_decode(" ".join(["", *words]).encode(), "strict", BYTE_TABLE)[0]
        tokenize = self.tokenizer.model.tokenize
        pieces = letters.replace(blank, "\n" + blank).split("\n")[1:]
        ids = np.fromiter((t.id for piece in pieces for t in tokenize(piece)), "<u4")
        # of the tokens of a word, the first one alone begins with the blank
        ends = np.append(np.flatnonzero(self.begins[ids]), len(ids))
        return ids.tobytes(), 4 * np.diff(ends)

    def _led(self, word: str) -> bytes:
        """The ids of a word led by a blank, or by the line break with which it begins, if what
        stands behind it goes on with a line break, or ends the text."""
        if not _visible(word[-1:]):
            raise _NotAWord
        if word[0] != "\n":
            return self.later[word]
        if not _visible(word[1:2]):
            raise _NotAWord
        return self.line_break + self.first[word[1:]]


def _binary(data: bytes, lengths: np.ndarray, where: np.ndarray) -> pa.Array:
    """Values of these lengths out of ``data`` for the places ``where``, empty ones elsewhere."""
    ends = np.zeros(len(where) + 1, dtype="<i8")
    ends[1:][where] = lengths
    np.cumsum(ends, out=ends)
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(where), buffers)


def _visible(mark: str) -> bool:
    return bool(mark) and not mark.isspace() and mark not in INVISIBLE


END_BYTES = array("I", [END_ID]).tobytes()
_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, generation: int = GENERATION) -> Encoder:
    """One encoder for each file and worker process, so that tasks share its memory."""
    key = path, generation
    if key not in _encoders:
        _encoders[key] = Encoder(path, generation)
    return _encoders[key]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def as_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
