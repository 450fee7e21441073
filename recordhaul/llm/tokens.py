"""Token ids of whole texts, by the ``tokenizers`` library, with a memory of words already cut.

Encoding a text anew for each occurrence of a word is the costly part of tokenising a corpus. A
text is therefore cut into chunks at places where the tokenizer itself always begins a new
piece; Arrow finds the distinct chunks of a batch, each is encoded once per worker, and the ids
of a text are the ids of its chunks in order. The place used is a single space or line feed
between two characters that are not white space: a pre-token of either vocabulary never reaches
across it and never looks over it, so the ids equal those of the whole text (``tests/llm``
compares them).

Texts with other white space, several white-space characters in a row, or the string of a special
token, which the library takes for that token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

#: A worker's memory holds so many chunks at most, if it is the only one; it starts anew beyond that.
REMEMBERED = 1_100_000
#: And so many words without white space and punctuation, of which chunks are made.
PIECES = 300_000

#: UTF-8 bytes of text that are encoded at once.
BATCH_BYTES = 6 << 20

_IRREGULAR = (
    r"[ \n][ \n]|[ \n]\z|[\t\x{b}\x{c}\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: One white-space character, a word of Latin letters, and punctuation that ends the word's piece.
_SIMPLE = re.compile("([ \n])([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,%$#*&|]*)")

_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def tokenizer_path(name: str) -> str:
    """``name`` itself if it is a path, else the file of that name among the public tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The character that a byte-level model has for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(other)}


def _letter_pairs() -> dict[int, str]:
    """For Latin letters of two UTF-8 bytes: the two characters a byte-level model has for them."""
    of = byte_letters()
    return {c: "".join(of[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class ChunkEncoder:
    """Encodes columns of texts; holds the ids of every chunk it has met.

    With ``plain``, the strings of special tokens are ordinary text.
    """

    #: What is put before a text to be cut like the rest; its ids do not count unless it is a space.
    lead = "\n"
    #: Most chunks that are remembered.
    remembered = REMEMBERED

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        marks = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._irregular = self._irregular_of([] if plain else marks)
        self._model = self._tokenizer.model
        self._letters = _letter_pairs()
        #: One vocabulary has lower case only and drops white space, the other keeps all.
        self._keeps_space = bool(self.whole(" "))
        self._forget()

    @staticmethod
    def _irregular_of(marks: list[str]) -> str:
        """The pattern of texts that are encoded whole."""
        return f"{_IRREGULAR}|(?i:{'|'.join(marks)})" if marks else _IRREGULAR

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._ids = np.empty(0, np.uint32)
        self._start = np.zeros(2, np.int64)
        self._place[""] = 0

    def whole(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        if (ids := self._pieces.get(piece)) is None:
            ids = tuple([token.id for token in self._model.tokenize(piece)])
            if len(self._pieces) >= PIECES:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> Sequence[int]:
        """The ids of one white-space character and the word behind it."""
        match = _SIMPLE.fullmatch(chunk)
        if match is None:
            return self.whole(chunk)
        space, word, tail = match.groups()
        if not self._keeps_space:
            word = word.lower()
        if not word.isascii():
            word = word.translate(self._letters)
        before: tuple[int, ...] = ()
        if self._keeps_space:
            if space == " ":
                word = "Ġ" + word  # how byte-level vocabularies write a space
            else:
                before = tuple(self.whole(space))
        return before + self._piece(word) + (self._piece(tail) if tail else ())

    def _chunks(self, chunks: list[str]) -> list[Sequence[int]]:
        """The ids of several chunks."""
        return [self._chunk(chunk) for chunk in chunks]

    def _learn(self, chunks: list[str]) -> None:
        """Adds what is not known yet; a chunk without white space before it has had a space."""
        new = [chunk for chunk in chunks if chunk not in self._place]
        if not new:
            return
        ids = self._chunks([chunk if chunk[0] == "\n" else " " + chunk for chunk in new])
        self._place.update(zip(new, range(len(self._place), len(self._place) + len(new)), strict=True))
        ends = self._start[-1] + np.cumsum([len(x) for x in ids])
        self._start = np.concatenate([self._start, ends])
        self._ids = np.concatenate([self._ids, np.array([x for y in ids for x in y], np.uint32)])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers; none for a null or empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            yield from self._encode(texts.slice(begin, end - begin))

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        led = pc.binary_join_element_wise(self.lead, texts, "")
        odd = pc.match_substring_regex(led, self._irregular)
        # A space goes without saying before the first chunk.
        led = pc.if_else(odd, "", texts if self.lead == " " else led)
        pieces = pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")
        chunks = pieces.flatten().dictionary_encode()
        if len(self._place) > self.remembered:
            self._forget()
        known = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(known)
        places = np.fromiter(map(self._place.__getitem__, known), np.int64, len(known))
        starts = self._start[places]
        counts = self._start[places + 1] - starts
        which = chunks.indices.to_numpy()
        starts, counts = starts[which], counts[which]
        ends = np.cumsum(counts)
        gather = np.repeat((starts - (ends - counts)).astype(np.int32), counts)
        gather += np.arange(len(gather), dtype=np.int32)
        ids = self._ids[gather]
        bounds = np.concatenate([[0], ends])[pieces.offsets.to_numpy()].tolist()
        lead = 0 if self.lead == " " else len(self.whole("\n"))
        out = [ids[a + lead : b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for n in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[n] = np.array(self.whole(self.lead.strip("\n") + texts[n].as_py()), np.uint32)
        return out


def encoder(name: str, plain: bool = False) -> ChunkEncoder:
    """The worker's encoder for a vocabulary, kept for the tasks that follow."""
    key = tokenizer_path(name), plain
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]
