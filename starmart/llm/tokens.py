"""Token ids by a public tokenizer, for whole texts, at the price of their distinct words."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

TOKENIZER = "word_bpe_49k.json"
WORD_BYTES = 36 << 20  # what a task keeps of words and of their pieces; as much of those before
SLICE_BYTES = 1 << 20  # of texts whose pieces are found at once
ENTRY_BYTES = 170  # of a dictionary entry, besides key and value

# The tokenizer's own pieces of a lower-case word, here for ASCII and Latin letters.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\uffff]+|[0-9]|[^\sa-z0-9\u00c0-\uffff]+")
# Characters whose lower case and composition are beyond doubt: no dotted capital I, no signs among letters.
LATIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
# The bytes of such characters and of ASCII white space; the kinds of bytes that pieces are made of.
ASCII = bytes([*range(9, 14), *range(32, 127)])
BLANK, LETTER, DIGIT, SIGN = range(4)
KIND = np.full(256, SIGN, np.uint8)
KIND[[*range(9, 14), 32]] = BLANK
KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = LETTER
KIND[ord("0") : ord("9") + 1] = DIGIT
# Byte-level tokenizers write the bytes that have no printable Latin-1 character as U+0100 and on.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
AS_CHARACTER = dict(zip(sorted(set(range(256)) - set(SHOWN)), range(0x100, 0x200), strict=False))


def is_plain(text: bytes) -> bool:
    """Whether a UTF-8 text has but ASCII and Latin letters, and no text of a special token."""
    other = text.translate(None, ASCII)
    return b"<|" not in text and (not other or LATIN.fullmatch(other.decode(errors="replace")) is not None)


def pieces_of(text: bytes) -> tuple[pa.BinaryArray, np.ndarray]:
    """``PIECES`` of all words of a plain lower-case text, and where each begins in it."""
    text += b"  "  # so that there is something behind an apostrophe
    data = np.frombuffer(text, np.uint8)
    kind = KIND[data]
    first = np.empty(len(data), bool)  # of a piece, or of white space
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == DIGIT
    if b"'" in text:
        # An apostrophe that begins a run of signs takes the letters of a short form behind it.
        at = np.flatnonzero(first & (data == ord("'")))
        one, two = data[at + 1], data[at + 2]
        short = np.isin(one, list(b"stmd"))
        long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        first[at[short | long] + 1] = False
        first[at[short] + 2] = True
        first[at[long] + 3] = True
    solid = kind != BLANK
    starts = np.flatnonzero(first & solid)
    letters = data[solid]
    offsets = np.append(np.flatnonzero(first[solid]), len(letters)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), buffers), starts


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare name is looked up among the public tokenizers of the machine it runs on."""
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of a text, word by word, for a tokenizer that drops white space and lower-cases.

    Such a tokenizer never merges across white space, so a text's ids are those of its words in a row.
    A piece of a word has the ids of the word that it would be alone. Of plain texts, many at a time, the distinct
    pieces are looked up and their ids dealt out by arrays. Of other texts the words are looked up, and of new
    ones the pieces are; a word with other than ASCII and Latin letters is given to the tokenizer as it is. What
    is kept of both is bounded by bytes: there are words of now and those before, and what is met again moves from
    these to those. So frequent ones stay when the others go. With ``special`` false the texts of special tokens
    are plain text.
    """

    def __init__(self, name: str = TOKENIZER, *, special: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_path(name))
        self.whole.encode_special_tokens = not special
        self.model = self.whole.model
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.word_bytes = 0

    def ids(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit numbers."""
        return next(self.all_ids([text]))

    def all_ids(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """``ids`` of every text, in their order."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > SLICE_BYTES:
                yield from self._some(some)
                some, size = [], 0
            some.append(text)
            size += len(text) + 1
        yield from self._some(some)

    def _some(self, texts: list[bytes]) -> Iterator[bytes]:
        plain = [is_plain(text) for text in texts]
        found = self._by_pieces([t for t, p in zip(texts, plain, strict=True) if p])
        for text, p in zip(texts, plain, strict=True):
            yield next(found) if p else self._by_words(text)

    def _by_pieces(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of plain texts."""
        lower = [t.lower() if t.isascii() else t.decode().lower().encode() for t in texts]
        pieces, starts = pieces_of(b" ".join(lower))
        encoded = pieces.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        self._bound()
        ids = list(map(self.words.get, distinct))
        for i, piece in enumerate(distinct):
            if ids[i] is None:
                ids[i] = self._keep(piece, self.older.get(piece) or self._piece(piece))
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(value) // 4 for value in ids], out=offsets[1:])
        kept = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<u4")))
        dealt = kept.take(encoded.indices)
        # Texts begin a blank behind the end of the one before.
        begin = np.cumsum([0, *(len(t) + 1 for t in lower)])
        ends = (4 * dealt.offsets.to_numpy().astype(np.int64))[np.searchsorted(starts, begin)].tolist()
        data = dealt.values.to_numpy().tobytes()
        for i in range(len(texts)):
            yield data[ends[i] : ends[i + 1]]

    def _by_words(self, text: bytes) -> bytes:
        if b"<|" not in text:  # the case of a special token's text matters
            text = text.lower()
        words = text.split()  # at ASCII white space, all of which the tokenizer drops
        new = set(words).difference(self.words)
        if new:
            if self._bound():
                new = set(words)
            for word in new:
                if word not in self.words:  # as a piece of another
                    self._keep(word, self.older.get(word) or self._word(word))
        return b"".join(map(self.words.__getitem__, words))

    def _bound(self) -> bool:
        """Whether what is kept was too much, and is now what was before."""
        full = self.word_bytes > WORD_BYTES
        if full:
            self.words, self.older, self.word_bytes = {}, self.words, 0
        return full

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():
            return self._piece(word)
        text = word.decode()
        if LATIN.fullmatch(text) and "<|" not in text:
            return b"".join([self._known(p.encode()) for p in PIECES.findall(text.lower())])
        return self._packed(self.whole.encode(text, add_special_tokens=False).ids)

    def _known(self, piece: bytes) -> bytes:
        """Ids of a piece, which are those of the word that it would be alone."""
        value = self.words.get(piece)
        return self._keep(piece, self.older.get(piece) or self._piece(piece)) if value is None else value

    def _piece(self, piece: bytes) -> bytes:
        piece = piece.lower()
        shown = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(AS_CHARACTER)
        return self._packed([t.id for t in self.model.tokenize(shown)])

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _keep(self, word: bytes, value: bytes) -> bytes:
        self.words[word] = value
        self.word_bytes += len(word) + len(value) + ENTRY_BYTES
        return value
