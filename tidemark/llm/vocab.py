"""Encoding with public tokenizers inside tasks.

A text is cut at blanks where no merge can cross, and each distinct piece is
encoded once by the tokenizers library's model and remembered in the worker
(bounded).  Encoding the pieces gives the ids of encoding the whole text.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from collections.abc import Sequence
from functools import partial

import numpy as np

#: Pieces remembered per worker and tokenizer, in each of two generations,
#: where workers go on to other stages; and where they only encode.
MAX_REMEMBERED = 250_000
MANY_REMEMBERED = 700_000
#: Longer pieces are encoded each time and not remembered.
MAX_PIECE = 64

_BLANK = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: Marks a text's first piece, which no blank precedes; never part of a text.
HEAD = "\ud800"
#: Starts a piece that stands for a line end and the text behind it.
LINE = "\n" + HEAD

# Characters below U+0250 need no normalizing but lower case, and every regular
# expression engine puts them in the same classes.
_LATIN = [chr(c) for c in (*range(9, 14), *range(0x20, 0x7F), *range(0xA1, 0x250)) if c != 0xAD]
_LETTER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile("[" + re.escape("".join(_LATIN)) + r"]*\Z")

# The pre-token patterns of the two vocabularies, with the
# classes of the characters above spelled out.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d|"
PRE_TOKEN = {
    "byte": rf"{_CONTRACTIONS} ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+",
    "word": rf"{_CONTRACTIONS}[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+",
}


def _byte_chars() -> dict[int, str]:
    """Byte-level vocabularies spell a byte as itself where it is printable
    Latin-1, and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()
#: The spelling of each Latin letter.
_SPELLING = {ord(c): c.encode().decode("latin1").translate(_BYTE_CHARS) for c in _LETTER}


def vocabulary(name: str, folder: str | None = None) -> str:
    """Path of a public vocabulary file; ``folder`` overrides the installed
    package's."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_level_pieces(text: str, lines: bool = False) -> list[str]:
    """Cut at each blank between two non-blanks: a byte-level pre-token always
    starts there, and the one before ends there.  All pieces but the first,
    which carries ``HEAD``, stand for a blank and themselves.  ``lines`` asks
    for cuts at line ends too, where one or two in a row are pre-tokens each."""
    if not text:
        return []
    odd = ("  " in text or "\n " in text or " \n" in text or text[0] == " " or text[-1] == " "
           or _OTHER_SPACE.search(text))
    if lines and not odd and "\n" in text and text[-1] != "\n" and "\n\n\n" not in text and "<|" not in text:
        text = text.replace("\n", " " + LINE)
    parts = _BLANK.split(text) if odd else text.split(" ")
    parts[0] = HEAD + parts[0]
    return parts


def word_pieces(text: str) -> list[str]:
    """Cut at blanks; this vocabulary drops white space.  It also drops case,
    so a text whose characters fold one by one is folded at once and cut at all
    white space (but where that could make an added token's string, or break
    one)."""
    if "<|" not in text and _PLAIN.match(text):
        return text.lower().split()
    return [p for p in text.split(" ") if p]


def spelled(piece: str) -> str:
    """The text of a byte-level piece."""
    return piece.replace(HEAD, "") if piece[0] == HEAD or piece[:2] == LINE else " " + piece


_loaded: dict[tuple[str, str], Encoder] = {}


def forget() -> None:
    """Drop this worker's encoders and what they remember.  Spark hands a
    worker on from stage to stage; one that needs its memory otherwise calls
    this first."""
    _loaded.clear()


class _Known(dict):
    """Ids by piece.  A missing piece comes from the generation before, or is
    encoded; a full generation becomes the one before."""

    def __init__(self, encode, most: int | None):
        super().__init__()
        self.encode = encode
        self.most = most
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= MAX_PIECE:
            if len(self) >= (self.most or MAX_REMEMBERED):
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Whole-text encoding through remembered pieces."""

    def __init__(self, path: str, cut: str, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        #: Strings that the library takes for a token wherever they stand.
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.holds_added = re.compile("|".join(map(re.escape, self.added)) or r"(?!)").search
        self.cut = {"byte": byte_level_pieces, "word": word_pieces}[cut]
        self.finest = {"byte": partial(byte_level_pieces, lines=True), "word": word_pieces}[cut]
        self.words = cut == "word"
        self.pre = re.compile(PRE_TOKEN[cut]).findall
        self.tokenize = self.tok.model.tokenize
        self.known = _Known(self._encode, remembered)
        self.marks = {m: struct.pack(f"<{len(t)}I", *[x.id for x in t]) for m in ".," for t in [self.tokenize(m)]}
        self.line_end = [t.id for t in self.tokenize(_BYTE_CHARS[0x0A])]

    @classmethod
    def load(cls, path: str, cut: str, remembered: int | None = None) -> Encoder:
        """One per worker process and file; the last caller says how many
        pieces it remembers (none: ``MAX_REMEMBERED``)."""
        if (path, cut) not in _loaded:
            _loaded[path, cut] = cls(path, cut)
        _loaded[path, cut].known.most = remembered
        return _loaded[path, cut]

    def _encode(self, piece: str) -> bytes:
        """The library's merges on each pre-token of a Latin piece; any other
        piece goes through the library's whole pipeline."""
        if self.holds_added(piece):
            text = piece if self.words else spelled(piece)
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # The usual piece: a word, and perhaps a mark, which is a pre-token of its own.
        whole, mark = (piece[:-1], piece[-1]) if piece[-1] in self.marks else (piece, "")
        if self.words:
            lead, word = "", whole.lower()
            whole = word
        elif whole[:1] == HEAD:
            lead, word = "", whole[1:]
        elif whole[:2] == LINE:
            lead, word = "\n", whole[2:]
        else:
            lead, word = " ", whole
        if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
            if mark:
                return self.known[whole] + self.marks[mark]
            if not word.isascii():
                word = word.translate(_SPELLING)
            ids = [t.id for t in self.tokenize(_BYTE_CHARS[0x20] + word if lead == " " else word)]
            if lead == "\n":
                ids = self.line_end + ids
            return struct.pack(f"<{len(ids)}I", *ids)
        text = piece.lower() if self.words else spelled(piece)
        if not _PLAIN.match(text):
            text = piece if self.words else text
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if text.isascii() and text.isprintable():
            ids = [t.id for p in self.pre(text) for t in self.tokenize(p.replace(" ", _BYTE_CHARS[0x20]))]
        else:
            ids = [t.id for p in self.pre(text)
                   for t in self.tokenize(p.encode().decode("latin1").translate(_BYTE_CHARS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids = self.known.__getitem__
        return [b"".join(map(ids, self.finest(t))) for t in texts]

    def counts(self, pieces: Sequence[str]) -> list[int]:
        """Tokens of each piece."""
        return [len(x) >> 2 for x in map(self.known.__getitem__, pieces)]
